"""Streaming form of the five-minute check on successful attempts."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlake.functions import as_ntz
from cohortlake.schemas import SCHEMAS
from cohortlake.session import exists
from cohortlake.streaming.incremental import file_stream


def unconfirmed_stream(
    attempts: DataFrame, payments: DataFrame, within_seconds: int = 300, lateness: str = "10 minutes"
) -> DataFrame:
    """Successful attempts no payment confirmed in time, once the watermark has passed them.

    Both inputs are streams. Watermarks need zoned timestamps, so the times are
    read in the session's zone and given back without one. Payments are reduced to the earliest and latest of
    each user, course and slot before the join, so a busy pair keeps one row of
    state per slot and an attempt meets at most two rows. An attempt is emitted
    when neither its own slot nor the next confirmed it.
    """
    within = f"{within_seconds} seconds"
    limit = F.expr(f"interval {within_seconds} seconds")
    two_slots = F.expr(f"interval {2 * within_seconds} seconds")
    slots = (
        payments.withColumn("paid_at", F.col("paid_at").cast("timestamp"))
        .withWatermark("paid_at", lateness)
        .groupBy(F.window("paid_at", within), "user_id", "course_id")
        .agg(F.min("paid_at").alias("earliest"), F.max("paid_at").alias("latest"))
    )
    nothing = F.lit(None).cast("timestamp")
    own = F.struct(
        F.col("window.start").alias("slot"), F.col("latest"), nothing.alias("earliest")
    )
    before = F.struct(
        (F.col("window.start") - limit).alias("slot"), nothing.alias("latest"), F.col("earliest")
    )
    evidence = slots.select(
        F.col("user_id").alias("p_user"),
        F.col("course_id").alias("p_course"),
        F.window_time("window").alias("seen_at"),
        F.inline(F.array(own, before)),
    )
    successes = (
        attempts.filter(F.col("result") == "success")
        .withColumn("attempted_at", F.col("attempted_at").cast("timestamp"))
        .withWatermark("attempted_at", lateness)
        .withColumn("a_slot", F.window("attempted_at", within).getField("start"))
    )
    at = F.col("attempted_at")
    confirmed = (F.col("latest") >= at) | (F.col("earliest") <= at + limit)
    joined = successes.join(
        evidence,
        (F.col("user_id") == F.col("p_user"))
        & (F.col("course_id") == F.col("p_course"))
        & (F.col("a_slot") == F.col("slot"))
        & (F.col("seen_at") >= at)
        & (F.col("seen_at") <= at + two_slots)
        & confirmed,
        "left_outer",
    )
    unmatched = joined.filter(F.col("seen_at").isNull()).select(*attempts.columns)
    return unmatched.withColumn("attempted_at", F.col("attempted_at").cast("timestamp_ntz"))


# Fixed value: later than every row, so that the watermark passes all of them.
_CLOSING = "9999-01-01 00:00:00"


def unconfirmed_to_end(
    spark: SparkSession,
    attempts: str,
    payments: str,
    work: str,
    within_seconds: int = 300,
    lateness: str = "10 minutes",
    **options,
) -> DataFrame:
    """The unconfirmed attempts of two folders of files, read as streams to their end.

    A closing row after all others stands in each stream, so the watermark passes every
    real row and each attempt is settled. Results and progress lie below ``work``: files
    that come later are read by the next call, if the folder is the same, and then a
    file may be late; all that one call finds new is one micro-batch unless ``options``
    of the file source ask for smaller ones, in the order in which files were written.
    Attempts without a time can not be passed and are not returned.
    """
    streams = {}
    for table, folder, moment in (
        ("payment_attempts", attempts, "attempted_at"),
        ("payments", payments, "paid_at"),
    ):
        schema = SCHEMAS[table]
        # With keys, as rows without one are left out before their time is seen.
        closing = {"user_id": F.lit(0), "course_id": F.lit(0), "result": F.lit("success")}
        closing[moment] = F.lit(_CLOSING)
        row = [
            closing.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields
        ]
        path = f"{work}/closing_{table}"
        if not exists(spark, path):
            spark.range(1).select(*row).write.parquet(path)
        files = [file_stream(spark, schema, f, **options) for f in (folder, path)]
        streams[table] = files[0].unionByName(files[1])
    found = unconfirmed_stream(
        streams["payment_attempts"], streams["payments"], within_seconds, lateness
    )
    query = (
        found.writeStream.format("parquet")
        .option("path", f"{work}/unconfirmed")
        .option("checkpointLocation", f"{work}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    rows = spark.read.schema(SCHEMAS["payment_attempts"]).parquet(f"{work}/unconfirmed")
    return rows.filter(F.col("attempted_at") < as_ntz(_CLOSING))
