"""Quality checks kept up to date while rows stream in.

Checks that look at one row at a time need no second pass: a micro-batch is counted
while it is written, and its counts are a few rows beside it. Counts of batches add up,
so totals, and the batch in which a total passed a limit, come from those rows alone.
"""

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from cohortlake import schemas as S
from cohortlake.functions import as_ntz
from cohortlake.operators.quality import CHECKS
from cohortlake.session import exists

_COUNTS = "table_name string, code string, n long, batch_id long"


def row_conditions(table: str, as_of) -> dict[str, Column]:
    """What each check of a table that needs no other row looks for."""
    now, col = as_ntz(as_of), F.col

    def outside(column, domain):
        return F.coalesce(~col(column).isin(domain), F.lit(True))

    return {
        "users": {"A2": col("registered_at") > now, "A3": col("channel").isNull()},
        "courses": {"A4": col("price_rub") == 0, "A5": col("is_published") == 0},
        "enrollments": {
            "A7": outside("status", S.ENROLLMENT_STATUSES),
            "A8": (col("progress_pct") == 100) & ~col("status").eqNullSafe("completed"),
        },
        "payments": {
            "A10": col("amount_rub") < 0,
            "A11": (col("amount_rub") == 0) & (col("status") == "success"),
        },
        "payment_attempts": {"A17": outside("result", S.ATTEMPT_RESULTS)},
        "ad_costs": {
            "A18": (col("spend_rub") == 0) & (col("impressions") > 0),
            "A19": col("date").cast("timestamp_ntz") > now,
            "A20": outside("channel", S.PAID_CHANNELS),
        },
    }[table]


def load_checked(
    stream: DataFrame, table: str, as_of, target: str, counts: str, checkpoint: str
) -> None:
    """Appends everything new of a table to ``target`` and its counts to ``counts``, then stops.

    Rows and counts of a micro-batch lie in partitions of its number, which a batch
    repeated after a failure overwrites, so nothing is counted twice.
    """
    conditions = row_conditions(table, as_of)

    def write(batch: DataFrame, batch_id: int) -> None:
        seen = Observation()
        found = [F.count_if(c).alias(code) for code, c in conditions.items()]
        observed = batch.observe(seen, F.count(F.lit(1)).alias("rows"), *found)
        numbered = observed.withColumn("batch_id", F.lit(batch_id).cast("long"))
        _overwrite(numbered, ["batch_id"], target)
        got = seen.get
        rows = [(table, code, got.get(code, 0), batch_id) for code in conditions]
        frame = batch.sparkSession.createDataFrame(rows, _COUNTS).coalesce(1)
        _overwrite(frame, ["table_name", "batch_id"], counts)

    query = (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def _overwrite(df: DataFrame, parts: list[str], target: str) -> None:
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*parts).parquet(target)


def totals(counts: DataFrame) -> DataFrame:
    """``code, table_name, severity, n`` over all batches so far; 0 before the first."""
    severities = F.create_map(*[F.lit(x) for c, d in CHECKS.items() for x in (c, d[1])])
    none = [(t, code, 0, -1) for t in S.TABLES for code in row_conditions(t, "1970-01-01")]
    counts = counts.unionByName(counts.sparkSession.createDataFrame(none, _COUNTS))
    sums = counts.groupBy("code", "table_name").agg(F.sum("n").alias("n"))
    return sums.select("code", "table_name", severities[F.col("code")].alias("severity"), "n")


def crossings(counts: DataFrame, limits: Mapping[str, int]) -> DataFrame:
    """``code, table_name, batch_id, n``: the batch in which a check's total passed its limit.

    The window runs over the counts of batches, a row each, not over rows.
    """
    limit = F.create_map(*[F.lit(x) for item in limits.items() for x in item])
    so_far = F.sum("n").over(Window.partitionBy("table_name", "code").orderBy("batch_id"))
    running = counts.withColumn("total", so_far).withColumn("limit", limit[F.col("code")])
    passed = (F.col("total") > F.col("limit")) & (F.col("total") - F.col("n") <= F.col("limit"))
    return running.filter(passed).select("code", "table_name", "batch_id", F.col("total").alias("n"))


def read_counts(spark: SparkSession, folder: str) -> DataFrame:
    """The counts of all batches; none before the first."""
    if not exists(spark, folder):
        return spark.createDataFrame([], _COUNTS)
    return spark.read.schema(_COUNTS).parquet(folder)
