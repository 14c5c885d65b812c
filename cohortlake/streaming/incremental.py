"""Incremental load of new files, and refresh of the months they touch."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortlake.functions import period_start
from cohortlake.session import is_folder


def file_stream(
    spark: SparkSession,
    schema: T.StructType,
    folder: str,
    pattern: str | None = None,
    fmt: str = "parquet",
    **options,
) -> DataFrame:
    """New files of a folder as a stream; the schema is declared, never inferred."""
    reader = spark.readStream.schema(schema).format(fmt).options(**options)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.load(folder)


def table_stream(spark: SparkSession, schema: T.StructType, path: str) -> DataFrame:
    """New files of a Parquet table, stored as one file or as a folder of files."""
    folder, _, name = path.rstrip("/").rpartition("/")
    if is_folder(spark, path):
        return file_stream(spark, schema, path)
    return file_stream(spark, schema, folder, name)


def load_new(
    stream: DataFrame,
    moment: str,
    target: str,
    checkpoint: str,
    after_batch: Callable[[int], None] | None = None,
) -> None:
    """Append everything new to ``target`` by month, then stop.

    Each micro-batch overwrites its own ``month / batch_id`` partitions, so a
    batch repeated after a failure leaves no second copy.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        placed = batch.withColumns(
            {"month": period_start(moment), "batch_id": F.lit(batch_id).cast("bigint")}
        )
        _overwrite_parts(placed, ["month", "batch_id"], target)
        if after_batch is not None:
            after_batch(batch_id)

    query = (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def _overwrite_parts(df: DataFrame, parts: list[str], target: str) -> None:
    """Replace only the partitions present in ``df``; big ones are split over tasks."""
    (
        df.hint("rebalance", parts[0])
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*parts)
        .parquet(target)
    )


def read_loaded(spark: SparkSession, schema: T.StructType, target: str) -> DataFrame:
    """Loaded rows with their ``month`` partition, which filters prune."""
    parts = [T.StructField("month", T.DateType()), T.StructField("batch_id", T.LongType())]
    return spark.read.schema(T.StructType(schema.fields + parts)).parquet(target)


def refresh_months(
    loaded: DataFrame, batch_id: int, mart: Callable[[DataFrame], DataFrame], target: str
) -> None:
    """Recompute ``mart`` for the months of a loaded batch and replace just these.

    ``mart`` must keep the ``month`` column. The months of a batch are calendar
    months, so naming them in the filter is safe and prunes the other partitions.
    Rows without a time are a month of their own, the missing one.
    """
    of_batch = loaded.filter(F.col("batch_id") == batch_id).select("month").distinct()
    months = [r.month for r in of_batch.collect()]
    if months:
        touched = F.col("month").isin([m for m in months if m is not None])
        if None in months:
            touched = F.coalesce(touched, F.lit(False)) | F.col("month").isNull()
        _overwrite_parts(mart(loaded.filter(touched)), ["month"], target)
