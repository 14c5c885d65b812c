"""Parquet tables written and read back, counted and previewed."""

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from cohortlake.session import run_folder


def create_table(df: DataFrame, path: str) -> DataFrame:
    """Write a new table and read it back; fails where one exists."""
    df.write.mode("errorifexists").option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def replace_table(df: DataFrame, path: str) -> DataFrame:
    """Write a table over whatever was there and read it back."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_counted(df: DataFrame, path: str, replace: bool = False) -> tuple[DataFrame, int]:
    """The table written and read back, and its rows as observed during the write."""
    seen = Observation()
    observed = df.observe(seen, F.count(F.lit(1)).alias("rows"))
    written = replace_table(observed, path) if replace else create_table(observed, path)
    return written, seen.get["rows"]


def materialize(df: DataFrame, name: str) -> DataFrame:
    """A frame written once to the shared folder and read from there.

    Used where several branches read the same frame, or where a join must
    shuffle it afresh. Lost executors cost nothing but a re-read.
    """
    return create_table(df, run_folder(df.sparkSession, name))


def row_counts(tables: dict[tuple[str, str], DataFrame]) -> DataFrame:
    """Rows per (layer, table) as ``layer, table_name, row_count``."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(layer).alias("layer"), F.lit(table).alias("table_name"), "row_count"
        )
        for (layer, table), df in tables.items()
    ]
    counts = parts[0]
    for part in parts[1:]:
        counts = counts.unionByName(part)
    return counts


def kept_and_excluded(raw: dict[str, DataFrame], staged: dict[str, DataFrame]) -> DataFrame:
    """Rows kept and excluded by staging, per table."""
    counts = row_counts(
        {("raw", t): df for t, df in raw.items()} | {("staging", t): df for t, df in staged.items()}
    )

    def of(layer):
        return F.sum(F.when(F.col("layer") == layer, F.col("row_count")).otherwise(0))

    return counts.groupBy("table_name").agg(
        of("raw").alias("raw_rows"),
        of("staging").alias("kept_rows"),
        (of("raw") - of("staging")).alias("excluded_rows"),
    )


def list_tables(spark: SparkSession, namespace: str) -> list[str]:
    """Names of the tables of a catalog namespace, sorted."""
    return sorted(t.name for t in spark.catalog.listTables(namespace) if not t.isTemporary)


def preview(df: DataFrame, columns: list[str], order: str, rows: int = 3) -> DataFrame:
    """The first rows of a table in the order of one column, NULL last."""
    return df.select(*columns).orderBy(F.asc_nulls_last(order)).limit(rows)
