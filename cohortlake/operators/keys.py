"""Key sets, orphan counts and de-duplication that stay small under a hot key."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_SALTS = 16


def key_set(df: DataFrame, keys: list[str], spread: str) -> DataFrame:
    """Keys of ``df`` with at most 16 copies each, for the right side of a semi or anti join.

    The copies are grouped by the keys and a salt of ``spread``, so the result
    is not yet placed by the keys: the join shuffles both sides itself, which is
    what lets adaptive execution split a hot key on the left.
    """
    salt = F.pmod(F.xxhash64(spread), F.lit(_SALTS))
    return df.select(*keys, salt.alias("_salt")).distinct().select(*keys)


def rows_per_key(df: DataFrame, keys: list[str], *more: Column) -> DataFrame:
    """One row per key with its row count ``rows`` and further aggregates."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"), *more)


def count_orphans(df: DataFrame, reference: DataFrame, keys: list[str]) -> DataFrame:
    """One row ``n``: rows of ``df`` whose key is absent from ``reference``.

    Rows with a NULL key count as orphans. Both sides are reduced to one row
    per key first, so only distinct keys are shuffled.
    """
    orphans = rows_per_key(df, keys).join(
        reference.select(*keys).distinct(), keys, "left_anti"
    )
    return orphans.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("n"))


def orphans(df: DataFrame, reference: DataFrame, keys: list[str], spread: str) -> DataFrame:
    """The orphaned rows themselves."""
    return df.join(key_set(reference, keys, spread), keys, "left_anti").select(*df.columns)


def duplicate_members(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row ``n``: rows whose key occurs more than once; NULL is one key."""
    repeated = rows_per_key(df, keys).filter(F.col("rows") > 1)
    return repeated.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("n"))


def keep_smallest_id(df: DataFrame, key: str, row_id: str) -> DataFrame:
    """Rows whose ``row_id`` is the smallest of their ``key``."""
    first = df.groupBy(key).agg(F.min(row_id).alias(row_id)).select(row_id)
    return df.join(first, row_id, "left_semi").select(*df.columns)


def keep_first(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """One row per key, the one with the smallest ``order``; a row without one comes last.

    ``min_by`` over the whole row combines map-side, so copies of one key never
    meet in one task the way a row number per key would bring them together.
    """
    rest = [c for c in df.columns if c not in keys]
    place = F.struct(F.col(order).isNull(), F.col(order))
    first = df.groupBy(*keys).agg(F.min_by(F.struct(*rest), place).alias("_row"))
    return first.select(*keys, "_row.*").select(*df.columns)


def number_rows(ordered: DataFrame, name: str, folder: str) -> DataFrame:
    """Numbers from 1 in the order of a frame already sorted with ``orderBy``.

    The sorted frame is written once; a row's number is its place within its
    sorted partition plus the rows of the partitions before. Only one count per
    partition is gathered, never the rows.
    """
    spark = ordered.sparkSession
    marked = ordered.withColumn("_place", F.monotonically_increasing_id())
    marked.write.mode("errorifexists").parquet(folder)
    placed = spark.read.schema(marked.schema).parquet(folder)
    # Fixed value: the id keeps the row's place in its lower 33 bits.
    part = F.shiftright(F.col("_place"), 33)
    sizes = placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_rows"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"))
    in_part = F.col("_place") - F.shiftleft(F.col("_part"), 33)
    numbered = placed.withColumn("_part", part).join(starts, "_part")
    number = (F.col("_start") + in_part + 1).alias(name)
    return numbered.select(*[c for c in ordered.columns if c != name], number)
