"""Exact distinct counts that can be merged and rolled up, kept as bitmaps of member ids.

A bitmap row holds 32,768 neighbouring ids of one day. Days of two loads are merged by
OR, and so are days into weeks, months or any other period, without reading the members
again; a count is the number of bits. Ids that lie close together share rows, so the
table grows with days x (largest id / 32,768), not with the facts.
"""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlake.functions import period_start

_BUCKET, _BITS = "bucket", "members"


def daily_members(facts: DataFrame, member: str, moment: str) -> DataFrame:
    """``period, bucket, members``: the members of each day. Rows without a member count none."""
    return facts.groupBy(
        period_start(moment, "day").alias("period"),
        F.bitmap_bucket_number(member).alias(_BUCKET),
    ).agg(F.bitmap_construct_agg(F.bitmap_bit_position(member)).alias(_BITS))


def merged(*days: DataFrame) -> DataFrame:
    """The members of several loads; a member of a day in two of them is one."""
    return _together(reduce(DataFrame.unionByName, days))


def rolled_up(days: DataFrame, grain: str) -> DataFrame:
    """Members per week, month or year from those of shorter periods."""
    return _together(days.withColumn("period", period_start("period", grain)))


def _together(bitmaps: DataFrame) -> DataFrame:
    return bitmaps.groupBy("period", _BUCKET).agg(F.bitmap_or_agg(_BITS).alias(_BITS))


def counted(bitmaps: DataFrame, name: str) -> DataFrame:
    """Distinct members per period."""
    return bitmaps.groupBy("period").agg(F.sum(F.bitmap_count(_BITS)).alias(name))
