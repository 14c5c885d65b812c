"""History of changing attributes and joins at the time of an event."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortlake.functions import as_ntz

# Fixed value: the end of a version that is still valid.
OPEN_END = "9999-12-31 00:00:00"


def _neighbour(
    rows: DataFrame, key: str, at: str, value: str, ahead: bool, name: str
) -> DataFrame:
    """The rows with ``value`` of the row before (or after) them in their key's time.

    Rows meet within their key and month; months meet as one row each, by the
    value at their end (or start). So a key with very many rows is never one group.
    What a month gets from the one beside it joins its rows as a row of its own,
    so the rows are shuffled once and meet no join.
    """
    order = F.asc if not ahead else F.desc
    pick = F.min_by if ahead else F.max_by
    ends = rows.groupBy(key, "_month").agg(pick(value, at).alias("_end"))
    months = Window.partitionBy(key).orderBy(order("_month"))
    far = ends.select(key, "_month", F.lag("_end").over(months).alias(value))
    far = far.filter(F.col(value).isNotNull()).withColumn("_own", F.lit(False))
    inside = Window.partitionBy(key, "_month").orderBy("_own", order(at))
    met = rows.withColumn("_own", F.lit(True)).unionByName(far, allowMissingColumns=True)
    near = met.withColumn(name, F.lag(value).over(inside))
    return near.filter("_own").select(*rows.columns, name)


def instants(
    snapshots: DataFrame, key: str, attributes: list[str], observed_at: str
) -> DataFrame:
    """One row per key and time; of several states at one instant the largest stays."""
    state = F.struct(*attributes)
    return (
        snapshots.filter(F.col(observed_at).isNotNull())
        .groupBy(key, observed_at)
        .agg(F.max(state).alias("_state"))
        .select(key, "_state.*", observed_at)
    )


def build_history(
    snapshots: DataFrame, key: str, attributes: list[str], observed_at: str
) -> DataFrame:
    """Versions ``[valid_from, valid_to)`` of a key's attributes from dated snapshots.

    Every change is a version, however short. Two snapshots of the same instant
    are settled by their attributes, the larger ones stay. Snapshots without a time
    cannot be placed and are left out.
    """
    seen = instants(snapshots, key, attributes, observed_at)
    return versions_of(seen, key, attributes, observed_at)


def versions_of(
    seen: DataFrame, key: str, attributes: list[str], observed_at: str
) -> DataFrame:
    """The versions of ``build_history`` from rows that are one per key and time already."""
    state = F.struct(*attributes)
    month = F.trunc(F.col(observed_at).cast("date"), "month")
    dated = seen.select(key, observed_at, state.alias("_state"), month.alias("_month"))
    before = _neighbour(dated, key, observed_at, "_state", False, "_before")
    changed = before.filter(~F.col("_before").eqNullSafe(F.col("_state"))).drop("_before")
    ended = _neighbour(changed, key, observed_at, observed_at, True, "_upcoming")
    return ended.select(
        key,
        "_state.*",
        F.col(observed_at).alias("valid_from"),
        F.coalesce("_upcoming", as_ntz(OPEN_END)).alias("valid_to"),
        F.col("_upcoming").isNull().alias("is_current"),
    )


def join_at_time(
    events: DataFrame, history: DataFrame, key: str, moment: str, how: str = "inner"
) -> DataFrame:
    """Events with the version valid at their time.

    Versions are first spread over the calendar months in which their key has
    events at all, so there are at most as many rows as versions and event months
    together. Events then meet the versions of their key and month only, in an
    equi-join that spreads a hot key over its months.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"unsupported join type {how!r}")
    month = F.trunc(F.col(moment).cast("date"), "month")
    dated = events.withColumn("_month", month)
    event_months = dated.select(F.col(key).alias("_key"), "_month").distinct()
    versions = history.withColumnsRenamed({c: f"h_{c}" for c in history.columns if c == moment})
    in_month = (
        (F.col(key) == F.col("_key"))
        & (F.col("valid_from") < F.add_months("_month", 1).cast("timestamp_ntz"))
        & (F.col("valid_to") > F.col("_month").cast("timestamp_ntz"))
    )
    spread = versions.join(event_months, in_month).drop("_key")
    e, h = dated.alias("e"), spread.alias("h")
    on = (
        (F.col(f"e.{key}") == F.col(f"h.{key}"))
        & (F.col("e._month") == F.col("h._month"))
        & (F.col(f"e.{moment}") >= F.col("h.valid_from"))
        & (F.col(f"e.{moment}") < F.col("h.valid_to"))
    )
    joined = e.join(h, on, how)
    kept = [F.col(f"e.{c}") for c in events.columns]
    if how in ("left_semi", "left_anti"):
        return joined.select(*kept)
    extra = [F.col(f"h.{c}") for c in versions.columns if c != key]
    return joined.select(*kept, *extra)
