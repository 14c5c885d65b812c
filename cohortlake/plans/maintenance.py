"""The warehouse kept up to date by loads of new rows instead of rebuilds.

A load derives from its new rows, and from the moved ``as_of``, which staging
verdicts can change: accounts through their e-mail, enrollments through users and
courses, payments through users and enrollments, attempts through users and paid
pairs. Only these rows are judged again, with the rules of ``operators.staging``,
before and after the load; the difference is appended to the staged tables, or
rewritten where rows leave a part. Marts follow the difference: those by month are
recomputed for the months it touches, the others add what the touched users and
courses count for now and subtract what they counted for.

Raw rows are appended and never change; ids are unique, as the sources promise.
Everything a load writes becomes visible at once, see ``sources.snapshots``.
"""

from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlake.functions import as_ntz, period_start
from cohortlake.operators import staging
from cohortlake.plans import marts
from cohortlake.schemas import SCHEMAS, STAGED_PREFIX, TABLES
from cohortlake.sources.layers import materialize
from cohortlake.sources.snapshots import (
    NOWHERE, Manifest, Snapshots, Stored, add_parts, replace_parts,
)

_SIGN = "_sign"
_IDS = {
    "users": "user_id",
    "courses": "course_id",
    "enrollments": "enrollment_id",
    "payments": "payment_id",
    "payment_attempts": "attempt_id",
}
# How staged rows are dealt into parts. Users and courses by a hash of their id.
_MOMENTS = {
    "enrollments": "enrolled_at",
    "payments": "paid_at",
    "payment_attempts": "attempted_at",
    "ad_costs": "date",
}
_BUCKETS = 16
_PAIR = ["user_id", "course_id"]


def _part(table: str) -> Column:
    """The part of a staged row as text: its month, or a bucket of its id."""
    if table in _MOMENTS:
        part = period_start(_MOMENTS[table])
    else:
        part = F.pmod(F.xxhash64(_IDS[table]), F.lit(_BUCKETS))
    return F.coalesce(part.cast("string"), F.lit(NOWHERE))


def _having(
    rows: DataFrame, keys: DataFrame, on: list[str], how: str = "left_semi"
) -> DataFrame:
    """Rows whose key is among some (or not); a missing key equals a missing one."""
    wanted = keys.select(*[F.col(c).alias(f"_{c}") for c in on]).distinct()
    same = reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in on])
    return rows.join(wanted, same, how)


class Changes:
    """Staged rows that come (sign 1) and go (sign -1), written once.

    ``come_parts`` and ``gone_parts`` are the parts they belong to: months or buckets, so few.
    """

    def __init__(self, before: DataFrame | None, after: DataFrame, table: str):
        key, part = _IDS.get(table), _part(table)
        signed = after.withColumn(_SIGN, F.lit(1))
        if before is not None:
            come = after.join(before.select(key), key, "left_anti").select(*after.columns)
            gone = before.join(after.select(key), key, "left_anti").select(*after.columns)
            signed = come.withColumn(_SIGN, F.lit(1)).unionByName(
                gone.withColumn(_SIGN, F.lit(-1))
            )
        self.signed = materialize(signed, f"changes-{table}")
        self.rows = self.signed.drop(_SIGN)
        self.come = self.signed.filter(F.col(_SIGN) == 1).drop(_SIGN)
        self.gone = self.signed.filter(F.col(_SIGN) == -1).drop(_SIGN)
        found = self.signed.select(_SIGN, part.alias("part")).distinct().collect()
        self.come_parts = {r.part for r in found if r[_SIGN] == 1}
        self.gone_parts = {r.part for r in found if r[_SIGN] == -1}
        self.any = bool(found)


class MaintainedWarehouse:
    """Raw, staged and mart tables below a root, brought forward load by load."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.snapshots = spark, Snapshots(spark, root)

    # Reading

    def read(self, name: str, manifest: Manifest | None = None) -> DataFrame:
        """A stored table of the newest snapshot, or of another one."""
        return self.snapshots.read(manifest or self.snapshots.head(), name)

    def mart_revenue(self) -> DataFrame:
        return marts.revenue_trend(self.read("revenue_months"))

    def mart_ad_performance(self) -> DataFrame:
        return self.read("ad_months").orderBy("month", "channel")

    def mart_activity(self) -> DataFrame:
        return marts.retention(self.read("activity_pairs"))

    def mart_completion(self) -> DataFrame:
        courses = self.read(STAGED_PREFIX + "courses")
        return marts.completion_rates(self.read("course_counts"), courses)

    def mart_conversion(self) -> DataFrame:
        return marts.conversion_rates(self.read("funnel_counts"))

    # Loading

    def load(self, batch: Mapping[str, DataFrame], as_of) -> Manifest:
        """Brings every table forward by the new rows of a batch; publishes them together.

        Tables missing from the batch have no new rows. ``as_of`` must not go back.
        """
        old = self.snapshots.head()
        if old.version and str(as_of) < old.notes["as_of"]:
            raise ValueError(f"as_of {as_of} lies before the last load's, {old.notes['as_of']}")
        load = _Load(self.snapshots, old, batch, as_of)
        load.run()
        self.snapshots.publish(load.new)
        return load.new

    def compact(self, table: str, most: int = 8) -> Manifest:
        """Parts of a staged table that have more than ``most`` folders written anew as one each."""
        old = self.snapshots.head()
        parts = [p for p, folders in old.tables[table].parts.items() if len(folders) > most]
        new = old.next()
        rows = self.snapshots.read(old, table, parts)
        by = _part(table.removeprefix(STAGED_PREFIX))
        if parts:
            replace_parts(new, table, self.snapshots.write(rows, table, by), parts)
            self.snapshots.publish(new)
        return new if parts else old


class _Load:
    """One load, from the snapshot before it to the one that it makes."""

    def __init__(self, snapshots: Snapshots, old: Manifest, batch, as_of):
        self.snapshots, self.spark, self.old = snapshots, snapshots.spark, old
        self.new = old.next(as_of=str(as_of))
        self.as_of = as_of
        self.batch = batch
        self.changes: dict[str, Changes] = {}
        self._frames: dict[tuple, DataFrame] = {}

    def _read(self, manifest: Manifest, name: str, parts=None) -> DataFrame:
        """A table of the old or the new snapshot; its files are listed once."""
        if name not in manifest.tables:
            return self.spark.createDataFrame([], SCHEMAS[name.removeprefix(STAGED_PREFIX)])
        wanted = None if parts is None else tuple(parts)
        place = manifest.version, name, wanted
        if place not in self._frames:
            self._frames[place] = self.snapshots.read(manifest, name, wanted)
        return self._frames[place]

    def _raw(self, table: str) -> DataFrame:
        """Raw rows of the loads before."""
        return self._read(self.old, table)

    def _staged(self, table: str, now: bool = True, parts=None) -> DataFrame:
        return self._read(self.new if now else self.old, STAGED_PREFIX + table, parts)

    def run(self) -> None:
        """Tables that wait for no other are brought forward side by side."""
        with ThreadPoolExecutor(len(TABLES)) as pool:
            self.fresh = dict(zip(TABLES, pool.map(self._append, TABLES), strict=True))
            steps = [
                [self._users, self._courses, self._ad_costs],
                [self._enrollments],
                [self._payments],
                [self._attempts],
                [
                    self._revenue, self._ad_performance, self._activity, self._completion,
                    self._conversion,
                ],
            ]
            for together in steps:
                list(pool.map(lambda step: step(), together))

    def _append(self, table: str) -> DataFrame:
        """The batch's rows of a table, stored as raw rows of this load."""
        rows = self.batch.get(table)
        if rows is None:
            rows = self.spark.createDataFrame([], SCHEMAS[table])
        rows = rows.select(*SCHEMAS[table].names)
        written = self.snapshots.write(rows, table, f"load{self.new.version}")
        add_parts(self.new, table, written)
        return self.snapshots.read(Manifest(tables={table: written}), table)

    # Staged tables

    def _settle(self, table: str, before: DataFrame | None, after: DataFrame) -> None:
        """Finds a table's changes and brings its staged form forward by them.

        Parts that only gain rows get further files; parts that lose some are
        written anew without them.
        """
        key, name = _IDS.get(table), STAGED_PREFIX + table
        changes = self.changes[table] = Changes(before, after, table)
        self.new.tables.setdefault(name, Stored(SCHEMAS[table].json()))
        lost = sorted(changes.gone_parts)
        if lost:
            kept = self._staged(table, now=False, parts=lost).join(
                changes.gone.select(key), key, "left_anti"
            )
            rows = kept.select(*after.columns).unionByName(
                changes.come.filter(_part(table).isin(lost))
            )
            replace_parts(self.new, name, self.snapshots.write(rows, name, _part(table)), lost)
        if changes.come_parts - changes.gone_parts:
            rows = changes.come.filter(~_part(table).isin(lost))
            add_parts(self.new, name, self.snapshots.write(rows, name, _part(table)))

    def _again(self, table: str, *changed: tuple[DataFrame, list[str]]) -> DataFrame | None:
        """Earlier raw rows whose verdict may change, those of any changed key, each once."""
        if not self.old.rows(table):
            return None
        rows, found = self._raw(table), []
        for keys, on in changed:
            found.append(_having(rows, keys, on))
            rows = _having(rows, keys, on, "left_anti")
        if not found:
            return None
        return materialize(reduce(DataFrame.unionByName, found), f"again-{table}")

    def _keys(self, *tables: str) -> list[tuple[DataFrame, list[str]]]:
        """Changed ids of those tables that changed at all."""
        return [
            (self.changes[t].rows, [_IDS[t]]) for t in tables if self.changes[t].any
        ]

    def _known(self, table: str, rows: DataFrame, now: bool) -> DataFrame:
        """The staged rows of a reference that some rows can meet."""
        key = _IDS[table]
        return _having(self._staged(table, now), rows, [key])

    def _users(self) -> None:
        fresh, earlier = self.fresh["users"], self._raw("users")
        emails = fresh.select("email")
        if self.old.version:
            moment = F.col("registered_at")
            since = as_ntz(self.old.notes["as_of"])
            due = earlier.filter((moment > since) & (moment <= as_ntz(self.as_of)))
            emails = emails.unionByName(due.select("email"))
        emails = materialize(emails.distinct(), "emails")
        again = materialize(_having(earlier, emails, ["email"]), "again-users")
        before = staging.stage_users(again, self.old.notes["as_of"]) if self.old.version else None
        after = staging.stage_users(again.unionByName(fresh), self.as_of)
        self._settle("users", before, after)

    def _courses(self) -> None:
        fresh = self.fresh["courses"]
        self._settle("courses", None, staging.stage_courses(fresh))

    def _enrollments(self) -> None:
        again = self._again("enrollments", *self._keys("users", "courses"))

        def staged(rows, now):
            users, courses = (self._known(t, rows, now) for t in ("users", "courses"))
            return staging.stage_enrollments(rows, users, courses)

        rows = self.fresh["enrollments"]
        rows = rows if again is None else again.unionByName(rows)
        before = None if again is None else staged(again, False)
        self._settle("enrollments", before, staged(rows, True))

    def _payments(self) -> None:
        again = self._again("payments", *self._keys("users", "enrollments"))

        def staged(rows, now):
            users, enrollments = (self._known(t, rows, now) for t in ("users", "enrollments"))
            return staging.stage_payments(rows, users, enrollments)

        rows = self.fresh["payments"]
        rows = rows if again is None else again.unionByName(rows)
        before = None if again is None else staged(again, False)
        self._settle("payments", before, staged(rows, True))

    def _attempts(self) -> None:
        keys = self._keys("users")
        if self.changes["payments"].any:
            keys.append((self.changes["payments"].rows, _PAIR))
        again = self._again("payment_attempts", *keys)

        def staged(rows, now):
            paid = _having(self._staged("payments", now), rows, _PAIR)
            return staging.stage_payment_attempts(rows, self._known("users", rows, now), paid)

        rows = self.fresh["payment_attempts"]
        rows = rows if again is None else again.unionByName(rows)
        before = None if again is None else staged(again, False)
        self._settle("payment_attempts", before, staged(rows, True))

    def _ad_costs(self) -> None:
        after = staging.stage_ad_costs(self.fresh["ad_costs"], self.as_of)
        if self.old.version:
            since = as_ntz(self.old.notes["as_of"]).cast("date")
            due = self._raw("ad_costs").filter(F.col("date") > since)
            after = after.unionByName(staging.stage_ad_costs(due, self.as_of))
        self._settle("ad_costs", None, after)

    # Marts by month

    def _months(self, *tables: str) -> set[str]:
        """Months of the changed rows of tables dealt by month."""
        found = set()
        for table in tables:
            found |= self.changes[table].come_parts | self.changes[table].gone_parts
        return found - {NOWHERE}

    @staticmethod
    def _months_of(moments: DataFrame) -> set[str]:
        """Months of a frame of one column."""
        months = moments.select(period_start(moments.columns[0]).alias("month")).distinct()
        return {str(r.month) for r in months.collect() if r.month is not None}

    def _by_month(self, name: str, rows: DataFrame, column: str, months: set[str]) -> None:
        """Rows of some months in place of those stored; the table has few rows per month."""
        if name in self.old.tables:
            kept = self.snapshots.read(self.old, name)
            rows = rows.unionByName(kept.filter(~F.col(column).cast("string").isin(*months)))
        replace_parts(self.new, name, self.snapshots.write(rows.hint("rebalance"), name))

    def _revenue(self) -> None:
        months = self._months("payments")
        if self.changes["courses"].any and self.old.rows(STAGED_PREFIX + "payments"):
            courses = self.changes["courses"].rows
            sold = _having(self._staged("payments", False), courses, ["course_id"])
            months |= self._months_of(sold.select("paid_at"))
        payments = self._staged("payments", parts=sorted(months))
        periods = marts.revenue_by_period(payments, self._staged("courses"))
        self._by_month("revenue_months", periods, "payment_month", months)

    def _ad_performance(self) -> None:
        months = self._months("ad_costs", "payments")
        months |= self._months_of(self.changes["users"].rows.select("registered_at"))
        payments = self._staged("payments", parts=sorted(months))
        users = self._staged("users")
        results = marts.ad_performance(
            self._staged("ad_costs", parts=sorted(months)),
            users.filter(period_start("registered_at").cast("string").isin(*months)),
            _having(users, payments, ["user_id"]),
            payments,
            period_start,
        )
        self._by_month("ad_months", results, "month", months)

    # Marts by difference

    def _add_up(self, name: str, keys: list[str], now: DataFrame, before: DataFrame) -> None:
        """Adds and subtracts counts by key to those stored; keys without any go.

        Other columns of both frames are counts. The stored table has a row per
        month, pair of months or course, whatever the facts.
        """
        counts = [c for c in now.columns if c not in keys]
        minus = before.select(*keys, *[(-F.col(c)).alias(c) for c in counts])
        terms = now.unionByName(minus)
        if name in self.old.tables:
            terms = terms.unionByName(self.snapshots.read(self.old, name))
        sums = terms.groupBy(*keys).agg(*[F.sum(c).cast("long").alias(c) for c in counts])
        left = reduce(Column.__or__, [F.col(c) != 0 for c in counts])
        replace_parts(self.new, name, self.snapshots.write(sums.filter(left), name))

    def _both(
        self, users: DataFrame, tables: list[str], count: Callable[..., DataFrame]
    ) -> tuple[DataFrame, DataFrame]:
        """What some users count for now and before."""
        return tuple(
            count(*[_having(self._staged(t, now), users, ["user_id"]) for t in tables])
            for now in (True, False)
        )

    def _activity(self) -> None:
        users = self.changes["enrollments"].rows.select("user_id")
        now, before = self._both(users, ["enrollments"], marts.activity_pairs)
        self._add_up("activity_pairs", ["cohort_month", "activity_month"], now, before)

    def _completion(self) -> None:
        changes = self.changes["enrollments"]
        now, before = marts.course_counts(changes.come), marts.course_counts(changes.gone)
        self._add_up("course_counts", ["course_id"], now, before)

    def _conversion(self) -> None:
        tables = ["users", "enrollments", "payments", "payment_attempts"]
        users = reduce(DataFrame.union, [self.changes[t].rows.select("user_id") for t in tables])
        users = materialize(users.distinct(), "funnel-users")
        now, before = self._both(users, tables, marts.funnel_counts)
        self._add_up("funnel_counts", ["cohort_month"], now, before)
