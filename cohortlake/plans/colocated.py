"""Staging over facts that lie together with their users.

Facts and users are dealt into the same buckets of ``user_id`` once. Joins on the user,
and on the user with a further key, then read bucket by bucket and shuffle no fact.
Without a shuffle nothing can split a hot user at run time, so users with more rows
than a bucket holds on average are laid apart when the layer is dealt, and facts without
a user with them. At most three times as many users as buckets can be that hot, which
bounds what is broadcast; their facts meet in shuffled joins, which Spark can split.

What a join on the user can not settle is the rule that a payment's enrollment is
staged, as an enrollment may be another user's. Payments find their own user's
enrollments in their bucket first; only those left over look everywhere.
"""

import uuid
from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlake.operators import staging
from cohortlake.operators.keys import key_set
from cohortlake.session import like
from cohortlake.sources.layers import create_table

FACTS = ["enrollments", "payments", "payment_attempts"]


def _bucketwise(reference: DataFrame) -> DataFrame:
    """A side that is joined as it lies, however small: a result then stays in its buckets."""
    return reference.hint("merge")


class ColocatedLayer:
    """Staged facts of raw tables, dealt by user below ``root``.

    ``buckets`` should grow with the facts, so that a bucket is what one task can sort.
    """

    def __init__(self, raw: Mapping[str, DataFrame], as_of, root: str, buckets: int):
        spark = raw["users"].sparkSession
        self.root, self.buckets, self.as_of = root, buckets, as_of
        # Its own settings: buckets of the user serve joins on the user and more.
        self.spark: SparkSession = like(spark)
        self.spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
        self._tables = f"colocated_{uuid.uuid4().hex}"
        self.hot = create_table(self._hot_users(raw), f"{root}/hot")
        self.courses = create_table(staging.stage_courses(raw["courses"]), f"{root}/courses")
        staged_users = staging.stage_users(raw["users"], as_of)
        together, apart = self._deal("users", staged_users.select("user_id", "registered_at"))
        self.users = _bucketwise(together), apart
        self.raw = {t: self._deal(t, raw[t]) for t in FACTS}
        self._staged: dict[str, tuple[DataFrame, DataFrame]] = {}

    def _hot_users(self, raw: Mapping[str, DataFrame]) -> DataFrame:
        """Users with more rows of a fact than its buckets have on average: ``buckets`` a fact."""
        found = []
        for table in FACTS:
            per_user = raw[table].groupBy("user_id").agg(F.count(F.lit(1)).alias("rows"))
            per_user = create_table(per_user, f"{self.root}/rows_{table}")
            total = per_user.agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0]
            hot = (F.col("rows") * self.buckets > total) & F.col("user_id").isNotNull()
            found.append(per_user.filter(hot).select("user_id"))
        return reduce(DataFrame.union, found).distinct()

    def _bucketed(self, name: str, rows: DataFrame) -> DataFrame:
        """Rows in buckets of their user, one file each, sorted."""
        table = f"{self._tables}_{name}"
        (
            rows.write.bucketBy(self.buckets, "user_id")
            .sortBy("user_id")
            .option("path", f"{self.root}/{name}/together")
            .saveAsTable(table)
        )
        return self.spark.table(table)

    def _deal(self, name: str, rows: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Rows of ordinary users in buckets, and those of hot users and of none apart."""
        hot = F.broadcast(self.hot)
        known = rows.filter(F.col("user_id").isNotNull())
        ordinary = known.join(hot, "user_id", "left_anti").select(*rows.columns)
        apart = known.join(hot, "user_id", "left_semi").select(*rows.columns)
        apart = apart.unionByName(rows.filter(F.col("user_id").isNull()))
        together = self._bucketed(name, ordinary.repartition(self.buckets, "user_id"))
        create_table(apart, f"{self.root}/{name}/apart")
        return together, self.spark.read.schema(rows.schema).parquet(f"{self.root}/{name}/apart")

    def _store(self, name: str, together: DataFrame, apart: DataFrame):
        """Staged parts: the first stays in the buckets it was read from."""
        return (
            self._bucketed(f"stg_{name}", together),
            create_table(apart, f"{self.root}/stg_{name}/apart"),
        )

    def staged(self, table: str) -> tuple[DataFrame, DataFrame]:
        """The staged rows of a fact: those in buckets, and those apart."""
        if table not in self._staged:
            parts = getattr(self, f"_{table}")()
            self._staged[table] = self._store(table, *parts)
        return self._staged[table]

    def __getitem__(self, table: str) -> DataFrame:
        return reduce(DataFrame.unionByName, self.staged(table))

    def _enrollments(self) -> tuple[DataFrame, DataFrame]:
        return tuple(
            staging.stage_enrollments(rows, users, self.courses)
            for rows, users in zip(self.raw["enrollments"], self.users, strict=True)
        )

    def own_enrollments(self) -> DataFrame:
        """Payments in buckets, timely and positive, marked where their own user's enrollment is staged."""
        payments, _ = self.raw["payments"]
        users, _ = self.users
        staged, _ = self.staged("enrollments")
        timely = staging._since_registration(
            payments.filter(F.col("amount_rub") > 0), users, "paid_at"
        )
        own = staged.select("user_id", "enrollment_id", F.lit(True).alias("_own"))
        own = _bucketwise(own)
        return timely.join(own, ["user_id", "enrollment_id"], "left").select(
            *payments.columns, "_own"
        )

    def _payments(self) -> tuple[DataFrame, DataFrame]:
        marked = self.own_enrollments()
        columns = self.raw["payments"][0].columns
        settled = marked.filter(F.col("_own")).select(*columns)
        left = marked.filter(F.col("_own").isNull()).select(*columns)
        everywhere = self["enrollments"].select("enrollment_id")
        left = create_table(left, f"{self.root}/left_payments")
        # The ids that rows left over ask for, then the rows that got an answer.
        asked = key_set(left, ["enrollment_id"], "payment_id")
        there = everywhere.join(asked, "enrollment_id", "left_semi")
        others = left.join(there, "enrollment_id", "left_semi").select(*columns)
        apart, users = self.raw["payments"][1], self.users[1]
        apart = staging.stage_payments(apart, users, self["enrollments"])
        # Few, so the shuffle that brings them to their users' buckets is small.
        others = others.repartition(self.buckets, "user_id")
        return settled.unionByName(others), apart

    def _payment_attempts(self) -> tuple[DataFrame, DataFrame]:
        together, apart = self.staged("payments")
        payments = _bucketwise(together), apart
        return tuple(
            self._judged_attempts(rows, users, paid)
            for rows, users, paid in zip(
                self.raw["payment_attempts"], self.users, payments, strict=True
            )
        )

    @staticmethod
    def _judged_attempts(rows: DataFrame, users: DataFrame, paid: DataFrame) -> DataFrame:
        """As ``stage_payment_attempts``; pairs are joined as they lie, in their user's bucket."""
        pair, result = ["user_id", "course_id"], F.col("result")
        other = rows.filter(result.isin("failed", "abandoned"))
        other = other.join(users.select("user_id"), "user_id", "left_semi")
        success = rows.filter(result == "success").join(paid.select(*pair), pair, "left_semi")
        return other.select(*rows.columns).unionByName(success.select(*rows.columns))
