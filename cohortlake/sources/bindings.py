"""The six logical tables over order-processing Parquet tables.

Every derived column is a deterministic expression of real columns, and every row
of the source becomes a row; remainders of keys only decide which rows carry a
defect for the quality checks to find. ``course_snapshots`` dates course
attributes for the history operators.
"""

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlake import schemas as S
from cohortlake.functions import as_ntz
from cohortlake.sources.layers import materialize

AS_OF = "1999-06-30 00:00:00"

# Fixed value: bytes of rows to a byte of a source file, by its order lines (12 and some 110).
UNPACKED = 8

# How source codes read as business terms.
SEGMENT_CHANNEL = {
    "BUILDING": "vk_ads",
    "AUTOMOBILE": "yandex_direct",
    "MACHINERY": "telegram",
    "HOUSEHOLD": "organic",
    "FURNITURE": "referral",
}
TYPE_PRODUCT = {
    "STANDARD": S.COURSE,
    "ECONOMY": S.COURSE,
    "SMALL": S.INTENSIVE,
    "MEDIUM": S.INTENSIVE,
    "LARGE": S.SUBSCRIPTION,
    "PROMO": S.SUBSCRIPTION,
}
ORDER_STATUS = {"F": "completed", "O": "active", "P": "dropped"}
EVENT_RESULT = {"purchase": "success", "error": "failed", "view": "abandoned", "click": "click"}
AD_CHANNELS = ["vk_ads", "yandex_direct", "telegram", "organic", "referral"]
METHODS = ["card", "sbp", "wallet"]
# Days that move the events of the source to the month before AS_OF.
EVENT_SHIFT_DAYS = 8980


def _coded(column: str, mapping: dict[str, str]) -> Column:
    value = F.lit(None).cast("string")
    for code, name in mapping.items():
        value = F.when(F.col(column) == code, name).otherwise(value)
    return value


def _pick(index: Column, values: list[str]) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def _rest(column: str, divisor: int) -> Column:
    return F.col(column) % divisor


def _days(amount: Column) -> Column:
    return F.make_dt_interval(days=amount.cast("int"))


# The source columns, declared so that no read has to look for them.
SOURCES = {
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double,"
    " c_mktsegment string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int,"
    " p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,"
    " o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int,"
    " l_quantity double, l_extendedprice double, l_discount double, l_tax double,"
    " l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string,"
    " value double, props string",
}


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.schema(SOURCES[table]).parquet(f"{sf_dir}/{table}.parquet")


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers; every twentieth shares an e-mail, every hundredth has none."""
    number = F.col("c_custkey")
    owner = number - F.when(_rest("c_custkey", 20) == 19, 1).otherwise(0)
    email = F.concat(F.lit("user"), owner.cast("string"), F.lit("@example.org"))
    return read(spark, sf_dir, "customer").select(
        number.alias("user_id"),
        F.when(_rest("c_custkey", 100) != 57, email).alias("email"),
        (_rest("c_custkey", 20) + 14).cast("int").alias("age"),
        F.concat(F.lit("city"), F.col("c_nationkey").cast("string")).alias("city"),
        F.when(_rest("c_custkey", 50) != 11, _coded("c_mktsegment", SEGMENT_CHANNEL)).alias(
            "channel"
        ),
        (as_ntz("1995-01-01") + _days((number * 37) % 1800)).alias("registered_at"),
        F.when(F.col("c_acctbal") > 0, 1).otherwise(0).alias("is_active"),
    )


def courses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts; every fortieth is free, sizes divisible by ten are unpublished."""
    size = F.col("p_size")
    product = _coded("p_type", TYPE_PRODUCT)
    price = F.floor("p_retailprice").cast("bigint")
    low, middle, high = S.LEVELS
    return read(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("course_id"),
        F.col("p_name").alias("title"),
        F.col("p_brand").alias("subject"),
        F.when(size <= 16, low).when(size <= 33, middle).otherwise(high).alias("level"),
        product.alias("course_type"),
        F.when(_rest("p_partkey", 40) == 7, 0).otherwise(price).alias("price_rub"),
        F.when(product != S.SUBSCRIPTION, (size % 9 + 4).cast("double")).alias("duration_weeks"),
        (as_ntz("1994-01-01") + _days(_rest("p_partkey", 300))).alias("created_at"),
        F.when(size % 10 == 0, 0).otherwise(1).alias("is_published"),
    )


def _order_courses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order with its smallest part as its course, none where it has no lines."""
    first = (
        read(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_orderkey").alias("o_orderkey"))
        .agg(F.min("l_partkey").alias("first_part"))
    )
    orders = read(spark, sf_dir, "orders")
    return orders.join(first, "o_orderkey", "left")


def enrollments(
    spark: SparkSession, sf_dir: str, order_courses: DataFrame | None = None
) -> DataFrame:
    """Orders; some point to no course, some have an unknown or no status."""
    number = F.col("o_orderkey")
    status = (
        F.when(_rest("o_orderkey", 97) == 5, "archived")
        .when(_rest("o_orderkey", 97) == 6, "paused")
        .when(_rest("o_orderkey", 97) != 7, _coded("o_orderstatus", ORDER_STATUS))
    )
    course = F.when(_rest("o_orderkey", 211) == 9, -number).otherwise(F.col("first_part"))
    orders = order_courses or _order_courses(spark, sf_dir)
    return orders.select(
        number.alias("enrollment_id"),
        F.col("o_custkey").alias("user_id"),
        course.alias("course_id"),
        F.col("o_orderdate").alias("enrolled_at"),
        status.alias("status"),
        _rest("o_orderkey", 101).cast("int").alias("progress_pct"),
    )


def payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines; some are refunds as negative amounts, some successes of 0.

    The first two lines of an order are paid minutes after it, the others on the
    ship day.
    """
    lines = read(spark, sf_dir, "lineitem")
    orders = read(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), "o_custkey", "o_orderdate"
    )
    price = F.floor("l_extendedprice").cast("bigint")
    refund = (F.col("l_returnflag") == "A") & (F.col("l_tax") == 0.08)
    supplier = _rest("l_suppkey", 50)
    seconds = (F.col("l_quantity") * 12).cast("int")
    soon = F.timestamp_add("SECOND", seconds, F.col("o_orderdate"))
    status = (
        F.when(F.col("l_returnflag") == "R", "refunded")
        .when(supplier == 11, "failed")
        .otherwise("success")
    )
    return lines.join(orders, "l_orderkey").select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("payment_id"),
        F.col("o_custkey").alias("user_id"),
        F.col("l_partkey").alias("course_id"),
        F.when(supplier == 3, -F.col("l_orderkey")).otherwise(F.col("l_orderkey")).alias(
            "enrollment_id"
        ),
        F.when(F.col("l_linenumber") <= 2, soon).otherwise(F.col("l_shipdate")).alias("paid_at"),
        F.when(refund, -price).when(supplier == 7, 0).otherwise(price).alias("amount_rub"),
        price.alias("base_price"),
        F.round(F.col("l_discount") * 100).cast("int").alias("discount_pct"),
        status.alias("status"),
        _pick(_rest("l_linenumber", 3), METHODS).alias("payment_method"),
    )


def payment_attempts(
    spark: SparkSession, sf_dir: str, order_courses: DataFrame | None = None
) -> DataFrame:
    """Events moved before ``AS_OF``, and one success per order for its course."""
    result = F.col("result")
    reason = F.when(result == "failed", "card_declined").when(result == "abandoned", "user_cancelled")
    number = F.col("event_id")
    from_events = read(spark, sf_dir, "events").select(
        (number * 2).alias("attempt_id"),
        F.when(_rest("event_id", 40) == 13, -number).otherwise(F.col("user_id")).alias("user_id"),
        _rest("event_id", 200).alias("course_id"),
        (F.col("ts") - _days(F.lit(EVENT_SHIFT_DAYS))).alias("attempted_at"),
        _coded("event_type", EVENT_RESULT).alias("result"),
    )
    orders = order_courses or _order_courses(spark, sf_dir)
    from_orders = orders.select(
        (F.col("o_orderkey") * 2 + 1).alias("attempt_id"),
        F.col("o_custkey").alias("user_id"),
        F.col("first_part").alias("course_id"),
        F.col("o_orderdate").alias("attempted_at"),
        F.lit("success").alias("result"),
    )
    return from_events.unionByName(from_orders).select(
        "attempt_id",
        "user_id",
        "course_id",
        "attempted_at",
        "result",
        reason.alias("failure_reason"),
        _pick(F.col("attempt_id") % 3, METHODS).alias("payment_method"),
    )


def ad_costs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines per ship day and supplier group; one channel loses spend on each 13th."""
    group = _rest("l_suppkey", 5)
    spend = F.floor(F.col("l_extendedprice") * F.col("l_tax")).cast("bigint")
    lost = (F.dayofmonth("date") == 13) & (F.col("channel") == "telegram")
    return (
        read(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_shipdate").cast("date").alias("date"), group.alias("grp"))
        .agg(
            (F.sum(F.floor("l_quantity").cast("bigint")) * 100).alias("impressions"),
            F.count(F.lit(1)).alias("clicks"),
            F.sum(spend).alias("spend"),
        )
        .withColumn("channel", _pick(F.col("grp"), AD_CHANNELS))
        .select(
            "date",
            "channel",
            "impressions",
            "clicks",
            F.when(lost, 0).otherwise(F.col("spend")).alias("spend_rub"),
        )
    )


def course_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Price step and publication of a course as seen on the days it was sold."""
    sold = F.col("l_shipdate")
    return read(spark, sf_dir, "lineitem").select(
        F.col("l_partkey").alias("course_id"),
        sold.alias("observed_at"),
        (F.floor(F.col("l_discount") * 100 / 4) * 500 + 1000).cast("bigint").alias("price_rub"),
        F.when(F.col("l_returnflag") == "R", 0).otherwise(1).alias("is_published"),
    )


BINDINGS = {
    "users": users,
    "courses": courses,
    "enrollments": enrollments,
    "payments": payments,
    "payment_attempts": payment_attempts,
    "ad_costs": ad_costs,
}


class RawTables(Mapping):
    """The six logical tables of a source, each bound when first asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self._spark, self._sf_dir = spark, sf_dir
        self._bound: dict[str, DataFrame] = {}

    def share_orders(self) -> None:
        """Writes the orders with their courses once, for readers of all six tables.

        Two tables are made of them, each with a pass over all order lines. Frames
        handed out before stay as they are.
        """
        of_orders = ("enrollments", "payment_attempts")
        if not any(table in self._bound for table in of_orders):
            columns = ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "first_part"]
            orders = _order_courses(self._spark, self._sf_dir).select(*columns)
            kept = materialize(orders, "order-courses")
            for table in of_orders:
                self._bound[table] = BINDINGS[table](self._spark, self._sf_dir, kept)

    def __getitem__(self, table: str) -> DataFrame:
        if table not in self._bound:
            self._bound[table] = BINDINGS[table](self._spark, self._sf_dir)
        return self._bound[table]

    def __iter__(self):
        return iter(BINDINGS)

    def __len__(self) -> int:
        return len(BINDINGS)
