"""Corrections beside the staging rules: flags, quarantine, refunds, time zones.

A flag is 1 where its rule holds and 0 otherwise, also where a value is missing.
"""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlake import schemas as S
from cohortlake.functions import as_ntz, period_start


def flag_users(users: DataFrame, as_of) -> DataFrame:
    """``is_duplicate``: not the smallest id of its e-mail; ``is_test``: registered later."""
    first = (
        users.groupBy("email")
        .agg(F.min("user_id").alias("user_id"))
        .select("user_id", F.lit(True).alias("_first"))
    )
    return (
        users.join(first, "user_id", "left")
        .select(
            *users.columns,
            F.col("_first").isNull().cast("int").alias("is_duplicate"),
            F.coalesce((F.col("registered_at") > as_ntz(as_of)).cast("int"), F.lit(0)).alias(
                "is_test"
            ),
        )
    )


def flag_courses(courses: DataFrame) -> DataFrame:
    """``is_free``: price 0."""
    free = F.coalesce((F.col("price_rub") == 0).cast("int"), F.lit(0))
    return courses.withColumn("is_free", free)


def flag_attempts(attempts: DataFrame, users: DataFrame) -> DataFrame:
    """``is_guest``: the user is unknown. Attempts without a user are guests.

    Users are unique, so one left join marks the members; its left side can be split
    under a hot user.
    """
    members = users.select(F.col("user_id").alias("_member"))
    marked = attempts.join(members, F.col("user_id") == F.col("_member"), "left")
    return marked.select(*attempts.columns, F.col("_member").isNull().cast("int").alias("is_guest"))


def flag_ad_costs(ad_costs: DataFrame) -> DataFrame:
    """``data_quality_issue``: impressions without spend."""
    lost = (F.col("spend_rub") == 0) & (F.col("impressions") > 0)
    return ad_costs.withColumn("data_quality_issue", F.coalesce(lost.cast("int"), F.lit(0)))


def quarantine(raw: DataFrame, staged: DataFrame, row_id: str) -> DataFrame:
    """Raw rows staging left out."""
    return raw.join(staged.select(row_id), row_id, "left_anti").select(*raw.columns)


def split_refunds(payments: DataFrame) -> DataFrame:
    """Payments and refunds as positive transactions.

    A negative amount is a refund; a successful positive one a payment. Failed,
    refunded and zero rows move no money and are left out.
    """
    amount = F.col("amount_rub")
    kind = F.when(amount < 0, "refund").when(
        (amount > 0) & (F.col("status") == "success"), "payment"
    )
    return (
        payments.withColumn("transaction_type", kind)
        .filter(F.col("transaction_type").isNotNull())
        .withColumn("amount_rub", F.abs("amount_rub"))
    )


def net_revenue(payments: DataFrame, grain: str = "month") -> DataFrame:
    """Revenue, refunds and their difference per period."""
    amount, kind = F.col("amount_rub"), F.col("transaction_type")

    def total(name):
        return F.coalesce(F.sum(F.when(kind == name, amount)), F.lit(0))

    sums = split_refunds(payments).groupBy(period_start("paid_at", grain).alias("period")).agg(
        total("payment").alias("revenue"), total("refund").alias("refunds")
    )
    return sums.withColumn("net_revenue", F.col("revenue") - F.col("refunds"))


def to_utc(df: DataFrame, columns: list[str], zone: str) -> DataFrame:
    """Local times of ``zone`` to UTC."""
    moved = {c: F.convert_timezone(F.lit(zone), F.lit("UTC"), F.col(c)) for c in columns}
    return df.withColumns(moved)


def unknown_values(df: DataFrame, domains: dict[str, list[str]]) -> DataFrame:
    """Values outside a column's domain with their counts; NULL counts as outside."""
    def outside(column) -> Column:
        return F.coalesce(~F.col(column).isin(domains[column]), F.lit(True))

    parts = [
        df.filter(outside(c))
        .groupBy(F.lit(c).alias("column_name"), F.col(c).alias("value"))
        .agg(F.count(F.lit(1)).alias("n"))
        for c in domains
    ]
    return reduce(DataFrame.unionByName, parts)


DOMAINS = {
    "users": {"channel": S.CHANNELS},
    "enrollments": {"status": S.ENROLLMENT_STATUSES},
    "payments": {"status": S.PAYMENT_STATUSES},
    "payment_attempts": {"result": S.ATTEMPT_RESULTS},
    "ad_costs": {"channel": S.PAID_CHANNELS},
}
