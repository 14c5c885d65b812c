"""Reports over staged tables: finance, advertising, product, curators, operations."""

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortlake.functions import as_ntz, half_up, period_start, ratio
from cohortlake.operators.corrections import split_refunds
from cohortlake.plans.marts import (
    ad_performance,
    completion_counts,
    course_counts,
    mart_ad_performance,
    mart_revenue,
    successful,
    with_trend,
)
from cohortlake.sources.layers import materialize


def _day(as_of) -> Column:
    return as_ntz(as_of).cast("date")


# Finance


def lifetime_value(payments: DataFrame) -> DataFrame:
    """Total revenue and number of payments of every paying user."""
    return (
        successful(payments)
        .groupBy("user_id")
        .agg(F.sum("amount_rub").alias("ltv_rub"), F.count(F.lit(1)).alias("transactions"))
    )


def revenue_by(
    payments: DataFrame, courses: DataFrame, keys: list[str], grain: str = "month"
) -> DataFrame:
    """Revenue per period and course attributes, summed per course before the join."""
    per_course = (
        successful(payments)
        .groupBy(period_start("paid_at", grain).alias("period"), "course_id")
        .agg(F.sum("amount_rub").alias("revenue"))
    )
    attributes = courses.select("course_id", *[k for k in keys if k != "course_id"])
    return (
        per_course.join(attributes, "course_id")
        .groupBy("period", *keys)
        .agg(F.sum("revenue").alias("revenue"))
    )


def top_subjects(payments: DataFrame, courses: DataFrame, top: int = 5) -> DataFrame:
    """Subjects with the highest revenue of each month; ties share a place."""
    in_month = Window.partitionBy("period").orderBy(F.desc("revenue"))
    ranked = revenue_by(payments, courses, ["subject"]).withColumn("place", F.rank().over(in_month))
    return ranked.filter(F.col("place") <= top)


def revenue_year_to_date(payments: DataFrame, courses: DataFrame) -> DataFrame:
    """Monthly revenue with its running total within the year."""
    in_year = Window.partitionBy("year").orderBy("period")
    return (
        revenue_by(payments, courses, [])
        .withColumn("year", F.year("period"))
        .withColumn("revenue_ytd", F.sum("revenue").over(in_year))
    )


def weekly_revenue(payments: DataFrame, courses: DataFrame, fall_pct: int = 20) -> DataFrame:
    """Weekly revenue against the previous week, flagged when it falls by more than ``fall_pct``."""
    weeks = revenue_by(payments, courses, [], "week").withColumnRenamed("period", "week")
    trend = with_trend(weeks, "week", "revenue", "revenue_prev_week", "revenue_wow_pct")
    fallen = F.col("revenue") * 100 < F.col("revenue_prev_week") * (100 - fall_pct)
    return trend.withColumn("is_anomaly", F.coalesce(fallen, F.lit(False)))


def new_payers(payments: DataFrame, grain: str = "week") -> DataFrame:
    """Users by the period of their first successful payment."""
    first = successful(payments).groupBy("user_id").agg(F.min("paid_at").alias("first_paid_at"))
    return first.groupBy(period_start("first_paid_at", grain).alias("period")).agg(
        F.count(F.lit(1)).alias("new_paying_users")
    )


def top_products(
    payments: DataFrame, courses: DataFrame, top: int = 3, grain: str = "week"
) -> DataFrame:
    """Courses with the highest revenue of each period, ties by course_id."""
    in_period = Window.partitionBy("period").orderBy(F.desc("revenue"), "course_id")
    per_course = revenue_by(payments, courses, ["course_id", "title"], grain)
    ranked = per_course.withColumn("place", F.row_number().over(in_period))
    return ranked.filter(F.col("place") <= top)


def last_months(payments: DataFrame, courses: DataFrame, as_of, months: int = 6) -> DataFrame:
    """Key metrics of the last full months before the month of ``as_of``."""
    current = F.trunc(_day(as_of), "month")
    month = F.col("payment_month")
    return (
        mart_revenue(payments, courses)
        .filter((month >= F.add_months(current, -months)) & (month < current))
        .select("payment_month", "revenue", "mrr", "arpu", "avg_check", "revenue_mom_pct")
    )


def revenue_structure(payments: DataFrame, courses: DataFrame) -> DataFrame:
    """Monthly revenue by product and subject with totals per product and month, and shares.

    ``detail`` is 0 for a subject row, 1 for a product total, 3 for the month.
    """
    of_month = F.max(F.when(F.col("detail") == 3, F.col("revenue"))).over(
        Window.partitionBy("period")
    )
    product = ["period", "course_type"]
    return (
        revenue_by(payments, courses, ["course_type", "subject"])
        .groupingSets(
            [[*product, "subject"], product, ["period"]], "period", "course_type", "subject"
        )
        .agg(F.sum("revenue").alias("revenue"), F.grouping_id().alias("detail"))
        .withColumn("share_pct", ratio(F.col("revenue"), of_month, 1, 100))
    )


# Advertising


def registrations_by_channel(users: DataFrame, grain: str = "month") -> DataFrame:
    """New users per period and channel, every channel; no channel is 'unknown'."""
    return users.groupBy(
        period_start("registered_at", grain).alias("period"),
        F.coalesce("channel", F.lit("unknown")).alias("channel"),
    ).agg(F.count("user_id").alias("registrations"))


def weekly_channels(
    ad_costs: DataFrame,
    users: DataFrame,
    payments: DataFrame,
    cac_jump_pct: int = 50,
    registrations_fall_pct: int = 30,
) -> DataFrame:
    """Weekly channel results beside the channel's previous week, with flags."""
    in_channel = Window.partitionBy("channel").orderBy("week")
    weeks = mart_ad_performance(ad_costs, users, payments, "week").withColumnRenamed("month", "week")
    compared = weeks.withColumns(
        {f"{c}_prev": F.lag(c).over(in_channel) for c in ("spend", "registrations", "cac")}
    )
    jumped = F.col("cac") * 100 > F.col("cac_prev") * (100 + cac_jump_pct)
    fell = F.col("registrations") * 100 < F.col("registrations_prev") * (
        100 - registrations_fall_pct
    )
    return compared.withColumns(
        {
            "cac_jump": F.coalesce(jumped, F.lit(False)),
            "registrations_fall": F.coalesce(fell, F.lit(False)),
        }
    )


def channel_summary(
    ad_costs: DataFrame, users: DataFrame, payments: DataFrame, start, end
) -> DataFrame:
    """Channel results over ``[start, end)``: sums and distinct payers first, then ratios."""

    def within(df, column):
        moment = F.col(column)
        low, high = as_ntz(start), as_ntz(end)
        if dict(df.dtypes)[column] == "date":
            low, high = low.cast("date"), high.cast("date")
        return df.filter((moment >= low) & (moment < high))

    return ad_performance(
        within(ad_costs, "date"),
        within(users, "registered_at"),
        users,
        within(payments, "paid_at"),
        lambda _: _day(start),
    ).withColumnRenamed("month", "period_start")


# Product


def active_users(enrollments: DataFrame) -> DataFrame:
    """Users active per day, week and month, by enrollments.

    Weeks and months are counted from the distinct users of each day.
    """
    days = enrollments.select("user_id", period_start("enrolled_at", "day").alias("period")).distinct()

    def counted(users, grain):
        sizes = users.groupBy("period").agg(F.count("user_id").alias("active_users"))
        return sizes.select(F.lit(grain).alias("grain"), "period", "active_users")

    longer = [
        counted(days.select("user_id", period_start("period", g).alias("period")).distinct(), g)
        for g in ("week", "month")
    ]
    return reduce(DataFrame.unionByName, longer, counted(days, "day"))


def cohort_matrix(activity: DataFrame, months: int = 7) -> DataFrame:
    """Retention rates of the first months as columns ``m0, m1, ...``, one row per cohort."""
    number = F.col("month_number")
    rates = [
        F.max(F.when(number == m, F.col("retention_rate_pct"))).alias(f"m{m}") for m in range(months)
    ]
    return activity.groupBy("cohort_month").agg(F.max("cohort_size").alias("cohort_size"), *rates)


def dropout_histogram(enrollments: DataFrame, width: int = 10) -> DataFrame:
    """Dropped enrollments by progress in steps of ``width`` percent."""
    bucket = F.floor(F.col("progress_pct") / F.lit(width)) * width
    dropped = enrollments.filter(F.col("status") == "dropped")
    counts = dropped.groupBy(bucket.cast("int").alias("progress_from")).agg(
        F.count(F.lit(1)).alias("dropped")
    )
    everything = F.sum("dropped").over(Window.partitionBy())
    return counts.withColumn("share_pct", ratio(F.col("dropped"), everything, 1, 100))


def low_completion(enrollments: DataFrame, courses: DataFrame, z_score: float = 1.0) -> DataFrame:
    """Subjects with their completion rate, flagged ``z_score`` deviations below the mean."""
    rates = completion_counts(enrollments, courses, ["subject"]).select(
        "subject",
        "total_enrollments",
        "completed",
        ratio(F.col("completed"), F.col("total_enrollments"), 2, 100).alias("completion_rate_pct"),
    )
    everything = Window.partitionBy()
    rate = F.col("completion_rate_pct")
    mean, spread = F.avg(rate).over(everything), F.stddev_samp(rate).over(everything)
    score = half_up((rate - mean) / F.nullif(spread, F.lit(0.0)), 3)
    return rates.withColumn("z_score", score).withColumn(
        "is_low", F.coalesce(F.col("z_score") < F.lit(-float(z_score)), F.lit(False))
    )


def course_completion(enrollments: DataFrame, courses: DataFrame) -> DataFrame:
    """Completion and dropout of each course with enrollments, beside its subject's completion."""
    total = F.col("total_enrollments")
    per_course = course_counts(enrollments).join(
        courses.select("course_id", "title", "subject", "level"), "course_id"
    )
    subjects = (
        per_course.groupBy("subject")
        .agg(F.sum("completed").alias("_completed"), F.sum("total_enrollments").alias("_total"))
        .withColumnRenamed("subject", "_subject")
    )
    rate = ratio(F.col("completed"), total, 1, 100)
    of_subject = ratio(F.col("_completed"), F.col("_total"), 1, 100)
    met = per_course.join(subjects, F.col("subject").eqNullSafe(F.col("_subject")))
    return met.select(
        "course_id",
        "title",
        "subject",
        "level",
        "total_enrollments",
        "completed",
        "dropped",
        rate.alias("completion_rate_pct"),
        ratio(F.col("dropped"), total, 1, 100).alias("dropout_rate_pct"),
        of_subject.alias("subject_rate_pct"),
        half_up(rate - of_subject, 1).alias("above_subject_pct"),
    )


def refund_rate(payments: DataFrame, grain: str = "month") -> DataFrame:
    """Payments and refunds per period, and refunds in percent of payments by number and sum.

    Of raw payments: staging leaves refunds out.
    """
    amount, refund = F.col("amount_rub"), F.col("transaction_type") == "refund"
    sums = split_refunds(payments).groupBy(period_start("paid_at", grain).alias("period")).agg(
        F.count_if(~refund).alias("payments"),
        F.count_if(refund).alias("refunds"),
        F.coalesce(F.sum(F.when(~refund, amount)), F.lit(0)).alias("paid_rub"),
        F.coalesce(F.sum(F.when(refund, amount)), F.lit(0)).alias("refunded_rub"),
    )
    return sums.withColumns(
        {
            "refund_rate_pct": ratio(F.col("refunds"), F.col("payments"), 1, 100),
            "refunded_share_pct": ratio(F.col("refunded_rub"), F.col("paid_rub"), 1, 100),
        }
    )


def payment_dropoff(attempts: DataFrame, users: DataFrame, grain: str = "month") -> DataFrame:
    """Attempts and abandoned ones per period, of members and of guests apart, and of all.

    Attempts are counted per user and period before they meet the users, so a hot
    user, or the attempts without one, are a row per period.
    """
    per_user = attempts.groupBy(
        "user_id", period_start("attempted_at", grain).alias("period")
    ).agg(
        F.count(F.lit(1)).alias("tries"),
        F.count_if(F.col("result") == "abandoned").alias("gave_up"),
    )
    members = users.select(F.col("user_id").alias("_member"))
    marked = per_user.join(members, F.col("user_id") == F.col("_member"), "left")
    guest = F.col("_member").isNull()

    def total(name, condition):
        return F.coalesce(F.sum(F.when(condition, F.col(name))), F.lit(0))

    sums = marked.groupBy("period").agg(
        total("tries", ~guest).alias("member_attempts"),
        total("gave_up", ~guest).alias("member_abandoned"),
        total("tries", guest).alias("guest_attempts"),
        total("gave_up", guest).alias("guest_abandoned"),
    )

    def rate(*kinds):
        tries, gave_up = (
            sum((F.col(f"{k}_{what}") for k in kinds), F.lit(0)) for what in ("attempts", "abandoned")
        )
        return ratio(gave_up, tries, 1, 100)

    return sums.withColumns(
        {
            "member_dropoff_pct": rate("member"),
            "guest_dropoff_pct": rate("guest"),
            "dropoff_pct": rate("member", "guest"),
        }
    )


# Curators


def last_activity(users: DataFrame, enrollments: DataFrame) -> DataFrame:
    """E-mail and last enrollment of every user with one, written once.

    Reading it back makes the join with the enrollments shuffle both sides, so
    adaptive execution can split the enrollments of a hot user. Reports on the same
    layer can share it.
    """
    last = enrollments.groupBy("user_id").agg(F.max("enrolled_at").alias("last_activity"))
    return materialize(users.select("user_id", "email").join(last, "user_id"), "last-activity")


def _active_with_idle(
    users: DataFrame, enrollments: DataFrame, courses: DataFrame, as_of, last: DataFrame | None
) -> DataFrame:
    active = enrollments.filter(F.col("status") == "active")
    if last is None:
        last = last_activity(users, enrollments)
    return (
        active.join(last, "user_id")
        .join(courses.select("course_id", "title"), "course_id")
        .withColumn("days_idle", F.date_diff(_day(as_of), F.col("last_activity").cast("date")))
    )


_STUDENT = [
    "user_id", "email", "enrollment_id", "title", "progress_pct", "status", "enrolled_at",
    "last_activity", "days_idle",
]


def active_students(
    users: DataFrame,
    enrollments: DataFrame,
    courses: DataFrame,
    as_of,
    last: DataFrame | None = None,
) -> DataFrame:
    """Active enrollments with the student's last activity and idle days.

    ``last`` is the layer's ``last_activity``, if it is stored already.
    """
    return _active_with_idle(users, enrollments, courses, as_of, last).select(*_STUDENT)


def _at_risk(active: DataFrame, as_of, idle_days: int, low_progress: int, old_days: int) -> DataFrame:
    idle = F.col("days_idle") > idle_days
    age = F.date_diff(_day(as_of), F.col("enrolled_at").cast("date"))
    slow = (F.col("progress_pct") < low_progress) & (age > old_days)
    return (
        active.filter(idle | slow)
        .withColumn("is_idle", idle)
        .withColumn("is_slow", F.coalesce(slow, F.lit(False)))
    )


def at_risk_students(
    users: DataFrame,
    enrollments: DataFrame,
    courses: DataFrame,
    as_of,
    idle_days: int = 7,
    low_progress: int = 20,
    old_days: int = 30,
    last: DataFrame | None = None,
) -> DataFrame:
    """Active enrollments idle for long, or old with little progress; longest idle first."""
    active = active_students(users, enrollments, courses, as_of, last)
    at_risk = _at_risk(active, as_of, idle_days, low_progress, old_days)
    return at_risk.orderBy(F.desc("days_idle"), "enrollment_id")


# Operations


def operations_counters(
    users: DataFrame,
    enrollments: DataFrame,
    courses: DataFrame,
    payments: DataFrame,
    attempts: DataFrame,
    as_of,
    last: DataFrame | None = None,
) -> DataFrame:
    """Counters of the day, week and month of ``as_of`` as ``metric, value`` rows.

    The periods are plain dates, so each table is filtered by them at the scan.
    """
    today = dt.datetime.fromisoformat(str(as_of)).date()
    tomorrow = today + dt.timedelta(days=1)
    starts = {
        "day": today,
        "week": today - dt.timedelta(days=today.weekday()),
        "month": today.replace(day=1),
    }

    def since(df, column, start):
        return df.filter((F.col(column) >= as_ntz(start)) & (F.col(column) < as_ntz(tomorrow)))

    def rows(df, metrics):
        """One pass over ``df``: its aggregates as metric rows."""
        one = df.agg(*[value.alias(name) for name, value in metrics.items()])
        pairs = [
            F.struct(F.lit(n).alias("metric"), F.col(n).cast("double").alias("value"))
            for n in metrics
        ]
        return one.select(F.inline(F.array(*pairs)))

    def per_span(df, column, prefix):
        recent = since(df, column, min(starts.values()))
        return rows(
            recent,
            {
                f"{prefix}_{span}": F.count_if(F.col(column) >= as_ntz(start))
                for span, start in starts.items()
            },
        )

    active = active_students(users, enrollments, courses, as_of, last)
    gave_up = F.count_if(F.col("result") == "abandoned")
    parts = [
        per_span(users, "registered_at", "registrations"),
        per_span(enrollments, "enrolled_at", "enrollments"),
        rows(
            since(successful(payments), "paid_at", today),
            {
                "payments_day": F.count(F.lit(1)),
                "payments_day_rub": F.coalesce(F.sum("amount_rub"), F.lit(0)),
            },
        ),
        rows(
            since(attempts, "attempted_at", today - dt.timedelta(days=6)),
            {"dropoff_7d_pct": ratio(gave_up, F.count(F.lit(1)), 1, 100)},
        ),
        rows(
            _at_risk(active, as_of, 7, 20, 30),
            {"students_at_risk": F.countDistinct("user_id")},
        ),
    ]
    return reduce(DataFrame.unionByName, parts)


def daily_payments(payments: DataFrame) -> DataFrame:
    """Successful payments per day: number and sum."""
    return (
        successful(payments)
        .groupBy(period_start("paid_at", "day").alias("day"))
        .agg(F.count(F.lit(1)).alias("payments"), F.sum("amount_rub").alias("amount_rub"))
    )
