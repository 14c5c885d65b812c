"""The five marts over staged tables. ``grain`` is the reporting period."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortlake import schemas as S
from cohortlake.functions import half_up, month_number, period_start, ratio


def _sum_where(condition: Column, value) -> Column:
    return F.sum(F.when(condition, F.col(value)).otherwise(F.lit(0)))


def successful(payments: DataFrame) -> DataFrame:
    return payments.filter(F.col("status") == "success")


def revenue_by_period(payments: DataFrame, courses: DataFrame, grain: str = "month") -> DataFrame:
    """Successful payments of published courses per period, without the trend columns."""
    product = F.col("course_type")
    sold = (
        successful(payments)
        .select("payment_id", "user_id", "course_id", "amount_rub", "discount_pct", "paid_at")
        .join(courses.select("course_id", "course_type"), "course_id")
        .withColumn("payment_month", period_start("paid_at", grain))
    )
    return sold.groupBy("payment_month").agg(
        F.countDistinct("user_id").alias("paying_users"),
        F.count("payment_id").alias("transactions"),
        F.sum("amount_rub").alias("revenue"),
        ratio(F.sum("amount_rub"), F.count("amount_rub"), 0).alias("avg_check"),
        ratio(F.sum("amount_rub"), F.countDistinct("user_id"), 0).alias("arpu"),
        _sum_where(product == S.SUBSCRIPTION, "amount_rub").alias("mrr"),
        ratio(F.count_if(F.col("discount_pct") > 0), F.count("payment_id"), 1, 100).alias(
            "discount_rate_pct"
        ),
        _sum_where(product == S.COURSE, "amount_rub").alias("revenue_courses"),
        _sum_where(product == S.INTENSIVE, "amount_rub").alias("revenue_intensive"),
        _sum_where(product == S.SUBSCRIPTION, "amount_rub").alias("revenue_subscription"),
    )


def with_trend(periods: DataFrame, period: str, value: str, prev: str, change: str) -> DataFrame:
    """Previous present period of ``value`` and the change against it in percent.

    The window has no partition: it runs on one row per period, after the
    aggregate.
    """
    in_order = Window.orderBy(period)
    earlier = F.lag(value).over(in_order)
    return periods.withColumn(prev, earlier).withColumn(
        change, ratio(F.col(value) - F.col(prev), F.col(prev), 1, 100)
    )


def mart_revenue(payments: DataFrame, courses: DataFrame, grain: str = "month") -> DataFrame:
    """Revenue per period with change and running total."""
    return revenue_trend(revenue_by_period(payments, courses, grain))


def revenue_trend(periods: DataFrame) -> DataFrame:
    """Change and running total over revenue periods."""
    trend = with_trend(
        periods, "payment_month", "revenue", "revenue_prev_month", "revenue_mom_pct"
    )
    total = F.sum("revenue").over(Window.orderBy("payment_month"))
    return trend.withColumn("revenue_cumulative", total).orderBy("payment_month")


def _ad_ratios(df: DataFrame) -> DataFrame:
    """Click, cost and return ratios from the summed ad columns."""
    spend = F.col("spend")
    return df.withColumns(
        {
            "ctr_pct": ratio(F.col("clicks"), F.col("impressions"), 2, 100),
            "cpc": ratio(spend, F.col("clicks"), 0),
            "cpm": ratio(spend, F.col("impressions"), 0, 1000),
            "cac": ratio(spend, F.col("paying_users"), 0),
            "roas": ratio(F.col("revenue_from_channel"), spend, 2),
        }
    )


def ad_performance(
    ad_costs: DataFrame, new_users: DataFrame, users: DataFrame, payments: DataFrame, period
) -> DataFrame:
    """Channel results per period; ``period`` maps a date column to its period.

    ``new_users`` are the users whose registrations count, ``users`` those whose
    payments do.

    Periods and channels without ad rows are not shown. Payments are summed to
    one row per period and user before they meet users, so the join carries no
    hot user and a payer needs no distinct count.
    """
    keys = ["month", "channel"]
    ads = ad_costs.groupBy(period("date").alias("month"), "channel").agg(
        F.sum("spend_rub").alias("spend"),
        F.sum("impressions").alias("impressions"),
        F.sum("clicks").alias("clicks"),
    )
    paid_users = users.filter(F.col("channel").isin(S.PAID_CHANNELS))
    registered = new_users.groupBy(period("registered_at").alias("month"), "channel").agg(
        F.count("user_id").alias("registrations")
    )
    per_payer = (
        successful(payments)
        .groupBy(period("paid_at").alias("month"), "user_id")
        .agg(F.sum("amount_rub").alias("paid_rub"))
    )
    payers = (
        per_payer.join(paid_users.select("user_id", "channel"), "user_id")
        .groupBy(keys)
        .agg(
            F.countDistinct("user_id").alias("paying_users"),
            F.sum("paid_rub").alias("revenue_from_channel"),
        )
    )
    filled = (
        ads.join(registered, keys, "left")
        .join(payers, keys, "left")
        .na.fill(0, ["registrations", "paying_users", "revenue_from_channel"])
    )
    return _ad_ratios(filled)


def mart_ad_performance(
    ad_costs: DataFrame, users: DataFrame, payments: DataFrame, grain: str = "month"
) -> DataFrame:
    """Channel results per calendar period."""
    results = ad_performance(ad_costs, users, users, payments, lambda c: period_start(c, grain))
    return results.orderBy("month", "channel")


def activity_pairs(enrollments: DataFrame) -> DataFrame:
    """Users per month of their first enrollment and month of activity.

    Enrollments are reduced to one row per user and month first. A cohort is
    the smallest of these months, and users of a pair of months are plain rows.
    """
    active = (
        enrollments.filter(F.col("user_id").isNotNull())
        .select("user_id", period_start("enrolled_at").alias("activity_month"))
        .distinct()
    )
    of_user = Window.partitionBy("user_id")
    cohorts = active.withColumn("cohort_month", F.min("activity_month").over(of_user))
    return cohorts.groupBy("cohort_month", "activity_month").agg(
        F.count(F.lit(1)).alias("retained_users")
    )


def mart_activity(enrollments: DataFrame) -> DataFrame:
    """Retention by month since the first enrollment."""
    return retention(activity_pairs(enrollments))


def retention(pairs: DataFrame) -> DataFrame:
    """Retention rates of the users of each pair of months."""
    number = month_number(F.col("cohort_month"), F.col("activity_month"))
    size = F.max(F.when(F.col("month_number") == 0, F.col("retained_users"))).over(
        Window.partitionBy("cohort_month")
    )
    return (
        pairs.withColumn("month_number", number)
        .withColumn("cohort_size", size)
        .select(
            "cohort_month",
            "month_number",
            "cohort_size",
            "retained_users",
            ratio(F.col("retained_users"), F.col("cohort_size"), 1, 100).alias(
                "retention_rate_pct"
            ),
        )
        .orderBy("cohort_month", "month_number")
    )


def course_counts(enrollments: DataFrame) -> DataFrame:
    """Enrollment counts by status, and the progress of active ones, per course."""
    status = F.col("status")
    progress = F.when(status == "active", F.col("progress_pct"))
    return enrollments.groupBy("course_id").agg(
        F.count("enrollment_id").alias("total_enrollments"),
        F.count_if(status == "completed").alias("completed"),
        F.count_if(status == "active").alias("active"),
        F.count_if(status == "dropped").alias("dropped"),
        F.sum(progress).alias("_progress"),
        F.count(progress).alias("_with_progress"),
    )


def completion_counts(enrollments: DataFrame, courses: DataFrame, keys: list[str]) -> DataFrame:
    """Enrollment counts by status per course attributes.

    Summed per course before the join, so a hot course is one row by then.
    """
    return _by_attributes(course_counts(enrollments), courses, keys)


def _by_attributes(per_course: DataFrame, courses: DataFrame, keys: list[str]) -> DataFrame:
    counts = ["total_enrollments", "completed", "active", "dropped"]
    return (
        per_course.join(courses.select("course_id", *keys), "course_id")
        .groupBy(*keys)
        .agg(*[F.sum(c).alias(c) for c in counts + ["_progress", "_with_progress"]])
    )


def mart_completion(enrollments: DataFrame, courses: DataFrame) -> DataFrame:
    """Completion and dropout by subject, level and product type."""
    return completion_rates(course_counts(enrollments), courses)


def completion_rates(per_course: DataFrame, courses: DataFrame) -> DataFrame:
    """Completion and dropout from the counts of each course."""
    keys = ["subject", "level", "course_type"]
    total = F.col("total_enrollments")
    return (
        _by_attributes(per_course, courses, keys)
        .select(
            *keys,
            "total_enrollments",
            "completed",
            "active",
            "dropped",
            ratio(F.col("completed"), total, 1, 100).alias("completion_rate_pct"),
            ratio(F.col("dropped"), total, 1, 100).alias("dropout_rate_pct"),
            ratio(F.col("_progress"), F.col("_with_progress"), 1).alias("avg_progress_active"),
        )
        .orderBy(F.desc_nulls_last("completion_rate_pct"), *keys)
    )


def funnel_counts(
    users: DataFrame,
    enrollments: DataFrame,
    payments: DataFrame,
    attempts: DataFrame,
    grain: str = "month",
) -> DataFrame:
    """Users at each step of the funnel per registration period.

    Each fact is reduced to one row per user, so the four joins are between
    unique keys and one group-by counts every step.
    """
    learned = enrollments.groupBy("user_id").agg(
        F.lit(1).alias("has_enrolled"),
        F.max(F.when(F.col("status") == "completed", 1).otherwise(0)).alias("has_completed"),
    )
    bought = successful(payments).groupBy("user_id").agg(F.lit(1).alias("has_paid"))
    tried = attempts.groupBy("user_id").agg(
        F.count("attempt_id").alias("tries"),
        F.count_if(F.col("result") == "abandoned").alias("gave_up"),
    )
    steps = (
        users.select("user_id", period_start("registered_at", grain).alias("cohort_month"))
        .join(learned, "user_id", "left")
        .join(bought, "user_id", "left")
        .join(tried, "user_id", "left")
    )

    def total(name):
        return F.sum(F.coalesce(F.col(name).cast("bigint"), F.lit(0)))

    return steps.groupBy("cohort_month").agg(
        F.count("user_id").alias("registered"),
        total("has_enrolled").alias("enrolled"),
        total("has_paid").alias("paid"),
        total("has_completed").alias("completed"),
        total("tries").alias("payment_attempts_total"),
        total("gave_up").alias("payment_attempts_abandoned"),
    )


def mart_conversion(
    users: DataFrame,
    enrollments: DataFrame,
    payments: DataFrame,
    attempts: DataFrame,
    grain: str = "month",
) -> DataFrame:
    """Registration funnel per registration period."""
    return conversion_rates(funnel_counts(users, enrollments, payments, attempts, grain))


def conversion_rates(counts: DataFrame) -> DataFrame:
    """Rates between the steps of the funnel."""

    def rate(part, whole, digits=1):
        return ratio(F.col(part), F.col(whole), digits, 100)

    return counts.select(
        "cohort_month",
        "registered",
        "enrolled",
        "paid",
        "completed",
        rate("enrolled", "registered").alias("cvr_reg_to_enroll_pct"),
        rate("paid", "enrolled").alias("cvr_enroll_to_paid_pct"),
        rate("completed", "paid").alias("cvr_paid_to_completed_pct"),
        rate("paid", "registered", 2).alias("overall_cvr_pct"),
        "payment_attempts_total",
        "payment_attempts_abandoned",
        rate("payment_attempts_abandoned", "payment_attempts_total").alias("payment_dropoff_pct"),
    ).orderBy("cohort_month")
