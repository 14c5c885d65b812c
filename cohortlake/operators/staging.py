"""Staging layer: rows are kept or dropped, never changed.

Every function returns the columns of its input in their order. Facts meet
users through a shuffle join with one row per user, so no side grows; the size
check for a broadcast and the split of a hot user are left to Spark.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlake import schemas as S
from cohortlake.functions import as_ntz
from cohortlake.operators.keys import key_set


def stage_users(users: DataFrame, as_of) -> DataFrame:
    """Registered by ``as_of``, and the smallest user_id of the e-mail.

    The smallest id is taken over all raw users, so an e-mail whose smallest id
    lies in the future loses every account. Users without e-mail count as one
    e-mail. The group-by combines map-side, which keeps a hot e-mail small; the
    semi join is on the unique user_id.
    """
    first_ids = users.groupBy("email").agg(F.min("user_id").alias("user_id")).select("user_id")
    known = users.filter(F.col("registered_at") <= as_ntz(as_of))
    return known.join(first_ids, "user_id", "left_semi").select(*users.columns)


def stage_courses(courses: DataFrame) -> DataFrame:
    """Published courses; a price of 0 is kept."""
    return courses.filter(F.col("is_published") == 1)


def _since_registration(facts: DataFrame, staged_users: DataFrame, moment: str) -> DataFrame:
    """Facts of staged users not dated before their registration."""
    registered = staged_users.select("user_id", "registered_at")
    joined = facts.join(registered, "user_id")
    return joined.filter(F.col(moment) >= F.col("registered_at")).select(*facts.columns)


def stage_enrollments(
    enrollments: DataFrame, staged_users: DataFrame, staged_courses: DataFrame
) -> DataFrame:
    """Staged user, not before registration, staged course."""
    timely = _since_registration(enrollments, staged_users, "enrolled_at")
    on_sale = staged_courses.select("course_id")
    return timely.join(on_sale, "course_id", "left_semi").select(*enrollments.columns)


def stage_payments(
    payments: DataFrame, staged_users: DataFrame, staged_enrollments: DataFrame
) -> DataFrame:
    """Positive amount, staged user, not before registration, staged enrollment.

    A positive amount already rules out zero-amount successes; refunded and
    failed rows of amount 0 go as well.
    """
    positive = payments.filter(F.col("amount_rub") > 0)
    timely = _since_registration(positive, staged_users, "paid_at")
    enrolled = staged_enrollments.select("enrollment_id")
    return timely.join(enrolled, "enrollment_id", "left_semi").select(*payments.columns)


def stage_payment_attempts(
    attempts: DataFrame, staged_users: DataFrame, staged_payments: DataFrame
) -> DataFrame:
    """Staged user, known result, and for a success a staged payment of any status.

    Successes and the other results are disjoint, so each part needs one semi
    join only: staged payments belong to staged users, hence a success with a
    staged payment has a staged user. A hot pair is reduced to a few keys among
    the payments and can be split among the attempts.
    """
    columns = attempts.columns
    others = [r for r in S.ATTEMPT_RESULTS if r != "success"]
    pair = ["user_id", "course_id"]
    paid_pairs = key_set(staged_payments, pair, "payment_id")
    unpaid = attempts.filter(F.col("result").isin(others))
    paid = attempts.filter(F.col("result") == "success")
    return (
        unpaid.join(staged_users.select("user_id"), "user_id", "left_semi")
        .select(*columns)
        .unionByName(paid.join(paid_pairs, pair, "left_semi").select(*columns))
    )


def stage_ad_costs(ad_costs: DataFrame, as_of) -> DataFrame:
    """Paid channel, dated by ``as_of``, and not free of charge with impressions.

    A row without spend or impressions follows three-valued logic: it stays
    only if the other operand settles the conjunction.
    """
    lost_spend = (F.col("spend_rub") == 0) & (F.col("impressions") > 0)
    return ad_costs.filter(
        ~lost_spend
        & (F.col("date") <= as_ntz(as_of).cast("date"))
        & F.col("channel").isin(S.PAID_CHANNELS)
    )


def stage_all(raw: dict[str, DataFrame], as_of) -> dict[str, DataFrame]:
    """All six staged tables, lazily, in dependency order."""
    users = stage_users(raw["users"], as_of)
    courses = stage_courses(raw["courses"])
    enrollments = stage_enrollments(raw["enrollments"], users, courses)
    payments = stage_payments(raw["payments"], users, enrollments)
    return {
        "users": users,
        "courses": courses,
        "enrollments": enrollments,
        "payments": payments,
        "payment_attempts": stage_payment_attempts(raw["payment_attempts"], users, payments),
        "ad_costs": stage_ad_costs(raw["ad_costs"], as_of),
    }
