"""Data-quality checks A1-A20 and rules X1-X6 on any layer.

A suite yields one row per check. Row-level checks of a table are counted in one
pass; where a table refers to another, its rows are first summed per key, so the
joins carry one row per key whatever the skew. Only A6, A12 and X4 compare row
with row and stay plain joins on a unique right side.
"""

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlake import schemas as S
from cohortlake.functions import as_ntz, half_up, period_start
from cohortlake.operators.keys import count_orphans, rows_per_key

CRITICAL, WARNING, INFO = "CRITICAL", "WARNING", "INFO"
# Fixed value: a side effect of cleaning, left out of the adjusted totals.
SECONDARY = ["A16"]

# Codes, tables and severities. The texts say what a rule tests and a next step.
# code: (table, severity, description, fix hint)
CHECKS = {
    "A1": ("users", WARNING,
           "Shared e-mail — e-mail value held by two or more user rows",
           "merge the accounts, keep the smallest id"),
    "A2": ("users", WARNING,
           "Future registration — registered_at lies past the as-of time",
           "exclude until that time comes"),
    "A3": ("users", INFO,
           "Empty channel — channel is empty",
           "ask the sign-up form for it"),
    "A4": ("courses", WARNING,
           "Zero price — price_rub equals 0",
           "confirm with the course owner"),
    "A5": ("courses", INFO,
           "Unpublished — is_published equals 0",
           "filter on publication"),
    "A6": ("enrollments+users", CRITICAL,
           "Enrolled before registration — enrolled_at precedes registered_at of the same user",
           "compare the clocks of both sources"),
    "A7": ("enrollments", CRITICAL,
           "Foreign status — status lies outside its domain",
           "extend the domain or mend the writer"),
    "A8": ("enrollments", WARNING,
           "Full progress, other status — progress_pct is 100 while status differs from completed",
           "derive one from the other"),
    "A9": ("enrollments→courses", CRITICAL,
           "Course row absent — course_id has no course row",
           "reload courses first"),
    "A10": ("payments", CRITICAL,
           "Amount below zero — amount_rub is below 0",
           "move such rows to refunds"),
    "A11": ("payments", CRITICAL,
           "Success worth nothing — status is success while amount_rub is 0",
           "read the gateway log of the payment"),
    "A12": ("payments+users", CRITICAL,
           "Paid before registration — paid_at precedes registered_at of the same user",
           "compare the clocks of both sources"),
    "A13": ("payments+courses", WARNING,
           "Charge for a zero-price course — amount_rub is positive for a course with price_rub 0",
           "look up the course price at that time"),
    "A14": ("payments→enrollments", CRITICAL,
           "Enrollment row absent — enrollment_id has no enrollment row",
           "reload enrollments first"),
    "A15": ("payment_attempts→users", WARNING,
           "User row absent — user_id has no user row",
           "count per attempt, not per user"),
    "A16": ("payment_attempts→payments", CRITICAL,
           "Success lacks payment row — result is success, but user and course have no payment row",
           "match with the bank statement"),
    "A17": ("payment_attempts", CRITICAL,
           "Foreign result — result lies outside its domain",
           "extend the domain or mend the writer"),
    "A18": ("ad_costs", WARNING,
           "Impressions lack spend — spend_rub is 0 or empty while impressions are positive",
           "request the cost export anew"),
    "A19": ("ad_costs", WARNING,
           "Future ad day — date lies past the as-of day",
           "exclude until that day comes"),
    "A20": ("ad_costs", INFO,
           "Unpaid channel — channel is outside the paid channels",
           "map the channel name"),
}

RULES = {
    "X1": ("enrollments→users", CRITICAL, "Enrollment of an unknown user", "Add a foreign key"),
    "X2": ("payments→users", CRITICAL, "Payment of an unknown user", "Add a foreign key"),
    "X3": ("payments→courses", CRITICAL, "Payment for an unknown course", "Add a foreign key"),
    "X4": ("payments+enrollments", CRITICAL, "Paid before the enrollment", "Check the load"),
    "X5": ("payment_attempts→payments", WARNING,
           "Successful attempt whose user and course have not exactly one payment",
           "Compare with the gateway ledger"),
}

RESULT_SCHEMA = (
    "code string, table_name string, severity string, n bigint, description string, fix_hint string"
)


def _count(condition: Column) -> Column:
    return F.count_if(condition)


def _outside(column: str, domain: list[str]) -> Column:
    """Not in the domain; NULL is outside."""
    return F.coalesce(~F.col(column).isin(domain), F.lit(True))


def _total(name: str, condition: Column | None = None) -> Column:
    value = F.col(name) if condition is None else F.when(condition, F.col(name))
    return F.coalesce(F.sum(value), F.lit(0))


def _text(value: str) -> str:
    """SQL string literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _as_rows(counts: DataFrame, details: dict) -> DataFrame:
    """One row of counts, a column per check, to result rows."""
    rows = []
    for code in counts.columns:
        table, severity, description, hint = map(_text, details[code])
        rows.append(f"{_text(code)}, {table}, {severity}, bigint({code}), {description}, {hint}")
    names = "code, table_name, severity, n, description, fix_hint"
    return counts.selectExpr(f"stack({len(rows)}, {', '.join(rows)}) AS ({names})")


def _results(counts: list[DataFrame], details: dict) -> DataFrame:
    return reduce(DataFrame.union, [_as_rows(c, details) for c in counts])


def _users(users: DataFrame, now: Column) -> DataFrame:
    per_email = rows_per_key(
        users,
        ["email"],
        _count(F.col("registered_at") > now).alias("future"),
        _count(F.col("channel").isNull()).alias("no_channel"),
    )
    return per_email.agg(
        _total("rows", F.col("rows") > 1).alias("A1"),
        _total("future").alias("A2"),
        _total("no_channel").alias("A3"),
    )


def _courses(courses: DataFrame) -> DataFrame:
    return courses.agg(
        _count(F.col("price_rub") == 0).alias("A4"),
        _count(F.col("is_published") == 0).alias("A5"),
    )


def _enrollments(enrollments: DataFrame, courses: DataFrame) -> DataFrame:
    finished = F.col("progress_pct") == 100
    per_course = rows_per_key(
        enrollments,
        ["course_id"],
        _count(_outside("status", S.ENROLLMENT_STATUSES)).alias("bad_status"),
        _count(finished & ~F.col("status").eqNullSafe("completed")).alias("mismatch"),
    )
    known = courses.select("course_id").distinct().withColumn("known", F.lit(True))
    return per_course.join(known, "course_id", "left").agg(
        _total("bad_status").alias("A7"),
        _total("mismatch").alias("A8"),
        _total("rows", F.col("known").isNull()).alias("A9"),
    )


def _payments(payments: DataFrame, courses: DataFrame) -> DataFrame:
    amount = F.col("amount_rub")
    per_course = payments.groupBy("course_id").agg(
        _count(amount < 0).alias("negative"),
        _count((amount == 0) & (F.col("status") == "success")).alias("zero"),
        _count(amount > 0).alias("positive"),
    )
    free = (
        courses.filter(F.col("price_rub") == 0)
        .groupBy("course_id")
        .agg(F.count(F.lit(1)).alias("prices"))
    )
    return per_course.join(free, "course_id", "left").agg(
        _total("negative").alias("A10"),
        _total("zero").alias("A11"),
        F.coalesce(F.sum(F.col("positive") * F.col("prices")), F.lit(0)).alias("A13"),
    )


def _attempts(attempts: DataFrame, users: DataFrame) -> DataFrame:
    per_user = rows_per_key(
        attempts, ["user_id"], _count(_outside("result", S.ATTEMPT_RESULTS)).alias("bad_result")
    )
    known = users.select("user_id").distinct().withColumn("known", F.lit(True))
    return per_user.join(known, "user_id", "left").agg(
        _total("rows", F.col("known").isNull()).alias("A15"),
        _total("bad_result").alias("A17"),
    )


def _ad_costs(ad_costs: DataFrame, now: Column) -> DataFrame:
    return ad_costs.agg(
        _count((F.col("spend_rub") == 0) & (F.col("impressions") > 0)).alias("A18"),
        _count(F.col("date").cast("timestamp_ntz") > now).alias("A19"),
        _count(_outside("channel", S.PAID_CHANNELS)).alias("A20"),
    )


def _earlier(facts: DataFrame, moment: str, reference: DataFrame, since: str, key: str) -> DataFrame:
    """One row ``n``: facts dated before the matching row of ``reference``.

    Facts without a match cannot be earlier, so an inner join counts the same.
    """
    pairs = facts.select(key, moment).join(reference.select(key, since), key)
    return pairs.agg(_count(F.col(moment) < F.col(since)).alias("n"))


def _successes(attempts: DataFrame) -> DataFrame:
    return attempts.filter(F.col("result") == "success")


def run_checks(tables: dict[str, DataFrame], as_of) -> DataFrame:
    """The 20 checks on one layer, one row per check."""
    now = as_ntz(as_of)
    users, courses = tables["users"], tables["courses"]
    enrollments, payments = tables["enrollments"], tables["payments"]
    attempts, ad_costs = tables["payment_attempts"], tables["ad_costs"]
    pair = ["user_id", "course_id"]
    counts = [
        _users(users, now),
        _courses(courses),
        _earlier(enrollments, "enrolled_at", users, "registered_at", "user_id").toDF("A6"),
        _enrollments(enrollments, courses),
        _payments(payments, courses),
        _earlier(payments, "paid_at", users, "registered_at", "user_id").toDF("A12"),
        count_orphans(payments, enrollments, ["enrollment_id"]).toDF("A14"),
        _attempts(attempts, users),
        count_orphans(_successes(attempts), payments, pair).toDF("A16"),
        _ad_costs(ad_costs, now),
    ]
    return _results(counts, CHECKS)


def run_extra_rules(tables: dict[str, DataFrame]) -> DataFrame:
    """Declared consistency rules no check covers, in the same form."""
    users, courses = tables["users"], tables["courses"]
    enrollments, payments = tables["enrollments"], tables["payments"]
    pair = ["user_id", "course_id"]
    tried = rows_per_key(_successes(tables["payment_attempts"]), pair)
    paid = rows_per_key(payments, pair).withColumnRenamed("rows", "paid_rows")
    not_single = F.coalesce(F.col("paid_rows"), F.lit(0)) != 1
    counts = [
        count_orphans(enrollments, users, ["user_id"]).toDF("X1"),
        count_orphans(payments, users, ["user_id"]).toDF("X2"),
        count_orphans(payments, courses, ["course_id"]).toDF("X3"),
        _earlier(payments, "paid_at", enrollments, "enrolled_at", "enrollment_id").toDF("X4"),
        tried.join(paid, pair, "left").agg(_total("rows", not_single).alias("X5")),
    ]
    return _results(counts, RULES)


def seasonal_correlation(users: DataFrame, ad_costs: DataFrame) -> DataFrame:
    """X6: correlation of monthly registrations with monthly spend, months with both."""
    registered = users.groupBy(period_start("registered_at").alias("month")).agg(
        F.count(F.lit(1)).cast("double").alias("registrations")
    )
    spent = ad_costs.groupBy(period_start("date").alias("month")).agg(
        F.sum("spend_rub").cast("double").alias("spend")
    )
    return registered.join(spent, "month").agg(
        F.count(F.lit(1)).alias("months"),
        half_up(F.corr("registrations", "spend"), 4).alias("correlation"),
    )


def findings(results: DataFrame) -> DataFrame:
    """Checks that found something."""
    return results.filter(F.col("n") > 0)


def clean_checks(results: DataFrame) -> DataFrame:
    """Checks that found nothing."""
    return results.filter(F.col("n") == 0).select("code", "table_name", "severity")


def by_code(column: str = "code") -> Column:
    """Sort key: the number in a check code."""
    return F.substring(column, 2, 10).cast("int")


def severity_summary(results: DataFrame) -> DataFrame:
    """Failed checks and records of CRITICAL and WARNING, and of all levels as TOTAL.

    Records are findings: a row two checks find counts twice. TOTAL includes INFO.
    """
    failed = findings(results)
    per_level = failed.rollup("severity").agg(
        F.count(F.lit(1)).alias("failed_checks"), F.coalesce(F.sum("n"), F.lit(0)).alias("records")
    )
    named = per_level.select(
        F.coalesce("severity", F.lit("TOTAL")).alias("severity"), "failed_checks", "records"
    )
    wanted = results.sparkSession.sql(
        f"SELECT * FROM VALUES ('{CRITICAL}'), ('{WARNING}'), ('TOTAL') AS levels (severity)"
    )
    return wanted.join(named, "severity", "left").na.fill(0)


def priorities(results: DataFrame) -> DataFrame:
    """What to fix first: CRITICAL now, WARNING next, with the head of the description."""
    urgency = F.when(F.col("severity") == CRITICAL, "now").otherwise("next")
    return (
        findings(results)
        .filter(F.col("severity").isin(CRITICAL, WARNING))
        .select(
            urgency.alias("urgency"),
            "code",
            F.substring_index("description", " — ", 1).alias("problem"),
        )
        .orderBy("urgency", by_code())
    )


def alerts(results: DataFrame, run_id: str, as_of) -> DataFrame:
    """Rows to act on at once: CRITICAL checks that found something."""
    return (
        findings(results)
        .filter(F.col("severity") == CRITICAL)
        .select(
            F.lit(run_id).alias("run_id"),
            as_ntz(as_of).alias("raised_at"),
            "code",
            "table_name",
            "n",
            "description",
            "fix_hint",
        )
    )


def table_summary(results: DataFrame) -> DataFrame:
    """Failed checks and records per table and severity."""
    return results.groupBy("table_name", "severity").agg(
        F.count_if(F.col("n") > 0).alias("failed_checks"), F.sum("n").alias("records")
    )


def results_frame(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    """Stored results from plain rows ``(code, table, severity, n, description, hint)``."""
    return spark.createDataFrame(rows, RESULT_SCHEMA)
