"""Why staging leaves a row out: every broken rule of every raw row.

Each table is read once and keeps all its rows; ``broken_rules`` names the rules in a
fixed order and is empty for the rows that staging keeps. A rule that needs another
table meets it by a left join on a key that is unique there, so a row stays one row
and a hot key can be split. A value that is missing breaks the rule it is needed for.
"""

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlake import schemas as S
from cohortlake.functions import as_ntz
from cohortlake.sources.layers import materialize

RULES = "broken_rules"
DUPLICATE, LATER = "duplicate_email", "registered_later"
UNPUBLISHED = "unpublished"
UNKNOWN_USER, UNKNOWN_COURSE = "user_not_staged", "course_not_staged"
EARLY, UNKNOWN_ENROLLMENT = "before_registration", "enrollment_not_staged"
AMOUNT, RESULT, UNPAID = "amount_not_positive", "unknown_result", "success_without_payment"
LOST, DATED_LATER, CHANNEL = "spend_lost", "dated_later", "channel_not_paid"


def _with_rules(rows: DataFrame, columns: list[str], rules: dict[str, Column]) -> DataFrame:
    """The columns and the names of the rules whose condition does not hold (NULL neither)."""
    named = [F.when(~F.coalesce(holds, F.lit(False)), name) for name, holds in rules.items()]
    return rows.select(*columns, F.array_compact(F.array(*named)).alias(RULES))


def _marked(reference: DataFrame, keys: list[str], *more: str) -> DataFrame:
    """Unique keys of a reference under names of their own, with a mark that they exist."""
    named = [F.col(c).alias(f"_{c}") for c in (*keys, *more)]
    return reference.select(*named, F.lit(True).alias(f"_has_{'_'.join(keys)}"))


def _meet(rows: DataFrame, reference: DataFrame, keys: list[str]) -> DataFrame:
    same = reduce(Column.__and__, [F.col(c) == F.col(f"_{c}") for c in keys])
    return rows.join(reference, same, "left")


def judge_users(users: DataFrame, as_of) -> DataFrame:
    """Smallest id of its e-mail; registered by ``as_of``."""
    first = users.groupBy("email").agg(F.min("user_id").alias("user_id"))
    rows = _meet(users, _marked(first, ["user_id"]), ["user_id"])
    known = F.col("registered_at") <= as_ntz(as_of)
    return _with_rules(rows, users.columns, {DUPLICATE: F.col("_has_user_id"), LATER: known})


def judge_courses(courses: DataFrame) -> DataFrame:
    """Published."""
    return _with_rules(courses, courses.columns, {UNPUBLISHED: F.col("is_published") == 1})


def _registered(facts: DataFrame, staged_users: DataFrame, moment: str):
    """Facts with their user's registration, and the rules on it.

    A fact of an unknown user breaks that rule alone, as there is no registration to precede.
    """
    users = _marked(staged_users, ["user_id"], "registered_at")
    has = F.col("_has_user_id")
    timely = has.isNull() | (F.col(moment) >= F.col("_registered_at"))
    return _meet(facts, users, ["user_id"]), {UNKNOWN_USER: has, EARLY: timely}


def judge_enrollments(
    enrollments: DataFrame, staged_users: DataFrame, staged_courses: DataFrame
) -> DataFrame:
    """Staged user, not before registration, staged course."""
    rows, rules = _registered(enrollments, staged_users, "enrolled_at")
    rows = _meet(rows, _marked(staged_courses, ["course_id"]), ["course_id"])
    rules[UNKNOWN_COURSE] = F.col("_has_course_id")
    return _with_rules(rows, enrollments.columns, rules)


def judge_payments(
    payments: DataFrame, staged_users: DataFrame, staged_enrollments: DataFrame
) -> DataFrame:
    """Positive amount, staged user, not before registration, staged enrollment."""
    rows, rules = _registered(payments, staged_users, "paid_at")
    rows = _meet(rows, _marked(staged_enrollments, ["enrollment_id"]), ["enrollment_id"])
    rules = {AMOUNT: F.col("amount_rub") > 0, **rules}
    rules[UNKNOWN_ENROLLMENT] = F.col("_has_enrollment_id")
    return _with_rules(rows, payments.columns, rules)


def judge_attempts(
    attempts: DataFrame, staged_users: DataFrame, staged_payments: DataFrame
) -> DataFrame:
    """Staged user, known result, and for a success a staged payment of user and course.

    The paid pairs are stored, one row each, so the join shuffles both sides afresh.
    """
    pair = ["user_id", "course_id"]
    paid = materialize(staged_payments.select(*pair).distinct(), "paid-pairs")
    rows = _meet(attempts, _marked(staged_users, ["user_id"]), ["user_id"])
    rows = rows.withColumnRenamed("_user_id", "_staged_user")
    rows = _meet(rows, _marked(paid, pair), pair)
    success = F.col("result") == "success"
    rules = {
        UNKNOWN_USER: F.col("_has_user_id"),
        RESULT: F.col("result").isin(S.ATTEMPT_RESULTS),
        UNPAID: F.coalesce(~success, F.lit(True)) | F.col("_has_user_id_course_id"),
    }
    return _with_rules(rows, attempts.columns, rules)


def judge_ad_costs(ad_costs: DataFrame, as_of) -> DataFrame:
    """Paid channel, dated by ``as_of``, not free of charge with impressions."""
    lost = (F.col("spend_rub") == 0) & (F.col("impressions") > 0)
    rules = {
        LOST: ~lost,
        DATED_LATER: F.col("date") <= as_ntz(as_of).cast("date"),
        CHANNEL: F.col("channel").isin(S.PAID_CHANNELS),
    }
    return _with_rules(ad_costs, ad_costs.columns, rules)


class Judged(Mapping):
    """Six raw tables with ``broken_rules``, each judged when first asked for.

    A table asks for the staged tables that its own rules need, and no others.
    """

    def __init__(self, raw: Mapping[str, DataFrame], staged: Mapping[str, DataFrame], as_of):
        self._raw, self._staged, self._as_of = raw, staged, as_of
        self._judged: dict[str, DataFrame] = {}

    def _judge(self, table: str) -> DataFrame:
        rows, staged = self._raw[table], self._staged
        if table == "users":
            return judge_users(rows, self._as_of)
        if table == "courses":
            return judge_courses(rows)
        if table == "enrollments":
            return judge_enrollments(rows, staged["users"], staged["courses"])
        if table == "payments":
            return judge_payments(rows, staged["users"], staged["enrollments"])
        if table == "payment_attempts":
            return judge_attempts(rows, staged["users"], staged["payments"])
        return judge_ad_costs(rows, self._as_of)

    def __getitem__(self, table: str) -> DataFrame:
        if table not in S.TABLES:
            raise KeyError(table)
        if table not in self._judged:
            self._judged[table] = self._judge(table)
        return self._judged[table]

    def __iter__(self):
        return iter(S.TABLES)

    def __len__(self) -> int:
        return len(S.TABLES)


def judge_all(
    raw: Mapping[str, DataFrame], staged: Mapping[str, DataFrame], as_of
) -> Mapping[str, DataFrame]:
    """All six raw tables with ``broken_rules``, against a staged layer of the same rows."""
    return Judged(raw, staged, as_of)


def kept(judged: DataFrame) -> DataFrame:
    """Rows without a broken rule, as staging keeps them."""
    return judged.filter(F.size(RULES) == 0).drop(RULES)


def quarantined(judged: DataFrame) -> DataFrame:
    """Rows left out, with their broken rules as text."""
    return judged.filter(F.size(RULES) > 0).withColumn(RULES, F.array_join(RULES, ","))


def reason_counts(judged: Mapping[str, DataFrame]) -> DataFrame:
    """``table_name, broken_rules, row_count`` per set of rules; kept rows have the empty set.

    A row is counted once, so the counts of a table add up to its raw rows.
    """
    parts = [
        df.groupBy(F.array_join(RULES, ",").alias(RULES))
        .agg(F.count(F.lit(1)).alias("row_count"))
        .select(F.lit(table).alias("table_name"), RULES, "row_count")
        for table, df in judged.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def rule_counts(judged: Mapping[str, DataFrame]) -> DataFrame:
    """Rows that break each rule, and those that break no other: what dropping it would save."""
    alone = F.size(RULES) == 1
    parts = [
        df.select(F.explode(RULES).alias("rule"), alone.cast("int").alias("_alone"))
        .groupBy("rule")
        .agg(F.count(F.lit(1)).alias("rows"), F.sum("_alone").alias("rows_alone"))
        .select(F.lit(table).alias("table_name"), "rule", "rows", "rows_alone")
        for table, df in judged.items()
    ]
    return reduce(DataFrame.unionByName, parts)
