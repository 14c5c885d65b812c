"""Successful attempts against payments within a time limit."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlake.operators.keys import _SALTS


def _slot(moment: str, seconds: int):
    """Number of the time slot a timestamp falls in."""
    since_epoch = F.unix_seconds(F.col(moment).cast("timestamp"))
    return F.floor(since_epoch / F.lit(seconds)).cast("bigint")


def unconfirmed_attempts(
    attempts: DataFrame, payments: DataFrame, within_seconds: int = 300
) -> DataFrame:
    """Successful attempts with no payment of the same user and course within the limit.

    Time is cut into slots as long as the limit. A payment confirms an attempt if
    it is the attempt's slot and not earlier, or the next slot and not later than
    the limit; so the latest payment of a slot and the earliest of the next decide.
    Payments are reduced to these two per user, course and slot (in 16 salted
    parts, see ``key_set``), and an attempt meets at most 32 rows however many
    payments a pair has.
    """
    pair = ["user_id", "course_id"]
    salt = F.pmod(F.xxhash64("payment_id"), F.lit(_SALTS))
    per_slot = (
        payments.groupBy(*pair, _slot("paid_at", within_seconds).alias("slot"), salt.alias("_salt"))
        .agg(F.min("paid_at").alias("earliest"), F.max("paid_at").alias("latest"))
        .drop("_salt")
    )
    same = F.struct(F.col("slot"), F.col("latest"), F.lit(None).cast("timestamp_ntz").alias("earliest"))
    before = F.struct(
        (F.col("slot") - 1).alias("slot"),
        F.lit(None).cast("timestamp_ntz").alias("latest"),
        F.col("earliest"),
    )
    evidence = per_slot.select(*pair, F.inline(F.array(same, before)))
    successes = attempts.filter(F.col("result") == "success").withColumn(
        "slot", _slot("attempted_at", within_seconds)
    )
    a, p = successes.alias("a"), evidence.alias("p")
    deadline = F.col("a.attempted_at") + F.make_dt_interval(secs=F.lit(within_seconds))
    confirmed = (F.col("p.latest") >= F.col("a.attempted_at")) | (F.col("p.earliest") <= deadline)
    on = [F.col(f"a.{c}") == F.col(f"p.{c}") for c in [*pair, "slot"]]
    return a.join(p, [*on, confirmed], "left_anti").select(*attempts.columns)
