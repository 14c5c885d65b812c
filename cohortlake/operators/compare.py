"""Comparison of two quality runs, and the history of runs."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortlake.operators.quality import SECONDARY, by_code


def _change_pct(before: Column, after: Column) -> Column:
    """Whole percent, half to even; NULL where there was nothing before."""
    share = (after - before).cast("double") / F.nullif(before, F.lit(0))
    return F.bround(share * 100, 0)


def paired_counts(before: DataFrame, after: DataFrame) -> DataFrame:
    """``code, before_n, after_n`` of every code of either run; a missing one is 0."""
    return (
        before.select("code", F.col("n").alias("before_n"))
        .join(after.select("code", F.col("n").alias("after_n")), "code", "full_outer")
        .na.fill(0, ["before_n", "after_n"])
    )


def compare_runs(before: DataFrame, after: DataFrame) -> DataFrame:
    """Change per check; checks clean in both runs are left out."""
    was, now = F.col("before_n"), F.col("after_n")
    status = (
        F.when(F.col("code").isin(SECONDARY), "secondary")
        .when((now == 0) & (was > 0), "removed")
        .otherwise("remains")
    )
    return (
        paired_counts(before, after)
        .filter((was > 0) | (now > 0))
        .select(
            "code",
            "before_n",
            "after_n",
            (now - was).alias("delta"),
            _change_pct(was, now).alias("change_pct"),
            status.alias("status"),
        )
        .orderBy(by_code())
    )


def compare_totals(before: DataFrame, after: DataFrame) -> DataFrame:
    """Totals over all checks (``all``), and without the secondary ones (``adjusted``)."""
    was, now = F.col("before_n"), F.col("after_n")
    both = F.array(F.lit("all"), F.lit("adjusted"))
    scopes = F.when(F.col("code").isin(SECONDARY), F.array(F.lit("all"))).otherwise(both)
    return (
        paired_counts(before, after)
        .withColumn("scope", F.explode(scopes))
        .groupBy("scope")
        .agg(
            F.sum(was).alias("before_n"),
            F.sum(now).alias("after_n"),
            F.count_if((was > 0) & (now == 0)).alias("checks_removed"),
            F.count_if(now > 0).alias("checks_remaining"),
        )
        .withColumn("removed_n", was - now)
        .withColumn("change_pct", _change_pct(was, now))
    )


def secondary_growth(before: DataFrame, after: DataFrame) -> DataFrame:
    """Secondary checks that found more after cleaning than before."""
    return paired_counts(before, after).filter(
        F.col("code").isin(SECONDARY) & (F.col("after_n") > F.col("before_n"))
    )


def as_run(results: DataFrame, run_id: str, run_at: Column) -> DataFrame:
    """Results as rows of the run history."""
    return results.select(
        F.lit(run_id).alias("run_id"), run_at.alias("run_at"), "code", "table_name", "severity", "n"
    )


def run_history(runs: DataFrame) -> DataFrame:
    """Every run's counts beside the same check's previous run."""
    of_check = Window.partitionBy("code").orderBy("run_at", "run_id")
    return runs.withColumn("previous_n", F.lag("n").over(of_check)).withColumn(
        "delta", F.col("n") - F.col("previous_n")
    )
