"""Physical plans: joins stay equi-joins, and a hot key is split."""

import pytest
from pyspark.sql import functions as F

from cohortlake import schemas as S
from cohortlake.operators import history, quality, reconcile, staging
from cohortlake.plans import marts
from cohortlake.plans.colocated import ColocatedLayer
from cohortlake.plans.registry import QUERIES
from cohortlake.session import run_folder
from cohortlake.sources.layers import create_table
from tests.conftest import SOURCE


@pytest.fixture
def conf(spark):
    """Set session options for one test."""
    changed = {}

    def set_all(**options):
        for key, value in options.items():
            name = "spark.sql." + key.replace("__", ".")
            changed[name] = spark.conf.get(name, None)
            spark.conf.set(name, value)

    yield set_all
    for name, value in changed.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.skipif(SOURCE is None, reason="no source tables")
@pytest.mark.parametrize("name", list(QUERIES))
def test_no_pair_joins_and_no_python(spark, conf, name):
    conf(autoBroadcastJoinThreshold="-1")
    text = plan(QUERIES[name](spark, SOURCE))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "EvalPython", "InPandas"):
        assert operator not in text


def facts_with_a_hot_user(spark, rows=200_000, users=2_000):
    """User 7 and the pair (7, 7) hold a third of all rows."""
    number = F.col("id")
    user = F.when(number % 3 == 0, 7).otherwise(F.pmod(F.xxhash64("id"), F.lit(users)))
    day = F.lit("2024-01-01").cast("timestamp_ntz") + F.make_dt_interval(
        days=(number % 300).cast("int")
    )
    people = spark.range(users).select(
        number.alias("user_id"),
        F.concat(F.lit("u"), number).alias("email"),
        F.lit("2023-01-01").cast("timestamp_ntz").alias("registered_at"),
        F.lit("vk_ads").alias("channel"),
    )
    facts = spark.range(rows).select(
        number.alias("enrollment_id"), user.alias("user_id"), user.alias("course_id"),
        day.alias("enrolled_at"), F.lit("active").alias("status"),
        (number % 101).cast("int").alias("progress_pct"),
    )
    return people, facts


@pytest.fixture
def hot(spark, conf):
    conf(
        autoBroadcastJoinThreshold="-1",
        adaptive__autoBroadcastJoinThreshold="-1",
        adaptive__advisoryPartitionSizeInBytes="64KB",
        adaptive__skewJoin__skewedPartitionThresholdInBytes="128KB",
        adaptive__skewJoin__skewedPartitionFactor="2",
        shuffle__partitions="16",
    )
    folder = run_folder(spark, "hot")
    people, facts = facts_with_a_hot_user(spark)
    people.write.parquet(f"{folder}/users")
    facts.write.parquet(f"{folder}/facts")
    return spark.read.parquet(f"{folder}/users"), spark.read.parquet(f"{folder}/facts")


def final_plan(df) -> str:
    df._jdf.queryExecution().toRdd().count()
    return plan(df)


def as_payments(facts):
    return facts.select(
        F.col("enrollment_id").alias("payment_id"), "user_id", "course_id", "enrollment_id",
        F.col("enrolled_at").alias("paid_at"), F.lit(10).cast("bigint").alias("amount_rub"),
        F.lit("success").alias("status"),
    )


def as_attempts(facts):
    return facts.select(
        F.col("enrollment_id").alias("attempt_id"), "user_id", "course_id",
        F.col("enrolled_at").alias("attempted_at"), F.lit("success").alias("result"),
    )


def test_hot_user_is_split_in_staging(hot):
    users, facts = hot
    courses = users.select(F.col("user_id").alias("course_id"))
    staged = staging.stage_enrollments(facts, users, courses)
    assert final_plan(staged).count("skew=true") >= 2
    assert staged.count() == facts.count()
    paid = staging.stage_payments(as_payments(facts), users, facts)
    assert "skew=true" in final_plan(paid)


def test_hot_pair_is_split_among_the_attempts(hot):
    users, facts = hot
    staged = staging.stage_payment_attempts(as_attempts(facts), users, as_payments(facts))
    assert "skew=true" in final_plan(staged)
    assert staged.count() == facts.count()
    open_attempts = reconcile.unconfirmed_attempts(as_attempts(facts), as_payments(facts))
    assert open_attempts.count() == 0


def test_hot_user_below_an_aggregate(hot):
    users, facts = hot
    late = quality._earlier(facts, "enrolled_at", users, "registered_at", "user_id")
    assert "skew=true" in final_plan(late)
    # The aggregate could use the join's placement; the session gives that up to split.
    joined = facts.join(users, "user_id").groupBy("user_id")
    sums = joined.agg(F.max("enrollment_id"), F.max("enrolled_at"), F.max("progress_pct"))
    assert "skew=true" in final_plan(sums)


def test_hot_course_at_time(hot):
    _, facts = hot
    versions = history.build_history(
        facts.filter("enrollment_id % 50 = 0").select(
            "course_id", F.col("enrolled_at").alias("at"), F.col("progress_pct").alias("price")
        ),
        "course_id", ["price"], "at",
    )
    joined = history.join_at_time(facts, versions, "course_id", "enrolled_at", "left")
    assert joined.count() == facts.count()


def test_marts_under_skew(hot):
    users, facts = hot
    activity = marts.mart_activity(facts).collect()
    assert sum(r.retained_users for r in activity if r.month_number == 0) == (
        facts.select("user_id").distinct().count()
    )
    ads = facts.sparkSession.createDataFrame([], S.SCHEMAS["ad_costs"])
    assert marts.mart_ad_performance(ads, users, as_payments(facts)).count() == 0


def test_filters_and_columns_reach_the_scan(spark, tmp_path, staged):
    path = str(tmp_path / "payments")
    staged["payments"].write.parquet(path)
    stored = spark.read.parquet(path)
    text = plan(marts.revenue_by_period(stored, staged["courses"]))
    scan = next(line for line in text.splitlines() if "FileScan" in line and "paid_at" in line)
    assert "EqualTo(status,success)" in scan and "payment_method" not in scan


def test_colocated_facts_are_not_shuffled(spark, conf):
    conf(shuffle__partitions="8")
    people, facts = facts_with_a_hot_user(spark, 60_000, 1_000)
    # Payments of each kind of enrollment: their own user's, another user's, and none.
    number = F.col("enrollment_id")
    meant = F.when(number % 10 == 1, number + 3).when(number % 10 == 2, -number).otherwise(number)
    nobody = F.when(number % 100 != 50, F.col("user_id"))
    raw = {
        "users": people,
        "courses": people.select(
            F.col("user_id").alias("course_id"), (F.col("user_id") % 3).cast("int").alias("is_published")
        ),
        "enrollments": facts.withColumn("user_id", nobody),
        "payments": as_payments(facts).withColumns({"enrollment_id": meant, "user_id": nobody}),
        "payment_attempts": as_attempts(facts).withColumns({
            "course_id": F.col("course_id") + (F.col("attempt_id") % 2),
            "result": F.when(F.col("attempt_id") % 3 == 1, "failed").otherwise("success"),
        }),
    }
    root = run_folder(spark, "colocated")
    raw = {t: create_table(df, f"{root}/raw/{t}") for t, df in raw.items()}
    layer = ColocatedLayer(raw, "2030-01-01", f"{root}/layer", 8)
    assert [r.user_id for r in layer.hot.collect()] == [7]
    users = staging.stage_users(raw["users"], "2030-01-01")
    expected = {
        "enrollments": staging.stage_enrollments(
            raw["enrollments"], users, staging.stage_courses(raw["courses"])
        )
    }
    expected["payments"] = staging.stage_payments(raw["payments"], users, expected["enrollments"])
    expected["payment_attempts"] = staging.stage_payment_attempts(
        raw["payment_attempts"], users, expected["payments"]
    )
    for table, df in expected.items():
        assert sorted(layer[table].collect()) == sorted(df.collect()) != []
        assert layer.staged(table)[1].count() > 1000, "the hot user lies apart"
    for together in (
        layer._enrollments()[0], layer.own_enrollments(), layer._payment_attempts()[0],
    ):
        text = plan(together)
        assert "Exchange hashpartitioning" not in text and "SortMergeJoin" in text
        assert "Bucketed: true" in text
