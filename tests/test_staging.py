import datetime as dt

import pytest
from pyspark.sql import functions as F

from cohortlake import schemas as S
from cohortlake.operators import staging
from tests.fixture import AS_OF, STAGED_KEYS

ROW_ID = {
    "users": "user_id",
    "courses": "course_id",
    "enrollments": "enrollment_id",
    "payments": "payment_id",
    "payment_attempts": "attempt_id",
}


@pytest.mark.parametrize("table", list(STAGED_KEYS))
def test_kept_keys(staged, table):
    assert sorted(r[0] for r in staged[table].select(ROW_ID[table]).collect()) == STAGED_KEYS[table]


@pytest.mark.parametrize("table", S.TABLES)
def test_rows_are_kept_unchanged(raw, staged, table):
    assert staged[table].columns == raw[table].columns
    assert staged[table].exceptAll(raw[table]).count() == 0


def test_ad_costs(staged):
    kept = staged["ad_costs"].select(F.col("date").cast("string"), "channel").collect()
    assert sorted(tuple(r) for r in kept) == [
        ("2024-01-10", "vk_ads"),
        ("2024-01-11", "vk_ads"),
        ("2024-02-10", "telegram"),
        ("2024-02-10", "vk_ads"),
        ("2024-03-01", "telegram"),
    ]


def test_ad_costs_without_spend_or_impressions(spark):
    day = dt.date(2024, 1, 1)
    rows = [
        (day, "vk_ads", 10, 1, None),  # unknown spend with impressions: dropped
        (day, "vk_ads", 0, 2, None),  # no impressions settle the rule: kept
        (day, "vk_ads", None, 3, 0),  # unknown impressions with spend 0: dropped
        (day, "vk_ads", None, 4, 5),  # spend settles the rule: kept
        (day, "vk_ads", 10, 5, -5),  # negative spend: kept
        (day, None, 10, 6, 5),  # no channel: dropped
    ]
    ads = spark.createDataFrame(rows, S.SCHEMAS["ad_costs"])
    assert sorted(r.clicks for r in staging.stage_ad_costs(ads, AS_OF).collect()) == [2, 4, 5]


def test_payment_of_an_unpublished_course_stays(spark, raw, staged):
    """Only the revenue mart asks whether the payment's own course is published."""
    row = (50, 1, 5, 1, dt.datetime(2024, 2, 1), 700, 700, 0, "success", "card")
    extra = spark.createDataFrame([row], S.SCHEMAS["payments"])
    kept = staging.stage_payments(extra, staged["users"], staged["enrollments"])
    assert kept.count() == 1
    from cohortlake.plans.marts import mart_revenue

    assert mart_revenue(kept, staged["courses"]).count() == 0


def test_future_smallest_id_drops_the_email(raw):
    kept = {r.user_id for r in staging.stage_users(raw["users"], AS_OF).collect()}
    assert 7 not in kept and 8 not in kept
    later = {r.user_id for r in staging.stage_users(raw["users"], "2026-01-01").collect()}
    assert 7 in later and 8 not in later


def test_partitions_and_order_do_not_matter(raw, staged):
    shuffled = {t: df.repartition(7).orderBy(F.desc(df.columns[0])) for t, df in raw.items()}
    again = staging.stage_all(shuffled, dt.datetime(2025, 7, 15))
    for table, df in again.items():
        assert sorted(map(str, df.collect())) == sorted(map(str, staged[table].collect()))
