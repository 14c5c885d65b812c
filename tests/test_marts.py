import datetime as dt

import pytest

from cohortlake.plans import marts
from tests import fixture


def rows(df):
    return [
        tuple(v.isoformat() if isinstance(v, dt.date) else v for v in r) for r in df.collect()
    ]


def test_revenue(staged):
    assert rows(marts.mart_revenue(staged["payments"], staged["courses"])) == fixture.MART_REVENUE


def test_ads(staged):
    mart = marts.mart_ad_performance(staged["ad_costs"], staged["users"], staged["payments"])
    assert rows(mart) == fixture.MART_ADS


def test_activity(staged):
    assert rows(marts.mart_activity(staged["enrollments"])) == fixture.MART_ACTIVITY


def test_completion(staged):
    mart = marts.mart_completion(staged["enrollments"], staged["courses"])
    assert rows(mart) == fixture.MART_COMPLETION


def conversion(staged, grain="month"):
    facts = [staged[t] for t in ("users", "enrollments", "payments", "payment_attempts")]
    return marts.mart_conversion(*facts, grain)


def test_conversion(staged):
    assert rows(conversion(staged)) == fixture.MART_CONVERSION


@pytest.mark.parametrize("grain", ["day", "week"])
def test_finer_grain_keeps_the_sums(staged, grain):
    fine = conversion(staged, grain).groupBy().sum("registered", "enrolled", "paid").first()
    assert tuple(fine) == (6, 5, 4)
    revenue = marts.mart_revenue(staged["payments"], staged["courses"], grain)
    assert revenue.groupBy().sum("revenue").first()[0] == 10600


def test_products_add_up_and_month_zero_is_whole(staged):
    for r in marts.mart_revenue(staged["payments"], staged["courses"]).collect():
        assert r.revenue == r.revenue_courses + r.revenue_intensive + r.revenue_subscription
    for r in marts.mart_activity(staged["enrollments"]).collect():
        assert r.month_number != 0 or r.retention_rate_pct == 100


def test_unknown_grain():
    from cohortlake.functions import period_start

    with pytest.raises(ValueError):
        period_start("x", "decade")
