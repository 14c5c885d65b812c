import datetime as dt

from cohortlake.plans import marts, reports


def by(df, *names):
    return {tuple(str(r[n]) for n in names): r for r in df.collect()}


def test_lifetime_value(staged):
    rows = {r.user_id: r.ltv_rub for r in reports.lifetime_value(staged["payments"]).collect()}
    assert rows == {1: 4700, 2: 3000, 3: 2400, 4: 500}


def test_registrations_by_channel(staged):
    rows = by(reports.registrations_by_channel(staged["users"]), "period", "channel")
    assert rows["2024-03-01", "unknown"].registrations == 1
    assert rows["2024-01-01", "organic"].registrations == 1


def test_active_users(staged):
    rows = by(reports.active_users(staged["enrollments"]), "grain", "period")
    assert rows["month", "2024-02-01"].active_users == 3
    assert rows["day", "2024-02-20"].active_users == 2
    assert rows["week", "2024-02-19"].active_users == 2


def test_top_subjects_and_products(staged):
    rows = by(reports.top_subjects(staged["payments"], staged["courses"], 1), "period")
    assert rows[("2024-02-01",)].subject == "Математика" and rows[("2024-02-01",)].revenue == 2900
    best = by(reports.top_products(staged["payments"], staged["courses"], 1), "period")
    assert best[("2024-02-19",)].course_id == 1


def test_year_to_date_starts_over(spark, staged):
    later = staged["payments"].filter("payment_id = 1").selectExpr(
        *[c for c in staged["payments"].columns if c != "paid_at"],
        "TIMESTAMP_NTZ'2025-01-02 00:00:00' AS paid_at",
    )
    rows = by(
        reports.revenue_year_to_date(staged["payments"].unionByName(later), staged["courses"]),
        "period",
    )
    assert rows[("2024-03-01",)].revenue_ytd == 10600
    assert rows[("2025-01-01",)].revenue_ytd == 2700


def test_weekly_revenue_flags_a_fall(staged):
    rows = by(reports.weekly_revenue(staged["payments"], staged["courses"]), "week")
    assert rows[("2024-02-05",)].is_anomaly and not rows[("2024-02-19",)].is_anomaly
    assert rows[("2024-01-01",)].revenue_wow_pct is None


def test_new_payers_count_once(staged):
    rows = by(reports.new_payers(staged["payments"], "month"), "period")
    assert {k[0]: r.new_paying_users for k, r in rows.items()} == {"2024-01-01": 2, "2024-02-01": 2}


def test_last_months(staged):
    rows = by(reports.last_months(staged["payments"], staged["courses"], "2024-04-15", 2), "payment_month")
    assert set(rows) == {("2024-02-01",), ("2024-03-01",)}


def test_revenue_structure(staged):
    rows = reports.revenue_structure(staged["payments"], staged["courses"]).collect()
    february = [r for r in rows if str(r.period) == "2024-02-01"]
    month = next(r for r in february if r.detail == 3)
    assert month.revenue == 3900 and month.share_pct == 100
    assert sum(r.revenue for r in february if r.detail == 0) == 3900
    product = {r.course_type: r.share_pct for r in february if r.detail == 1}
    assert product == {"Курс": 74.4, "Подписка": 25.6}


def test_channel_summary_counts_a_payer_once(staged):
    rows = by(
        reports.channel_summary(
            staged["ad_costs"], staged["users"], staged["payments"], "2024-01-01", "2024-04-01"
        ),
        "channel",
    )
    vk = rows[("vk_ads",)]
    assert (vk.spend, vk.registrations, vk.paying_users, vk.revenue_from_channel) == (1200, 2, 2, 5400)
    assert vk.cac == 600 and vk.roas == 4.5
    first = reports.channel_summary(
        staged["ad_costs"], staged["users"], staged["payments"], "2024-01-01", dt.date(2024, 2, 1)
    ).collect()
    assert [(r.channel, r.registrations) for r in first] == [("vk_ads", 1)]


def test_weekly_channels(staged):
    rows = by(
        reports.weekly_channels(staged["ad_costs"], staged["users"], staged["payments"]),
        "week", "channel",
    )
    first, second = rows["2024-01-08", "vk_ads"], rows["2024-02-05", "vk_ads"]
    assert first.spend_prev is None and not first.cac_jump
    assert second.spend_prev == 800


def test_cohort_matrix(staged):
    rows = by(reports.cohort_matrix(marts.mart_activity(staged["enrollments"])), "cohort_month")
    january = rows[("2024-01-01",)]
    assert (january.cohort_size, january.m0, january.m1, january.m2, january.m3) == (2, 100, 50, 50, None)


def test_dropout_histogram(staged):
    rows = reports.dropout_histogram(staged["enrollments"]).collect()
    assert [(r.progress_from, r.dropped, r.share_pct) for r in rows] == [(30, 1, 100.0)]


def test_low_completion(staged):
    rows = by(reports.low_completion(staged["enrollments"], staged["courses"], 0.5), "subject")
    assert rows[("Математика",)].completion_rate_pct == 50 and not rows[("Математика",)].is_low
    assert rows[("Физика",)].is_low


def test_students(staged):
    tables = [staged[t] for t in ("users", "enrollments", "courses")]
    active = by(reports.active_students(*tables, "2024-02-25"), "enrollment_id")
    assert set(active) == {("2",), ("5",)}
    assert active[("5",)].days_idle == 5 and active[("5",)].email == "c@x"
    assert reports.at_risk_students(*tables, "2024-02-25").count() == 1
    later = reports.at_risk_students(*tables, "2024-03-20").collect()
    assert [r.enrollment_id for r in later] == [2, 5]


def test_slow_students_need_not_be_idle(spark, staged):
    slow = staged["enrollments"].selectExpr(
        *[c for c in staged["enrollments"].columns if c != "progress_pct"],
        "CAST(IF(enrollment_id = 2, 10, progress_pct) AS INT) AS progress_pct",
    )
    rows = reports.at_risk_students(staged["users"], slow, staged["courses"], "2024-03-10").collect()
    flags = {r.enrollment_id: (r.is_idle, r.is_slow) for r in rows}
    assert flags == {2: (True, True), 5: (True, False)}


def test_operations(staged):
    tables = [
        staged[t] for t in ("users", "enrollments", "courses", "payments", "payment_attempts")
    ]
    rows = {r.metric: r.value for r in reports.operations_counters(*tables, "2024-02-07").collect()}
    assert rows["enrollments_day"] == 1 and rows["enrollments_month"] == 1
    assert rows["payments_day"] == 1 and rows["payments_day_rub"] == 1000
    assert rows["dropoff_7d_pct"] == 50.0
    assert rows["registrations_month"] == 0


def test_course_completion(staged):
    rows = {r.course_id: r for r in reports.course_completion(staged["enrollments"], staged["courses"]).collect()}
    counts = staged["enrollments"].groupBy("course_id").count().collect()
    assert {c: r.total_enrollments for c, r in rows.items()} == {r.course_id: r["count"] for r in counts}
    math = [r for r in rows.values() if r.subject == "Математика"]
    total = sum(r.total_enrollments for r in math)
    for r in math:
        rate = round(100 * sum(m.completed for m in math) / total, 1)
        assert r.subject_rate_pct == rate
        assert r.above_subject_pct == round(r.completion_rate_pct - rate, 1)


def test_refund_rate(spark, raw):
    rows = reports.refund_rate(raw["payments"]).collect()
    paid = [r for r in raw["payments"].collect()]
    assert sum(r.refunds for r in rows) == sum(r.amount_rub < 0 for r in paid)
    assert sum(r.refunded_rub for r in rows) == -sum(r.amount_rub for r in paid if r.amount_rub < 0)
    for r in rows:
        assert r.refund_rate_pct == (round(100 * r.refunds / r.payments, 1) if r.payments else None)


def test_payment_dropoff_tells_guests_apart(raw):
    rows = reports.payment_dropoff(raw["payment_attempts"], raw["users"]).collect()
    users = {r.user_id for r in raw["users"].collect()}
    attempts = raw["payment_attempts"].collect()
    guests = [a for a in attempts if a.user_id not in users]
    assert guests and sum(r.guest_attempts for r in rows) == len(guests)
    assert sum(r.member_attempts for r in rows) == len(attempts) - len(guests)
    gave_up = sum(a.result == "abandoned" for a in attempts)
    assert sum(r.guest_abandoned + r.member_abandoned for r in rows) == gave_up
