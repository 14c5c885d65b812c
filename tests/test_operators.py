import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from cohortlake import schemas as S
from cohortlake.functions import period_start
from cohortlake.operators import corrections, distinct, history, keys, reasons, reconcile
from cohortlake.operators.staging import stage_ad_costs, stage_users
from cohortlake.session import run_folder
from tests.fixture import AS_OF


def ids(df, column):
    return sorted(r[0] for r in df.select(column).collect())


def test_orphans_and_counts(raw):
    attempts, users = raw["payment_attempts"], raw["users"]
    assert ids(keys.orphans(attempts, users, ["user_id"], "user_id"), "attempt_id") == [7]
    assert keys.count_orphans(attempts, users, ["user_id"]).first().n == 1


def test_null_keys_are_orphans(spark):
    left = spark.sql("SELECT * FROM VALUES (1), (NULL), (NULL), (9) t(k)")
    right = spark.sql("SELECT * FROM VALUES (1), (NULL) t(k)")
    assert keys.count_orphans(left, right, ["k"]).first().n == 3
    assert keys.orphans(left, right, ["k"], "k").count() == 3


def test_key_set_has_all_keys_and_few_copies(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), "id")
    sizes = {r.k: r["count"] for r in keys.key_set(df, ["k"], "id").groupBy("k").count().collect()}
    assert set(sizes) == {0, 1, 2} and max(sizes.values()) <= 16


def test_keep_first_and_smallest(spark):
    rows = [(1, "a", 5, "x"), (2, "a", 5, "y"), (3, "b", 5, "z"), (4, None, 5, "u"), (5, None, 5, "v")]
    df = spark.createDataFrame(rows, "id long, k string, j int, v string")
    first = keys.keep_first(df, ["k", "j"], "id")
    assert first.columns == df.columns
    assert sorted((r.id, r.v) for r in first.collect()) == [(1, "x"), (3, "z"), (4, "u")]
    assert ids(keys.keep_smallest_id(df, "k", "id"), "id") == [1, 3, 4]
    assert keys.duplicate_members(df, ["k"]).first().n == 4


def test_number_rows(spark):
    df = spark.range(0, 5000, 1, 7).select(
        F.xxhash64("id").alias("h"), (F.col("id") % 3).alias("day"), F.col("id").alias("source")
    )
    numbered = keys.number_rows(df.orderBy("day", "h"), "n", run_folder(spark, "numbers"))
    got = [(r.day, r.h) for r in numbered.orderBy("n").collect()]
    assert got == sorted(got)
    assert ids(numbered, "n") == list(range(1, 5001))


def test_flags(raw):
    users = {r.user_id: r for r in corrections.flag_users(raw["users"], AS_OF).collect()}
    assert sorted(u for u, r in users.items() if r.is_duplicate) == [5, 8, 10]
    assert [u for u, r in users.items() if r.is_test] == [7]
    free = corrections.flag_courses(raw["courses"]).filter("is_free = 1")
    assert ids(free, "course_id") == [4]
    guests = corrections.flag_attempts(raw["payment_attempts"], raw["users"]).filter("is_guest = 1")
    assert ids(guests, "attempt_id") == [7]
    issues = corrections.flag_ad_costs(raw["ad_costs"]).filter("data_quality_issue = 1")
    assert issues.count() == 1


def test_quarantine_is_the_complement(raw, staged):
    left_out = corrections.quarantine(raw["payments"], staged["payments"], "payment_id")
    assert ids(left_out, "payment_id") == [5, 6, 8, 10, 11, 13]


def test_refunds(raw):
    rows = {r.payment_id: r for r in corrections.split_refunds(raw["payments"]).collect()}
    assert rows[5].transaction_type == "refund" and rows[5].amount_rub == 4000
    assert 6 not in rows and 14 not in rows and 12 not in rows
    march = corrections.net_revenue(raw["payments"]).filter("period = '2024-03-01'").first()
    assert (march.revenue, march.refunds, march.net_revenue) == (7000, 4000, 3000)


def test_to_utc(spark):
    df = spark.sql("SELECT TIMESTAMP_NTZ'2024-01-01 02:00:00' AS t")
    assert corrections.to_utc(df, ["t"], "Europe/Moscow").first().t == dt.datetime(2023, 12, 31, 23)


def test_unknown_values(raw):
    found = corrections.unknown_values(raw["enrollments"], corrections.DOMAINS["enrollments"])
    assert sorted((r.value or "", r.n) for r in found.collect()) == [("", 1), ("archived", 1)]


def snapshots(spark, rows):
    stamp = "%Y-%m-%d %H:%M"
    data = [(k, dt.datetime.strptime(t, stamp), price) for k, t, price in rows]
    return spark.createDataFrame(data, "k int, at timestamp_ntz, price int")


def test_history(spark):
    df = snapshots(spark, [
        (1, "2024-01-01 00:00", 10),
        (1, "2024-01-02 00:00", 10),
        (1, "2024-02-01 08:00", 11),
        (1, "2024-02-01 09:00", 12),
        (1, "2024-03-01 00:00", None),
        (1, "2024-04-01 00:00", 12),
        (2, "2024-01-05 00:00", 7),
    ])
    versions = history.build_history(df, "k", ["price"], "at").orderBy("k", "valid_from").collect()
    assert [(r.k, r.price, r.valid_from.strftime("%m-%d %H"), r.is_current) for r in versions] == [
        (1, 10, "01-01 00", False),
        (1, 11, "02-01 08", False),
        (1, 12, "02-01 09", False),
        (1, None, "03-01 00", False),
        (1, 12, "04-01 00", True),
        (2, 7, "01-05 00", True),
    ]
    assert versions[0].valid_to == versions[1].valid_from
    assert versions[-1].valid_to.year == 9999


def test_snapshots_without_a_time(spark):
    df = snapshots(spark, [(1, "2024-01-01 00:00", 10)])
    undated = spark.createDataFrame([(1, None, 5)], df.schema)
    versions = history.build_history(df.unionByName(undated), "k", ["price"], "at").collect()
    assert [(r.price, r.is_current) for r in versions] == [(10, True)]


@pytest.mark.parametrize("seed", range(2))
def test_join_at_time_against_brute_force(spark, seed):
    draw = random.Random(seed)
    start = dt.datetime(2024, 1, 1)
    moment = lambda: start + dt.timedelta(minutes=draw.randrange(0, 400 * 1440))
    # Key 0 holds a third of all rows on both sides.
    key = lambda: 0 if draw.random() < 0.34 else draw.randrange(1, 6)
    shots = [(key(), moment(), draw.randrange(3)) for _ in range(150)]
    events = [(i, key(), moment()) for i in range(300)]
    versions = history.build_history(
        spark.createDataFrame(shots, "k int, at timestamp_ntz, price int"), "k", ["price"], "at"
    )
    frame = spark.createDataFrame(events, "id int, k int, t timestamp_ntz")
    spans = [(r.k, r.price, r.valid_from, r.valid_to) for r in versions.collect()]
    expected = {
        i: next((p for vk, p, a, b in spans if vk == k and a <= t < b), None) for i, k, t in events
    }
    left = history.join_at_time(frame, versions, "k", "t", "left").collect()
    assert {r.id: r.price for r in left} == expected and len(left) == len(events)
    matched = {i for i, p in expected.items() if p is not None}
    semi = history.join_at_time(frame, versions, "k", "t", "left_semi")
    assert {r.id for r in semi.collect()} == matched
    anti = history.join_at_time(frame, versions, "k", "t", "left_anti")
    assert {r.id for r in anti.collect()} == set(expected) - matched


def test_point_in_time_join_rejects_other_types(spark):
    df = snapshots(spark, [(1, "2024-01-01 00:00", 10)])
    with pytest.raises(ValueError):
        history.join_at_time(df, df, "k", "at", "cross")


@pytest.mark.parametrize("seed", range(3))
def test_unconfirmed_against_brute_force(spark, seed):
    draw = random.Random(seed)
    start = dt.datetime(2024, 1, 1)

    def moment():
        return start + dt.timedelta(microseconds=draw.randrange(0, 2 * 3600 * 10**6))

    def pair():
        return (1, 1) if draw.random() < 0.4 else (draw.randrange(4), draw.randrange(4))

    attempts = [(i, *pair(), moment(), draw.choice(["success", "failed"]), None, "card") for i in range(120)]
    paid = [(i, *pair(), 1, moment(), 1, 1, 0, "success", "card") for i in range(60)]
    # Exactly on the limit, and just past it.
    attempts += [(900, 8, 8, start, "success", None, "card"), (901, 9, 9, start, "success", None, "card")]
    limit = dt.timedelta(minutes=5)
    paid += [
        (900, 8, 8, 1, start + limit, 1, 1, 0, "success", "card"),
        (901, 9, 9, 1, start + limit + dt.timedelta(microseconds=1), 1, 1, 0, "success", "card"),
    ]
    expected = sorted(
        a[0] for a in attempts if a[4] == "success" and not any(
            p[1] == a[1] and p[2] == a[2] and a[3] <= p[4] <= a[3] + limit for p in paid
        )
    )
    got = reconcile.unconfirmed_attempts(
        spark.createDataFrame(attempts, S.SCHEMAS["payment_attempts"]),
        spark.createDataFrame(paid, S.SCHEMAS["payments"]),
    )
    assert ids(got, "attempt_id") == expected
    assert 900 not in expected and 901 in expected


def test_null_email_hot_group(spark):
    """A third of the users share no e-mail at all: one of them is kept."""
    users = spark.range(3000).select(
        F.col("id").alias("user_id"),
        F.when(F.col("id") % 3 != 0, F.concat(F.lit("u"), "id")).alias("email"),
        F.lit("2024-01-01").cast("timestamp_ntz").alias("registered_at"),
    )
    assert stage_users(users, AS_OF).count() == 2001


def test_versions_within_a_day_and_a_hot_key(spark):
    day = [(1, f"2024-01-01 {h:02d}:00", p) for h, p in ((8, 100), (12, 200), (18, 100))]
    hot = [(2, f"2024-0{1 + i % 4}-{1 + i % 27:02d} {i % 24:02d}:00", i % 3) for i in range(400)]
    versions = history.build_history(snapshots(spark, day + hot), "k", ["price"], "at").collect()
    assert [r.price for r in sorted(versions, key=lambda r: r.valid_from) if r.k == 1] == [100, 200, 100]
    states = {}
    for k, t, price in hot:
        states[t] = max(price, states.get(t, -1))
    expected, last = [], None
    for t in sorted(states):
        if states[t] != last:
            expected.append((t, states[t]))
            last = states[t]
    found = sorted((r.valid_from, r.price, r.valid_to) for r in versions if r.k == 2)
    assert [(t.strftime("%Y-%m-%d %H:%M"), p) for t, p, _ in found] == expected
    assert all(a[2] == b[0] for a, b in zip(found, found[1:]))


def test_keep_first_without_order_value(spark):
    df = spark.createDataFrame([(1, None, "a"), (2, None, "b"), (2, 5, "c")], "k int, o int, v string")
    assert sorted(map(tuple, keys.keep_first(df, ["k"], "o").collect())) == [(1, None, "a"), (2, 5, "c")]


def test_reasons_of_every_row(raw, staged):
    judged = reasons.judge_all(raw, staged, AS_OF)
    for table, df in judged.items():
        assert df.count() == raw[table].count()
        kept = sorted(map(repr, map(tuple, reasons.kept(df).collect())))
        assert kept == sorted(map(repr, map(tuple, staged[table].collect())))

    def broken(table, key):
        rows = reasons.quarantined(judged[table]).collect()
        return {r[key]: r.broken_rules for r in rows}

    users = broken("users", "user_id")
    assert users[5] == "duplicate_email" and users[10] == "duplicate_email"
    assert users[7] == "registered_later" and users[8] == "duplicate_email"
    enrollments = broken("enrollments", "enrollment_id")
    assert enrollments[6] == "before_registration" and enrollments[8] == "course_not_staged"
    assert enrollments[10] == "user_not_staged" and enrollments[11] == "user_not_staged"
    counts = reasons.reason_counts(judged).collect()
    for table, df in raw.items():
        of_table = {r.broken_rules: r.row_count for r in counts if r.table_name == table}
        assert sum(of_table.values()) == df.count()
        assert of_table.get("", 0) == staged[table].count()
    for r in reasons.rule_counts(judged).collect():
        texts = broken(r.table_name, raw[r.table_name].columns[0]).values()
        if r.table_name != "ad_costs":
            assert r.rows == sum(r.rule in t.split(",") for t in texts)
            assert r.rows_alone == sum(r.rule == t for t in texts)


def test_missing_values_break_the_rule_they_are_needed_for(spark):
    user = spark.createDataFrame(
        [(1, "a", 1, "c", "organic", None, 1), (2, "b", 1, "c", "organic", dt.datetime(2024, 1, 1), 1)],
        S.SCHEMAS["users"],
    )
    judged = reasons.judge_users(user, AS_OF)
    assert {r.user_id: r.broken_rules for r in judged.collect()} == {1: ["registered_later"], 2: []}
    staged_users = reasons.kept(judged)
    courses = spark.createDataFrame(
        [(1, "t", "s", "l", "k", 1, 1.0, None, 1)], S.SCHEMAS["courses"]
    )
    rows = [(1, 2, 1, None, "active", 1), (2, None, None, None, None, None)]
    enrollments = spark.createDataFrame(rows, S.SCHEMAS["enrollments"])
    found = reasons.judge_enrollments(enrollments, staged_users, courses).collect()
    assert {r.enrollment_id: r.broken_rules for r in found} == {
        1: ["before_registration"], 2: ["user_not_staged", "course_not_staged"],
    }
    ads = spark.createDataFrame([(None, "vk_ads", None, 1, 0)], S.SCHEMAS["ad_costs"])
    assert reasons.judge_ad_costs(ads, AS_OF).first().broken_rules == ["spend_lost", "dated_later"]
    assert stage_ad_costs(ads, AS_OF).count() == 0


def test_members_as_bitmaps(spark):
    rng = random.Random(6)
    start = dt.datetime(2024, 1, 29)
    ids = [-40_000, -1, 0, 1, 32_767, 32_768, 32_769, 10**9, None]
    rows = [(rng.choice(ids), start + dt.timedelta(hours=rng.randrange(24 * 20))) for _ in range(150)]
    facts = spark.createDataFrame(rows, "user_id long, at timestamp_ntz")
    loads = [spark.createDataFrame(part, facts.schema) for part in (rows[:70], rows[70:])]
    days = distinct.merged(*[distinct.daily_members(f, "user_id", "at") for f in loads])
    for grain, df in {
        "day": days, "week": distinct.rolled_up(days, "week"), "month": distinct.rolled_up(days, "month"),
    }.items():
        expected = facts.groupBy(period_start("at", grain).alias("period")).agg(
            F.countDistinct("user_id").alias("n")
        )
        assert sorted(distinct.counted(df, "n").collect()) == sorted(expected.collect())


def test_tables_are_judged_alone(raw, staged):
    asked = []

    class Asked(dict):
        def __getitem__(self, table):
            asked.append(table)
            return super().__getitem__(table)

    judged = reasons.judge_all(raw, Asked(staged), AS_OF)
    assert reasons.quarantined(judged["ad_costs"]).count() > 0 and asked == []
    judged["enrollments"]
    assert asked == ["users", "courses"]
    assert list(judged) == list(raw) and "orders" not in judged


def test_months_of_a_history_are_not_joined(spark):
    days = [(k, f"2024-0{1 + i}-1{k} 00:00", i % 2) for k in (1, 2) for i in range(4)]
    versions = history.build_history(snapshots(spark, days), "k", ["price"], "at")
    assert versions.count() == 8
    plan = versions._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Union" in plan
