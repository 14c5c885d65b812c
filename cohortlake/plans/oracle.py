"""The registered queries as plain SQL over the source tables.

Written apart from the Spark plans: joins, windows and filters follow the
definitions directly and share no code with them but the as-of time.
"""

from cohortlake.operators.quality import CHECKS, RULES
from cohortlake.sources.bindings import AS_OF

# The six logical tables.
_TABLES = {
    "users": """
  SELECT c_custkey AS user_id,
         CASE WHEN c_custkey % 100 = 57 THEN NULL
              ELSE 'user' || CAST(c_custkey - CASE WHEN c_custkey % 20 = 19 THEN 1 ELSE 0 END AS VARCHAR)
                   || '@example.org' END AS email,
         CAST(14 + c_custkey % 20 AS INTEGER) AS age,
         'city' || CAST(c_nationkey AS VARCHAR) AS city,
         CASE WHEN c_custkey % 50 = 11 THEN NULL
              WHEN c_mktsegment = 'BUILDING' THEN 'vk_ads'
              WHEN c_mktsegment = 'AUTOMOBILE' THEN 'yandex_direct'
              WHEN c_mktsegment = 'MACHINERY' THEN 'telegram'
              WHEN c_mktsegment = 'HOUSEHOLD' THEN 'organic'
              WHEN c_mktsegment = 'FURNITURE' THEN 'referral' END AS channel,
         TIMESTAMP '1995-01-01' + to_days(CAST(c_custkey * 37 % 1800 AS INTEGER)) AS registered_at,
         CAST(CASE WHEN c_acctbal > 0 THEN 1 ELSE 0 END AS INTEGER) AS is_active
  FROM customer""",
    "courses": """
  SELECT p_partkey AS course_id, p_name AS title, p_brand AS subject,
         CASE WHEN p_size < 17 THEN 'Базовый' WHEN p_size < 34 THEN 'Продвинутый'
              ELSE 'Эксперт' END AS level,
         CASE WHEN p_type IN ('STANDARD', 'ECONOMY') THEN 'Курс'
              WHEN p_type IN ('SMALL', 'MEDIUM') THEN 'Интенсив'
              WHEN p_type IN ('LARGE', 'PROMO') THEN 'Подписка' END AS course_type,
         CASE WHEN p_partkey % 40 = 7 THEN 0 ELSE CAST(floor(p_retailprice) AS BIGINT) END AS price_rub,
         CASE WHEN p_type IN ('LARGE', 'PROMO') THEN NULL
              ELSE CAST(p_size % 9 + 4 AS DOUBLE) END AS duration_weeks,
         TIMESTAMP '1994-01-01' + to_days(CAST(p_partkey % 300 AS INTEGER)) AS created_at,
         CAST(CASE WHEN p_size % 10 = 0 THEN 0 ELSE 1 END AS INTEGER) AS is_published
  FROM part""",
    "order_courses": """
  SELECT o.*, f.first_part
  FROM orders o
  LEFT JOIN (SELECT l_orderkey, min(l_partkey) AS first_part FROM lineitem GROUP BY l_orderkey) f
    ON f.l_orderkey = o.o_orderkey""",
    "enrollments": """
  SELECT o_orderkey AS enrollment_id, o_custkey AS user_id,
         CASE WHEN o_orderkey % 211 = 9 THEN -o_orderkey ELSE first_part END AS course_id,
         o_orderdate AS enrolled_at,
         CASE o_orderkey % 97 WHEN 5 THEN 'archived' WHEN 6 THEN 'paused' WHEN 7 THEN NULL
              ELSE CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'O' THEN 'active'
                                      WHEN 'P' THEN 'dropped' END END AS status,
         CAST(o_orderkey % 101 AS INTEGER) AS progress_pct
  FROM order_courses""",
    "payments": """
  SELECT l_orderkey * 10 + l_linenumber AS payment_id, o_custkey AS user_id,
         l_partkey AS course_id,
         CASE WHEN l_suppkey % 50 = 3 THEN -l_orderkey ELSE l_orderkey END AS enrollment_id,
         CASE WHEN l_linenumber <= 2
              THEN o_orderdate + CAST(l_quantity * 12 AS INTEGER) * INTERVAL 1 SECOND
              ELSE l_shipdate END AS paid_at,
         CASE WHEN l_returnflag = 'A' AND l_tax = CAST(0.08 AS DOUBLE)
              THEN -CAST(floor(l_extendedprice) AS BIGINT)
              WHEN l_suppkey % 50 = 7 THEN 0
              ELSE CAST(floor(l_extendedprice) AS BIGINT) END AS amount_rub,
         CAST(floor(l_extendedprice) AS BIGINT) AS base_price,
         CAST(round(l_discount * 100) AS INTEGER) AS discount_pct,
         CASE WHEN l_returnflag = 'R' THEN 'refunded' WHEN l_suppkey % 50 = 11 THEN 'failed'
              ELSE 'success' END AS status,
         CASE l_linenumber % 3 WHEN 0 THEN 'card' WHEN 1 THEN 'sbp' ELSE 'wallet' END AS payment_method
  FROM lineitem JOIN orders ON o_orderkey = l_orderkey""",
    "payment_attempts": """
  SELECT u.*,
         CASE result WHEN 'failed' THEN 'card_declined' WHEN 'abandoned' THEN 'user_cancelled'
              END AS failure_reason,
         CASE attempt_id % 3 WHEN 0 THEN 'card' WHEN 1 THEN 'sbp' ELSE 'wallet' END AS payment_method
  FROM (SELECT event_id * 2 AS attempt_id,
               CASE WHEN event_id % 40 = 13 THEN -event_id ELSE user_id END AS user_id,
               event_id % 200 AS course_id,
               ts - INTERVAL 8980 DAY AS attempted_at,
               CASE event_type WHEN 'purchase' THEN 'success' WHEN 'error' THEN 'failed'
                    WHEN 'view' THEN 'abandoned' WHEN 'click' THEN 'click' END AS result
        FROM events
        UNION ALL
        SELECT o_orderkey * 2 + 1, o_custkey, first_part, o_orderdate, 'success'
        FROM order_courses) u""",
    "ad_costs": """
  SELECT CAST(l_shipdate AS DATE) AS date,
         CASE l_suppkey % 5 WHEN 0 THEN 'vk_ads' WHEN 1 THEN 'yandex_direct' WHEN 2 THEN 'telegram'
              WHEN 3 THEN 'organic' ELSE 'referral' END AS channel,
         CAST(100 * sum(CAST(floor(l_quantity) AS BIGINT)) AS BIGINT) AS impressions,
         count(*) AS clicks,
         CAST(CASE WHEN l_suppkey % 5 = 2 AND day(CAST(l_shipdate AS DATE)) = 13 THEN 0
              ELSE sum(CAST(floor(l_extendedprice * l_tax) AS BIGINT)) END AS BIGINT) AS spend_rub
  FROM lineitem GROUP BY CAST(l_shipdate AS DATE), l_suppkey % 5""",
}

# The staging rules.
_STAGED = {
    "stg_users": f"""
  SELECT * FROM users
  WHERE registered_at <= TIMESTAMP '{AS_OF}'
    AND user_id IN (SELECT min(user_id) FROM users GROUP BY email)""",
    "stg_courses": "SELECT * FROM courses WHERE is_published = 1",
    "stg_enrollments": """
  SELECT e.* FROM enrollments e, stg_users u, stg_courses c
  WHERE e.user_id = u.user_id AND e.course_id = c.course_id AND e.enrolled_at >= u.registered_at""",
    "stg_payments": """
  SELECT p.* FROM payments p, stg_users u, stg_enrollments e
  WHERE p.user_id = u.user_id AND p.enrollment_id = e.enrollment_id
    AND p.paid_at >= u.registered_at AND p.amount_rub > 0""",
    "stg_payment_attempts": """
  SELECT a.* FROM payment_attempts a
  WHERE a.user_id IN (SELECT user_id FROM stg_users)
    AND (a.result IN ('failed', 'abandoned')
         OR (a.result = 'success'
             AND EXISTS (SELECT 1 FROM stg_payments p
                         WHERE p.user_id = a.user_id AND p.course_id = a.course_id)))""",
    "stg_ad_costs": f"""
  SELECT * FROM ad_costs
  WHERE (spend_rub <> 0 OR impressions <= 0) AND date <= DATE '{AS_OF[:10]}'
    AND channel IN ('vk_ads', 'yandex_direct', 'telegram')""",
}

_NAMED = _TABLES | _STAGED


def _broken(**rules: str) -> str:
    """Names of the conditions that do not hold, in order."""
    names = [f"CASE WHEN NOT coalesce({holds}, false) THEN '{n}' END" for n, holds in rules.items()]
    return f"concat_ws(',', {', '.join(names)})"


_USER_STAGED = "EXISTS (SELECT 1 FROM stg_users u WHERE u.user_id = t.user_id)"


def _since_registered(moment: str) -> str:
    return (
        f"NOT {_USER_STAGED} OR {moment} >= "
        "(SELECT max(registered_at) FROM stg_users u WHERE u.user_id = t.user_id)"
    )


# The broken staging rules of every raw row.
_BROKEN = {
    "users": _broken(
        duplicate_email="user_id IN (SELECT min(user_id) FROM users GROUP BY email)",
        registered_later=f"registered_at <= TIMESTAMP '{AS_OF}'",
    ),
    "courses": _broken(unpublished="is_published = 1"),
    "enrollments": _broken(
        user_not_staged=_USER_STAGED,
        before_registration=_since_registered("enrolled_at"),
        course_not_staged="EXISTS (SELECT 1 FROM stg_courses c WHERE c.course_id = t.course_id)",
    ),
    "payments": _broken(
        amount_not_positive="amount_rub > 0",
        user_not_staged=_USER_STAGED,
        before_registration=_since_registered("paid_at"),
        enrollment_not_staged="""EXISTS (SELECT 1 FROM stg_enrollments e
            WHERE e.enrollment_id = t.enrollment_id)""",
    ),
    "payment_attempts": _broken(
        user_not_staged=_USER_STAGED,
        unknown_result="result IN ('success', 'failed', 'abandoned')",
        success_without_payment="""coalesce(result, '') <> 'success' OR EXISTS (
            SELECT 1 FROM stg_payments p
            WHERE p.user_id = t.user_id AND p.course_id = t.course_id)""",
    ),
    "ad_costs": _broken(
        spend_lost="NOT (spend_rub = 0 AND impressions > 0)",
        dated_later=f"date <= DATE '{AS_OF[:10]}'",
        channel_not_paid="channel IN ('vk_ads', 'yandex_direct', 'telegram')",
    ),
}
_JUDGED = {f"judged_{t}": f"SELECT t.*, {b} AS broken_rules FROM {t} t" for t, b in _BROKEN.items()}


def _with(select: str, **more: str) -> str:
    """The statement after the table definitions and further named queries."""
    parts = [f"{name} AS ({body})" for name, body in (_NAMED | more).items()]
    return "WITH " + ",\n".join(parts) + "\n" + select.strip()


def _month(column: str) -> str:
    return f"CAST(date_trunc('month', {column}) AS DATE)"


def _period(column: str, grain: str) -> str:
    return f"CAST(date_trunc('{grain}', {column}) AS DATE)"


def _pct(part: str, whole: str, digits: int = 1) -> str:
    return f"round(100.0::DOUBLE * ({part}) / nullif({whole}, 0), {digits})"


def _int(expression: str) -> str:
    return f"CAST({expression} AS BIGINT)"


def _revenue(grain: str = "month") -> str:
    """Revenue per period before the trend."""

    def of(product):
        return _int(f"coalesce(sum(amount_rub) FILTER (course_type = '{product}'), 0)")

    return f"""
  SELECT {_period('paid_at', grain)} AS payment_month,
         count(DISTINCT user_id) AS paying_users, count(*) AS transactions,
         {_int('sum(amount_rub)')} AS revenue, round(avg(amount_rub), 0) AS avg_check,
         round(CAST(sum(amount_rub) AS DOUBLE) / count(DISTINCT user_id), 0) AS arpu,
         {of('Подписка')} AS mrr,
         {_pct('count(*) FILTER (discount_pct > 0)', 'count(*)')} AS discount_rate_pct,
         {of('Курс')} AS revenue_courses, {of('Интенсив')} AS revenue_intensive,
         {of('Подписка')} AS revenue_subscription
  FROM stg_payments JOIN stg_courses USING (course_id) WHERE status = 'success' GROUP BY ALL"""


_MART_REVENUE = f"""
  SELECT r.*, p.revenue AS revenue_prev_month,
         {_pct('r.revenue - p.revenue', 'p.revenue')} AS revenue_mom_pct,
         {_int('(SELECT sum(revenue) FROM months s WHERE s.n <= r.n)')} AS revenue_cumulative
  FROM months r LEFT JOIN months p ON p.n = r.n - 1"""
_MONTHS = "SELECT *, row_number() OVER (ORDER BY payment_month) AS n FROM revenue_months"
_REVENUE_PARTS = {
    "revenue_months": _revenue(),
    "months": _MONTHS,
    "mart_revenue": f"SELECT * EXCLUDE (n) FROM ({_MART_REVENUE})",
}


def _ads(grain: str) -> str:
    ad, reg, paid = (_period(c, grain) for c in ("date", "registered_at", "paid_at"))
    return f"""
  SELECT a.month, a.channel, a.spend, a.impressions, a.clicks,
         coalesce(r.registrations, 0) AS registrations, coalesce(p.paying_users, 0) AS paying_users,
         coalesce(p.revenue, 0) AS revenue_from_channel,
         {_pct('clicks', 'impressions', 2)} AS ctr_pct,
         round(a.spend::DOUBLE / nullif(clicks, 0), 0) AS cpc,
         round(1000.0::DOUBLE * a.spend / nullif(impressions, 0), 0) AS cpm,
         round(a.spend::DOUBLE / nullif(p.paying_users, 0), 0) AS cac,
         round(coalesce(p.revenue, 0)::DOUBLE / nullif(a.spend, 0), 2) AS roas
  FROM (SELECT {ad} AS month, channel, {_int('sum(spend_rub)')} AS spend,
               {_int('sum(impressions)')} AS impressions, {_int('sum(clicks)')} AS clicks
        FROM stg_ad_costs GROUP BY ALL) a
  LEFT JOIN (SELECT {reg} AS month, channel, count(*) AS registrations
             FROM stg_users GROUP BY ALL) r USING (month, channel)
  LEFT JOIN (SELECT {paid} AS month, channel, count(DISTINCT user_id) AS paying_users,
                    {_int('sum(amount_rub)')} AS revenue
             FROM stg_payments JOIN stg_users USING (user_id)
             WHERE status = 'success' GROUP BY ALL) p USING (month, channel)"""


_ACTIVITY = f"""
  SELECT cohort_month, number AS month_number, first(size) AS cohort_size,
         count(DISTINCT user_id) AS retained_users,
         {_pct('count(DISTINCT user_id)', 'first(size)')} AS retention_rate_pct
  FROM (SELECT e.user_id, c.cohort_month, s.size,
               datediff('month', c.cohort_month, {_month('e.enrolled_at')}) AS number
        FROM stg_enrollments e
        JOIN cohorts c ON c.user_id = e.user_id
        JOIN (SELECT cohort_month, count(*) AS size FROM cohorts GROUP BY ALL) s
          ON s.cohort_month = c.cohort_month)
  GROUP BY cohort_month, number"""
_ACTIVITY_PARTS = {
    "cohorts": f"SELECT user_id, min({_month('enrolled_at')}) AS cohort_month FROM stg_enrollments GROUP BY user_id",
    "activity": _ACTIVITY,
}


def _funnel(grain: str) -> str:
    return f"""
  SELECT cohort_month, count(*) AS registered,
         {_int('sum(enrolled)')} AS enrolled, {_int('sum(paid)')} AS paid,
         {_int('sum(completed)')} AS completed,
         {_pct('sum(enrolled)', 'count(*)')} AS cvr_reg_to_enroll_pct,
         {_pct('sum(paid)', 'sum(enrolled)')} AS cvr_enroll_to_paid_pct,
         {_pct('sum(completed)', 'sum(paid)')} AS cvr_paid_to_completed_pct,
         {_pct('sum(paid)', 'count(*)', 2)} AS overall_cvr_pct,
         {_int('sum(tries)')} AS payment_attempts_total,
         {_int('sum(gave_up)')} AS payment_attempts_abandoned,
         {_pct('sum(gave_up)', 'sum(tries)')} AS payment_dropoff_pct
  FROM (SELECT {_period('registered_at', grain)} AS cohort_month,
               CAST(user_id IN (SELECT user_id FROM stg_enrollments) AS INTEGER) AS enrolled,
               CAST(user_id IN (SELECT user_id FROM stg_payments WHERE status = 'success') AS INTEGER) AS paid,
               CAST(user_id IN (SELECT user_id FROM stg_enrollments WHERE status = 'completed') AS INTEGER)
                 AS completed,
               (SELECT count(*) FROM stg_payment_attempts a WHERE a.user_id = u.user_id) AS tries,
               (SELECT count(*) FROM stg_payment_attempts a
                WHERE a.user_id = u.user_id AND a.result = 'abandoned') AS gave_up
        FROM stg_users u) GROUP BY cohort_month"""


# Counts per check over tables with a given prefix.


def _check_counts(prefix: str) -> str:
    users, courses, enrollments, payments, attempts, ads = (
        prefix + t
        for t in ("users", "courses", "enrollments", "payments", "payment_attempts", "ad_costs")
    )
    rows = {
        "A1": f"""{users} u WHERE EXISTS (SELECT 1 FROM {users} v
                  WHERE v.email IS NOT DISTINCT FROM u.email AND v.user_id <> u.user_id)""",
        "A2": f"{users} WHERE registered_at > TIMESTAMP '{AS_OF}'",
        "A3": f"{users} WHERE channel IS NULL",
        "A4": f"{courses} WHERE price_rub = 0",
        "A5": f"{courses} WHERE is_published = 0",
        "A6": f"{enrollments} e JOIN {users} u USING (user_id) WHERE e.enrolled_at < u.registered_at",
        "A7": f"""{enrollments} WHERE status IS NULL
                  OR status NOT IN ('active', 'completed', 'dropped', 'paused')""",
        "A8": f"{enrollments} WHERE progress_pct = 100 AND status IS DISTINCT FROM 'completed'",
        "A9": f"{enrollments} e ANTI JOIN {courses} c ON c.course_id = e.course_id",
        "A10": f"{payments} WHERE amount_rub < 0",
        "A11": f"{payments} WHERE amount_rub = 0 AND status = 'success'",
        "A12": f"{payments} p JOIN {users} u USING (user_id) WHERE p.paid_at < u.registered_at",
        "A13": f"""{payments} p JOIN {courses} c USING (course_id)
                   WHERE c.price_rub = 0 AND p.amount_rub > 0""",
        "A14": f"{payments} p ANTI JOIN {enrollments} e ON e.enrollment_id = p.enrollment_id",
        "A15": f"{attempts} a ANTI JOIN {users} u ON u.user_id = a.user_id",
        "A16": f"""(SELECT * FROM {attempts} WHERE result = 'success') a
                   ANTI JOIN {payments} p ON p.user_id = a.user_id AND p.course_id = a.course_id""",
        "A17": f"""{attempts} WHERE result IS NULL OR result NOT IN ('success', 'failed', 'abandoned')""",
        "A18": f"{ads} WHERE spend_rub = 0 AND impressions > 0",
        "A19": f"{ads} WHERE CAST(date AS TIMESTAMP) > TIMESTAMP '{AS_OF}'",
        "A20": f"""{ads} WHERE channel IS NULL
                   OR channel NOT IN ('vk_ads', 'yandex_direct', 'telegram')""",
    }
    return _code_rows(rows, CHECKS)


def _code_rows(rows: dict[str, str], details: dict) -> str:
    return "\nUNION ALL ".join(
        f"SELECT '{code}' AS code, '{details[code][0]}' AS table_name,"
        f" '{details[code][1]}' AS severity, count(*) AS n FROM {source}"
        for code, source in rows.items()
    )


_RULE_COUNTS = _code_rows(
    {
        "X1": "enrollments e ANTI JOIN users u ON u.user_id = e.user_id",
        "X2": "payments p ANTI JOIN users u ON u.user_id = p.user_id",
        "X3": "payments p ANTI JOIN courses c ON c.course_id = p.course_id",
        "X4": "payments p JOIN enrollments e USING (enrollment_id) WHERE p.paid_at < e.enrolled_at",
        "X5": """(SELECT a.attempt_id, count(p.payment_id) AS paid FROM payment_attempts a
                  LEFT JOIN payments p ON p.user_id = a.user_id AND p.course_id = a.course_id
                  WHERE a.result = 'success' GROUP BY a.attempt_id) WHERE paid <> 1""",
    },
    RULES,
)

_CHECK_PARTS = {"before_run": _check_counts(""), "after_run": _check_counts("stg_")}
_RAW_RUN = {"before_run": _CHECK_PARTS["before_run"]}
_PAIRED = {
    **_CHECK_PARTS,
    "paired": """SELECT b.code, b.n AS before_n, a.n AS after_n
                 FROM before_run b JOIN after_run a ON a.code = b.code""",
}
_CHANGE = "round_even((after_n - before_n)::DOUBLE / nullif(before_n, 0) * 100, 0)"


def _totals(scope: str, where: str) -> str:
    return f"""
  SELECT '{scope}' AS scope, {_int('sum(before_n)')} AS before_n, {_int('sum(after_n)')} AS after_n,
         count(*) FILTER (before_n > 0 AND after_n = 0) AS checks_removed,
         count(*) FILTER (after_n > 0) AS checks_remaining,
         {_int('sum(before_n) - sum(after_n)')} AS removed_n,
         round_even((sum(after_n) - sum(before_n))::DOUBLE / nullif(sum(before_n), 0) * 100, 0) AS change_pct
  FROM paired WHERE {where}"""


_SOLD = """
  SELECT p.*, c.title, c.subject, c.course_type
  FROM stg_payments p JOIN stg_courses c ON c.course_id = p.course_id WHERE p.status = 'success'"""

_IDLE = f"""
  SELECT e.user_id, u.email, e.enrollment_id, c.title, e.progress_pct, e.status, e.enrolled_at,
         l.last_activity,
         CAST(DATE '{AS_OF[:10]}' - CAST(l.last_activity AS DATE) AS INTEGER) AS days_idle
  FROM stg_enrollments e
  JOIN stg_users u ON u.user_id = e.user_id
  JOIN stg_courses c ON c.course_id = e.course_id
  JOIN (SELECT user_id, max(enrolled_at) AS last_activity FROM stg_enrollments GROUP BY user_id) l
    ON l.user_id = e.user_id
  WHERE e.status = 'active'"""
_AT_RISK = f"""
  SELECT *, days_idle > 7 AS is_idle,
         progress_pct < 20 AND DATE '{AS_OF[:10]}' - CAST(enrolled_at AS DATE) > 30 AS is_slow
  FROM idle
  WHERE days_idle > 7
     OR (progress_pct < 20 AND DATE '{AS_OF[:10]}' - CAST(enrolled_at AS DATE) > 30)"""

_HISTORY = """
  SELECT course_id, price_rub, is_published, observed_at AS valid_from,
         coalesce(lead(observed_at) OVER w, TIMESTAMP '9999-12-31') AS valid_to,
         lead(observed_at) OVER w IS NULL AS is_current
  FROM (SELECT *, lag((price_rub, is_published)) OVER (PARTITION BY course_id ORDER BY observed_at) AS prev
        FROM (SELECT l_partkey AS course_id, l_shipdate AS observed_at,
                     CAST(floor(l_discount * 100 / 4) * 500 + 1000 AS BIGINT) AS price_rub,
                     CAST(CASE WHEN l_returnflag = 'R' THEN 0 ELSE 1 END AS INTEGER) AS is_published
              FROM lineitem WHERE l_shipdate IS NOT NULL
              QUALIFY row_number() OVER (PARTITION BY l_partkey, l_shipdate
                                         ORDER BY price_rub DESC, is_published DESC) = 1))
  WHERE prev IS DISTINCT FROM (price_rub, is_published)
  WINDOW w AS (PARTITION BY course_id ORDER BY observed_at)"""


def _operations() -> str:
    today = f"DATE '{AS_OF[:10]}'"
    starts = {
        "day": today,
        "week": f"CAST(date_trunc('week', {today}) AS DATE)",
        "month": f"CAST(date_trunc('month', {today}) AS DATE)",
    }
    rows = {}
    for name, table, moment in (
        ("registrations", "stg_users", "registered_at"),
        ("enrollments", "stg_enrollments", "enrolled_at"),
    ):
        for span, start in starts.items():
            rows[f"{name}_{span}"] = (
                f"SELECT count(*) FROM {table}"
                f" WHERE CAST({moment} AS DATE) BETWEEN {start} AND {today}"
            )
    paid = f"stg_payments WHERE status = 'success' AND CAST(paid_at AS DATE) = {today}"
    rows["payments_day"] = f"SELECT count(*) FROM {paid}"
    rows["payments_day_rub"] = f"SELECT coalesce(sum(amount_rub), 0) FROM {paid}"
    share = _pct("count(*) FILTER (result = 'abandoned')", "count(*)")
    rows["dropoff_7d_pct"] = (
        f"SELECT {share} FROM stg_payment_attempts"
        f" WHERE CAST(attempted_at AS DATE) BETWEEN {today} - 6 AND {today}"
    )
    rows["students_at_risk"] = f"SELECT count(DISTINCT user_id) FROM ({_AT_RISK})"
    return "\nUNION ALL ".join(
        f"SELECT '{name}' AS metric, CAST(({value}) AS DOUBLE) AS value"
        for name, value in rows.items()
    )


def _counts_of(layer: str, tables: list[str]) -> list[str]:
    return [
        f"SELECT '{layer}' AS layer, '{t}' AS table_name, count(*) AS row_count FROM {t}"
        for t in tables
    ]


_RAW_NAMES = ["users", "courses", "enrollments", "payments", "payment_attempts", "ad_costs"]


def oracle_queries() -> dict[str, str]:
    """Statement per registered query."""
    sql = {name: _with(f"SELECT * FROM {name}") for name in _STAGED}
    sql["mart_revenue"] = _with("SELECT * FROM mart_revenue", **_REVENUE_PARTS)
    sql["mart_ad_performance"] = _with(_ads("month"))
    sql["mart_activity"] = _with("SELECT * FROM activity", **_ACTIVITY_PARTS)
    completed = "count(*) FILTER (status = 'completed')"
    dropped = "count(*) FILTER (status = 'dropped')"
    sql["mart_completion"] = _with(f"""
SELECT subject, level, course_type, count(*) AS total_enrollments, {completed} AS completed,
       count(*) FILTER (status = 'active') AS active, {dropped} AS dropped,
       {_pct(completed, 'count(*)')} AS completion_rate_pct,
       {_pct(dropped, 'count(*)')} AS dropout_rate_pct,
       round(avg(progress_pct) FILTER (status = 'active'), 1) AS avg_progress_active
FROM stg_enrollments JOIN stg_courses USING (course_id) GROUP BY ALL""")
    sql["mart_conversion"] = _with(_funnel("month"))

    sql["dq_raw"] = _with("SELECT * FROM before_run", **_RAW_RUN)
    sql["dq_staging"] = _with(_check_counts("stg_"))
    sql["dq_compare"] = _with(f"""
SELECT code, before_n, after_n, after_n - before_n AS delta, {_CHANGE} AS change_pct,
       CASE WHEN code = 'A16' THEN 'secondary' WHEN before_n > 0 AND after_n = 0 THEN 'removed'
            ELSE 'remains' END AS status
FROM paired WHERE before_n + after_n > 0""", **_PAIRED)
    sql["dq_compare_totals"] = _with(
        _totals("all", "true") + " UNION ALL " + _totals("adjusted", "code <> 'A16'"), **_PAIRED
    )
    sql["dq_secondary_growth"] = _with(
        "SELECT * FROM paired WHERE code = 'A16' AND after_n > before_n", **_PAIRED
    )
    sql["dq_run_history"] = _with(f"""
SELECT 'raw' AS run_id, TIMESTAMP '{AS_OF}' AS run_at, code, table_name, severity, n,
       CAST(NULL AS BIGINT) AS previous_n, CAST(NULL AS BIGINT) AS delta FROM before_run
UNION ALL
SELECT 'staging', TIMESTAMP '1999-07-01', a.code, a.table_name, a.severity, a.n, b.n, a.n - b.n
FROM after_run a JOIN before_run b ON b.code = a.code""", **_CHECK_PARTS)
    failed = "count(*) FILTER (n > 0) AS failed_checks"
    records = _int("coalesce(sum(n), 0)") + " AS records"
    sql["dq_severity_summary"] = _with(f"""
SELECT severity, {failed}, {records} FROM before_run WHERE severity <> 'INFO' GROUP BY severity
UNION ALL SELECT 'TOTAL', {failed}, {records} FROM before_run""", **_RAW_RUN)
    sql["dq_table_summary"] = _with(
        f"SELECT table_name, severity, {failed}, {records} FROM before_run GROUP BY ALL", **_RAW_RUN
    )
    sql["dq_clean_checks"] = _with(
        "SELECT code, table_name, severity FROM after_run WHERE n = 0", **_CHECK_PARTS
    )
    heads = ", ".join(f"('{c}', '{d[2].split(' — ')[0]}')" for c, d in CHECKS.items())
    sql["dq_priorities"] = _with(f"""
SELECT CASE severity WHEN 'CRITICAL' THEN 'now' ELSE 'next' END AS urgency, code, problem
FROM before_run JOIN (VALUES {heads}) d (code, problem) USING (code)
WHERE n > 0 AND severity <> 'INFO'""", **_RAW_RUN)
    sql["dq_alerts"] = _with(f"""
SELECT 'raw' AS run_id, TIMESTAMP '{AS_OF}' AS raised_at, code, table_name, n
FROM before_run WHERE n > 0 AND severity = 'CRITICAL'""", **_RAW_RUN)
    sql["dq_report_text"] = _with("SELECT code, n FROM before_run WHERE n > 0", **_RAW_RUN)
    sql["dq_stored_results"] = sql["dq_raw"]
    sql["dq_extra_rules"] = _with(_RULE_COUNTS)
    sql["dq_seasonal_correlation"] = _with(f"""
SELECT count(*) AS months, round(corr(registrations, spend), 4) AS correlation
FROM (SELECT {_month('registered_at')} AS month, count(*)::DOUBLE AS registrations FROM users GROUP BY ALL)
JOIN (SELECT {_month('date')} AS month, sum(spend_rub)::DOUBLE AS spend FROM ad_costs GROUP BY ALL)
USING (month)""")
    sql["unknown_domain_values"] = _with("""
SELECT 'payment_attempts' AS table_name, 'result' AS column_name, result AS value, count(*) AS n
FROM payment_attempts
WHERE coalesce(result, '') NOT IN ('success', 'failed', 'abandoned') GROUP BY result
UNION ALL
SELECT 'enrollments', 'status', status, count(*) FROM enrollments
WHERE coalesce(status, '') NOT IN ('active', 'completed', 'dropped', 'paused') GROUP BY status
UNION ALL
SELECT 'payments', 'status', status, count(*) FROM payments
WHERE coalesce(status, '') NOT IN ('success', 'refunded', 'failed') GROUP BY status
UNION ALL
SELECT 'users', 'channel', channel, count(*) FROM users
WHERE coalesce(channel, '') NOT IN
  ('organic', 'vk_ads', 'yandex_direct', 'telegram', 'referral', 'email') GROUP BY channel
UNION ALL
SELECT 'ad_costs', 'channel', channel, count(*) FROM ad_costs
WHERE coalesce(channel, '') NOT IN ('vk_ads', 'yandex_direct', 'telegram') GROUP BY channel""")

    mart_names = {
        "mart_revenue": "SELECT * FROM mart_revenue",
        "mart_ad_performance": _ads("month"),
        "mart_activity": "SELECT * FROM activity",
        "mart_completion": """SELECT DISTINCT subject, level, course_type
                              FROM stg_enrollments JOIN stg_courses USING (course_id)""",
        "mart_conversion": f"SELECT DISTINCT {_month('registered_at')} FROM stg_users",
    }
    counts = _counts_of("raw", _RAW_NAMES) + _counts_of("staging", list(_STAGED))
    counts += [
        f"SELECT 'marts', '{name}', count(*) FROM ({body})" for name, body in mart_names.items()
    ]
    sql["layer_row_counts"] = _with(
        "\nUNION ALL ".join(counts), **(_REVENUE_PARTS | _ACTIVITY_PARTS)
    )
    sql["staging_kept_excluded"] = _with("\nUNION ALL ".join(
        f"SELECT '{t}' AS table_name, (SELECT count(*) FROM {t}) AS raw_rows, count(*) AS kept_rows,"
        f" (SELECT count(*) FROM {t}) - count(*) AS excluded_rows FROM stg_{t}"
        for t in _RAW_NAMES
    ))
    sql["preview_topk"] = _with("""
SELECT payment_month, paying_users, revenue, avg_check, revenue_mom_pct FROM mart_revenue
ORDER BY payment_month LIMIT 3""", **_REVENUE_PARTS)
    sql["csv_round_trip"] = _with("SELECT * FROM courses")
    sql["coerced_timestamps"] = _with("""
SELECT user_id, CASE WHEN user_id % 9 <> 4 THEN registered_at END AS registered_at FROM users""")

    sql["dedupe_min_key"] = """
SELECT p_partkey, p_name, p_type FROM part
QUALIFY row_number() OVER (PARTITION BY p_name ORDER BY p_partkey) = 1"""
    sql["dedupe_first_enrollment"] = _with("""
SELECT * FROM enrollments
QUALIFY row_number() OVER (PARTITION BY user_id, course_id ORDER BY enrollment_id) = 1""")
    sql["orphan_anti_join"] = _with("""
SELECT * FROM payment_attempts a
WHERE NOT EXISTS (SELECT 1 FROM users u WHERE u.user_id = a.user_id AND u.is_active = 1)""")
    sql["existence_filter"] = _with("""
SELECT * FROM payment_attempts a
WHERE NOT (result = 'success'
           AND NOT EXISTS (SELECT 1 FROM payments p
                           WHERE p.user_id = a.user_id AND p.course_id = a.course_id))""")
    sql["duplicate_email_members"] = _with("""
SELECT CAST(coalesce(sum(n), 0) AS BIGINT) AS n
FROM (SELECT count(*) AS n FROM users GROUP BY email HAVING count(*) > 1)""")
    sql["attempts_renumbered"] = _with("""
SELECT attempt_id AS source_id, attempted_at, user_id, result,
       row_number() OVER (ORDER BY attempted_at, attempt_id) AS attempt_id
FROM payment_attempts""")

    sql["report_lifetime_value"] = _with("""
SELECT user_id, CAST(sum(amount_rub) AS BIGINT) AS ltv_rub, count(*) AS transactions
FROM stg_payments WHERE status = 'success' GROUP BY user_id""")
    sql["report_registrations_by_channel"] = _with(f"""
SELECT {_month('registered_at')} AS period, coalesce(channel, 'unknown') AS channel,
       count(*) AS registrations FROM stg_users GROUP BY ALL""")
    sql["report_active_users"] = _with(" UNION ALL ".join(
        f"SELECT '{g}' AS grain, {_period('enrolled_at', g)} AS period,"
        " count(DISTINCT user_id) AS active_users FROM stg_enrollments GROUP BY ALL"
        for g in ("day", "week", "month")
    ))
    sql["report_top_subjects"] = _with(f"""
SELECT {_month('paid_at')} AS period, subject, {_int('sum(amount_rub)')} AS revenue,
       CAST(rank() OVER (PARTITION BY {_month('paid_at')} ORDER BY sum(amount_rub) DESC) AS INTEGER) AS place
FROM sold GROUP BY 1, 2 QUALIFY place <= 5""", sold=_SOLD)
    sql["report_revenue_ytd"] = _with(f"""
SELECT period, CAST(year(period) AS INTEGER) AS year, revenue,
       {_int('sum(revenue) OVER (PARTITION BY year(period) ORDER BY period)')} AS revenue_ytd
FROM (SELECT {_month('paid_at')} AS period, {_int('sum(amount_rub)')} AS revenue FROM sold GROUP BY 1)
""", sold=_SOLD)
    sql["report_weekly_revenue"] = _with(f"""
SELECT week, revenue, lag(revenue) OVER w AS revenue_prev_week,
       {_pct('revenue - lag(revenue) OVER w', 'lag(revenue) OVER w')} AS revenue_wow_pct,
       coalesce(revenue < 0.8 * lag(revenue) OVER w, false) AS is_anomaly
FROM (SELECT {_period('paid_at', 'week')} AS week, {_int('sum(amount_rub)')} AS revenue
      FROM sold GROUP BY 1) WINDOW w AS (ORDER BY week)""", sold=_SOLD)
    sql["report_new_payers"] = _with(f"""
SELECT {_period('first_paid', 'week')} AS period, count(*) AS new_paying_users
FROM (SELECT min(paid_at) AS first_paid FROM stg_payments WHERE status = 'success' GROUP BY user_id)
GROUP BY 1""")
    sql["report_top_products"] = _with(f"""
SELECT {_period('paid_at', 'week')} AS period, course_id, title, {_int('sum(amount_rub)')} AS revenue,
       CAST(row_number() OVER (PARTITION BY {_period('paid_at', 'week')}
                               ORDER BY sum(amount_rub) DESC, course_id) AS INTEGER) AS place
FROM sold GROUP BY 1, 2, 3 QUALIFY place <= 3""", sold=_SOLD)
    sql["report_last_six_months"] = _with(f"""
SELECT payment_month, revenue, mrr, arpu, avg_check, revenue_mom_pct FROM mart_revenue
WHERE payment_month >= DATE '1998-12-01' AND payment_month < DATE '1999-06-01'""", **_REVENUE_PARTS)
    sql["report_revenue_structure"] = _with(f"""
SELECT period, course_type, subject, {_int('sum(revenue)')} AS revenue,
       CAST(detail AS BIGINT) AS detail,
       {_pct('sum(revenue)', 'first(month_revenue)')} AS share_pct
FROM (SELECT period, revenue, detail, month_revenue,
             CASE WHEN detail < 3 THEN course_type END AS course_type,
             CASE WHEN detail = 0 THEN subject END AS subject
      FROM (SELECT {_month('paid_at')} AS period, course_type, subject, amount_rub AS revenue,
                   sum(amount_rub) OVER (PARTITION BY {_month('paid_at')}) AS month_revenue FROM sold),
           (VALUES (0), (1), (3)) d (detail))
GROUP BY period, course_type, subject, detail""", sold=_SOLD)
    sql["report_weekly_channels"] = _with(f"""
SELECT week, channel, spend, impressions, clicks, registrations, paying_users, revenue_from_channel,
       ctr_pct, cpc, cpm, cac, roas, lag(spend) OVER w AS spend_prev,
       lag(registrations) OVER w AS registrations_prev, lag(cac) OVER w AS cac_prev,
       coalesce(cac > 1.5 * lag(cac) OVER w, false) AS cac_jump,
       coalesce(10 * registrations < 7 * lag(registrations) OVER w, false) AS registrations_fall
FROM (SELECT * RENAME (month AS week) FROM ({_ads('week')}))
WINDOW w AS (PARTITION BY channel ORDER BY week)""")
    year = "'1998-01-01' AND {0} < TIMESTAMP '1999-01-01'"

    def within(column):
        return f"{column} >= TIMESTAMP " + year.format(column)

    sql["report_channel_summary"] = _with(f"""
SELECT DATE '1998-01-01' AS period_start, a.channel, a.spend, a.impressions, a.clicks,
       coalesce(r.registrations, 0) AS registrations, coalesce(p.paying_users, 0) AS paying_users,
       coalesce(p.revenue, 0) AS revenue_from_channel,
       {_pct('clicks', 'impressions', 2)} AS ctr_pct,
       round(a.spend::DOUBLE / nullif(clicks, 0), 0) AS cpc,
       round(1000.0::DOUBLE * a.spend / nullif(impressions, 0), 0) AS cpm,
       round(a.spend::DOUBLE / nullif(p.paying_users, 0), 0) AS cac,
       round(coalesce(p.revenue, 0)::DOUBLE / nullif(a.spend, 0), 2) AS roas
FROM (SELECT channel, {_int('sum(spend_rub)')} AS spend, {_int('sum(impressions)')} AS impressions,
             {_int('sum(clicks)')} AS clicks FROM stg_ad_costs WHERE {within('date')} GROUP BY 1) a
LEFT JOIN (SELECT channel, count(*) AS registrations FROM stg_users WHERE {within('registered_at')}
           GROUP BY 1) r USING (channel)
LEFT JOIN (SELECT channel, count(DISTINCT user_id) AS paying_users, {_int('sum(amount_rub)')} AS revenue
           FROM stg_payments JOIN stg_users USING (user_id)
           WHERE status = 'success' AND {within('paid_at')} GROUP BY 1) p USING (channel)""")
    sql["report_weekly_funnel"] = _with(_funnel("week"))
    rates = ", ".join(
        f"max(retention_rate_pct) FILTER (month_number = {m}) AS m{m}" for m in range(7)
    )
    sql["report_cohort_matrix"] = _with(
        f"SELECT cohort_month, max(cohort_size) AS cohort_size, {rates} FROM activity GROUP BY 1",
        **_ACTIVITY_PARTS,
    )
    sql["report_dropout_histogram"] = _with(f"""
SELECT CAST(progress_pct // 10 * 10 AS INTEGER) AS progress_from, count(*) AS dropped,
       {_pct('count(*)', "(SELECT count(*) FROM stg_enrollments WHERE status = 'dropped')")} AS share_pct
FROM stg_enrollments WHERE status = 'dropped' GROUP BY 1""")
    sql["report_low_completion"] = _with(f"""
SELECT r.*, round((completion_rate_pct - mean) / nullif(spread, 0), 3) AS z_score,
       coalesce(round((completion_rate_pct - mean) / nullif(spread, 0), 3) < -1, false) AS is_low
FROM rates r,
     (SELECT avg(completion_rate_pct) AS mean, stddev_samp(completion_rate_pct) AS spread FROM rates)
""", rates=f"""
  SELECT subject, count(*) AS total_enrollments, {completed} AS completed,
         {_pct(completed, 'count(*)', 2)} AS completion_rate_pct
  FROM stg_enrollments JOIN stg_courses USING (course_id) GROUP BY subject""")
    sql["export_active_students"] = _with("SELECT * FROM idle", idle=_IDLE)
    sql["export_at_risk_students"] = _with(_AT_RISK, idle=_IDLE)
    sql["report_operations"] = _with(_operations(), idle=_IDLE)
    sql["report_daily_payments"] = _with("""
SELECT CAST(paid_at AS DATE) AS day, count(*) AS payments, CAST(sum(amount_rub) AS BIGINT) AS amount_rub
FROM stg_payments WHERE status = 'success' GROUP BY 1""")

    sql["flagged_users"] = _with(f"""
SELECT *,
       CAST(user_id <> min(user_id) OVER (PARTITION BY email) AS INTEGER) AS is_duplicate,
       CASE WHEN registered_at > TIMESTAMP '{AS_OF}' THEN 1 ELSE 0 END AS is_test
FROM users""")
    sql["flagged_courses"] = _with("SELECT *, CASE WHEN price_rub = 0 THEN 1 ELSE 0 END AS is_free FROM courses")
    sql["flagged_attempts"] = _with("""
SELECT a.*, CAST(NOT EXISTS (SELECT 1 FROM users u WHERE u.user_id = a.user_id) AS INTEGER) AS is_guest
FROM payment_attempts a""")
    sql["flagged_ad_costs"] = _with("""
SELECT *, CASE WHEN spend_rub = 0 AND impressions > 0 THEN 1 ELSE 0 END AS data_quality_issue
FROM ad_costs""")
    sql["quarantined_enrollments"] = _with("""
SELECT * FROM enrollments WHERE enrollment_id NOT IN (SELECT enrollment_id FROM stg_enrollments)""")
    sql["transactions"] = _with("""
SELECT * REPLACE (abs(amount_rub) AS amount_rub),
       CASE WHEN amount_rub < 0 THEN 'refund' ELSE 'payment' END AS transaction_type
FROM payments WHERE amount_rub < 0 OR (amount_rub > 0 AND status = 'success')""")
    sql["net_revenue"] = _with(f"""
SELECT {_month('paid_at')} AS period,
       {_int("coalesce(sum(amount_rub) FILTER (amount_rub > 0), 0)")} AS revenue,
       {_int("coalesce(-sum(amount_rub) FILTER (amount_rub < 0), 0)")} AS refunds,
       {_int("sum(amount_rub)")} AS net_revenue
FROM payments WHERE amount_rub < 0 OR (amount_rub > 0 AND status = 'success') GROUP BY 1""")
    sql["users_in_utc"] = _with("""
SELECT * REPLACE ((registered_at AT TIME ZONE 'Europe/Moscow') AT TIME ZONE 'UTC' AS registered_at)
FROM users""")
    sql["unconfirmed_attempts"] = _with("""
SELECT * FROM payment_attempts a
WHERE result = 'success'
  AND NOT EXISTS (SELECT 1 FROM payments p WHERE p.user_id = a.user_id AND p.course_id = a.course_id
                  AND p.paid_at BETWEEN a.attempted_at AND a.attempted_at + INTERVAL 5 MINUTE)""")
    sql["course_history"] = _with("SELECT * FROM history", history=_HISTORY)
    sql["payments_at_list_price"] = _with("""
SELECT p.payment_id, p.user_id, p.course_id, p.paid_at, p.amount_rub,
       h.price_rub, h.is_published, h.valid_from, h.valid_to, h.is_current
FROM payments p JOIN history h
  ON h.course_id = p.course_id AND p.paid_at >= h.valid_from AND p.paid_at < h.valid_to
""", history=_HISTORY)
    sql["revenue_of_courses_on_sale"] = _with(f"""
SELECT {_month('paid_at')} AS payment_month, {_int('sum(amount_rub)')} AS revenue,
       count(*) AS transactions
FROM payments p
WHERE status = 'success' AND amount_rub > 0
  AND EXISTS (SELECT 1 FROM history h WHERE h.course_id = p.course_id AND h.is_published = 1
              AND p.paid_at >= h.valid_from AND p.paid_at < h.valid_to)
GROUP BY 1""", history=_HISTORY)
    sql["incremental_daily_orders"] = f"""
SELECT {_month('o_orderdate')} AS month, CAST(o_orderdate AS DATE) AS day, count(*) AS orders,
       CAST(sum(CAST(floor(o_totalprice) AS BIGINT)) AS BIGINT) AS value_rub
FROM orders GROUP BY 1, 2"""
    sql["merged_course_history"] = sql["course_history"]
    for name in _STAGED:
        sql[f"incremental_{name}"] = sql[name]
    for name in ("revenue", "ad_performance", "activity", "completion", "conversion"):
        sql[f"incremental_{name}"] = sql[f"mart_{name}"]
    sql["incremental_row_counts"] = _with("\nUNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}" for t in [*_RAW_NAMES, *_STAGED]
    ))
    for t in _RAW_NAMES:
        sql[f"quarantine_{t}"] = _with(f"SELECT * FROM judged_{t} WHERE broken_rules <> ''", **_JUDGED)
    sql["staging_reasons"] = _with("\nUNION ALL ".join(
        f"SELECT '{t}' AS table_name, broken_rules, count(*) AS row_count FROM judged_{t} GROUP BY ALL"
        for t in _RAW_NAMES
    ), **_JUDGED)
    sql["staging_rule_counts"] = _with("\nUNION ALL ".join(
        f"""SELECT '{t}' AS table_name, rule, count(*) AS rows,
       CAST(count(*) FILTER (broken_rules = rule) AS BIGINT) AS rows_alone
FROM (SELECT broken_rules, unnest(string_split(broken_rules, ',')) AS rule
      FROM judged_{t} WHERE broken_rules <> '') GROUP BY rule"""
        for t in _RAW_NAMES
    ), **_JUDGED)
    sql["active_users_rollup"] = sql["report_active_users"]
    sql["unconfirmed_attempts_stream"] = sql["unconfirmed_attempts"]
    of_one_row = ", ".join(f"'A{k}'" for k in (2, 3, 4, 5, 7, 8, 10, 11, 17, 18, 19, 20))
    sql["dq_stream_totals"] = _with(
        f"SELECT * FROM before_run WHERE code IN ({of_one_row})", **_RAW_RUN
    )
    for name in ("export_active_students", "export_at_risk_students"):
        sql[f"{name}_csv"] = sql[name]
    sql["dq_stored_compare"] = sql["dq_compare"]
    kept = {f"kept_{t}": f"SELECT * FROM {t}" for t in _RAW_NAMES}
    kept["kept_payments"] += " WHERE status <> 'refunded'"
    sql["dq_secondary_growth_without_refunds"] = _with(
        "SELECT * FROM paired WHERE code = 'A16' AND after_n > before_n",
        **kept, **{**_PAIRED, "after_run": _check_counts("kept_")},
    )
    sql["dq_extra_rules_on_active"] = _with(
        _RULE_COUNTS,
        users=f"SELECT * FROM ({_TABLES['users']}) u WHERE is_active = 1",
        courses=f"SELECT * FROM ({_TABLES['courses']}) c WHERE is_published = 1",
    )
    rate = _pct("completed", "total_enrollments")
    sql["report_course_completion"] = _with(f"""
SELECT c.course_id, c.title, c.subject, c.level, c.total_enrollments, c.completed, c.dropped,
       {rate} AS completion_rate_pct, {_pct('dropped', 'total_enrollments')} AS dropout_rate_pct,
       subject_rate_pct, round({rate} - subject_rate_pct, 1) AS above_subject_pct
FROM per_course c
JOIN (SELECT subject, {_pct('sum(completed)', 'sum(total_enrollments)')} AS subject_rate_pct
      FROM per_course GROUP BY subject) s ON s.subject IS NOT DISTINCT FROM c.subject""",
        per_course=f"""
  SELECT course_id, title, subject, level, count(*) AS total_enrollments,
         {completed} AS completed, {dropped} AS dropped
  FROM stg_enrollments JOIN stg_courses USING (course_id) GROUP BY ALL""",
    )
    sql["report_refund_rate"] = _with(f"""
SELECT *, {_pct('refunds', 'payments')} AS refund_rate_pct,
       {_pct('refunded_rub', 'paid_rub')} AS refunded_share_pct
FROM (SELECT {_month('paid_at')} AS period,
             count(*) FILTER (amount_rub > 0) AS payments, count(*) FILTER (amount_rub < 0) AS refunds,
             {_int('coalesce(sum(amount_rub) FILTER (amount_rub > 0), 0)')} AS paid_rub,
             {_int('coalesce(-sum(amount_rub) FILTER (amount_rub < 0), 0)')} AS refunded_rub
      FROM payments WHERE amount_rub < 0 OR (amount_rub > 0 AND status = 'success') GROUP BY 1)""")
    tried = {
        f"{who}_{what}": f"count(*) FILTER ({who == 'guest'} = guest AND {which})"
        for who in ("member", "guest")
        for what, which in (("attempts", "true"), ("abandoned", "result = 'abandoned'"))
    }
    sql["report_payment_dropoff"] = _with(f"""
SELECT *, {_pct('member_abandoned', 'member_attempts')} AS member_dropoff_pct,
       {_pct('guest_abandoned', 'guest_attempts')} AS guest_dropoff_pct,
       {_pct('member_abandoned + guest_abandoned', 'member_attempts + guest_attempts')} AS dropoff_pct
FROM (SELECT {_month('attempted_at')} AS period, {', '.join(f'{x} AS {n}' for n, x in tried.items())}
      FROM (SELECT *, NOT EXISTS (SELECT 1 FROM users u WHERE u.user_id = a.user_id) AS guest
            FROM payment_attempts a) GROUP BY 1)""")
    for t in ("enrollments", "payments", "payment_attempts"):
        sql[f"colocated_stg_{t}"] = sql[f"stg_{t}"]
    sql["dq_stream_alerts"] = _with(f"""
SELECT code, table_name, CAST(0 AS BIGINT) AS batch_id, n FROM before_run
WHERE code IN ({of_one_row}) AND severity = 'CRITICAL' AND n > 0""", **_RAW_RUN)
    sql["rebuilt_mart_revenue"] = sql["mart_revenue"]
    return sql
