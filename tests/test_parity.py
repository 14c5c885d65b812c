"""Registered queries against their SQL, on the source tables and on skewed copies."""

import duckdb
import pytest

import __spark_entry__ as entry
from cohortlake.plans.oracle import oracle_queries
from cohortlake.plans.registry import QUERIES
from cohortlake.sources.bindings import SOURCES
from tests.conftest import SOURCE

pytestmark = pytest.mark.skipif(SOURCE is None, reason="no source tables")
NAMES = list(QUERIES)
SQL = oracle_queries()
# How the two engines name their types.
TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
    "timestamp_ntz": "TIMESTAMP", "date": "DATE", "boolean": "BOOLEAN",
}
# One customer, one part and one event user hold a third of the rows; some keys,
# times and amounts are missing.
SKEWED = {
    "orders": """CASE WHEN o_orderkey % 3 = 0 THEN 21 WHEN o_orderkey % 50 = 1 THEN NULL
                 ELSE o_custkey END AS o_custkey""",
    "lineitem": """CASE WHEN l_orderkey % 3 = 1 THEN 11 WHEN l_orderkey % 50 = 2 THEN NULL
                   ELSE l_partkey END AS l_partkey,
                   CASE WHEN l_orderkey % 7 = 0 AND l_linenumber = 5 THEN NULL
                   ELSE l_returnflag END AS l_returnflag,
                   CASE WHEN l_orderkey % 11 = 0 AND l_linenumber = 6 THEN NULL
                   ELSE l_shipdate END AS l_shipdate,
                   CASE WHEN l_suppkey % 17 = 0 AND l_linenumber = 4 THEN NULL
                   ELSE l_extendedprice END AS l_extendedprice""",
    "events": """CASE WHEN event_id % 3 = 0 THEN 21 WHEN event_id % 50 = 1 THEN NULL
                 ELSE user_id END AS user_id""",
}
ON_SKEWED = [
    n
    for n in NAMES
    if n.startswith(
        ("stg_", "mart_", "flagged_", "export_", "dedupe_", "quarantine_", "incremental_", "colocated_")
    )
] + [
    "dq_raw", "dq_staging", "dq_extra_rules", "existence_filter", "orphan_anti_join",
    "report_active_users", "report_operations", "unconfirmed_attempts", "course_history",
    "payments_at_list_price", "revenue_of_courses_on_sale", "net_revenue",
    "quarantined_enrollments", "attempts_renumbered", "merged_course_history", "staging_reasons",
    "active_users_rollup", "unconfirmed_attempts_stream", "dq_stream_totals",
    "report_payment_dropoff", "report_refund_rate", "report_course_completion",
    "report_last_six_months", "layer_row_counts", "staging_kept_excluded",
]


def views(folder):
    con = duckdb.connect()
    for table in SOURCES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return con


@pytest.fixture(scope="module")
def database():
    return views(SOURCE)


@pytest.fixture(scope="module")
def skewed(tmp_path_factory):
    folder = tmp_path_factory.mktemp("skewed")
    con = views(SOURCE)
    for table in SOURCES:
        changes = f"* REPLACE ({SKEWED[table]})" if table in SKEWED else "*"
        con.execute(f"COPY (SELECT {changes} FROM {table}) TO '{folder}/{table}.parquet'")
    return str(folder), views(folder)


def compare(name, spark, folder, database):
    df = QUERIES[name](spark, folder)
    mine = [tuple(r) for r in df.collect()]
    cursor = database.execute(SQL[name])
    types = {c[0]: str(c[1]) for c in cursor.description}
    assert {n: TYPES[t] for n, t in df.dtypes} == types
    place = [list(types).index(c) for c in df.columns]
    theirs = [tuple(r[i] for i in place) for r in cursor.fetchall()]
    assert sorted(map(repr, mine)) == sorted(map(repr, theirs))
    return mine


def test_every_query_has_sql():
    assert set(SQL) == set(NAMES)
    assert set(NAMES) <= set(entry.queries()) and set(NAMES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", NAMES)
def test_same_rows_and_types(spark, database, name):
    assert compare(name, spark, SOURCE, database) or name == "dq_secondary_growth"


@pytest.mark.parametrize("name", ON_SKEWED)
def test_same_under_skew_and_missing_values(spark, skewed, name):
    compare(name, spark, *skewed)


def test_entry(spark):
    assert entry.entry(spark).count() > 0
