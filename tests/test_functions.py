import math

import duckdb
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cohortlake.functions import half_up, month_number, period_start, ratio


@settings(max_examples=5, deadline=None)
@given(st.lists(st.integers(-10_000_000, 10_000_000), min_size=50, max_size=400))
def test_half_up_rounds_like_sql(spark, numbers):
    values = [(n / 1000.0,) for n in numbers] + [(1.005,), (-0.5,), (2.5,), (0.05,)]
    df = spark.createDataFrame(values, "x double")
    for digits in (0, 1, 2):
        mine = [r[0] for r in df.select(half_up(F.col("x"), digits)).collect()]
        con = duckdb.connect()
        theirs = [con.execute(f"SELECT round(?::DOUBLE, {digits})", [v[0]]).fetchone()[0] for v in values]
        assert all(math.isclose(a, b, abs_tol=0) for a, b in zip(mine, theirs))


def test_ratio_guards(spark):
    df = spark.sql("SELECT * FROM VALUES (1L, 3L), (1L, 0L), (NULL, 3L), (1L, NULL) t(a, b)")
    assert [r[0] for r in df.select(ratio(F.col("a"), F.col("b"), 1, 100)).collect()] == [
        33.3, None, None, None,
    ]


def test_months_count_boundaries(spark):
    df = spark.sql("SELECT DATE'2024-01-31' AS a, DATE'2024-03-01' AS b, DATE'2023-12-31' AS c")
    got = df.select(
        month_number(F.col("a"), F.col("b")), month_number(F.col("a"), F.col("c"))
    ).first()
    assert tuple(got) == (2, -1)


def test_period_start(spark):
    df = spark.sql("SELECT TIMESTAMP_NTZ'2024-05-16 23:59:59' AS t")
    got = df.select(*[period_start("t", g).cast("string") for g in ("day", "week", "month", "year")])
    assert tuple(got.first()) == ("2024-05-16", "2024-05-13", "2024-05-01", "2024-01-01")


def test_half_up_on_large_and_close_values(spark):
    values = [(1.5e17, 2, 1.5e17), (0.49999999999999994, 0, 0.0), (-2.5, 0, -3.0)]
    for value, digits, expected in values:
        df = spark.createDataFrame([(value,)], "x double")
        assert df.select(half_up(F.col("x"), digits)).first()[0] == expected
