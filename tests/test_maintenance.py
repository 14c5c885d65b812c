"""Snapshots, and the warehouse brought forward by loads against full builds."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from cohortlake import schemas as S
from cohortlake.operators import staging
from cohortlake.operators.history import build_history
from cohortlake.plans.maintenance import MaintainedWarehouse
from cohortlake.plans.versions import MaintainedHistory
from cohortlake.plans.warehouse import build_marts
from cohortlake.session import run_folder
from cohortlake.sources.snapshots import Conflict, Manifest, Snapshots, add_parts, replace_parts
from tests.fixture import AS_OF


def rows(df):
    return sorted(map(repr, map(tuple, df.collect())))


def same_rows(found, expected):
    """Equal up to order and to 0 in place of a sum over nothing."""
    assert found.columns == expected.columns
    assert rows(found.na.fill(0)) == rows(expected.na.fill(0))


def numbers(spark, low, high):
    return spark.range(low, high).select("id", (F.col("id") % 3).alias("third"))


def test_snapshots_show_whole_loads_only(spark):
    store = Snapshots(spark, run_folder(spark, "store"))
    assert store.head() == Manifest() and store.versions() == []
    first = store.head().next(by="a")
    add_parts(first, "t", store.write(numbers(spark, 0, 10), "t", F.col("third")))
    assert store.head() == Manifest()
    store.publish(first)
    assert store.head() == first and store.read(store.head(), "t").count() == 10

    second = first.next()
    replace_parts(second, "t", store.write(numbers(spark, 100, 101), "t", F.col("third")), ["1", "2"])
    add_parts(second, "t", store.write(numbers(spark, 90, 91), "t", F.col("third")))
    store.publish(second)
    held = {r.id for r in store.read(store.head(), "t").collect()}
    assert held == {0, 3, 6, 9, 90, 100}
    assert store.read(store.at(1), "t").count() == 10, "an older snapshot stays readable"
    assert store.head().rows("t") == 6 and store.row_counts(second).collect() == [("t", 6)]
    assert {r.id for r in store.read(second, "t", ["1", "7"]).collect()} == {100}


def test_a_second_load_of_one_version_fails(spark):
    store = Snapshots(spark, run_folder(spark, "store"))
    for name in ("one", "two"):
        draft = Manifest().next(by=name)
        if name == "one":
            store.publish(draft)
        else:
            with pytest.raises(Conflict):
                store.publish(draft)
    assert store.versions() == [1] and store.head().notes == {"by": "one"}


def test_rows_without_a_part_and_no_rows(spark):
    store = Snapshots(spark, run_folder(spark, "store"))
    new = Manifest().next()
    undated = spark.createDataFrame([(1, None), (2, "x")], "id long, at string")
    add_parts(new, "t", store.write(undated, "t", F.col("at")))
    add_parts(new, "e", store.write(undated.limit(0), "e", F.col("at")))
    assert set(new.tables["t"].parts) == {"none", "x"} and new.tables["e"].parts == {}
    assert store.read(new, "e").schema == undated.schema and store.read(new, "e").count() == 0
    assert rows(store.read(new, "t")) == rows(undated)


MOMENTS = ["2024-02-01 00:00:00", "2024-03-04 12:00:00", AS_OF]


@pytest.fixture(scope="module")
def arrivals(spark, raw):
    """The fixture's rows in three loads by chance, so most arrive late or early."""
    rng = random.Random(8)
    out = {}
    for table, df in raw.items():
        found = [(*r, rng.randrange(3)) for r in df.collect()]
        schema = S.T.StructType([*S.SCHEMAS[table].fields, S.T.StructField("_load", S.T.IntegerType())])
        out[table] = spark.createDataFrame(found, schema).cache()
    return out


def batch(arrivals, number):
    return {t: df.filter(F.col("_load") == number) for t, df in arrivals.items()}


def until(arrivals, number):
    return {t: df.filter(F.col("_load") <= number).drop("_load") for t, df in arrivals.items()}


def check(warehouse, arrived, as_of):
    staged = staging.stage_all(arrived, as_of)
    for table, df in staged.items():
        same_rows(warehouse.read(S.STAGED_PREFIX + table), df)
    for name, mart in build_marts(staged).items():
        same_rows(getattr(warehouse, name)(), mart)


def test_loads_end_where_full_builds_do(spark, arrivals):
    warehouse = MaintainedWarehouse(spark, run_folder(spark, "maintained"))
    for number, as_of in enumerate(MOMENTS):
        warehouse.load(batch(arrivals, number), as_of)
        check(warehouse, until(arrivals, number), as_of)
    with pytest.raises(ValueError):
        warehouse.load({}, MOMENTS[0])
    before = warehouse.snapshots.head()
    name = S.STAGED_PREFIX + "payments"
    compacted = warehouse.compact(name, most=0)
    assert {len(folders) for folders in compacted.tables[name].parts.values()} == {1}
    assert rows(warehouse.read(name)) == rows(warehouse.read(name, before))
    # Nothing but time goes on: user 7 registers, its e-mail's smallest account.
    warehouse.load({}, "2026-01-01 00:00:00")
    check(warehouse, until(arrivals, 2), "2026-01-01 00:00:00")


def test_a_load_that_dies_changes_nothing(spark, arrivals, monkeypatch):
    warehouse = MaintainedWarehouse(spark, run_folder(spark, "maintained"))
    warehouse.load(batch(arrivals, 0), MOMENTS[0])
    before, held = warehouse.snapshots.head(), rows(warehouse.read("stg_enrollments"))

    def die(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as broken:
        broken.setattr(staging, "stage_payment_attempts", die)
        with pytest.raises(RuntimeError, match="lost"):
            warehouse.load(batch(arrivals, 1), MOMENTS[1])
    assert warehouse.snapshots.head() == before
    assert rows(warehouse.read("stg_enrollments")) == held
    warehouse.load(batch(arrivals, 1), MOMENTS[1])
    same_rows(
        warehouse.read("stg_enrollments"),
        staging.stage_all(until(arrivals, 1), MOMENTS[1])["enrollments"],
    )


SEEN = "key long, price long, listed int, seen_at timestamp_ntz"


@pytest.mark.parametrize("seed", range(3))
def test_merged_history_in_any_order(spark, seed):
    rng = random.Random(seed)

    def moment():
        return dt.datetime(2024, 1, 1) + dt.timedelta(hours=rng.randrange(24 * 120))

    found = [
        (rng.choice([1, 1, 1, 2, 3, None]), rng.choice([10, 20, None]), rng.randrange(2), moment())
        for _ in range(200)
    ]
    found += [(4, 5, 1, None), (5, 1, 1, dt.datetime(2024, 2, 1)), (5, 2, 1, dt.datetime(2024, 2, 1))]
    rng.shuffle(found)
    attributes = ["price", "listed"]
    store = MaintainedHistory(
        spark, run_folder(spark, "history"), "key", attributes, "seen_at", buckets=3
    )
    cuts = [0, 90, 140, 200, len(found)]
    for low, high in zip(cuts, cuts[1:], strict=False):
        store.merge(spark.createDataFrame(found[low:high], SEEN))
        full = build_history(spark.createDataFrame(found[:high], SEEN), "key", attributes, "seen_at")
        assert rows(store.versions()) == rows(full)
    assert store.snapshots.head().version == 4
    store.merge(spark.createDataFrame(found[90:140], SEEN))
    assert rows(store.versions()) == rows(full)
    version = store.snapshots.head().version
    store.merge(spark.createDataFrame([(9, 1, 1, None)], SEEN))
    assert store.snapshots.head().version == version, "nothing dated, nothing to publish"


def test_merge_opens_only_touched_buckets(spark):
    store = MaintainedHistory(
        spark, run_folder(spark, "history"), "key", ["price", "listed"], "seen_at", buckets=8
    )
    many = [(k, 1, 1, dt.datetime(2024, 1, 1)) for k in range(40)]
    first = store.merge(spark.createDataFrame(many, SEEN))
    second = store.merge(spark.createDataFrame([(3, 2, 1, dt.datetime(2024, 2, 1))], SEEN))
    before, after = first.tables["versions"].parts, second.tables["versions"].parts
    assert sum(before[p] != after[p] for p in after) == 1 and len(after) > 4
    closed = store.versions().filter("key = 3").orderBy("valid_from").collect()
    assert [(r.price, r.is_current) for r in closed] == [(1, False), (2, True)]
    assert closed[0].valid_to == closed[1].valid_from
