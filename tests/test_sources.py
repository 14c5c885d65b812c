import datetime as dt
import os
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark import SparkConf, SparkContext
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from cohortlake import schemas as S
from cohortlake.plans import marts, registry, warehouse
from cohortlake.session import configure, like, partitions, run_folder, shared_root
from cohortlake.sources import bindings, csvfiles, layers
from cohortlake.sources.snapshots import Snapshots
from tests.fixture import AS_OF, RAW_COUNTS


def test_csv_types_and_nulls(raw):
    for table, df in raw.items():
        assert df.schema == S.SCHEMAS[table]
    course = raw["courses"].filter("course_id = 2").first()
    assert course.duration_weeks is None and course.subject == "Физика"
    assert raw["users"].filter("email IS NULL").count() == 2


def test_missing_inputs(spark, csv_folder, tmp_path):
    (tmp_path / "users.csv").write_text("user_id\n")
    with pytest.raises(csvfiles.MissingInputs) as error:
        csvfiles.read_csv_layer(spark, str(tmp_path))
    assert len(error.value.missing) == 5


def test_corrupt_rows_are_kept(spark, tmp_path):
    path = tmp_path / "ads.csv"
    path.write_text("date,channel,impressions,clicks,spend_rub\n2024-01-01,vk_ads,1,2,3\nbad,x,y,1,2\n")
    rows = csvfiles.read_csv(spark, str(path), "ad_costs", keep_corrupt=True).collect()
    assert rows[0]._corrupt_record is None and rows[0].spend_rub == 3
    assert rows[1]._corrupt_record == "bad,x,y,1,2" and rows[1].impressions is None


def test_csv_round_trip(spark, raw, tmp_path):
    for table, df in raw.items():
        path = str(tmp_path / table)
        csvfiles.write_csv(df, path)
        back = csvfiles.read_csv(spark, path, table)
        assert sorted(map(str, back.collect())) == sorted(map(str, df.collect()))


def test_coerce_timestamps(spark):
    df = spark.sql("SELECT '2024-01-02 03:04:05' AS a, 'oops' AS b, 1 AS c")
    out = csvfiles.coerce_timestamps(df, ["a", "b", "c"])
    assert dict(out.dtypes) == {"a": "timestamp_ntz", "b": "timestamp_ntz", "c": "int"}
    row = out.first()
    assert row.a.hour == 3 and row.b is None and row.c == 1


def test_create_fails_where_replace_does_not(raw, tmp_path):
    path = str(tmp_path / "t")
    layers.create_table(raw["users"], path)
    with pytest.raises(AnalysisException):
        layers.create_table(raw["users"], path)
    assert layers.replace_table(raw["users"].limit(2), path).count() == 2


def test_warehouse(spark, raw):
    stored = warehouse.build(raw, AS_OF, run_folder(spark, "wh"))
    sizes = {(r.layer, r.table_name): r.row_count for r in layers.row_counts(stored).collect()}
    assert sizes["raw", "users"] == 10 and sizes["staging", "stg_users"] == 6
    assert sizes["marts", "mart_activity"] == 5
    assert len(sizes) == 17


def test_catalog(spark, raw, staged):
    tables = {("raw", "users"): raw["users"], ("staging", "stg_users"): staged["users"]}
    listed = warehouse.register(spark, tables)
    assert listed == {"raw": ["users"], "staging": ["stg_users"], "marts": []}
    assert spark.table("staging.stg_users").count() == 6
    with pytest.raises(AnalysisException):
        warehouse.register(spark, tables)
    warehouse.register(spark, tables, replace=True)


def test_kept_and_excluded(spark, raw, staged):
    rows = {r.table_name: r for r in layers.kept_and_excluded(raw, staged).collect()}
    assert (rows["users"].kept_rows, rows["users"].excluded_rows) == (6, 4)
    assert (rows["ad_costs"].kept_rows, rows["ad_costs"].excluded_rows) == (5, 3)


def test_rows_observed_while_writing(spark, raw):
    layer = warehouse.StagedLayer(raw, AS_OF, run_folder(spark, "observed"))
    layer["enrollments"]
    assert layer.rows == {"users": 6, "courses": 4, "enrollments": 8}


def test_shared_folder_is_the_session_setting(spark):
    assert shared_root(spark) == spark.sparkContext.getConf().get("spark.checkpoint.dir")
    assert os.path.dirname(run_folder(spark, "x")).startswith(shared_root(spark))


def test_preview(staged):
    top = layers.preview(staged["payments"], ["payment_id", "paid_at"], "paid_at", 2)
    assert [r.payment_id for r in top.collect()] == [1, 4]


def test_checks_cover_every_code():
    from cohortlake.operators.quality import CHECKS

    assert list(CHECKS) == list(RAW_COUNTS)


def test_shuffles_grow_with_the_input(spark):
    name = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    for size, partitions in ((0, "4"), (64 << 30, "1024"), (100 << 40, "1638400")):
        configure(spark, size)
        assert spark.conf.get(name) == partitions
    configure(spark)


def test_joined_partitions_are_bounded_by_rows(spark):
    """Shuffled rows of some 2 MB that unpack to much more are read by several tasks."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.parallelismFirst", "false")
    tasks = []
    try:
        for unpacked in (1, 64):
            configure(spark, 8 << 20, unpacked)
            few = like(spark)
            few.conf.set("spark.sql.adaptive.coalescePartitions.parallelismFirst", "false")
            for session in (spark, few):
                numbers = session.range(600_000).repartition(F.xxhash64("id"))
                tasks.append(numbers.groupBy(F.spark_partition_id()).count().count())
        assert tasks[0] == tasks[1] == 1
        assert min(tasks[2:]) > 1
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.parallelismFirst")
        configure(spark)


def test_files_are_read_in_pieces_bounded_by_rows(spark, tmp_path):
    """A file of several row groups that unpacks to much more is read by several tasks."""
    path = str(tmp_path / "numbers")
    noise = spark.range(300_000, numPartitions=1).select(F.xxhash64("id").alias("noise"))
    noise.write.option("parquet.block.size", 1 << 18).parquet(path)
    tasks = []
    try:
        for unpacked in (1, 128):
            configure(spark, 8 << 20, unpacked)
            for session in (spark, like(spark)):
                read = session.read.parquet(path)
                tasks.append(read.select(F.spark_partition_id()).distinct().count())
        assert tasks[0] == tasks[1] == 1
        assert min(tasks[2:]) > 1
    finally:
        configure(spark)


def test_sizes_of_the_application_come_back(spark, monkeypatch):
    """Queries whose input needs no smaller pieces run with the sizes asked for at the start."""
    name = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    given = SparkConf(False).set(name, "16m")
    try:
        with monkeypatch.context() as patch:
            patch.setattr(SparkContext, "getConf", lambda self: given)
            configure(spark, 8 << 20, 8)
            assert spark.conf.get(name) == str(8 << 20)
            configure(spark)
            assert spark.conf.get(name) == "16m"
    finally:
        configure(spark)


def test_staging_reads_raw_tables_that_are_written(spark, tmp_path):
    raw = warehouse.RawLayer(
        {"users": spark.range(3).toDF("user_id"), "courses": spark.range(4).toDF("course_id")},
        str(tmp_path / "warehouse"),
    )
    assert not raw.nearest["users"].inputFiles()
    assert not raw.stored
    raw["users"]
    files = raw.nearest["users"].inputFiles()
    assert files and all(str(tmp_path) in f for f in files)
    assert raw.nearest["users"].count() == 3
    assert not raw.nearest["courses"].inputFiles()


def _order_tables(spark, folder):
    """Orders with two lines, one, none and without a key; an order line without an order."""
    orders = [(1, 7), (2, 8), (3, None), (None, 9), (1, 7)]
    lines = [(1, 30), (1, 20), (2, None), (2, 10), (4, 5), (None, 6)]
    for table, rows, names in (
        ("orders", orders, ("o_orderkey", "o_custkey")),
        ("lineitem", lines, ("l_orderkey", "l_partkey")),
        ("events", [(5,)], ("event_id",)),
    ):
        fields = bindings.SOURCES[table].split(", ")
        values = [
            F.col(name) if name in names else F.lit(None).cast(kind).alias(name)
            for name, kind in (f.split() for f in fields)
        ]
        frame = spark.createDataFrame(rows, ", ".join(f"{n} bigint" for n in names))
        frame.select(*values).write.parquet(f"{folder}/{table}.parquet")


def test_orders_are_shared_by_the_tables_made_of_them(spark, tmp_path):
    _order_tables(spark, tmp_path)
    alone, shared = (bindings.RawTables(spark, str(tmp_path)) for _ in range(2))
    shared.share_orders()
    for table in ("enrollments", "payment_attempts"):
        assert any("lineitem" in f for f in alone[table].inputFiles())
        files = shared[table].inputFiles()
        assert any("order-courses" in f for f in files)
        assert not any("lineitem" in f or "orders.parquet" in f for f in files)
        assert alone[table].schema == shared[table].schema
        assert sorted(map(str, alone[table].collect())) == sorted(map(str, shared[table].collect()))
    assert shared["enrollments"].count() == 5
    before = alone["enrollments"]
    alone.share_orders()
    assert alone["enrollments"] is before


def test_rows_are_judged_by_their_size_not_their_files(spark, tmp_path):
    path = str(tmp_path / "users")
    spark.range(1000).write.parquet(path)
    first = spark.read.parquet(path)._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    configure(spark, 64 << 30, 8)
    try:
        assert partitions(spark) == 8192
        rows = spark.read.parquet(path)._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
        assert rows >= 7 * first
        assert partitions(like(spark)) == 8192
    finally:
        configure(spark)


def test_changed_files_are_a_new_source(spark, tmp_path):
    for table, columns in bindings.SOURCES.items():
        empty = spark.createDataFrame([], columns)
        empty.write.parquet(str(tmp_path / f"{table}.parquet"))
    first = registry.source(spark, str(tmp_path))
    assert registry.source(spark, str(tmp_path)) is first
    spark.createDataFrame(
        [(1, "n", 2, 3.0, "BUILDING")], bindings.SOURCES["customer"]
    ).write.mode("append").parquet(str(tmp_path / "customer.parquet"))
    second = registry.source(spark, str(tmp_path))
    assert second is not first and second.staged["users"].count() == 1


def test_a_failed_attempt_is_written_over(spark, raw):
    folder = run_folder(spark, "failed")
    raw["users"].limit(1).write.parquet(f"{folder}/staging/stg_users")
    with pytest.raises(AnalysisException):
        warehouse.StagedLayer(raw, AS_OF, folder)["users"]
    assert warehouse.StagedLayer(raw, AS_OF, folder, replace=True)["users"].count() == 6


def test_queries_side_by_side_write_a_table_once(spark, raw):
    layer = warehouse.StagedLayer(raw, AS_OF, run_folder(spark, "threads"))
    with ThreadPoolExecutor(4) as pool:
        frames = list(pool.map(layer.__getitem__, ["payments"] * 4))
    assert all(f is frames[0] for f in frames) and frames[0].count() == 8


def test_columns_by_header_and_forms_of_time(spark, tmp_path):
    (tmp_path / "ad.csv").write_text("clicks,date,channel,spend_rub,impressions\n5,2024-01-01,vk_ads,9,1000\n")
    row = csvfiles.read_csv(spark, str(tmp_path / "ad.csv"), "ad_costs").first()
    assert (row.clicks, row.impressions) == (5, 1000)
    (tmp_path / "bad.csv").write_text("clicks,date,channel,spend_rub,impressions\nx,2024-01-01,vk_ads,9,1\n")
    assert csvfiles.malformed_rows(spark, str(tmp_path / "bad.csv"), "ad_costs") == 1
    (tmp_path / "short.csv").write_text("clicks,date\n1,2024-01-01\n")
    with pytest.raises(ValueError, match="impressions"):
        csvfiles.read_csv(spark, str(tmp_path / "short.csv"), "ad_costs")
    names = "attempt_id,user_id,course_id,attempted_at,result,failure_reason,payment_method\n"
    times = ["2024-01-01 01:02:03", "2024-01-01 01:02:03.5", "2024-01-01T01:02:03"]
    (tmp_path / "t.csv").write_text(names + "".join(f"{i},1,1,{t},success,,card\n" for i, t in enumerate(times)))
    found = csvfiles.read_csv(spark, str(tmp_path / "t.csv"), "payment_attempts").orderBy("attempt_id")
    assert [r.attempted_at.microsecond for r in found.collect()] == [0, 500000, 0]
    csvfiles.write_csv(found, str(tmp_path / "again"))
    again = csvfiles.read_csv(spark, str(tmp_path / "again"), "payment_attempts")
    assert sorted(again.collect()) == sorted(found.collect())


def test_second_build_replaces_the_first(spark, raw):
    root = run_folder(spark, "twice")
    warehouse.build(raw, AS_OF, root)
    with pytest.raises(AnalysisException):
        warehouse.build(raw, AS_OF, root)
    tables = warehouse.build(raw, AS_OF, root, replace=True)
    assert tables["raw", "payments"].count() == raw["payments"].count()


def test_a_build_that_dies_leaves_the_one_before(spark, raw, monkeypatch):
    root = run_folder(spark, "dies")
    warehouse.build(raw, AS_OF, root)
    before = warehouse.read_layer(spark, root, "marts")["mart_revenue"].collect()
    fewer = {**raw, "payments": raw["payments"].limit(1)}

    def die(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as broken:
        broken.setattr(marts, "mart_conversion", die)
        with pytest.raises(RuntimeError, match="lost"):
            warehouse.build(fewer, AS_OF, root, replace=True)
    assert warehouse.read_layer(spark, root, "marts")["mart_revenue"].collect() == before
    assert warehouse.read_layer(spark, root, "raw")["payments"].count() == raw["payments"].count()
    warehouse.build(fewer, AS_OF, root, replace=True)
    assert warehouse.read_layer(spark, root, "raw")["payments"].count() == 1
    old = Snapshots(spark, root)
    first = old.read(old.at(1), "marts.mart_revenue")
    assert first.collect() == before, "a reader of the old build goes on"


def test_counts_of_a_build_come_from_its_manifest(spark, raw, staged):
    root = run_folder(spark, "counted")
    tables = warehouse.build(raw, AS_OF, root)
    manifest = Snapshots(spark, root).head()
    assert manifest.notes == {"as_of": AS_OF}
    counts = warehouse.stored_counts(spark, manifest)
    assert sorted(counts.collect()) == sorted(layers.row_counts(tables).collect())
    kept = warehouse.stored_kept_and_excluded(spark, manifest)
    assert sorted(kept.collect()) == sorted(layers.kept_and_excluded(raw, staged).collect())
    assert counts.inputFiles() == kept.inputFiles() == []


def test_facts_lie_by_month(spark, raw):
    layer = warehouse.StagedLayer(raw, AS_OF, run_folder(spark, "months"))
    months = layer.months("payments")
    assert months == sorted({str(r.m) for r in layer["payments"].select(
        F.trunc(F.col("paid_at").cast("date"), "month").alias("m")).collect()})
    some = layer.within("payments", dt.date(2024, 2, 20), dt.date(2024, 3, 1))
    expected = layer["payments"].filter("paid_at >= '2024-02-01' AND paid_at < '2024-04-01'")
    assert sorted(some.collect()) == sorted(expected.collect())
    assert all("=2024-02-01/" in f or "=2024-03-01/" in f for f in some.inputFiles())
    assert layer.of_months("payments", []).count() == 0
