import datetime as dt
import random

from pyspark.sql import functions as F

from cohortlake import schemas as S
from cohortlake.functions import period_start
from cohortlake.operators.quality import run_checks
from cohortlake.operators.reconcile import unconfirmed_attempts
from cohortlake.session import run_folder
from cohortlake.streaming import checks, incremental
from cohortlake.streaming.reconcile import unconfirmed_stream, unconfirmed_to_end
from tests.fixture import AS_OF


def test_incremental_load_and_refresh(spark, raw):
    base = run_folder(spark, "increment")
    source, facts, mart = f"{base}/in", f"{base}/facts", f"{base}/mart"
    schema = S.SCHEMAS["payments"]
    refreshed = []

    def daily(rows):
        return rows.groupBy("month", period_start("paid_at", "day").alias("day")).agg(
            F.sum("amount_rub").alias("amount")
        )

    def after(batch_id):
        loaded = incremental.read_loaded(spark, schema, facts)
        new = loaded.filter(F.col("batch_id") == batch_id).select("month").distinct()
        refreshed.append(sorted(str(r.month) for r in new.collect()))
        incremental.refresh_months(loaded, batch_id, daily, mart)

    def load():
        stream = incremental.file_stream(spark, schema, source)
        incremental.load_new(stream, "paid_at", facts, f"{base}/checkpoint", after)

    early = raw["payments"].filter("paid_at < '2024-03-01'")
    early.write.parquet(source)
    load()
    load()  # nothing new
    raw["payments"].filter("paid_at >= '2024-03-01'").write.mode("append").parquet(source)
    raw["payments"].filter("payment_id = 1").write.mode("append").parquet(source)
    load()

    loaded = incremental.read_loaded(spark, schema, facts)
    assert loaded.count() == raw["payments"].count() + 1
    assert refreshed == [["2024-01-01", "2024-02-01"], ["2024-01-01", "2024-03-01"]]
    stored = {r.day: r.amount for r in spark.read.parquet(mart).collect()}
    assert stored == {r.day: r.amount for r in daily(loaded).collect()}


def test_repeated_batch_leaves_one_copy(spark, raw, tmp_path):
    target = str(tmp_path / "facts")
    placed = raw["payments"].withColumns(
        {"month": period_start("paid_at"), "batch_id": F.lit(0).cast("bigint")}
    )
    for _ in range(2):
        incremental._overwrite_parts(placed, ["month", "batch_id"], target)
    assert spark.read.parquet(target).count() == raw["payments"].count()


def test_unconfirmed_stream(spark, tmp_path):
    start = dt.datetime(2024, 1, 1, 12)

    def at(minutes):
        return start + dt.timedelta(minutes=minutes)

    attempts = [
        (1, 1, 1, at(0), "success", None, "card"),  # paid after 4 minutes
        (2, 1, 2, at(0), "success", None, "card"),  # paid after 6 minutes
        (3, 2, 1, at(7), "success", None, "card"),  # never paid
        (4, 2, 1, at(7), "failed", None, "card"),
        (5, 3, 3, at(8), "success", None, "card"),  # paid in the next slot, in time
        (6, 3, 4, at(8), "success", None, "card"),  # paid before the attempt only
        (99, 9, 9, at(600), "failed", None, "card"),
    ]
    paid = [(1, 1, at(4)), (1, 2, at(6)), (3, 3, at(12)), (3, 3, at(12.5)), (3, 4, at(7))]
    paid += [(9, 9, at(600))]
    payments = [(i, u, c, 1, t, 1, 1, 0, "success", "card") for i, (u, c, t) in enumerate(paid)]
    # The watermark moves on once later rows have been read.
    tail_attempts = [(100, 9, 9, at(700), "success", None, "card")]
    tail_payments = [(100, 9, 9, 1, at(700), 1, 1, 0, "success", "card")]
    for name, batches in (
        ("payment_attempts", (attempts, tail_attempts)),
        ("payments", (payments, tail_payments)),
    ):
        for rows in batches:
            frame = spark.createDataFrame(rows, S.SCHEMAS[name]).coalesce(1)
            frame.write.mode("append").parquet(str(tmp_path / name))

    def stream(name):
        return incremental.file_stream(
            spark, S.SCHEMAS[name], str(tmp_path / name), maxFilesPerTrigger=1
        )

    out = str(tmp_path / "out")
    query = (
        unconfirmed_stream(stream("payment_attempts"), stream("payments"))
        .writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", str(tmp_path / "checkpoint"))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    got = sorted(r.attempt_id for r in spark.read.parquet(out).collect())
    batch = unconfirmed_attempts(
        spark.createDataFrame(attempts, S.SCHEMAS["payment_attempts"]),
        spark.createDataFrame(payments, S.SCHEMAS["payments"]),
    )
    assert got == sorted(r.attempt_id for r in batch.collect()) == [2, 3, 6]


def test_undated_rows_and_tables_in_folders(spark, raw):
    base = run_folder(spark, "undated")
    undated = raw["payments"].withColumn("paid_at", F.when(F.col("payment_id") > 2, F.col("paid_at")))
    undated.write.parquet(f"{base}/payments.parquet")
    schema = S.SCHEMAS["payments"]

    def by_month(rows):
        return rows.groupBy("month").agg(F.count("*").alias("n"))

    def after(batch_id):
        loaded = incremental.read_loaded(spark, schema, f"{base}/facts")
        incremental.refresh_months(loaded, batch_id, by_month, f"{base}/mart")

    stream = incremental.table_stream(spark, schema, f"{base}/payments.parquet")
    incremental.load_new(stream, "paid_at", f"{base}/facts", f"{base}/checkpoint", after)
    counts = {r.month: r.n for r in spark.read.parquet(f"{base}/mart").collect()}
    assert sum(counts.values()) == raw["payments"].count() and counts[None] == 2


def test_streams_run_to_their_end_and_go_on(spark, tmp_path):
    rng = random.Random(4)
    start = dt.datetime(2024, 1, 1)

    def made(first, count, day):
        attempts, payments = [], []
        for i in range(first, first + count):
            at = start + dt.timedelta(days=day, seconds=rng.randrange(7200))
            pair = rng.randrange(3), rng.randrange(3)
            attempts.append((i, *pair, at, rng.choice(["success", "success", "failed"]), None, "card"))
            at = start + dt.timedelta(days=day, seconds=rng.randrange(7200))
            payments.append((i, *pair, 1, at, 1, 1, 0, "success", "card"))
        return {"payment_attempts": attempts, "payments": payments}

    everything = {"payment_attempts": [], "payments": []}
    for load in (made(0, 60, 0), made(60, 40, 2)):
        for name, rows in load.items():
            everything[name] += rows
            frame = spark.createDataFrame(rows, S.SCHEMAS[name]).coalesce(2)
            frame.write.mode("append").parquet(str(tmp_path / name))
    found = unconfirmed_to_end(
        spark, str(tmp_path / "payment_attempts"), str(tmp_path / "payments"), str(tmp_path / "work")
    )
    frames = [spark.createDataFrame(everything[n], S.SCHEMAS[n]) for n in everything]
    expected = unconfirmed_attempts(*frames)
    assert found.columns == expected.columns and expected.count() > 5
    assert sorted(found.collect()) == sorted(expected.collect())


def test_checks_of_a_stream(spark, raw, tmp_path):
    counts = str(tmp_path / "counts")
    assert {r.n for r in checks.totals(checks.read_counts(spark, counts)).collect()} == {0}
    files = {}
    for table, df in raw.items():
        files[table] = str(tmp_path / table)
        for part in range(3):
            some = df.filter(F.pmod(F.hash(*df.columns), F.lit(3)) == part)
            some.coalesce(1).write.mode("append").parquet(files[table])

    def run():
        for table, folder in files.items():
            stream = incremental.file_stream(spark, S.SCHEMAS[table], folder, maxFilesPerTrigger=1)
            checks.load_checked(
                stream, table, AS_OF, str(tmp_path / f"to/{table}"), counts,
                str(tmp_path / f"progress/{table}"),
            )

    run()
    run()  # nothing new, nothing counted again
    stored = checks.read_counts(spark, counts)
    assert stored.filter("table_name = 'payments'").select("batch_id").distinct().count() == 3
    found = {tuple(r) for r in checks.totals(stored).collect()}
    every = run_checks(raw, AS_OF).select("code", "table_name", "severity", "n").collect()
    assert len(found) == 12 and found <= {tuple(r) for r in every}
    for table, df in raw.items():
        assert spark.read.parquet(str(tmp_path / f"to/{table}")).count() == df.count()


def test_crossings_name_the_batch(spark):
    rows = [("payments", "A10", n, b) for b, n in enumerate([1, 0, 3, 5])]
    rows += [("payments", "A11", 9, 0)]
    counts = spark.createDataFrame(rows, "table_name string, code string, n long, batch_id long")
    found = checks.crossings(counts, {"A10": 2, "A12": 0}).collect()
    assert [tuple(r) for r in found] == [("A10", "payments", 2, 4)]
    assert checks.crossings(counts, {"A10": 100, "A11": 8}).collect()[0].code == "A11"
