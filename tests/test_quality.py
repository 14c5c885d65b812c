from pyspark.sql import functions as F

from cohortlake.operators import compare, quality
from cohortlake.sources import layers, reporttext
from tests.fixture import AS_OF, RAW_COUNTS, RULE_COUNTS, STAGED_COUNTS


def counts(results):
    return {r.code: r.n for r in results.collect()}


def test_raw(raw):
    assert counts(quality.run_checks(raw, AS_OF)) == RAW_COUNTS


def test_staged(staged):
    assert counts(quality.run_checks(staged, AS_OF)) == STAGED_COUNTS


def test_empty_tables(raw):
    empty = {t: df.limit(0) for t, df in raw.items()}
    assert counts(quality.run_checks(empty, AS_OF)) == dict.fromkeys(RAW_COUNTS, 0)


def test_extra_rules(raw):
    found = counts(quality.run_extra_rules(raw))
    assert {c: found[c] for c in RULE_COUNTS} == RULE_COUNTS
    # Attempts 2 (two payments), 4 (two), 1 (two), 7 and 14 (none).
    assert found["X5"] == 5


def test_summary_and_priorities(raw):
    results = quality.run_checks(raw, AS_OF)
    levels = {r.severity: (r.failed_checks, r.records) for r in quality.severity_summary(results).collect()}
    assert levels["TOTAL"] == (20, sum(RAW_COUNTS.values()))
    assert levels["CRITICAL"] == (9, 12)
    assert levels["WARNING"] == (8, 14)
    first = quality.priorities(results).collect()
    assert [r.code for r in first if r.urgency == "next"][:3] == ["A1", "A2", "A4"]
    assert {r.problem for r in first if r.code == "A6"} == {"Enrolled before registration"}
    assert quality.alerts(results, "r1", AS_OF).count() == 9
    assert quality.clean_checks(results).count() == 0


def test_compare(raw, staged):
    before, after = quality.run_checks(raw, AS_OF), quality.run_checks(staged, AS_OF)
    rows = {r.code: r for r in compare.compare_runs(before, after).collect()}
    assert len(rows) == 20
    assert rows["A16"].status == "secondary"
    assert rows["A1"].status == "removed" and rows["A1"].change_pct == -100
    assert {c for c, r in rows.items() if r.status == "remains"} == {"A3", "A4", "A7", "A8", "A13"}
    totals = {r.scope: r for r in compare.compare_totals(before, after).collect()}
    adjusted = totals["adjusted"]
    assert (adjusted.before_n, adjusted.after_n, adjusted.change_pct) == (27, 7, -74)
    assert (adjusted.checks_removed, adjusted.checks_remaining) == (14, 5)
    assert totals["all"].before_n == 29
    assert compare.secondary_growth(before, after).count() == 0
    assert compare.secondary_growth(after, before).count() == 1


def run(spark, **n):
    rows = [(c, "t", "CRITICAL", v, "d", "h") for c, v in n.items()]
    return quality.results_frame(spark, rows)


def test_compare_missing_codes_and_rounding(spark):
    before, after = run(spark, A1=8, A2=0, A4=200), run(spark, A1=9, A2=0, A3=4, A4=199)
    rows = {r.code: r for r in compare.compare_runs(before, after).collect()}
    assert set(rows) == {"A1", "A3", "A4"}
    assert rows["A1"].change_pct == 12  # 12.5 goes to the even neighbour
    assert rows["A4"].change_pct == 0
    assert rows["A3"].change_pct is None and rows["A3"].delta == 4


def test_history_of_runs(spark):
    at = lambda day: F.lit(f"2024-01-0{day} 00:00:00").cast("timestamp_ntz")
    runs = compare.as_run(run(spark, A1=5, A2=1), "a", at(1)).unionByName(
        compare.as_run(run(spark, A1=3, A2=1), "b", at(2))
    )
    rows = {(r.run_id, r.code): (r.previous_n, r.delta) for r in compare.run_history(runs).collect()}
    assert rows["a", "A1"] == (None, None)
    assert rows["b", "A1"] == (5, -2) and rows["b", "A2"] == (1, 0)


def test_stored_runs(spark, tmp_path):
    path, at = str(tmp_path / "runs"), F.lit("2024-01-01").cast("timestamp_ntz")
    for n in (5, 6):  # the same run twice
        reporttext.store_run(compare.as_run(run(spark, A1=n), "a", at), path)
    reporttext.store_run(compare.as_run(run(spark, A1=4), "b", at), path)
    rows = compare.run_history(reporttext.load_runs(spark, path)).collect()
    assert sorted((r.run_id, r.n, r.previous_n) for r in rows) == [("a", 6, None), ("b", 4, 6)]


def test_text_report_reads_back(spark, raw, tmp_path):
    results = quality.run_checks(raw, AS_OF)
    volumes = layers.row_counts({("raw", t): df for t, df in raw.items()})
    text = reporttext.render_quality(results, volumes, "raw")
    path = tmp_path / "report.md"
    path.write_text(text, encoding="utf-8")
    assert counts(reporttext.read_report(spark, str(path))) == RAW_COUNTS
    assert "- **A12** Paid before registration" in text


def test_old_report_lines(spark, tmp_path):
    path = tmp_path / "old.md"
    path.write_text(
        "| Код | Таблица | Записей |\n| `A1` | `users` | **1,234** | x |\n"
        "| `A7` | `enrollments` | 0 | x |\n| `A9` | `enrollments` | CRITICAL |\n",
        encoding="utf-8",
    )
    assert counts(reporttext.read_report(spark, str(path))) == {"A1": 1234, "A7": 0}


def test_stored_results_and_compare_text(spark, raw, staged, tmp_path):
    for name, tables in (("raw", raw), ("staging", staged)):
        reporttext.store_results(quality.run_checks(tables, AS_OF), str(tmp_path / name))
    before = reporttext.load_results(spark, str(tmp_path / "raw"))
    after = reporttext.load_results(spark, str(tmp_path / "staging"))
    assert counts(before) == RAW_COUNTS and counts(after) == STAGED_COUNTS
    text = reporttext.render_compare(
        compare.compare_runs(before, after), compare.compare_totals(before, after)
    )
    assert "| `A1` | 6 | 0 | -6 | -100% | removed |" in text
    assert "| Change | -74% |" in text
