"""Command line: build or extend a warehouse, check a layer, compare the checks, preview, export.

    python -m cohortlake build   --input DIR --warehouse DIR --as-of 2025-07-15
    python -m cohortlake load    --input DIR --warehouse DIR --as-of 2025-07-16
    python -m cohortlake check   --warehouse DIR --layer raw|staging --as-of 2025-07-15
    python -m cohortlake compare --warehouse DIR
    python -m cohortlake preview --warehouse DIR
    python -m cohortlake export  --warehouse DIR --to DIR --as-of 2025-07-15
"""

import argparse

from pyspark.sql import SparkSession

from cohortlake.functions import as_ntz
from cohortlake.operators import compare as C
from cohortlake.operators import quality as Q
from cohortlake.plans import reports, warehouse
from cohortlake.plans.maintenance import MaintainedWarehouse
from cohortlake.schemas import STAGED_PREFIX, TABLES
from cohortlake.session import configure, stored_state
from cohortlake.sources import csvfiles, layers, reporttext
from cohortlake.sources.snapshots import Snapshots

PREVIEW = ["payment_month", "paying_users", "revenue", "avg_check", "revenue_mom_pct"]


def build(
    spark: SparkSession,
    folder: str,
    root: str,
    as_of: str,
    replace: bool = False,
    register: bool = False,
) -> str:
    """Raw, staged and mart tables from CSV files; returns their sizes as text.

    With ``register`` they are saved as tables of the catalog as well.
    """
    raw = csvfiles.read_csv_layer(spark, folder)
    configure(spark, stored_state(spark, folder)[0])
    tables = warehouse.build(raw, as_of, root, replace)
    if register:
        warehouse.register(spark, tables, replace)
    sizes = warehouse.stored_counts(spark, Snapshots(spark, root).head())
    counts = {(r.layer, r.table_name): r.row_count for r in sizes.collect()}
    lines = [f"{layer:<8} {table:<24} {n:>14,}" for (layer, table), n in sorted(counts.items())]
    for t in TABLES:
        kept = counts["staging", STAGED_PREFIX + t]
        lines.append(f"{t}: {kept:,} kept, {counts['raw', t] - kept:,} excluded")
        bad = csvfiles.malformed_rows(spark, f"{folder.rstrip('/')}/{t}.csv", t)
        if bad:
            lines.append(f"{t}: {bad:,} rows with fields that do not fit, read as NULL")
    return "\n".join(lines)


def load(spark: SparkSession, folder: str, root: str, as_of: str) -> str:
    """Brings the maintained tables below ``<root>/loads`` forward by a folder of new rows."""
    kept = MaintainedWarehouse(spark, f"{root}/loads")
    configure(spark, stored_state(spark, folder)[0])
    before, after = kept.snapshots.head(), kept.load(csvfiles.read_csv_layer(spark, folder), as_of)
    lines = [f"load {after.version}, as of {as_of}"]
    for table in sorted(after.tables):
        new = after.rows(table) - before.rows(table)
        lines.append(f"{table:<24} {after.rows(table):>14,} {new:>+12,}")
    return "\n".join(lines)


def export(spark: SparkSession, root: str, folder: str, as_of: str) -> str:
    """The curators' lists as CSV below ``folder``."""
    layer = warehouse.read_layer(spark, root, "staging")
    users, enrollments, courses = (layer[t] for t in ("users", "enrollments", "courses"))
    last = reports.last_activity(users, enrollments)
    lists = {
        "active_students": reports.active_students(users, enrollments, courses, as_of, last),
        "at_risk_students": reports.at_risk_students(users, enrollments, courses, as_of, last=last),
    }
    for name, rows in lists.items():
        csvfiles.write_csv(rows, f"{folder}/{name}", "overwrite")
    return "\n".join(f"{folder}/{name}" for name in lists)


def check(spark: SparkSession, root: str, layer: str, as_of: str) -> str:
    """Runs the suite on a stored layer, keeps its results, returns the report."""
    tables = warehouse.read_layer(spark, root, layer)
    path = f"{root}/quality/{layer}"
    reporttext.store_results(Q.run_checks(tables, as_of), path)
    results = reporttext.load_results(spark, path)
    run = C.as_run(results, f"{layer}-{as_of}".replace(" ", "T"), as_ntz(as_of))
    reporttext.store_run(run, f"{root}/quality/history")
    volumes = layers.row_counts({(layer, t): df for t, df in tables.items()})
    text = reporttext.render_quality(results, volumes, layer)
    reporttext.write_text(spark, text, f"{root}/quality/{layer}_report")
    return text


def compare(spark: SparkSession, root: str) -> str:
    """Compares the stored results of raw and staging; returns the report."""
    paths = [f"{root}/quality/{layer}" for layer in ("raw", "staging")]
    csvfiles.require(spark, paths)
    before, after = (reporttext.load_results(spark, p) for p in paths)
    reporttext.store_compare(C.compare_runs(before, after), f"{root}/quality/compare")
    changes = reporttext.load_compare(spark, f"{root}/quality/compare")
    text = reporttext.render_compare(changes, C.compare_totals(before, after))
    for r in C.secondary_growth(before, after).collect():
        text += f"\n{r.code} grew from {r.before_n:,} to {r.after_n:,}: a side effect of cleaning.\n"
    reporttext.write_text(spark, text, f"{root}/quality/compare_report")
    return text


def preview(spark: SparkSession, root: str) -> str:
    """Tables with their sizes, and the first months of the revenue mart."""
    marts = warehouse.read_layer(spark, root, "marts")
    sizes = sorted(warehouse.stored_counts(spark, Snapshots(spark, root).head()).collect())
    lines = [f"{r.layer:<8} {r.table_name:<24} {r.row_count:>14,}" for r in sizes]
    head = layers.preview(marts["mart_revenue"], PREVIEW, "payment_month")
    lines += ["", " | ".join(PREVIEW)]
    lines += [" | ".join(str(v) for v in row) for row in head.collect()]
    return "\n".join(lines)


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="cohortlake", description=__doc__.splitlines()[0])
    commands = parser.add_subparsers(dest="command", required=True)
    for name in ("build", "load", "check", "compare", "preview", "export"):
        command = commands.add_parser(name)
        command.add_argument("--warehouse", required=True)
        if name in ("build", "load"):
            command.add_argument("--input", required=True)
        if name == "build":
            command.add_argument("--replace", action="store_true")
            command.add_argument("--register", action="store_true")
        if name == "check":
            command.add_argument("--layer", choices=["raw", "staging"], required=True)
        if name == "export":
            command.add_argument("--to", required=True)
        if name in ("build", "load", "check", "export"):
            command.add_argument("--as-of", required=True)
    given = parser.parse_args(arguments)
    spark = configure(SparkSession.builder.appName(f"cohortlake-{given.command}").getOrCreate())
    if given.command == "build":
        print(build(spark, given.input, given.warehouse, given.as_of, given.replace, given.register))
    elif given.command == "load":
        print(load(spark, given.input, given.warehouse, given.as_of))
    elif given.command == "export":
        print(export(spark, given.warehouse, given.to, given.as_of))
    elif given.command == "check":
        print(check(spark, given.warehouse, given.layer, given.as_of))
    elif given.command == "compare":
        print(compare(spark, given.warehouse))
    else:
        print(preview(spark, given.warehouse))


if __name__ == "__main__":
    main()
