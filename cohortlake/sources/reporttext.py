"""Quality results as a stored table, and as the text report people read.

The table is what later runs compare with. The text is laid out on the driver
from its 20 rows; reading counts back from such a text is kept for old reports.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlake.operators import quality as Q

RUN_SCHEMA = (
    "run_at timestamp_ntz, code string, table_name string, severity string, n bigint, run_id string"
)
COMPARE_SCHEMA = (
    "code string, before_n bigint, after_n bigint, delta bigint, change_pct double, status string"
)


def store_results(results: DataFrame, path: str) -> None:
    """One small file per run; running again replaces it."""
    results.coalesce(1).write.mode("overwrite").json(path)


def load_results(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(Q.RESULT_SCHEMA).json(path)


def store_compare(changes: DataFrame, path: str) -> None:
    """A comparison (see ``compare.compare_runs``) as a small file; running again replaces it."""
    changes.coalesce(1).write.mode("overwrite").json(path)


def load_compare(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(COMPARE_SCHEMA).json(path)


def store_run(run: DataFrame, path: str) -> None:
    """Add a run (see ``compare.as_run``) to the stored history; a repeated run replaces itself."""
    (
        run.coalesce(1)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("run_id")
        .parquet(path)
    )


def load_runs(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RUN_SCHEMA).parquet(path)


def write_text(spark: SparkSession, text: str, path: str) -> None:
    """A rendered report as one text file below ``path``."""
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(path)


def _table(header: list[str], rows: list[list]) -> list[str]:
    lines = ["| " + " | ".join(header) + " |", "|" + "---|" * len(header)]
    return lines + ["| " + " | ".join(str(c) for c in row) + " |" for row in rows]


def render_quality(results: DataFrame, volumes: DataFrame, layer: str) -> str:
    """Text report of one run: volumes, severity summary, findings, clean checks, priorities."""
    checks = sorted(results.collect(), key=lambda r: int(r.code[1:]))
    found = [r for r in checks if r.n > 0]
    clean = [r for r in checks if r.n == 0]
    summary = {r.severity: r for r in Q.severity_summary(results).collect()}
    lines = [f"# Data quality: {layer}", "", "## Volumes", ""]
    sizes = sorted(volumes.collect(), key=lambda r: r.table_name)
    lines += _table(["Table", "Rows"], [[r.table_name, f"{r.row_count:,}"] for r in sizes])
    lines += ["", "## Summary", ""]
    lines += _table(
        ["Level", "Failed checks", "Records"],
        [
            [level, summary[level].failed_checks, f"{summary[level].records:,}"]
            for level in (Q.CRITICAL, Q.WARNING, "TOTAL")
        ],
    )
    lines += ["", "## Findings", ""]
    lines += _table(
        ["Code", "Table", "Records", "Level", "Description", "Hint"],
        [
            [f"`{r.code}`", f"`{r.table_name}`", f"**{r.n:,}**", r.severity, r.description, r.fix_hint]
            for r in found
        ],
    )
    lines += ["", "## Clean checks", ""]
    lines += _table(
        ["Code", "Table", "Level"], [[f"`{r.code}`", f"`{r.table_name}`", r.severity] for r in clean]
    )
    if layer == "raw":
        for title, level in (("Fix now", Q.CRITICAL), ("Fix next", Q.WARNING)):
            lines += ["", f"## {title}", ""]
            lines += [
                f"- **{r.code}** {r.description.split(' — ')[0]}"
                for r in found
                if r.severity == level
            ]
    return "\n".join(lines) + "\n"


def render_compare(changes: DataFrame, totals: DataFrame) -> str:
    """Text report of a comparison: change per check and the adjusted totals."""

    def signed(value, empty):
        return empty if not value else f"{value:+,}"

    def pct(value):
        return "—" if value is None else f"{value:+.0f}%"

    rows = sorted(changes.collect(), key=lambda r: int(r.code[1:]))
    lines = ["# Data quality: before and after", ""]
    lines += _table(
        ["Code", "Before", "After", "Change", "%", "Status"],
        [
            [f"`{r.code}`", f"{r.before_n:,}", f"{r.after_n:,}", signed(r.delta, "unchanged"),
             pct(r.change_pct), r.status]
            for r in rows
        ],
    )
    total = totals.filter(F.col("scope") == "adjusted").first()
    lines += [""] + _table(
        ["", "Records"],
        [
            ["Before", f"{total.before_n:,}"],
            ["After", f"{total.after_n:,}"],
            ["Removed", f"{total.removed_n:,}"],
            ["Change", pct(total.change_pct)],
        ],
    )
    return "\n".join(lines) + "\n"


def report_lines(results: DataFrame) -> DataFrame:
    """The findings of a run as lines of a text report, formatted in Spark."""
    line = F.format_string(
        "| `%s` | `%s` | **%s** | %s | %s | %s |",
        "code", "table_name", F.format_number("n", 0), "severity", "description", "fix_hint",
    )
    return Q.findings(results).select(line.alias("value"))


def read_report(spark: SparkSession, path: str) -> DataFrame:
    """``code, n`` from a text report; checks listed without a number are absent."""
    cells = F.transform(F.split("value", r"\|"), lambda c: F.trim(c))
    codes = F.filter(cells, lambda c: c.rlike("^`A[0-9]+`$"))
    bold = F.filter(cells, lambda c: c.rlike(r"^\*\*[0-9,]+\*\*$"))
    plain = F.filter(cells, lambda c: c.rlike("^[0-9][0-9,]*$"))
    # A number in bold is the count; other numbers of the row are not.
    number = F.regexp_replace(F.coalesce(F.get(bold, 0), F.get(plain, 0)), "[*,]", "")
    return (
        spark.read.text(path)
        .select(F.regexp_replace(F.get(codes, 0), "`", "").alias("code"), number.alias("number"))
        .filter("code IS NOT NULL AND number IS NOT NULL")
        .groupBy("code")
        .agg(F.max(F.col("number").try_cast("bigint")).alias("n"))
    )
