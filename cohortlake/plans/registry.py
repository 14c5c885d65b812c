"""Named queries ``(spark, sf_dir) -> DataFrame`` over the source tables."""

import datetime as dt
from collections.abc import Callable, Mapping
from functools import cached_property, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlake.functions import as_ntz, period_start
from cohortlake.operators import (
    compare, corrections, distinct, history, keys, quality, reasons, reconcile,
)
from cohortlake.plans import marts, reports, warehouse
from cohortlake.plans.colocated import FACTS, ColocatedLayer
from cohortlake.plans.maintenance import MaintainedWarehouse
from cohortlake.plans.versions import MaintainedHistory
from cohortlake.plans.warehouse import (
    RawLayer, StagedLayer, built, stored_counts, stored_kept_and_excluded, table_name,
)
from cohortlake.schemas import SCHEMAS, STAGED_PREFIX, TABLES
from cohortlake.session import configure, partitions, run_folder, stored_state
from cohortlake.sources import bindings, csvfiles, layers, reporttext
from cohortlake.sources.bindings import AS_OF
from cohortlake.sources.snapshots import Manifest, Snapshots
from cohortlake.streaming import checks, incremental
from cohortlake.streaming.reconcile import unconfirmed_to_end

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

SUMMARY_START, SUMMARY_END = "1998-01-01", "1999-01-01"
# When the loads of the maintained warehouse are made.
LOAD_TIMES = ["1996-07-01 00:00:00", "1998-03-01 00:00:00", AS_OF]


class Source:
    """The tables of one folder, and the layers its queries share once written."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self._spark, self._root = spark, run_folder(spark, "warehouse")
        self.raw = bindings.RawTables(spark, sf_dir)

    @cached_property
    def raw_layer(self) -> RawLayer:
        return RawLayer(self.raw, self._root, replace=True)

    @cached_property
    def staged(self) -> StagedLayer:
        return StagedLayer(self.raw_layer.nearest, AS_OF, self._root, replace=True)

    def all_raw(self) -> dict[str, DataFrame]:
        """Every raw table, written."""
        self.raw.share_orders()
        return self.raw_layer.all()

    def all_staged(self) -> dict[str, DataFrame]:
        """Every staged table, written."""
        self.raw.share_orders()
        return self.staged.all()

    @cached_property
    def published(self) -> tuple[Snapshots, Manifest]:
        """Both layers and the marts as one published build."""
        self.raw.share_orders()
        store = Snapshots(self._spark, self._root)
        store.publish(built(store, store.head(), self.raw_layer, self.staged))
        return store, store.head()

    @cached_property
    def streamed_counts(self) -> DataFrame:
        """Counts of the checks of single rows, from a stream of each raw table's files."""
        work = run_folder(self._spark, "checked")
        for table in TABLES:
            for folder in self.raw_layer.folders(table):
                stream = incremental.file_stream(self._spark, SCHEMAS[table], folder)
                place = f"{work}/{table}", f"{work}/counts", f"{work}/progress/{table}"
                checks.load_checked(stream, table, AS_OF, *place)
        return checks.read_counts(self._spark, f"{work}/counts")

    @cached_property
    def colocated(self) -> ColocatedLayer:
        root = run_folder(self._spark, "colocated")
        return ColocatedLayer(self.raw_layer, AS_OF, root, partitions(self._spark))

    @cached_property
    def last_activity(self) -> DataFrame:
        return reports.last_activity(self.staged["users"], self.staged["enrollments"])

    @cached_property
    def judged(self) -> Mapping[str, DataFrame]:
        """Raw rows with the staging rules they break."""
        return reasons.judge_all(self.raw_layer, self.staged, AS_OF)

    @cached_property
    def raw_results(self) -> DataFrame:
        return self._stored("raw", self.all_raw())

    @cached_property
    def staged_results(self) -> DataFrame:
        return self._stored("staging", self.all_staged())

    @cached_property
    def maintained(self) -> MaintainedWarehouse:
        """The warehouse after three loads of the raw tables, see ``_arrivals``."""
        warehouse = MaintainedWarehouse(self._spark, run_folder(self._spark, "maintained"))
        arrivals = {t: _arrivals(t, df) for t, df in self.all_raw().items()}
        for number, as_of in enumerate(LOAD_TIMES):
            batch = {t: df.filter(F.col("_load") == number) for t, df in arrivals.items()}
            warehouse.load(batch, as_of)
        return warehouse

    def _stored(self, layer: str, tables: Mapping[str, DataFrame]) -> DataFrame:
        """Results of a quality run, kept as a table for the queries that read results."""
        path = run_folder(self._spark, f"quality-{layer}")
        reporttext.store_results(quality.run_checks(tables, AS_OF), path)
        return reporttext.load_results(self._spark, path)


def _arrivals(table: str, rows: DataFrame) -> DataFrame:
    """Raw rows with the load they come with.

    Facts come with the first load after them, some one load late. Users and courses
    come by their number, so an e-mail's smallest account or the course of a payment
    may come after the rows that depend on it.
    """
    last = len(LOAD_TIMES) - 1
    moments = {
        "enrollments": ("enrolled_at", F.col("enrollment_id") % 11 == 4),
        "payments": ("paid_at", F.col("payment_id") % 13 == 5),
        "payment_attempts": ("attempted_at", F.col("attempt_id") % 7 == 3),
        "ad_costs": ("date", F.dayofmonth("date") == 30),
    }
    if table in moments:
        moment, late = moments[table]
        at = F.col(moment).cast("timestamp_ntz")
        number = F.lit(last)
        for k in reversed(range(last)):
            number = F.when(at < as_ntz(LOAD_TIMES[k]), k).otherwise(number)
        number = F.least(number + F.coalesce(late.cast("int"), F.lit(0)), F.lit(last))
    else:
        number = F.col("user_id" if table == "users" else "course_id") % len(LOAD_TIMES)
    return rows.withColumn("_load", number)


_sources: dict[tuple, Source] = {}


def source(spark: SparkSession, sf_dir: str) -> Source:
    """The source, shared by the queries of one application while its files stay the same.

    The session's shuffles are sized from the bytes of the files on the way.
    """
    files = [stored_state(spark, f"{sf_dir}/{t}.parquet") for t in bindings.SOURCES]
    configure(spark, sum(size for size, _, _ in files), bindings.UNPACKED)
    key = (spark.sparkContext.applicationId, sf_dir, *files)
    if key not in _sources:
        _sources[key] = Source(spark, sf_dir)
    return _sources[key]


def raw(spark: SparkSession, sf_dir: str) -> Mapping[str, DataFrame]:
    """Raw tables as lazy frames."""
    return source(spark, sf_dir).raw


def raw_layer(spark: SparkSession, sf_dir: str) -> RawLayer:
    """Raw tables written once, for queries that read one of them more than once.

    A quality run reads payments and enrollments four times each.
    """
    return source(spark, sf_dir).raw_layer


def staged(spark: SparkSession, sf_dir: str) -> StagedLayer:
    return source(spark, sf_dir).staged


def _query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _on_raw(name: str, fn: Callable[[Mapping], DataFrame]) -> None:
    QUERIES[name] = lambda spark, sf_dir: fn(raw(spark, sf_dir))


def _on_raw_layer(name: str, fn: Callable[[RawLayer], DataFrame]) -> None:
    QUERIES[name] = lambda spark, sf_dir: fn(raw_layer(spark, sf_dir))


def _on_staged(name: str, fn: Callable[[StagedLayer], DataFrame]) -> None:
    QUERIES[name] = lambda spark, sf_dir: fn(staged(spark, sf_dir))


# Staging and marts

for _table in TABLES:
    _on_staged(STAGED_PREFIX + _table, lambda layer, t=_table: layer.derive(t))

for _table in FACTS:
    QUERIES[f"colocated_{STAGED_PREFIX}{_table}"] = lambda spark, sf_dir, t=_table: source(
        spark, sf_dir
    ).colocated[t]

_on_staged("mart_revenue", lambda s: marts.mart_revenue(s["payments"], s["courses"]))
_on_staged(
    "mart_ad_performance",
    lambda s: marts.mart_ad_performance(s["ad_costs"], s["users"], s["payments"]),
)
_on_staged("mart_activity", lambda s: marts.mart_activity(s["enrollments"]))
_on_staged("mart_completion", lambda s: marts.mart_completion(s["enrollments"], s["courses"]))
_on_staged(
    "mart_conversion",
    lambda s: marts.mart_conversion(
        s["users"], s["enrollments"], s["payments"], s["payment_attempts"]
    ),
)


# Quality


def _counts(results: DataFrame) -> DataFrame:
    return results.select("code", "table_name", "severity", "n")


def _results(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Stored results of the raw and the staged layer."""
    tables = source(spark, sf_dir)
    return tables.raw_results, tables.staged_results


@_query
def dq_raw(spark, sf_dir):
    return _counts(quality.run_checks(source(spark, sf_dir).all_raw(), AS_OF))


@_query
def dq_staging(spark, sf_dir):
    return _counts(quality.run_checks(source(spark, sf_dir).all_staged(), AS_OF))


@_query
def dq_compare(spark, sf_dir):
    return compare.compare_runs(*_results(spark, sf_dir))


@_query
def dq_compare_totals(spark, sf_dir):
    return compare.compare_totals(*_results(spark, sf_dir))


@_query
def dq_secondary_growth(spark, sf_dir):
    return compare.secondary_growth(*_results(spark, sf_dir))


@_query
def dq_stored_compare(spark, sf_dir):
    """The comparison stored as a table and read back."""
    path = run_folder(spark, "compare")
    reporttext.store_compare(compare.compare_runs(*_results(spark, sf_dir)), path)
    return reporttext.load_compare(spark, path)


@_query
def dq_secondary_growth_without_refunds(spark, sf_dir):
    """What leaving refunded payments out makes worse: successes that lose their payment."""
    tables = dict(source(spark, sf_dir).all_raw())
    tables["payments"] = tables["payments"].filter(F.col("status") != "refunded")
    after = quality.run_checks(tables, AS_OF)
    return compare.secondary_growth(source(spark, sf_dir).raw_results, after)


@_query
def dq_run_history(spark, sf_dir):
    before, after = _results(spark, sf_dir)
    path = run_folder(spark, "runs")
    reporttext.store_run(compare.as_run(before, "raw", as_ntz(AS_OF)), path)
    reporttext.store_run(compare.as_run(after, "staging", as_ntz("1999-07-01")), path)
    return compare.run_history(reporttext.load_runs(spark, path))


@_query
def dq_severity_summary(spark, sf_dir):
    return quality.severity_summary(source(spark, sf_dir).raw_results)


@_query
def dq_table_summary(spark, sf_dir):
    return quality.table_summary(source(spark, sf_dir).raw_results)


@_query
def dq_clean_checks(spark, sf_dir):
    return quality.clean_checks(source(spark, sf_dir).staged_results)


@_query
def dq_priorities(spark, sf_dir):
    return quality.priorities(source(spark, sf_dir).raw_results)


@_query
def dq_alerts(spark, sf_dir):
    rows = quality.alerts(source(spark, sf_dir).raw_results, "raw", AS_OF)
    return rows.select("run_id", "raised_at", "code", "table_name", "n")


@_query
def dq_report_text(spark, sf_dir):
    """The findings written as a text report and read back."""
    path = run_folder(spark, "report")
    reporttext.report_lines(source(spark, sf_dir).raw_results).write.text(path)
    return reporttext.read_report(spark, path)


@_query
def dq_stored_results(spark, sf_dir):
    """Results stored as a table and read back."""
    return _counts(source(spark, sf_dir).raw_results)


@_query
def dq_stream_totals(spark, sf_dir):
    """The checks that need one row at a time, counted while each table streams in."""
    return checks.totals(source(spark, sf_dir).streamed_counts)


@_query
def dq_stream_alerts(spark, sf_dir):
    """Critical checks of the stream, and the batch in which they first found something."""
    critical = [c for c, d in quality.CHECKS.items() if d[1] == quality.CRITICAL]
    return checks.crossings(source(spark, sf_dir).streamed_counts, dict.fromkeys(critical, 0))


_on_raw_layer("dq_extra_rules", lambda r: _counts(quality.run_extra_rules(r)))


def _rules_against_active(layer: RawLayer) -> DataFrame:
    """The extra rules where only active users and published courses count as known."""
    users = layer["users"].filter(F.col("is_active") == 1)
    courses = layer["courses"].filter(F.col("is_published") == 1)
    return _counts(quality.run_extra_rules({**layer, "users": users, "courses": courses}))


_on_raw_layer("dq_extra_rules_on_active", _rules_against_active)
_on_raw(
    "dq_seasonal_correlation",
    lambda r: quality.seasonal_correlation(r["users"], r["ad_costs"]),
)


def _unknown_domain_values(tables: Mapping[str, DataFrame]) -> DataFrame:
    parts = [
        corrections.unknown_values(tables[t], domains).withColumn("table_name", F.lit(t))
        for t, domains in corrections.DOMAINS.items()
    ]
    return reduce(DataFrame.unionByName, parts)


_on_raw("unknown_domain_values", _unknown_domain_values)


# Layers and files


@_query
def layer_row_counts(spark, sf_dir):
    """Rows of all tables of the build, from its manifest."""
    _, manifest = source(spark, sf_dir).published
    return stored_counts(spark, manifest)


@_query
def staging_kept_excluded(spark, sf_dir):
    _, manifest = source(spark, sf_dir).published
    return stored_kept_and_excluded(spark, manifest)


@_query
def preview_topk(spark, sf_dir):
    store, manifest = source(spark, sf_dir).published
    columns = ["payment_month", "paying_users", "revenue", "avg_check", "revenue_mom_pct"]
    mart = store.read(manifest, table_name("marts", "mart_revenue"))
    return layers.preview(mart, columns, "payment_month")


@_query
def rebuilt_mart_revenue(spark, sf_dir):
    """The mart of a warehouse built twice: the second build takes the place of the first."""
    tables, root = source(spark, sf_dir).all_raw(), run_folder(spark, "rebuilt")
    warehouse.build({**tables, "payments": tables["payments"].limit(0)}, AS_OF, root)
    try:
        warehouse.build(tables, AS_OF, root)
    except warehouse.AlreadyBuilt:
        warehouse.build(tables, AS_OF, root, replace=True)
    return warehouse.read_layer(spark, root, "marts")["mart_revenue"]


@_query
def csv_round_trip(spark, sf_dir):
    """Courses exported as CSV and read back with the declared schema."""
    path = run_folder(spark, "courses")
    csvfiles.write_csv(raw(spark, sf_dir)["courses"], path)
    return csvfiles.read_csv(spark, path, "courses")


@_query
def coerced_timestamps(spark, sf_dir):
    """Registration times held as text, some of them unreadable."""
    text = F.when(F.col("user_id") % 9 == 4, "n/a").otherwise(F.col("registered_at").cast("string"))
    users = raw(spark, sf_dir)["users"].withColumn("registered_at", text)
    return csvfiles.coerce_timestamps(users, ["registered_at"]).select("user_id", "registered_at")


# Keys


@_query
def dedupe_min_key(spark, sf_dir):
    source(spark, sf_dir)
    parts = bindings.read(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type")
    return keys.keep_smallest_id(parts, "p_name", "p_partkey")


@_query
def dedupe_first_enrollment(spark, sf_dir):
    return keys.keep_first(
        raw(spark, sf_dir)["enrollments"], ["user_id", "course_id"], "enrollment_id"
    )


@_query
def orphan_anti_join(spark, sf_dir):
    tables = raw(spark, sf_dir)
    return keys.orphans(
        tables["payment_attempts"],
        tables["users"].filter(F.col("is_active") == 1),
        ["user_id"],
        "user_id",
    )


@_query
def existence_filter(spark, sf_dir):
    """Attempts that are not (successful and without a payment), on raw tables.

    With three-valued logic a row without result stays only if it has a payment,
    as a success does.
    """
    tables = raw_layer(spark, sf_dir)
    attempts = tables["payment_attempts"]
    paid = keys.key_set(tables["payments"], ["user_id", "course_id"], "payment_id")
    settled = F.col("result") != "success"
    open_rows = attempts.filter(F.coalesce(~settled, F.lit(True)))
    confirmed = open_rows.join(paid, ["user_id", "course_id"], "left_semi")
    return attempts.filter(settled).unionByName(confirmed.select(*attempts.columns))


@_query
def duplicate_email_members(spark, sf_dir):
    return keys.duplicate_members(raw(spark, sf_dir)["users"], ["email"])


@_query
def attempts_renumbered(spark, sf_dir):
    """Attempts numbered from 1 in the order of their time."""
    attempts = raw(spark, sf_dir)["payment_attempts"].withColumnRenamed("attempt_id", "source_id")
    ordered = attempts.select("source_id", "attempted_at", "user_id", "result").orderBy(
        "attempted_at", "source_id"
    )
    return keys.number_rows(ordered, "attempt_id", run_folder(spark, "numbered"))


# Reports

_on_staged("report_lifetime_value", lambda s: reports.lifetime_value(s["payments"]))
_on_staged(
    "report_registrations_by_channel", lambda s: reports.registrations_by_channel(s["users"])
)
_on_staged("report_active_users", lambda s: reports.active_users(s["enrollments"]))


@_query
def active_users_rollup(spark, sf_dir):
    """Active users from bitmaps: two loads merged by day, days rolled up to weeks and months."""
    enrollments = staged(spark, sf_dir)["enrollments"]
    loads = [
        layers.materialize(
            distinct.daily_members(enrollments.filter(part), "user_id", "enrolled_at"), "members"
        )
        for part in (F.col("enrollment_id") % 3 == 0, F.col("enrollment_id") % 3 != 0)
    ]
    days = layers.materialize(distinct.merged(*loads), "members")
    grains = {"day": days, "week": distinct.rolled_up(days, "week")}
    grains["month"] = distinct.rolled_up(days, "month")
    parts = [
        distinct.counted(members, "active_users").select(
            F.lit(grain).alias("grain"), "period", "active_users"
        )
        for grain, members in grains.items()
    ]
    return reduce(DataFrame.unionByName, parts)


_on_staged("report_top_subjects", lambda s: reports.top_subjects(s["payments"], s["courses"]))
_on_staged(
    "report_revenue_ytd", lambda s: reports.revenue_year_to_date(s["payments"], s["courses"])
)
_on_staged("report_weekly_revenue", lambda s: reports.weekly_revenue(s["payments"], s["courses"]))
_on_staged("report_new_payers", lambda s: reports.new_payers(s["payments"]))
_on_staged("report_top_products", lambda s: reports.top_products(s["payments"], s["courses"]))


def _last_six_months(layer: StagedLayer) -> DataFrame:
    """The report from the files of its months, and of the last month with revenue before."""
    today = dt.date.fromisoformat(AS_OF[:10])
    number = today.year * 12 + today.month - 1 - 6
    first = dt.date(number // 12, number % 12 + 1, 1).isoformat()
    months = layer.months("payments")
    chosen = [m for m in months if first <= m < today.replace(day=1).isoformat()]
    for month in reversed([m for m in months if m < first]):
        chosen.append(month)
        before = layer.of_months("payments", [month])
        if not marts.revenue_by_period(before, layer["courses"]).isEmpty():
            break
    return reports.last_months(layer.of_months("payments", chosen), layer["courses"], AS_OF)


_on_staged("report_last_six_months", _last_six_months)
_on_staged(
    "report_revenue_structure", lambda s: reports.revenue_structure(s["payments"], s["courses"])
)
_on_staged(
    "report_weekly_channels",
    lambda s: reports.weekly_channels(s["ad_costs"], s["users"], s["payments"]),
)
_on_staged(
    "report_channel_summary",
    lambda s: reports.channel_summary(
        s["ad_costs"], s["users"], s["payments"], SUMMARY_START, SUMMARY_END
    ),
)
_on_staged(
    "report_weekly_funnel",
    lambda s: marts.mart_conversion(
        s["users"], s["enrollments"], s["payments"], s["payment_attempts"], "week"
    ),
)
_on_staged(
    "report_cohort_matrix", lambda s: reports.cohort_matrix(marts.mart_activity(s["enrollments"]))
)
_on_staged("report_dropout_histogram", lambda s: reports.dropout_histogram(s["enrollments"]))
_on_staged(
    "report_low_completion", lambda s: reports.low_completion(s["enrollments"], s["courses"])
)


@_query
def export_active_students(spark, sf_dir):
    layer, last = staged(spark, sf_dir), source(spark, sf_dir).last_activity
    return reports.active_students(
        layer["users"], layer["enrollments"], layer["courses"], AS_OF, last
    )


@_query
def export_at_risk_students(spark, sf_dir):
    layer, last = staged(spark, sf_dir), source(spark, sf_dir).last_activity
    return reports.at_risk_students(
        layer["users"], layer["enrollments"], layer["courses"], AS_OF, last=last
    )


def _through_csv(name: str) -> None:
    def exported(spark, sf_dir):
        """An export written as CSV and read back."""
        rows, path = QUERIES[name](spark, sf_dir), run_folder(spark, name)
        csvfiles.write_csv(rows, path)
        return csvfiles.read_export(spark, path, rows.schema)

    QUERIES[f"{name}_csv"] = exported


for _export in ("export_active_students", "export_at_risk_students"):
    _through_csv(_export)


@_query
def report_operations(spark, sf_dir):
    """The counters; of payments and attempts only the files of their months are read."""
    layer, last = staged(spark, sf_dir), source(spark, sf_dir).last_activity
    today = dt.date.fromisoformat(AS_OF[:10])
    since = min(today.replace(day=1), today - dt.timedelta(days=6))
    recent = [layer.within(t, since, today) for t in ("payments", "payment_attempts")]
    return reports.operations_counters(
        layer["users"], layer["enrollments"], layer["courses"], *recent, AS_OF, last
    )


_on_staged(
    "report_course_completion", lambda s: reports.course_completion(s["enrollments"], s["courses"])
)
_on_raw("report_refund_rate", lambda r: reports.refund_rate(r["payments"]))
_on_raw(
    "report_payment_dropoff", lambda r: reports.payment_dropoff(r["payment_attempts"], r["users"])
)
_on_staged("report_daily_payments", lambda s: reports.daily_payments(s["payments"]))


# Corrections, history, reconciliation, incremental load

_on_raw("flagged_users", lambda r: corrections.flag_users(r["users"], AS_OF))
_on_raw("flagged_courses", lambda r: corrections.flag_courses(r["courses"]))
_on_raw_layer(
    "flagged_attempts", lambda r: corrections.flag_attempts(r["payment_attempts"], r["users"])
)
_on_raw("flagged_ad_costs", lambda r: corrections.flag_ad_costs(r["ad_costs"]))
_on_staged(
    "quarantined_enrollments",
    lambda s: corrections.quarantine(s.source["enrollments"], s["enrollments"], "enrollment_id"),
)
for _table in TABLES:
    QUERIES[f"quarantine_{_table}"] = lambda spark, sf_dir, t=_table: reasons.quarantined(
        source(spark, sf_dir).judged[t]
    )


@_query
def staging_reasons(spark, sf_dir):
    """Rows per table and set of broken rules; the empty set is what staging keeps."""
    return reasons.reason_counts(source(spark, sf_dir).judged)


@_query
def staging_rule_counts(spark, sf_dir):
    return reasons.rule_counts(source(spark, sf_dir).judged)


_on_raw("transactions", lambda r: corrections.split_refunds(r["payments"]))
_on_raw("net_revenue", lambda r: corrections.net_revenue(r["payments"]))
_on_raw(
    "users_in_utc", lambda r: corrections.to_utc(r["users"], ["registered_at"], "Europe/Moscow")
)
_on_raw_layer(
    "unconfirmed_attempts",
    lambda r: reconcile.unconfirmed_attempts(r["payment_attempts"], r["payments"]),
)


@_query
def unconfirmed_attempts_stream(spark, sf_dir):
    """The same attempts found by a join of two streams with watermarks, run to their end."""
    tables = raw_layer(spark, sf_dir)
    attempts, payments = (tables.folders(t)[0] for t in ("payment_attempts", "payments"))
    return unconfirmed_to_end(spark, attempts, payments, run_folder(spark, "unconfirmed"))


def _course_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    source(spark, sf_dir)
    snapshots = bindings.course_snapshots(spark, sf_dir)
    return history.build_history(
        snapshots, "course_id", ["price_rub", "is_published"], "observed_at"
    )


@_query
def course_history(spark, sf_dir):
    return _course_history(spark, sf_dir)


@_query
def merged_course_history(spark, sf_dir):
    """The same history merged from four batches, the latest months first."""
    source(spark, sf_dir)
    merged = MaintainedHistory(
        spark, run_folder(spark, "history"), "course_id", ["price_rub", "is_published"], "observed_at"
    )
    snapshots = bindings.course_snapshots(spark, sf_dir)
    for rest in reversed(range(4)):
        merged.merge(snapshots.filter(F.month("observed_at") % 4 == rest))
    return merged.versions()


@_query
def payments_at_list_price(spark, sf_dir):
    """Payments with the course version valid when they were made."""
    payments = raw_layer(spark, sf_dir)["payments"].select(
        "payment_id", "user_id", "course_id", "paid_at", "amount_rub"
    )
    versions = _course_history(spark, sf_dir)
    return history.join_at_time(payments, versions, "course_id", "paid_at")


@_query
def revenue_of_courses_on_sale(spark, sf_dir):
    """Monthly revenue of courses published at the time of payment, not now."""
    paid = marts.successful(raw_layer(spark, sf_dir)["payments"]).filter(F.col("amount_rub") > 0)
    on_sale = _course_history(spark, sf_dir).filter(F.col("is_published") == 1)
    sold = history.join_at_time(paid, on_sale, "course_id", "paid_at", "left_semi")
    return sold.groupBy(period_start("paid_at").alias("payment_month")).agg(
        F.sum("amount_rub").alias("revenue"), F.count(F.lit(1)).alias("transactions")
    )


@_query
def incremental_daily_orders(spark, sf_dir):
    """Order value per day, loaded as a stream of files and refreshed by touched month."""
    source(spark, sf_dir)
    folder = run_folder(spark, "incremental")
    schema = bindings.read(spark, sf_dir, "orders").schema
    stream = incremental.table_stream(spark, schema, f"{sf_dir}/orders.parquet")
    facts, mart = f"{folder}/orders", f"{folder}/daily"

    def daily(orders):
        value = F.floor("o_totalprice").cast("bigint")
        return orders.groupBy("month", period_start("o_orderdate", "day").alias("day")).agg(
            F.count(F.lit(1)).alias("orders"), F.sum(value).alias("value_rub")
        )

    def refresh(batch_id):
        loaded = incremental.read_loaded(spark, schema, facts)
        incremental.refresh_months(loaded, batch_id, daily, mart)

    incremental.load_new(stream, "o_orderdate", facts, f"{folder}/checkpoint", refresh)
    return spark.read.parquet(mart).select("month", "day", "orders", "value_rub")


# The warehouse after three loads, each mart as the full build has it


def _on_maintained(name: str, fn: Callable[[MaintainedWarehouse], DataFrame]) -> None:
    QUERIES[name] = lambda spark, sf_dir: fn(source(spark, sf_dir).maintained)


for _table in TABLES:
    _on_maintained(
        f"incremental_{STAGED_PREFIX}{_table}", lambda w, t=_table: w.read(STAGED_PREFIX + t)
    )
for _mart in ("revenue", "ad_performance", "activity", "completion", "conversion"):
    _on_maintained(f"incremental_{_mart}", lambda w, m=f"mart_{_mart}": getattr(w, m)())


@_query
def incremental_row_counts(spark, sf_dir):
    """Rows of the raw and staged tables, from the manifest of the last load alone."""
    snapshots = source(spark, sf_dir).maintained.snapshots
    counts = snapshots.row_counts(snapshots.head())
    names = [*TABLES, *(STAGED_PREFIX + t for t in TABLES)]
    return counts.filter(F.col("table_name").isin(names))
