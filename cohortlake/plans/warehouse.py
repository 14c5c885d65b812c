"""The three layers: raw tables, staged tables written once, marts over them."""

import datetime as dt
import uuid
from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor
from threading import Lock

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from cohortlake.functions import period_start
from cohortlake.operators import staging
from cohortlake.plans import marts
from cohortlake.schemas import LAYERS, STAGED_PREFIX, TABLES
from cohortlake.sources.csvfiles import MissingInputs
from cohortlake.sources.layers import list_tables
from cohortlake.sources.snapshots import NOWHERE, Manifest, Snapshots, Stored


class WrittenLayer(Mapping):
    """Tables written to storage on first use and read from there.

    They lie at ``<root>/<layer>/<table>`` as a snapshot holds them, see
    ``sources.snapshots``; no manifest names them until ``build`` publishes one.
    With ``replace`` a table left behind by a failed attempt is written over.
    """

    _LAYER, _PREFIX = "", ""
    _NEEDS: dict[str, list[str]] = {}
    # Fact tables dealt by the month of a moment, and in its order within each file.
    _MOMENT: dict[str, str] = {}

    def __init__(self, source: Mapping[str, DataFrame], root: str, replace: bool = False):
        self.source, self.root = source, root
        self._mode = "overwrite" if replace else "errorifexists"
        self.stored: dict[str, Stored] = {}
        self._frames: dict[str, DataFrame] = {}
        self._locks = {table: Lock() for table in TABLES}

    def derive(self, table: str) -> DataFrame:
        """The lazy frame that gets written."""
        return self.source[table]

    def __getitem__(self, table: str) -> DataFrame:
        with self._locks[table]:
            if table not in self.stored:
                frame = self.derive(table)
                store, name = Snapshots(frame.sparkSession, self.root), self.name(table)
                moment = self._MOMENT.get(table)
                part = period_start(moment) if moment else NOWHERE
                folder = f"{self._LAYER}/{self._PREFIX}{table}"
                self.stored[table] = store.write(frame, name, part, moment, folder, self._mode)
                self._frames[table] = store.read(Manifest(tables={name: self.stored[table]}), name)
            return self._frames[table]

    @property
    def rows(self) -> dict[str, int]:
        """Rows of the tables written so far."""
        return {table: stored.rows() for table, stored in self.stored.items()}

    def folders(self, table: str) -> list[str]:
        """The folders of a table's files, for readers that watch files."""
        self[table]
        parts = self.stored[table].parts
        found = [f"{self.root}/{f}" for p in sorted(parts) for f, _ in parts[p]]
        return found or [f"{self.root}/{self._LAYER}/{self._PREFIX}{table}"]

    def name(self, table: str) -> str:
        """The table's name in a manifest."""
        return table_name(self._LAYER, self._PREFIX + table)

    def months(self, table: str) -> list[str]:
        """The months a table dealt by month has rows of, as text, earliest first."""
        self[table]
        return sorted(p for p in self.stored[table].parts if p != NOWHERE)

    def of_months(self, table: str, months: list[str]) -> DataFrame:
        """The rows of some months; no file of another is opened."""
        store, name = Snapshots(self[table].sparkSession, self.root), self.name(table)
        return store.read(Manifest(tables={name: self.stored[table]}), name, months)

    def within(self, table: str, first: dt.date, last: dt.date) -> DataFrame:
        """The rows of all months that touch the days from first to last."""
        low, high = (day.replace(day=1).isoformat() for day in (first, last))
        return self.of_months(table, [m for m in self.months(table) if low <= m <= high])

    def __iter__(self):
        return iter(TABLES)

    def __len__(self) -> int:
        return len(TABLES)

    def all(self) -> dict[str, DataFrame]:
        """Every table; those that need no other are written side by side."""
        alone = [t for t in self if not self._NEEDS.get(t)]
        with ThreadPoolExecutor(len(alone)) as pool:
            list(pool.map(self.__getitem__, alone))
        return {table: self[table] for table in self}


class _Nearest(Mapping):
    """The tables of a layer from storage where they are written by now, else as derived."""

    def __init__(self, layer: WrittenLayer):
        self._layer = layer

    def __getitem__(self, table: str) -> DataFrame:
        return (self._layer if table in self._layer.stored else self._layer.source)[table]

    def __iter__(self):
        return iter(self._layer)

    def __len__(self) -> int:
        return len(self._layer)


class RawLayer(WrittenLayer):
    """Raw tables mirrored once, for suites that read each of them many times."""

    _LAYER = "raw"

    @property
    def nearest(self) -> Mapping[str, DataFrame]:
        """The tables for readers that need no copy but use one that is there."""
        return _Nearest(self)


class StagedLayer(WrittenLayer):
    """Staged tables written to storage on first use, each reading the earlier ones.

    A mart that needs enrollments builds users, courses and enrollments and no
    more. Reading a written table keeps later plans short, lets several branches
    share the work, and makes every join with it shuffle afresh, which is where
    adaptive execution can split a hot key.
    """

    _NEEDS = {
        "users": [],
        "courses": [],
        "ad_costs": [],
        "enrollments": ["users", "courses"],
        "payments": ["users", "enrollments"],
        "payment_attempts": ["users", "payments"],
    }

    _LAYER, _PREFIX = "staging", STAGED_PREFIX
    _MOMENT = {
        "enrollments": "enrolled_at",
        "payments": "paid_at",
        "payment_attempts": "attempted_at",
    }

    def __init__(self, raw: Mapping[str, DataFrame], as_of, root: str, replace: bool = False):
        super().__init__(raw, root, replace)
        self.as_of = as_of

    def derive(self, table: str) -> DataFrame:
        inputs = [self[need] for need in self._NEEDS[table]]
        if table in ("users", "ad_costs"):
            inputs = [self.as_of]
        return getattr(staging, f"stage_{table}")(self.source[table], *inputs)


MARTS = [
    "mart_revenue", "mart_ad_performance", "mart_activity", "mart_completion", "mart_conversion",
]


def build_marts(layer) -> dict[str, DataFrame]:
    """The five marts of a staged layer (any mapping of table names to frames)."""
    users, courses, enrollments = layer["users"], layer["courses"], layer["enrollments"]
    payments, attempts = layer["payments"], layer["payment_attempts"]
    return {
        "mart_revenue": marts.mart_revenue(payments, courses),
        "mart_ad_performance": marts.mart_ad_performance(layer["ad_costs"], users, payments),
        "mart_activity": marts.mart_activity(enrollments),
        "mart_completion": marts.mart_completion(enrollments, courses),
        "mart_conversion": marts.mart_conversion(users, enrollments, payments, attempts),
    }


class AlreadyBuilt(AnalysisException):
    """The warehouse has a published build and none was to be replaced."""


def build(
    raw: Mapping[str, DataFrame], as_of, root: str, replace: bool = False
) -> dict[tuple[str, str], DataFrame]:
    """Write the three layers below ``root`` and return every table read back.

    ``root`` names a new warehouse; where one is published the build fails, unless
    ``replace`` asks to take its place. Every build writes files of its own and becomes
    the newest snapshot when all its tables are complete. Until then, and if it dies,
    readers see the build before.
    """
    spark = next(iter(raw.values())).sparkSession
    store = Snapshots(spark, root)
    old = store.head()
    if old.version and not replace:
        raise AlreadyBuilt(f"{root} holds build {old.version}; ask to replace it")
    folder = f"builds/{uuid.uuid4().hex}"
    mirrored = RawLayer(raw, f"{store.root}/{folder}")
    layer = StagedLayer(mirrored, as_of, f"{store.root}/{folder}")
    new = built(store, old, mirrored, layer, folder)
    new.notes["as_of"] = str(as_of)
    store.publish(new)
    return {tuple(name.split(".")): store.read(new, name) for name in new.tables}


def built(
    store: Snapshots, old: Manifest, raw: RawLayer, staged: StagedLayer, folder: str = "."
) -> Manifest:
    """A manifest after ``old`` of the marts and both layers, all written.

    ``folder`` is where the layers lie below the store's root.
    """
    raw.all()
    staged.all()
    marts_of = build_marts(staged)
    with ThreadPoolExecutor(len(marts_of)) as pool:
        written = pool.map(
            lambda name: store.write(marts_of[name], table_name("marts", name)), marts_of
        )
        tables = {table_name("marts", n): t for n, t in zip(marts_of, written, strict=True)}
    for layer in (raw, staged):
        tables |= {layer.name(t): layer.stored[t].below(folder) for t in layer}
    return Manifest(old.version + 1, dict(old.notes), tables)


def table_name(layer: str, table: str) -> str:
    """How a manifest of the warehouse names a table."""
    return f"{layer}.{table}"


def read_layer(spark: SparkSession, root: str, layer: str) -> dict[str, DataFrame]:
    """The tables of a layer of the newest build by their logical names, all required."""
    store = Snapshots(spark, root)
    manifest = store.head()
    names = MARTS if layer == "marts" else TABLES
    prefix = STAGED_PREFIX if layer == "staging" else ""
    wanted = {t: table_name(layer, prefix + t) for t in names}
    missing = [f"{root}: {name}" for name in wanted.values() if name not in manifest.tables]
    if missing:
        raise MissingInputs(missing)
    return {t: store.read(manifest, name) for t, name in wanted.items()}


def stored_counts(spark: SparkSession, manifest: Manifest) -> DataFrame:
    """``layer, table_name, row_count`` of a build, from its manifest alone."""
    rows = [(*name.split("."), stored.rows()) for name, stored in manifest.tables.items()]
    return spark.createDataFrame(rows, "layer string, table_name string, row_count long")


def stored_kept_and_excluded(spark: SparkSession, manifest: Manifest) -> DataFrame:
    """Rows kept and excluded by staging, per table, from a build's manifest alone."""
    rows = []
    for table in TABLES:
        raw = manifest.rows(table_name("raw", table))
        kept = manifest.rows(table_name("staging", STAGED_PREFIX + table))
        rows.append((table, raw, kept, raw - kept))
    columns = "table_name string, raw_rows long, kept_rows long, excluded_rows long"
    return spark.createDataFrame(rows, columns)


def register(
    spark: SparkSession, tables: dict[tuple[str, str], DataFrame], replace: bool = False
) -> dict[str, list[str]]:
    """Save the layers as catalog databases ``raw``, ``staging`` and ``marts``.

    Returns the tables of each database as the catalog lists them.
    """
    for layer in LAYERS:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {layer}")
    for (layer, table), df in tables.items():
        df.write.mode("overwrite" if replace else "errorifexists").saveAsTable(f"{layer}.{table}")
    return {layer: list_tables(spark, layer) for layer in LAYERS}
