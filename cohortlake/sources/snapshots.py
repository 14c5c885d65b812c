"""Tables as immutable files that a numbered manifest lists.

Readers see the newest manifest and nothing else. A load writes new files beside
the old ones and becomes visible when its manifest appears, in one rename that
fails if another load came first. A load that dies leaves the tables as they were.

    <root>/data/<name>-<random>/snapshot_part=<part>/*.parquet
    <root>/manifests/00000007.json
"""

import json
import uuid
from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortlake.session import _file_system, exists

_PART = "snapshot_part"
# The part of rows that have no value to be placed by, and of tables without parts.
NOWHERE = "none"


class Conflict(RuntimeError):
    """Another load was published since this one began."""


@dataclass
class Stored:
    """One table of a manifest: its schema, and the folders and rows of each part."""

    schema: str
    parts: dict[str, list[tuple[str, int]]] = field(default_factory=dict)

    def rows(self) -> int:
        return sum(rows for folders in self.parts.values() for _, rows in folders)

    def below(self, folder: str) -> "Stored":
        """The same files as seen from a folder further up."""
        parts = {p: [(f"{folder}/{f}", n) for f, n in fs] for p, fs in self.parts.items()}
        return Stored(self.schema, parts)


@dataclass
class Manifest:
    """What one snapshot holds. ``notes`` are the loader's own words."""

    version: int = 0
    notes: dict[str, str] = field(default_factory=dict)
    tables: dict[str, Stored] = field(default_factory=dict)

    def next(self, **notes: str) -> "Manifest":
        tables = {n: Stored(t.schema, dict(t.parts)) for n, t in self.tables.items()}
        return Manifest(self.version + 1, self.notes | notes, tables)

    def rows(self, table: str) -> int:
        return self.tables[table].rows() if table in self.tables else 0

    def to_json(self) -> str:
        tables = {n: {"schema": t.schema, "parts": t.parts} for n, t in self.tables.items()}
        return json.dumps({"version": self.version, "notes": self.notes, "tables": tables})

    @classmethod
    def from_json(cls, text: str) -> "Manifest":
        read = json.loads(text)
        tables = {
            n: Stored(t["schema"], {p: [(f, r) for f, r in fs] for p, fs in t["parts"].items()})
            for n, t in read["tables"].items()
        }
        return cls(read["version"], read["notes"], tables)


class Snapshots:
    """The snapshots below one root, on any file system Spark reaches."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    # Manifests

    def _manifest(self, version: int) -> str:
        return f"{self.root}/manifests/{version:08d}.json"

    def versions(self) -> list[int]:
        """Numbers of all published snapshots, oldest first."""
        folder = f"{self.root}/manifests"
        if not exists(self.spark, folder):
            return []
        files, path = _file_system(self.spark, folder)
        names = [status.getPath().getName() for status in files.listStatus(path)]
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[0] != ".")

    def at(self, version: int) -> Manifest:
        files, path = _file_system(self.spark, self._manifest(version))
        stream = files.open(path)
        try:
            return Manifest.from_json(
                self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
            )
        finally:
            stream.close()

    def head(self) -> Manifest:
        """The newest snapshot; an empty one of version 0 before the first load."""
        versions = self.versions()
        return self.at(versions[-1]) if versions else Manifest()

    def publish(self, manifest: Manifest) -> None:
        """Makes a snapshot the newest; ``Conflict`` if its number is taken.

        The rename neither replaces a manifest nor shows half of one.
        """
        target = self._manifest(manifest.version)
        files, path = _file_system(self.spark, target)
        draft = path.getParent().suffix(f"/.{uuid.uuid4().hex}")
        out = files.create(draft, False)
        out.write(bytearray(manifest.to_json(), "utf-8"))
        out.close()
        context = self.spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(
            files.getUri(), self.spark._jsc.hadoopConfiguration()
        )
        kind = getattr(self.spark._jvm.org.apache.hadoop.fs, "Options$Rename")
        options = self.spark.sparkContext._gateway.new_array(kind, 1)
        options[0] = kind.NONE
        try:
            context.rename(draft, path, options)
        except Exception as error:
            if manifest.version in self.versions():
                raise Conflict(f"version {manifest.version} is already published") from error
            raise

    # Tables

    def write(
        self,
        df: DataFrame,
        name: str,
        part: Column | str = NOWHERE,
        order: str | None = None,
        folder: str | None = None,
        mode: str = "errorifexists",
    ) -> Stored:
        """New files for a frame, by ``part`` read as text; not visible until published.

        Where a column deals them, parts are balanced by size: a large one is several
        files and small ones are one. ``order`` sorts the rows of a file. Rows are counted
        from the files' footers. The files lie in a folder of their own, unless one is named.
        """
        folder = folder or f"data/{name}-{uuid.uuid4().hex}"
        if isinstance(part, str):
            placed = df.withColumn(_PART, F.lit(part))
        else:
            value = F.coalesce(part.cast("string"), F.lit(NOWHERE))
            placed = df.withColumn(_PART, value).hint("rebalance", _PART)
        if order is not None:
            placed = placed.sortWithinPartitions(_PART, order)
        writer = placed.write.mode(mode).option("compression", "zstd").partitionBy(_PART)
        writer.parquet(f"{self.root}/{folder}")
        schema = T.StructType([*df.schema.fields, T.StructField(_PART, T.StringType())])
        written = self.spark.read.schema(schema).parquet(f"{self.root}/{folder}")
        counts = written.groupBy(_PART).agg(F.count(F.lit(1)).alias("rows")).collect()
        parts = {r[_PART]: [(f"{folder}/{_PART}={r[_PART]}", r.rows)] for r in counts}
        return Stored(df.schema.json(), parts)

    def read(
        self, manifest: Manifest, table: str, parts: Iterable[str] | None = None
    ) -> DataFrame:
        """A table as a snapshot holds it, or only some of its parts: no other file is opened."""
        stored = manifest.tables[table]
        schema = T.StructType.fromJson(json.loads(stored.schema))
        chosen = stored.parts if parts is None else {p for p in parts if p in stored.parts}
        folders = [f for p in sorted(chosen) for f, _ in stored.parts[p]]
        if not folders:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.root}/{f}" for f in folders])

    def row_counts(self, manifest: Manifest) -> DataFrame:
        """``table_name, row_count`` of a snapshot, from its manifest alone."""
        rows = [(name, stored.rows()) for name, stored in sorted(manifest.tables.items())]
        return self.spark.createDataFrame(rows, "table_name string, row_count long")


def add_parts(manifest: Manifest, table: str, written: Stored) -> None:
    """Further files of a table beside those it has."""
    stored = manifest.tables.setdefault(table, Stored(written.schema))
    for part, folders in written.parts.items():
        stored.parts[part] = [*stored.parts.get(part, []), *folders]


def replace_parts(
    manifest: Manifest, table: str, written: Stored, parts: Iterable[str] | None = None
) -> None:
    """Files in place of those of ``parts`` (of the whole table, if None)."""
    stored = manifest.tables.setdefault(table, Stored(written.schema))
    gone = set(stored.parts) if parts is None else set(parts)
    kept = {p: f for p, f in stored.parts.items() if p not in gone}
    stored.parts = kept | written.parts
