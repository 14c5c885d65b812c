"""A history of changing attributes that batches of snapshots are merged into."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlake.operators.history import instants, versions_of
from cohortlake.sources.layers import materialize
from cohortlake.sources.snapshots import Manifest, Snapshots, add_parts, replace_parts

_INSTANTS, _VERSIONS = "instants", "versions"


class MaintainedHistory:
    """Versions of a key's attributes, kept in buckets of keys, see ``build_history``.

    A batch may bring snapshots of any time in any order: a newer one closes the open
    version, an older one splits or moves the version it falls into. What a version
    becomes depends on every instant its key was seen at, also those that confirmed it,
    so instants are kept beside the versions, one row per key and time. A merge reads
    the instants of the batch's keys alone, in their buckets, and writes the versions of
    these buckets anew; other buckets are not opened. Both tables appear at once.
    """

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        key: str,
        attributes: list[str],
        observed_at: str,
        buckets: int = 16,
    ):
        self.snapshots = Snapshots(spark, root)
        self.key, self.attributes, self.observed_at = key, attributes, observed_at
        self.buckets = buckets

    def versions(self) -> DataFrame:
        """The history as merged so far."""
        return self.snapshots.read(self.snapshots.head(), _VERSIONS)

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("string")

    def _instants(self, snapshots: DataFrame) -> DataFrame:
        return instants(snapshots, self.key, self.attributes, self.observed_at)

    def merge(self, batch: DataFrame) -> Manifest:
        """Merges a batch of dated snapshots; a batch merged twice changes nothing."""
        old = self.snapshots.head()
        stored = self.snapshots.write(self._instants(batch), _INSTANTS, self._bucket())
        fresh = self.snapshots.read(Manifest(tables={_INSTANTS: stored}), _INSTANTS)
        keys = materialize(fresh.select(self.key).distinct(), "keys")
        touched = set(stored.parts)
        if not touched and old.version:
            return old
        new, seen, kept = old.next(), fresh, None
        if old.version:
            same = keys.select(F.col(self.key).alias("_key"))
            mine = F.col(self.key).eqNullSafe(F.col("_key"))
            earlier = self.snapshots.read(old, _INSTANTS, sorted(touched))
            seen = self._instants(earlier.join(same, mine, "left_semi").unionByName(fresh))
            kept = self.snapshots.read(old, _VERSIONS, sorted(touched)).join(same, mine, "left_anti")
        # Stored, so that windows over a hot key's months are planned from its own size.
        seen = materialize(seen, "seen")
        merged = versions_of(seen, self.key, self.attributes, self.observed_at)
        if kept is not None:
            merged = kept.unionByName(merged)
        written = self.snapshots.write(merged, _VERSIONS, self._bucket())
        replace_parts(new, _VERSIONS, written, touched)
        add_parts(new, _INSTANTS, stored)
        self.snapshots.publish(new)
        return new
