"""Helpers of the operators: stored steps, word hashes, and a filter of fixed size."""

import contextlib
from collections.abc import Iterator
from contextvars import ContextVar

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlake.session import configure, run_folder, stored_state

WORD = r"[^\x20\x09-\x0D]+"

_MASK = (1 << 64) - 1
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
# Bytes hashed at once, few enough for a processor's cache; a longer text is cut
# between words.
PIECE = 256 << 10


def prepare(spark: SparkSession) -> SparkSession:
    """Session settings of the operators: small Arrow batches, whatever the texts' length."""
    configure(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "500")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(16 << 20))
    return spark


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{table}.parquet")


_steps: ContextVar[list[str] | None] = ContextVar("steps", default=None)


def stored(df: DataFrame, name: str) -> DataFrame:
    """The frame, written below the shared folder and read again: cuts its lineage."""
    spark = df.sparkSession
    path = run_folder(spark, name)
    if (steps := _steps.get()) is not None:
        steps.append(path)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextlib.contextmanager
def noting_steps() -> Iterator[list[str]]:
    """The folders of all frames that this thread stores meanwhile."""
    steps: list[str] = []
    token = _steps.set(steps)
    try:
        yield steps
    finally:
        _steps.reset(token)


def input_bytes(df: DataFrame) -> int:
    """Stored bytes of the files below a frame, 0 if it has none."""
    return sum(stored_state(df.sparkSession, path)[0] for path in df.inputFiles())


def whole_text(column: str = "text") -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit values."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


class _Tables:
    """Byte tables and powers of the base, made once in each process."""

    def __init__(self):
        self.lower = np.arange(256, dtype=np.uint8)
        self.lower[65:91] += 32
        self.gap = np.zeros(256, bool)
        self.gap[[32, *range(9, 14)]] = True
        self.value = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))
        self.powers = self.inverses = np.ones(0, np.uint64)

    def grown(self, n: int) -> "_Tables":
        if len(self.powers) < n:
            one = np.ones(1, np.uint64)
            self.powers, self.inverses = (
                np.cumprod(np.concatenate([one, np.full(n, b, np.uint64)]))
                for b in (_BASE, _INVERSE)
            )
        return self


_tables: list[_Tables] = []


def tables(n: int = 0) -> _Tables:
    if not _tables:
        _tables.append(_Tables())
    return _tables[0].grown(n)


def prefix_hashes(data: np.ndarray) -> np.ndarray:
    """Sums from which the hash of any stretch of the bytes follows, see ``stretch``."""
    t = tables(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(t.value[data] * t.powers[: len(data)], out=sums[1:])
    return sums


def stretch(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the bytes from starts to ends."""
    return mix((sums[ends] - sums[starts]) * tables().inverses[starts])


def _pieces(data: bytes) -> Iterator[bytes]:
    gap, at = tables().gap, 0
    while len(data) - at > PIECE:
        block = np.frombuffer(data, np.uint8, count=PIECE, offset=at)
        gaps = np.flatnonzero(gap[block])
        end = at + int(gaps[-1]) + 1 if len(gaps) else at + PIECE
        while not len(gaps) and end < len(data) and not gap[data[end]]:
            end += 1
        yield data[at:end]
        at = end
    yield data[at:]


def word_hashes(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words with A-Z lowered, and where each text's words begin.

    A missing text has no words. Text i owns ``hashes[begins[i]:begins[i + 1]]``.
    """
    found, counts = [], np.zeros(len(texts) + 1, np.int64)
    group, owners, size = [], [], 0

    def flush():
        if not group:
            return
        data = np.frombuffer(b"\n" + b"\n".join(group) + b"\n", np.uint8)
        t = tables()
        gap = t.gap[data]
        starts = np.flatnonzero(gap[:-1] & ~gap[1:]) + 1
        ends = np.flatnonzero(~gap[:-1] & gap[1:]) + 1
        sums = prefix_hashes(t.lower[data])
        found.append(stretch(sums, starts, ends) ^ mix((ends - starts).astype(np.uint64)))
        bounds = np.cumsum([1] + [len(g) + 1 for g in group])
        places = np.searchsorted(starts, bounds)
        np.add.at(counts, np.asarray(owners) + 1, np.diff(places))

    for i, text in enumerate(texts):
        for piece in _pieces(text.encode()) if isinstance(text, str) else ():
            if size + len(piece) > PIECE:
                flush()
                group, owners, size = [], [], 0
            group.append(piece)
            owners.append(i)
            size += len(piece)
    flush()
    hashes = np.concatenate(found) if found else np.zeros(0, np.uint64)
    return hashes, np.cumsum(counts)


def grams(hashes: np.ndarray, begins: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of n words inside one text, and their first word's index."""
    if len(hashes) < n:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    total = hashes[: len(hashes) - n + 1].copy()
    for k in range(1, n):
        total = total * np.uint64(_BASE) + hashes[k : len(hashes) - n + 1 + k]
    inside = np.ones(len(total), bool)
    for k in range(1, n):
        cut = begins[1:-1] - k
        inside[cut[(cut >= 0) & (cut < len(total))]] = False
    at = np.flatnonzero(inside)
    return mix(total[at]), at


class Sent:
    """An object whose fields are broadcast; its class travels with the function that uses it."""

    def __init__(self, spark: SparkSession, thing):
        self._kind, self._fields = type(thing), spark.sparkContext.broadcast(vars(thing))

    @property
    def value(self):
        thing = object.__new__(self._kind)
        thing.__dict__.update(self._fields.value)
        return thing


class HashFilter:
    """Bits of at most ``2 ** most`` positions that hold a set of 64-bit hashes.

    Its size is bounded whatever the set's: more hashes only let more others
    pass, and what passes is joined exactly afterwards.
    """

    def __init__(self, words: np.ndarray | None, bits: int):
        self.words, self.bits = words, bits

    def _place(self, hashes: np.ndarray, seed: int) -> np.ndarray:
        return mix(hashes + np.uint64(seed * _BASE & _MASK)) >> np.uint64(64 - self.bits)

    def holds(self, hashes: np.ndarray) -> np.ndarray:
        left = np.arange(len(hashes))
        for seed in (1, 2, 3):
            place = self._place(hashes[left], seed)
            word = self.words[(place >> np.uint64(6)).astype(np.int64)]
            left = left[(word >> (place & np.uint64(63))) & np.uint64(1) == 1]
        ok = np.zeros(len(hashes), bool)
        ok[left] = True
        return ok

    @classmethod
    def of(cls, df: DataFrame, column: str, count: int, most: int = 27) -> "HashFilter":
        """The filter of a column of longs with about ``count`` values.

        Positions are combined by Spark; the driver gets at most ``2 ** most / 64`` words,
        as Arrow columns of 16 bytes a word rather than as a row object each.
        """
        bits = int(min(most, max(12, np.ceil(np.log2(max(1, count) * 48)))))
        empty = cls(None, bits)

        def places(frames):
            for frame in frames:
                hashes = frame[column].to_numpy(np.int64).view(np.uint64)
                place = np.concatenate([empty._place(hashes, seed) for seed in (1, 2, 3)])
                yield pd.DataFrame(
                    {
                        "word": (place >> np.uint64(6)).astype(np.int64),
                        "mask": (np.uint64(1) << (place & np.uint64(63))).view(np.int64),
                    }
                )

        found = (
            df.select(column)
            .mapInPandas(places, "word long, mask long")
            .groupBy("word")
            .agg(F.bit_or("mask").alias("mask"))
            .toArrow()
        )
        words = np.zeros(1 << bits >> 6, np.uint64)
        words[found["word"].to_numpy()] = found["mask"].to_numpy().view(np.uint64)
        return cls(words, bits)


def as_long(hashes: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(hashes).view(np.int64)
