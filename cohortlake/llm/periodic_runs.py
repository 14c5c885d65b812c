"""Periodic runs of words, found by minimizers of several scales, and their collapse."""

import zlib
from collections.abc import Callable, Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlake.llm.common import mix, tables

# Periods below this are compared lag by lag, longer ones go through minimizers.
SHORT = 8
# Largest period of a scale to its smallest. Windows shrink as it grows: at 2 none is left.
_RATIO = 1.5
# Words of a block of texts; a longer text is a block of its own.
_BLOCK = 1 << 18

Change = Callable[[list[bytes], int | None], list[bytes]]


class Words:
    """The words of some texts as numbers that are equal where the words are.

    Every text is followed by a number of its own, so no repeat crosses two texts.
    """

    def __init__(self, texts: list[list[bytes]]):
        known: dict[bytes, int] = {}
        counts = np.array([len(words) for words in texts], np.int64)
        self.begins = np.concatenate([[0], np.cumsum(counts + 1)])[:-1]
        self.ends = self.begins + counts
        self.ids = np.empty(int(counts.sum()) + len(texts), np.int64)
        for words, begin, end in zip(texts, self.begins, self.ends, strict=True):
            self.ids[begin:end] = [known.setdefault(word, len(known)) for word in words]
        self.ids[self.ends] = -1 - np.arange(len(texts))

    def longest(self) -> int:
        return int((self.ends - self.begins).max(initial=0))

    def of_length(self, least: int) -> "Words":
        """The texts of at least so many words, with their old places in ``origin``."""
        keep = np.flatnonzero(self.ends - self.begins >= least)
        lengths = self.ends[keep] - self.begins[keep] + 1
        some = object.__new__(Words)
        some.begins = np.concatenate([[0], np.cumsum(lengths)])[:-1]
        some.ends = some.begins + lengths - 1
        shift = np.repeat(self.begins[keep] - some.begins, lengths)
        some.ids = self.ids[np.arange(int(lengths.sum())) + shift]
        some.shifts = self.begins[keep] - some.begins
        return some

    def hash_stretches(self) -> None:
        t = tables(len(self.ids) + 1)
        self.sums = np.zeros(len(self.ids) + 1, np.uint64)
        np.cumsum(mix(self.ids.view(np.uint64)) * t.powers[: len(self.ids)], out=self.sums[1:])
        self.inverses = t.inverses

    def hashes(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """64-bit hashes of the words from starts to ends."""
        return (self.sums[ends] - self.sums[starts]) * self.inverses[starts]


def _stretches(equal: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the stretches of true values."""
    steps = np.diff(equal.astype(np.int8), prepend=0, append=0)
    return np.flatnonzero(steps == 1), np.flatnonzero(steps == -1)


def _by_lag(words: Words, period: int, least: int) -> np.ndarray:
    """(start, end, period) of all maximal stretches of one period, by comparing each word."""
    starts, ends = _stretches(words.ids[:-period] == words.ids[period:])
    long = ends - starts + period >= least
    found = np.stack([starts, ends + period, np.full(len(starts), period)], axis=1)
    return found[long]


def _minimizers(hashes: np.ndarray, window: int) -> np.ndarray:
    """Places that hold the least hash, the leftmost of equal ones, of some window."""
    if len(hashes) < window:
        return np.zeros(0, np.int64)
    bits = np.uint64(max(1, int(len(hashes) - 1).bit_length()))
    places = np.arange(len(hashes), dtype=np.uint64)
    least, width = (mix(hashes) >> bits << bits) | places, 1
    while 2 * width <= window:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    rest = window - width
    least = np.minimum(least[: len(least) - rest], least[rest:])
    chosen = (least & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    return chosen[np.concatenate([[True], chosen[1:] != chosen[:-1]])]


def _extended(words: Words, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How many words before, and from, each pair of places are equal, within their text."""
    of = np.searchsorted(words.begins, left, "right") - 1
    room = [left - words.begins[of], words.ends[of] - right]
    found = []
    for most, sign in zip(room, (-1, 1), strict=True):
        low, high = np.zeros(len(left), np.int64), most.copy()
        for _ in range(int(most.max(initial=0)).bit_length()):
            half = (low + high + 1) >> 1
            a, b = (left, right) if sign > 0 else (left - half, right - half)
            same = words.hashes(a, a + half) == words.hashes(b, b + half)
            low, high = np.where(same, half, low), np.where(same, high, half - 1)
        found.append(low)
    return found[0], found[1]


def _by_minimizers(words: Words, low: int, high: int, least: int, times: int) -> np.ndarray:
    """(start, end, period) of the maximal stretches with a period from low to high.

    Words are hashed in runs of ``high``. Two equal ones inside a stretch of period
    q <= high are a multiple of q apart, or its period would be shorter; and the
    windows at its start and q later lie in it and choose places q apart, so the
    next minimizer of equal hash is at the distance of the period.
    """
    window = (times - 1) * low - high + 1
    count = len(words.ids) - high + 1
    if count < window:
        return np.zeros((0, 3), np.int64)
    hashes = (words.sums[high:] - words.sums[:count]) * words.inverses[:count]
    at = _minimizers(hashes, window)
    order = np.argsort(hashes[at], kind="stable")
    at = at[order]
    left, right = at[:-1], at[1:]
    period = right - left
    seeds = (hashes[left] == hashes[right]) & (low <= period) & (period <= high)
    left, right, period = left[seeds], right[seeds], period[seeds]
    # Minimizers that follow each other at one distance seed the same stretch.
    order = np.lexsort((left, period))
    left, right, period = left[order], right[order], period[order]
    first = np.ones(len(left), bool)
    first[1:] = (period[1:] != period[:-1]) | (left[1:] > left[:-1] + high)
    left, right, period = left[first], right[first], period[first]
    before, after = _extended(words, left, right)
    begin, end = left - before, right + after
    long = end - begin >= np.maximum(least, times * period)
    return np.unique(np.stack([begin, end, period], axis=1)[long], axis=0)


def _exact(words: Words, found: np.ndarray) -> np.ndarray:
    """The stretches, those that a hash has misjudged extended anew by their words."""
    out = []
    for begin, end, period in found.tolist():
        ids = words.ids
        text = int(np.searchsorted(words.begins, begin, "right")) - 1
        first, last = int(words.begins[text]), int(words.ends[text])
        whole = np.array_equal(ids[begin : end - period], ids[begin + period : end])
        left = begin > first and ids[begin - 1] == ids[begin - 1 + period]
        right = end < last and ids[end] == ids[end - period]
        if whole and not left and not right:
            out.append((begin, end, period))
        else:
            starts, ends = _stretches(ids[first : last - period] == ids[first + period : last])
            out += [(first + s, first + e + period, period) for s, e in zip(starts.tolist(), ends.tolist())]
    return np.array(out, np.int64).reshape(-1, 3)


def find_runs(
    texts: list[list[bytes]], least: int = 24, times: int = 3
) -> list[list[tuple[int, int, int]]]:
    """All runs (start, length, period) of each text's words, by start, then period.

    A run is a stretch with smallest period q of at least ``least`` words and ``times`` q
    that no neighbouring word extends. Periods below ``SHORT`` are scanned lag by lag,
    longer ones are found by minimizers, a scale for all periods within a ratio of 1.5.
    """
    if times < 3:
        raise ValueError("windows need runs of three periods or more")
    words = Words(texts)
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    found = []
    some = words.of_length(least)
    for period in range(1, SHORT):
        if len(some.ids) > period:
            found.append(_moved(some, _by_lag(some, period, max(least, times * period))))
    low = SHORT
    while low * times <= words.longest():
        high = int(low * _RATIO)
        some = words.of_length(max(least, times * low))
        some.hash_stretches()
        found.append(_moved(some, _exact(some, _by_minimizers(some, low, high, least, times))))
        low = high + 1
    runs = np.concatenate(found) if found else np.zeros((0, 3), np.int64)
    runs = runs[runs[:, 1] - runs[:, 0] >= np.maximum(least, times * runs[:, 2])]
    # A stretch of period q has all multiples of q as periods too: the least counts.
    runs = runs[np.lexsort((runs[:, 2], runs[:, 1], runs[:, 0]))]
    new = np.ones(len(runs), bool)
    new[1:] = (runs[1:, :2] != runs[:-1, :2]).any(axis=1)
    runs = runs[new]
    runs = runs[np.lexsort((runs[:, 2], runs[:, 0]))]
    of = np.searchsorted(words.begins, runs[:, 0], "right") - 1
    runs = np.stack([runs[:, 0] - words.begins[of], runs[:, 1] - runs[:, 0], runs[:, 2]], axis=1)
    for text, run in zip(of.tolist(), runs.tolist(), strict=True):
        out[text].append(tuple(run))
    return out


def _moved(some: Words, found: np.ndarray) -> np.ndarray:
    """Stretches among some of the texts at their places among all."""
    if len(found):
        of = np.searchsorted(some.begins, found[:, 0], "right") - 1
        found[:, :2] += some.shifts[of][:, None]
    return found


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words without those that stand in some run after its first period."""
    if not runs:
        return words
    steps = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        steps[start + period] += 1
        steps[start + length] -= 1
    gone = (np.cumsum(steps[:-1]) > 0).tolist()
    return [word for word, out in zip(words, gone, strict=True) if not out]


def planted(words: list[bytes], doc_id: int | None) -> list[bytes]:
    """The words; those of a tenth of the documents repeat from a place that the id tells.

    A document without id stays as it is.
    """
    digest = zlib.crc32(str(doc_id).encode())
    if doc_id is None or not words or digest % 10:
        return words
    g, n = digest // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
_OUT = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("runs", pa.list_(_RUN)),
        ("strongest", _RUN),
        ("collapsed_text", pa.string()),
    ]
)
_RUN_SQL = "struct<start: long, length: long, period: long>"
_OUT_SQL = f"doc_id long, runs array<{_RUN_SQL}>, strongest {_RUN_SQL}, collapsed_text string"


def _strength(run: tuple[int, int, int]) -> tuple[Fraction, int, int]:
    start, length, period = run
    return Fraction(length, period), -start, -period


def _named(run: tuple[int, int, int]) -> dict[str, int]:
    return dict(zip(("start", "length", "period"), run, strict=True))


def _blocks(batches: Iterator[pa.RecordBatch], change: Change) -> Iterator[tuple[list, list]]:
    """The ids and words of the rows, some texts at a time."""
    ids, texts, size = [], [], 0
    for batch in batches:
        rows = zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text")), strict=True)
        for doc_id, text in rows:
            # bytes.split() parts words at the six white space bytes and no others.
            words = change((text or b"").split(), doc_id)
            ids.append(doc_id)
            texts.append(words)
            size += len(words)
            if size >= _BLOCK:
                yield ids, texts
                ids, texts, size = [], [], 0
    if ids:
        yield ids, texts


def collapse_runs(
    docs: DataFrame, least: int = 24, times: int = 3, change: Change = lambda words, _: words
) -> DataFrame:
    """``doc_id, runs, strongest, collapsed_text`` per row, see ``find_runs``.

    Words are what ASCII white space parts, compared exactly; ``change`` may put others
    in their place before runs are searched. ``strongest`` is the run of the greatest
    length to period, the leftmost, then that of the shortest period; null without
    runs. ``collapsed_text`` leaves out every word that stands in some run after its
    first period and joins the others by spaces.

    Whole texts are read, each on its own, so no row meets another. A missing, empty or
    blank text has no words: no runs and an empty text. Rows that repeat or lack a
    doc_id are rows like others; an empty table gives none; further columns are ignored.
    """

    def search(batches):
        for ids, texts in _blocks(batches, change):
            found = find_runs(texts, least, times)
            columns = [
                ids,
                [[_named(run) for run in runs] for runs in found],
                [_named(max(runs, key=_strength)) if runs else None for runs in found],
                [b" ".join(collapsed(w, r)).decode() for w, r in zip(texts, found, strict=True)],
            ]
            arrays = [pa.array(c, f.type) for c, f in zip(columns, _OUT, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, schema=_OUT)

    own = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("text").cast("string").cast("binary").alias("text"),
    )
    return own.mapInArrow(search, _OUT_SQL)
