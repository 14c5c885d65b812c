"""Repetition coverage of texts, and the rules that reject repetitive ones."""

import re

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame

from cohortlake.llm.common import WORD

_WORD = re.compile(WORD)
_BASE = np.uint64(0xD6E8FEB86659FD93)
SYMBOLS = "#*$%&|<>"

# Largest shares of a text's word characters inside repeated runs of n words (first ones
# included, so a line said twice counts twice), and of
# its lines and line characters that repeat an earlier line.
GRAM_LIMITS = {5: 0.30, 6: 0.28, 7: 0.26, 8: 0.24, 9: 0.22, 10: 0.20}
LINE_LIMIT, LINE_CHARS_LIMIT = 0.30, 0.20


def _repeated(keys: np.ndarray, n: int, size: int) -> np.ndarray:
    """Words inside runs of n words whose key occurs twice or more, first ones included."""
    order = np.argsort(keys, kind="stable")
    same = keys[order][1:] == keys[order][:-1]
    twice = np.zeros(len(keys), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    steps = np.zeros(size + 1, np.int64)
    at = np.flatnonzero(twice)
    np.add.at(steps, at, 1)
    np.add.at(steps, at + n, -1)
    return np.cumsum(steps[:-1]) > 0


def coverage(text: str | None, lengths: tuple[int, ...] = tuple(GRAM_LIMITS)) -> dict:
    """Counts of one text: words, characters, repeated lines and repeated runs of words."""
    text = text or ""
    words = _WORD.findall(text)
    size = len(words)
    chars = np.fromiter(map(len, words), np.int64, size)
    out = {
        "n_words": size,
        "word_chars": int(chars.sum()),
        "n_symbols": sum(map(text.count, SYMBOLS)),
    }
    seen: set[str] = set()
    lines = line_chars = repeats = repeat_chars = 0
    for line in text.split("\n"):
        if not _WORD.search(line):
            continue
        lines, line_chars = lines + 1, line_chars + len(line)
        if line in seen:
            repeats, repeat_chars = repeats + 1, repeat_chars + len(line)
        seen.add(line)
    out |= {"n_lines": lines, "line_chars": line_chars}
    out |= {"n_dup_lines": repeats, "dup_line_chars": repeat_chars}
    known: dict[str, int] = {}
    ids = np.fromiter((known.setdefault(w, len(known)) for w in words), np.uint64, size)
    # Runs of three as exact pairs of numbers: the first two words, then with the third.
    out["n_repeat_words"] = 0
    if size >= 3:
        pairs = np.unique(ids[:-1] * np.uint64(len(known)) + ids[1:], return_inverse=True)[1]
        triples = pairs[:-1].astype(np.uint64) * np.uint64(len(known)) + ids[2:]
        out["n_repeat_words"] = int(_repeated(triples, 3, size).sum())
    rolling = ids + np.uint64(1)
    for n in range(2, max(lengths, default=0) + 1):
        if size < n:
            break
        rolling = rolling[:-1] * _BASE + (ids[n - 1 :] + np.uint64(1))
        if n in lengths:
            out[f"chars_{n}"] = int(chars[_repeated(rolling, n, size)].sum())
    return {f"chars_{n}": 0 for n in lengths} | out


def passes(c: dict) -> tuple[bool, bool]:
    """Whether the counts fail the base rule, and whether the text is kept."""
    failed = c["n_words"] < 50 or 100 * c["n_repeat_words"] > 50 * c["n_words"]
    kept = (
        not failed
        and c["n_dup_lines"] <= LINE_LIMIT * c["n_lines"]
        and c["dup_line_chars"] <= LINE_CHARS_LIMIT * c["line_chars"]
        and all(c[f"chars_{n}"] <= limit * c["word_chars"] for n, limit in GRAM_LIMITS.items())
    )
    return failed, kept


_COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
_MORE = ["dup_line_chars", *(f"chars_{n}" for n in GRAM_LIMITS)]


def repetition(docs: DataFrame) -> DataFrame:
    """Counts and verdict per document, one row per input row.

    Whole texts are read, each on its own, so no row meets another. Rolling
    hashes of runs of 5 to 10 words find repeated runs; the runs of three words are
    compared exactly. A missing or empty text has zero counts and fails the base
    rule; an empty table gives no rows; further columns are ignored.
    """

    def measure(frames):
        for frame in frames:
            rows = []
            for text in frame["text"]:
                c = coverage(text if isinstance(text, str) else None)
                failed, kept = passes(c)
                rows.append([*(c[k] for k in _COUNTS), failed, kept, *(c[k] for k in _MORE)])
            out = pd.DataFrame(rows, columns=[*_COUNTS, "base_failed", "kept", *_MORE])
            out.insert(0, "doc_id", frame["doc_id"].to_numpy())
            yield out

    schema = "doc_id long, " + ", ".join(f"{c} long" for c in _COUNTS)
    schema += ", base_failed boolean, kept boolean, " + ", ".join(f"{c} long" for c in _MORE)
    return docs.selectExpr("cast(doc_id as long) doc_id", "cast(text as string) text").mapInPandas(
        measure, schema
    )


def passing(docs: DataFrame) -> DataFrame:
    """The rows whose text ``repetition`` keeps, with all their columns as they are."""

    def keep(batches):
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index("text")).to_pylist()
            yield batch.filter(pa.array([passes(coverage(t))[1] for t in texts], pa.bool_()))

    return docs.mapInArrow(keep, docs.schema)
