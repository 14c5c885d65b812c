"""Line dedup, periodic runs and whitening against brute force."""

import hashlib
import random
import re
import zlib
from collections import defaultdict
from fractions import Fraction

import duckdb
import numpy as np
import pytest

import __spark_entry__ as entry
from cohortlake.llm import line_dedup, periodic_runs, queries, whitening
from tests.conftest import SOURCE

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, source string, n_lines int, kept_text string, runs int"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def frame(spark, rows):
    return spark.createDataFrame([(*r, "s", 1, "x", 2) for r in rows], SCHEMA).repartition(3)


# Lines

SHARED = "A line that many of the Documents share"


def line_rows():
    rng = random.Random(3)
    pool = [f"{SHARED} {k}" for k in range(12)] + ["short", "", "   ", "é" * 20, "é" * 19]
    pool += ["İstanbul line of capital letters", "i̇stanbul line of capital letters"]
    rows = []
    for doc in range(60):
        lines = [rng.choice(pool) for _ in range(rng.randint(0, 12))]
        lines = [rng.choice(["", " ", "\t\v\f\r"]) + x + rng.choice(["", " \t", "\xa0"]) for x in lines]
        lines = [x.upper() if x.isascii() and rng.random() < 0.3 else x for x in lines]
        rows.append((doc * 7 % 61, "\n".join(lines)))
    # One line in all rows of one document, copies, rows without an id and without text.
    rows += [(200, "said in one document only, often\n" * 4), (200, "said in one document only, often")]
    rows += [rows[5], rows[5], (None, rows[7][1]), (None, "no id\n" + rows[8][1])]
    rows += [(300, None), (301, ""), (302, "\n"), (303, "\n".join(f"{SHARED} 3 {i}" for i in range(3000)))]
    rows += [(304, rows[-1][1] + "\nan end"), (305, rows[-1][1])]
    return rows


def without_common(rows, least_docs=3, least_chars=20):
    def key(line):
        return re.sub("[A-Z]", lambda m: m[0].lower(), line.strip(" \t\n\x0b\x0c\r"))

    holders = defaultdict(set)
    for doc, text in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= least_chars:
                holders[key(line)].add(doc)
    last = {
        k: max(d for d in docs if d is not None)
        for k, docs in holders.items()
        if len(docs) >= least_docs
    }
    out = []
    for doc, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if last.get(key(x), doc) == doc]
        out.append((doc, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(map(repr, out))


def test_common_lines_leave_all_but_the_last_document(spark):
    rows = line_rows()
    found = line_dedup.drop_common_lines(frame(spark, rows))
    assert found.columns[:3] == ["doc_id", "text", "source"] and len(set(found.columns)) == 7
    got = found.select("doc_id", "n_lines", "n_dropped", "kept_text").collect()
    assert sorted(repr(tuple(r)) for r in got) == without_common(rows)
    assert sum(r.n_dropped for r in got) > 3000
    few = line_dedup.drop_common_lines(frame(spark, rows), least_docs=2, least_chars=5)
    got = few.select("doc_id", "n_lines", "n_dropped", "kept_text").collect()
    assert sorted(repr(tuple(r)) for r in got) == without_common(rows, 2, 5)


def test_lines_of_no_rows(spark):
    assert line_dedup.drop_common_lines(frame(spark, [])).collect() == []


# Runs


def brute_runs(words, least=24, times=3):
    known, found = {}, {}
    ids = np.array([known.setdefault(w, len(known)) for w in words])
    for period in range(1, len(words) // times + 1):
        steps = np.diff((ids[:-period] == ids[period:]).astype(np.int8), prepend=0, append=0)
        for start, end in zip(np.flatnonzero(steps == 1), np.flatnonzero(steps == -1), strict=True):
            if end + period - start >= max(least, times * period):
                found.setdefault((int(start), int(end) + period), period)
    return sorted(((s, e - s, q) for (s, e), q in found.items()), key=lambda r: (r[0], r[2]))


def periodic_texts(count, longest, seed):
    rng = random.Random(seed)
    for _ in range(count):
        letters = rng.choice([1, 2, 3, 60])
        text = [b"%d" % rng.randrange(letters) for _ in range(rng.choice([0, 1, 23, 24, 80, 300]))]
        for _ in range(rng.randint(0, 4)):
            root = [b"%d" % rng.randrange(letters) for _ in range(rng.randint(1, longest))]
            size = rng.randint(2 * len(root), 5 * len(root) + 3)
            at = rng.randint(0, len(text))
            text[at:at] = [root[i % len(root)] for i in range(size)]
        yield text


@pytest.mark.parametrize("count, longest", [(150, 40), (25, 700)])
def test_runs_against_all_lags(count, longest):
    texts = list(periodic_texts(count, longest, count))
    found = [periodic_runs.find_runs(texts[i : i + 7]) for i in range(0, count, 7)]
    expected = [brute_runs(t) for t in texts]
    assert [r for block in found for r in block] == expected
    assert sum(map(len, expected)) > 20


def test_runs_of_every_period_at_the_shortest_length():
    for period in range(1, 90):
        root = [b"%d" % i for i in range(period)]
        size = max(24, 3 * period)
        words = [b"x"] + [root[i % period] for i in range(size)] + [b"y"]
        assert periodic_runs.find_runs([words]) == [[(1, size, period)]]
        assert periodic_runs.find_runs([words[:-2] + [b"y"]]) == [[]]


def test_runs_misjudged_by_a_hash_are_extended_anew():
    words = periodic_runs.Words([[b"a", b"b"] * 20 + [b"c"]])
    wrong = np.array([[0, 41, 2]])
    assert periodic_runs._exact(words, wrong).tolist() == [[0, 40, 2]]


def test_runs_of_rows(spark):
    rng = random.Random(9)
    rows = [(i, " \n".join(f"W{rng.randrange(9)}" for _ in range(rng.randint(0, 400)))) for i in range(80)]
    rows += [(None, "la " * 50), (7, "la " * 50), (7, "la " * 50), (90, None), (91, ""), (92, " \t\n")]
    rows += [(93, "one\xa0two " * 24), (95, " ".join(f"w{i % 31_000}" for i in range(100_000)))]
    made = periodic_runs.collapse_runs(frame(spark, rows), change=periodic_runs.planted)
    got = sorted(repr(_flat(r)) for r in made.collect())
    assert got == sorted(map(repr, map(expected_runs, rows)))
    assert periodic_runs.collapse_runs(frame(spark, [])).collect() == []


def _flat(row):
    runs = [tuple(r) for r in row.runs]
    return row.doc_id, runs, row.strongest and tuple(row.strongest), sha(row.collapsed_text)


def expected_runs(row):
    doc_id, text = row
    words = WORD.findall(text or "")
    g, rest = divmod(zlib.crc32(str(doc_id).encode()), 10)
    if doc_id is not None and words and rest == 0:
        a = g % len(words)
        p = 1 + (len(words) - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(len(words))]
    if len(words) == 100_000:
        runs = [(0, 100_000, 31_000)]
    else:
        runs = brute_runs(words) if words else []
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)
    return doc_id, runs, best, sha(" ".join(w for i, w in enumerate(words) if i not in gone))


# Whitening


def test_scatter_is_exact():
    rng = np.random.default_rng(2)
    for rows, dims, span in ((1, 3, 5), (65, 1, 2), (1000, 7, 3000), (130, 4, 2**40)):
        x = rng.integers(-span, span, (rows, dims))
        sums, products = whitening.scatter(x)
        whole = x.astype(object)
        assert sums.tolist() == whole.sum(axis=0).tolist()
        assert products.tolist() == whole.T.dot(whole).tolist()


def test_sums_in_parts_of_a_word():
    values = [0, 1, -1, 2**32, -(2**32), 2**100 + 5, -(2**100) - 5, 2**31]
    found = [0] * len(values)
    for batch in whitening._limbs(values):
        for row in batch.to_pylist():
            found[row["place"]] += row["value"] << (32 * row["limb"])
    assert found == values


VECTORS = "vec_id long, embedding array<float>, n int, component string, whitened int"


def vector_rows():
    rng = np.random.default_rng(4)
    spread = rng.normal(size=(400, 10)) * np.linspace(0.9, 0.1, 10) @ rng.normal(size=(10, 10))
    rows = [(i, [float(c) for c in np.float32(v)]) for i, v in enumerate(spread)]
    rows += [(7, rows[7][1]), (None, rows[9][1]), *[(500 + i, rows[3][1]) for i in range(150)]]
    bad = [None, [], [0.1] * 9, [None] + [0.1] * 9, [float("nan")] + [0.0] * 9]
    bad += [[float("inf")] + [0.0] * 9]
    return rows, [(900 + i, v) for i, v in enumerate(bad)]


def vectors(spark, rows):
    return spark.createDataFrame([(*r, 1, "c", 2) for r in rows], VECTORS).repartition(5)


def test_whitening(spark):
    rows, bad = vector_rows()
    got = whitening.whiten(vectors(spark, rows + bad)).collect()
    assert len(got) == 8 * len(rows)
    x = np.array([[int(np.floor(1024 * np.float64(np.float32(c)))) + 100_000 for c in v] for _, v in rows])
    n, sums = len(x), x.sum(axis=0)
    centred = x - sums / n
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    values, axes = values[::-1][:8], axes[:, ::-1][:, :8]
    white = centred @ axes / np.sqrt(values)
    total = centred.var(axis=0).sum()
    deviation = ((n * x - sums) ** 2).sum(axis=1)
    place = defaultdict(list)
    for i, (vec_id, _) in enumerate(rows):
        place[vec_id].append(i)
    signs = {}
    for r in got:
        k = r.component - 1
        i = next(i for i in place[r.vec_id])
        assert (r.n, int(r.deviation)) == (n, deviation[i])
        assert abs(r.explained - values[k] / total) < 1e-9
        if abs(white[i, k]) > 1e-6:
            signs.setdefault(k, np.sign(white[i, k] * r.whitened))
            assert abs(r.whitened - signs[k] * white[i, k]) < 1e-8
    assert {r.identity_error for r in got} == {got[0].identity_error} and got[0].identity_error < 1e-9


def test_whitening_without_variance_or_rows(spark):
    rows, bad = vector_rows()
    assert whitening.whiten(vectors(spark, [])).collect() == []
    assert whitening.whiten(vectors(spark, bad[:2])).collect() == []
    assert whitening.whiten(vectors(spark, rows[-3:])).collect() == []
    flat = [(i, [float(i), 0.5, 2.0 * i]) for i in range(20)]
    assert {r.component for r in whitening.whiten(vectors(spark, flat)).collect()} == {1}
    huge = [(i, [3e38 * (-1) ** i, float(i)]) for i in range(10)]
    got = whitening.whiten(vectors(spark, huge)).collect()
    assert {r.component for r in got} == {1} and all(abs(abs(r.whitened) - 1) < 1e-9 for r in got)


# Registered queries


@pytest.mark.skipif(SOURCE is None, reason="no source tables")
def test_queries_are_registered():
    assert set(queries.QUERIES) | {"pipeline"} <= set(entry.queries())
    assert {f"op{n}" for n in range(1, 14)} == {name.split("_")[0] for name in queries.QUERIES}


@pytest.mark.skipif(SOURCE is None, reason="no source tables")
@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "pages"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SOURCE}/{table}.parquet'")
    found = entry.queries()[name](spark, SOURCE)
    cursor = con.execute(entry.oracle_sql()[name])
    names = [c[0] for c in cursor.description]
    assert sorted(names) == sorted(found.columns)
    theirs = sorted(map(repr, cursor.fetchall()))
    assert sorted(repr(tuple(r)) for r in found.select(*names).collect()) == theirs != []


@pytest.mark.skipif(SOURCE is None, reason="no source tables")
def test_run_query(spark):
    docs = spark.read.parquet(f"{SOURCE}/documents.parquet").select("doc_id", "text").collect()
    got = {r.doc_id: r for r in entry.queries()["op13_periodic_runs"](spark, SOURCE).collect()}
    assert len(got) == len(docs)
    for doc in docs:
        _, runs, best, text = expected_runs(doc)
        row = got[doc.doc_id]
        assert row.n_runs == len(runs) and row.collapsed_sha256 == text
        assert row.runs_sha256 == sha("".join(f"{s},{n},{q}\n" for s, n, q in runs))
        assert (row.start, row.length, row.period) == (best or (None, None, None))
        assert row.exponent_milli == (best and 1000 * best[1] // best[2])
