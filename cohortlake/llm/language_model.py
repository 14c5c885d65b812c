"""Hierarchical Pitman-Yor language model, sampled by Gibbs and used for perplexity."""

import os

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlake.llm.common import Sent, as_long, input_bytes, mix, stored, word_hashes

# A word's context is the word before it, known by a code of this many values: each
# code has a restaurant of its own, and all share the root as parent.
CODES = 1 << 16
# Discount and strength of the contexts' restaurants and of the root.
CONTEXT, ROOT = (0.75, 1.0), (0.7, 10.0)
# Sweeps of the sampler, and how many of the last ones are averaged.
SWEEPS, KEPT = 4, 3
# Words with at least this share of all tokens are dealt out by context as well.
_FREQUENT, _WAYS = 0.002, 64
_BLOCK = 1_000_000
_PART_BYTES = 12 << 20
# Customers are seated one by one up to here, then in steps of a sixteenth.
_SINGLY = 64
_END, _START = np.uint64(0xE0D0F00D), np.uint64(0x57A27)
_HELD = np.uint16(1 << 15)


def _pack(values: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(values).tobytes())


def _unpack(data: bytes, kind) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data), kind)


def token_stream(texts: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all tokens with an end after each text, codes of the tokens before
    them, and the text each belongs to."""
    hashes, begins = word_hashes(texts)
    owner = np.repeat(np.arange(len(texts)), np.diff(begins))
    ends = begins[1:] + np.arange(len(texts))
    out = np.empty(len(hashes) + len(texts), np.uint64)
    is_end = np.zeros(len(out), bool)
    is_end[ends] = True
    out[is_end], out[~is_end] = _END, hashes
    owners = np.empty(len(out), np.int64)
    owners[is_end], owners[~is_end] = np.arange(len(texts)), owner
    before = np.empty(len(out), np.uint64)
    before[1:] = out[:-1]
    first = np.concatenate([[0], ends[:-1] + 1]) if len(texts) else ends
    before[first] = _START
    return out, (mix(before) & np.uint64(CODES - 1)).astype(np.uint16), owners


def _frequent_words(docs: DataFrame) -> np.ndarray:
    """Sorted hashes of words with a large share of all tokens: at most 1 / share of them."""

    def run(frames):
        for frame in frames:
            hashes, _, _ = token_stream(frame["text"].tolist())
            words, counts = np.unique(hashes, return_counts=True)
            use = counts >= _FREQUENT / 4 * len(hashes)
            yield pd.DataFrame(
                {"word": [0, *as_long(words[use])], "n": [len(hashes), *counts[use]], "all": [True] + [False] * int(use.sum())}
            )

    sums = docs.select("text").mapInPandas(run, "word long, n long, all boolean")
    sums = stored(sums.groupBy("word", "all").agg(F.sum("n").alias("n")), "frequent")
    total = sums.filter("all").agg(F.sum("n")).first()[0] or 0
    rows = sums.filter(~F.col("all") & (F.col("n") >= max(1, _FREQUENT * total))).select("word")
    return np.sort(rows.toPandas()["word"].to_numpy(np.int64).view(np.uint64))


_DEALT = "p long, block long, words binary, counts binary, codes binary, docs binary"


def _deal(docs: DataFrame, parts: int, frequent: np.ndarray, scoring: bool) -> DataFrame:
    """Tokens in blocks, dealt to parts by word; frequent words also by their context.

    For scoring a block also has the places of its documents, and a row of its own
    with their ids (its part is negative).
    """

    def block_rows(ids, held, texts):
        hashes, codes, owners = token_stream(texts)
        common = np.zeros(len(hashes), bool)
        if len(frequent):
            at = np.minimum(np.searchsorted(frequent, hashes), len(frequent) - 1)
            common = frequent[at] == hashes
        deal = mix(hashes + np.where(common, codes.astype(np.uint64) % np.uint64(_WAYS) + np.uint64(1), np.uint64(0)))
        order = np.argsort(deal, kind="stable")
        deal, hashes, codes, owners = deal[order], hashes[order], codes[order], owners[order]
        first = np.flatnonzero(np.concatenate([[True], deal[1:] != deal[:-1]]))
        part = ((deal[first] >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)
        ends = np.concatenate([first[1:], [len(deal)]])
        block = int.from_bytes(os.urandom(8), "little", signed=True)
        docs_ = owners.astype(np.uint16) | np.where(held[owners], _HELD, np.uint16(0))
        rows = []
        for p in np.unique(part):
            own = np.flatnonzero(part == p)
            a, b = first[own[0]], ends[own[-1]]
            rows.append((
                int(p), block, _pack(hashes[first[own]]), _pack((ends - first)[own].astype(np.uint32)),
                _pack(codes[a:b]), _pack(docs_[a:b]) if scoring else None,
            ))
        if scoring:
            sizes = np.bincount(owners, minlength=len(texts)).astype(np.uint32)
            names = "\n".join("" if i is None else i for i in ids).encode()
            rows.append((-1 - block % parts, block, _pack(sizes), names, _pack(held), None))
        return pd.DataFrame(rows, columns=["p", "block", "words", "counts", "codes", "docs"])

    def run(frames):
        ids, held, texts, size = [], [], [], 0
        for frame in frames:
            for i, h, text in zip(frame["doc_id"], frame["held_out"], frame["text"]):
                ids.append(i)
                held.append(h)
                texts.append(text)
                size += len(text or "") // 5 + 1
                if size >= _BLOCK or len(texts) >= int(_HELD) - 1:
                    yield block_rows(ids, np.array(held, bool), texts)
                    ids, held, texts, size = [], [], [], 0
        if texts:
            yield block_rows(ids, np.array(held, bool), texts)

    return docs.mapInPandas(run, _DEALT)


def seat(customers: np.ndarray, mass: np.ndarray, discount: float, rng) -> np.ndarray:
    """Tables after all customers of each dish sat down again.

    The next one opens a table with probability mass / (mass + seated - discount *
    tables), mass that of the dish at the parent. Long queues sit down in steps.
    """
    tables = np.minimum(customers, 1).astype(np.float64)
    seated = tables.copy()
    left = np.flatnonzero(customers > 1)
    while len(left):
        n, t, m = seated[left], tables[left], mass[left]
        step = np.where(n < _SINGLY, 1.0, np.floor(n / 16))
        step = np.minimum(step, customers[left] - n)
        chance = m / (m + np.maximum(n - discount * t, 1e-9))
        tables[left] = t + rng.binomial(step.astype(np.int64), np.clip(chance, 0.0, 1.0))
        seated[left] = n + step
        left = left[seated[left] < customers[left]]
    return tables


class Totals:
    """What all parts share: customers and tables per context code, the root's, and
    the frequent words. Its size does not depend on the corpus."""

    def __init__(self, sums: pd.DataFrame, frequent: np.ndarray, seed: int):
        of = lambda kind: sums[sums["kind"] == kind]
        self.customers, self.tables = np.zeros(CODES), np.zeros(CODES)
        for kind, target in (("customers", self.customers), ("tables", self.tables)):
            rows = of(kind)
            target[rows["id"].to_numpy(np.int64)] = rows["n"].to_numpy()
        self.frequent = frequent
        at = lambda kind: (
            of(kind).set_index("id")["n"].reindex(as_long(frequent), fill_value=0).to_numpy(np.float64)
        )
        self.word_counts, self.word_customers = at("word"), at("dishes")
        single = lambda kind: float(of(kind)["n"].sum())
        self.tokens = single("tokens")
        self.types = single("types") + float((self.word_counts > 0).sum())
        discount, strength = ROOT
        rng = np.random.default_rng([seed, 7])
        # The frequent words' tables at the root need the root's tables; they are few.
        others = single("root tables")
        mass = (strength + discount * (others + len(frequent))) / (self.types + 1)
        self.word_tables = seat(self.word_customers, np.full(len(frequent), mass), discount, rng)
        self.root_tables = others + self.word_tables.sum()
        self.root_customers = self.tables.sum()

    def find(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(self.frequent):
            return np.zeros(len(words), bool), np.zeros(len(words), np.int64)
        at = np.minimum(np.searchsorted(self.frequent, words), len(self.frequent) - 1)
        return self.frequent[at] == words, at

    def root(self, words, customers: np.ndarray, tables: np.ndarray) -> np.ndarray:
        """Probability of words at the root."""
        common, at = self.find(words)
        customers, tables = customers.astype(np.float64), tables.astype(np.float64)
        if common.any():
            customers[common] = self.word_customers[at[common]]
            tables[common] = self.word_tables[at[common]]
        discount, strength = ROOT
        fresh = (strength + discount * self.root_tables) / (self.types + 1)
        return (customers - discount * tables + fresh) / (strength + self.root_customers)


def _types(rows: pd.DataFrame, held: bool) -> tuple[np.ndarray, ...]:
    """Words of a part (sorted), and per token its word's index, code and document field."""
    words = [_unpack(x, np.uint64) for x in rows["words"]]
    counts = [_unpack(x, np.uint32) for x in rows["counts"]]
    unique, inverse = np.unique(np.concatenate(words), return_inverse=True)
    index = np.repeat(inverse, np.concatenate(counts))
    codes = np.concatenate([_unpack(x, np.uint16) for x in rows["codes"]])
    docs = [_unpack(x, np.uint16) for x in rows["docs"]] if held else []
    return unique, index.astype(np.int64), codes, docs


_STATE = "p long, words binary, counts binary, ones binary, index binary, codes binary, customers binary, tables binary, roots binary, singles binary"


def _seated(rows: pd.DataFrame) -> pd.DataFrame:
    """First state of a part: one table per context and word."""
    words, index, codes, _ = _types(rows, held=False)
    pairs, n = np.unique(index << 16 | codes, return_counts=True)
    index, codes = pairs >> 16, pairs & (CODES - 1)
    one = n == 1
    ones = np.bincount(index[one], minlength=len(words))
    state = {
        "p": int(rows["p"].iloc[0]),
        "words": _pack(words),
        "counts": _pack(np.bincount(index, weights=n, minlength=len(words)).astype(np.uint64)),
        "ones": _pack(ones.astype(np.uint32)),
        "index": _pack(index[~one].astype(np.uint32)),
        "codes": _pack(codes[~one].astype(np.uint16)),
        "customers": _pack(n[~one].astype(np.uint32)),
        "tables": _pack(np.ones(int((~one).sum()), np.uint32)),
        "roots": _pack(np.ones(len(words), np.uint32)),
        "singles": _pack(np.bincount(codes[one], minlength=CODES).astype(np.uint32)),
    }
    return pd.DataFrame([state])


def _parts_of(row) -> dict[str, np.ndarray]:
    kinds = {"words": np.uint64, "counts": np.uint64, "codes": np.uint16}
    names = [c.split()[0] for c in _STATE.split(", ")][1:]
    return {n: _unpack(getattr(row, n), kinds.get(n, np.uint32)) for n in names if hasattr(row, n)}


def _totals(states: DataFrame, words: DataFrame, frequent: np.ndarray, seed: int) -> Totals:
    def sums(frames):
        for frame in frames:
            for row in frame.itertuples(index=False):
                s = _parts_of(row)
                rare = ~np.isin(s["words"], frequent)
                tables = np.bincount(s["codes"], weights=s["tables"], minlength=CODES) + s["singles"]
                customers = np.bincount(s["codes"], weights=s["customers"], minlength=CODES) + s["singles"]
                dishes = np.bincount(s["index"], weights=s["tables"], minlength=len(s["words"])) + s["ones"]
                out = [
                    ("customers", np.arange(CODES), customers), ("tables", np.arange(CODES), tables),
                    ("word", as_long(s["words"][~rare]), s["counts"][~rare]),
                    ("dishes", as_long(s["words"][~rare]), dishes[~rare]),
                    ("tokens", [0], [s["counts"].sum()]), ("types", [0], [rare.sum()]),
                    ("root tables", [0], [s["roots"][rare].sum()]),
                ]
                for kind, ids, n in out:
                    frame_ = pd.DataFrame({"kind": kind, "id": ids, "n": np.asarray(n, np.float64)})
                    yield frame_[frame_["n"] > 0]

    joined = states.join(words, "p")
    rows = joined.mapInPandas(sums, "kind string, id long, n double").groupBy("kind", "id")
    return Totals(rows.agg(F.sum("n").alias("n")).toPandas(), frequent, seed)


def _sweep(states: DataFrame, words: DataFrame, totals, seed: int) -> DataFrame:
    """All customers of all words in all contexts seated again, then the root's."""

    def run(frames):
        t = totals.value
        for frame in frames:
            for row in frame.itertuples(index=False):
                s = _parts_of(row)
                rng = np.random.default_rng([seed, row.p])
                served = np.bincount(s["index"], weights=s["tables"], minlength=len(s["words"])) + s["ones"]
                parent = t.root(s["words"], served, s["roots"])
                discount, strength = CONTEXT
                mass = (strength + discount * t.tables[s["codes"]]) * parent[s["index"]]
                tables = seat(s["customers"].astype(np.float64), mass, discount, rng)
                served = np.bincount(s["index"], weights=tables, minlength=len(s["words"])) + s["ones"]
                discount, strength = ROOT
                mass = np.full(len(served), (strength + discount * t.root_tables) / (t.types + 1))
                roots = seat(served, mass, discount, rng)
                new = {"tables": _pack(tables.astype(np.uint32)), "roots": _pack(roots.astype(np.uint32))}
                yield pd.DataFrame([{c: getattr(row, c) for c in columns} | new])

    columns = states.columns
    return states.join(words, "p").mapInPandas(run, states.schema)


def _scored(dealt: DataFrame, kept: list[DataFrame], words: DataFrame, totals: list) -> DataFrame:
    """Sums per part, block and document: base and model score, and known words."""
    states = None
    for k, state in enumerate(kept):
        one = state.withColumn("sample", F.lit(k))
        states = one if states is None else states.unionByName(one)
    states = states.join(words, "p")

    def score(_, rows: pd.DataFrame, samples: pd.DataFrame) -> pd.DataFrame:
        columns = ["block", "ids", "held", "sizes", "known", "base", "score"]
        out = []
        if len(rows) and rows["p"].iloc[0] < 0:
            for row in rows.itertuples(index=False):
                out.append((row.block, row.counts, row.codes, row.words, None, None, None))
            return pd.DataFrame(out, columns=columns)
        if not len(rows):
            return pd.DataFrame(out, columns=columns)
        unique, index, codes, docs = _types(rows, held=True)
        trained = np.concatenate(docs) & _HELD == 0
        pairs, place = np.unique(index << 16 | codes, return_inverse=True)
        n = np.bincount(place[trained], minlength=len(pairs)).astype(np.float64)
        pair_index, pair_codes = pairs >> 16, pairs & (CODES - 1)
        last = totals[-1].value
        counts = np.bincount(index[trained], minlength=len(unique)).astype(np.float64)
        common, at = last.find(unique)
        counts[common] = last.word_counts[at[common]]
        chance = np.zeros(len(pairs))
        discount, strength = CONTEXT
        for k, t in enumerate(totals):
            t = t.value
            tables = np.minimum(n, 1.0)
            served, roots = np.zeros(len(unique)), np.zeros(len(unique))
            for row in samples[samples["sample"] == k].itertuples(index=False):
                s = _parts_of(row)
                mine = np.searchsorted(unique, s["words"])
                tables[np.searchsorted(pairs, mine[s["index"]] << 16 | s["codes"])] = s["tables"]
                served[mine] = s["ones"] + np.bincount(s["index"], weights=s["tables"], minlength=len(mine))
                roots[mine] = s["roots"] * (served[mine] > 0)
            parent = t.root(unique, served, roots)
            fresh = (strength + discount * t.tables[pair_codes]) * parent[pair_index]
            seen = strength + t.customers[pair_codes]
            chance += (n - discount * tables + fresh) / seen / len(totals)
        model = np.log10(chance)[place]
        base = np.log10((counts + 0.1) / (last.tokens + 0.1 * (last.types + 1)))[index]
        known = (counts > 0)[index]
        begin = 0
        for block, own in zip(rows["block"], docs):
            end = begin + len(own)
            doc = (own & (_HELD - np.uint16(1))).astype(np.int64)
            sums = [
                np.bincount(doc, weights=x[begin:end]) for x in (known, base, model)
            ]
            out.append((block, None, None, None, *(_pack(x) for x in sums)))
            begin = end
        return pd.DataFrame(out, columns=columns)

    return dealt.groupBy("p").cogroup(states.groupBy("p")).applyInPandas(
        score,
        "block long, ids binary, held binary, sizes binary, known binary, base binary, score binary",
    )


def score_texts(docs: DataFrame) -> DataFrame:
    """Base and model log10 probability of each document, one row per input row.

    The model learns from documents whose crc32(doc_id as text) mod 10 is not 0 (a
    missing doc_id counts as empty text, and is held out). Tokens are words with A-Z
    lowered and one end. Contexts are the word before, in 65,536 restaurants; words
    that share a code share a restaurant. Seating runs part by part, each part the
    words of one hash range, with the other parts' totals of the sweep before.
    A missing text is its end alone; an unknown word has the root's chance of a new
    dish; an empty table gives no rows; equal runs agree on equal tables but for
    the order of sums.
    """
    spark = docs.sparkSession
    text_id = F.coalesce(F.col("doc_id").cast("long").cast("string"), F.lit(""))
    source = docs.select(
        F.col("doc_id").cast("long").cast("string").alias("doc_id"),
        F.col("text").cast("string"),
        (F.crc32(text_id.cast("binary")) % 10 == 0).alias("held_out"),
    )
    parts = int(max(4, -(-input_bytes(docs) // _PART_BYTES)))
    frequent = _frequent_words(source)
    training = _deal(source.filter(~F.col("held_out")), parts, frequent, scoring=False)
    first = stored(training.groupBy("p").applyInPandas(_seated, _STATE), "seated")
    words = first.select("p", "words", "counts", "singles", "ones")
    states = first.select("p", "index", "codes", "customers", "tables", "roots")
    kept, shared = [], []
    totals = Sent(spark, _totals(states, words, frequent, 0))
    for sweep in range(1, SWEEPS + 1):
        states = stored(_sweep(states, words, totals, sweep), "sweep")
        totals = Sent(spark, _totals(states, words, frequent, sweep))
        if sweep > SWEEPS - KEPT:
            kept.append(states)
            shared.append(totals)
    # Blocks have random names, so they are written once: a task run again must not deal anew.
    dealt = stored(_deal(source, parts, frequent, scoring=True), "dealt")
    partial = _scored(dealt, kept, words, shared)
    train_tokens = int(totals.value.tokens)

    def combine(rows: pd.DataFrame) -> pd.DataFrame:
        head = rows[rows["ids"].notna()].iloc[0]
        sizes = _unpack(head["sizes"], np.uint32)
        sums = np.zeros((3, len(sizes)))
        for row in rows[rows["ids"].isna()].itertuples(index=False):
            for k, x in enumerate((row.known, row.base, row.score)):
                values = _unpack(x, np.float64)
                sums[k, : len(values)] += values
        ids = head["ids"].decode().split("\n")
        return pd.DataFrame({
            "doc_id": pd.array([int(i) if i else None for i in ids], "Int64"),
            "held_out": _unpack(head["held"], bool), "n_tokens": sizes.astype(np.int64),
            "n_known": sums[0].astype(np.int64), "train_tokens": train_tokens,
            "base_score": sums[1], "score": sums[2],
        })

    return partial.groupBy("block").applyInPandas(
        combine,
        "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long,"
        " base_score double, score double",
    )
