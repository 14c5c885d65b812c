"""Benchmark passages in documents, found with spaced seeds."""

import os

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlake.llm.common import HashFilter, Sent, as_long, mix, stored, word_hashes

# Seeds: the fewest and most words of the items they are for, and the word positions
# looked at; the others may differ. Whatever words are changed within the share below,
# one of an item's seeds finds it: a stretch of 26 words or more holds a shorter one of
# 13 at least with the same share, and the tests go through all changes of 1 to 25 words.
SEEDS = (
    (1, 1, (0,)),
    (2, 2, (0, 1)),
    (3, 3, (0, 1, 2)),
    (4, 4, (0, 1, 2, 3)),
    (5, 5, (0, 1, 2)),
    (5, 5, (0, 1, 3)),
    (6, 9, (0, 1, 2, 3)),
    (6, 9, (0, 1, 4, 5)),
    (10, 12, (0, 1, 3, 4, 5)),
    (10, 12, (0, 1, 2, 6, 7)),
    (10, 12, (0, 2, 4, 5, 7)),
    (13, None, (0, 1, 2, 5, 7, 8)),
    (13, None, (0, 1, 2, 3, 5, 6)),
    (13, None, (0, 1, 3, 7, 8, 9)),
    (13, None, (0, 4, 5, 7, 8, 9)),
)
# Items of fewer words count only where they are all words of a document.
FEWEST = 3
# An overlap counts from this many words, or the whole of a shorter item, with this
# share of equal words.
LEAST_WORDS, SHARE = 13, 0.8


def seed_hashes(hashes: np.ndarray, begins: np.ndarray, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all places of a seed inside one text, and their first word's index."""
    offsets = SEEDS[seed][2]
    n = len(hashes) - offsets[-1]
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    total = np.full(n, seed + 1, np.uint64)
    for k in offsets:
        total = total * np.uint64(0x9E3779B97F4A7C15) + hashes[k : k + n]
    owner = np.repeat(np.arange(len(begins) - 1), np.diff(begins))
    at = np.flatnonzero(owner[:n] == owner[offsets[-1] :])
    return mix(total[at]), at


def longest_overlap(equal: np.ndarray, share: float) -> int:
    """Length of the longest stretch with at least this share of equal words."""
    gain = np.round((equal - share) * 1000).astype(np.int64)
    sums = np.concatenate([[0], np.cumsum(gain)])
    lowest = np.minimum.accumulate(sums)
    first = np.searchsorted(-lowest, -sums, side="left")
    return int((np.arange(len(sums)) - first).max(initial=0))


def _benchmark_seeds(benchmark: DataFrame) -> DataFrame:
    """Per place of an item's seeds: hash, item_id, place and the seed's number."""

    def run(frames):
        for frame in frames:
            hashes, begins = word_hashes(frame["text"].tolist())
            sizes = np.diff(begins)
            ids = frame["item_id"].to_numpy()
            for seed, (least, most, _) in enumerate(SEEDS):
                found, at = seed_hashes(hashes, begins, seed)
                owner = np.searchsorted(begins, at, side="right") - 1
                use = (sizes[owner] >= least) & (sizes[owner] <= (most or sizes[owner]))
                owner, at = owner[use], at[use]
                yield pd.DataFrame(
                    {"hash": as_long(found[use]), "item_id": ids[owner], "place": at - begins[owner], "seed": seed}
                )

    return benchmark.mapInPandas(run, "hash long, item_id long, place long, seed int")


def _item_words(benchmark: DataFrame) -> DataFrame:
    def run(frames):
        for frame in frames:
            hashes, begins = word_hashes(frame["text"].tolist())
            words = [hashes[a:b].tobytes() for a, b in zip(begins, begins[1:])]
            yield pd.DataFrame({"item_id": frame["item_id"], "item_words": words})

    return benchmark.mapInPandas(run, "item_id long, item_words binary")


def overlaps(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Documents with the benchmark items they overlap with.

    One row per input row: doc_id, contaminated, n_items, item_ids (sorted),
    overlap_words (the longest overlap, 0 if none). Words are compared with A-Z
    lowered. A document and an item overlap where, laid against each other word by
    word, a stretch of at least 13 words (or of the whole item, if shorter) has 80 %
    equal words; candidates are places where a seed's words agree. All windows of
    whole texts are hashed; a filter of fixed size, made of all benchmark hashes,
    leaves those worth joining. Items of one or two words count only where they are
    all words of a document; items without text or without id are not searched; rows of benchmark with the same id are all searched. A
    missing text has no overlap, a missing doc_id stays missing; an empty table on
    either side gives no overlaps.
    """
    spark = docs.sparkSession
    items = benchmark.selectExpr("cast(item_id as long) item_id", "cast(text as string) text").filter(
        "item_id IS NOT NULL AND text IS NOT NULL"
    )
    seeds = stored(_benchmark_seeds(items).distinct(), "seeds")
    keep = Sent(spark, HashFilter.of(seeds, "hash", seeds.count()))
    used = sorted(r.seed for r in seeds.select("seed").distinct().collect())
    columns = ["doc_id", "row", "hashes", "places", "words"]

    def search(frames):
        for frame in frames:
            hashes, begins = word_hashes(frame["text"].tolist())
            found = [([], []) for _ in range(len(frame))]
            sizes = np.diff(begins)
            for seed in used:
                values, at = seed_hashes(hashes, begins, seed)
                ok = keep.value.holds(values)
                values, at = as_long(values[ok]), at[ok]
                owner = np.searchsorted(begins, at, side="right") - 1
                if SEEDS[seed][0] < FEWEST:
                    whole = sizes[owner] == SEEDS[seed][0]
                    values, at, owner = values[whole], at[whole], owner[whole]
                for value, place, i in zip(values.tolist(), (at - begins[owner]).tolist(), owner):
                    found[i][0].append(value)
                    found[i][1].append(place)
            rows = []
            for i, (doc_id, (values, places)) in enumerate(zip(frame["doc_id"], found)):
                words = hashes[begins[i] : begins[i + 1]].tobytes() if values else None
                row = int.from_bytes(os.urandom(8), "little", signed=True)
                rows.append((doc_id, row, values, places, words))
            yield pd.DataFrame(rows, columns=columns, dtype=object).astype({"row": "int64"})

    source = docs.selectExpr("cast(cast(doc_id as long) as string) doc_id", "cast(text as string) text")
    searched = stored(
        source.mapInPandas(
            search, "doc_id string, row long, hashes array<long>, places array<long>, words binary"
        ),
        "searched",
    )
    hits = (
        searched.filter("words IS NOT NULL")
        .select("row", F.explode(F.arrays_zip("hashes", "places")).alias("hit"))
        .select("row", F.col("hit.hashes").alias("hash"), F.col("hit.places").alias("at"))
    )
    aligned = (
        hits.join(seeds, "hash")
        .select("row", "item_id", (F.col("at") - F.col("place")).alias("shift"))
        .distinct()
    )

    def verify(frames):
        for frame in frames:
            lengths = []
            for shift, words, item in zip(frame["shift"], frame["words"], frame["item_words"]):
                a, b = np.frombuffer(words, np.uint64), np.frombuffer(item, np.uint64)
                low, high = max(0, -shift), min(len(b), len(a) - shift)
                best = longest_overlap(a[low + shift : high + shift] == b[low:high], SHARE)
                lengths.append(best if best >= min(LEAST_WORDS, len(b)) else 0)
            yield frame[["row", "item_id"]].assign(length=lengths)

    words = searched.filter("words IS NOT NULL").select("row", "words")
    verified = (
        aligned.join(words, "row")
        .join(_item_words(items), "item_id")
        .select("row", "item_id", "shift", "words", "item_words")
        .mapInPandas(verify, "row long, item_id long, length long")
        .filter("length > 0")
        .groupBy("row")
        .agg(F.sort_array(F.collect_set("item_id")).alias("item_ids"), F.max("length").alias("longest"))
    )
    return searched.select("doc_id", "row").join(verified, "row", "left").select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("item_ids").isNotNull().alias("contaminated"),
        F.coalesce(F.size("item_ids"), F.lit(0)).cast("long").alias("n_items"),
        F.coalesce("item_ids", F.array().cast("array<long>")).alias("item_ids"),
        F.coalesce("longest", F.lit(0)).cast("long").alias("overlap_words"),
    )
