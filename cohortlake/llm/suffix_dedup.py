"""Removal of repeated byte strings, found by two-stage suffix sorting."""

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlake.llm.common import (
    PIECE,
    HashFilter,
    Sent,
    as_long,
    mix,
    prefix_hashes,
    stored,
    stretch,
    tables,
    whole_text,
)

# Bytes that mark a place; the smallest mark of a string is its anchor.
_MARK = 32
# Bytes sorted at once, and bytes of one anchor's segments beyond which its strings are
# dealt out one by one.
_BATCH, _LARGE = 1_000_000, 16 << 20
_REMEMBERED = 500_000


def _window_minima(values: np.ndarray, width: int) -> np.ndarray:
    """Smallest value of each window, from running minima of blocks in both directions."""
    n = len(values) - width + 1
    top = np.iinfo(np.uint64).max
    padded = np.full(-(-len(values) // width) * width, top, np.uint64)
    padded[: len(values)] = values
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1 : width - 1 + n])


def segments(texts: list[bytes], length: int) -> tuple[np.ndarray, ...]:
    """Runs of starts of ``length``-byte strings with the same anchor.

    Arrays: text, anchor hash, first start, number of starts, and whether a run may
    hold equal strings itself. Equal strings have equal anchors, wherever they stand.
    """
    found, group, size = [], [], 0
    for i, text in enumerate(texts):
        for at in range(0, max(0, len(text) - length + 1), PIECE):
            part = text[at : at + PIECE + length - 1]
            if size + len(part) > PIECE and group:
                found.append(_segments(group, length))
                group, size = [], 0
            group.append((i, at, part))
            size += len(part)
    if group:
        found.append(_segments(group, length))
    if not found:
        empty = np.zeros(0, np.int64)
        return empty, empty.astype(np.uint64), empty, empty, empty.astype(bool)
    return tuple(np.concatenate(x) for x in zip(*found))


def _segments(group: list[tuple[int, int, bytes]], length: int) -> tuple[np.ndarray, ...]:
    data = np.frombuffer(b"".join(part for _, _, part in group), np.uint8)
    bounds = np.cumsum([0] + [len(part) for _, _, part in group])
    mark = min(_MARK, length)
    sums = prefix_hashes(data)
    places = np.arange(len(data) - mark + 1)
    marks = mix((sums[mark:] - sums[:-mark]) * tables().inverses[: len(places)])
    # The upper bits order the marks, the lower ones tell places apart.
    low = np.uint64((1 << 24) - 1)
    least = _window_minima(marks & ~low | places.astype(np.uint64), length - mark + 1)
    inside = np.zeros(len(least) + length, np.int32)
    inside[bounds[:-1]] += 1
    inside[bounds[1:] - length + 1] -= 1
    starts = np.flatnonzero(np.cumsum(inside)[: len(least)] > 0)
    least = least[starts]
    anchor, place = least >> np.uint64(24), least & low
    change = (anchor[1:] != anchor[:-1]) | (starts[1:] != starts[:-1] + 1)
    first = np.flatnonzero(np.concatenate([[True], change]))
    last = np.concatenate([first[1:] - 1, [len(starts) - 1]])
    piece = np.searchsorted(bounds, starts[first], side="right") - 1
    owner = np.array([i for i, _, _ in group])[piece]
    offset = np.array([at for _, at, _ in group])[piece] - bounds[piece]
    return (
        owner, mix(anchor[first]), starts[first] + offset, last - first + 1,
        place[first] != place[last],
    )


def sort_suffixes(data: np.ndarray, cuts: np.ndarray, depth: int) -> np.ndarray:
    """Places of all bytes in the order of the first ``depth`` bytes that follow.

    ``cuts`` are the bounds of the strings that ``data`` joins; none reads beyond its
    own. Suffixes smaller than their successor are sorted directly, as are those
    whose run of equal bytes is too long to tell; all others follow by scanning
    the buckets of first bytes upwards, each suffix placing its predecessor.
    """
    n = len(data)
    ends = np.repeat(cuts[1:], np.diff(cuts))
    places = np.arange(n)
    is_bound = np.ones(n + 1, bool)
    is_bound[1:-1] = data[1:] != data[:-1]
    is_bound[cuts] = True
    bounds = np.flatnonzero(is_bound)
    run_end = np.repeat(bounds[1:], np.diff(bounds))
    follows = data[np.minimum(run_end, n - 1)]
    induced = (run_end < ends) & (run_end - places < depth) & (follows < data)
    direct = _sort_directly(data, places[~induced], ends, depth)
    by_byte = np.split(direct, np.searchsorted(data[direct], np.arange(1, 256)))
    waiting: list[list[np.ndarray]] = [[] for _ in range(256)]
    is_first = np.zeros(n, bool)
    is_first[cuts[:-1]] = True
    order = []

    def predecessors(found: np.ndarray) -> np.ndarray:
        before = found[~is_first[found]] - 1
        return before[induced[before]]

    for byte in range(256):
        level = np.concatenate(waiting[byte]) if waiting[byte] else places[:0]
        scanned = []
        while len(level):
            scanned.append(level)
            before = predecessors(level)
            level = before[data[before] == byte]
        bucket = np.concatenate([*scanned, by_byte[byte]])
        order.append(bucket)
        before = predecessors(bucket)
        before = before[data[before] > byte]
        first = data[before]
        sorted_ = before[np.argsort(first, kind="stable")]
        for k, part in zip(*_split(np.sort(first), sorted_)):
            waiting[k].append(part)
    return np.concatenate(order)


def _split(keys: np.ndarray, values: np.ndarray) -> tuple[list[int], list[np.ndarray]]:
    if not len(keys):
        return [], []
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first].tolist(), np.split(values, first[1:])


def _sort_directly(data: np.ndarray, places: np.ndarray, ends: np.ndarray, depth: int) -> np.ndarray:
    """Places by their bytes: by the first eight, then ties of different strings in full."""
    if not len(places):
        return places
    stops = np.minimum(places + depth, ends[places])
    # Equal strings are sorted once.
    whole = stretch(prefix_hashes(data), places, stops)
    _, one, text = np.unique(whole, return_index=True, return_inverse=True)
    begins, stops = places[one], stops[one]
    padded = np.concatenate([data, np.zeros(16, np.uint8)])
    eight = np.zeros(len(data) + 8, np.uint64)
    for k in range(8):
        eight = eight << np.uint64(8) | padded[k : k + len(eight)].astype(np.uint64)
    words = np.stack([eight[begins], eight[begins + 8]])
    for k in range(2):
        beyond = np.flatnonzero(stops - begins < 8 * (k + 1))
        kept = np.maximum(stops[beyond] - begins[beyond] - 8 * k, 0).astype(np.uint64)
        shift = (np.uint64(64) - np.uint64(8) * kept) & np.uint64(63)
        words[k, beyond] = np.where(kept > 0, words[k, beyond] >> shift << shift, 0)
    order = np.lexsort((words[1], words[0]))
    tie = np.all(words[:, order[1:]] == words[:, order[:-1]], axis=0)
    group = np.cumsum(np.concatenate([[True], ~tie]))
    several = np.flatnonzero(np.bincount(group)[group] > 1)
    raw = data.tobytes()
    keys = [
        (g, raw[a:b], i)
        for g, a, b, i in zip(
            group[several].tolist(), begins[order[several]].tolist(),
            stops[order[several]].tolist(), order[several].tolist(),
        )
    ]
    order[several] = [i for _, _, i in sorted(keys)]
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    return places[np.argsort(rank[text], kind="stable")]


def repeated_starts(strings: list[bytes], length: int) -> list[np.ndarray]:
    """Per string, which of its ``length``-byte starts occur twice or more in all of them.

    Neighbours in suffix order whose common prefix reaches ``length`` are repeats.
    """
    data = np.frombuffer(b"".join(strings), np.uint8)
    cuts = np.cumsum([0] + [len(s) for s in strings])
    order = sort_suffixes(data, cuts, length)
    ends = np.repeat(cuts[1:], np.diff(cuts))
    order = order[ends[order] - order >= length]
    sums = prefix_hashes(data)
    hashes = stretch(sums, order, order + length)
    raw, left, right = data.tobytes(), order[:-1], order[1:]
    # The common prefix of neighbours, as far as it matters: all of it or not.
    same = np.flatnonzero(hashes[:-1] == hashes[1:])
    same = [i for i in same.tolist() if raw[left[i] : left[i] + length] == raw[right[i] : right[i] + length]]
    repeated = np.zeros(len(data), bool)
    repeated[left[same]] = True
    repeated[right[same]] = True
    return [repeated[a : max(a, b - length + 1)] for a, b in zip(cuts, cuts[1:])]


def _runs(flags: np.ndarray) -> tuple[list[int], list[int]]:
    edge = np.diff(np.concatenate([[0], flags.astype(np.int8), [0]]))
    return np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist()


_RUNS = "class long, begins array<long>, ends array<long>"


def _sorted_runs(classes: DataFrame, length: int) -> DataFrame:
    """Runs of repeated starts inside each class of segments, whole anchors together."""

    def run(frames):
        strings, names, size, anchor = [], [], 0, None

        def result():
            rows = [(c, *_runs(f)) for c, f in zip(names, repeated_starts(strings, length))]
            return pd.DataFrame(rows, columns=["class", "begins", "ends"])

        for frame in frames:
            for row in frame.itertuples(index=False):
                if size > _BATCH and row.anchor != anchor:
                    yield result()
                    strings, names, size = [], [], 0
                anchor = row.anchor
                strings.append(row.bytes)
                names.append(row[1])
                size += len(row.bytes)
        if strings:
            yield result()

    return (
        classes.select("anchor", "class", "bytes")
        .repartition("anchor")
        .sortWithinPartitions("anchor")
        .mapInPandas(run, _RUNS)
    )


def _dealt_runs(classes: DataFrame, length: int) -> DataFrame:
    """The same for anchors with very many segments: their strings are grouped by digest."""

    def strings(frames):
        for frame in frames:
            for name, data in zip(frame["class"], frame["bytes"]):
                for at in range(0, len(data) - length + 1, 20_000):
                    stop = min(at + 20_000, len(data) - length + 1)
                    digests = [hashlib.md5(data[i : i + length]).digest() for i in range(at, stop)]
                    yield pd.DataFrame({"digest": digests, "class": name, "start": range(at, stop)})

    windows = classes.select("class", "bytes").mapInPandas(
        strings, "digest binary, class long, start long"
    )
    twice = windows.groupBy("digest").agg(F.count("*").alias("n")).filter("n > 1").select("digest")
    starts = windows.join(twice, "digest")
    return (
        starts.groupBy("class")
        .agg(F.collect_set("start").alias("begins"))
        .withColumn("begins", F.sort_array("begins"))
        .withColumn("ends", F.transform("begins", lambda x: x + 1))
    )


def merge_spans(begins: np.ndarray, ends: np.ndarray) -> list[list[int]]:
    """Maximal stretches covered by the given ones, in order."""
    order = np.argsort(begins, kind="stable")
    begins, ends = begins[order], ends[order]
    reach = np.maximum.accumulate(ends)
    new = np.concatenate([[True], begins[1:] > reach[:-1]])
    first = np.flatnonzero(new)
    last = np.concatenate([first[1:] - 1, [len(begins) - 1]])
    return np.stack([begins[first], reach[last]], axis=1).tolist()


def remove_repeats(docs: DataFrame, length: int = 400) -> DataFrame:
    """What stays of each document without the bytes of repeated strings.

    Every byte covered by a ``length``-byte string that starts anywhere else too is
    removed, judged on the input; strings never cross documents. One row per input
    row: doc_id, n_bytes, n_removed, n_spans, kept_sha256, and spans (begin, end) in
    bytes. A missing text is empty; a text shorter than ``length`` keeps all; of
    equal texts at least so long all bytes go; a missing doc_id stays missing; an
    empty table gives no rows. Texts are known by 64 bits.

    Strings are dealt out by an anchor, the smallest hash of their parts, so equal
    strings meet. Segments whose anchor occurs once are left aside; equal segments
    become one class; the others are suffix-sorted with all segments of their
    anchors. Anchors with many megabytes of different segments are dealt out again,
    string by string.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("long"), whole_text().alias("text"))
    texts = texts.withColumn("key", F.xxhash64("text"))
    long_enough = texts.filter(F.octet_length("text") >= length)

    def unseen(frame, seen):
        new = [k not in seen and not seen.add(k) for k in frame["key"].tolist()]
        if len(seen) > _REMEMBERED:
            seen.clear()
        return frame["key"].to_numpy()[new], [t.encode() for t in frame["text"][new]]

    def anchors(frames):
        seen: set[int] = set()
        for frame in frames:
            keys, texts = unseen(frame, seen)
            owner, hashes, first, _, several = segments(texts, length)
            yield pd.DataFrame(
                {"anchor": as_long(hashes), "key": keys[owner], "first": first, "several": several}
            )

    places = long_enough.select("key", "text").mapInPandas(
        anchors, "anchor long, key long, first long, several boolean"
    )
    place = F.struct("key", "first")
    repeated = stored(
        places.groupBy("anchor")
        .agg(F.min(place).alias("low"), F.max(place).alias("high"), F.max("several").alias("several"))
        .filter("several OR low <> high")
        .select("anchor"),
        "anchors",
    )
    keep = Sent(spark, HashFilter.of(repeated, "anchor", repeated.count()))

    def cut(frames):
        seen, classes = set(), set()
        for frame in frames:
            rows = []
            keys, texts = unseen(frame, seen)
            owner, hashes, first, count, _ = segments(texts, length)
            ok = keep.value.holds(hashes)
            for i, anchor, at, n in zip(
                owner[ok].tolist(), as_long(hashes[ok]).tolist(), first[ok].tolist(), count[ok].tolist()
            ):
                part = texts[i][at : at + n + length - 1]
                name = int.from_bytes(hashlib.md5(part).digest()[:8], "little", signed=True)
                rows.append((anchor, keys[i], at, n, name, None if name in classes else part))
                classes.add(name)
            if len(classes) > _REMEMBERED:
                classes.clear()
            yield pd.DataFrame(rows, columns=["anchor", "key", "first", "starts", "class", "bytes"])

    found = stored(
        long_enough.select("key", "text")
        .mapInPandas(
            cut, "anchor long, key long, first long, starts long, class long, bytes binary"
        ),
        "segments",
    )
    places = found.select("class", "key", "first", "starts").distinct()
    counted = stored(
        found.groupBy("class").agg(
            F.count_distinct("key", "first").alias("n"), F.max("starts").alias("starts")
        ),
        "classes",
    )
    classes = found.filter("bytes IS NOT NULL").dropDuplicates(["class"])
    classes = stored(classes.select("anchor", "class", "bytes"), "bytes")
    sizes = classes.groupBy("anchor").agg(F.sum(F.octet_length("bytes")).alias("size"))
    large = stored(sizes.filter(F.col("size") > _LARGE).select("anchor"), "large")
    runs = _sorted_runs(classes.join(large, "anchor", "left_anti"), length)
    if not large.isEmpty():
        runs = runs.unionByName(_dealt_runs(classes.join(large, "anchor", "left_semi"), length))
    whole = counted.filter("n > 1").select(
        "class", F.array(F.lit(0).cast("long")).alias("begins"), F.array("starts").alias("ends")
    )
    single = counted.filter("n = 1").select("class")
    runs = runs.filter(F.size("begins") > 0).join(single, "class").unionByName(whole)
    spans = (
        places.join(runs, "class")
        .select(
            "key",
            F.transform("begins", lambda x: x + F.col("first")).alias("begins"),
            F.transform("ends", lambda x: x + F.col("first") + (length - 1)).alias("ends"),
        )
        .groupBy("key")
        .agg(F.flatten(F.collect_list("begins")).alias("begins"),
             F.flatten(F.collect_list("ends")).alias("ends"))
    )
    spans = stored(spans, "spans")
    digests = stored(
        texts.select("doc_id", "key", F.octet_length("text").cast("long").alias("n_bytes"),
                     F.sha2(F.col("text"), 256).alias("sha")),
        "digests",
    )
    copies = (
        digests.filter(F.col("n_bytes") >= length).groupBy("key").agg(F.count("*").alias("copies"))
        .filter("copies > 1").drop("copies")
    )
    partly = stored(spans.join(copies, "key", "left_anti"), "partly")
    changed = Sent(spark, HashFilter.of(partly, "key", partly.count()))

    def pick(frames):
        for frame in frames:
            ok = changed.value.holds(frame["key"].to_numpy(np.int64).view(np.uint64))
            yield frame[ok]

    def strip(frames):
        for frame in frames:
            rows = []
            for key, text, begins, ends in frame.itertuples(index=False):
                merged = merge_spans(np.asarray(begins, np.int64), np.asarray(ends, np.int64))
                data, kept, at = text.encode(), hashlib.sha256(), 0
                for begin, end in merged:
                    kept.update(data[at:begin])
                    at = end
                kept.update(data[at:])
                rows.append((key, sum(e - b for b, e in merged), merged, kept.hexdigest()))
            yield pd.DataFrame(rows, columns=["key", "removed", "spans", "kept"])

    candidates = long_enough.select("key", "text").mapInPandas(pick, "key long, text string")
    stripped = (
        candidates.join(partly, "key")
        .select("key", "text", "begins", "ends")
        .mapInPandas(strip, "key long, removed long, spans array<array<long>>, kept string")
        .dropDuplicates(["key"])
    )
    everything = copies.withColumn("copied", F.lit(True))
    out = digests.join(everything, "key", "left").join(stripped, "key", "left")
    gone = F.col("copied").isNotNull()
    no_spans = F.array().cast("array<array<long>>")
    all_of_it = F.array(F.array(F.lit(0).cast("long"), F.col("n_bytes")))
    return out.select(
        "doc_id", "n_bytes",
        F.when(gone, F.col("n_bytes")).otherwise(F.coalesce("removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(gone, F.lit(1)).otherwise(F.coalesce(F.size("spans"), F.lit(0))).cast("long").alias("n_spans"),
        F.when(gone, F.lit(hashlib.sha256(b"").hexdigest())).otherwise(F.coalesce("kept", "sha")).alias("kept_sha256"),
        F.when(gone, all_of_it).otherwise(F.coalesce("spans", no_spans)).alias("spans"),
    )
