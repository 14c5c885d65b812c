"""Similarity join of word shingle sets with parity sketches."""

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortlake.llm.common import HashFilter, Sent, as_long, grams, mix, stored, word_hashes
from cohortlake.llm.components import connected

# Sizes of sets are banded by this ratio.
_RATIO = 1.5
# Centres of a group grow by this factor each round, up to so many more at once.
_GROWTH, _CENTRES = 16, 4096
# Members of a group compared in one task, and bits of the sketch that goes with them.
_SALT, _SHORT = 50_000, 512
# Sets remembered by a task to leave out copies.
_REMEMBERED = 500_000


class Threshold:
    """Sets are linked when ``high * common >= low * union``, low / high the similarity."""

    def __init__(self, low: int, high: int):
        self.low, self.high = low, high
        edges = [1]
        while edges[-1] < 1 << 40:
            edges.append(max(edges[-1] + 1, int(edges[-1] * _RATIO)))
        self.edges = np.array(edges, np.int64)

    def difference(self, sizes):
        """Largest symmetric difference of two linked sets with so many members together."""
        return sizes * (self.high - self.low) // (self.high + self.low)

    def difference_in(self, bands):
        """Largest symmetric difference of two linked sets whose sizes lie up to the band's end."""
        return self.difference(2 * (self.edges[bands + 1] - 1))

    def spare(self, bands):
        """Blocks above the largest difference: in so many at least two linked sets agree.

        Each set may then leave out one key less than that: if all sets leave out their
        most frequent ones, two linked sets still share a key. These are empty
        blocks, and blocks whose members stand in very many sets.
        """
        return 3 + self.difference_in(bands) // 5

    def linked(self, a: np.ndarray, b: np.ndarray) -> bool:
        common = len(np.intersect1d(a, b, assume_unique=True))
        return self.high * common >= self.low * (len(a) + len(b) - common)


def shingle_sets(texts: list, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each text, and where each text's begin.

    A text with fewer words than n has its whole sequence as the only shingle; one
    without words has none.
    """
    hashes, begins = word_hashes(texts)
    values, at = grams(hashes, begins, n)
    owner = np.searchsorted(begins, at, side="right") - 1
    sizes = np.diff(begins)
    for i in np.flatnonzero((sizes > 0) & (sizes < n)):
        total = np.uint64(int(sizes[i]))
        for h in hashes[begins[i] : begins[i + 1]]:
            total = mix(np.array([total ^ h]))[0]
        values, owner = np.append(values, total), np.append(owner, i)
    order = np.lexsort((values, owner))
    values, owner = values[order], owner[order]
    new = np.ones(len(values), bool)
    new[1:] = (values[1:] != values[:-1]) | (owner[1:] != owner[:-1])
    values, owner = values[new], owner[new]
    return values, np.searchsorted(owner, np.arange(len(texts) + 1))


def set_ids(values: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """64-bit identity of each set, 0 for the empty one."""
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(values ^ np.uint64(0xA5A5)))])
    sizes = np.diff(begins).astype(np.uint64)
    ids = mix((sums[begins[1:]] - sums[begins[:-1]]) ^ mix(sizes))
    return np.where(sizes > 0, ids, np.uint64(0))


def block_keys(
    values: np.ndarray, begins: np.ndarray, limit: Threshold
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys of each set's parity blocks, the set each belongs to, and its size band.

    In each size band the members are dealt to blocks by hash; a block is the XOR of
    its members' hashes, 0 if it is empty. A set near the upper edge of its band also
    has keys in the next, so two linked sets have keys in a common band.
    """
    sizes = np.diff(begins)
    band = np.searchsorted(limit.edges, sizes, side="right") - 1
    keys, owners, bands = [], [], []
    members = mix(values ^ np.uint64(0x5BD1E995))
    for step in (0, 1):
        of = band + step
        use = (sizes > 0) & (limit.difference_in(of) > 0)
        if step:
            use &= limit.high * sizes >= limit.low * limit.edges[of]
        chosen = np.flatnonzero(use)
        if not len(chosen):
            continue
        of = of[chosen]
        blocks = limit.difference_in(of) + limit.spare(of)
        offsets = np.concatenate([[0], np.cumsum(blocks)])
        index = np.full(len(sizes), -1)
        index[chosen] = np.arange(len(chosen))
        owner = np.repeat(index, sizes)
        inside = owner >= 0
        owner, own = owner[inside], members[inside]
        salt = mix(of.astype(np.uint64) + np.uint64(77))
        block = (mix(own + salt[owner]) % blocks[owner].astype(np.uint64)).astype(np.int64)
        place = offsets[owner] + block
        order = np.argsort(place, kind="stable")
        place, own = place[order], own[order]
        first = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
        parity = np.zeros(offsets[-1], np.uint64)
        parity[place[first]] = np.bitwise_xor.reduceat(own, first)
        doc = np.repeat(np.arange(len(chosen)), blocks)
        number = (np.arange(offsets[-1]) - offsets[doc]).astype(np.uint64)
        keys.append(mix(parity ^ mix(salt[doc] + number)))
        owners.append(chosen[doc])
        bands.append(of[doc])
    if not keys:
        none = np.zeros(0, np.int64)
        return none.astype(np.uint64), none, none
    return np.concatenate(keys), np.concatenate(owners), np.concatenate(bands)


def bit_sketch(members: np.ndarray, bits: int = 0) -> bytes:
    """Parities of the members by hash: bits, a power of two, by default of at least twice
    the members."""
    bits = bits or max(64, 1 << int(2 * len(members) - 1).bit_length())
    place = (mix(members + np.uint64(0xC0FFEE)) & np.uint64(bits - 1)).astype(np.int64)
    return np.packbits(np.bincount(place, minlength=bits) & 1).tobytes()


def hamming(a: bytes, b: bytes) -> int:
    """Differing bits of two sketches, the longer one folded: at most the symmetric difference."""
    x, y = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)
    while len(x) != len(y):
        if len(x) < len(y):
            x, y = y, x
        x = x[: len(x) // 2] ^ x[len(x) // 2 :]
    return int(np.bitwise_count(x ^ y).sum())


def _texts(docs: DataFrame) -> DataFrame:
    return docs.selectExpr("cast(doc_id as long) doc_id", "cast(text as string) text")


def _all_keys(docs: DataFrame, n: int, limit: Threshold) -> DataFrame:
    def run(frames):
        seen: set[int] = set()
        for frame in frames:
            values, begins = shingle_sets(frame["text"].tolist(), n)
            ids = set_ids(values, begins)
            keys, owners, _ = block_keys(values, begins, limit)
            fresh = np.zeros(len(ids), bool)
            for i, id_ in enumerate(ids.tolist()):
                if id_ not in seen:
                    seen.add(id_)
                    fresh[i] = True
            if len(seen) > _REMEMBERED:
                seen.clear()
            use = fresh[owners]
            yield pd.DataFrame({"key": as_long(keys[use]), "id": as_long(ids[owners[use]])})

    return _texts(docs).mapInPandas(run, "key long, id long")


_SETS = "doc_id long, n long, id long, keys array<long>, bands array<int>, members binary, sketch binary, short binary"


def _sets(docs: DataFrame, n: int, limit: Threshold, keep) -> DataFrame:
    """Every document with its set's size and identity; members and sketch where a key is shared."""

    def run(frames):
        seen: set[int] = set()
        for frame in frames:
            values, begins = shingle_sets(frame["text"].tolist(), n)
            ids = set_ids(values, begins)
            keys, owners, bands = block_keys(values, begins, limit)
            ok = np.flatnonzero(keep.value.holds(keys))
            ok = ok[np.argsort(owners[ok], kind="stable")]
            keys, owners, bands = as_long(keys[ok]), owners[ok], bands[ok]
            cuts = np.searchsorted(owners, np.arange(len(ids) + 1))
            rows = []
            for i, id_ in enumerate(as_long(ids).tolist()):
                own = keys[cuts[i] : cuts[i + 1]]
                members = values[begins[i] : begins[i + 1]]
                row = [int(begins[i + 1] - begins[i]), id_, None, None, None, None, None]
                if len(own) and id_ not in seen:
                    seen.add(id_)
                    of = bands[cuts[i] : cuts[i + 1]].tolist()
                    sketches = bit_sketch(members), bit_sketch(members, _SHORT)
                    row[2:] = own.tolist(), of, members.tobytes(), *sketches
                rows.append(row)
            if len(seen) > _REMEMBERED:
                seen.clear()
            out = pd.DataFrame(rows, columns=["n", "id", "keys", "bands", "members", "sketch", "short"])
            out.insert(0, "doc_id", frame["doc_id"].astype("Int64"))
            yield out

    return _texts(docs).mapInPandas(run, _SETS)


def _verified(pairs: DataFrame, documents: DataFrame, limit: Threshold) -> DataFrame:
    """Pairs (a, b) of set identities that are linked: sketches first, then the members.

    Only the members of sets in a pair are shuffled; a filter of fixed size picks them.
    """
    ids = pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    needed = Sent(pairs.sparkSession, HashFilter.of(ids, "id", 2 * pairs.count()))

    def chosen(frames):
        for frame in frames:
            yield frame[needed.value.holds(frame["id"].to_numpy(np.int64).view(np.uint64))]

    sets = (
        documents.filter("members IS NOT NULL")
        .select("id", "sketch", "members")
        .mapInPandas(chosen, "id long, sketch binary, members binary")
        .dropDuplicates(["id"])
    )

    def linked(frames):
        for frame in frames:
            ok = []
            for s_a, s_b, m_a, m_b in zip(frame["s_a"], frame["s_b"], frame["m_a"], frame["m_b"]):
                a, b = np.frombuffer(m_a, np.uint64), np.frombuffer(m_b, np.uint64)
                near = hamming(s_a, s_b) <= limit.difference(len(a) + len(b))
                ok.append(near and limit.linked(a, b))
            yield frame.loc[np.array(ok, bool), ["a", "b"]]

    full = pairs
    for side in ("a", "b"):
        more = sets.select(
            F.col("id").alias(side), F.col("sketch").alias(f"s_{side}"), F.col("members").alias(f"m_{side}")
        )
        full = full.join(more, side)
    return full.select("a", "b", "s_a", "s_b", "m_a", "m_b").mapInPandas(linked, "a long, b long")


def _near_pairs(rows: DataFrame, limit: Threshold) -> DataFrame:
    """Pairs of a group's centres and members of other components that may be linked.

    Rows of a group come with its centres first; members pass by as a stream and are
    compared by their short sketches, so only near pairs become rows. A large group is
    dealt to several tasks, each with all its centres of the round.
    """

    def compare(frames):
        group, centres = None, None
        for frame in frames:
            out = [np.zeros((0, 2), np.int64)]
            sketches = np.frombuffer(b"".join(frame["short"]), np.uint64).reshape(len(frame), -1)
            columns = {c: frame[c].to_numpy() for c in ("id", "component", "n", "centre", "best")}
            keys = np.stack([frame["key"].to_numpy(), frame["salt"].to_numpy()])
            cuts = np.flatnonzero(np.any(keys[:, 1:] != keys[:, :-1], axis=0)) + 1
            for at in np.split(np.arange(len(frame)), cuts):
                name = tuple(keys[:, at[0]])
                if name != group:
                    group, centres = name, None
                part = {c: v[at] for c, v in columns.items()} | {"sketch": sketches[at]}
                first = {c: v[part["centre"]] for c, v in part.items()}
                centres = first if centres is None else {
                    c: np.concatenate([v, first[c]]) for c, v in centres.items()
                }
                rest = {c: v[~part["centre"]] for c, v in part.items()}
                for i in range(len(rest["id"]) if len(centres["id"]) else 0):
                    n, other = rest["n"][i], centres["n"]
                    ok = (centres["component"] != rest["component"][i]) & (
                        (rest["id"][i] > centres["id"]) | centres["best"] & (rest["id"][i] != centres["id"])
                    )
                    ok &= limit.high * np.minimum(n, other) >= limit.low * np.maximum(n, other)
                    found = np.flatnonzero(ok)
                    apart = np.bitwise_count(centres["sketch"][found] ^ rest["sketch"][i]).sum(axis=1)
                    found = found[apart <= limit.difference(n + other[found])]
                    pair = np.stack([np.full(len(found), rest["id"][i]), centres["id"][found]], axis=1)
                    out.append(np.sort(pair, axis=1))
            pairs = np.unique(np.concatenate(out), axis=0)
            yield pd.DataFrame({"a": pairs[:, 0], "b": pairs[:, 1]})

    salts = F.ceil(F.col("m") / _SALT).cast("int")
    own = F.pmod(F.xxhash64("id"), salts).cast("int")
    member = F.array(F.struct(own.alias("salt"), F.lit(False).alias("centre")))
    centre = F.transform(
        F.sequence(F.lit(0), salts - 1), lambda salt: F.struct(salt.alias("salt"), F.lit(True).alias("centre"))
    )
    places = F.when(F.col("turn") | F.col("best"), F.concat(member, centre)).otherwise(member)
    dealt = (
        rows.select("*", F.explode(places).alias("place"))
        .select("*", "place.salt", "place.centre")
        .repartition("key", "salt")
        .sortWithinPartitions("key", "salt", F.desc("centre"))
        .select("key", "salt", "id", "component", "n", "centre", F.expr("best AND NOT turn").alias("best"), "short")
    )
    return dealt.mapInPandas(compare, "a long, b long").distinct()


def _linked_sets(shared: DataFrame, documents: DataFrame, limit: Threshold) -> DataFrame:
    """(id, component) of the sets that share keys.

    A set leaves out its most frequent keys, see ``Threshold.spare``. Keys with the
    same sets are one group, known by a 64-bit hash of all its sets. Within a
    group some members are centres, compared with all members of other components;
    every round has sixteen times the centres of the last, and the set with most
    links. A group whose members are all one component is done, so a group of very
    many near copies costs few comparisons for each; a group of unrelated sets ends
    when all its members have been centres.
    """
    spare = F.array(*[F.lit(int(x)) for x in limit.spare(np.arange(len(limit.edges) - 1))])
    rank = F.row_number().over(
        Window.partitionBy("id", "band").orderBy(F.desc("m"), F.desc("key"))
    )
    sets = documents.filter("keys IS NOT NULL").select("id", "n", "keys", "bands", "short")
    sets = stored(sets.dropDuplicates(["id"]), "distinct")
    rare = stored(
        sets.select("id", F.explode(F.arrays_zip("keys", "bands")).alias("k"))
        .select("id", F.col("k.keys").alias("key"), F.col("k.bands").alias("band"))
        .join(shared, "key")
        .withColumn("rank", rank)
        .filter(F.col("rank") >= F.get(spare, F.col("band")))
        .select("id", "key"),
        "rare",
    )
    groups = (
        rare.groupBy("key")
        .agg(
            F.count("*").alias("m"),
            F.min("id").alias("low"),
            F.bit_xor(F.xxhash64(F.lit(5), "id")).alias("mark"),
        )
        .filter("m > 1")
        .groupBy("m", "low", "mark")
        .agg(F.min("key").alias("key"))
        .drop("mark")
    )
    members = stored(rare.join(groups, "key"), "members")
    most = members.agg(F.max("m")).first()[0] or 0
    place = F.col("id").cast("double") / 2.0**64 + 0.5
    columns = ["key", "id", "m", "low"]

    def centres(step: int) -> int:
        powers = [_GROWTH**k for k in range(step + 1) if _GROWTH**k <= _CENTRES]
        return powers[-1] + _CENTRES * (step + 1 - len(powers))

    def within(step: int):
        return (place <= centres(step) / F.col("m")) | (F.col("id") == F.col("low"))

    state = members.select(*columns, F.col("id").alias("component"), F.lit(0).alias("degree"))
    links = labels = None
    step = 0
    while True:
        open_ = (
            state.groupBy("key")
            .agg(F.min("component").alias("low_c"), F.max("component").alias("high_c"),
                 F.max(F.struct("degree", "id")).alias("best"))
            .filter("low_c <> high_c")
            .select("key", F.col("best.id").alias("best"))
        )
        turn = within(step) & ~within(step - 1) if step else within(0)
        best = F.col("id") == F.col("best") if step else F.lit(False)
        active = state.join(open_, "key").select(
            *columns, "component", turn.alias("turn"), best.alias("best")
        )
        active = stored(active, "active")
        sketched = active.join(sets.select("id", "n", "short"), "id")
        near = stored(_near_pairs(sketched, limit), "near")
        new = None if near.isEmpty() else stored(_verified(near, documents, limit), "linked")
        state = active.select(*columns, "component", F.lit(0).alias("degree"))
        if new is not None and not new.isEmpty():
            links = new if links is None else links.unionByName(new)
            known = new
            if labels is not None:
                known = new.unionByName(labels.select(F.col("node").alias("a"), F.col("component").alias("b")))
            labels = stored(connected(known), "labels")
            degrees = (
                links.select(F.explode(F.array("a", "b")).alias("node"))
                .groupBy("node").agg(F.count("*").cast("int").alias("degree"))
            )
            found = stored(labels.join(degrees, "node").withColumnRenamed("node", "id"), "found")
            state = active.select(*columns).join(found, "id", "left").select(
                *columns,
                F.coalesce("component", "id").alias("component"),
                F.coalesce("degree", F.lit(0)).alias("degree"),
            )
        if centres(step) >= most or active.isEmpty():
            break
        step += 1
    if labels is None:
        return sets.select("id", F.col("id").alias("component")).limit(0)
    return labels.withColumnRenamed("node", "id")


def similar_components(docs: DataFrame, n: int = 5, low: int = 80, high: int = 100) -> DataFrame:
    """Components of documents whose sets of n-word shingles are similar.

    Words have A-Z lowered. Two documents link when ``high * common >= low *
    union``. One row per input row: doc_id, n_shingles and component_id, the
    smallest doc_id reachable by links (its own for a document without words or text,
    which links with nothing). Equal sets are one class from the start, known by
    64 bits, so groups of copies cost nothing more; repeated rows fall into one
    class. A missing doc_id links like others but names no component; a component
    without any doc_id has none. An empty table gives no rows.
    """
    limit = Threshold(low, high)
    spark = docs.sparkSession
    groups = (
        _all_keys(docs, n, limit)
        .groupBy("key")
        .agg(F.min("id").alias("low"), F.max("id").alias("high"), F.count("*").alias("m"))
        .filter("low <> high")
        .drop("low", "high")
    )
    shared = stored(groups, "shared")
    keep = Sent(spark, HashFilter.of(shared, "key", shared.count()))
    documents = stored(_sets(docs, n, limit, keep), "sets")
    parts = stored(_linked_sets(shared, documents, limit), "parts")
    classes = documents.filter("n > 0").groupBy("id").agg(F.min("doc_id").alias("first"))
    classes = classes.join(parts, "id", "left").withColumn(
        "component", F.coalesce("component", "id")
    )
    smallest = classes.groupBy("component").agg(F.min("first").alias("component_id"))
    named = classes.join(smallest, "component").select("id", "component_id")
    alone = documents.filter("n = 0").select("doc_id", "n", F.col("doc_id").alias("component_id"))
    grouped = documents.filter("n > 0").join(named, "id").select("doc_id", "n", "component_id")
    return grouped.unionByName(alone).withColumnRenamed("n", "n_shingles")
