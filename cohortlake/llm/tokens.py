"""Token ids in binary shards, with a minimal perfect hash index by document."""

import re
import sys
import zlib
from array import array
from codecs import charmap_decode
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortlake.llm.common import mix, stored, whole_text
from cohortlake.llm.files import reading, writing
from cohortlake.session import run_folder

# Classes of bytes, by what is known of the characters they belong to: nothing, a letter
# A-Z or a-z, a mark, another character that is no white space, a later byte of a longer
# character, white space, a line's end, the first byte of a Latin letter (or of one of
# two signs), the first byte of another character that is no white space.
_LETTER, _MARK, _OTHER, _LATER, _SPACE, _LINE, _LATIN, _FIRST = range(1, 9)
_MARKS = b'.,;:!?%$#&*|()"-/'
_CLASS = bytearray(256)
for _class, _members in (
    (_OTHER, range(33, 127)), (_LETTER, range(65, 91)), (_LETTER, range(97, 123)),
    (_MARK, _MARKS), (_LATER, range(0x80, 0xC0)), (_SPACE, b" \t\v\f\r"), (_LINE, b"\n"),
    (_FIRST, range(0xC9, 0xF5)), (_LATIN, range(0xC3, 0xC9)), (0, b"\xe1\xe2\xe3"),
):
    for _byte in _members:
        _CLASS[_byte] = _class
_CLASS = bytes(_CLASS)
# By the classes of two neighbouring bytes: whether a unit of the byte-level pattern
# always ends between them, 1, or does under one of the conditions below.
_NEXT = np.zeros(256, np.uint8)
_AFTER_LATER, _AFTER_LATIN, _BEFORE_LATIN, _AFTER_LINE = 2, 3, 4, 5
for _space in (_SPACE, _LINE):
    _NEXT[[c << 4 | _space for c in (_LETTER, _MARK, _OTHER)]] = 1
    _NEXT[_LATER << 4 | _space] = _AFTER_LATER
_NEXT[[_LETTER << 4 | _MARK, _MARK << 4 | _LETTER]] = 1
_NEXT[_LATER << 4 | _MARK] = _AFTER_LATIN
_NEXT[_MARK << 4 | _LATIN] = _BEFORE_LATIN
_NEXT[[_LINE << 4 | c for c in (_LETTER, _MARK, _OTHER, _LATIN, _FIRST)]] = _AFTER_LINE
_NEXT = _NEXT.tobytes()
# A byte of no text.
_EDGE = b"\xff"
# Where a long text can be cut.
_CUT = re.compile(rb"[!-~](?= [!-~])")
# Words of Latin letters, and numbers.
_PLAIN = re.compile(
    rb" ?(?:(?:[A-Za-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf]|[\xc4-\xc8][\x80-\xbf])+|[0-9]+)"
)
# Bytes of the units that are told apart as two numbers, with their length.
_SHORT = 15
_LOW = np.array([(1 << 8 * min(n, 8)) - 1 for n in range(_SHORT + 1)], np.uint64)
_HIGH = np.array([(1 << 8 * max(n - 8, 0)) - 1 for n in range(_SHORT + 1)], np.uint64)
# Bytes cut into units at once, and bytes of units and ids remembered by a process, in two
# halves, with what Python adds to each.
_GROUP = 512 << 10
_KNOWN, _ADDED = 32 << 20, 150
_SHARD = 32 << 20
# Keys per bucket of the index, and positions per key of one level.
_KEYS = 20_000
_LOOSE = 2


def _starts(raw: bytes, edges: np.ndarray) -> np.ndarray:
    """Where units begin: at the edges, and wherever the pattern surely ends a match.

    That is before white space behind another character, between letters and marks, and
    behind a line's end that stands alone; where the bytes leave doubt nothing is cut.
    """
    data = np.frombuffer(raw, np.uint8)
    kinds = np.frombuffer(raw.translate(_CLASS), np.uint8)
    pairs = (kinds[:-1] << np.uint8(4)) | kinds[1:]
    cut = np.zeros(len(raw), np.uint8)
    cut[1:] = np.frombuffer(pairs.tobytes().translate(_NEXT), np.uint8)
    doubt = np.flatnonzero(cut > 1)
    asked = cut[doubt]
    cut[doubt] = 0
    # A space may be of two bytes from C2 on, or of three from E1, E2 or E3 on.
    at = doubt[asked == _AFTER_LATER]
    third = data[np.maximum(at - 3, 0)]
    cut[at] = (data[at - 2] != 0xC2) & ((third < 0xE1) | (third > 0xE3))
    at = doubt[asked == _AFTER_LATIN]
    first = data[at - 2]
    cut[at] = (kinds[at - 2] == _LATIN) & ~_is_sign(first, data[at - 1])
    at = doubt[asked == _BEFORE_LATIN]
    cut[at] = ~_is_sign(data[at], data[at + 1])
    at = doubt[asked == _AFTER_LINE]
    cut[at] = cut[at - 1]
    cut[edges] = 1
    return np.flatnonzero(cut)


def _is_sign(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Whether two bytes are a sign of multiplication or division, among the Latin letters."""
    return (first == 0xC3) & ((second == 0x97) | (second == 0xB7))


def _first_equals(low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """For each pair of numbers the index of an equal pair, the same for all equal ones."""
    equal, left, level = np.zeros(len(low), np.int64), np.arange(len(low)), 0
    hashes = mix(low ^ mix(high))
    while len(left):
        bits = len(left).bit_length() + 1
        slot = (hashes >> np.uint64(64 - bits)).astype(np.int64)
        claimed = np.zeros(1 << bits, np.int64)
        claimed[slot] = left
        first = claimed[slot]
        ok = (low[first] == low[left]) & (high[first] == high[left])
        equal[left[ok]] = first[ok]
        left, level = left[~ok], level + 1
        hashes = mix(hashes[~ok] + np.uint64(level))
    return equal


def _parts(data: bytes) -> list[bytes]:
    """A long text, cut where the pattern surely ends a match."""
    parts, at = [], 0
    while len(data) - at > _GROUP and (found := _CUT.search(data, at + _GROUP)):
        parts.append(data[at : found.end()])
        at = found.end()
    return [*parts, data[at:]]


class _Known(dict):
    """Ids of strings; one that is not there yet is asked for when it is looked up."""

    def __init__(self, ids):
        self._ids, self.size = ids, 0

    def __missing__(self, unit: bytes) -> bytes:
        code = self[unit] = self._ids(unit)
        self.size += len(unit) + len(code) + _ADDED
        return code


class Encoder:
    """Ids of texts as the tokenizer gives them, each unit encoded once while remembered."""

    def __init__(self, path: str, dtype):
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._tokenizer.no_padding()
        self._tokenizer.no_truncation()
        self._split = self._tokenizer.model.tokenize
        self._dtype = np.dtype(dtype)
        self._code = "H" if self._dtype.itemsize == 2 else "I"
        # The model's letters for bytes: printable ones stand for themselves, the others
        # follow each other from 256 on.
        plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
        others = [b for b in range(256) if b not in plain]
        letters = {b: chr(256 + k) for k, b in enumerate(others)}
        self._letters = "".join(letters.get(b, chr(b)) for b in range(256))
        self._added = [t.content for t in self._tokenizer.get_added_tokens_decoder().values()]
        self._known = _Known(self._ids)
        self._older: dict[bytes, bytes] = {}

    def _bytes(self, ids) -> bytes:
        out = array(self._code, ids)
        if sys.byteorder == "big":
            out.byteswap()
        return out.tobytes()

    def _encode(self, text: str) -> bytes:
        return self._bytes(self._tokenizer.encode(text, add_special_tokens=False).ids)

    def _ids(self, unit: bytes) -> bytes:
        """The ids of a unit; words of Latin letters and numbers are given to the model directly."""
        if (ids := self._older.get(unit)) is not None:
            return ids
        if not _PLAIN.fullmatch(unit):
            return self._encode(unit.decode())
        spelled = charmap_decode(unit, "strict", self._letters)[0]
        return self._bytes([t.id for t in self._split(spelled)])

    def _group(self, texts: list[bytes]) -> list[bytes]:
        raw = _EDGE.join(texts) + _EDGE
        ends = np.cumsum([len(t) + 1 for t in texts]) - 1
        begins = np.concatenate([[0], ends[:-1] + 1])
        starts = _starts(raw, np.concatenate([begins, ends]))
        sizes = np.diff(starts, append=len(raw))
        # Equal units are looked up once.
        short = np.flatnonzero(sizes <= _SHORT)
        size, padded = sizes[short], raw + bytes(16)
        eight = np.ndarray(len(raw) + 8, "<u8", padded, strides=(1,))
        low = eight[starts[short]] & _LOW[size]
        high = eight[starts[short] + 8] & _HIGH[size] | size.astype(np.uint64) << np.uint64(56)
        unit = np.arange(len(starts))
        unit[short] = short[_first_equals(low, high)]
        own = np.flatnonzero(unit == np.arange(len(starts)))
        number = np.zeros(len(starts), np.int64)
        number[own] = np.arange(len(own))
        number = number[unit]
        known, stops = self._known, (starts + sizes)[own].tolist()
        codes = [b"" if raw[a] == 0xFF else known[raw[a:b]] for a, b in zip(starts[own].tolist(), stops)]
        lengths = np.fromiter(map(len, codes), np.int64, len(codes)) // self._dtype.itemsize
        places, count = np.cumsum(lengths) - lengths, lengths[number]
        after = np.cumsum(count)
        taken = np.repeat(places[number] - after + count, count) + np.arange(after[-1])
        ids = np.frombuffer(b"".join(codes), self._dtype)[taken]
        bounds = after[np.searchsorted(starts, ends)].tolist()
        return [ids[a:b].tobytes() for a, b in zip([0, *bounds], bounds)]

    def __call__(self, texts: list[str]) -> list[bytes]:
        """Ids of each text; texts with an added token are left to the library as a whole."""
        out: list[list[bytes]] = [[] for _ in texts]
        group, owners, size = [], [], 0

        def flush():
            if self._known.size > _KNOWN:
                self._known, self._older = _Known(self._ids), self._known
            for i, ids in zip(owners, self._group(group) if group else ()):
                out[i].append(ids)

        for i, text in enumerate(texts):
            if any(token in text for token in self._added):
                out[i].append(self._encode(text))
                continue
            for part in _parts(text.encode()):
                if size + len(part) > _GROUP:
                    flush()
                    group, owners, size = [], [], 0
                group.append(part)
                owners.append(i)
                size += len(part)
        flush()
        return [ids[0] if len(ids) == 1 else b"".join(ids) for ids in out]


@lru_cache(maxsize=1)
def kept_encoder(path: str, dtype: str) -> Encoder:
    """The process's encoder, whose remembered units serve the tasks that follow too."""
    return Encoder(path, dtype)


_ENTRY = "doc_id long, copy long, shard string, at long, n_tokens long"


def write_shards(docs: DataFrame, folder: str, tokenizer: str, end_id: int) -> DataFrame:
    """Raw little-endian ids of all documents in shards; one row per document.

    Documents are sorted by doc_id (missing first), then text; equal doc_ids are
    numbered by ``copy``. Ids take two bytes where the vocabulary allows. A shard
    holds a run of the order. ``at`` is the place in ids within the shard.
    """
    from tokenizers import Tokenizer

    wide = Tokenizer.from_file(tokenizer).get_vocab_size(with_added_tokens=True) > 1 << 16
    dtype = np.dtype("<u4" if wide or end_id >= 1 << 16 else "<u2")
    end = np.array([end_id], dtype).tobytes()

    def write(frames):
        encoder, last, copy = kept_encoder(tokenizer, dtype.str), (), 0
        frame = next(frames, None)
        while frame is not None:
            rows, at = [], 0
            with writing(folder, f".u{dtype.itemsize * 8}") as (name, out):
                while frame is not None and at * dtype.itemsize < _SHARD:
                    for doc_id, ids in zip(frame["doc_id"], encoder(frame["text"].tolist())):
                        copy = copy + 1 if doc_id == last else 0
                        last = doc_id
                        n = len(ids) // dtype.itemsize + 1
                        out.write(ids)
                        out.write(end)
                        rows.append((None if doc_id is None else int(doc_id), copy, name, at, n))
                        at += n
                    frame = next(frames, None)
            out_frame = pd.DataFrame(
                rows, columns=["doc_id", "copy", "shard", "at", "n_tokens"], dtype=object
            )
            yield out_frame.astype({"doc_id": "Int64", "copy": "int64", "at": "int64"})

    ordered = (
        docs.select(F.col("doc_id").cast("long").cast("string").alias("key"),
                    F.col("doc_id").cast("long"), whole_text().alias("text"))
        .repartitionByRange("doc_id")
        .sortWithinPartitions("doc_id", "text")
        .select(F.col("key").alias("doc_id"), "text")
    )
    return ordered.mapInPandas(write, _ENTRY)


def number_shards(entries: DataFrame) -> DataFrame:
    """Each shard's number in the order of its first key, and the ids before it.

    The window sees one row per shard, that is per some 32 MB of ids.
    """
    order = Window.orderBy("first", "shard")
    return (
        entries.groupBy("shard")
        .agg(F.min(F.struct(F.col("doc_id").isNotNull(), "doc_id", "copy")).alias("first"),
             F.sum("n_tokens").alias("ids"))
        .select("shard", F.row_number().over(order).alias("number"),
                (F.sum("ids").over(order) - F.col("ids")).alias("before"))
    )


def key_hashes(doc_ids: pd.Series, copies: pd.Series) -> np.ndarray:
    """64-bit hash of a key; a missing doc_id is a key too."""
    missing = doc_ids.isna().to_numpy()
    ids = doc_ids.fillna(0).astype("int64").to_numpy().view(np.uint64)
    x = mix(mix(ids + np.uint64(0x51ED27)) + copies.to_numpy(np.int64).view(np.uint64))
    return np.where(missing, mix(x + np.uint64(1)), x)


def _slots(hashes: np.ndarray, level: int, size: int) -> np.ndarray:
    return (mix(hashes + np.uint64(level * 0x9E3779B9 + 7)) % np.uint64(size)).astype(np.int64)


def build_hash(hashes: np.ndarray) -> list[np.ndarray]:
    """Levels of a minimal perfect hash: bits of the slots that exactly one key claims.

    Keys that collide go to the next level. A key's number is the rank of its bit.
    """
    levels, left = [], hashes
    while len(left):
        if len(levels) > 200:
            raise ValueError("two keys share a hash")
        size = len(left) * _LOOSE + 1
        slot = _slots(left, len(levels), size)
        claims = np.bincount(slot, minlength=size)
        levels.append(claims == 1)
        left = left[claims[slot] != 1]
    return levels


def look_up(levels: list[np.ndarray], hashes: np.ndarray) -> np.ndarray:
    """Numbers of keys, in time that does not depend on how many keys there are; -1 if none."""
    numbers, left, base = np.full(len(hashes), -1, np.int64), np.arange(len(hashes)), 0
    for k, bits in enumerate(levels):
        if not len(left):
            break
        slot = _slots(hashes[left], k, len(bits))
        found = bits[slot]
        ranks = np.cumsum(bits) - 1
        numbers[left[found]] = base + ranks[slot[found]]
        left, base = left[~found], base + int(bits.sum())
    return numbers


_INDEX = "bucket long, sizes array<int>, bits binary, prints binary, shards binary, places binary, lengths binary"


def build_index(entries: DataFrame, buckets: int) -> DataFrame:
    """A row per bucket of keys: levels of its hash, and by key number a 32-bit
    fingerprint, shard number, place and length."""

    def build(frame: pd.DataFrame) -> pd.DataFrame:
        hashes = key_hashes(frame["doc_id"], frame["copy"])
        levels = build_hash(hashes)
        order = np.argsort(look_up(levels, hashes))
        column = lambda name, kind: frame[name].to_numpy()[order].astype(kind).tobytes()
        row = {
            "bucket": int(frame["bucket"].iloc[0]),
            "sizes": [len(b) for b in levels],
            "bits": b"".join(np.packbits(b).tobytes() for b in levels),
            "prints": (mix(hashes)[order] >> np.uint64(32)).astype("<u4").tobytes(),
            "shards": column("number", "<u4"),
            "places": column("at", "<u8"),
            "lengths": column("n_tokens", "<u8"),
        }
        return pd.DataFrame([row])

    return _bucketed(entries, buckets).groupBy("bucket").applyInPandas(build, _INDEX)


def _bucketed(keys: DataFrame, buckets: int) -> DataFrame:
    return keys.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "copy"), F.lit(buckets)))


def _levels(sizes, bits: bytes) -> list[np.ndarray]:
    levels, at = [], 0
    for size in sizes:
        n = (size + 7) // 8
        part = np.frombuffer(bits, np.uint8, count=n, offset=at)
        levels.append(np.unpackbits(part, count=size).astype(bool))
        at += n
    return levels


def find(index: DataFrame, keys: DataFrame, buckets: int) -> DataFrame:
    """Shard number, place and length of keys (doc_id, copy). A key that is not in
    the index gives no row, but for one in 2^32 whose fingerprint agrees by chance."""

    def search(_, rows: pd.DataFrame, entry: pd.DataFrame) -> pd.DataFrame:
        if not len(entry) or not len(rows):
            return pd.DataFrame(columns=["doc_id", "copy", "number", "at", "n_tokens"])
        e = entry.iloc[0]
        hashes = key_hashes(rows["doc_id"], rows["copy"])
        number = look_up(_levels(e["sizes"], e["bits"]), hashes)
        prints = np.frombuffer(e["prints"], "<u4")
        ok = (number >= 0) & (prints[number] == (mix(hashes) >> np.uint64(32)).astype("<u4"))
        number = number[ok]
        out = rows.loc[ok, ["doc_id", "copy"]].astype({"doc_id": "Int64"})
        for name, field, kind in (
            ("number", "shards", "<u4"), ("at", "places", "<u8"), ("n_tokens", "lengths", "<u8")
        ):
            out[name] = np.frombuffer(e[field], kind)[number].astype(np.int64)
        return out

    left = _bucketed(keys.select("doc_id", "copy"), buckets).groupBy("bucket")
    return left.cogroup(index.groupBy("bucket")).applyInPandas(
        search, "doc_id long, copy long, number long, at long, n_tokens long"
    )


def fetch(found: DataFrame, shards: DataFrame, folder: str) -> DataFrame:
    """Checksum of the ids at each place, read from the shards."""

    def read(frames):
        for frame in frames:
            sums = []
            for shard, rows in frame.groupby("shard", sort=False):
                width = int(shard.rsplit(".u", 1)[1]) // 8
                with reading(folder, shard) as source:
                    for row in rows.itertuples():
                        source.seek(row.at * width)
                        data = source.read(row.n_tokens * width)
                        ids = np.frombuffer(data, f"<u{width}")
                        if len(ids) != row.n_tokens:
                            raise ValueError(f"{shard} is too short")
                        sums.append((row.Index, zlib.crc32(ids.astype("<u4").tobytes())))
            crc = pd.Series(dict(sums), dtype="int64").reindex(frame.index)
            out = frame.drop(columns=["shard"]).assign(ids_crc32=crc)
            out["doc_id"] = out["doc_id"].astype("Int64")
            yield out

    placed = (
        found.join(shards, "number")
        .select("doc_id", "copy", (F.col("before") + F.col("at")).alias("start"), "n_tokens",
                "shard", "at")
        .repartition("shard")
        .sortWithinPartitions("shard", "at")
    )
    return placed.mapInPandas(
        read, "doc_id long, copy long, start long, n_tokens long, at long, ids_crc32 long"
    ).drop("at")


def token_output(docs: DataFrame, tokenizer: str, end_id: int = 2) -> DataFrame:
    """Ids of every document written to shards, indexed, looked up and read back.

    One row per input row: doc_id, copy, start (ids of all documents before it), n_tokens
    with the end id, ids_crc32. Equal doc_ids are told apart by ``copy``, in the
    order of their texts; a missing doc_id sorts first; a missing text is empty and
    keeps its end id. An empty table gives no rows; further columns are ignored.
    """
    folder = run_folder(docs.sparkSession, "shards")
    entries = stored(write_shards(docs, folder, tokenizer, end_id), "entries")
    shards = stored(number_shards(entries), "manifest")
    count = entries.count()
    buckets = max(1, -(-count // _KEYS))
    index = stored(build_index(entries.join(shards, "shard"), buckets), "index")
    return fetch(find(index, entries, buckets), shards, folder)
