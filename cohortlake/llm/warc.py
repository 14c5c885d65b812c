"""WARC archives of pages, and their revisit resolution."""

import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlake.llm.common import stored
from cohortlake.llm.files import reading, writing
from cohortlake.session import run_folder

# Bytes of records, before compression, after which a task starts a new archive.
_ARCHIVE = 256 << 20
_LEVEL = 4
_DATE = "1970-01-01T00:00:00Z"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_HEADERS = (
    "archive string, at long, page_id long, url string, payload_bytes long,"
    " payload_digest string"
)


def _clean(value) -> str:
    return "" if value is None or pd.isna(value) else str(value).replace("\r", " ").replace("\n", " ")


def _number(value) -> str:
    return "" if value is None or pd.isna(value) else str(int(value))


def record_id(archive: str, at: int) -> str:
    """The id of the record that was first written at a place of an archive: no two share one."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{archive}/{at}')}>"


def record(
    kind: str, page_id, url, digest: str, size: int, payload: bytes, name: str, original=None
) -> bytes:
    """One record, compressed on its own. A revisit keeps the HTTP header, without payload.

    ``name`` is its id; ``original`` the page_id, url and id of what a revisit repeats.
    """
    http = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {size}\r\n\r\n"
    ).encode()
    block = http + payload
    lines = [
        "WARC/1.1",
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: {name}",
        f"WARC-Date: {_DATE}",
        f"WARC-Target-URI: {_clean(url)}",
        f"WARC-Payload-Digest: sha256:{digest}",
        f"X-Page-ID: {_number(page_id)}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if kind == "revisit":
        first_id, first_url, first_name = original
        lines += [
            f"WARC-Profile: {_PROFILE}",
            f"WARC-Refers-To: {first_name}",
            f"WARC-Refers-To-Target-URI: {_clean(first_url)}",
            f"WARC-Refers-To-Date: {_DATE}",
            f"X-Refers-To-Page-ID: {_number(first_id)}",
        ]
    raw = "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"
    packer = zlib.compressobj(_LEVEL, zlib.DEFLATED, 31)
    return packer.compress(raw) + packer.flush()


def records(source) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """Place, headers and payload of each record of an archive, one at a time."""
    at, rest, end = 0, b"", False
    while True:
        unpacker, raw, begun = zlib.decompressobj(31), [], at
        while not unpacker.eof:
            if not rest:
                rest = source.read(1 << 20)
                if not rest:
                    end = True
                    break
            raw.append(unpacker.decompress(rest))
            used = len(rest) - len(unpacker.unused_data)
            at, rest = at + used, unpacker.unused_data
        if end:
            if raw:
                raise ValueError("an archive ends inside a record")
            return
        head, _, body = b"".join(raw).partition(b"\r\n\r\n")
        headers = dict(
            line.split(": ", 1) if ": " in line else (line.rstrip(":"), "")
            for line in head.decode().split("\r\n")[1:]
        )
        block = body[: int(headers["Content-Length"])]
        http, _, payload = block.partition(b"\r\n\r\n")
        headers["payload length"] = http.decode().rsplit("Content-Length: ", 1)[1].split("\r\n")[0]
        yield begun, headers, payload


def _id(text: str) -> int | None:
    return int(text) if text else None


def write_archives(pages: DataFrame, folder: str) -> DataFrame:
    """A response record per page in archives below the folder; returns their headers.

    Columns: archive, at (place of the record), page_id, url, payload_bytes,
    payload_digest. A missing html is an empty payload.
    """

    def write(frames):
        frame = next(frames, None)
        while frame is not None:
            rows, at, size = [], 0, 0
            with writing(folder, ".warc.gz") as (name, out):
                while frame is not None and size < _ARCHIVE:
                    for page_id, url, html in zip(frame["page_id"], frame["url"], frame["html"]):
                        payload = html.encode() if isinstance(html, str) else b""
                        digest = hashlib.sha256(payload).hexdigest()
                        own = record_id(name, at)
                        data = record("response", page_id, url, digest, len(payload), payload, own)
                        out.write(data)
                        rows.append(
                            (name, at, _id(_number(page_id)), url, len(payload), digest)
                        )
                        at, size = at + len(data), size + len(payload)
                    frame = next(frames, None)
            yield _frame(rows, _HEADERS)

    source = pages.selectExpr(
        "cast(cast(page_id as long) as string) page_id",
        "cast(url as string) url",
        "cast(html as string) html",
    )
    return source.mapInPandas(write, _HEADERS)


def _frame(rows: list[tuple], schema: str) -> pd.DataFrame:
    fields = [part.split() for part in schema.split(", ")]
    frame = pd.DataFrame(rows, columns=[name for name, _ in fields], dtype=object)
    whole = {name: "Int64" for name, kind in fields if kind in ("long", "int")}
    return frame.astype(whole)


def resolve(headers: DataFrame, least: int) -> DataFrame:
    """Headers with ``kind`` and ``refers_to``.

    Of equal payloads of at least ``least`` bytes the first by page_id (missing
    last, then by place) stays a response. Headers are grouped by digest with
    partial sums first; payloads that occur once need no join, and a payload on
    very many pages is one row on the other side of a join Spark can split.
    """
    place = F.struct(F.col("page_id").isNull(), "page_id", "archive", "at", "url")
    first = (
        headers.filter(F.col("payload_bytes") >= least)
        .groupBy("payload_digest")
        .agg(F.min(place).alias("first"), F.count("*").alias("copies"))
        .filter("copies > 1")
        .drop("copies")
    )
    joined = headers.join(first, "payload_digest", "left")
    revisit = F.col("first").isNotNull() & (
        (F.col("payload_bytes") >= least)
        & ((F.col("first.archive") != F.col("archive")) | (F.col("first.at") != F.col("at")))
    )
    return joined.select(
        "archive", "at", "page_id", "payload_digest",
        F.when(revisit, F.lit("revisit")).otherwise(F.lit("response")).alias("kind"),
        F.when(revisit, F.col("first.page_id")).cast("string").alias("refers_to"),
        F.when(revisit, F.col("first.url")).alias("first_url"),
        F.when(revisit, F.col("first.archive")).alias("first_archive"),
        F.when(revisit, F.col("first.at")).cast("string").alias("first_at"),
    )



def rewrite(decided: DataFrame, source_folder: str, folder: str, archives: int) -> DataFrame:
    """New archives with fresh headers, one for each old one; returns their names.

    The records' places arrive sorted within one archive; an archive is read and
    written as a stream, so a task holds one record. There are as many tasks as
    archives: by the size of names and headers alone all would go to one.
    """

    def write(frames):
        name, out, old, stream, done = None, None, None, None, []

        def close():
            if out is not None:
                out.__exit__(None, None, None)
                stream.__exit__(None, None, None)

        for frame in frames:
            for row in frame.itertuples(index=False):
                if row.archive != name:
                    close()
                    name = row.archive
                    out, stream = writing(folder, ".warc.gz"), reading(source_folder, name)
                    new_name, target = out.__enter__()
                    done.append(new_name)
                    old = records(stream.__enter__())
                at, headers, payload = next(old)
                if at != row.at:
                    raise ValueError(f"{name}: a record at {at} has no header row")
                digest = headers["WARC-Payload-Digest"].removeprefix("sha256:")
                again, original = row.kind == "revisit", None
                if again:
                    first = record_id(row.first_archive, int(row.first_at))
                    original = row.refers_to, row.first_url, first
                target.write(
                    record(
                        row.kind, _id(headers["X-Page-ID"]), headers["WARC-Target-URI"], digest,
                        len(payload), b"" if again else payload, record_id(name, at), original,
                    )
                )
        close()
        if done:
            yield pd.DataFrame({"archive": done})

    sorted_ = decided.repartition(max(1, archives), "archive").sortWithinPartitions("archive", "at")
    return sorted_.mapInPandas(write, "archive string")


_RECORDS = (
    "page_id long, url string, payload_bytes long, payload_digest string,"
    " record_type string, refers_to long, payload string"
)


def read_archives(names: DataFrame, folder: str, payloads: bool = False) -> DataFrame:
    """Rows of the records in the named archives. The payload of a response is checked
    against its digest; it is returned only on request."""

    def read(frames):
        for frame in frames:
            for name in frame["archive"]:
                rows = []
                with reading(folder, name) as source:
                    for _, headers, payload in records(source):
                        digest = headers["WARC-Payload-Digest"].removeprefix("sha256:")
                        kind = headers["WARC-Type"]
                        if kind == "response" and hashlib.sha256(payload).hexdigest() != digest:
                            raise ValueError(f"{name}: a payload differs from its digest")
                        rows.append((
                            _id(headers["X-Page-ID"]), headers["WARC-Target-URI"],
                            int(headers["payload length"]), digest, kind,
                            _id(headers.get("X-Refers-To-Page-ID", "")),
                            payload.decode() if payloads and kind == "response" else None,
                        ))
                        if len(rows) == 2000:
                            yield _frame(rows, _RECORDS)
                            rows = []
                if rows:
                    yield _frame(rows, _RECORDS)

    # A task for each archive; by their own size all names would go to one.
    return names.repartition(max(1, names.count())).mapInPandas(read, _RECORDS)


def deduplicate(pages: DataFrame, least: int = 100) -> tuple[DataFrame, str]:
    """Archives of all pages with repeated payloads as revisits.

    Returns the names of the archives (column archive) and their folder. Rows may
    repeat: the second of two equal rows revisits the first. A missing page_id sorts
    last, a missing html is an empty payload, an empty table gives no archive;
    further columns are ignored.
    """
    spark = pages.sparkSession
    first, second = run_folder(spark, "archives"), run_folder(spark, "deduplicated")
    headers = stored(write_archives(pages, first), "headers")
    archives = headers.agg(F.countDistinct("archive")).first()[0]
    names = stored(rewrite(resolve(headers, least), first, second, archives), "archives")
    return names, second
