"""Lines that many documents share leave all but one of them."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlake.llm.common import stored, whole_text

# The white space stripped from a line, and the letters lowered.
GAPS = " \t\n\x0b\f\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
RESULT = ["n_lines", "n_dropped", "kept_text"]


def line_key(line: Column) -> Column:
    """A line as it is compared: stripped of white space, A-Z lowered."""
    return F.translate(F.btrim(line, F.lit(GAPS)), UPPER, UPPER.lower())


def lines_of(docs: DataFrame, least_chars: int) -> DataFrame:
    """(doc_id, text_hash, pos, k1, k2): lines whose key has ``least_chars`` code points.

    A key is known by 128 bits. Rows that share a doc_id are told apart by their text.
    """
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text")
    ).select(
        "doc_id",
        F.xxhash64("text").alias("text_hash"),
        F.posexplode(F.split("text", "\n", -1)).alias("pos", "line"),
    )
    keyed = rows.select("doc_id", "text_hash", "pos", line_key(F.col("line")).alias("key"))
    return keyed.filter(F.length("key") >= least_chars).select(
        "doc_id",
        "text_hash",
        "pos",
        F.xxhash64(F.lit(1), "key").alias("k1"),
        F.xxhash64(F.lit(2), "key").alias("k2"),
    )


def common_keys(lines: DataFrame, least_docs: int) -> DataFrame:
    """(k1, k2, last): keys of ``least_docs`` documents or more, and the largest doc_id.

    A document counts a key once, also where its lines or rows repeat. The distinct
    pairs are dealt by key and document, so a line that most documents hold is
    counted in every task and meets as one row of each.
    """
    pairs = lines.select("k1", "k2", "doc_id").distinct()
    counted = pairs.groupBy("k1", "k2").agg(F.count("*").alias("docs"), F.max("doc_id").alias("last"))
    return counted.filter(F.col("docs") >= least_docs).select("k1", "k2", "last")


def drop_common_lines(docs: DataFrame, least_docs: int = 3, least_chars: int = 20) -> DataFrame:
    """All rows and columns, with ``n_lines``, ``n_dropped`` and ``kept_text``.

    Lines whose key (see ``line_key``) has ``least_chars`` code points or more and stands
    in ``least_docs`` documents or more are dropped, except from the largest doc_id that
    holds the key; shorter ones, empty ones among them, always stay. Kept lines keep
    their order and their own spelling.

    A document is a doc_id: rows that repeat one count as one document and are all
    cleaned or all spared; rows without doc_id are one document, smaller than all
    others. A missing text is an empty one, which is one empty line. An empty table
    gives no rows. Columns of the input named like a result are replaced.

    Only hashes and places of lines are shuffled to count and to look up keys. Texts
    move once, to meet the places of their own dropped lines: by a merge join at every
    size, as these places grow with the documents.
    """
    lines = stored(lines_of(docs, least_chars), "lines")
    keys = stored(common_keys(lines, least_docs), "common")
    hits = lines.join(keys, ["k1", "k2"]).filter(~F.col("doc_id").eqNullSafe(F.col("last")))
    drops = stored(
        hits.groupBy(F.col("doc_id").alias("__d_id"), F.col("text_hash").alias("__d_hash")).agg(
            F.collect_set("pos").alias("__drops")
        ),
        "drops",
    )
    own = [c for c in docs.columns if c not in RESULT]
    texts = docs.select(
        *own, F.col("doc_id").cast("long").alias("__id"), F.xxhash64(whole_text()).alias("__hash")
    )
    same = F.col("__id").eqNullSafe(F.col("__d_id")) & (F.col("__hash") == F.col("__d_hash"))
    met = texts.join(drops.hint("merge"), same, "left")
    return _without_drops(met).select(*own, *RESULT)


def _without_drops(met: DataFrame) -> DataFrame:
    """Puts each text together again from the places not dropped, in linear time."""
    text, drops = whole_text(), F.col("__drops")
    places = F.sequence(F.lit(0), F.size("__lines") - 1)
    kept = F.transform(F.array_except(places, drops), lambda at: F.get(F.col("__lines"), at))
    return met.withColumn("__lines", F.split(text, "\n", -1)).withColumns(
        {
            "n_lines": F.size("__lines").cast("long"),
            "n_dropped": F.when(drops.isNull(), 0).otherwise(F.size(drops)).cast("long"),
            "kept_text": F.when(drops.isNull(), text).otherwise(F.array_join(kept, "\n")),
        }
    )
