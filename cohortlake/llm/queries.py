"""Named queries of the operators over their whole tables."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlake.llm import (
    decontamination,
    html_template,
    jaccard_join,
    language_model,
    line_dedup,
    mixing,
    periodic_runs,
    personal_data,
    quality_rules,
    suffix_dedup,
    tokens,
    warc,
    whitening,
)
from cohortlake.llm.common import read

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}

SOURCE_WEIGHTS = [5, 2, 1]


def _query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def tokenizer_path() -> str:
    """Place of the vocabulary among the installed public tokenizers."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@_query
def op1_parity_sketch_join(spark, sf_dir):
    return jaccard_join.similar_components(read(spark, sf_dir, "documents"), n=3, low=90, high=100)


@_query
def op2_spaced_seeds(spark, sf_dir):
    benchmark = read(spark, sf_dir, "benchmark")
    return decontamination.overlaps(read(spark, sf_dir, "documents"), benchmark)


@_query
def op3_bootstrapped_contexts(spark, sf_dir):
    return personal_data.personal_data(read(spark, sf_dir, "documents"))


@_query
def op4_warc_revisits(spark, sf_dir):
    names, folder = warc.deduplicate(read(spark, sf_dir, "pages"), least=100)
    return warc.read_archives(names, folder).drop("payload")


ORACLE_SQL["op4_warc_revisits"] = """
WITH payloads AS (
    SELECT page_id, coalesce(url, '') AS url, strlen(coalesce(html, '')) AS payload_bytes,
           sha256(coalesce(html, '')) AS payload_digest
    FROM pages
), originals AS (
    SELECT payload_digest, min(page_id) AS original
    FROM payloads WHERE payload_bytes >= 100 GROUP BY payload_digest
)
SELECT p.page_id, p.url, CAST(p.payload_bytes AS BIGINT) AS payload_bytes, p.payload_digest,
       CASE WHEN o.original <> p.page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN o.original <> p.page_id THEN o.original END AS refers_to
FROM payloads p LEFT JOIN originals o
  ON o.payload_digest = p.payload_digest AND p.payload_bytes >= 100
"""


@_query
def op5_html_templates(spark, sf_dir):
    return html_template.main_text(read(spark, sf_dir, "pages"))


@_query
def op6_repetition_rules(spark, sf_dir):
    return quality_rules.repetition(read(spark, sf_dir, "documents"))


def _covered(n: int) -> str:
    """Words of each document, marked where they lie inside a run of n words that repeats."""
    gram = " || ' ' || ".join(["word", *(f"lead(word, {k}) OVER w" for k in range(1, n))])
    return f"""
  SELECT doc_id, pos, word, max(again) OVER (
           PARTITION BY doc_id ORDER BY pos ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW) AS inside
  FROM (SELECT doc_id, pos, word,
               CASE WHEN gram IS NOT NULL AND count(*) OVER (PARTITION BY doc_id, gram) > 1
                    THEN 1 ELSE 0 END AS again
        FROM (SELECT doc_id, pos, word, {gram} AS gram FROM words
              WINDOW w AS (PARTITION BY doc_id ORDER BY pos)))"""


_LENGTHS = quality_rules.GRAM_LIMITS
ORACLE_SQL["op6_repetition_rules"] = f"""
WITH texts AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
words AS (
    SELECT doc_id, unnest(found) AS word, unnest(range(len(found))) AS pos
    FROM (SELECT doc_id, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') AS found FROM texts)
),
lines AS (
    SELECT doc_id, line, row_number() OVER (PARTITION BY doc_id, line ORDER BY pos) AS nth
    FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
                 unnest(range(len(string_split(text, chr(10))))) AS pos FROM texts)
    WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]')
),
{", ".join(f"g{n} AS ({_covered(n)})" for n in (3, *_LENGTHS))},
sums AS (
    SELECT t.doc_id,
           length(regexp_replace(t.text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
           coalesce(w.n_words, 0) AS n_words, coalesce(w.word_chars, 0) AS word_chars,
           coalesce(l.n_lines, 0) AS n_lines, coalesce(l.line_chars, 0) AS line_chars,
           coalesce(l.n_dup_lines, 0) AS n_dup_lines,
           coalesce(l.dup_line_chars, 0) AS dup_line_chars, coalesce(r.n, 0) AS n_repeat_words,
           {", ".join(f"coalesce(c{n}.n, 0) AS chars_{n}" for n in _LENGTHS)}
    FROM texts t
    LEFT JOIN (SELECT doc_id, count(*) AS n_words, sum(length(word)) AS word_chars
               FROM words GROUP BY doc_id) w ON w.doc_id = t.doc_id
    LEFT JOIN (SELECT doc_id, count(*) AS n_lines, sum(length(line)) AS line_chars,
                      count(*) FILTER (WHERE nth > 1) AS n_dup_lines,
                      sum(length(line)) FILTER (WHERE nth > 1) AS dup_line_chars
               FROM lines GROUP BY doc_id) l ON l.doc_id = t.doc_id
    LEFT JOIN (SELECT doc_id, sum(inside) AS n FROM g3 GROUP BY doc_id) r ON r.doc_id = t.doc_id
    {" ".join(
        f"LEFT JOIN (SELECT doc_id, sum(length(word)) AS n FROM g{n} WHERE inside = 1 GROUP BY doc_id) c{n}"
        f" ON c{n}.doc_id = t.doc_id" for n in _LENGTHS
    )}
)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars,
       CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
       CAST(n_repeat_words AS BIGINT) AS n_repeat_words,
       n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words)
         AND n_dup_lines <= {quality_rules.LINE_LIMIT}::DOUBLE * n_lines
         AND dup_line_chars <= {quality_rules.LINE_CHARS_LIMIT}::DOUBLE * line_chars
         AND {" AND ".join(f"chars_{n} <= {x}::DOUBLE * word_chars" for n, x in _LENGTHS.items())} AS kept,
       CAST(dup_line_chars AS BIGINT) AS dup_line_chars,
       {", ".join(f"CAST(chars_{n} AS BIGINT) AS chars_{n}" for n in _LENGTHS)}
FROM sums
"""


@_query
def op7_pitman_yor_model(spark, sf_dir):
    return language_model.score_texts(read(spark, sf_dir, "documents"))


@_query
def op8_entropy_mixing(spark, sf_dir):
    mixed = mixing.mix_sources(read(spark, sf_dir, "documents"), SOURCE_WEIGHTS)
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "copies", "rate")


@_query
def op9_token_index(spark, sf_dir):
    return tokens.token_output(read(spark, sf_dir, "documents"), tokenizer_path()).select(
        "doc_id", "start", "n_tokens", "ids_crc32"
    )


@_query
def op10_suffix_sort(spark, sf_dir):
    return suffix_dedup.remove_repeats(read(spark, sf_dir, "documents"), length=400).drop("spans")


@_query
def op11_line_dedup(spark, sf_dir):
    cleaned = line_dedup.drop_common_lines(read(spark, sf_dir, "documents"))
    digest = F.sha2(F.encode("kept_text", "utf-8"), 256).alias("kept_sha256")
    return cleaned.select("doc_id", "n_lines", "n_dropped", digest)


# Lower-casing and stripping name their letters, as SQL's own take more of Unicode.
ORACLE_SQL["op11_line_dedup"] = """
WITH lines AS (
    SELECT doc_id, coalesce(text, '') AS text,
           unnest(string_split(coalesce(text, ''), chr(10))) AS line,
           unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS pos
    FROM documents
), keyed AS (
    SELECT *, translate(trim(line, concat(' ', chr(9), chr(10), chr(11), chr(12), chr(13))),
                        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
    FROM lines
), common AS (
    SELECT key, max(doc_id) AS last
    FROM keyed WHERE length(key) >= 20
    GROUP BY key HAVING count(DISTINCT doc_id) >= 3
), marked AS (
    SELECT k.*, c.key IS NOT NULL AND k.doc_id <> c.last AS dropped
    FROM keyed k LEFT JOIN common c ON k.key = c.key
)
SELECT doc_id, count(*) AS n_lines, CAST(count_if(dropped) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT dropped), ''))
           AS kept_sha256
FROM marked GROUP BY doc_id
"""


@_query
def op12_bit_sliced_whitening(spark, sf_dir):
    white = whitening.whiten(read(spark, sf_dir, "embeddings"), components=8)
    deviation = F.col("deviation").try_cast("long").alias("deviation")
    return white.select(
        "vec_id", "component", "n", deviation, "whitened", "explained", "identity_error"
    )


@_query
def op13_periodic_runs(spark, sf_dir):
    found = periodic_runs.collapse_runs(
        read(spark, sf_dir, "documents"), least=24, times=3, change=periodic_runs.planted
    )
    lines = F.transform(
        "runs", lambda r: F.concat(F.concat_ws(",", r.start, r.length, r.period), F.lit("\n"))
    )
    listed = F.array_join(lines, "")
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "strongest.start",
        "strongest.length",
        "strongest.period",
        F.expr("1000 * strongest.length div strongest.period").alias("exponent_milli"),
        F.sha2(F.encode(listed, "utf-8"), 256).alias("runs_sha256"),
        F.sha2(F.encode("collapsed_text", "utf-8"), 256).alias("collapsed_sha256"),
    )
