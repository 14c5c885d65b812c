"""From documents to training shards: five stages over whole tables.

Each stage takes the documents its predecessor kept and returns documents with all
their columns, but for the last, which returns a row per document written. Rows are
told apart by their doc_id and text together; equal rows are one document from the
second stage on, so missing and repeated ids are no special case.
"""

import functools
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlake.llm import decontamination, jaccard_join, mixing, quality_rules, tokens
from cohortlake.llm.common import noting_steps, prepare, read, stored
from cohortlake.llm.queries import SOURCE_WEIGHTS, tokenizer_path
from cohortlake.session import remove

_KEY = "__row_key"
# SQL cannot express the rolling hashes, the tilted rates or the tokenizer; tests
# compare the stages with brute force.
ORACLE_SQL = None


def _row_key() -> Column:
    return F.xxhash64(
        F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit(""))
    )


def _keyed(docs: DataFrame) -> DataFrame:
    """The documents under their row key in place of doc_id, for operators on them."""
    rest = ["text", "source"]
    return docs.select(_row_key().alias("doc_id"), *[F.col(c).cast("string") for c in rest])


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are long enough and repeat little."""
    prepare(spark)
    return quality_rules.passing(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of similar ones, that with the smallest doc_id."""
    prepare(spark)
    parts = jaccard_join.similar_components(_keyed(docs), n=5, low=80, high=100)
    ids = docs.select(_row_key().alias("key"), F.col("doc_id").cast("long").alias("id"))
    order = F.struct(F.col("id").isNull(), "id", "key")
    first = (
        parts.select(F.col("doc_id").alias("key"), "component_id")
        .distinct()
        .join(ids.distinct(), "key")
        .groupBy("component_id")
        .agg(F.min(order).alias("first"))
        .select(F.col("first.key").alias(_KEY))
    )
    kept = docs.withColumn(_KEY, _row_key()).join(stored(first, "first"), _KEY, "left_semi")
    return kept.dropDuplicates([_KEY]).select(*docs.columns)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that overlap with no benchmark item."""
    prepare(spark)
    found = decontamination.overlaps(_keyed(docs), read(spark, sf_dir, "benchmark"))
    leaked = found.filter("contaminated").select(F.col("doc_id").alias(_KEY)).distinct()
    kept = docs.withColumn(_KEY, _row_key()).join(stored(leaked, "leaked"), _KEY, "left_anti")
    return kept.select(*docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """As many copies of each document as the mix takes."""
    prepare(spark)
    mixed = mixing.mix_sources(_keyed(docs), SOURCE_WEIGHTS)
    copies = mixed.groupBy(F.col("doc_id").alias(_KEY)).agg(F.sum("copies").cast("int").alias("__n"))
    single = docs.withColumn(_KEY, _row_key()).dropDuplicates([_KEY])
    joined = single.join(stored(copies.filter("__n > 0"), "copies"), _KEY)
    repeated = joined.withColumn("__n", F.explode(F.expr("array_repeat(0, __n)")))
    return repeated.select(*docs.columns)


def token_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of all documents in shards; a row per document, read back from them."""
    prepare(spark)
    return tokens.token_output(docs, tokenizer_path())


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
# Folders of the steps that the last stage of an application has stored.
_steps: dict[str, list[str]] = {}


def _tidy(stage: Stage) -> Stage:
    """The stage; before it begins, the steps that the stage before has stored are removed.

    A stage's result is written before the next one begins, so they are of no more use;
    where the documents still read them, as in a plan not yet written, they stay.
    """

    @functools.wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        application = spark.sparkContext.applicationId
        read_now = docs.inputFiles()
        for folder in _steps.pop(application, []):
            if not any(folder in path for path in read_now):
                remove(spark, folder)
        with noting_steps() as steps:
            kept = stage(spark, docs, sf_dir)
        _steps[application] = steps
        return kept

    return run_stage


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", _tidy(quality)),
    ("jaccard_join", _tidy(near_duplicates)),
    ("decontamination", _tidy(decontaminate)),
    ("mixing", _tidy(mix)),
    ("token_output", _tidy(token_shards)),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; what each returns is stored and read again."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
