"""Mixing sources to target weights by entropy balancing."""

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortlake.llm.common import WORD, stored

# Documents rounded together; the shares of their fractions carry over from one to the next.
_BUCKET = 4096
_STEPS = 40
_EXACT = "decimal(38,9)"


def target_tokens(
    sizes: DataFrame, weights: list[int], share: float, cap: float
) -> DataFrame:
    """Targets of all sources that fill a share of all tokens in proportion to weights.

    ``sizes`` has (source, source_size), one row per source. Sources by code
    point, missing last, take the weights in turn. No target exceeds ``cap`` times
    its source; what is above goes to the others by weight. A source without
    tokens has target 0. The window sees one row per source.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    full = Window.orderBy("ratio", F.col("source").asc_nulls_last())
    every = Window.partitionBy()
    weight = F.element_at(
        F.array(*[F.lit(float(w)) for w in weights]),
        (F.pmod(F.row_number().over(order) - 1, F.lit(len(weights))) + 1).cast("int"),
    )
    most = F.lit(cap) * F.col("source_size")
    ranked = (
        sizes.withColumn("weight", weight)
        .withColumn("ratio", most / F.col("weight"))
        .withColumn("wanted", F.lit(share) * F.sum("source_size").over(every))
        .withColumn("below", F.sum(most).over(full))
        .withColumn("above", F.sum("weight").over(every) - F.sum("weight").over(full))
        .withColumn(
            "is_full", F.col("below") + F.col("ratio") * F.col("above") <= F.col("wanted")
        )
    )
    free = F.when(~F.col("is_full"), F.col("weight"))
    taken = F.coalesce(F.sum(F.when(F.col("is_full"), most)).over(every), F.lit(0.0))
    level = (F.col("wanted") - taken) / F.sum(free).over(every)
    target = F.when(F.col("is_full"), most).otherwise(
        F.least(most, F.col("weight") * level)
    )
    return ranked.select("source", "source_size", target.alias("target"), "is_full")


def balance(histogram: DataFrame, targets: DataFrame, cap: float) -> DataFrame:
    """Tilt of each source: the multiplier of its token constraint.

    Rates ``min(cap, exp(tilt * size / mean size))`` stay closest to 1 in relative
    entropy among all rates whose tokens meet the target. Each Newton step is one
    aggregation over the counts of (source, size); brackets keep a step inside.
    Sums are decimal, so they do not depend on the order of the rows.
    """
    mean = F.col("source_size") / F.col("docs")
    counts = histogram.groupBy("source").agg(F.sum("n").alias("docs"))
    state = targets.join(counts, targets["source"].eqNullSafe(counts["source"])).select(
        targets["source"], "source_size", "docs", "target", "is_full", mean.alias("mean"),
        F.lit(0.0).alias("tilt"), F.lit(-700.0).alias("low"), F.lit(700.0).alias("high"),
        (F.col("is_full") | (F.col("source_size") == 0)).alias("done"),
    )
    state = stored(state, "tilt")
    for _ in range(_STEPS):
        x = F.col("size") / F.col("mean")
        rate = F.least(F.lit(cap), F.exp(F.least(F.lit(50.0), F.col("tilt") * x)))
        tokens = F.col("n") * F.col("size") * rate
        slope = F.when(rate < cap, tokens * x).otherwise(0.0)
        open_ = state.filter(~F.col("done")).withColumnRenamed("source", "key")
        sums = (
            histogram.join(open_, histogram["source"].eqNullSafe(F.col("key")))
            .groupBy("source")
            .agg(
                F.sum(tokens.cast(_EXACT)).cast("double").alias("tokens"),
                F.sum(slope.cast(_EXACT)).cast("double").alias("slope"),
            )
            .withColumnRenamed("source", "key")
        )
        joined = state.join(sums, state["source"].eqNullSafe(sums["key"]), "left")
        gap = F.col("target") - F.col("tokens")
        low = F.when(gap > 0, F.col("tilt")).otherwise(F.col("low"))
        high = F.when(gap > 0, F.col("high")).otherwise(F.col("tilt"))
        newton = F.col("tilt") + gap / F.col("slope")
        middle = (F.greatest(low, F.lit(-64.0)) + F.least(high, F.lit(64.0))) / 2
        inside = (F.col("slope") > 0) & (newton > low) & (newton < high)
        met = F.abs(gap) <= F.col("target") * 1e-7
        step = F.round(F.when(inside, newton).otherwise(middle), 12)
        was = F.col("done") | F.col("tokens").isNull()
        state = stored(
            joined.select(
                state["source"], "source_size", "docs", "target", "is_full", "mean",
                F.when(was | met, F.col("tilt")).otherwise(step).alias("tilt"),
                F.when(was, F.col("low")).otherwise(low).alias("low"),
                F.when(was, F.col("high")).otherwise(high).alias("high"),
                (was | met).alias("done"),
            ),
            "tilt",
        )
        if state.filter(~F.col("done")).isEmpty():
            break
    return state


def _copies(frame: pd.DataFrame) -> pd.DataFrame:
    """Whole copies of one bucket: largest first, what a document leaves goes to the next."""
    frame = frame.sort_values(
        ["size", "mark", "doc_id"], ascending=[False, True, True], kind="stable"
    )
    size, rate = frame["size"].to_numpy(np.float64), frame["rate"].to_numpy(np.float64)
    copies, owed = np.floor(rate + 1e-9), 0.0
    rest = np.maximum(rate - copies, 0.0) * size
    for i, s in enumerate(size):
        owed += rest[i]
        if rest[i] > 0 and owed >= s / 2:
            copies[i] += 1
            owed -= s
    frame = frame.assign(copies=copies.astype(np.int64), taken=copies.astype(np.int64) * size.astype(np.int64))
    return frame.drop(columns=["mark", "bucket"])


def mix_sources(
    docs: DataFrame, weights: list[int], share: float = 1.5, cap: float = 2.0
) -> DataFrame:
    """Copies of each document in a mix that meets token targets per source.

    Returns doc_id, source, size (words of the whole text, 0 if missing),
    source_size, target, rate, copies (0 up to ``cap``) and taken, one row per
    input row. Rates come from ``balance``; within buckets of some thousand
    documents of a source fractions are carried over, so the tokens of a source
    come within about one small document per bucket of its target. Equal runs
    agree. Missing sources are one source; rows may repeat; an empty table gives
    no rows; documents without words are taken once at rate 1 and weigh nothing.
    """
    size = F.regexp_count(F.coalesce(F.col("text"), F.lit("")), F.lit(WORD)).cast("long")
    sizes = stored(docs.select(F.col("doc_id").cast("long"), F.col("source").cast("string"), size.alias("size")), "sizes")
    histogram = stored(sizes.groupBy("source", "size").agg(F.count("*").alias("n")), "histogram")
    totals = histogram.groupBy("source").agg(
        F.sum(F.col("n") * F.col("size")).cast("long").alias("source_size")
    )
    targets = stored(target_tokens(totals, weights, share, cap), "targets")
    tilts = balance(histogram, targets, cap)
    plan = tilts.select(
        F.col("source").alias("key"), "source_size", "docs", "target", "is_full", "mean", "tilt"
    )
    rate = F.when(F.col("is_full"), F.lit(cap)).otherwise(
        F.least(F.lit(cap), F.exp(F.least(
            F.lit(50.0), F.coalesce(F.col("tilt") * F.col("size") / F.col("mean"), F.lit(0.0))
        )))
    )
    rate = F.when(F.col("size") > 0, rate).otherwise(F.lit(1.0))
    mark = F.xxhash64(F.lit(8), "doc_id", "size")
    bucket = F.pmod(mark, F.greatest(F.lit(1), F.ceil(F.col("docs") / _BUCKET)))
    rated = sizes.join(plan, sizes["source"].eqNullSafe(F.col("key"))).select(
        "doc_id", "source", "size", "source_size", "target",
        rate.alias("rate"), mark.alias("mark"), bucket.alias("bucket"),
    )
    return rated.groupBy("source", "bucket").applyInPandas(
        lambda frame: _copies(frame),
        "doc_id long, source string, size long, source_size long, target double,"
        " rate double, copies long, taken long",
    )
