"""Personal data in texts: fixed patterns, and contexts learned from what they find.

DataFrame functions only; texts and graph stay in the JVM.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlake.llm.common import stored, whole_text

KINDS = ("email", "ip", "card", "phone")

# The patterns of each kind, in forms that need no backtracking over long runs: a
# match begins where its first run of characters does, or where the last match ended.
_LOCAL = r"[A-Za-z0-9._%+-]"
_EMAIL = rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
_IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
# A whole run of digits with single separators; only runs of 16 to 19 digits count.
_CARD = r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){15,18}+(?![\x20-]?[0-9])"
_PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
_OCTET = r"0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"

# What may be an identifier: groups of digits parted by single spaces, with brackets and
# other signs between them, or else a word with a digit or @. Before it lies its context.
_GROUP = r"[+(\[]*+[0-9][0-9()\[\]/.+-]*+(?=[,;:!?]*+(?:[\x20\x09-\x0D]|$))"
_WORD = (
    rf"(?<![^\x20\x09-\x0D])(?:{_GROUP}(?:\x20{_GROUP})*+"
    r"|[^0-9@\x20\x09-\x0D]*+[0-9@][^\x20\x09-\x0D]*+)"
)
# Fewest characters of an identifier that the patterns do not know.
_SHORTEST = 6
_REACH = 80
_TWO_WORDS = r"([^\x20\x09-\x0D]++[\x20\x09]++[^\x20\x09-\x0D]++)[\x20\x09]++$"
_CONTEXT, _CONTEXT_CUT = r"(?:^|[\x20\x09-\x0D])" + _TWO_WORDS, r"[\x20\x09-\x0D]" + _TWO_WORDS

# Rounds at most; each brings in contexts by the finds of the last.
ROUNDS = 6
# Known values of a kind that a context must have, and their share among its other
# values from which it is heard; and the score from which a value is a find.
LEAST_KNOWN, HEARD, CONFIDENT = 3, 0.5, 0.9

_SPAN = "array<struct<begin:int,end:int,value:string>>"
# Matches of a text that are placed together.
_TOGETHER = 512


def _let(value: Column, body) -> Column:
    """A column of a value that is computed once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), 0)


def matches(text: Column, pattern: str) -> Column:
    """Leftmost non-overlapping matches with their places in code points.

    Places add up the gaps and lengths before, some matches at a time, so that no
    array grows by a match a step: a text of very many matches takes time in proportion.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.slice(F.split(text, pattern, -1), 1, F.size(found))
    pairs = F.zip_with(gaps, found, lambda gap, value: F.struct(F.length(gap).alias("gap"), value.alias("value")))
    none = F.array().cast(_SPAN)

    def step(state, pair):
        begin = state["at"] + pair["gap"]
        end = begin + F.length(pair["value"])
        span = F.struct(begin.alias("begin"), end.alias("end"), pair["value"].alias("value"))
        return F.struct(end.alias("at"), F.concat(state["spans"], F.array(span)).alias("spans"))

    def cut(pairs):
        numbers = F.sequence(F.lit(0), F.floor((F.size(pairs) - 1) / _TOGETHER).cast("int"))
        return F.transform(numbers, lambda k: F.slice(pairs, k * _TOGETHER + 1, F.lit(_TOGETHER)))

    def starts(parts):
        lengths = F.transform(
            parts,
            lambda part: F.aggregate(
                part, F.lit(0), lambda n, pair: n + pair["gap"] + F.length(pair["value"])
            ),
        )
        first = F.array(F.lit(0))
        return F.aggregate(
            lengths, first, lambda ends, n: F.concat(ends, F.array(F.element_at(ends, -1) + n))
        )

    def placed(parts, begins):
        def place(part, k):
            start = F.struct(F.get(begins, k).alias("at"), none.alias("spans"))
            return F.aggregate(part, start, step)["spans"]

        return F.flatten(F.transform(parts, place))

    spans = _let(_let(pairs, cut), lambda parts: _let(starts(parts), lambda begins: placed(parts, begins)))
    return F.when(F.size(found) > 0, spans).otherwise(none)


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _valid(kind: str, value: Column) -> Column:
    if kind == "ip":
        return value.rlike(rf"^{_OCTET}(?:\.{_OCTET}){{3}}$")
    if kind == "card":
        return F.call_function("luhn_check", _digits(value))
    if kind == "phone":
        return F.length(_digits(value)).between(8, 15)
    return F.lit(True)


def _checked(found: Column, kind: str) -> Column:
    return F.filter(found, lambda m: _valid(kind, m["value"]))


def _numbered(found: Column, number: int) -> Column:
    return F.transform(
        found,
        lambda m: F.struct(F.lit(number).alias("kind"), m["begin"].alias("begin"), m["end"].alias("end")),
    )


def _count(number: int) -> Column:
    return F.size(F.filter("base", lambda s: s["kind"] == number)).cast("long")


def base_spans(text: Column) -> Column:
    """Spans of all kinds, by kind and then place: struct of kind (its number), begin, end."""
    gates = {
        "email": F.contains(text, F.lit("@")),
        "ip": text.rlike(r"[0-9]\.[0-9]"),
        "card": text.rlike(r"[0-9][\x20-]?[0-9]"),
        "phone": text.rlike(r"\+[0-9]"),
    }
    patterns = {"email": _EMAIL, "ip": _IP, "card": _CARD, "phone": _PHONE}
    parts = []
    for number, kind in enumerate(KINDS):
        spans = _numbered(_checked(matches(text, patterns[kind]), kind), number)
        none = F.array().cast("array<struct<kind:int,begin:int,end:int>>")
        parts.append(F.when(gates[kind], spans).otherwise(none))
    return F.concat(*parts)


def _instances(found: DataFrame) -> DataFrame:
    """What may be identifiers: row, place, value, its context, and the kind of a base span.

    Base spans are whole instances; other words and groups of digits are instances
    where they overlap none.
    """
    words = F.when(
        F.col("text").rlike("[0-9@]"), matches(F.col("text"), _WORD)
    )
    begin = F.col("begin")
    # A bracket at the end belongs to the value if one was opened in it.
    signs = F.when(F.contains(F.col("w.value"), F.lit("(")), r"[.,;:!?\]]++$").otherwise(r"[.,;:!?)\]]++$")
    value = F.regexp_replace(F.col("w.value"), signs, F.lit(""))
    end = begin + F.length("value")
    free = ~F.exists("base", lambda s: (s["begin"] < end) & (begin < s["end"]))
    others = (
        found.select("row", "base", "text", F.explode(words).alias("w"))
        .select("row", "base", "text", F.col("w.begin").alias("begin"), value.alias("value"))
        .filter((F.length("value") >= _SHORTEST) & free)
        .select("row", "text", "begin", end.alias("end"), F.lit(None).cast("int").alias("kind"))
    )
    base = found.select("row", "text", F.explode("base").alias("s")).select(
        "row", "text", "s.begin", "s.end", "s.kind"
    )
    # Where the text before is cut, the cut may be inside a word, which then begins none.
    before = F.expr(f"substring(text, greatest(1, begin - {_REACH} + 1), least(begin, {_REACH}))")
    whole = F.regexp_extract(before, _CONTEXT, 1)
    context = F.when(begin <= _REACH, whole).otherwise(F.regexp_extract(before, _CONTEXT_CUT, 1))
    return base.unionByName(others).select(
        "row", "begin", "end",
        F.lower(F.expr("substring(text, begin + 1, end - begin)")).alias("value"),
        F.lower(F.regexp_replace(context, r"[\x20\x09]+", " ")).alias("context"),
        "kind",
    ).filter("context <> ''")


def _discovered(instances: DataFrame) -> DataFrame:
    """Instances that confident contexts give a kind: (row, kind, begin, end).

    Contexts and values form a graph. Known values are those the patterns found and the
    finds of the rounds before. In each round a context with enough known values of a
    kind gives that kind to its other values, with the share of such values among its
    values but the one in question: what is not known counts against it, and no value
    adds to the confidence it is scored by. A value's score follows from all its
    contexts; a find counts in the next round, so it can bring in contexts that the
    patterns alone do not reach. Both sides are grouped with partial sums over distinct
    edges; rounds end early when they find nothing.
    """
    edges = stored(
        instances.groupBy("context", "value").agg(F.max("kind").alias("seed")), "edges"
    )
    sizes = edges.groupBy("context").agg(F.count("*").alias("size"))
    edges = stored(edges.join(sizes.filter(F.col("size") > LEAST_KNOWN), "context"), "graph")
    seeds = edges.filter("seed IS NOT NULL").groupBy("value").agg(F.max("seed").alias("kind"))
    seeds = known = stored(seeds, "known")
    finds = None
    for _ in range(ROUNDS):
        useful = (
            edges.join(known, "value")
            .groupBy("context", "kind")
            .agg((F.count("*") / (F.first("size") - 1)).alias("confidence"), F.count("*").alias("n"))
            .filter((F.col("n") >= LEAST_KNOWN) & (F.col("confidence") >= HEARD))
            .select("context", "kind", "confidence")
        )
        doubt = F.log(F.greatest(F.lit(1e-9), 1 - F.col("confidence")))
        fresh = (
            edges.select("context", "value")
            .join(known, "value", "left_anti")
            .join(useful, "context")
            .groupBy("value", "kind")
            .agg((1 - F.exp(F.sum(doubt))).alias("score"))
            .groupBy("value")
            .agg(F.max(F.struct("score", "kind")).alias("best"))
            .filter(F.col("best.score") >= CONFIDENT)
            .select("value", F.col("best.kind").alias("kind"))
        )
        fresh = stored(fresh, "finds")
        if fresh.isEmpty():
            break
        finds = fresh if finds is None else finds.unionByName(fresh)
        known = seeds.unionByName(finds)
    if finds is None:
        return instances.limit(0).select("row", "kind", "begin", "end")
    return instances.filter("kind IS NULL").drop("kind").join(finds, "value").select(
        "row", "kind", "begin", "end"
    )


def _written(spans: Column) -> Column:
    kind = F.array(*map(F.lit, KINDS))
    return F.array_join(
        F.transform(
            spans, lambda s: F.concat_ws(":", F.get(kind, s["kind"]), s["begin"], s["end"])
        ),
        ",",
    )


def personal_data(docs: DataFrame) -> DataFrame:
    """Personal data per document, one row per input row.

    doc_id, n_email, n_ip, n_card, n_phone and base_sha256 describe what the fixed
    patterns find; spans holds these and what learned contexts add, as
    kind:begin:end by kind and place, in code points. Contexts are the two words
    before an identifier, if they take at most 80 characters with the spaces; what
    else may be one is a word with a digit or @, or groups of digits parted by spaces,
    of six characters or more. A missing or empty text has no spans; equal rows are
    handled alike; a missing doc_id stays missing; an empty table gives no rows.
    """
    found = docs.select(F.col("doc_id").cast("long"), whole_text().alias("text"))
    found = found.withColumn("row", F.monotonically_increasing_id())
    found = found.withColumn("base", base_spans(F.col("text")))
    kept = F.when(F.col("text").rlike("[0-9@]"), F.col("text")).alias("text")
    found = stored(found.select("row", "doc_id", "base", kept), "found")
    instances = stored(_instances(found.filter("text IS NOT NULL")), "instances")
    more = (
        _discovered(instances)
        .groupBy("row")
        .agg(F.collect_set(F.struct("kind", "begin", "end")).alias("more"))
    )
    spans = F.when(F.col("more").isNull(), F.col("base")).otherwise(
        F.array_sort(F.array_union("base", "more"))
    )
    counts = [_count(n).alias(f"n_{kind}") for n, kind in enumerate(KINDS)]
    return found.select("row", "doc_id", "base").join(more, "row", "left").select(
        "doc_id", *counts, F.sha2(_written(F.col("base")), 256).alias("base_sha256"),
        _written(spans).alias("spans"),
    )
