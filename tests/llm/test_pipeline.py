"""The pipeline's stages, each on what its predecessor kept, against brute force."""

import re
from collections import Counter

import pytest

import corpus_pipeline
from cohortlake.llm import quality_rules
from cohortlake.llm.common import read, stored
from cohortlake.session import exists
from tests.conftest import SOURCE

pytestmark = pytest.mark.skipif(SOURCE is None, reason="no tables")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text, n=5):
    w = [re.sub("[A-Z]+", lambda m: m[0].lower(), x) for x in WORD.findall(text)]
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} or ({tuple(w)} if w else set())


def test_stages(spark):
    docs = read(spark, SOURCE, "documents")
    columns, kept = docs.columns, [docs.collect()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stored(stage(spark, docs, SOURCE), name)
        assert docs.columns == columns
        kept.append(docs.collect())
    before, good, single, clean, mixed = kept
    assert {r.doc_id for r in good} == {
        r.doc_id for r in before if quality_rules.passes(quality_rules.coverage(r.text))[1]
    }
    sets = {r.doc_id: shingles(r.text) for r in good}
    group = {i: i for i in sets}
    for i in sets:
        for j in sets:
            if i < j and 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j]):
                low, high = sorted((group[i], group[j]))
                group = {k: low if g == high else g for k, g in group.items()}
    assert sorted(r.doc_id for r in single) == sorted(set(group.values()))
    items = [" ".join(WORD.findall(r.text)).lower() for r in read(spark, SOURCE, "benchmark").collect()]
    text = {r.doc_id: " ".join(WORD.findall(r.text)).lower() for r in single}
    assert {r.doc_id for r in clean} <= {i for i, t in text.items() if not any(x in t for x in items)}
    assert len(clean) >= 0.9 * len(single)
    copies = Counter(r.doc_id for r in mixed)
    assert max(copies.values()) <= 2 and set(copies) <= {r.doc_id for r in clean}
    words = {r.doc_id: len(WORD.findall(r.text)) for r in clean}
    total = sum(words[i] * n for i, n in copies.items())
    assert total == pytest.approx(1.5 * sum(words.values()), rel=0.05)
    last = corpus_pipeline.STAGES[-1][1](spark, docs, SOURCE).collect()
    assert Counter(r.doc_id for r in last) == copies
    ends = sorted((r.start, r.start + r.n_tokens) for r in last)
    assert ends[0][0] == 0 and all(a[1] == b[0] for a, b in zip(ends, ends[1:]))


def test_steps_of_a_stage_go_when_the_next_begins(spark):
    docs = read(spark, SOURCE, "documents").limit(120)
    docs = stored(docs, "few")
    application = spark.sparkContext.applicationId
    _, single = corpus_pipeline.STAGES[1]
    _, clean = corpus_pipeline.STAGES[2]
    lazy = single(spark, docs, SOURCE)
    steps = list(corpus_pipeline._steps[application])
    assert steps and all(exists(spark, s) for s in steps)
    # Documents that still read the steps keep those that they read.
    expected = lazy.count()
    clean(spark, lazy, SOURCE)
    assert lazy.count() == expected and any(exists(spark, s) for s in steps)
    written = stored(single(spark, docs, SOURCE), "single")
    steps = list(corpus_pipeline._steps[application])
    clean(spark, written, SOURCE)
    assert steps and not any(exists(spark, s) for s in steps)
    assert written.count() == expected
