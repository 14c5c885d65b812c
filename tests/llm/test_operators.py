"""Operators against brute force, on rows with missing values, copies and clashing names."""

import hashlib
import itertools
import math
import random
import re
import time
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortlake.llm import (
    decontamination, html_template, jaccard_join, language_model, mixing, personal_data,
    quality_rules, suffix_dedup, tokens, warc,
)
from cohortlake.llm.common import HashFilter, word_hashes
from cohortlake.llm.components import connected
from cohortlake.llm.files import reading
from cohortlake.llm.queries import tokenizer_path

WORD = re.compile(r"[^\x20\x09-\x0D]+")
VOCABULARY = [a + b for a in "the of and to in is that for it as".split() for b in ("", "er", "s")]
SCHEMA = (
    "doc_id long, text string, source string, key long, row string, size int, id int, n int,"
    " words string, copies int"
)


def lowered(text):
    return [re.sub("[A-Z]+", lambda m: m[0].lower(), w) for w in WORD.findall(text or "")]


def rows():
    rng = random.Random(5)

    def prose(n):
        return " ".join(rng.choice(VOCABULARY) + str(rng.randint(0, 30)) for _ in range(n))

    base = prose(300)
    near = base.split()
    near[150] = "changed"
    texts = [base, base, " ".join(near), base.upper(), prose(80), prose(40) + "\n" + prose(30)]
    texts += [None, "", "   ", "one", "one two", "One  TWO", prose(3000) + " " + prose(40)]
    texts += [prose(60) + " " + base + " " + prose(30), "x" * 900, "ab " * 500, prose(100) + base[:700]]
    texts += ["Mail a.b+c@mail.example.org, or a@b.c+d@e.f. 1.2.3.4.5.6.7.8 300.1.1.1 00010.2.3.4"]
    texts += ["card 4111 1111-1111 1111, 4111111111111112; +1 (724) 555-7058. é@x é +12 3+45678901"]
    texts += [prose(20) + " 𝒳 ßtraße a@b.co " + prose(3) for _ in range(2)]
    out = [(i, t, f"s{i % 4}" if i % 5 else None) for i, t in enumerate(texts)]
    out += [(3, texts[4], "s1"), (3, texts[4], "s1"), (None, base, "s2"), (None, None, None)]
    return [(*r, 1, "row", 2, 3, 4, "words", 5) for r in out]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(rows(), SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def by_text(frame):
    return {(r.doc_id, r.text): r for r in frame.collect()}


def test_word_hashes_of_long_texts():
    long = " ".join(f"W{i}" for i in range(90_000))
    hashes, begins = word_hashes([long, None, "", "w5 W5 w6"])
    assert begins.tolist() == [0, 90_000, 90_000, 90_000, 90_003]
    assert len(set(hashes[:90_000].tolist())) == 90_000
    assert hashes[90_000] == hashes[90_001] == hashes[5] and hashes[90_002] == hashes[6]


def test_filter_holds_all_and_few_others(spark):
    values = [(int(x),) for x in np.random.default_rng(1).integers(-(2**62), 2**62, 5000)]
    keep = HashFilter.of(spark.createDataFrame(values, "h long"), "h", 5000)
    own = np.array(values).ravel().view(np.uint64)
    assert keep.holds(own).all() and keep.holds(own + np.uint64(1)).mean() < 0.01


def test_components(spark):
    rng = random.Random(2)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(400, i) for i in range(401, 450)]
    parent = list(range(500))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    found = connected(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r.node: r.component for r in found} == {
        x: find(x) for e in edges if e[0] != e[1] for x in e
    }


@pytest.mark.parametrize("n, low", [(3, 90), (5, 80)])
def test_similar_components(spark, docs, none, n, low):
    sets, data = {}, [(r[0], r[1]) for r in rows()]
    for i, (_, text) in enumerate(data):
        w = lowered(text)
        grams = {tuple(w[k : k + n]) for k in range(len(w) - n + 1)}
        sets[i] = grams or ({tuple(w)} if w else set())
    group = {i: i for i in sets}
    for i in sets:
        for j in sets:
            a, b = sets[i], sets[j]
            if i < j and a and 100 * len(a & b) >= low * len(a | b):
                old, new = group[j], group[i]
                group = {k: new if g == old else g for k, g in group.items()}
    names = {}
    for i, g in group.items():
        ids = [data[k][0] for k in group if group[k] == g and data[k][0] is not None]
        names[i] = min(ids, default=None)
    expected = Counter((data[i][0], len(sets[i]), names[i]) for i in sets)
    found = jaccard_join.similar_components(docs, n, low, 100)
    assert Counter(map(tuple, found.collect())) == expected
    assert jaccard_join.similar_components(none, n, low, 100).count() == 0


def test_overlaps(spark, none):
    rng = random.Random(3)
    item = [f"w{rng.randrange(500)}" for _ in range(30)]
    changed = [w if k % 7 else "other" for k, w in enumerate(item)]
    noise = [f"n{k}" for k in range(200)]
    texts = [" ".join(noise + item), " ".join(noise[:9] + changed + noise), " ".join(noise), None, "",
             " ".join(noise + item[:9]), " ".join(item[:9] + item[15:18]), "a b c D e f g", " ".join(item[2:18])]
    data = [(i, t, "s", 1, "r", 1, 1, 1, "w", 1) for i, t in enumerate(texts)] + [(None, " ".join(item), *[None] * 8)]
    benchmark = spark.createDataFrame(
        [(7, " ".join(item)), (8, None), (9, ""), (10, "a b c d e f"), (11, "n1 n2"), (None, "n1 n2 n3 n4 n5 n6")],
        "item_id long, text string",
    )
    found = decontamination.overlaps(spark.createDataFrame(data, SCHEMA), benchmark)
    assert {r.doc_id: r.item_ids for r in found.collect()} == {
        0: [7], 1: [7], 2: [], 3: [], 4: [], 5: [], 6: [], 7: [10], 8: [7], None: [7]
    }
    assert decontamination.overlaps(none, benchmark).count() == 0
    assert decontamination.overlaps(spark.createDataFrame(data, SCHEMA), benchmark.limit(0)).filter("contaminated").count() == 0


def test_seeds_hit_all_allowed_changes():
    for n in range(1, 26):
        offsets = [o for least, most, o in decontamination.SEEDS if least <= n <= (most or n)]
        places = [{k + o for o in seed} for seed in offsets for k in range(n - seed[-1])]
        for changed in itertools.combinations(range(n), n - math.ceil(n * 8 / 10)):
            assert any(place.isdisjoint(changed) for place in places), (n, changed)


def test_overlaps_of_short_items(spark):
    items = {n: [f"i{n}x{k}" for k in range(n)] for n in range(1, 16)}
    data, expected = [], {}
    for n, words in items.items():
        allowed = n - math.ceil(n * 8 / 10)
        for more in (0, 1) if n <= 13 else (0,):
            for changed in list(itertools.combinations(range(n), allowed + more))[:120]:
                text = " ".join("other" if k in changed else w for k, w in enumerate(words))
                whole = text if n < 3 else f"before it {text} and after"
                expected[len(data)] = [] if more else [n]
                data.append((len(data), whole))
    benchmark = spark.createDataFrame([(n, " ".join(w)) for n, w in items.items()], "item_id long, text string")
    found = decontamination.overlaps(spark.createDataFrame(data, "doc_id long, text string"), benchmark)
    assert {r.doc_id: r.item_ids for r in found.collect()} == expected


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c) * (1 + i % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


BASE = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(x) <= 255 for x in m.split("."))),
    ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 16 <= len(re.sub("[^0-9]", "", m)) <= 19 and luhn(re.sub("[^0-9]", "", m))),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 8 <= len(re.sub("[^0-9]", "", m)) <= 15),
]


def test_personal_data(spark, docs, none):
    expected = Counter()
    for doc_id, text, *_ in rows():
        spans = [f"{k}:{m.start()}:{m.end()}" for k, p, ok in BASE for m in re.finditer(p, text or "") if ok(m[0])]
        expected[doc_id, hashlib.sha256(",".join(spans).encode()).hexdigest()] += 1
    found = personal_data.personal_data(docs)
    assert Counter((r.doc_id, r.base_sha256) for r in found.collect()) == expected
    assert personal_data.personal_data(none).count() == 0


def test_contexts_find_unseen_identifiers(spark):
    seeds = [f"please write to user{i}@mail.example.com today" for i in range(30)]
    unseen = [(99, "please write to user99(at)mail.example.com today")]
    data = [(i, t) for i, t in enumerate(seeds)] + unseen
    found = personal_data.personal_data(spark.createDataFrame(data, "doc_id long, text string"))
    row = found.filter("doc_id = 99").first()
    assert row.n_email == 0 and row.spans == "email:16:42"


def test_spaced_phones_and_cards_are_seeds(spark):
    def card(k):
        digits = f"411111111111{k:03d}"
        return next(digits + c for c in "0123456789" if luhn(digits + c))

    def spaced(digits):
        return " ".join(digits[i : i + 4] for i in range(0, len(digits), 4))

    texts = [f"just call me: +1 ({700 + i}) 555-{3000 + i}. thanks" for i in range(30)]
    texts += [f"paid by card {spaced(card(i))} on time" for i in range(30)]
    unseen = {100: ("so call me: 030 123 4567, or", "phone:12:24"), 101: ("so call me: (743) 555-3824 now", "phone:12:26"),
              102: ("gone by card 4111 1111 1111 112 on", "card:13:31"), 103: ("room 030 123 4567 is", "")}
    data = [*enumerate(texts), *((i, t) for i, (t, _) in unseen.items())]
    found = personal_data.personal_data(spark.createDataFrame(data, "doc_id long, text string"))
    spans = {r.doc_id: r.spans for r in found.collect()}
    assert all(spans[i].startswith("phone:14:") for i in range(30))
    assert all(spans[i].startswith("card:13:32") for i in range(30, 60))
    assert {i: spans[i] for i in unseen} == {i: s for i, (_, s) in unseen.items()}


def found_spans(spark, texts):
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return {r.doc_id: r.spans for r in personal_data.personal_data(frame).collect()}


def test_values_do_not_vouch_for_themselves(spark):
    texts = [f"write to me{i}@mail.example.com" for i in range(6)]
    texts += [f"write to room{10044 + i}" for i in range(4)]
    spans = found_spans(spark, texts)
    assert all(spans[i] for i in range(6)) and not any(spans[i] for i in range(6, 10))


def test_finds_bring_in_further_contexts(spark):
    texts = [f"please call: +1 (555) 010-{1000 + i}" for i in range(40)]
    first = [f"0{30 + i} 555 {4000 + i}" for i in range(4)]
    texts += [f"please call: {v}" for v in first]
    # No seed stands in this context, only finds and one more.
    texts += [f"my number {v}" for v in first] + ["my number 077 555 9999"]
    spans = found_spans(spark, texts)
    assert all(spans[i] == "phone:13:25" for i in range(40, 44))
    assert all(spans[i] == "phone:10:22" for i in range(44, 48))
    assert spans[48] == "phone:10:22", "a find of the second round"


def test_recall_of_planted_identifiers(spark):
    rng = random.Random(11)
    words = ["alpha", "beta", "gamma", "delta", "omega"]
    before = {
        "email": ["mail me at", "reply soon to", "copy sent to"],
        "phone": ["ring us on", "her mobile is", "fax it to"],
        "ip": ["host seen at", "logged in from", "traffic came via"],
    }

    def seed(kind):
        if kind == "email":
            return f"{rng.choice(words)}{rng.randint(0, 10**6)}@mail{rng.randint(1, 9)}.example.com"
        if kind == "phone":
            return f"+49 {rng.randint(100, 999)} {rng.randint(10**6, 10**7 - 1)}"
        return ".".join(str(rng.randint(1, 250)) for _ in range(4))

    def unseen(kind):
        if kind == "email":
            return f"{rng.choice(words)}{rng.randint(0, 10**6)}[at]mail.example.com"
        if kind == "phone":
            return f"0{rng.randint(100, 999)} {rng.randint(10**5, 10**6 - 1)}"
        return "-".join(str(rng.randint(1, 250)) for _ in range(4))

    texts, planted = [], {}
    for kind, phrases in before.items():
        for phrase in phrases:
            texts += [f"{rng.choice(words)} {phrase} {seed(kind)} {rng.choice(words)}" for _ in range(60)]
            for _ in range(4):
                value, lead = unseen(kind), f"{rng.choice(words)} {phrase} "
                planted[len(texts)] = f"{kind}:{len(lead)}:{len(lead) + len(value)}"
                texts.append(f"{lead}{value} {rng.choice(words)}")
    clean = range(len(texts), len(texts) + 200)
    texts += [f"{rng.choice(words)} row {rng.choice(words)} {rng.randint(10**6, 10**7)} end" for _ in clean]
    spans = found_spans(spark, texts)
    caught = sum(spans[i] == span for i, span in planted.items())
    assert caught >= 0.9 * len(planted) and not any(spans[i] for i in clean)


def test_places_of_very_many_matches(spark):
    rng = random.Random(2)
    texts = ["", "no", "7 " * 511, "7 " * 512, "é7 " * 513, " ".join(str(rng.randint(0, 10**6)) for _ in range(200_000))]
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    begun = time.monotonic()
    found = frame.select("doc_id", personal_data.matches(F.col("text"), "[0-9]+").alias("m")).collect()
    assert time.monotonic() - begun < 30
    for row in found:
        expected = [(m.start(), m.end(), m[0]) for m in re.finditer("[0-9]+", texts[row.doc_id])]
        assert [tuple(m) for m in row.m] == expected


def pages(spark, data):
    return spark.createDataFrame(data, "page_id long, url string, html string, kind string, at long")


def test_archives(spark):
    body = "<p>" + "ä" * 80 + "</p>"
    data = [(3, "u3", body), (1, "u1", body), (2, None, "short"), (4, "u4", "short"), (5, "u5", None),
            (None, "u6", body), (1, "u1", body), (6, "u\r\n7", body + "x")]
    frame = pages(spark, [(*r, "k", 0) for r in data]).repartition(3)
    names, folder = warc.deduplicate(frame)
    found = warc.read_archives(names, folder, payloads=True).collect()
    assert len(found) == len(data)
    originals = [r for r in found if r.payload_digest == hashlib.sha256(body.encode()).hexdigest()]
    assert sorted((r.record_type, r.refers_to) for r in originals) == [
        ("response", None), ("revisit", 1), ("revisit", 1), ("revisit", 1)
    ]
    assert all(r.payload_bytes == len(body.encode()) for r in originals)
    assert Counter(r.payload for r in found if r.record_type == "response") == Counter([body, "short", "short", "", body + "x"])
    assert warc.read_archives(*warc.deduplicate(frame.limit(0))).count() == 0


def test_record_ids_and_standard_revisit_headers(spark):
    body = "<p>" + "x" * 200 + "</p>"
    data = [(1, "u1", body), (1, "u1", body), (1, "u1", body), (2, "u2", "short"), (2, "u2", "short")]
    names, folder = warc.deduplicate(pages(spark, [(*r, "k", 0) for r in data]).repartition(3))
    found = []
    for row in names.collect():
        with reading(folder, row.archive) as source:
            found += [headers for _, headers, _ in warc.records(source)]
    ids = {h["WARC-Record-ID"]: h for h in found}
    assert len(ids) == len(found) == 5
    revisits = [h for h in found if h["WARC-Type"] == "revisit"]
    assert len(revisits) == 2
    for h in revisits:
        original = ids[h["WARC-Refers-To"]]
        assert original["WARC-Type"] == "response" and h["WARC-Refers-To-Target-URI"] == "u1"
        assert original["WARC-Payload-Digest"] == h["WARC-Payload-Digest"]


def test_main_text(spark):
    def page(k, more=""):
        return (
            f"<html><head><title>t{k}</title><style>p{{}}</style></head><body><nav><ul><li>Menu {k}</li></ul></nav>"
            f'<div class="ad">Buy {k}</div><article><h1>Head {k}</h1><p>Text &amp; <b>bold</b>\n {k}<p>a < b'
            f"<script>var x='</p>'</script><div class='comments'><p>No</p></div>{more}</article>"
            f"<footer>Foot {k}</footer></body></html>"
        )

    data = [(k, f"http://h.example/{k}", page(k)) for k in range(5)]
    data += [(9, "http://single.example/", page(9)), (10, None, None), (11, "x", ""), (12, "http://h.example/", "<p>plain")]
    data += [(None, "http://h.example/", page(3)), (13, "http://h.example/z", page(13, "<p>end")[:-25])]
    found = html_template.main_text(pages(spark, [(*r, "k", 0) for r in data]))
    texts = {r.page_id: r.text for r in found.collect()}
    for k in (0, 1, 2, 3, 4, 9):
        assert texts[k] == f"Head {k}\n\nText & bold {k}\n\na < b"
    assert texts[10] == texts[11] == "" and texts[12] == "plain" and texts[None] == texts[3]
    assert texts[13].endswith("a < b\n\nend")
    assert html_template.main_text(pages(spark, [])).count() == 0


def test_repeated_text_is_template(spark):
    long = "All articles of this paper may be read free of charge thanks to the help of our readers."
    menu = "".join(f"<li><a href='/{w}'>{w}</a></li>" for w in ("Home", "Sports", "Contact us"))

    def plain(k):
        more = "".join(f"<p>Part {k} {i}</p><p>Read more</p>" for i in range(k % 3 + 1))
        return (f"<html><body class='page-{k}'><div><ul>{menu}</ul></div><div><p>Sports</p><p>{long}</p><div><p>Home"
                f"<p>Story {k} of <b>Home</b></p>{more}</div></div><div><a>Terms</a> | <a>Imprint</a></div></body></html>")  # fmt: skip

    def named(k):
        return f"<article><p>Story {k}</p><p>{long}</p></article><p>Imprint {k}</p>"

    data = [(k, f"http://plain.example/{k}", plain(k)) for k in range(6)]
    data += [(10 + k, f"http://named.example/{k}", named(k)) for k in range(4)]
    data += [(20 + k, f"http://copies.example/{k}", "<div><p>Written once, copied often</p></div>") for k in range(9)]
    found = html_template.main_text(pages(spark, [(*r, "k", 0) for r in data]))
    texts = {r.page_id: r.text for r in found.collect()}
    for k in range(6):
        assert texts[k].split("\n\n") == [f"Story {k} of Home", *(f"Part {k} {i}" for i in range(k % 3 + 1))]
    assert all(texts[10 + k] == f"Story {k}" for k in range(4))
    assert all(texts[20 + k] == "Written once, copied often" for k in range(9))


def test_classes_of_the_page_are_not_side():
    for page in (
        '<body class="no-sidebar"><p>Text</p></body>',
        '<body class="has-sidebar search-enabled sidebar"><p>Text</p></body>',
        '<html class="menu"><main class="search"><p>Text</p></main></html>',
        '<article class="post has-comments comments"><p>Text</p></article>',
        '<div class="layout no-sidebar"><p>Text</p></div>',
    ):
        assert html_template.extract(page, frozenset()) == "Text"
    for name in ("sidebar", "wide comments", "site-footer", "cookie-banner", "main-nav", "newsletter_signup", "widget-area", "ad"):
        assert html_template.extract(f'<p>Text</p><div class="{name}"><p>Side</p></div>', frozenset()) == "Text"


def test_repetition(spark, docs, none):
    found = quality_rules.repetition(docs).collect()
    expected = Counter()
    for doc_id, text, *_ in rows():
        w, text = WORD.findall(text or ""), text or ""
        triples = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
        inside = {k for i in range(len(w) - 2) if triples[tuple(w[i : i + 3])] > 1 for k in (i, i + 1, i + 2)}
        lines = [x for x in text.split("\n") if WORD.search(x)]
        failed = len(w) < 50 or 100 * len(inside) > 50 * len(w)
        expected[doc_id, len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text),
                 len(lines) - len(set(lines)), len(inside), failed] += 1
    got = Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in found)
    assert got == expected
    assert all(not r.kept for r in found if r.base_failed)
    assert quality_rules.passing(docs).count() == sum(r.kept for r in found)
    assert quality_rules.passing(docs).schema == docs.schema and quality_rules.repetition(none).count() == 0


def test_language_model(spark, docs, none):
    found = language_model.score_texts(docs).collect()
    data = [(i, lowered(t) + ["\0"]) for i, t, *_ in rows()]
    held = lambda i: zlib.crc32(str("" if i is None else i).encode()) % 10 == 0
    c = Counter(w for i, ws in data if not held(i) for w in ws)
    total, types = sum(c.values()), len(c)
    expected = Counter(
        (i, held(i), len(ws), sum(c[w] > 0 for w in ws), total,
         round(sum(math.log10((c[w] + 0.1) / (total + 0.1 * (types + 1))) for w in ws), 5))
        for i, ws in data
    )
    assert Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 5)) for r in found) == expected
    assert all(r.score < 0 for r in found) and language_model.score_texts(none).count() == 0


def test_blocks_keep_their_names(docs, monkeypatch):
    seen, scored = [], language_model._scored

    def twice(dealt, *rest):
        seen.extend(sorted(r.block for r in dealt.select("block").collect()) for _ in range(2))
        return scored(dealt, *rest)

    monkeypatch.setattr(language_model, "_scored", twice)
    assert language_model.score_texts(docs).count() == len(rows())
    assert seen[0] == seen[1] and seen[0]


def test_seats_lie_between_one_and_all():
    rng = np.random.default_rng(4)
    customers = np.array([0.0, 1, 2, 50, 5000, 10**6])
    runs = np.stack([language_model.seat(customers, np.full(6, 0.5), 0.75, rng) for _ in range(200)])
    assert np.all(runs[:, 0] == 0) and np.all(runs[:, 1] == 1) and np.all(runs <= customers)
    # Two customers share a table but for a chance of mass / (mass + 1 - discount).
    assert runs[:, 2].mean() == pytest.approx(1 + 0.5 / 0.75, abs=0.15)
    assert np.all(np.diff(runs.mean(axis=0)) > 0)


def test_mixing(spark, none):
    rng = random.Random(6)
    data = [(i, "w " * rng.randint(0, 90), ["a", "b", "c", None][min(3, rng.randrange(6))]) for i in range(1500)]
    data += [(7, None, "b"), (None, "x y", "c"), (7, None, "b"), (1, "", "empty")]
    frame = spark.createDataFrame(data, "doc_id long, text string, source string")
    found = mixing.mix_sources(frame, [5, 2, 1]).collect()
    assert len(found) == len(data)
    sizes = Counter()
    for _, t, s in data:
        sizes[s] += len((t or "").split())
    names = sorted((s for s in sizes if s is not None)) + [None]
    weights = {s: [5, 2, 1][k % 3] for k, s in enumerate(names)}
    target, left, open_ = {}, 1.5 * sum(sizes.values()), set(names)
    while True:
        share = {s: left * weights[s] / sum(weights[o] for o in open_) for s in open_}
        full = {s for s in open_ if share[s] >= 2 * sizes[s]}
        if not full:
            break
        for s in full:
            target[s] = 2 * sizes[s]
            left -= target[s]
        open_ -= full
        if not open_:
            break
    target |= share if open_ else {}
    taken = Counter()
    for r in found:
        taken[r.source] += r.taken
        assert r.taken <= 2 * r.size and r.source_size == sizes[r.source]
        assert r.target == pytest.approx(target[r.source], abs=1e-6)
    for s in names:
        assert taken[s] == pytest.approx(target[s], rel=0.01, abs=1)
    again = mixing.mix_sources(frame.repartition(5), [5, 2, 1]).collect()
    assert Counter((r.doc_id, r.size, r.taken) for r in again) == Counter((r.doc_id, r.size, r.taken) for r in found)
    assert mixing.mix_sources(none, [5, 2, 1]).count() == 0


def test_token_output(spark, docs, none):
    from tokenizers import Tokenizer

    tokenizer, start, expected = Tokenizer.from_file(tokenizer_path()), 0, []
    data = sorted(((r[0], r[1] or "") for r in rows()), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    for doc_id, text in data:
        ids = tokenizer.encode(text, add_special_tokens=False).ids + [2]
        expected.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    found = tokens.token_output(docs, tokenizer_path()).collect()
    assert Counter((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in found) == Counter(expected)
    assert tokens.token_output(none, tokenizer_path()).count() == 0


def test_units_are_encoded_once(monkeypatch):
    asked, ids = Counter(), tokens.Encoder._ids

    def counted(self, unit):
        asked[unit] += 1
        return ids(self, unit)

    monkeypatch.setattr(tokens.Encoder, "_ids", counted)
    encoder = tokens.Encoder(tokenizer_path(), "<u2")
    texts = ["One word, two word; word", "a word\nword. two, word", "", " word two"]
    found = encoder(texts) + encoder(texts[::-1])
    expected = [encoder._tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    assert [np.frombuffer(c, "<u2").tolist() for c in found] == expected + expected[::-1]
    assert set(asked.values()) == {1}


def test_units_are_cut_like_the_library(monkeypatch):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path())
    signs = [
        " ", " ", " ", "\n", "\n", "\t", "\r\n", "\x0b", "\x1c", "\x85", "\xa0", "\u1680", "\u2003", "\u2028",
        "\u3000", "\x00", "a", "Bc", "the", "é", "ß", "Ā", "ɏ", "ȿ", "ɀ", "×", "÷", "ª", "µ", "²", "3", "14", ".", ",",
        "-", "'", "'s", "'ll", "(", '"', "$", "_", "<", "e\u0301", "Ж", "中", "か", "“", "—", "😀", "\ufeff", "\u200b",
        "<|endoftext|>", "|>", "averyveryverylongword", "x" * 40,
    ]
    chosen = np.random.default_rng(9).integers(0, len(signs), (3_000, 14)).tolist()
    texts = ["".join(signs[k] for k in row) for row in chosen]
    texts += [a + chr(c) + b for c in range(0x80, 0x260) for a, b in ((".", ","), (" ", "\n"), ("x", "x"))]
    texts += ["", "a", "a\x00", " ", "\n", " a ", "\n\na\n\n"]
    expected = [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    for group in (64, 1 << 20):
        monkeypatch.setattr(tokens, "_GROUP", group)
        for dtype in ("<u2", "<u4"):
            found = tokens.Encoder(tokenizer_path(), dtype)(texts)
            assert [np.frombuffer(c, dtype).tolist() for c in found] == expected


def test_long_texts_are_cut(monkeypatch):
    monkeypatch.setattr(tokens, "_GROUP", 50)
    sizes, group = [], tokens.Encoder._group
    monkeypatch.setattr(
        tokens.Encoder, "_group", lambda self, texts: sizes.append(sum(map(len, texts))) or group(self, texts)
    )
    text = "one two, three\nfour  é " * 40
    encoder = tokens.Encoder(tokenizer_path(), "<u2")
    expected = encoder._tokenizer.encode(text, add_special_tokens=False).ids
    assert np.frombuffer(encoder([text])[0], "<u2").tolist() == expected
    assert max(sizes) < 100


def test_equal_units_are_looked_up_once(monkeypatch):
    asked = Counter()

    class Counted(tokens._Known):
        def __getitem__(self, unit):
            asked[unit] += 1
            return super().__getitem__(unit)

    encoder = tokens.Encoder(tokenizer_path(), "<u2")
    encoder._known = Counted(encoder._ids)
    encoder(["one two one, two. one " * 50, "two\none " * 50])
    assert set(asked.values()) == {1}


def test_units_are_kept_between_tasks():
    assert tokens.kept_encoder(tokenizer_path(), "<u2") is tokens.kept_encoder(tokenizer_path(), "<u2")


def test_minimal_perfect_hash():
    keys = np.random.default_rng(3).integers(0, 2**63, 20_000).astype(np.uint64)
    levels = tokens.build_hash(np.unique(keys))
    numbers = tokens.look_up(levels, np.unique(keys))
    assert sorted(numbers.tolist()) == list(range(len(np.unique(keys))))


def test_suffix_order_finds_all_repeats():
    rng = random.Random(1)
    for _ in range(60):
        alphabet, depth = rng.choice([b"ab", b"abc", b"the quick ", b"a"]), rng.choice([3, 5, 8])
        strings = [bytes(rng.choice(alphabet) for _ in range(rng.randint(1, 60))) for _ in range(4)]
        strings[1] = strings[0][3:] + strings[1]
        counts = Counter(s[i : i + depth] for s in strings for i in range(len(s) - depth + 1))
        for s, flags in zip(strings, suffix_dedup.repeated_starts(strings, depth)):
            assert flags.tolist() == [counts[s[i : i + depth]] > 1 for i in range(max(0, len(s) - depth + 1))]


@pytest.mark.parametrize("large", [False, True])
def test_remove_repeats(spark, docs, none, large, monkeypatch):
    if large:
        monkeypatch.setattr(suffix_dedup, "_LARGE", 2000)
    counts, expected = Counter(), Counter()
    for _, t, *_ in rows():
        b = (t or "").encode()
        counts.update(b[i : i + 400] for i in range(len(b) - 399))
    for doc_id, t, *_ in rows():
        b = (t or "").encode()
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - 399):
            if counts[b[i : i + 400]] > 1:
                gone[i : i + 400] = True
        kept = np.frombuffer(b, np.uint8)[~gone].tobytes()
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        expected[doc_id, len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()] += 1
    found = suffix_dedup.remove_repeats(docs, 400).collect()
    assert Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in found) == expected
    if not large:
        assert suffix_dedup.remove_repeats(none, 400).count() == 0
