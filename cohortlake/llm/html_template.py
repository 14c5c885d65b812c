"""Main text of web pages by templates deduced from the pages of a host."""

import hashlib
import html as html_entities
import json
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlake.llm.common import HashFilter, Sent, input_bytes, stored

# Share of a host's different pages that a class must occur on, and fewest pages for
# a template and for any text in it.
SUPPORT, FEWEST = 0.5, 3
# Largest stored size of all templates that is sent to every executor.
BROADCAST_BYTES = 4 << 20

_TAG = re.compile(r"""</?([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>""")
_MARK = re.compile(r"""(?:^|\s)(class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)
_SPACE = re.compile(r"\s+")
_RAW = {"script", "style", "noscript", "template", "textarea", "title", "iframe", "svg"}
_VOID = set("area base br col embed hr img input link meta source track wbr".split())
_BLOCKS = set(
    "address article aside blockquote body caption dd details div dl dt fieldset figcaption"
    " figure footer form h1 h2 h3 h4 h5 h6 header hr legend li main nav ol option p pre"
    " section summary table tbody td tfoot th thead tr ul".split()
)
_SIDE = set(
    "head nav header footer aside form script style noscript template textarea title iframe svg"
    " button select dialog menu".split()
)
# Elements that hold the text itself, whatever their classes say of the page.
_WHOLE = {"html", "body", "main", "article"}
# Whole class names, ids and roles of side elements: such a word, alone or with a usual
# word for its place before it and for its form after it.
_SIDE_MARK = re.compile(
    r"(?:(?:site|page|main|global|top|bottom|post|entry|article|content)[-_]?)?"
    r"(?:ads?|advert\w*|banner|promo\w*|sponsor\w*|cookies?|consent|notices?|alert"
    r"|comments?|respond|replies|disqus|side-?bar|widgets?|menu|nav|navigation|navbar|footer|header"
    r"|masthead|breadcrumbs?|share|sharing|social|related|recommended|subscribe|newsletter"
    r"|popup|modal|overlay|search|login|signup|pagination|pager|skip|copyright|legal"
    r"|complementary|contentinfo)"
    r"(?:[-_]?(?:ads?|area|banner|bar|block|body|box|buttons?|consent|container|content|form|icons?|inner"
    r"|items?|links?|list|main|menu|nav|notice|posts?|section|signup|text|title|top|wrap(?:per)?|[0-9]+))*",
    re.I,
)
# Blocks whose end tag may be missing end where one of these begins; a paragraph, at any block.
_ENDED_BY = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option"}, "p": _BLOCKS,
    "tr": {"tr"}, "td": {"td", "th", "tr"}, "th": {"td", "th", "tr"},
}
_LETTERS, _SIGN = re.compile(r"[^\W\d_]{2}"), re.compile(r"[^\W_]")
_MAIN_MARK = re.compile(
    r"(?:^|[\s_-])(?:article|content|post|entry|story|main|body)(?:$|[\s_-])", re.I
)


def tokens(page: str) -> Iterator[tuple[str, str, str]]:
    """(kind, name, value): open or close tags with class, id and role, or text.

    Comments, declarations and the contents of scripts, styles and the like are skipped.
    """
    at, end = 0, len(page)
    while at < end:
        start = page.find("<", at)
        if start < 0:
            yield "text", "", page[at:]
            return
        follows = page[start + 1 : start + 2]
        if not (follows.isascii() and follows.isalpha() or follows in ("/", "!", "?") and follows):
            more = page.find("<", start + 1)
            more = end if more < 0 else more
            yield "text", "", page[at:more]
            at = more
            continue
        if start > at:
            yield "text", "", page[at:start]
        if page.startswith("<!--", start):
            close = page.find("-->", start + 4)
            at = end if close < 0 else close + 3
            continue
        found = _TAG.match(page, start)
        if not found:
            close = page.find(">", start)
            at = end if close < 0 else close + 1
            continue
        at, name = found.end(), found[1].lower()
        if page[start + 1] == "/":
            yield "close", name, ""
            continue
        marks = " ".join(
            f'{k.lower()}="{v.strip(chr(34) + chr(39))}"' for k, v in _MARK.findall(found[2])
        )
        yield "open", name, marks
        if name in _RAW and not found[2].endswith("/"):
            close = re.compile(rf"</{re.escape(name)}[\s>/]", re.I).search(page, at)
            at = close.start() if close else end


def spell(kind: str, name: str, value: str) -> str | None:
    """A token as compared between pages; long texts by their hash, empty ones not at all."""
    if kind == "text":
        text = _SPACE.sub(" ", value).strip()
        if len(text) > 80:
            text = hashlib.blake2b(text.encode(), digest_size=16).hexdigest()
        return f"#{text}" if text else None
    return f"</{name}>" if kind == "close" else f"<{name} {value}".rstrip() + ">"


def placed(page: str) -> Iterator[tuple[str, str, str, str | None]]:
    """Tokens with their spelling, which ends in a code of the names of the enclosing blocks."""
    names, codes, opened = [], [0], Counter()

    def end():
        opened[names.pop()] -= 1
        return codes.pop()

    for kind, name, value in tokens(page):
        text = spell(kind, name, value)
        if name in _BLOCKS and kind == "open":
            while names and name in _ENDED_BY.get(names[-1], ()):
                end()
        if name in _BLOCKS and name not in _VOID and (kind == "open" or opened[name]):
            if kind == "open":
                names.append(name)
                opened[name] += 1
                codes.append(zlib.crc32(name.encode(), codes[-1]))
                code = codes[-1]
            else:
                while names[-1] != name:
                    end()
                code = end()
        else:
            code = codes[-1]
        yield kind, name, value, text and f"{text}\t{code:x}"


def _host(url: str) -> Column:
    found = F.regexp_extract(url, r"^\s*(?:[a-zA-Z][\w+.-]*:)?//([^/?#\s]*)", 1)
    return F.lower(F.coalesce(found, F.lit("")))


_STATS = "host string, token string, pages long, total long, most long, vector long, place double"


def _different(pages: DataFrame) -> DataFrame:
    """The different pages with their hash and hosts; only copies are shuffled."""
    spark = pages.sparkSession
    rows = pages.select(F.xxhash64("html").alias("key"), "html", _host("url").alias("host"))
    copied = stored(rows.groupBy("key").count().filter("count > 1").select("key"), "copied")
    keep = Sent(spark, HashFilter.of(copied, "key", copied.count()))

    @F.pandas_udf("boolean")
    def holds(key: pd.Series) -> pd.Series:
        return pd.Series(keep.value.holds(key.to_numpy(np.int64).view(np.uint64)))

    rows = rows.withColumn("copied", holds("key"))
    copies = rows.filter("copied").groupBy("key").agg(
        F.first("html").alias("html"), F.collect_set("host").alias("hosts")
    )
    return rows.filter("NOT copied").select("key", "html", F.array("host").alias("hosts")).union(copies)


def _occurrences(pages: DataFrame) -> DataFrame:
    """Per host and token: pages, occurrences, most on a page, the occurrence vector's
    fingerprint and the sum of its first places. Host ``*`` stands for all hosts.

    Copies of a page count once per host, and once for all hosts: what stands on
    copies alone is not a template.
    """
    random = 0x9E3779B97F4A7C15

    def count(frames):
        for frame in frames:
            rows: dict[tuple[str, str], list] = {}
            for key, hosts, page in zip(frame["key"], frame["hosts"], frame["html"]):
                seen: dict[str, list] = {}
                n = 0
                for n, (*_, text) in enumerate(placed(page or "")):
                    if text is not None:
                        entry = seen.setdefault(text, [0, n])
                        entry[0] += 1
                for host in (*hosts, "*"):
                    rows.setdefault((host, ""), [0, 0, 0, 0, 0.0])[0] += 1
                    for text, (times, first) in seen.items():
                        mark = (key * random + times * 0xD6E8FEB86659FD93) % (1 << 64)
                        mark = (mark ^ mark >> 32) * random % (1 << 64)
                        entry = rows.setdefault((host, text), [0, 0, 0, 0, 0.0])
                        entry[0] += 1
                        entry[1] += times
                        entry[2] = max(entry[2], times)
                        entry[3] ^= mark ^ mark >> 29
                        entry[4] += first / (n + 1)
            out = [
                (*key, e[0], e[1], e[2], int(np.uint64(e[3]).astype(np.int64)), e[4])
                for key, e in rows.items()
            ]
            yield pd.DataFrame(out, columns=[c.split()[0] for c in _STATS.split(", ")])

    return (
        _different(pages).mapInPandas(count, _STATS)
        .groupBy("host", "token")
        .agg(
            F.sum("pages").alias("pages"), F.sum("total").alias("total"),
            F.max("most").alias("most"), F.bit_xor("vector").alias("vector"),
            F.sum("place").alias("place"),
        )
    )


def nest(frame: pd.DataFrame) -> list[str]:
    """The template of a host: tags of valid classes and texts, in page order.

    Tokens with the same occurrence vector form a class. Classes of a close tag
    without its open tag before it, or the other way round, do not nest and are dropped.
    """
    text = frame["token"].str.startswith("#")
    frame = frame.assign(mean=frame["place"] / frame["pages"])
    sizes = frame.groupby("vector")["token"].transform("size")
    ordered = frame[text | (sizes >= 2)].sort_values(["mean", "token"])["token"].tolist()
    keep, opened = set(), []
    for i, token in enumerate(ordered):
        if token.startswith("#"):
            keep.add(i)
        elif token.startswith("</"):
            name = token[2:].split(">")[0]
            for k in range(len(opened) - 1, -1, -1):
                if opened[k][0] == name:
                    keep |= {opened[k][1], i}
                    del opened[k:]
                    break
        else:
            opened.append((re.split(r"[\s>]", token[1:])[0], i))
    return [t for i, t in enumerate(ordered) if i in keep]


def deduce(pages: DataFrame) -> DataFrame:
    """One template per host with enough pages, as a JSON list of tokens; ``*`` for the rest.

    Tokens are counted with partial sums, also those of a host with very many pages;
    only tokens on enough of its pages reach the group that nests them, tags if they
    occur once in their place, texts however often they do.
    """
    stats = stored(_occurrences(pages), "occurrences")
    counts = stats.filter("token = ''").select("host", F.col("pages").alias("all_pages"))
    common = (
        stats.filter("token != ''")
        .join(counts, "host")
        .filter(
            (F.col("pages") >= F.lit(SUPPORT) * F.col("all_pages"))
            & ((F.col("all_pages") >= FEWEST) | (F.col("host") == "*"))
            & F.when(F.col("token").startswith("#"), F.col("pages") >= FEWEST).otherwise(F.col("most") == 1)
        )
    )

    def template(frame: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"host": [frame["host"].iloc[0]], "template": [json.dumps(nest(frame))]})

    return common.groupBy("host").applyInPandas(template, "host string, template string")


def _role(name: str, marks: str) -> str:
    if name in _SIDE or name not in _WHOLE and _side(marks):
        return "side"
    if name in ("article", "main") or any(_MAIN_MARK.search(v) for v in _values(marks)):
        return "main"
    return ""


def _values(marks: str) -> list[str]:
    return re.findall(r'"([^"]*)"', marks)


def _side(marks: str) -> bool:
    return any(_SIDE_MARK.fullmatch(v) for value in _values(marks) for v in value.split())


def extract(page: str | None, template: frozenset[str]) -> str:
    """Text of the slots inside the template's main elements, as blocks.

    A slot is what stands between two tokens of the template. Blocks whose texts are
    all in the template are left out; one with other text too stays whole, and so
    does one of numbers, signs and single letters, which are alike by chance. Slots
    inside menus, headers, footers, asides, forms, adverts, notices, comments and the
    like are left out, and so are such elements inside a slot. Where the template has
    none of the main elements, those of the page count, and if it has none, all slots.
    """
    parts = list(placed(page or ""))
    roles = [_role(p[1], p[2]) if p[0] == "open" else "" for p in parts]
    has_main = any(r == "main" and p[3] in template for r, p in zip(roles, parts))
    tags = template
    if not has_main:
        tags = frozenset(p[3] for p in parts if p[0] != "text")
        has_main = "main" in roles
    slots: list[tuple[str, str]] = []
    skipped: list[str] = []
    blocks, words, other = [], [], []

    def end_block():
        text = _SPACE.sub(" ", html_entities.unescape("".join(words))).strip()
        if text and (other or not _LETTERS.search(text)):
            blocks.append(text)
        words.clear()
        other.clear()

    for (kind, name, value, text), role in zip(parts, roles):
        if kind == "text":
            inside = not has_main or any(r == "main" for _, r in slots)
            if inside and not skipped and not any(r == "side" for _, r in slots):
                words.append(value)
                if text and text not in template and _SIGN.search(html_entities.unescape(value)):
                    other.append(value)
            continue
        if name in _BLOCKS:
            end_block()
        elif name == "br":
            words.append(" ")
        if name in _VOID:
            continue
        if kind == "open":
            if text in tags and role:
                slots.append((name, role))
            elif skipped:
                if skipped[0] == name:
                    skipped.append(name)
            elif role == "side":
                skipped.append(name)
            elif any(n == name for n, _ in slots):
                slots.append((name, ""))
        elif skipped and skipped[0] == name:
            skipped.pop()
        elif any(n == name for n, _ in slots):
            skipped.clear()
            while slots.pop()[0] != name:
                pass
    end_block()
    return "\n\n".join(blocks)


def main_text(pages: DataFrame) -> DataFrame:
    """Main text per page: page_id, url, text and n_chars, one row per input row.

    A missing html is empty and gives an empty text; a missing url belongs to the
    host without name; hosts with fewer than three pages use the template of all
    hosts. Equal pages give equal texts; an empty table gives no rows; further
    columns are ignored. Templates are sent to all executors only while their
    stored size is below a limit; beyond it pages and templates are joined by host.
    """
    source = pages.select(
        F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string")
    )
    templates = stored(deduce(source), "templates")
    small = input_bytes(templates) <= BROADCAST_BYTES
    general = templates.filter("host = '*'").select(F.col("template").alias("general"))
    row = general.first()
    fallback = row["general"] if row else "[]"
    hosts = templates.filter("host != '*'")

    def run(frames):
        known: dict[str, frozenset[str]] = {}
        for frame in frames:
            texts = []
            for page, template in zip(frame["html"], frame["template"]):
                template = template or fallback
                if len(known) > 1000:
                    known.clear()
                if template not in known:
                    known[template] = frozenset(json.loads(template))
                texts.append(extract(page, known[template]))
            out = frame[["page_id", "url"]].assign(text=texts, n_chars=[len(t) for t in texts])
            out["page_id"] = out["page_id"].astype("Int64")
            yield out

    joined = source.withColumn("host", _host("url")).join(
        F.broadcast(hosts) if small else hosts, "host", "left"
    )
    return joined.select("page_id", "url", "html", "template").mapInPandas(
        run, "page_id long, url string, text string, n_chars long"
    )
