"""HTML extraction: structure, and a host's repeated token runs where structure is silent.

A page is cut into blocks.  Blocks inside ``article`` or ``main`` are its text; blocks inside
menus, headers, footers, sidebars, notices, adverts, forms and comment sections are not; scripts,
styles and markup are no blocks at all.  Blocks that neither tells apart are judged by the host:
the token streams of its pages (all but the article blocks, which stay whatever repeats) make a
suffix array, of which the repeats of RUN tokens or more count that are on SHARE of the host's
different pages, two at least.  They cover those tokens on each page; a block covered for more than
half goes, unique runs stay.  A block of SHORT to RUN - 1 tokens goes if it is repeated as a whole
on as many pages.

A maximal repeat of RUN tokens or more is covered by its runs of RUN tokens, which are on as many
pages or more, and each such run lies in a maximal repeat on the same pages; so the suffix array is
held as its intervals of depth RUN.  They are found by grouping on host and run, with each page
counted once per run before anything is shuffled, so a host with a third of all pages is a sum
like any other.  Only hosts with blocks to judge are looked at.

Character references are decoded, white space in a block becomes one space, blocks are joined by
one line break.

What is no text is told by the element (``nav``, ``footer``, ``form`` ...) or, on containers only, by a class, id or role
whose whole name says so (``ad``, ``cookie-banner``, ``site-footer``; not ``has-sidebar`` or ``search-term``).  Inside an
article only the names of adverts, notices, comment sections and the like count (``NAMED_INSIDE``).

Defined results: a null or empty page has an empty text; an unclosed element ends with its parent
or the page, but one that would hide its content (``svg``, ``select``, ``iframe``, ``script`` ...) is passed over if it is
self-closed or never ended; pages of a host with equal text outside menus and the like, and so repeated rows, count as
one; a null url belongs to the empty host; an empty table gives an empty result.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import Hasher, Words, shingle_hashes, small_side, stored, table, utf8
from .url_filter import AUTHORITY
from .common import lower_ascii

RUN, SHORT = 8, 4
MIN_PAGES, SHARE = 2, 0.1
MAX_BROADCAST = 1_000_000
PIECE = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^'\">])*)(?:>|\Z)", re.S)
RAW = {"script", "style", "textarea", "iframe", "noembed", "noframes", "xmp"}    # their content is no markup
CODE = {"script", "style"}
SILENT = RAW | {"svg", "math", "object", "select", "noscript", "template", "audio", "video", "canvas"}
MAIN = {"article", "main"}
CHROME = {"nav", "header", "footer", "aside", "form", "menu", "dialog", "button", "head", "title"}
BLOCKS = MAIN | CHROME | {
    "p", "div", "section", "ul", "ol", "li", "dl", "dt", "dd", "table", "thead", "tbody", "tfoot", "tr", "td", "th", "caption",
    "h1", "h2", "h3", "h4", "h5", "h6", "blockquote", "pre", "figure", "figcaption", "address", "details", "summary",
    "fieldset", "hr", "body", "html"}
VOID = {"br", "hr", "img", "input", "meta", "link", "area", "base", "col", "embed", "source", "track", "wbr"}
CONTAINERS = {"div", "section", "span", "ins", "ul", "ol", "dl", "table", "td", "center", "fieldset", "details", "figure"}
#: names that say that a container's content is not the page's text, and words that may stand beside them
NAMED_INSIDE = {
    "ad", "ads", "advert", "adverts", "advertisement", "advertising", "sponsor", "sponsored", "promo", "promotion", "cookie", "cookies",
    "consent", "gdpr", "popup", "modal", "newsletter", "subscribe", "share", "social", "nav", "navbar", "navigation", "menu", "breadcrumb",
    "breadcrumbs", "comment", "comments", "respond", "replies", "disqus"}
NAMED = NAMED_INSIDE | {"banner", "notice", "notices", "header", "masthead", "footer", "sidebar", "related", "toolbar", "search"}
BESIDE = {"site", "page", "global", "top", "bottom", "left", "right", "box", "block", "slot", "unit", "bar", "list", "links", "section", "area",
          "wrapper", "container", "inner", "outer", "primary", "secondary"}
ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alertdialog", "menu", "menubar", "toolbar", "form"}
VALUES = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
IN, OUT, OPEN = "in", "out", "open"


def pieces(page: str) -> list[tuple[int, int, str, bool, str]]:
    """(start, end, tag, whether it ends the element, attributes) of the markup in order; what has no tag is ``''``.

    An element whose content is no markup is one piece up to its end, if it has one.
    """
    out, at, endless = [], 0, set()
    while m := PIECE.search(page, at):
        tag, at = (m[2] or "").lower(), m.end()
        if tag in RAW and not m[1] and not m[0].endswith("/>") and tag not in endless:
            end = re.compile(rf"</{tag}\s*>", re.I).search(page, at)
            # one more that starts before that end is the one that ends there; but scripts may name their own kind
            if end and (tag in CODE or not re.compile(rf"<{tag}\b", re.I).search(page, at, end.start())):
                out.append((m.start(), end.end(), "", False, ""))
                at = end.end()
                continue
            if not end:
                endless.add(tag)                           # none of this kind ends from here on
        out.append((m.start(), at, tag, bool(m[1]), (m[3] or "")))
    return out


def ended(found: list[tuple[int, int, str, bool, str]]) -> dict[int, int]:
    """For each piece that starts an element with an end tag of its own, the piece that ends it."""
    out, stack = {}, []
    for i, (_, _, tag, closes, _) in enumerate(found):
        if closes:
            at = next((k for k in range(len(stack) - 1, -1, -1) if found[stack[k]][2] == tag), None)
            if at is not None:
                out[stack[at]] = i
                del stack[at:]
        elif tag and tag not in VOID:
            stack.append(i)
    return out


def says_no_text(tag: str, attributes: str, inside: bool) -> bool:
    """Whether an element's names say that it holds none of the page's text."""
    if tag in ("html", "body") or tag in MAIN:
        return False
    known = NAMED_INSIDE if inside else NAMED
    for kind, *values in VALUES.findall(attributes):
        for name in "".join(values).lower().split():
            if kind.lower() == "role":
                if name in ROLES:
                    return True
            elif tag in CONTAINERS:
                words = [w for w in re.split("[-_]+", name) if w]
                if any(w in known for w in words) and all(w in known or w in BESIDE for w in words):
                    return True
    return False


def blocks(page: str) -> list[tuple[str, str]]:
    """(text, IN, OUT or OPEN) of a page's blocks in order."""
    out: list[tuple[str, str]] = []
    stack: list[tuple[str, str]] = [("", OPEN)]
    held: list[str] = []

    def close() -> None:
        text = " ".join(html.unescape("".join(held)).split())
        held.clear()
        if text:
            out.append((text, stack[-1][1]))

    found = pieces(page)
    whole, at, hidden = ended(found), 0, -1
    for i, (start, end, tag, closes, attributes) in enumerate(found):
        if i <= hidden:
            at = end
            continue
        held.append(page[at:start])
        at = end
        if not tag:
            continue
        if tag in SILENT:                                  # nothing of it is text; without an end it holds nothing
            hidden = whole.get(i, -1)
            continue
        if tag == "br":
            held.append(" ")
        if tag in BLOCKS or not closes and tag not in VOID and says_no_text(tag, attributes, stack[-1][1] == IN):
            close()
        if tag in VOID:
            continue
        if closes:
            depth = next((k for k in range(len(stack) - 1, 0, -1) if stack[k][0] == tag), 0)
            if depth:
                if any(role != stack[depth - 1][1] for _, role in stack[depth:]):
                    close()
                del stack[depth:]
        elif not attributes.endswith("/"):
            if tag == "p" and stack[-1][0] == "p":
                stack.pop()                                # a paragraph ends where the next begins
            role = stack[-1][1]
            if role != OUT:
                if tag in CHROME and not (tag == "header" and role == IN) or says_no_text(tag, attributes, role == IN):
                    role = OUT
                elif tag in MAIN:
                    role = IN
            stack.append((tag, role))
    held.append(page[at:])
    close()
    return out


def text_hash(text: str) -> int:
    return int.from_bytes(blake2b(utf8(text), digest_size=8).digest(), "little", signed=True)


def page_rows(pages: DataFrame) -> DataFrame:
    """(id, url, host, page, main, open, runs): hash of the page's text, article text, unjudged blocks with their
    places (and hashes, if short), and the hashes of the page's token runs outside the article, by place."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hasher = Hasher(fold=False)
        for b in batches:
            parsed = [blocks(p) if isinstance(p, str) else [] for p in b["html"]]
            streams, opens, texts = [], [], []
            for page in parsed:
                w = Words([utf8(" ".join(t for t, role in page if role != IN))], hasher)
                streams.append(shingle_hashes(w.hash, RUN).view(np.int64))
                at, mine = 0, []
                for i, (t, role) in enumerate(page):
                    n = len(t.split()) if role != IN else 0
                    if role == OPEN:
                        mine.append({"i": i, "text": t, "at": at, "n": n, "run": text_hash(t) if SHORT <= n < RUN else None})
                    at += n
                opens.append(mine)
                texts.append(text_hash("\n".join(t for t, role in page if role != OUT)))
            yield pd.DataFrame({"id": b["id"], "url": b["url"], "host": b["host"], "page": texts, "open": opens, "runs": streams,
                                "main": [[{"i": i, "text": t} for i, (t, role) in enumerate(p) if role == IN] for p in parsed]})

    kind = pages.schema["id"].dataType.simpleString()
    return pages.mapInPandas(run, f"id {kind}, url string, host string, page long, main array<struct<i:int,text:string>>, "
                                  "open array<struct<i:int,text:string,at:int,n:int,run:long>>, runs array<long>")


def extract(spark: SparkSession, pages: DataFrame, id_col="page_id", url_col="url", html_col="html") -> DataFrame:
    """(id, url, text) of every page."""
    host = lower_ascii(F.regexp_extract(F.coalesce(F.col(url_col), F.lit("")), AUTHORITY, 1))
    rows = stored(spark, page_rows(pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), host.alias("host"),
                                                F.col(html_col).alias("html")))
                  .withColumn("row", F.monotonically_increasing_id()), "pages")
    # one row of each of a host's pages, with the pages a repeat must be on
    pages_of = stored(spark, rows.groupBy("host", "page").agg(F.min("row").alias("row"), F.max(F.size("open")).alias("open")), "different-pages")
    hosts = pages_of.groupBy("host").agg(F.count("*").alias("n"), F.max("open").alias("open")).filter("open > 0").select(
        "host", F.greatest(F.lit(MIN_PAGES), F.ceil(F.col("n") * SHARE)).alias("need"))
    counted = stored(spark, pages_of.join(stored(spark, hosts, "hosts"), "host").select("row", "need"), "counted")
    short = F.transform(F.filter("open", lambda o: o["run"].isNotNull()), lambda o: o["run"])
    # intervals of the host's suffix array at depth RUN, and short blocks, that enough pages share
    boiler = stored(spark, rows.select("row", "host", F.array_distinct(F.concat("runs", short)).alias("runs"))
                    .join(small_side(counted, MAX_BROADCAST), "row").select("host", "need", F.explode("runs").alias("run"))
                    .groupBy("host", "run").agg(F.count("*").alias("pages"), F.max("need").alias("need"))
                    .filter(F.col("pages") >= F.col("need")).select("host", "run"), "boilerplate")
    # only blocks that structure leaves open are judged: their tokens are covered by the runs that touch them
    todo = rows.filter(F.size("open") > 0)
    places = todo.select("row", "host", F.posexplode("runs").alias("at", "run")).withColumn("n", F.lit(RUN)).unionByName(
        todo.select("row", "host", F.explode("open").alias("o")).filter("o.run is not null").select("row", "host", "o.at", "o.run", "o.n"))
    covered = (places.join(boiler, ["host", "run"]).select("row", F.explode(F.sequence(F.col("at"), F.col("at") + F.col("n") - 1)).alias("token"))
               .distinct().groupBy("row").agg(F.collect_set("token").alias("covered")))

    def unique(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in parts:
            kept = []
            for opened, hidden in zip(b["open"], b["covered"]):
                gone = set() if hidden is None else set(hidden)
                kept.append([{"i": o["i"], "text": o["text"]} for o in opened
                             if 2 * sum(t in gone for t in range(o["at"], o["at"] + o["n"])) <= o["n"]])
            yield pd.DataFrame({"row": b["row"], "kept": kept})

    kept = stored(spark, todo.select("row", "open").join(covered, "row", "left").mapInPandas(
        unique, "row long, kept array<struct<i:int,text:string>>"), "kept")
    every = F.array_sort(F.concat("main", F.coalesce("kept", F.array().cast("array<struct<i:int,text:string>>"))))
    return rows.drop("open", "runs", "page").join(kept, "row", "left").select("id", "url", F.array_join(every["text"], "\n").alias("text"))


def op5_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = extract(spark, table(spark, sf_dir, "pages"))
    return found.select(F.col("id").alias("page_id"), "url", "text", F.length("text").cast("long").alias("n_chars"))
