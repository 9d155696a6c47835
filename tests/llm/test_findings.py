"""Cases that were wrong once: page markup, secrets at borders, short items, clashing names, repeated and null ids."""

import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfprice.llm import decontaminate, html_extract, jaccard_join, mixing, secrets, suffix_dedup


@pytest.mark.parametrize("page, text", [
    ('<article><p>a</p><svg class="i"/><p>b</p><p>c</p></article>', "a\nb\nc"),
    ("<body class='home has-sidebar'><p>x</p></body>", "x"),
    ("<article><h2 id='related-work'>R</h2><p class='search-term'>s</p></article>", "R\ns"),
    ("<article><p>a</p><object><p>b</p><select><p>c</p></article>", "a\nb\nc"),
    ("<article><p>a<iframe src=x><p>b</p><p>c</p></article><article><iframe>no</iframe>d</article>", "a\nb\nc\nd"),
    ("<article>one <svg><text>t</text></svg> two<select><option>no</select></article>", "one two"),
    ("<div class='cookie-banner'>no</div><div class='site-footer'>no</div><main>m<div class='ad'>no</div><div class=comments>no</div></main>", "m"),
    ("<article><div class='search-results header'>kept</div><div role=search>no</div></article>", "kept"),
    ("<style>p{}</style><script>var t='</p>';</script><p>k<script>x", "kx"),
    ("<p>a &lt;b&gt; <!-- no --> c<br/>d", "a <b> c d"),
])
def test_page_text(page, text):
    assert "\n".join(t for t, role in html_extract.blocks(page) if role != html_extract.OUT) == text


def plain_boilerplate(streams, run, need):
    """Token places covered by maximal repeats of ``run`` tokens or more on ``need`` pages, from a whole suffix array."""
    suffixes = sorted((tuple(s[i:]), p, i) for p, s in enumerate(streams) for i in range(len(s)))

    def common(a, b):
        n = 0
        while n < min(len(a), len(b)) and a[n] == b[n]:
            n += 1
        return n
    lcp = [common(a[0], b[0]) for a, b in zip(suffixes, suffixes[1:])]
    covered = defaultdict(set)
    for depth in sorted({d for d in lcp if d >= run}):
        first = 0
        for i in range(len(suffixes)):
            if i == len(lcp) or lcp[i] < depth:                        # the interval first..i of this depth ends
                if len({p for _, p, _ in suffixes[first:i + 1]}) >= need and i > first:
                    for _, p, at in suffixes[first:i + 1]:
                        covered[p].update(range(at, at + depth))
                first = i + 1
    return covered


def test_host_repeats_equal_a_whole_suffix_array(spark):
    rnd = random.Random(9)
    common = [" ".join(f"c{rnd.randrange(40)}" for _ in range(rnd.choice([9, 14, 30]))) for _ in range(5)]
    pages, streams, blocks = [], [], []
    for i in range(30):
        mine = [rnd.choice(common) if rnd.random() < 0.3 else " ".join(f"w{rnd.randrange(60)}" for _ in range(rnd.randrange(10, 25))) for _ in range(5)]
        if rnd.random() < 0.5:
            mine[2] = mine[2] + " " + rnd.choice(common)
        pages.append((i, "http://h.example/p", "".join(f"<p>{b}</p>" for b in mine)))
        blocks.append(mine)
        streams.append(" ".join(mine).split())
    covered = plain_boilerplate(streams, html_extract.RUN, 3)           # a tenth of 30 pages
    want = {}
    for i, mine in enumerate(blocks):
        at, kept = 0, []
        for b in mine:
            n = len(b.split())
            if 2 * len(covered[i] & set(range(at, at + n))) <= n:
                kept.append(b)
            at += n
        want[i] = "\n".join(kept)
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    assert {r.id: r.text for r in html_extract.extract(spark, df).collect()} == want
    assert any(len(want[i].split("\n")) < 5 for i in want)


def test_opaque_values_and_links_at_cell_borders(spark):
    late = "xy" * 40 + "7"                                             # its first digit comes after 80 letters
    texts = {1: f"user=x {late}", 2: "x" * 40 + " user=x"}
    for shift in range(-6, 7):                                         # exactly SCOPE apart wherever the cells' borders fall
        texts[100 + shift] = " " * (185 + shift) + "secret=abcdefgh" + " " * 200 + "user=bob"
        texts[200 + shift] = " " * (185 + shift) + "secret=abcdefgh" + " " * 201 + "user=bob"
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r.id: [s.kind for s in r.spans] for r in secrets.scan(spark, df).collect()}
    assert got[1] == ["login", "opaque"] and got[2] == []
    assert all(got[i] == ["assign", "login"] for i in texts if 94 <= i <= 106)
    assert all(got[i] == ["assign"] for i in texts if i >= 194)


def test_short_items_match_whole_texts(spark):
    bench = spark.createDataFrame([(1, "Two Words"), (2, "one"), (3, "a b c d"), (4, " "), (5, "two words")], "item_id long, text string")
    docs = spark.createDataFrame([(1, "two  WORDS"), (2, "two words more"), (3, "one"), (4, ""), (5, "a b c d")], "doc_id long, text string")
    got = {(r.id, r.item_id, r.similarity) for r in decontaminate.contaminated(spark, docs, bench).collect()}
    assert got == {(1, 1, 1.0), (1, 5, 1.0), (3, 2, 1.0), (5, 3, 1.0)}
    assert sorted(r.doc_id for r in decontaminate.keep_clean(spark, docs, bench).collect()) == [2, 4]


def test_clashing_names(spark, odd_docs):
    df = odd_docs.selectExpr("*", "1 as text_key", "2 as found_spans", "3 as gone", "4 as KEY", "5 as times", "6 as mix_prefix", "7 as mix_times")
    n = df.count()
    assert secrets.redact(spark, df).columns == df.columns and secrets.redact(spark, df).count() == n
    assert jaccard_join.keep_one(spark, df).columns == df.columns
    out = mixing.mixed(spark, df)
    assert out.columns == [*df.columns, "mix_times_"] and out.count() <= n


def test_exactly_one_of_each_group_stays(spark):
    a, b, c = ("a%d " * 30 % tuple(range(k, k + 30)) for k in (0, 100, 200))
    rows = [(1, a, "x"), (1, a, "x"), (2, a + "more", "x"), (None, b, "x"), (None, b, "y"), (None, b + "end", "z"), (1, c, "alone"), (5, c + "tail", "x"),
            (9, None, "x"), (9, "", "x"), (None, None, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    kept = jaccard_join.keep_one(spark, df).collect()
    texts = [r.text or "" for r in kept]
    assert sum(t.startswith("a0 ") for t in texts) == 1 and sum(t.startswith("a100 ") for t in texts) == 1
    assert sum(t.startswith("a200 ") for t in texts) == 1 and sum(not t for t in texts) == 3
    assert len(kept) == 6 and (1, c) in [(r.doc_id, r.text) for r in kept]


def test_sketches_never_differ_more_than_sets():
    rnd = np.random.default_rng(3)
    for _ in range(50):
        s = np.unique(rnd.integers(0, 1 << 63, rnd.integers(1, 3000)).astype(np.uint64))
        t = np.unique(np.concatenate([s[rnd.random(len(s)) < 0.8], rnd.integers(0, 1 << 63, rnd.integers(0, 200)).astype(np.uint64)]))
        bits = jaccard_join.differing_bits(jaccard_join.sketch_array([jaccard_join.sketch(s)]), jaccard_join.sketch_array([jaccard_join.sketch(t)]))
        assert bits[0] <= len(np.setxor1d(s, t))


@pytest.mark.parametrize("percent", [80, 90])
def test_linked_sets_share_a_signature(percent):
    """Sets at the threshold, with empty segments and with exchanged ones."""
    rnd = np.random.default_rng(percent)
    bands = jaccard_join.Bands(percent, 5000)
    for n in (3, 9, 25, 60, 200, 900):
        for _ in range(15):
            s = np.unique(rnd.integers(0, 1 << 63, n).astype(np.uint64))
            out = rnd.permutation(len(s))[:int(len(s) * (100 - percent) / 100)]
            t = np.delete(s, out)
            if len(t) * 100 < percent * len(s):
                continue
            for exchanges in (0, 1, 4):
                allocation = {b: (tuple(range(k)), tuple(range(k, 2 * k))) for b in range(len(bands.low))
                              if (k := min(exchanges, bands.segments(b) // 2))}
                a, b = (jaccard_join.signatures(x, bands, allocation) for x in (s, t))
                assert len(np.intersect1d(a, b))


@pytest.mark.parametrize("percent", [80, 90])
def test_linked_sets_share_more_signatures_than_either_can_spare(percent):
    """So the rarest that they share is left, whichever order the signatures of a band are left in."""
    rnd = np.random.default_rng(percent + 1)
    bands, spared = jaccard_join.Bands(percent, 5000), 0
    for n in (2, 3, 9, 25, 60, 200, 450, 900, 3000):
        for _ in range(15):
            s = np.unique(rnd.integers(0, 1 << 63, n).astype(np.uint64))
            t = np.delete(s, rnd.permutation(len(s))[:int(len(s) * (100 - percent) / 100)])
            both = np.intersect1d(*(jaccard_join.signatures(x, bands, {}) for x in (s, t)))
            band = both >> np.uint64(jaccard_join.SEGMENT_BITS + jaccard_join.HASH_BITS)
            a, b = (dict(jaccard_join.spare(x, bands)) for x in (s, t))
            assert set(a) & set(b)
            for at in set(a) & set(b):
                assert (band == at).sum() > max(a[at], b[at])
                spared += a[at] + b[at]
    assert spared


def test_passages_of_words_in_what_is_left(spark):
    rnd = random.Random(6)
    words = [f"w{i}" for i in range(40)]
    shared = [" ".join(rnd.choices(words, k=k)) for k in (6, 11, 12, 13, 25, 40)]
    rows = []
    for i in range(40):
        parts = [" ".join(rnd.choices(words, k=rnd.randrange(3, 30))) for _ in range(3)]
        parts.insert(rnd.randrange(3), rnd.choice(shared))
        text = "  ".join(parts).encode()
        cut = sorted(rnd.sample(range(len(text)), 2)) if i % 4 == 0 else []
        removed = [(cut[0] + 100 * k, cut[0] + 100 * k + 30) for k, _ in enumerate(cut)]        # in places of the text before the cut
        kept_cuts = [removed[0][0], removed[1][0] - 30] if removed else []
        rows.append((i, removed, text, kept_cuts))
    rows += [(100, [], b"", []), (101, [], rows[1][2], []), (102, [], rows[1][2].upper(), [])]
    df = spark.createDataFrame([(r, x, bytearray(t)) for r, x, t, _ in rows], "row long, removed array<struct<start:int,end:int>>, kept binary")
    n, holders, places = 12, defaultdict(set), {}
    for r, _, text, cuts in rows:
        mine, number = [], 0
        for a, b in zip([0, *cuts], [*cuts, len(text)]):
            w = text[a:b].lower().split()
            mine += [(number + i, tuple(w[i:i + n])) for i in range(len(w) - n + 1)]
            number += len(w) + 1
        places[r] = mine
        for _, g in mine:
            holders[g].add(r)
    want = {}
    for r, mine in places.items():
        at = {i for i, g in mine if len(holders[g]) > 1}
        if at:
            want[r] = sum(i - 1 not in at for i in at)
    got = {r.row: r.n for r in suffix_dedup.passages(spark, df, words=n, seed=4).collect()}
    assert got == want and len(want) > 10


def test_odd_pages(spark):
    from shelfprice.llm import url_filter

    long_url, long_html = "http://a.example.org/es/" + "x/" * 50_000, "<p>" + "word " * 100_000 + "</p>"
    rows = [(1, None, None), (1, None, None), (2, "", ""), (3, long_url, long_html), (None, "http://x.com/de/", "<article>a</article>"),
            (4, "http://x.com/de/", "<article>a</article>"), (4, "http://x.com/de/", "<article>a</article>"), (5, "HTTP://", "<")]
    df = spark.createDataFrame([(*r, "h", 1, "p", "v", "t") for r in rows],
                               "page_id long, url string, html string, host string, row long, path string, verdict string, text string")
    got = sorted((r.id or 0, r.rule or "", r.verdict) for r in url_filter.judge(spark, df).collect())
    assert got == [(0, "com/de/", "block"), (1, "", "allow"), (1, "", "allow"), (2, "", "allow"), (3, "example.org/es/", "block"),
                   (4, "com/de/", "block"), (4, "com/de/", "block"), (5, "", "allow")]
    pages = sorted((r.id or 0, r.text) for r in html_extract.extract(spark, df).collect())
    assert pages == [(0, "a"), (1, ""), (1, ""), (2, ""), (3, " ".join(["word"] * 100_000)), (4, "a"), (4, "a"), (5, "<")]


@pytest.mark.parametrize("members, exchanged", [(1000, False), (4000, True)])
def test_a_segment_is_exchanged_when_its_pairs_cost_more_than_the_rows(spark, members, exchanged):
    """A signature that is made, shuffled and joined costs what dozens of compared pairs do."""
    bands = jaccard_join.Bands(90, 100)
    band, cut = bands.of(100), jaccard_join.SEGMENT_BITS + jaccard_join.HASH_BITS
    classes = spark.range(members).select(F.col("id").alias("class"), F.lit(100).cast("long").alias("n"))
    rest = classes.select(F.lit((band << cut) + (3 << jaccard_join.HASH_BITS) + 5).alias("sig"), "class")
    found = jaccard_join.allocate(spark, rest, classes, bands)
    assert ({b: skipped for b, (skipped, _) in found.items()}) == ({band: (3,)} if exchanged else {})


def test_windows_of_many_texts_at_once():
    """Texts are hashed together; windows of words stay within a text and its cuts, numbered in their text."""
    r = random.Random(5)
    texts = [" ".join(r.choice("abc") for _ in range(n)).encode() for n in (0, 3, 4, 9, 30, 2, 14)]
    rows = [(t, sorted(r.choices(range(0, len(t) + 1, 2), k=i % 3))) for i, t in enumerate(texts)]
    found, hashes, seeds = list(suffix_dedup.word_windows(rows, suffix_dedup.Hasher(fold=True), 4, 2)), {}, {}
    for (kept, cuts), (at, seed, w) in zip(rows, found, strict=True):
        words, starts = [], []
        for a, b in zip([0, *cuts], [*cuts, len(kept)]):
            piece = kept[a:b].split()
            starts += range(len(words), len(words) + len(piece) - 3)
            words += [*piece, None]
        assert at.tolist() == starts
        for i, s, h in zip(starts, seed.tolist(), w.tolist()):
            assert hashes.setdefault(tuple(words[i:i + 4]), (h, s)) == (h, s)
    assert len(set(hashes.values())) == len(hashes) > 10


def test_extents_of_two_contexts_and_of_three_agree():
    """Two contexts of an anchor are compared at once; beside a third that shares nothing but the anchor they repeat as far."""
    r, repeats = random.Random(6), 0
    for _ in range(300):
        left, right = (bytes(r.choices(b"ab", k=6)) for _ in range(2))
        pairs = [(left[r.randrange(6):], right[:r.randrange(6)]) for _ in range(2)]
        contexts, lefts = [x + b"core" + y for x, y in pairs], [len(x) for x, _ in pairs]
        two = suffix_dedup.repeat_extents(contexts, lefts, 10)
        three = suffix_dedup.repeat_extents([*contexts, b"?core!"], [*lefts, 1], 10)
        if contexts[0] != contexts[1]:
            assert two.tolist() == three[:2].tolist() and not three[2].any()
            repeats += two.any()
    assert repeats > 10
