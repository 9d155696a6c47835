"""Divergence audit, lexical search and embedding near-dedup against plain statements of their rules."""

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from shelfprice.llm import divergence, embedding_dedup, lexical_search

LETTERS = re.compile("[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
TERMS = re.compile("[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def low(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def plain_audit(rows, min_docs, top):
    """rows: (lang, source, text)."""
    rows = [(lang or "", source or "", LETTERS.findall(low(text))) for lang, source, text in rows]
    out = []
    for lang in {r[0] for r in rows}:
        mine = [r for r in rows if r[0] == lang]
        docs = Counter(t for *_, w in mine for t in set(w))
        kept = sorted(t for t, n in docs.items() if n >= min_docs)
        counts = {s: Counter() for _, s, _ in mine}
        for _, s, w in mine:
            counts[s].update(t for t in w if docs[t] >= min_docs)

        def p(c):
            total = sum(c.values())
            return {t: 1 + 10 ** 9 * (c[t] + 2) // (total + 2 * len(kept)) for t in kept}
        ps, q = {s: p(c) for s, c in counts.items()}, p(sum(counts.values(), Counter()))

        def f(a, b):
            return (a - b) ** 2 // (a + b)
        for s in counts:
            pairs = [(sum(f(ps[s][t], ps[u][t]) for t in kept), u) for u in counts if u != s]
            terms = [(f(ps[s][t], q[t]), t) for t in kept if counts[s][t] and ps[s][t] > q[t]]
            for part, found, most in (("pair", pairs, None), ("term", terms, top)):
                for rank, (value, item) in enumerate(sorted(found, key=lambda x: (-x[0], x[1].encode()))[:most], 1):
                    out.append((lang, s, part, item, value, rank))
    return sorted(out)


@pytest.mark.parametrize("shard_rows, block, cells, held, size", [(200_000, 256, 1 << 18, 1 << 17, 1 << 21), (7, 2, 12, 5, 64)])
def test_divergence(spark, monkeypatch, shard_rows, block, cells, held, size):
    for name, value in (("SHARD_ROWS", shard_rows), ("SOURCE_BLOCK", block), ("CELLS", cells), ("HELD", held), ("SLICE_BYTES", size)):
        monkeypatch.setattr(divergence, name, value)
    rnd = random.Random(2)
    words = ["Aa", "aA", "b", "c1d", "é", "É", "x_y", "z", "the", "of", "ein", "zwei"]
    rows = [(rnd.choice(["en", "de", None]), rnd.choice(["s1", "s2", "s3", None, "S4"]), " ".join(rnd.choices(words, k=rnd.randrange(0, 12)))) for _ in range(120)]
    rows += [("fr", "only", "un"), ("it", "a", None), ("it", "b", "\x00 1 2"), ("en", "s1", "the " * 30_000), ("en", "s1", "")] + [("en", "s2", "b c")] * 5
    df = spark.createDataFrame(rows, "lang string, source string, text string")
    got = sorted(tuple(r) for r in divergence.audit(spark, df, min_docs=4, top=3).collect())
    assert got == plain_audit(rows, 4, 3)


def test_divergence_long_counts():
    count = np.array([0, 1, 5, 10 ** 15, 7 * 10 ** 14], np.int64)
    total = np.full(5, 10 ** 15 + 3, np.int64)
    assert divergence.share(count, total).tolist() == [1 + 10 ** 9 * int(c) // (10 ** 15 + 3) for c in count]


def plain_search(docs, items, limit):
    docs = [(i, TERMS.findall(low(t))) for i, t in docs]
    n_docs, total = sum(bool(w) for _, w in docs), sum(len(w) for _, w in docs)
    df = Counter(t for _, w in docs for t in set(w))
    out = []
    for item, text in items:
        found = []
        for i, w in docs:
            tf, score = Counter(w), 0
            for t in set(TERMS.findall(low(text))):
                if tf[t]:
                    m = 100 - 50 + (50 * len(w) * n_docs) // total
                    score += math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10 ** 9 * tf[t] // (1000 * tf[t] + 20 * m))
            if score > 0:
                found.append((-score, i is None, i or 0, i))
        out += [(item, rank, i, -s) for rank, (s, _, _, i) in enumerate(sorted(found, key=lambda x: x[:3])[:limit], 1)]
    return sorted(out, key=str)


@pytest.mark.parametrize("shard, first, block, limit", [(8192, 16, 50_000, 5), (7, 1, 6, 5), (40, 2, 20, 3), (8192, 16, 50_000, 500)])
def test_search(spark, monkeypatch, shard, first, block, limit):
    monkeypatch.setattr(lexical_search, "SHARD_ROWS", shard)
    monkeypatch.setattr(lexical_search, "FIRST_READ", first)
    monkeypatch.setattr(lexical_search, "BLOCK_TERMS", block)
    rnd = random.Random(8)
    words = [f"w{int(rnd.paretovariate(0.6))}" for _ in range(400)] + ["É", "e9", "the", "The"] * 20
    docs = [(i, " ".join(rnd.choices(words, k=rnd.randrange(0, 30)))) for i in range(150)]
    docs += [(500 + i, docs[3][1]) for i in range(20)] + [(7, docs[7][1]), (None, docs[9][1]), (600, None), (601, ""), (602, " .,; "), (603, "the " * 20_000)]
    items = [(i, " ".join(rnd.choices(words, k=rnd.randrange(1, 14)))) for i in range(12)] + [(20, None), (21, "nowhere"), (22, docs[3][1]), (22, docs[3][1])]
    got = lexical_search.search(spark, spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"),
                                limit=limit).select("item_id", "rank", "doc_id", "score").collect()
    assert sorted(map(tuple, got), key=str) == plain_search(docs, items, limit)


def test_search_stops_early():
    """Lists are left before their end, and reading on positions seen by direct access moves the best positions."""
    import pyarrow as pa

    n, vocabulary = 4000, 2
    codes = [np.arange(vocabulary, dtype=np.int32).tobytes()] * n
    tf = [np.array([n - i, n - i], np.int32).tobytes() for i in range(n)]                # both lists in the same order
    batch = pa.record_batch([pa.array(range(n)), pa.array(range(n)), pa.array([50] * n), pa.array(codes, pa.binary()), pa.array(tf, pa.binary())],
                            ["row", "id", "n", "codes", "tf"])
    shard = lexical_search.Shard(batch, np.array([10, 10]), n, 50 * n)
    read = []
    best = lexical_search.Best(10)
    original = np.unique
    try:
        lexical_search.np.unique = lambda x, *a, **k: read.append(len(x)) or original(x, *a, **k)
        shard.search(np.array([0, 1]), best)
    finally:
        lexical_search.np.unique = original
    assert best.id.tolist() == list(range(10)) and sum(read) < n / 10


def plain_links(rows, threshold):
    """rows: (id, vector)."""
    def fine(v):
        return v and all(x is not None and math.isfinite(x) for x in v) and any(v)
    links, least = defaultdict(set), list(range(len(rows)))
    for a, (_, v) in enumerate(rows):
        for b, (_, w) in enumerate(rows[:a]):
            if fine(v) and fine(w) and len(v) == len(w):
                x, y = np.array(v, float), np.array(w, float)
                x, y = x / np.abs(x).max(), y / np.abs(y).max()
                if x @ y / (math.sqrt(x @ x) * math.sqrt(y @ y)) >= threshold:
                    links[a].add(b)
                    links[b].add(a)
    changed = True
    while changed:
        changed = False
        for a, bs in links.items():
            m = min([least[a], *(least[b] for b in bs)])
            changed |= m != least[a]
            least[a] = m
    groups = defaultdict(list)
    for i, g in enumerate(least):
        groups[g].append(rows[i][0])
    out = []
    for i, (v, _) in enumerate(rows):
        c = min((x for x in groups[least[i]] if x is not None), default=None)
        out.append((v, len(links[i]), c, v is not None and v == c))
    return sorted(out, key=str)


@pytest.mark.parametrize("tile, pivots, broadcast", [(2048, 2048, 1_000_000), (16, 2048, 1_000_000), (8, 3, 0), (64, 1, 0)])
def test_embedding_links(spark, monkeypatch, tile, pivots, broadcast):
    monkeypatch.setattr(embedding_dedup, "TILE", tile)
    monkeypatch.setattr(embedding_dedup, "MAX_PIVOTS", pivots)
    monkeypatch.setattr(embedding_dedup, "MAX_BROADCAST", broadcast)
    rnd = np.random.default_rng(5)
    rows = []
    for c in range(12):
        centre = rnd.normal(size=8)
        rows += [(len(rows) + i, (centre + rnd.normal(size=8) * rnd.choice([0.05, 0.3, 0.6])).tolist()) for i in range(15)]
    rows += [(1000 + i, rows[4][1]) for i in range(9)] + [(2000, [3.5 * x for x in rows[4][1]]), (3, rows[3][1]), (None, rows[30][1])]
    rows += [(3000 + i, rnd.normal(size=5).tolist()) for i in range(6)] + [(3100, rows[-1][1])]
    nan, inf = float("nan"), float("inf")
    rows += [(4000, None), (4001, []), (4002, [0.0] * 8), (4003, [nan] + [1.0] * 7), (4004, [inf] + [1.0] * 7), (4005, [1.0] * 8), (4006, [1e-200] * 8),
             (4007, [1e300] * 8), (4008, [1.0] * 7 + [None]), (4009, [nan] + [1.0] * 7), (None, None)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = [tuple(r) for r in embedding_dedup.near_duplicates(spark, df).collect()]
    assert sorted(got, key=str) == plain_links(rows, 0.9)


def test_quantisation_bounds_hold():
    rnd = np.random.default_rng(1)
    x = embedding_dedup.unit(np.concatenate([rnd.normal(size=(300, 24)), rnd.normal(size=(50, 24)) ** 9]))
    q, scale, error = embedding_dedup.quantised(x)
    g = embedding_dedup.integers(q) @ embedding_dedup.integers(q).T
    assert (g == q.astype(int) @ q.astype(int).T).all()
    about = g * scale[:, None] * scale[None, :]
    assert (np.abs(x @ x.T - about) <= error[:, None] + error[None, :] + error[:, None] * error[None, :]).all()


def test_odd_and_empty(spark, odd_docs):
    for df in (odd_docs, odd_docs.limit(0)):
        bench = spark.createDataFrame([(1, "one word5x5"), (None, "one"), (2, None)], "item_id long, text string")
        found = lexical_search.search(spark, df, bench).collect()
        assert (len(found) > 0) == (df is odd_docs)
        assert lexical_search.search(spark, df, bench.limit(0)).count() == 0
        assert divergence.audit(spark, df, min_docs=1).count() == 0             # every language has one source
        rows = divergence.audit(spark, df, source_col="doc_id", min_docs=1)
        assert (rows.count() > 0) == (df is odd_docs)
    e = spark.createDataFrame([], "vec_id long, embedding array<float>, class long, copies long")
    assert embedding_dedup.near_duplicates(spark, e).count() == 0
    e = spark.createDataFrame([(1, None, 1, 2), (2, [0.0], 1, 2)], e.schema)
    assert sorted(map(tuple, embedding_dedup.near_duplicates(spark, e).collect())) == [(1, 0, 1, True), (2, 0, 2, True)]
