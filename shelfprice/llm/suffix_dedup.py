"""Suffix-array dedup: every byte covered by a LENGTH-byte string that also starts elsewhere goes.

A suffix array over a corpus is cut into parts that can be sorted alone.  In every window of
LENGTH bytes the smallest hash of its ANCHOR-byte substrings is an anchor, so equal windows
have equal anchors at equal places, and only suffixes that start at anchors need sorting: the
suffixes of one anchor are one stretch of the suffix array.

Each occurrence of an anchor has a context: the bytes around it that windows holding it can
reach.  Occurrences are counted by anchor; those alone go.  Equal contexts are one, and
if there are several of them all their windows repeat.  For an anchor with different contexts
the right contexts are sorted, common prefixes of neighbours give the tree of common-prefix
intervals by a stack scan, and in every interval of depth r the members are ordered by what
lies to the left: members whose left extensions agree for LENGTH - r bytes or more, though they
may not be neighbours in the suffix array, are a repeat, which covers both from the left
extension's end to depth r.  Anchors with more than MAX_CONTEXTS contexts are not gathered: their
windows are hashed whole, grouped, and those that occur twice cover their bytes; the result is
the same.

Passages of more than 50 words can be shorter than LENGTH bytes.  ``passages`` finds those that also stand in another
text within what is left, by words: every window of WORDS words has the smallest hash of its SEED-word runs
as its seed; seeds that stand in one text only go, and the windows of the others are hashed whole and grouped.

Defined results: a null text is empty; matches never cross texts, overlaps count, and what
repeats is judged on the input; repeated rows repeat each other; texts shorter than LENGTH lose
nothing; an empty table gives an empty result.  Texts are told apart by 128 bits of hash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import CHUNK_BYTES, Hasher, U, Words, chunks, drop_stored, lookup, mix64, powers, stored, table, utf8

LENGTH, ANCHOR = 400, 128
WORDS, SEED = 51, 16
MAX_CONTEXTS = 16_384          # about 11 MB of contexts; sorted in one task


def window_min(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of every w consecutive values, from minima of 1, 2, 4 and more of them."""
    n, k = len(x) - w + 1, 1
    while 2 * k <= w:
        x = np.minimum(x[:-k], x[k:])
        k *= 2
    return np.minimum(x[:n], x[w - k:w - k + n])


def anchors(c: np.ndarray, owner: np.ndarray, hasher: Hasher, length: int, anchor: int) -> tuple[np.ndarray, np.ndarray]:
    """(places, hashes): substrings that are the smallest of some window; ``owner`` is the text of each byte, and no window spans two."""
    size = len(owner)
    if size < length:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    start = np.arange(size - anchor + 1)
    h = hasher.spans(c, start, start + anchor)
    w = length - anchor + 1
    least = window_min(h, w)                                       # of the windows, by their start
    least[owner[:size - length + 1] != owner[length - 1:]] = 0
    # a place is taken if the largest of the minima over it is its own hash
    edge = np.full(w - 1, np.iinfo(np.uint64).max, np.uint64)
    over = ~window_min(np.concatenate([edge, ~least, edge]), w)
    at = np.flatnonzero(over == h)
    return at, h[at]


def occurrences(docs: DataFrame, length: int, anchor: int) -> DataFrame:
    """(a, x, k1, k2, at, left, right): anchor and context hashes of every anchor in rows (k1, k2, text)."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hasher, reach = Hasher(fold=False), length - anchor
        for b in batches:
            k1, k2 = b["k1"].to_numpy(), b["k2"].to_numpy()
            for first, held in chunks(b["text"]):
                sizes = np.array([len(t) for t in held])
                edges, owner = np.concatenate([[0], np.cumsum(sizes)]), np.repeat(np.arange(len(held)), sizes)
                c = hasher.prefix(np.frombuffer(b"".join(held), np.uint8))
                at, h = anchors(c, owner, hasher, length, anchor)
                if not len(at):
                    continue
                own = owner[at]
                lo, hi = np.maximum(at - reach, edges[own]), np.minimum(at + length, edges[own + 1])
                x = mix64(hasher.spans(c, lo, hi) + U(3) * hasher.spans(c, at, hi))
                yield pd.DataFrame({"a": h.view(np.int64), "x": x.view(np.int64), "k1": k1[first + own], "k2": k2[first + own],
                                    "at": at - edges[own], "left": at - lo, "right": hi - at})

    return docs.mapInPandas(run, "a long, x long, k1 long, k2 long, at int, left int, right int")


def agree(x: np.ndarray, y: np.ndarray) -> int:
    """Length of the common prefix."""
    n = min(len(x), len(y))
    differ = np.flatnonzero(x[:n] != y[:n])
    return int(differ[0]) if len(differ) else n


def intervals(lcp: list[int]) -> Iterator[tuple[int, int, int]]:
    """(depth, first, last) of the common-prefix intervals; lcp[i] is that of members i and i + 1."""
    stack: list[tuple[int, int]] = []
    for i, depth in enumerate([*lcp, 0]):
        first = i
        while stack and stack[-1][0] > depth:
            d, first = stack.pop()
            yield d, first, i
        if depth and (not stack or stack[-1][0] < depth):
            stack.append((depth, first))


def repeat_extents(contexts: list[bytes], lefts: list[int], length: int) -> np.ndarray:
    """For each of an anchor's distinct contexts how far to the left and right it repeats in another.

    All repeats hold the anchor, so together they cover one stretch; (0, 0) without any.
    """
    n = len(contexts)
    data = [np.frombuffer(c, np.uint8) for c in contexts]
    if n == 2:                                         # most anchors: what the two share on either side
        (p, q), (x, y) = lefts, data
        back, depth = agree(x[:p][::-1], y[:q][::-1]), agree(x[p:], y[q:])
        return np.full((2, 2), (back, depth) if back + depth >= length else (0, 0), np.int64)
    order = sorted(range(n), key=lambda i: contexts[i][lefts[i]:])
    right = [data[i][lefts[i]:] for i in order]
    lcp = [agree(x, y) for x, y in zip(right, right[1:])]
    back = [contexts[i][:lefts[i]][::-1] for i in range(n)]
    by_left = sorted(range(n), key=back.__getitem__)
    left = [np.frombuffer(back[i], np.uint8) for i in by_left]
    shared = np.array([agree(x, y) for x, y in zip(left, left[1:])])
    rank = np.empty(n, np.int64)
    rank[by_left] = np.arange(n)
    rank = rank[order]
    reach = np.zeros((n, 2), np.int64)                 # by rank from the left
    for depth, first, last in intervals(lcp):
        members = np.sort(rank[first:last + 1])
        # what two members that follow each other from the left share there: the least in between
        common = np.minimum.reduceat(shared[:members[-1]], members[:-1])
        ok = common + depth >= length
        if ok.any():
            for side in (members[:-1][ok], members[1:][ok]):
                reach[side, 0] = np.maximum(reach[side, 0], common[ok])
                reach[side, 1] = np.maximum(reach[side, 1], depth)
    out = np.empty_like(reach)
    out[by_left] = reach
    return out


def extents_by_sorting(contexts: DataFrame, length: int) -> DataFrame:
    """(a, x, lo, hi) around the anchor, of rows (a, x, left, context); a whole anchor is one unit."""
    def solve(b: pd.DataFrame) -> pd.DataFrame:
        a, contexts, lefts = b["a"].to_numpy(), b["context"].tolist(), b["left"].tolist()
        edges = [0, *(np.flatnonzero(a[1:] != a[:-1]) + 1), len(a)]
        reach = np.concatenate([repeat_extents(contexts[s:e], lefts[s:e], length) for s, e in zip(edges, edges[1:])])
        ok = reach[:, 1] > 0
        return pd.DataFrame({"a": a[ok], "x": b["x"].to_numpy()[ok], "lo": -reach[ok, 0], "hi": reach[ok, 1]})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None                                    # the anchor that the last batch ended in
        for b in batches:
            b = b if held is None else pd.concat([held, b], ignore_index=True)
            ended = np.flatnonzero(b["a"].to_numpy() != b["a"].iloc[-1])
            edge = int(ended[-1]) + 1 if len(ended) else 0
            if edge:
                yield solve(b.iloc[:edge])
            held = b.iloc[edge:]
        if held is not None and len(held):
            yield solve(held)

    return contexts.repartition("a").sortWithinPartitions("a").mapInPandas(run, "a long, x long, lo int, hi int")


def extents_by_windows(contexts: DataFrame, length: int) -> DataFrame:
    """The same, of anchors with too many contexts to gather: windows that occur in two contexts."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hasher = Hasher(fold=False)
        for b in batches:
            for a, x, left, context in zip(b["a"], b["x"], b["left"], b["context"]):
                data = np.frombuffer(context, np.uint8)
                start = np.arange(max(0, len(data) - length + 1))
                h = hasher.spans(hasher.prefix(data), start, start + length)
                h2 = mix64(h ^ (left - start).astype(np.uint64))
                yield pd.DataFrame({"a": a, "x": x, "lo": start - left, "w": h2.view(np.int64)})

    windows = contexts.mapInPandas(run, "a long, x long, lo int, w long")
    twice = windows.groupBy("a", "w").agg(F.count("*").alias("n")).filter("n > 1")
    return windows.join(twice, ["a", "w"]).groupBy("a", "x").agg(F.min("lo").alias("lo"), (F.max("lo") + length).alias("hi"))


def repeat_spans(spark: SparkSession, rows: DataFrame, length=LENGTH, anchor=ANCHOR, max_contexts=MAX_CONTEXTS) -> DataFrame:
    """(k1, k2, spans), stored: byte spans that repeat, not yet merged, of rows (k1, k2, text).

    What a step stores goes as soon as the last step that reads it is stored.
    """
    occ = stored(spark, occurrences(rows, length, anchor), "occurrences")
    # all that is summed here are longs: partial sums shrink copies before the shuffle
    by_anchor = stored(spark, occ.groupBy("a").agg(F.count("*").alias("n"), F.min("x").alias("lo"), F.max("x").alias("hi"))
                       .filter("n > 1").select("a", (F.col("lo") < F.col("hi")).alias("varied")), "anchors")
    several = stored(spark, occ.join(by_anchor, "a"), "several")
    drop_stored(spark, occ, by_anchor)
    by_context = stored(spark, several.groupBy("a", "x").agg(
        F.count("*").alias("n"), F.first("varied").alias("varied"), F.first("k1").alias("k1"), F.first("k2").alias("k2"),
        F.first("at").alias("at"), F.first("left").alias("left"), F.first("right").alias("right")), "contexts")
    whole = by_context.filter((F.col("n") > 1) & (F.col("left") + F.col("right") >= length)).select(
        "a", "x", (-F.col("left")).alias("lo"), F.col("right").alias("hi"))
    # one text of each context gives its bytes
    wanted = by_context.filter("varied").groupBy("k1", "k2").agg(F.collect_list(F.struct("a", "x", "at", "left", "right")).alias("want"))

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            held, size = [], 0
            for text, a, x, at, left, right in zip(*(b[c] for c in ("text", "a", "x", "at", "left", "right"))):
                data = utf8(text)
                held.append((a, x, left, [data[p - lo:p + hi] for p, lo, hi in zip(at, left, right)]))
                size += len(at)
                if size > 1 << 13:
                    yield frame(held)
                    held, size = [], 0
            if held:
                yield frame(held)

    def frame(held) -> pd.DataFrame:
        """One for many texts: making a frame takes longer than cutting a text."""
        a, x, left, context = zip(*held)
        return pd.DataFrame({"a": np.concatenate(a), "x": np.concatenate(x), "left": np.concatenate(left),
                             "context": [c for each in context for c in each]})

    wanted = stored(spark, wanted, "wanted")
    texts = rows.join(wanted, ["k1", "k2"]).select("text", *[F.col("want")[c].alias(c) for c in ("a", "x", "at", "left", "right")])
    cuts = stored(spark, texts.mapInPandas(cut, "a long, x long, left int, context binary")
                  .groupBy("a", "x").agg(F.first("left").alias("left"), F.first("context").alias("context")), "cuts")
    drop_stored(spark, wanted)
    crowded = stored(spark, cuts.groupBy("a").agg(F.count("*").alias("n")).filter(F.col("n") > max_contexts).select("a"), "crowded")
    extents = stored(spark, whole.unionByName(extents_by_sorting(cuts.join(crowded, "a", "left_anti"), length))
                     .unionByName(extents_by_windows(cuts.join(crowded, "a"), length)), "extents")
    drop_stored(spark, by_context, cuts, crowded)
    spans = several.join(extents, ["a", "x"]).select("k1", "k2", F.struct(
        (F.col("at") + F.col("lo")).alias("start"), (F.col("at") + F.col("hi")).alias("end")).alias("span")).distinct()
    out = stored(spark, spans.groupBy("k1", "k2").agg(F.collect_list("span").alias("spans")), "spans")
    drop_stored(spark, several, extents)
    return out


def merged(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Spans joined where they touch or overlap."""
    order = np.argsort(start, kind="stable")
    start, reach = start[order], np.maximum.accumulate(end[order])
    first = np.flatnonzero(np.concatenate([[True], start[1:] > reach[:-1]]))
    return start[first], np.append(reach[first[1:] - 1], reach[-1])


def dedup(spark: SparkSession, docs: DataFrame, id_col="doc_id", text_col="text", **options) -> DataFrame:
    """(id, n_bytes, removed, kept) of every row: the spans removed, merged, and the bytes left."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), text.alias("text"), F.xxhash64(text).alias("k1"), F.xxhash64(F.lit(8), text).alias("k2"))
    spans = repeat_spans(spark, rows.select("k1", "k2", "text"), **options)

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            sizes, removed, kept = [], [], []
            for text, start, end in zip(b["text"], b["start"], b["end"]):
                data, at, left = utf8(text), 0, []
                sizes.append(len(data))
                if start is None:
                    removed.append([])
                    kept.append(data)
                    continue
                gone = list(zip(*(x.tolist() for x in merged(start, end))))
                for s, e in gone:
                    left.append(data[at:s])
                    at = e
                removed.append([{"start": s, "end": e} for s, e in gone])
                kept.append(b"".join([*left, data[at:]]))
            yield pd.DataFrame({"id": b["id"], "n_bytes": sizes, "removed": removed, "kept": kept})

    kind = rows.schema["id"].dataType.simpleString()
    return rows.join(spans, ["k1", "k2"], "left").select(
        "id", "text", F.col("spans")["start"].alias("start"), F.col("spans")["end"].alias("end")).mapInPandas(
        cut, f"id {kind}, n_bytes long, removed array<struct<start:int,end:int>>, kept binary")


def word_windows(rows: list[tuple[bytes, list[int]]], hasher: Hasher, words: int, seed: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(number of its first word, seed, hash) of every window of ``words`` words, for each row (text, its cuts); none spans a cut."""
    pieces, texts = [], np.zeros(len(rows) + 1, np.int64)          # texts: the first piece of each row
    for i, (kept, cuts) in enumerate(rows):
        pieces += [kept[a:b] for a, b in zip([0, *cuts], [*cuts, len(kept)])]
        texts[i + 1] = len(pieces)
    found = Words(pieces, hasher)
    h, bounds = mix64(found.hash), found.bounds
    # words are numbered in their text, with a gap at every cut
    gaps = bounds[:-1] + np.arange(len(pieces))
    number = gaps - np.repeat(gaps[texts[:-1]], np.diff(texts))
    if len(h) >= len(hasher.pow):
        hasher.pow, hasher.inv = powers(2 * len(h) + 2)
    c = np.concatenate([np.zeros(1, np.uint64), np.cumsum(h * hasher.pow[:len(h)], dtype=np.uint64)])
    runs = [mix64((c[k:] - c[:-k]) * hasher.inv[:max(len(c) - k, 0)] + U(k)) for k in (seed, words)]
    least = window_min(runs[0], words - seed + 1) if len(runs[1]) else runs[1]
    piece = np.repeat(np.arange(len(pieces)), np.diff(bounds))[:len(runs[1])]
    whole = np.flatnonzero(np.arange(len(runs[1])) + words <= bounds[1:][piece])
    piece = piece[whole]
    at = whole - bounds[piece] + number[piece]
    edges = np.searchsorted(piece, texts)
    for a, b in zip(edges[:-1], edges[1:]):
        yield at[a:b], least[whole[a:b]], runs[1][whole[a:b]]


def passages(spark: SparkSession, found: DataFrame, words=WORDS, seed=SEED) -> DataFrame:
    """(row, n): runs of ``words`` words or more, as long as can be, that another row of the stored ``found`` (row, removed,
    kept) holds too, within what is left of the texts."""
    def windows(b: pd.DataFrame):
        hasher, rows = Hasher(fold=True), []
        for removed, kept in zip(b["removed"], b["kept"]):
            cuts, gone = [], 0
            for s in removed:
                cuts.append(s["start"] - gone)
                gone += s["end"] - s["start"]
            rows.append((kept, cuts))
        at = 0
        while at < len(rows):                              # texts of CHUNK_BYTES together, or a longer one
            end, size = at + 1, len(rows[at][0])
            while end < len(rows) and size + len(rows[end][0]) <= CHUNK_BYTES:
                size += len(rows[end][0])
                end += 1
            yield from ((row, *found) for row, found in zip(b["row"].iloc[at:end], word_windows(rows[at:end], hasher, words, seed)))
            at = end

    def seeds(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            each = [(row, np.unique(s)) for row, _, s, _ in windows(b)]
            yield pd.DataFrame({"row": np.repeat([r for r, _ in each], [len(s) for _, s in each]).astype(np.int64),
                                "seed": np.concatenate([np.zeros(0, np.uint64), *[s for _, s in each]]).view(np.int64)})

    def chosen(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for (row, at, s, w), mine in zip(windows(b), b["seeds"]):
                ok = lookup(np.sort(np.asarray(mine, np.int64).view(np.uint64)), s)[1]
                yield pd.DataFrame({"row": row, "at": at[ok], "w": w[ok].view(np.int64)})

    def elsewhere(rows: DataFrame, key: str) -> DataFrame:
        """Keys that more than one row has."""
        return rows.groupBy(key).agg(F.min("row").alias("lo"), F.max("row").alias("hi")).filter("lo < hi").select(key)

    every = stored(spark, found.select("row", "removed", "kept").mapInPandas(seeds, "row long, seed long"), "seeds")
    shared = stored(spark, elsewhere(every, "seed"), "shared-seeds")
    mine = stored(spark, every.join(shared, "seed").groupBy("row").agg(F.collect_list("seed").alias("seeds")), "seeds-of")
    drop_stored(spark, every, shared)
    some = stored(spark, found.select("row", "removed", "kept").join(mine, "row").mapInPandas(
        chosen, "row long, at long, w long"), "windows")
    drop_stored(spark, mine)
    hit = some.join(stored(spark, elsewhere(some, "w"), "shared-windows"), "w").groupBy("row").agg(
        F.array_sort(F.collect_list("at")).alias("at"))
    starts = F.filter("at", lambda p, i: (i == 0) | (p != F.get("at", i - 1) + 1))
    return hit.select("row", F.size(starts).cast("long").alias("n"))


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Beside the contract's columns ``n_passages``: maximal removed runs, and runs of more than 50 words in what is left that stand
    in another document too."""
    found = stored(spark, dedup(spark, table(spark, sf_dir, "documents")).withColumn("row", F.monotonically_increasing_id()), "found")
    size = F.aggregate("removed", F.lit(0).cast("long"), lambda acc, s: acc + s["end"] - s["start"])
    spans = F.size("removed").cast("long")
    return found.join(passages(spark, found), "row", "left").select(
        F.col("id").alias("doc_id"), "n_bytes", size.alias("n_removed"), spans.alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"),
        (spans + F.coalesce("n", F.lit(0))).alias("n_passages"))
