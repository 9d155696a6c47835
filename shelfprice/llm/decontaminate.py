"""Benchmark decontamination: n-gram seeds, then Smith-Waterman alignment.

Test items are cut into word 3-grams, and every one of them is a seed: which of them an edit
leaves standing cannot be told from how rare they are.  One pass finds the seeds in every whole
text, joins neighbouring hits into windows, and aligns item and window word by word: 2 for a
match, -1 for a mismatch or gap.  The score over the score of an exact copy is the similarity; at
or above ``threshold`` the document holds a copy, edited or not.  A copy that keeps no three
words in a row is not found.

Common seeds cost little: a score at the threshold needs that share of the item's words within
the stretch a copy can span, and windows without it are not aligned.

Items are sent to the tasks in blocks of at most BLOCK_BYTES of text, one pass a block, so
what is broadcast has a fixed bound; the corpus is only mapped, never shuffled or paired.

Defined results: null and empty texts match nothing; an item of fewer than MIN_WORDS words,
too short to tell a leak within a text from chance, matches the texts that consist of just its words, by one hash of
all of them; an item without words matches nothing; repeated items and rows give repeated
results; empty tables give an empty result.  Case of A-Z is ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import Hasher, Words, chunks, lookup, shingle_hashes, table, utf8

N, MIN_WORDS = 3, 5
MATCH, MISMATCH, GAP = 2, -1, -1
THRESHOLD = 0.5
BLOCK_BYTES = 4 << 20
LEAK = "array<struct<item:int,similarity:double,start:int,end:int>>"


def align(item: np.ndarray, text: np.ndarray) -> tuple[int, int]:
    """Best local alignment: (score, index one past its last word of ``text``), row by row."""
    j = np.arange(len(text) + 1, dtype=np.int32)
    row, best, end = np.zeros(len(text) + 1, np.int32), 0, 0
    for word in item:
        fresh = np.zeros_like(row)
        fresh[1:] = np.maximum(row[:-1] + np.where(text == word, MATCH, MISMATCH), row[1:] + GAP)
        np.maximum(fresh, 0, out=fresh)
        row = np.maximum.accumulate(fresh - GAP * j) + GAP * j     # gaps along the text
        k = int(row.argmax())
        if row[k] > best:
            best, end = int(row[k]), k
    return best, end


class Items:
    """Word hashes of the items of one block and the index of their n-grams."""

    def __init__(self, texts: list | None = None, state: dict | None = None):
        if state is not None:            # as broadcast: plain arrays
            self.__dict__.update(state)
            return
        hasher = Hasher(fold=True)
        self.words = [Words([utf8(t)], hasher).hash for t in texts]
        grams, owners, places = [], [], []
        for i, w in enumerate(self.words):
            if len(w) >= MIN_WORDS:
                g = shingle_hashes(w, N)
                grams.append(g)
                owners.append(np.full(len(g), i))
                places.append(np.arange(len(g)))
        # short items by the hash of all their words, and where a key's items begin
        short = [(int(shingle_hashes(w, len(w))[0]), i) for i, w in enumerate(self.words) if 0 < len(w) < MIN_WORDS]
        self.short = {k: [i for x, i in short if x == k] for k, _ in short}
        cat = (lambda x, t: np.concatenate(x) if x else np.zeros(0, t))
        self.index(cat(grams, np.uint64), cat(owners, np.int64), cat(places, np.int64))

    def index(self, grams, owners, places) -> None:
        order = np.argsort(grams, kind="stable")
        self.grams, self.owners, self.places = grams[order], owners[order], places[order]
        self.keys, self.first = np.unique(self.grams, return_index=True)
        self.first = np.append(self.first, len(self.grams))

    def can_hold(self, owner: int, window: np.ndarray, threshold: float) -> bool:
        """Whether an alignment with ``window`` can reach the threshold: it must match that share
        of the item, and a copy that reaches it spans at most 2 * m words."""
        item = self.words[owner]
        m = len(item)
        among = np.cumsum(np.concatenate([[0], lookup(np.sort(item), window)[1]]))
        most = among[-1] if len(window) <= 2 * m else (among[2 * m:] - among[:-2 * m]).max()
        return bool(min(most, np.isin(item, window).sum()) >= threshold * m)

    def leaks(self, words: np.ndarray, threshold: float) -> list[tuple]:
        """(item, similarity, first word, one past the last) of the copies in a text."""
        if 0 < len(words) < MIN_WORDS and self.short:
            return [(i, 1.0, 0, len(words)) for i in self.short.get(int(shingle_hashes(words, len(words))[0]), ())
                    if len(self.words[i]) == len(words)]
        grams = shingle_hashes(words, N)
        at, hit = lookup(self.keys, grams)
        places = np.flatnonzero(hit)
        first, n = self.first[at[places]], self.first[at[places] + 1] - self.first[at[places]]
        owners = self.owners[np.repeat(first - np.cumsum(n) + n, n) + np.arange(n.sum())]
        places = np.repeat(places, n)
        order = np.lexsort((places, owners))
        owners, places = owners[order], places[order]
        edges = np.flatnonzero(np.diff(owners)) + 1
        found = zip(owners[np.append(0, edges)].tolist(), np.split(places, edges)) if len(owners) else ()
        out = []
        for owner, hits in found:
            item = self.words[owner]
            m, best = len(item), None
            hits = np.unique(hits)
            for window in np.split(hits, np.flatnonzero(np.diff(hits) > 2 * m) + 1):
                a, b = max(0, window[0] - 2 * m), window[-1] + 2 * m
                if not self.can_hold(owner, words[a:b], threshold):
                    continue
                score, end = align(item, words[a:b])
                if best is None or score > best[0]:
                    best = score, a, end
            if best is None:
                continue
            score, a, end = best
            if score >= threshold * MATCH * m:
                _, back = align(item[::-1], words[a:a + end][::-1])
                out.append((owner, score / (MATCH * m), int(a + end - back), int(a + end)))
        return sorted(out)


def item_blocks(items: DataFrame, item_col: str, text_col: str) -> Iterator[tuple[list, list]]:
    ids, texts, size = [], [], 0
    rows = items.select(F.col(item_col).alias("i"), F.col(text_col).alias("t")).filter("t is not null")
    for r in rows.orderBy("i", "t").toLocalIterator():
        if texts and size + len(r["t"]) > BLOCK_BYTES:
            yield ids, texts
            ids, texts, size = [], [], 0
        ids.append(r["i"])
        texts.append(r["t"])
        size += len(r["t"])
    if texts:
        yield ids, texts


def leak_finder(shared, threshold: float):
    @F.pandas_udf(LEAK)
    def leaks(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        hasher, block = Hasher(fold=True), Items(state=shared.value)
        for series in batches:
            out = []
            for _, held in chunks(series):
                w = Words(held, hasher)
                out += [block.leaks(w.hash[w.bounds[i]:w.bounds[i + 1]], threshold) for i in range(len(held))]
            yield pd.Series([[dict(zip(("item", "similarity", "start", "end"), x)) for x in r] for r in out])
    return leaks


def leak_columns(spark: SparkSession, docs: DataFrame, items: DataFrame, text_col="text", item_col="item_id",
                 item_text_col="text", threshold=THRESHOLD) -> Iterator[tuple]:
    """For every block of items: (their ids, column of the leaks found in each text)."""
    for ids, texts in item_blocks(items, item_col, item_text_col):
        block = Items(texts)
        if not len(block.keys) and not block.short:
            continue
        shared = spark.sparkContext.broadcast(vars(block))

        yield ids, leak_finder(shared, threshold)(F.col(text_col))


def contaminated(spark: SparkSession, docs: DataFrame, items: DataFrame, id_col="doc_id", text_col="text",
                 item_col="item_id", **options) -> DataFrame:
    """(id, item_id, similarity, start, end): every document with a copy of an item, by word positions."""
    out = None
    for ids, column in leak_columns(spark, docs, items, text_col, item_col, **options):
        rows = docs.select(F.col(id_col).alias("id"), F.explode(column).alias("leak"))
        names = F.broadcast(spark.createDataFrame(list(enumerate(ids)), ["item", "item_id"]))    # one block's ids
        rows = rows.select("id", "leak.*").join(names, "item").drop("item")
        out = rows if out is None else out.unionByName(rows)
    if out is None:
        out = docs.select(F.col(id_col).alias("id"), F.lit(None).cast("long").alias("item_id"),
                          F.lit(0.0).alias("similarity"), F.lit(0).alias("start"), F.lit(0).alias("end")).filter("false")
    return out.select("id", "item_id", "similarity", "start", "end")


def keep_clean(spark: SparkSession, docs: DataFrame, items: DataFrame, text_col="text", **options) -> DataFrame:
    """The rows of ``docs`` without a copy of any item, all columns as they are."""
    for _, column in list(leak_columns(spark, docs, items, text_col, **options)):
        docs = docs.filter(F.size(column) == 0)
    return docs


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contaminated(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.withColumnRenamed("id", "doc_id")
