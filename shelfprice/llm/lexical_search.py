"""Ranked lexical search with the Best Position Algorithm over impact lists.

1. One pass cuts the texts into terms and keeps, for each text, its length and its terms that the
   queries hold, with their occurrences.  That table is stored; the corpus totals and the terms'
   document counts are sums over it.
2. Each task deals its texts into shards of bounded size.  In a shard every query term has an impact
   list, its texts by descending impact.  For a query, the lists of its terms are read in parallel,
   some positions at a time; a text met for the first time is looked up in all other lists (direct
   access), which gives its whole score and the positions it has there.  The best position of a list
   is the end of its leading run of positions seen, by whatever access; no text unseen can
   have more in that list than what comes next.  These bounds add up to the threshold, which is
   tighter than that of the positions read last; reading stops once it is strictly below the score of the
   limit-th best text, so that texts of equal score are all met.  Scores found in a task's
   earlier shards count, so later shards stop sooner or are not read.
3. A task passes on ``limit`` texts of each query at most; ranking them is a window in two steps.

Queries come in blocks of about BLOCK_TERMS terms, so what is broadcast, and what the driver holds
of them, is bounded whatever their number; each block is a pass over the corpus.

A term's weight w is floor(1000 ln((2 N + 2) / (2 df + 1))) and its impact on a text of n terms
w * ((10**9 tf) div (1000 tf + 20 m)), m = 50 + (50 n N) div L: 64-bit integers, so scores do not
depend on the order of adding.  Terms are compared by 64-bit hashes.

Defined results: a null text has no term; a query without terms, or whose terms no text holds, has no
rows; repeated rows are ranked each, ties by id, null ids last; a repeated query row is answered each
time; empty tables give an empty result.  Ids of texts are read as long.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from .common import Hasher, chunks, drop_stored, lookup, stored, table

LIMIT = 50
BLOCK_TERMS = 50_000           # terms of the queries that are answered in one pass
SHARD_ROWS, SHARD_POSTINGS = 8192, 1 << 20
FIRST_READ = 16                # positions read of each list; doubled every time
SALTS = 16
ABSENT = -1

SEPARATORS = np.ones(256, bool)
for first, last in ((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF)):
    SEPARATORS[first:last + 1] = False

FOUND = pa.schema([("query", pa.int64()), ("score", pa.int64()), ("id", pa.int64()), ("row", pa.int64())])


def term_hashes(held: list[bytes], hasher: Hasher) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of the terms of some texts in order, where each text's begin, and the end)."""
    data = np.frombuffer(b" ".join(held) + b" ", np.uint8)
    edge = np.diff(np.concatenate([[1], SEPARATORS[data].view(np.int8), [1]]))
    start, end = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    offsets = np.cumsum([0] + [len(t) + 1 for t in held])
    return hasher.spans(hasher.prefix(data), start, end), np.searchsorted(start, offsets)


def query_terms(queries: DataFrame) -> DataFrame:
    """(query, terms) of rows (query, text): distinct term hashes."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hasher = Hasher(fold=True)
        for b in batches:
            out = []
            for _, held in chunks(b["text"]):
                h, at = term_hashes(held, hasher)
                out += [np.unique(h[i:j]).view(np.int64) for i, j in zip(at[:-1], at[1:])]
            yield pd.DataFrame({"query": b["query"], "terms": out})

    return queries.mapInPandas(run, "query long, terms array<long>")


def held_terms(docs: DataFrame, vocabulary) -> DataFrame:
    """(id, n, codes, tf) of rows (id, text): its number of terms, and of those in the broadcast ``vocabulary`` place and count."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, known = Hasher(fold=True), vocabulary.value
        for b in batches:
            n, codes, tf = [np.zeros(0, np.int64)], [], []
            for _, held in chunks(b.column("text").to_pylist()):
                h, at = term_hashes(held, hasher)
                n.append(np.diff(at))
                place, there = lookup(known, h)
                owner = np.repeat(np.arange(len(held), dtype=np.int64), n[-1])[there]
                each, count = np.unique(owner * len(known) + place[there], return_counts=True)
                cut = np.searchsorted(each, np.arange(1, len(held)) * len(known))
                codes += [(x % max(len(known), 1)).astype(np.int32).tobytes() for x in np.split(each, cut)]
                tf += [x.astype(np.int32).tobytes() for x in np.split(count, cut)]
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(np.concatenate(n)), pa.array(codes, pa.binary()), pa.array(tf, pa.binary())],
                                             ["id", "n", "codes", "tf"])

    return docs.mapInArrow(run, "id long, n long, codes binary, tf binary")


def ints(column) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.int32).astype(np.int64)


def document_counts(held: DataFrame, size: int) -> np.ndarray:
    """In how many texts each of ``size`` terms is."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(size, np.int64)
        for b in batches:
            df += np.bincount(ints(b.column("codes")), minlength=size)
        some = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(df[some])], ["code", "df"])

    out = np.zeros(size, np.int64)
    for r in held.select("codes").mapInArrow(run, "code long, df long").groupBy("code").agg(F.sum("df").alias("df")).toLocalIterator():
        out[r["code"]] = r["df"]
    return out


class Best:
    """The best texts of one query so far."""

    def __init__(self, limit: int):
        self.limit = limit
        self.score, self.no_id, self.id, self.row = np.zeros(0, np.int64), np.zeros(0, bool), np.zeros(0, np.int64), np.zeros(0, np.int64)

    @property
    def least(self) -> int:
        """Score that a text must reach; 0 while there is room."""
        return int(self.score[-1]) if len(self.score) == self.limit else 0

    def add(self, score, no_id, ids, row) -> None:
        score, no_id, ids, row = (np.concatenate(x) for x in ((self.score, score), (self.no_id, no_id), (self.id, ids), (self.row, row)))
        order = np.lexsort((row, ids, no_id, -score))[:self.limit]
        self.score, self.no_id, self.id, self.row = score[order], no_id[order], ids[order], row[order]


class Shard:
    """Impact lists of some texts."""

    def __init__(self, batch: pa.RecordBatch, weights: np.ndarray, texts: int, total: int):
        self.row = batch.column("row").to_numpy()
        ids = batch.column("id")
        self.no_id = ids.is_null().to_numpy(zero_copy_only=False)
        self.id = ids.fill_null(0).to_numpy()
        n = batch.column("n").to_numpy()
        m = 50 + (50 * n * texts) // max(total, 1)
        codes, tf = ints(batch.column("codes")), ints(batch.column("tf"))
        size = np.array([len(x) // 4 for x in batch.column("codes").to_pylist()], np.int64)
        doc = np.repeat(np.arange(len(n)), size)
        impact = weights[codes] * ((1_000_000_000 * tf) // (1000 * tf + 20 * m[doc]))
        some = impact > 0
        codes, doc, impact = codes[some], doc[some], impact[some]
        order = np.lexsort((-impact, codes))
        codes, self.doc, self.impact = codes[order], doc[order], impact[order]
        self.start = np.searchsorted(codes, np.arange(len(weights) + 1))

    def search(self, terms: np.ndarray, best: Best) -> None:
        """Best position algorithm over the lists of ``terms``."""
        lists = [(int(a), int(b)) for a, b in zip(self.start[terms], self.start[terms + 1]) if a < b]
        if not lists or best.least > sum(int(self.impact[a]) for a, _ in lists):
            return
        size = np.array([b - a for a, b in lists])
        begin = np.concatenate([[0], np.cumsum(size)])
        doc = np.concatenate([self.doc[a:b] for a, b in lists])
        impact = np.concatenate([self.impact[a:b] for a, b in lists] + [[0]])         # its last entry is that of an absent text
        place = np.full((len(lists), len(self.row)), len(doc), np.int64)              # direct access: where a text is in each list
        place[np.repeat(np.arange(len(lists)), size), doc] = np.arange(len(doc))
        seen = np.zeros(len(doc) + 1, bool)
        met = np.zeros(len(self.row), bool)
        front = begin[:-1].copy()                                                     # first position of each list not seen yet
        found, scores, top = [], [], best.score
        read, step = 0, FIRST_READ
        while True:
            fresh = np.unique(np.concatenate([doc[a + read:min(a + read + step, b)] for a, b in zip(begin[:-1], begin[1:])]))
            fresh = fresh[~met[fresh]]
            read, step = read + step, 2 * step
            if len(fresh):
                met[fresh] = True
                at = place[:, fresh]
                score = impact[at].sum(0)
                seen[at] = True
                found.append(fresh)
                scores.append(score)
                top = np.concatenate([top, score])
                if len(top) > best.limit:
                    top = np.partition(top, -best.limit)[-best.limit:]
            threshold = 0
            for i, end in enumerate(begin[1:]):
                a = front[i]
                while a < end and seen[a]:                    # the run of positions seen grows
                    run = seen[a:min(a + 1024, end)]
                    a += len(run) if run.all() else int(run.argmin())
                front[i] = a
                if a < end:
                    threshold += int(impact[a])
            if threshold == 0 or len(top) >= best.limit and threshold < top.min():
                break
        docs, score = np.concatenate(found), np.concatenate(scores)
        enough = score >= max(best.least, 1)
        if len(top) >= best.limit:
            enough &= score >= top.min()
        docs, score = docs[enough], score[enough]
        best.add(score, self.no_id[docs], self.id[docs], self.row[docs])


def search_shards(shared, limit: int):
    """Over rows (row, id, n, codes, tf): the best texts of each query in the task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, queries, texts, total = shared.value
        best = {q: Best(limit) for q, _ in queries}
        for batch in batches:
            size = np.cumsum([len(x) // 4 for x in batch.column("codes").to_pylist()])
            at = 0
            while at < len(batch):
                before = size[at - 1] if at else 0
                to = min(at + SHARD_ROWS, max(at + 1, int(np.searchsorted(size, before + SHARD_POSTINGS, side="right"))))
                shard = Shard(batch.slice(at, to - at), weights, texts, total)
                for q, terms in queries:
                    shard.search(terms, best[q])
                at = to
        for q, b in best.items():
            if len(b.score):
                yield pa.record_batch([pa.array(np.full(len(b.score), q)), pa.array(b.score),
                                       pa.array(b.id, mask=b.no_id), pa.array(b.row)], schema=FOUND)
    return run


def ranked(found: DataFrame, limit: int) -> DataFrame:
    order = [F.desc("score"), F.asc_nulls_last("id"), "row"]
    some = found.withColumn("r", F.row_number().over(Window.partitionBy("query", F.pmod(F.xxhash64("row"), F.lit(SALTS))).orderBy(*order)))
    some = some.filter(F.col("r") <= limit).drop("r")
    return some.withColumn("rank", F.row_number().over(Window.partitionBy("query").orderBy(*order))).filter(F.col("rank") <= limit)


def search(spark: SparkSession, docs: DataFrame, queries: DataFrame, id_col="doc_id", text_col="text", query_col="item_id",
           query_text="text", limit=LIMIT) -> DataFrame:
    """(query's id, rank, id, score): the ``limit`` best texts of each query row."""
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    asked = stored(spark, queries.select(F.col(query_col).alias("item"), F.col(query_text).alias("text")).withColumn(
        "query", F.monotonically_increasing_id()), "queries")
    terms = stored(spark, query_terms(asked.select("query", "text")), "query-terms")
    blocks = -(-(terms.agg(F.sum(F.size("terms"))).first()[0] or 0) // BLOCK_TERMS)
    out = spark.createDataFrame([], "query long, score long, id long, row long, rank int")
    for block in range(blocks):
        rows = terms.filter((F.pmod(F.xxhash64("query"), F.lit(blocks)) == block) & (F.size("terms") > 0)).collect()
        hashes = [np.array(r["terms"], np.int64).view(np.uint64) for r in rows]
        vocabulary = np.unique(np.concatenate(hashes)) if hashes else np.zeros(0, np.uint64)
        known = spark.sparkContext.broadcast(vocabulary)
        held = stored(spark, held_terms(texts, known).withColumn("row", F.monotonically_increasing_id()), "held")
        some, total = held.agg(F.count(F.when(F.col("n") > 0, 1)), F.coalesce(F.sum("n"), F.lit(0))).first()
        df = document_counts(held, len(vocabulary))
        weights = np.array([math.floor(1000 * math.log((2 * some + 2) / (2 * int(x) + 1))) for x in df], np.int64)
        asking = [(r["query"], lookup(vocabulary, h)[0]) for r, h in zip(rows, hashes)]
        shared = spark.sparkContext.broadcast((weights, asking, some, total))
        found = held.mapInArrow(search_shards(shared, limit), "query long, score long, id long, row long")
        best = stored(spark, ranked(stored(spark, found, "found"), limit), "best")
        known.destroy()
        shared.destroy()
        drop_stored(spark, held)
        out = best if blocks == 1 else out.unionByName(best)
    return out.join(asked.select("query", "item"), "query").select(F.col("item").alias(query_col), "rank", F.col("id").alias(id_col), "score")


def op12_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


ORACLE = """
with t as (select row_number() over () as r, doc_id, regexp_extract_all(translate(coalesce(text, ''),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') as w from documents),
s as (select count(*) as docs, sum(len(w))::bigint as l from t where len(w) > 0),
b as (select row_number() over () as q, item_id, list_distinct(regexp_extract_all(translate(coalesce(text, ''),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) as w from benchmark),
q as (select q, item_id, unnest(w) as term from b),
o as (select r, doc_id, n, term, count(*) as tf from (select r, doc_id, len(w) as n, unnest(w) as term from t)
    where term in (select term from q) group by all),
f as (select term, floor(1000 * ln((2 * any_value(docs) + 2)::double / (2 * count(*) + 1)::double))::bigint as w from o, s group by term),
i as (select r, doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * n * docs) // l))) as impact
    from o join f using (term), s),
x as (select q, item_id, r, doc_id, sum(impact)::bigint as score from q join i using (term) group by all having sum(impact) > 0),
k as (select *, (row_number() over (partition by q order by score desc, doc_id, r))::int as rank from x)
select item_id, rank, doc_id, score from k where rank <= 50"""
