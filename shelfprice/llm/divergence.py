"""Source divergence audit: how far the word use of a language's sources differs.

1. An Arrow compute pipeline inside mapInArrow counts terms: ascii_lower, split_pattern_regex,
   dictionary_encode, and two hash group_by (by text and term, then by group and term).  A task adds
   its slices up and passes on (lang, source, term, occurrences, texts), at most HELD rows at a time.
2. Partial counts are added up by shuffle; the terms that at least ``min_docs`` texts of a language
   hold are kept, by a window over the term's sources, and stored.
3. Columnar shards: a language's kept terms are dealt over shards by hash, its sources over blocks.
   A shard reads its terms in order, a bounded matrix of terms by sources at a time, adds up the
   divergences of the block's sources from all others and keeps each source's strongest terms.
   Shards are merged by sum and by rank.

A group is a source within a language.  With N occurrences of the V kept terms in a group, a term
that occurs c times there has p = 1 + floor(10**9 (c + 2) / (N + 2 V)); the same over the whole
language gives q.  The divergence of p from q at a term is floor((p - q)**2 / (p + q)).  All of it is
64-bit integer arithmetic: p is found by long division in steps of 1000, so counts may reach 10**15.

A hot source or term is a sum like any other; a language is spread over its shards.  What grows with
the square of a language's sources is the report itself, one row for each two of them.

Defined results: null text, lang and source are ''; repeated rows count each time; a text without
terms still makes its group occur; a language without kept terms has all divergences 0 and no term
rows; a language with one source has no pair rows; ties are ranked by the item's UTF-8 bytes; an
empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from .common import stored, table

SEPARATOR = r"[\x00-\x40\x5B-\x60\x7B-\x7F]+"   # all that is no term: ASCII but its letters
UNIT = 1_000_000_000
MIN_DOCS, TOP = 10, 10
SLICE_BYTES = 1 << 21          # texts that are counted at once
HELD = 1 << 17                 # partial counts a task adds up before it passes them on
SHARD_ROWS = 200_000           # kept counts in a shard
SOURCE_BLOCK = 256             # sources whose divergences a shard adds up
CELLS = 1 << 18                # terms by sources held at once

COUNTS = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.string()), ("n", pa.int64()), ("d", pa.int64())])
FOUND = pa.schema([("lang", pa.string()), ("source", pa.string()), ("part", pa.string()), ("item", pa.string()), ("value", pa.int64())])


def slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """``batch`` in runs of rows of up to SLICE_BYTES of text; a longer text comes alone, whole."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    at = 0
    while at < len(ends):
        start = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, start + SLICE_BYTES, side="right")))
        yield batch.slice(at, to - at)
        at = to


def count_slice(batch: pa.RecordBatch) -> pa.Table:
    """(lang, source, term, n, d) of some texts."""
    parts = pc.split_pattern_regex(pc.ascii_lower(batch.column("text")), SEPARATOR)
    terms = pc.list_flatten(parts)
    row = pc.list_parent_indices(parts)
    said = pc.not_equal(terms, "")                           # what is before a leading separator or after the last one
    terms, row = terms.filter(said), row.filter(said)
    code = pc.dictionary_encode(terms)
    each = pa.table({"row": row.cast(pa.int64()), "code": code.indices}).group_by(["row", "code"], use_threads=False).aggregate(
        [([], "count_all")])
    groups = pa.table({"lang": batch.column("lang"), "source": batch.column("source"), "row": np.arange(len(batch))}).group_by(
        ["lang", "source"], use_threads=False).aggregate([("row", "list")])
    rows_of = groups["row_list"].combine_chunks()
    of_row = np.empty(len(batch), np.int64)
    of_row[pc.list_flatten(rows_of).to_numpy()] = pc.list_parent_indices(rows_of).to_numpy()
    counted = pa.table({"group": of_row[each["row"].to_numpy()], "code": each["code"], "n": each["count_all"]}).group_by(
        ["group", "code"], use_threads=False).aggregate([("n", "sum"), ([], "count_all")])
    return pa.table([groups["lang"].take(counted["group"]), groups["source"].take(counted["group"]),
                     code.dictionary.take(counted["code"].combine_chunks()), counted["n_sum"], counted["count_all"]], schema=COUNTS)


def count_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def added(held: list[pa.Table]) -> pa.Table:
        out = pa.concat_tables(held).group_by(["lang", "source", "term"], use_threads=False).aggregate([("n", "sum"), ("d", "sum")])
        return pa.table(out.columns, schema=COUNTS)

    held, rows = [], 0
    for batch in batches:
        for part in slices(batch):
            held.append(count_slice(part))
            rows += len(held[-1])
            if rows > 2 * HELD:
                held = [added(held)]
                rows = len(held[0])
                if rows > HELD:
                    yield from held[0].to_batches()
                    held, rows = [], 0
                pa.default_memory_pool().release_unused()
    if held:
        yield from added(held).to_batches()
    del held
    pa.default_memory_pool().release_unused()


def share(count: np.ndarray, total: np.ndarray) -> np.ndarray:
    """1 + floor(UNIT * count / total), exactly, for count <= total < 9 * 10**15."""
    total = np.maximum(total, 1)
    out, rest = count // total, count % total
    for _ in range(3):
        rest = rest * 1000
        out, rest = out * 1000 + rest // total, rest % total
    return out + 1


def divergence(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    d = p - q
    return d * d // (p + q)


class Shard:
    """One language's terms of a shard against the sources of a block."""

    def __init__(self, lang: str, top: int):
        self.lang, self.limit_top, self.sources, self.terms, self.rows = lang, top, [], [], []
        self.matrix = None

    def begin(self) -> None:
        """After the shard's source rows (source, mine, total, kept terms) have come."""
        self.place = {s: i for i, (s, *_) in enumerate(self.sources)}
        self.mine = np.array([i for i, (_, m, *_) in enumerate(self.sources) if m], np.int64)
        self.total = np.array([t for *_, t, _ in self.sources], np.int64)
        self.v = int(self.sources[0][3])
        self.matrix = np.zeros((len(self.mine), len(self.sources)), np.int64)
        self.top: dict[int, list] = {int(i): [] for i in self.mine}
        self.limit = max(1, CELLS // len(self.sources))

    def add(self, term: str, source: str, n: int) -> None:
        if not self.terms or self.terms[-1] != term:
            if len(self.terms) == self.limit:
                self.settle()
            self.terms.append(term)
        self.rows.append((len(self.terms) - 1, self.place[source], n))

    def settle(self) -> None:
        """Adds up the terms at hand and forgets them."""
        if not self.terms:
            return
        at, source, n = np.array(self.rows, np.int64).T
        counts = np.zeros((len(self.terms), len(self.sources)), np.int64)
        counts[at, source] = n
        p = share(counts + 2, self.total + 2 * self.v)
        whole = share(counts.sum(1) + 2, self.total.sum() + 2 * self.v)
        names = np.array(self.terms, object)
        for row, s in enumerate(self.mine):
            self.matrix[row] += divergence(p[:, s:s + 1], p).sum(0)
            over = np.flatnonzero((counts[:, s] > 0) & (p[:, s] > whole))
            value = divergence(p[over, s], whole[over])
            if len(value) > self.limit_top:                   # ties at the last place all stay until they are ranked
                enough = value >= np.partition(value, -self.limit_top)[-self.limit_top]
                over, value = over[enough], value[enough]
            best = self.top[int(s)] + [(-int(f), names[t].encode(), names[t]) for t, f in zip(over, value)]
            self.top[int(s)] = sorted(best)[:self.limit_top]
        self.terms, self.rows = [], []

    def report(self) -> Iterator[pa.RecordBatch]:
        if self.matrix is None:                               # no kept term in this shard
            self.begin()
        self.settle()
        names = [s for s, *_ in self.sources]
        pairs = [(int(s), u, row) for row, s in enumerate(self.mine) for u in range(len(names)) if u != s]
        tops = [(int(s), item, -f) for s, best in self.top.items() for f, _, item in best]
        n = len(pairs) + len(tops)
        if n:
            yield pa.record_batch([
                pa.array([self.lang] * n, pa.string()),
                pa.array([names[s] for s, *_ in pairs] + [names[s] for s, *_ in tops], pa.string()),
                pa.array(["pair"] * len(pairs) + ["term"] * len(tops), pa.string()),
                pa.array([names[u] for _, u, _ in pairs] + [item for _, item, _ in tops], pa.string()),
                pa.array([int(self.matrix[row, u]) for _, u, row in pairs] + [f for *_, f in tops], pa.int64())], schema=FOUND)


def merge_shards(top: int):
    """Over rows (lang, shard, block, term, source, n, mine, total, v) in order; a shard's source rows, whose term is null, come first."""
    columns = ("lang", "shard", "block", "term", "source", "n", "mine", "total", "v")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, key = None, None
        for batch in batches:
            for lang, shard, block, term, source, n, mine, total, v in zip(*(batch.column(c).to_pylist() for c in columns)):
                if (lang, shard, block) != key:
                    if held is not None:
                        yield from held.report()
                    held, key = Shard(lang, top), (lang, shard, block)
                if term is None:
                    held.sources.append((source, mine, total, v))
                else:
                    if held.matrix is None:
                        held.begin()
                    held.add(term, source, n)
        if held is not None:
            yield from held.report()

    return run


def kept_counts(spark: SparkSession, docs: DataFrame, min_docs: int) -> DataFrame:
    """(lang, source, term, n), stored: occurrences of the kept terms."""
    # one exchange, by what the window groups by, serves the sum as well: a term's partial counts are some for each task and source
    counts = (docs.mapInArrow(count_terms, "lang string, source string, term string, n long, d long").repartition("lang", "term")
              .groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("d").alias("d")))
    texts = F.sum("d").over(Window.partitionBy("lang", "term"))
    return stored(spark, counts.withColumn("texts", texts).filter(F.col("texts") >= min_docs).select("lang", "source", "term", "n"), "kept")


def audit(spark: SparkSession, docs: DataFrame, text_col="text", lang_col="lang", source_col="source", min_docs=MIN_DOCS,
          top=TOP) -> DataFrame:
    """(lang, source, part, item, value, rank): each source against every other one of its language, and its strongest terms."""
    rows = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(a)
                         for c, a in ((text_col, "text"), (lang_col, "lang"), (source_col, "source"))])
    kept = kept_counts(spark, rows, min_docs)
    terms = kept.groupBy("lang", "term").agg(F.lit(1)).groupBy("lang").agg(F.count("*").alias("v"))
    totals = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = stored(spark, rows.select("lang", "source").distinct().join(totals, ["lang", "source"], "left").join(terms, "lang", "left")
                    .select("lang", "source", F.coalesce("total", F.lit(0)).alias("total"), F.coalesce("v", F.lit(0)).alias("v")), "groups")
    most = groups.groupBy("lang").count().agg(F.max("count")).first()[0] or 1
    shards = max(1, -(-kept.count() // max(SHARD_ROWS, most * most)))
    blocks = -(-most // SOURCE_BLOCK)
    block = F.pmod(F.xxhash64("source"), F.lit(blocks)).cast("int")
    everywhere = groups.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))).withColumn(
        "block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    heads = everywhere.select("lang", "shard", "block", F.lit(None).cast("string").alias("term"), "source", F.lit(0).cast("long").alias("n"),
                              (block == F.col("block")).alias("mine"), "total", "v")
    body = kept.select("lang", F.pmod(F.xxhash64("term"), F.lit(shards)).cast("int").alias("shard"),
                       F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), "term", "source", "n",
                       F.lit(False).alias("mine"), F.lit(0).cast("long").alias("total"), F.lit(0).cast("long").alias("v"))
    found = (heads.unionByName(body).repartition("lang", "shard", "block").sortWithinPartitions("lang", "shard", "block", "term", "source")
             .mapInArrow(merge_shards(top), "lang string, source string, part string, item string, value long"))
    found = stored(spark, found, "shards")
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = found.filter("part = 'pair'").groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value"))
    strongest = found.filter("part = 'term'").withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return pairs.withColumn("rank", F.row_number().over(order)).unionByName(strongest)


def op11_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(spark, table(spark, sf_dir, "documents"))


ORACLE = """
with d as (select row_number() over () as r, coalesce(lang, '') as lang, coalesce(source, '') as source,
      regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') as w from documents),
o as (select r, lang, source, unnest(w) as term from d),
k as (select lang, term from o group by lang, term having count(distinct r) >= 10),
v as (select lang, count(*) as v from k group by lang),
c as (select lang, source, term, count(*) as n from o join k using (lang, term) group by all),
g as (select lang, source, coalesce(sum(n), 0)::bigint as total from (select distinct lang, source from d) left join c using (lang, source) group by all),
p as (select g.lang, g.source, k.term, coalesce(n, 0) as n,
      1 + (1000000000 * (coalesce(n, 0) + 2)) // (g.total + 2 * v.v) as p
    from g join k using (lang) join v using (lang) left join c using (lang, source, term)),
q as (select lang, term, 1 + (1000000000 * (sum(n)::bigint + 2)) // (any_value(t.total) + 2 * any_value(v.v)) as q
    from c join v using (lang) join (select lang, sum(total)::bigint as total from g group by lang) t using (lang) group by lang, term),
pairs as (select a.lang, a.source, b.source as item, coalesce(s.value, 0)::bigint as value
    from g a join g b on a.lang = b.lang and a.source <> b.source
    left join (select x.lang, x.source, y.source as item, sum(((x.p - y.p) * (x.p - y.p)) // (x.p + y.p)) as value
      from p x join p y on x.lang = y.lang and x.term = y.term and x.source <> y.source group by all) s
    on s.lang = a.lang and s.source = a.source and s.item = b.source),
terms as (select lang, source, term as item, (((p.p - q.q) * (p.p - q.q)) // (p.p + q.q))::bigint as value
    from p join q using (lang, term) where n > 0 and p.p > q.q)
select lang, source, 'pair' as part, item, value,
    (row_number() over (partition by lang, source order by value desc, item))::int as rank from pairs
union all
select * from (select lang, source, 'term' as part, item, value,
    (row_number() over (partition by lang, source order by value desc, item))::int as rank from terms) where rank <= 10"""
