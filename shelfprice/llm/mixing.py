"""Mixing sources to target weights by hash thresholds.

Every document gets a hash.  A source whose target is below its size takes the documents
whose hash lies under a threshold; a target above the size takes every document once and
those under the threshold twice.  The threshold is found from histograms: words are summed
by source and leading hash digits, the bucket in which the running sum passes the budget is
the boundary, and only that bucket is split further.  Lower thresholds are nested in higher
ones, nothing is sorted, and the hash depends only on document id and seed, so reruns agree.

Defined results: a null text has size 0; null sources form one source, ordered last; rows of
equal id share a hash and are taken together (as are null ids); a source of size 0 has
target 0 and takes nothing; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from .common import WORD, new_name, small_side, stored

WEIGHTS = (5, 2, 1)
SHARE = (3, 2)            # the mix holds 3/2 of all words
REPEATS = 2               # no source, and no document, beyond twice its size
LEVELS, DIGITS = 5, 3     # 5 levels of 3 hex digits: 4,096 buckets each, 60 bits in all
MAX_BROADCAST_SOURCES = 100_000


def document_hash(id_col: str, seed: str):
    """15 hex digits of md5: the leading 60 bits."""
    return F.substring(F.md5(F.concat(F.lit(seed + ":"), F.coalesce(F.col(id_col).cast("string"), F.lit("")))),
                       1, LEVELS * DIGITS)


def source_targets(sizes: DataFrame, weights=WEIGHTS, share=SHARE, repeats=REPEATS) -> DataFrame:
    """(source, source_size, target) by code point order, null last: weights repeat along it.

    The targets share ``share`` of all words by weight, none above ``repeats`` times its size:
    with sources in order of size by weight, the first ones that reach their ceiling keep it,
    and the others share the rest by weight.  One row per source passes the two windows.
    """
    s = (sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
         .withColumn("rank", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
         .withColumn("weight", F.element_at(F.array(*map(F.lit, weights)),
                                            (F.col("rank") % len(weights) + 1).cast("int")).cast("long"))
         .withColumn("top", F.col("source_size") * repeats))
    order = Window.orderBy(F.col("top") / F.col("weight"), "rank")
    upto = order.rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    s = (s.withColumn("left_words", F.sum("source_size").over(every) * share[0] / share[1]
                      - F.coalesce(F.sum("top").over(upto), F.lit(0)))
         .withColumn("left_weight", F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(upto), F.lit(0)))
         .withColumn("full", F.col("top") * F.col("left_weight") <= F.col("weight") * F.col("left_words")))
    first = F.min(F.when(~F.col("full"), F.struct(F.col("top") / F.col("weight"), "rank", "left_words", "left_weight"))).over(every)
    s = s.withColumn("rest", first)
    return s.select("source", "source_size",
                    F.when(F.col("full"), F.col("top").cast("double"))
                    .otherwise(F.col("weight") * F.col("rest.left_words") / F.col("rest.left_weight")).alias("target"))


def sized(docs: DataFrame, id_col: str, text_col: str, source_col: str, seed: str) -> DataFrame:
    return docs.select(
        F.col(id_col).alias("id"), F.col(source_col).alias("source"),
        F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        document_hash(id_col, seed).alias("hash"))


def beside(rows: DataFrame, state: DataFrame, source_col="source", prefix="mix_") -> DataFrame:
    """Rows with their source's state (columns ``mix_...``)."""
    named = state.select(*[F.col(c).alias(prefix + c) for c in state.columns])
    return rows.join(small_side(named, MAX_BROADCAST_SOURCES), F.col(source_col).eqNullSafe(F.col(prefix + "source")))


def thresholds(spark: SparkSession, rows: DataFrame, weights=WEIGHTS, share=SHARE, repeats=REPEATS) -> DataFrame:
    """(source, source_size, target, whole, budget, prefix) of sized, stored ``rows``.

    Every document of a source is taken ``whole`` times, and once more if its hash sorts below
    ``prefix``.
    """
    targets = source_targets(rows.select("source", "size"), weights, share, repeats)
    whole = F.when(F.col("source_size") == 0, 0).otherwise(F.floor(F.col("target") / F.col("source_size")))
    state = stored(spark, targets.select(
        "*", whole.cast("int").alias("whole"),
        (F.col("target") - whole * F.col("source_size")).alias("budget"), F.lit("").alias("prefix")), "level")
    for level in range(LEVELS):
        # words by bucket inside the boundary bucket found so far, then the bucket the budget ends in
        digits = F.substring("hash", level * DIGITS + 1, DIGITS)
        histogram = (beside(rows, state).filter(F.substring("hash", 1, level * DIGITS) == F.col("mix_prefix"))
                     .groupBy("source", digits.alias("bucket")).agg(F.sum("size").alias("words")))
        running = Window.partitionBy("source").orderBy("bucket")
        before = histogram.withColumn("before", F.sum("words").over(running) - F.col("words"))
        found = (beside(before, state.select("source", "budget")).filter(F.col("before") <= F.col("mix_budget"))
                 .groupBy("source").agg(F.max(F.struct("bucket", "before", "words")).alias("edge"))
                 .withColumnRenamed("source", "found_source"))
        last = level == LEVELS - 1
        # the last bucket holds one hash: it counts when that brings the sum nearer to the budget,
        # and '~' sorts after every digit, so that a prefix ending in it includes its own bucket
        nearer = F.col("budget") - F.col("edge.before") >= F.col("edge.words") / 2
        state = stored(spark, state.join(found, F.col("source").eqNullSafe(F.col("found_source")), "left").select(
            "source", "source_size", "target", "whole",
            (F.col("budget") - F.coalesce("edge.before", F.lit(0))).alias("budget"),
            F.concat("prefix", F.coalesce("edge.bucket", F.lit("0" * DIGITS)),
                     F.when(nearer, "~").otherwise("") if last else F.lit("")).alias("prefix")), "level")
    return state


def times(hash_col, repeats: int, prefix="mix_"):
    more = (F.col(prefix + "whole") < repeats) & (hash_col < F.col(prefix + "prefix"))
    return F.col(prefix + "whole") + F.when(more, 1).otherwise(0)


def mix(spark: SparkSession, docs: DataFrame, id_col="doc_id", text_col="text", source_col="source",
        seed="mix", weights=WEIGHTS, share=SHARE, repeats=REPEATS) -> DataFrame:
    """(id, source, size, source_size, target, times, taken): how often the mix holds each row."""
    rows = stored(spark, sized(docs, id_col, text_col, source_col, seed), "sizes")
    out = beside(rows, thresholds(spark, rows, weights, share, repeats))
    n = times(F.col("hash"), repeats)
    return out.select("id", "source", "size", F.col("mix_source_size").alias("source_size"),
                      F.col("mix_target").alias("target"), n.alias("times"), (n * F.col("size")).alias("taken"))


def mixed(spark: SparkSession, docs: DataFrame, id_col="doc_id", text_col="text", source_col="source",
          seed="mix", weights=WEIGHTS, share=SHARE, repeats=REPEATS) -> DataFrame:
    """The rows of ``docs`` that the mix holds, all columns as they are, and ``mix_times``: how often (``mix_times_`` where
    there is a column of that name)."""
    rows = stored(spark, sized(docs, id_col, text_col, source_col, seed), "sizes")
    prefix = "mix_"
    while any(c.lower().startswith(prefix) for c in docs.columns):
        prefix = "_" + prefix
    out = beside(docs, thresholds(spark, rows, weights, share, repeats), source_col, prefix)
    n = times(document_hash(id_col, seed), repeats, prefix)
    return out.filter(n > 0).select(*docs.columns, n.alias(new_name(docs, "mix_times")))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .common import table

    m = mix(spark, table(spark, sf_dir, "documents"))
    return m.select(F.col("id").alias("doc_id"), "size", "source_size", "target",
                    F.col("taken").cast("long").alias("taken"), "source", "times")


def oracle_sql() -> str:
    return """
with d as (select doc_id, source,
    coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::bigint as size,
    substr(md5('mix:' || coalesce(doc_id::varchar, '')), 1, 15) as h from documents),
s as (select source, sum(size)::bigint as source_size,
    row_number() over (order by source nulls last) - 1 as rank from d group by source),
w as (select *, [5, 2, 1][(rank % 3 + 1)::int] as weight, source_size * 2 as top,
    sum(source_size) over () * 3 / 2.0 as budget from s),
c as (select *, budget - coalesce(sum(top) over (order by top / weight, rank rows between unbounded preceding
      and 1 preceding), 0) as left_words,
    sum(weight) over () - coalesce(sum(weight) over (order by top / weight, rank rows between unbounded preceding
      and 1 preceding), 0) as left_weight from w),
f as (select *, top * left_weight <= weight * left_words as is_full from c),
r as (select arg_min(left_words, row(top / weight, rank)) as rw, arg_min(left_weight, row(top / weight, rank)) as rwt
    from f where not is_full),
t as (select source, source_size,
    case when is_full then top::double else weight * rw::double / rwt::double end as target
    from f left join r on true),
k as (select *, case when source_size = 0 then 0 else floor(target / source_size) end as whole from t),
x as (select d.doc_id, d.source, d.size, k.source_size, k.target, k.whole, d.h,
    k.target - k.whole * k.source_size as budget,
    sum(d.size) over (partition by d.source order by d.h range between unbounded preceding and current row)
      as upto, sum(d.size) over (partition by d.source, d.h) as own
    from d join k on d.source is not distinct from k.source),
e as (select *, upto - own as before from x),
b as (select source, max(h) as edge from e where before <= budget group by source)
select e.doc_id, e.size, e.source_size, e.target, e.source,
    (e.whole + case when e.whole < 2 and (e.h < b.edge or (e.h = b.edge and e.budget - e.before >= e.own / 2.0))
      then 1 else 0 end)::int as times,
    ((e.whole + case when e.whole < 2 and (e.h < b.edge or (e.h = b.edge and e.budget - e.before >= e.own / 2.0))
      then 1 else 0 end) * e.size)::bigint as taken
from e left join b on e.source is not distinct from b.source"""
