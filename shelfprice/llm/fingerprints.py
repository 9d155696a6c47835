"""Document fingerprints: SimHash, and permuted block tables to find near ones.

The terms of a text are its pairs of neighbouring words, and its last word alone, each weighing as
often as it occurs.  Every occurrence votes on the 64 bits of its term's hash; a bit is set if
more than half of the weight has it.  Votes are added up as 32 sums a text, two bits to a sum, by
grouped partial aggregation; nothing larger than the sums is shuffled for it.

``near_fingerprints`` finds all pairs of distinct fingerprints within a Hamming radius r: the
bits are cut into b blocks, at least b - r of them agree, so one table for every choice of b - r
blocks, keyed by their bits, holds each pair together at least once.  b grows with the logarithm
of the number of fingerprints, so that a key stays about as rare.  Rows of equal fingerprint are
one.  Everything is DataFrame functions.

Defined results: a null text is an empty one; without words a fingerprint is all zeros; equal texts
have equal fingerprints; likeness is the share of equal bits.  Neighbours are by descending id, nulls
last, ties by hash of the text; after the last comes the first, so a single row is its own
neighbour.  An empty table gives an empty result.
"""

from __future__ import annotations

from itertools import combinations
from math import ceil, log2

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from .common import stored, table

BITS, RADIUS = 64, 3
LANES = 0x0000000100000001
RANGE_ROWS = 2000              # rows of one window of neighbours, up to MAX_RANGES windows
STEP = 128
MAX_RANGES = STEP * STEP


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(text, "[\\x20\\x09-\\x0D]+"), "")


def terms(words: Column) -> Column:
    """array<struct<a,b>>: every word with the one after it, the last one with null."""
    return F.arrays_zip(words.alias("a"), F.slice(words, F.lit(2), F.size(words)).alias("b"))


def vote_sums(term: Column, present: Column) -> list[Column]:
    """32 sums, bit i in the low half and bit i + 32 in the high half, and the weight of all."""
    h = F.when(present, term)
    return [*[F.sum(F.shiftrightunsigned(h, i).bitwiseAND(LANES)).alias(f"s{i}") for i in range(32)],
            F.count(h).alias("weight")]


def fingerprint() -> Column:
    """The fingerprint as a long, of the sums of ``vote_sums``."""
    out, none = F.lit(0).cast("long"), F.lit(0).cast("long")
    for i in range(32):
        low, high = F.col(f"s{i}").bitwiseAND(0xFFFFFFFF), F.shiftrightunsigned(f"s{i}", 32)
        for votes, bit in ((low, i), (high, i + 32)):
            out = out.bitwiseOR(F.when(votes * 2 > F.col("weight"), F.shiftleft(F.lit(1).cast("long"), bit)).otherwise(none))
    return out


def hex64(x: Column) -> Column:
    return F.lpad(F.lower(F.hex(x)), 16, "0")


def likeness(a: Column, b: Column) -> Column:
    return 1 - F.bit_count(a.bitwiseXOR(b)) / BITS


def range_of(bounds: list, col: Column) -> Column:
    """How many of the sorted ``bounds`` are at most the value: first among every STEP-th, then between."""
    if not bounds:
        return F.lit(0)
    coarse = F.array(*[F.lit(b) for b in bounds[STEP - 1::STEP]]).cast("array<long>")
    rows = F.array(*[F.array(*[F.lit(b) for b in bounds[i:i + STEP]]) for i in range(0, len(bounds), STEP)])
    at = F.coalesce(F.size(F.filter(coarse, lambda b: b <= col)), F.lit(0)) if len(bounds) >= STEP else F.lit(0)
    at = F.when(at >= ceil(len(bounds) / STEP), F.lit(len(bounds))).otherwise(
        at * STEP + F.size(F.filter(F.get(rows, at), lambda b: b <= col)))
    return F.coalesce(F.when(col.isNull(), 0).otherwise(at), F.lit(0))


def with_next(spark: SparkSession, rows: DataFrame) -> DataFrame:
    """Rows (id, text, text_key) with the text and key of the next one by descending id.

    Ids are cut into ranges; every range also gets the first row of the one after it, so each
    window of neighbours is complete in itself.
    """
    n = rows.count()
    if not n:
        return rows.withColumns({"next_text": F.col("text"), "next_key": F.col("text_key")})
    parts = min(max(1, ceil(n / RANGE_ROWS)), MAX_RANGES)
    quantiles = rows.agg(F.percentile_approx("id", [i / parts for i in range(1, parts)] or [0.5], 100_000)).first()[0] or []
    bounds = sorted(set(quantiles)) if parts > 1 else []
    placed = rows.withColumn("range", range_of(bounds, F.col("id")))
    # at most MAX_RANGES rows: the first of each range, and the range before it
    heads = placed.groupBy("range").agg(F.max(F.struct("id", "text_key")).alias("head")).orderBy(F.desc("range")).collect()
    to = spark.createDataFrame([(h["head"]["id"], h["head"]["text_key"], heads[i - 1]["range"]) for i, h in enumerate(heads)],
                               "head_id long, head_key long, to int")
    halo = rows.join(F.broadcast(to), F.col("id").eqNullSafe(F.col("head_id")) & (F.col("text_key") == F.col("head_key")))
    both = placed.withColumn("halo", F.lit(0)).unionByName(
        halo.select("id", "text", "text_key", F.col("to").alias("range"), F.lit(1).alias("halo")))
    order = Window.partitionBy("range").orderBy("halo", F.col("id").desc_nulls_last(), F.desc("text_key"))
    return (both.withColumns({"next_text": F.lead("text").over(order), "next_key": F.lead("text_key").over(order)})
            .filter("halo = 0").drop("halo", "range"))


def edited_text(text: Column, following: Column) -> Column:
    """The text with its second half, floor(n / 2) code points, replaced by the first of the next."""
    half = F.floor(F.length(text) / 2).cast("int")
    return F.concat(F.substring(text, F.lit(1), F.length(text) - half), F.substring(following, F.lit(1), half))


def fingerprints(docs: DataFrame, text_cols: dict[str, str], keep: list[str]) -> DataFrame:
    """``keep`` and, for each {name: text column}, the fingerprint of that text, one row per row."""
    texts = F.explode(F.array(*[F.struct(F.lit(i).alias("which"), F.col(c).alias("text"))
                                for i, c in enumerate(text_cols.values())]))
    rows = (docs.select(F.monotonically_increasing_id().alias("row"), *dict.fromkeys([*keep, *text_cols.values()]))
            .select("row", *keep, texts.alias("t")))
    # words are a column of their own, or each use would cut the text again
    words = rows.select("row", *keep, "t.which", words_of(F.col("t.text")).alias("words"))
    votes = words.select("row", *keep, "which", F.explode_outer(terms(F.col("words"))).alias("t"))
    one = (votes.groupBy("row", *keep, "which").agg(*vote_sums(F.xxhash64("t.a", "t.b"), F.col("t.a").isNotNull()))
           .select("row", *keep, "which", fingerprint().alias("f")))
    return one.groupBy("row", *keep).agg(*[F.max(F.when(F.col("which") == i, F.col("f"))).alias(n)
                                           for i, n in enumerate(text_cols)]).select(*keep, *text_cols)


def block_tables(n: int, radius: int = RADIUS) -> list[list[tuple[int, int]]]:
    """Tables for about n fingerprints: each a list of (shift, width) of the blocks that make its key."""
    b = radius + 2
    while BITS * (b - radius) / b < log2(max(n, 2)) + 4 and b < 12:
        b += 1
    edges = [BITS * i // b for i in range(b + 1)]
    blocks = [(lo, hi - lo) for lo, hi in zip(edges, edges[1:])]
    return [list(c) for c in combinations(blocks, b - radius)]


def near_fingerprints(spark: SparkSession, fingerprints: DataFrame, radius: int = RADIUS, col="fingerprint") -> DataFrame:
    """(a, b, distance): all pairs of distinct fingerprints (longs) at most ``radius`` bits apart, a < b."""
    f = stored(spark, fingerprints.select(F.col(col).alias("f")).distinct(), "distinct-fingerprints")
    keys = F.array(*[F.struct(F.lit(i).alias("t"), sum_bits(F.col("f"), t).alias("key"))
                     for i, t in enumerate(block_tables(f.count(), radius))])
    rows = f.select("f", F.explode(keys).alias("k")).select("f", "k.*")
    one, two = rows.select(F.col("f").alias("a"), "t", "key"), rows.select(F.col("f").alias("b"), "t", "key")
    distance = F.bit_count(F.col("a").bitwiseXOR(F.col("b")))
    return (one.join(two, ["t", "key"]).filter((F.col("a") < F.col("b")) & (distance <= radius))
            .select("a", "b", distance.alias("distance")).distinct())


def sum_bits(f: Column, blocks: list[tuple[int, int]]) -> Column:
    """The bits of some blocks, side by side."""
    out, at = F.lit(0).cast("long"), 0
    for shift, width in blocks:
        out = out.bitwiseOR(F.shiftleft(F.shiftrightunsigned(f, shift).bitwiseAND((1 << width) - 1), at))
        at += width
    return out


def op6_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), text.alias("text"),
                                                    F.xxhash64(text).alias("text_key"))
    pairs = with_next(spark, rows).withColumn("edited", edited_text(F.col("text"), F.col("next_text")))
    texts = pairs.select("id", F.length("text").cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"),
                         "text_key", "next_key", "text", "edited")
    keep = ["id", "n_chars", "edited_sha256", "text_key", "next_key"]
    f = stored(spark, fingerprints(texts, {"own": "text", "changed": "edited"}, keep), "fingerprints")
    # equal texts have equal fingerprints: one row for each text
    by_text = stored(spark, f.select(F.col("text_key").alias("key"), F.col("own").alias("next")).distinct(), "by-text")
    near = near_fingerprints(spark, f, col="own")
    counts = stored(spark, near.select(F.explode(F.array("a", "b")).alias("f")).groupBy("f").agg(F.count("*").alias("n_near")), "near")
    out = f.join(by_text, f["next_key"] == by_text["key"]).join(counts, f["own"] == counts["f"], "left")
    return out.select(F.col("id").alias("doc_id"), "n_chars", "edited_sha256", hex64(F.col("own")).alias("fingerprint"),
                      hex64(F.col("changed")).alias("edited_fingerprint"),
                      likeness(F.col("own"), F.col("changed")).alias("near_edited"),
                      likeness(F.col("own"), F.col("next")).alias("near_next"),
                      F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"))
