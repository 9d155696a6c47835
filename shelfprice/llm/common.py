"""Helpers the operators share: byte-level words, 64-bit hashes, stored tables, components.

A word is ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased, found on the UTF-8 bytes (separators
are ASCII, so words never split a code point).  Word hashes are 64 bits wide.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from contextlib import contextmanager

import numpy as np
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import scratch_path, shuffles_removed

U = np.uint64
BASE = 0x9E3779B97F4A7C15
CHUNK_BYTES = 1 << 17          # texts are hashed together up to this size: arrays stay in cache
WORD = r"[^\x20\x09-\x0D]+"
MAX_LEAST = 1_000_000          # rows of two longs that are broadcast
BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH_BYTES = 4 << 20          # of the rows a Python worker gets at once, copies of them on both sides; 10,000 texts take many times that


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Within it writes pass rows to Python in batches of BATCH_BYTES."""
    before = spark.conf.get(BATCH_SETTING, None)
    spark.conf.set(BATCH_SETTING, str(BATCH_BYTES))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(BATCH_SETTING)
        else:
            spark.conf.set(BATCH_SETTING, before)


def stored(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """``df`` written under the shared checkpoint folder and read again: its lineage and its shuffle files end here."""
    path = scratch_path(spark, "llm", name)
    with small_batches(spark), shuffles_removed(spark):
        df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._stored_path = path
    return out


def drop_stored(spark: SparkSession, *tables: DataFrame) -> None:
    """Deletes what ``stored`` wrote for ``tables``, once nothing that is still to run reads them."""
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for df in tables:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(df._stored_path)
        path.getFileSystem(conf).delete(path, True)


def new_name(df: DataFrame, name: str) -> str:
    """``name``, or one like it, that is no column of ``df`` (names are compared as Spark does, without case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def small_side(df: DataFrame, max_rows: int) -> DataFrame:
    """``df`` (a stored table) marked for broadcast if it is counted to hold at most ``max_rows``
    rows; beyond that it is left to an ordinary shuffled join."""
    return F.broadcast(df) if df.count() <= max_rows else df


def lower_ascii(col):
    return F.translate(col, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def mix64(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser (public splitmix64 constants)."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def byte_values(fold: bool) -> np.ndarray:
    """One odd 64-bit value per byte; with ``fold`` A-Z share those of a-z."""
    v = mix64(np.arange(1, 257, dtype=np.uint64) * U(BASE)) | U(1)
    if fold:
        v[0x41:0x5B] = v[0x61:0x7B]
    return v


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """``BASE**i`` and ``BASE**-i`` modulo 2**64 for i < n."""
    out = []
    for b in (BASE, pow(BASE, -1, 1 << 64)):
        a = np.full(n, b, np.uint64)
        a[0] = 1
        out.append(np.cumprod(a, dtype=np.uint64))
    return out[0], out[1]


class Hasher:
    """Hashes of substrings by prefix sums: sum of value(byte) * BASE**i, shifted back to 0."""

    def __init__(self, fold: bool):
        self.values = byte_values(fold)
        self.pow, self.inv = powers(1 << 18)

    def prefix(self, a: np.ndarray) -> np.ndarray:
        if len(a) >= len(self.pow):
            self.pow, self.inv = powers(2 * len(a) + 2)
        c = np.zeros(len(a) + 1, np.uint64)
        np.cumsum(self.values[a] * self.pow[:len(a)], out=c[1:])
        return c

    def spans(self, c: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix64((c[end] - c[start]) * self.inv[start] + (end - start).astype(np.uint64))


class Words:
    """Words of some texts: hash, byte start and end within ``data``; text i has words
    ``bounds[i]:bounds[i+1]`` and bytes from ``offsets[i]``."""

    def __init__(self, texts: list[bytes], hasher: Hasher):
        self.data = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
        self.offsets = np.cumsum([0] + [len(t) + 1 for t in texts])
        sep = (self.data == 32) | ((self.data >= 9) & (self.data <= 13))
        edge = np.diff(np.concatenate([[1], sep.view(np.int8), [1]]))
        self.start, self.end = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
        self.hash = hasher.spans(hasher.prefix(self.data), self.start, self.end)
        self.bounds = np.searchsorted(self.start, self.offsets)


def utf8(text) -> bytes:
    return text.encode() if isinstance(text, str) else b""


def chunks(texts: Iterable) -> Iterator[tuple[int, list[bytes]]]:
    """(index of the first, texts as bytes): consecutive texts up to CHUNK_BYTES together."""
    first, held, size = 0, [], 0
    for i, t in enumerate(texts):
        b = utf8(t)
        if held and size + len(b) > CHUNK_BYTES:
            yield first, held
            first, held, size = i, [], 0
        held.append(b)
        size += len(b) + 1
    if held:
        yield first, held


def shingle_hashes(h: np.ndarray, k: int) -> np.ndarray:
    """Hashes of k consecutive word hashes."""
    n = len(h) - k + 1
    if n <= 0:
        return h[:0]
    out = np.zeros(n, np.uint64)
    for j in range(k):
        out = mix64(out * U(BASE) + h[j:j + n] + U(j + 1))
    return out


def sum_counts(parts: Iterable[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Adds up (keys, counts) pairs of unique keys."""
    parts = list(parts)
    if not parts:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    keys, inv = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
    return keys, np.bincount(inv, np.concatenate([p[1] for p in parts]), len(keys)).astype(np.int64)


def lookup(keys: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of each x in the sorted ``keys`` and whether it is there."""
    if not len(keys):
        return np.zeros(len(x), np.int64), np.zeros(len(x), bool)
    i = np.minimum(np.searchsorted(keys, x), len(keys) - 1)
    return i, keys[i] == x


def components(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """(node, component): smallest node reachable over ``edges`` (a, b longs), for all nodes on one.

    Alternating large-star and small-star steps on stored edges until nothing changes; each
    step is one grouping, rounds grow with the logarithm of the longest chain.
    """
    def star(e: DataFrame, large: bool) -> DataFrame:
        both = e.select(F.col("a").alias("u"), F.col("b").alias("v"))
        flipped = both.select(F.col("v").alias("u"), F.col("u").alias("v"))
        if large:
            near = both.unionByName(flipped)
        else:                                    # every edge seen from its larger end
            near = both.filter("u > v").unionByName(flipped.filter("u > v"))
        # stored, so that both sides of the join are plain shuffles and a hub's edges can be split, or the smaller is broadcast
        least = stored(spark, near.groupBy("u").agg(F.min("v").alias("m")), "least")
        superseded.append(least)
        out = near.join(small_side(least, MAX_LEAST), "u").select("u", "v", F.least("u", "m").alias("m"))
        if large:
            out = out.filter("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
        else:
            out = (out.select(F.col("v").alias("a"), F.col("m").alias("b"))
                   .unionByName(out.select(F.col("u").alias("a"), F.col("m").alias("b"))))
        return out.filter("a != b")

    def step(df: DataFrame, name: str) -> DataFrame:
        out = stored(spark, df, name)
        while superseded:
            drop_stored(spark, superseded.pop())
        superseded.append(out)
        return out

    def mark(e: DataFrame) -> tuple:
        return tuple(e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    superseded: list[DataFrame] = []
    e = step(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a != b").distinct(), "edges")
    before = mark(e)
    while before[0]:
        e = step(star(step(star(e, True), "large"), False).distinct(), "edges")
        after = mark(e)
        if after == before:
            break
        before = after
    return (e.select(F.col("a").alias("node"), F.col("b").alias("component"))
            .unionByName(e.select(F.col("b").alias("node"), F.col("b").alias("component"))).distinct())
