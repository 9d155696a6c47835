"""Embedding near-dedup: all pairs of cosine at least ``threshold``, by int8 tile products with error bounds.

1. Equal vectors are one class with a count, by partial aggregation, so copies never meet each other.
2. Classes are dealt to cells: a bounded number of pivots (the classes of least hash) are broadcast,
   and a vector's home is the pivot of least angle.  A cell of more than TILE classes is split
   in parts by hash.  A vector u linked to v, at an angle of at most t, is no farther from its own home
   than angle(v, v's home) + 2 t is from v; so v visits only cells within that angle, and of two cells one, chosen
   by parity, gets the other's visitors.  Every pair that can be linked meets once, in one tile.
3. A tile holds its cell's part, quantised to int8 with one scale for each vector, and reads its visitors in
   batches: one product of small integers, exact in floats, gives all dot products of the quantised vectors.  With x = s q + e, the
   dot product of unit vectors x, y differs from s s' (q . q') by at most |e| + |e'| + |e| |e'|, so pairs
   whose bound stays below the threshold are done with; those that are surely above it are links; only the others
   are computed in double precision.
4. A tile passes on the number of links of each class and a spanning forest of its links, not the links
   themselves; components of the forests' edges are found on stored tables.

Vectors without structure (all pivots at about the same angle) meet in all tiles, which is
quadratic in the number of different vectors, as any all-pairs product is; memory is bounded by the tile all the same.

Defined results: a vector that is null, empty, zero, or holds null or non-finite components is linked with nothing;
vectors of different length are not linked; vectors that are positive multiples of each other are linked like others;
repeated rows are vectors of their own; a null id takes part but names a component only if all its ids are null, and is
never kept; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import components, small_side, stored, table

THRESHOLD = 0.9
TILE = 2048                    # classes in a part of a cell
MAX_PIVOTS = 2048              # that many at most, of MAX_PIVOT_BYTES in all
MAX_PIVOT_BYTES = 16 << 20
SLACK = 1e-5                   # covers rounding of the float products that the bounds are compared in
EXACT_PAIRS = 1 << 16          # pairs computed in double precision at once
LEVELS = 127
MAX_BROADCAST = 1_000_000      # rows of (cell, parts); more are joined by shuffle


def unit(x: np.ndarray) -> np.ndarray:
    """Rows of ``x`` as unit vectors in double precision."""
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def quantised(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(q, scale, error): unit vectors as int8 with ``|x - scale * q| <= error``."""
    scale = np.abs(x).max(1) / LEVELS
    q = np.rint(x / scale[:, None])
    error = np.sqrt(((x - q * scale[:, None]) ** 2).sum(1)) * (1 + 1e-9) + 1e-12
    return q.astype(np.int8), scale, error


def integers(q: np.ndarray) -> np.ndarray:
    """int8 as floats whose dot products are exact integers."""
    return q.astype(np.float32 if q.shape[1] * LEVELS * LEVELS < 1 << 24 else np.float64)


class Tile:
    """The members of a part of a cell, and their links with each other and with visitors."""

    def __init__(self, classes: np.ndarray, copies: np.ndarray, x: np.ndarray, threshold: float):
        self.threshold, self.classes, self.copies, self.x = threshold, classes, copies, x
        q, self.scale, self.error = quantised(x)
        self.q = integers(q)
        self.links = np.zeros(len(x), np.int64)
        self.root = np.arange(len(x))

    def pairs(self, x: np.ndarray, among: bool) -> tuple[np.ndarray, np.ndarray]:
        """(member, visitor) of all links with visitors ``x``; ``among`` the members themselves, each pair once."""
        q, scale, error = quantised(x)
        bound = self.error[:, None].astype(np.float32) + (error + error * self.error.max()).astype(np.float32)[None, :]
        about = (self.q @ integers(q).T) * self.scale.astype(np.float32)[:, None] * scale.astype(np.float32)[None, :]
        maybe = about + bound >= self.threshold - SLACK
        if among:
            maybe &= np.tri(len(x), k=-1, dtype=bool).T                 # member before visitor
        i, j = np.nonzero(maybe)
        linked = about[i, j] - bound[i, j] >= self.threshold + SLACK    # surely
        near = np.flatnonzero(~linked)
        for at in range(0, len(near), EXACT_PAIRS):
            some = near[at:at + EXACT_PAIRS]
            linked[some] = np.einsum("ij,ij->i", self.x[i[some]], x[j[some]]) >= self.threshold
        return i[linked], j[linked]

    def join(self, a: int, b: int) -> None:
        def top(i):
            while self.root[i] != i:
                self.root[i] = self.root[self.root[i]]
                i = self.root[i]
            return i
        a, b = top(a), top(b)
        self.root[max(a, b)] = min(a, b)

    def meet(self, classes: np.ndarray | None, copies: np.ndarray | None, x: np.ndarray | None) -> Iterator[pa.RecordBatch]:
        """Links of visitors, or of the members among themselves if there are none given."""
        among = x is None
        classes, copies, x = (self.classes, self.copies, self.x) if among else (classes, copies, x)
        i, j = self.pairs(x, among)
        if not len(i):
            return
        size = len(self.classes)
        self.links += np.bincount(i, copies[j], size).astype(np.int64)
        met = np.bincount(j, self.copies[i], len(x)).astype(np.int64)
        least = np.full(len(x), size)
        np.minimum.at(least, j, i)                           # a visitor's first member, to which its others are joined
        for k in np.unique(least[j] * size + i):
            if k // size != k % size:
                self.join(int(k // size), int(k % size))
        some = np.flatnonzero(met)
        if among:
            self.links += met
            for k in some:
                self.join(int(k), int(least[k]))
        else:
            yield rows_of(classes[some], met[some], self.classes[least[some]])

    def report(self) -> Iterator[pa.RecordBatch]:
        some = np.flatnonzero(self.links)
        yield rows_of(self.classes[some], self.links[some], self.classes[self.root[some]])


def rows_of(classes, links, to) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(classes), pa.array(links), pa.array(to)], ["class", "links", "to"])


def vectors(column) -> np.ndarray:
    """Vectors of equal length, packed as doubles."""
    data = column.to_pylist()
    return unit(np.frombuffer(b"".join(data), np.float64).reshape(len(data), -1))


def meet_in_tiles(threshold: float):
    """Over rows (tile, visits, class, copies, vector) in order of tile, members first."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tile, key, members = None, None, []
        for batch in batches:
            keys = batch.column("tile").to_numpy()
            visits = batch.column("visits").to_numpy(zero_copy_only=False)
            change = np.flatnonzero((keys[1:] != keys[:-1]) | (visits[1:] != visits[:-1])) + 1
            for a, b in zip([0, *change], [*change, len(keys)]):
                if a == b:
                    continue
                part = batch.slice(a, b - a)
                if keys[a] != key:
                    yield from finished(tile, members, threshold)
                    tile, key, members = None, keys[a], []
                if not visits[a]:
                    members.append(part)
                    continue
                if tile is None and members:
                    tile = begun(members, threshold)
                    yield from tile.meet(None, None, None)
                for at in range(0, len(part), TILE):
                    some = part.slice(at, TILE)
                    if tile is not None:
                        yield from tile.meet(some.column("class").to_numpy(), some.column("copies").to_numpy(), vectors(some.column("vector")))
        yield from finished(tile, members, threshold)

    return run


def begun(members: list[pa.RecordBatch], threshold: float) -> Tile:
    t = pa.Table.from_batches(members)
    return Tile(t["class"].to_numpy(), t["copies"].to_numpy(), vectors(t["vector"]), threshold)


def finished(tile: Tile | None, members: list[pa.RecordBatch], threshold: float) -> Iterator[pa.RecordBatch]:
    if tile is None and members:
        tile = begun(members, threshold)
        yield from tile.meet(None, None, None)
    if tile is not None:
        yield from tile.report()


def packed(df: DataFrame) -> DataFrame:
    """(class, copies, vector) of rows (class, copies, embedding): the vector as doubles in one binary."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            e = b.column("embedding")
            values, at = e.flatten().to_numpy().astype(np.float64), np.concatenate([[0], np.cumsum(e.value_lengths().to_numpy())])
            out = [values[i:j].tobytes() for i, j in zip(at[:-1], at[1:])]
            yield pa.RecordBatch.from_arrays([b.column("class"), b.column("copies"), pa.array(out, pa.binary())], ["class", "copies", "vector"])

    return df.mapInArrow(run, "class long, copies long, vector binary")


def at_home(df: DataFrame, pivots, threshold: float) -> DataFrame:
    """(class, copies, vector, home, cells): the pivot of least angle, and all cells that hold vectors it may be linked to
    and that come before its own in the order that deals pairs of cells out."""
    wide = 2 * np.arccos(min(threshold, 1.0)) + 1e-6

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        points = pivots.value                                   # vector length -> (number of its first cell, unit vectors)
        for b in batches:
            length = np.array([len(x) for x in b.column("vector").to_pylist()], np.int64)
            for n in np.unique(length):
                some = b.filter(pa.array(length == n))
                first, p = points[int(n)]
                for at in range(0, len(some), TILE):
                    rows = some.slice(at, TILE)
                    angle = np.arccos(np.clip(vectors(rows.column("vector")) @ p.T, -1, 1))
                    home = angle.argmin(1)
                    other = np.arange(len(p))[None, :]
                    mine = np.where((home[:, None] + other) % 2 == 0, other < home[:, None], other > home[:, None])
                    mine &= angle <= angle.min(1)[:, None] + wide
                    cells = [first + np.flatnonzero(m) for m in mine]
                    yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(first + home), pa.array(cells, pa.list_(pa.int64()))],
                                                     [*rows.schema.names, "home", "cells"])

    return df.mapInArrow(run, "class long, copies long, vector binary, home long, cells array<long>")


def pick_pivots(classes: DataFrame) -> dict:
    """vector length -> (number of its first cell, unit vectors): for each length one pivot at least, the classes of least hash.

    MAX_PIVOTS and MAX_PIVOT_BYTES bound what comes to the driver and is broadcast, for up to MAX_PIVOTS lengths.
    """
    out, cells = {}, 0
    sizes = classes.groupBy(F.length("vector").alias("bytes")).agg(F.count("*").alias("n")).orderBy(F.desc("n")).collect()
    for s in sizes:
        k = max(1, min(-(-s["n"] // TILE), MAX_PIVOTS, MAX_PIVOT_BYTES // s["bytes"]))
        rows = (classes.filter(F.length("vector") == s["bytes"]).select("vector").orderBy(F.xxhash64("vector"), "vector").limit(k).collect())
        out[s["bytes"]] = (cells, unit(np.array([np.frombuffer(r["vector"], np.float64) for r in rows])))
        cells += k
    return out


def link_classes(spark: SparkSession, classes: DataFrame, threshold: float) -> DataFrame:
    """(class, links, to), stored: rows as found in tiles."""
    pivots = spark.sparkContext.broadcast(pick_pivots(classes))
    placed = stored(spark, at_home(classes, pivots, threshold), "placed")
    parts = stored(spark, placed.groupBy("home").agg(F.ceil(F.count("*") / TILE).cast("int").alias("parts")), "parts")
    small = small_side(parts, MAX_BROADCAST)                   # one row for each pivot
    mine = placed.join(small, "home").withColumn("part", F.pmod(F.xxhash64("class"), F.col("parts")).cast("int"))
    row = ("class", "copies", "vector")
    number = F.xxhash64("cell", "in_part")                     # of a tile; tiles that share one would only be compared in vain
    members = mine.select(F.col("home").alias("cell"), F.col("part").alias("in_part"), F.lit(False).alias("visits"), *row)
    cousins = mine.filter("part > 0").select(F.col("home").alias("cell"), F.explode(F.sequence(F.lit(0), F.col("part") - 1)).alias("in_part"),
                                             F.lit(True).alias("visits"), *row)
    away = mine.select(F.explode("cells").alias("cell"), *row).join(
        small.select(F.col("home").alias("cell"), F.col("parts").alias("there")), "cell")
    visitors = away.select("cell", F.explode(F.sequence(F.lit(0), F.col("there") - 1)).alias("in_part"), F.lit(True).alias("visits"), *row)
    tiles = members.unionByName(cousins).unionByName(visitors).select(number.alias("tile"), "visits", *row)
    met = tiles.repartition("tile").sortWithinPartitions("tile", "visits").mapInArrow(
        meet_in_tiles(threshold), "class long, links long, to long")
    return stored(spark, met, "met")


def near_duplicates(spark: SparkSession, vecs: DataFrame, id_col="vec_id", vec_col="embedding", threshold=THRESHOLD) -> DataFrame:
    """(id, n_links, component_id, kept) of every row."""
    v = F.col(vec_col)
    fine = F.coalesce((F.size(v) > 0) & ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
                      & F.exists(v, lambda x: x != 0), F.lit(False))
    rows = vecs.select(F.col(id_col).alias("id"), F.when(fine, v).alias("embedding"), F.when(fine, F.xxhash64(F.lit(1), v)).alias("k1"),
                       F.when(fine, F.xxhash64(F.lit(2), v)).alias("k2"))                  # 128 bits name a vector
    equal = stored(spark, rows.filter("embedding is not null").groupBy("k1", "k2").agg(
        F.count("*").alias("copies"), F.min("id").alias("first_id"), F.first("embedding").alias("embedding"))
        .withColumn("class", F.monotonically_increasing_id()), "classes")
    classes = stored(spark, packed(equal.select("class", "copies", "embedding")), "packed")
    met = link_classes(spark, classes, threshold)
    parts = stored(spark, components(spark, met.filter("class != to").select(F.col("class").alias("a"), F.col("to").alias("b"))), "components")
    linked = stored(spark, equal.drop("embedding").join(met.groupBy("class").agg(F.sum("links").alias("links")), "class", "left")
                    .join(parts.withColumnRenamed("node", "class"), "class", "left")
                    .withColumn("component", F.coalesce("component", "class")), "linked")
    least = stored(spark, linked.groupBy("component").agg(F.min("first_id").alias("component_id")), "least")
    named = stored(spark, linked.join(least, "component").select(
        "k1", "k2", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id"), "named")
    component = F.coalesce("component_id", "id")
    return rows.drop("embedding").join(named, ["k1", "k2"], "left").select(
        "id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(False)).alias("kept"))


def op13_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(spark, table(spark, sf_dir, "embeddings")).withColumnRenamed("id", "vec_id")


ORACLE = """
with recursive t as materialized (select row_number() over () as r, vec_id, embedding::double[] as e from embeddings),
v as (select * from t where e is not null and len(e) > 0
    and len(list_filter(e, lambda x: x is null or not isfinite(x))) = 0 and len(list_filter(e, lambda x: x <> 0)) > 0),
l as materialized (select a.r as x, b.r as y from v a join v b on a.r <> b.r and len(a.e) = len(b.e)
    and list_cosine_similarity(a.e, b.e) >= 0.9),
n as (select x, count(*) as n from l group by x),
s(r, place) as (select r, r from v union select s.r, l.y from s join l on l.x = s.place),
m as (select s.r, min(t.vec_id) as id from s join t on t.r = s.place group by s.r)
select t.vec_id, coalesce(n.n, 0)::bigint as n_links, coalesce(m.id, t.vec_id) as component_id,
    coalesce(t.vec_id = coalesce(m.id, t.vec_id), false) as kept
from t left join n on n.x = t.r left join m on m.r = t.r"""
