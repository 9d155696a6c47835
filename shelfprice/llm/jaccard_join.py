"""N-gram Jaccard join: exact linking of texts whose word-shingle sets are similar.

Universe partition with pigeonhole.  Sets are put into bands by size, so that linked sets lie in
the same or neighbouring bands.  In a band whose sets differ in at most H shingles when linked, the
universe of shingles is hashed into H + 1 + Z segments: at least Z + 1 of them agree.  A signature
is a segment's subset, hashed; equal signatures make candidates.  Empty subsets, which many sets share,
are indexed only by sets with more than Z of them: any other linked pair agrees in one that is not empty.
Allocation by cost: a segment whose equal subsets leave more pairs to compare (step 4) than an exchange costs is skipped,
and a cheap one is indexed with its one-deletion neighbourhood (all subsets short of one shingle) instead, which
covers a difference of one there; that costs its rows, and the pairs of sets with at most one shingle there, which all
meet in the empty subset.  With k exchanges some segments still agree (``Bands.agreeing``), and the rule for
empty subsets uses that number.

1. Equal sets are one class, with one representative text; a class is linked as a whole.
2. Each task groups its signatures: members of a group keep a row that points to the group's first class, and only
   that one goes on, so that a signature many sets share is a few rows for each task when it is shuffled.
   Groups then point to their first class over all tasks in the same way.  What points nowhere goes.
3. Every class is compared with the one it points to most often, links are verified, and of the other pointers only
   those are compared that still join different ones.  The links give components.
4. Groups that then hold several components are open.  Linked sets agree in so many indexed segments, A, that each can
   leave A - 1 of its open groups: it leaves the largest, which common lines and passages make, and of the groups that a linked
   pair shares the smallest still holds both.  Segments are exchanged by what is left.  Members of it are compared in blocks, all with
   all of other components.  Of the pairs that may be linked first only the nearest are verified exactly that join a block's components to
   one another (a spanning forest, fewer rows than the block has members), then, in what is still open, all.

Comparisons first use a sketch, one bit for each cell that says whether an odd number of the set's shingles fall
there: sketches never differ in more bits than the sets do in shingles, so no linked pair is lost.  A set has BITS cells, a larger one
as many as shingles at least (fewer are full, and let pairs that have nothing in common pass), so at the similarities asked
for hardly any other pair is left.  The longer of two sketches is folded: cells that are equal modulo the fewer are added up.
Verification intersects whole shingle sets.
Shingles are compared by 64-bit hashes.

Defined results: words are as in ``common``; a text with fewer words than a shingle is one
shingle; null, empty and blank texts have an empty set and are linked with nothing; equal texts
are linked; a null id takes part, but is never a component's id unless all are null; rows with one
id stay apart rows; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from .common import (Hasher, U, Words, chunks, components, drop_stored, mix64, new_name, shingle_hashes, small_side, stored, table)

BITS = 2048                    # of the sketch, more for sets of more shingles
BLOCK = 1024                   # members compared at once
MAX_BROADCAST = 1_000_000      # rows of (long) keys; more are joined by shuffle
HELD = 1 << 17                 # signatures a task groups at once
SEGMENT_BITS, HASH_BITS = 17, 40
PAIR_COST, ROW_COST = 1, 64    # of comparing the sketches of one pair, and of making, shuffling and joining one more signature
DELETION_FACTOR = 2            # pairs that a one-deletion neighbourhood adds, over the rows it takes


class Bands:
    """Sizes low[i]..high[i] make band i; sets linked at ``percent`` are at most one band apart."""

    def __init__(self, percent: int, largest: int):
        self.low, self.high, at = [], [], 1
        while at <= max(largest, 1) or len(self.low) < 2:
            self.low.append(at)
            self.high.append(at * 100 // percent)
            at = self.high[-1] + 1
        self.percent = percent
        self.low.append(at)
        self.high.append(at * 100 // percent)

    def of(self, size: int) -> int:
        return int(np.searchsorted(self.high, size))

    def differing(self, band: int) -> int:
        """H: linked sets r, s differ in at most (100 - p)(|r| + |s|) / (100 + p) shingles."""
        return (100 - self.percent) * 2 * self.high[band] // (100 + self.percent)

    def segments(self, band: int) -> int:
        """H + 1, and Z more for the empty ones that the smallest sets of the band are likely to have."""
        m, least = self.differing(band) + 1, self.low[band] * self.percent / 100
        empty = m * math.exp(-least / m)
        return m + (math.ceil(empty + 2 * math.sqrt(empty)) if least >= 20 else 0)

    def agreeing(self, band: int, exchanges: int) -> int:
        """Segments that agree at least in linked sets; differences cost a plain segment 1, one with its neighbourhood 2."""
        plain, h = self.segments(band) - 2 * exchanges, self.differing(band)
        return plain - h + exchanges if h < plain else exchanges - (h - plain) // 2

    def of_column(self, n):
        """Band of a column of sizes."""
        return F.size(F.filter(F.array(*map(F.lit, self.high)), lambda x: x < n))


def cells(n: int) -> int:
    """Bits of the sketch of n shingles: a power of two, n at least."""
    return max(BITS, 1 << max(n - 1, 0).bit_length())


def sketch(s: np.ndarray, bits: int = BITS) -> bytes:
    return np.packbits(np.bincount((s >> U(20)).astype(np.int64) % bits, minlength=bits) & 1).tobytes()


def sums_by(at: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    """Sums modulo 2**64 of values by place; halves are added as floats, which are exact below 2**21 terms."""
    if len(at) >= 1 << 21:
        out = np.zeros(n, np.uint64)
        np.add.at(out, at, values)
        return out
    low = np.bincount(at, (values & U(0xFFFFFFFF)).astype(np.float64), n).astype(np.uint64)
    high = np.bincount(at, (values >> U(32)).astype(np.float64), n).astype(np.uint64)
    return low + (high << U(32))


def segment_of(s: np.ndarray, band: int, m: int) -> np.ndarray:
    return ((mix64(s + U(band + 1)) >> U(11)) % U(m)).astype(np.int64)


def spare(s: np.ndarray, bands: Bands) -> list[tuple[int, int]]:
    """(band, groups of that band that the set can leave): sets linked with it share one group more with it at least.

    Of the segments that agree, the set's empty ones may not be indexed.
    """
    out, b0 = [], bands.of(len(s))
    for band in (b0, b0 + 1):
        m = bands.segments(band)
        empty = m - np.count_nonzero(np.bincount(segment_of(s, band, m), minlength=m))
        out.append((band, max(bands.agreeing(band, 0) - empty - 1, 0)))
    return out


def signatures(s: np.ndarray, bands: Bands, allocation: dict, only: set | None = None) -> np.ndarray:
    """Signatures of a set in its own band and the next: band, segment and the subset's hash."""
    out, b0 = [], bands.of(len(s))
    for band in (b0, b0 + 1):
        if not len(s) or only is not None and band not in only:
            continue
        m = bands.segments(band)
        segment = segment_of(s, band, m)
        values = mix64(s ^ U(0xA5A5A5A5))
        subset = sums_by(segment, values, m)
        head = (U(band) << U(SEGMENT_BITS + HASH_BITS)) | ((np.arange(m, dtype=np.uint64) & U((1 << SEGMENT_BITS) - 1)) << U(HASH_BITS))
        cut = U(64 - HASH_BITS)
        skipped, deleted = allocation.get(band, ((), ()))
        indexed = np.ones(m, bool)
        empty = np.bincount(segment, minlength=m) == 0
        if empty.sum() < bands.agreeing(band, len(deleted)):
            indexed = ~empty
            indexed[list(deleted)] = True
        indexed[list(skipped)] = False
        out.append((head | (mix64(subset) >> cut))[indexed])
        if deleted:
            inside = np.isin(segment, list(deleted))
            out.append(head[segment[inside]] | (mix64(subset[segment[inside]] - values[inside]) >> cut))
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def text_sets(held: list[bytes], hasher: Hasher, k: int) -> list[np.ndarray]:
    w = Words(held, hasher)
    every, out = shingle_hashes(w.hash, k), []
    for a, b in zip(w.bounds[:-1], w.bounds[1:]):
        if b - a >= k:
            out.append(np.unique(every[a:b - k + 1]))
        else:                                  # fewer words than a shingle: all of them are one
            out.append(shingle_hashes(w.hash[a:b], b - a) ^ U(b - a) if b > a else every[:0])
    return out


def set_key(s: np.ndarray) -> tuple[int, int]:
    """128 bits of a set."""
    return tuple(int(np.int64(x)) for x in np.array(
        [mix64(s).sum(dtype=np.uint64) + U(len(s)), mix64(s * U(0x9E3779B97F4A7C15) + U(7)).sum(dtype=np.uint64)]).view(np.int64))


def describe(docs: DataFrame, k: int) -> DataFrame:
    """(id, text_key, k1, k2, n, sketch) of rows (id, text_key, text)."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hasher = Hasher(fold=True)
        for b in batches:
            keys, sizes, sketches = [], [], []
            for _, held in chunks(b["text"]):
                for s in text_sets(held, hasher, k):
                    keys.append(set_key(s))
                    sizes.append(len(s))
                    sketches.append(sketch(s, cells(len(s))))
            yield pd.DataFrame({"id": b["id"], "text_key": b["text_key"], "k1": [x[0] for x in keys],
                                "k2": [x[1] for x in keys], "n": np.array(sizes, np.int64), "sketch": sketches})

    kind = docs.schema["id"].dataType.simpleString()
    return docs.mapInPandas(run, f"id {kind}, text_key long, k1 long, k2 long, n long, sketch binary")


def class_texts(docs: DataFrame, classes: DataFrame) -> DataFrame:
    """(class, text): the text of each class's representative row, so that copies are left out."""
    want = small_side(classes.select("class", F.col("text_key").alias("want"), F.col("id").alias("want_id")), MAX_BROADCAST)
    return docs.join(want, (F.col("text_key") == F.col("want")) & F.col("id").eqNullSafe(F.col("want_id"))).select("class", "text")


def first_of_group(sig: np.ndarray, cls: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(sig, class, first class of its group, whether it is that one), ordered by sig and class."""
    order = np.lexsort((cls, sig))
    sig, cls = sig[order], cls[order]
    new = np.ones(len(sig), bool)
    new[1:] = sig[1:] != sig[:-1]
    return sig, cls, cls[np.maximum.accumulate(np.where(new, np.arange(len(sig)), 0))], new


def pointers(texts: DataFrame, k: int, bands: Bands, allocation: dict, only=None) -> DataFrame:
    """(sig, class, hub): members of groups of equal signatures, and a smaller class of the group; a group is one tree of them."""
    def grouped(sig: np.ndarray, cls: np.ndarray) -> pd.DataFrame:
        sig, cls, hub, first = first_of_group(sig.view(np.int64), cls)
        use = first | (cls != hub)
        return pd.DataFrame({"sig": sig[use], "class": cls[use], "hub": hub[use]})

    def within_task(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hasher, sigs, classes, size = Hasher(fold=True), [], [], 0
        for b in batches:
            for first, held in chunks(b["text"]):
                for s, c in zip(text_sets(held, hasher, k), b["class"].to_numpy()[first:first + len(held)]):
                    sigs.append(signatures(s, bands, allocation, only))
                    classes.append(np.full(len(sigs[-1]), c))
                    size += len(sigs[-1])
                    if size >= HELD:
                        yield grouped(np.concatenate(sigs), np.concatenate(classes))
                        sigs, classes, size = [], [], 0
        if sigs:
            yield grouped(np.concatenate(sigs), np.concatenate(classes))

    def over_tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """In order of sig and class: rows that point elsewhere stay, the others point to the first of their group."""
        last_sig = last_hub = None
        for b in batches:
            sig, cls, hub = (b.column(c).to_numpy() for c in ("sig", "class", "hub"))
            at = np.flatnonzero(cls == hub)
            s, c = sig[at], cls[at]
            new = np.ones(len(at), bool)
            new[1:] = s[1:] != s[:-1]
            h = c[np.maximum.accumulate(np.where(new, np.arange(len(at)), 0))] if len(at) else c
            if len(at) and s[0] == last_sig:              # the group that the last batch ended in
                h = np.where(s == last_sig, last_hub, h)
            if len(at):
                last_sig, last_hub = s[-1], h[-1]
            hub = hub.copy()
            hub[at] = h
            use = cls != hub
            yield pa.RecordBatch.from_arrays([pa.array(sig[use]), pa.array(cls[use]), pa.array(hub[use])], ["sig", "class", "hub"])

    kind = "sig long, class long, hub long"
    rows = texts.mapInPandas(within_task, kind)
    first = F.col("class") == F.col("hub")                # others need not meet their group
    return (rows.repartition(F.when(first, F.col("sig")).otherwise(F.xxhash64("class")))
            .sortWithinPartitions("sig", "class").mapInArrow(over_tasks, kind))


def allocate(spark: SparkSession, rest: DataFrame, classes: DataFrame, bands: Bands) -> dict:
    """band -> (skipped segments, one-deletion segments), where the exchange costs less than the open members (sig, class).

    One row for each band, of which there are some dozens, and one for each segment that costs more than an
    exchange come to the driver.
    """
    sets, shingles = {}, {}
    for r in classes.groupBy(bands.of_column(F.col("n")).alias("band")).agg(F.count("*").alias("c"), F.sum("n").alias("n")).collect():
        for band in (r["band"], r["band"] + 1):
            sets[band] = sets.get(band, 0) + r["c"]
            shingles[band] = shingles.get(band, 0) + r["n"]
    if not sets:
        return {}

    def exchange(band: int) -> float:
        each = shingles[band] / sets[band] / bands.segments(band)        # shingles of a set in a segment
        bare = sets[band] * (1 + each) * math.exp(-each)                 # sets with one at most
        return ROW_COST * (1 + DELETION_FACTOR) * shingles[band] / bands.segments(band) + PAIR_COST * bare * bare / 2

    limit = spark.createDataFrame([(b, float(exchange(b))) for b in sets], "band long, least double")
    cell = F.shiftrightunsigned("sig", HASH_BITS)
    groups = rest.groupBy("sig").agg(F.count("*").alias("c"))
    cells = (groups.groupBy(cell.alias("cell")).agg((F.sum(F.col("c") * (F.col("c") - 1)) / 2 * PAIR_COST).alias("pairs"))
             .withColumn("band", F.shiftrightunsigned("cell", SEGMENT_BITS)))
    hot: dict[int, list] = {}
    for r in cells.join(F.broadcast(limit), "band").filter(F.col("pairs") > F.col("least")).orderBy(F.desc("pairs"), "cell").collect():
        hot.setdefault(r["band"], []).append(int(r["cell"] & ((1 << SEGMENT_BITS) - 1)))
    out = {}
    for band, segments in hot.items():
        m = bands.segments(band)
        if m > 1 << SEGMENT_BITS:
            continue
        cool = [i for i in range(m) if i not in set(segments)] + segments[::-1]
        n = min(len(segments), m // 2)
        if n:
            out[band] = (tuple(segments[:n]), tuple(cool[:n]))
    return out


def differing_bits(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a ^ b).sum(-1, dtype=np.int64)


def may_link(bits: np.ndarray, na: np.ndarray, nb: np.ndarray, percent: int) -> np.ndarray:
    """Whether sets of these sizes whose sketches differ in so many bits can be linked."""
    return (100 + percent) * bits <= (100 - percent) * (na + nb)


def sketch_array(column) -> np.ndarray:
    """Sketches of one length, as rows."""
    return np.frombuffer(b"".join(column), np.uint64).reshape(len(column), -1)


class Sketches:
    """Sketches of a column, as one array for each length: of those that are as long or longer, folded to it."""

    def __init__(self, column):
        column = list(column)
        self.length = np.array([len(x) for x in column], np.int64)
        self.levels = {}
        for size in np.unique(np.append(self.length, BITS // 8)).tolist():
            rows = np.flatnonzero(self.length >= size)
            place = np.zeros(len(column), np.int64)
            place[rows] = np.arange(len(rows))
            folded = np.zeros((len(rows), size // 8), np.uint64)
            for own in np.unique(self.length[rows]).tolist():
                some = np.flatnonzero(self.length[rows] == own)
                whole = sketch_array([column[i] for i in rows[some]])
                folded[some] = np.bitwise_xor.reduce(whole.reshape(len(some), own // size, size // 8), axis=1)
            self.levels[size] = place, folded

    def differing(self, i: np.ndarray, other: Sketches, j: np.ndarray, size: int) -> np.ndarray:
        """Bits that sketches i differ in from sketches j of the other column, both folded to ``size`` bytes."""
        (at, a), (to, b) = self.levels[size], other.levels[size]
        return differing_bits(a[at[i]], b[to[j]])


def near(a: Sketches, b: Sketches, i: np.ndarray, j: np.ndarray, na: np.ndarray, nb: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """(whether sketches i of a and j of b allow a link, bits they differ in): shortest length first, then that of the shorter one."""
    bits = a.differing(i, b, j, BITS // 8)
    ok = may_link(bits, na, nb, percent)
    shorter = np.minimum(a.length[i], b.length[j])
    for size in np.unique(shorter[ok]).tolist():
        if size > BITS // 8:
            at = np.flatnonzero(ok & (shorter == size))
            bits[at] = a.differing(i[at], b, j[at], size)
            ok[at] = may_link(bits[at], na[at], nb[at], percent)
    return ok, bits


def forest(one: np.ndarray, two: np.ndarray, nodes: int) -> np.ndarray:
    """Indices of the edges of a least spanning forest, edges being given in order: each tree takes its first edge to another, until none has one."""
    root, at, out = np.arange(nodes), np.arange(len(one)), []
    while len(at):
        a, b = root[one[at]], root[two[at]]
        at, a, b = (x[a != b] for x in (at, a, b))
        first = np.full(nodes, len(at))
        np.minimum.at(first, a, np.arange(len(at)))
        np.minimum.at(first, b, np.arange(len(at)))
        use = np.unique(first[first < len(at)])
        out.append(at[use])
        up = np.arange(nodes)
        for x, y in zip(a[use].tolist(), b[use].tolist()):
            while up[x] != x:
                x = up[x]
            while up[y] != y:
                y = up[y]
            up[max(x, y)] = min(x, y)
        while (up[up] != up).any():
            up = up[up]
        root = up[root]
    return np.concatenate(out) if out else at


def likely(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sketches allow a link."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            every, both = np.arange(len(b)), pd.concat([b["sketch"], b["other_sketch"]])
            sketches = Sketches(both)
            ok, _ = near(sketches, sketches, every, every + len(b), b["n"].to_numpy(), b["other_n"].to_numpy(), percent)
            yield b.loc[ok, ["a", "b"]]

    one = classes.select(F.col("class").alias("b"), "n", "sketch")
    two = classes.select(F.col("class").alias("a"), F.col("n").alias("other_n"), F.col("sketch").alias("other_sketch"))
    return (pairs.join(one, "b").join(two, "a")
            .filter(F.least("n", "other_n") * 100 >= F.greatest("n", "other_n") * percent).mapInPandas(run, "a long, b long"))


def set_rows(texts: DataFrame, k: int) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hasher = Hasher(fold=True)
        for b in batches:
            for first, held in chunks(b["text"]):
                yield pd.DataFrame({"class": b["class"].to_numpy()[first:first + len(held)],
                                    "set": [s.view(np.int64) for s in text_sets(held, hasher, k)]})
    return texts.mapInPandas(run, "class long, set array<long>")


def verified(spark: SparkSession, pairs: DataFrame, docs: DataFrame, classes: DataFrame, k: int, percent: int) -> DataFrame:
    """The stored pairs (a, b) whose sets are linked, by intersection of whole sets, stored.

    The set of b is cut from its text beside the pair and goes to that of a, once for each pair.
    """
    def sets(column: str, name: str) -> DataFrame:
        some = pairs.select(F.col(column).alias("class")).distinct()
        wanted = stored(spark, classes.select("class", "text_key", "id").join(some, "class"), "wanted")
        return set_rows(class_texts(docs, wanted), k).select(F.col("class").alias(column), F.col("set").alias(name))

    beside = sets("b", "sb").join(small_side(pairs, MAX_BROADCAST), "b")
    met = beside.join(sets("a", "sa"), "a").select("a", "b", F.size("sa").alias("x"), F.size("sb").alias("y"),
                                                   F.size(F.array_intersect("sa", "sb")).alias("both"))
    linked = 100 * F.col("both") >= percent * (F.col("x") + F.col("y") - F.col("both"))
    return stored(spark, met.filter(linked).select("a", "b"), "links")


def open_members(members: DataFrame, parts: DataFrame) -> DataFrame:
    """(sig, class, size): members of the groups that hold several components, which one of their pointers joins.

    A group of two has one pointer, which has been verified by then: it is not looked at again.
    """
    def part(column: str, name: str) -> DataFrame:
        return small_side(parts, MAX_BROADCAST).select(F.col("node").alias(column), F.col("component").alias(name))

    marked = (members.join(part("class", "p"), "class", "left").join(part("hub", "q"), "hub", "left")
              .select("sig", "class", "hub", (F.coalesce("p", "class") != F.coalesce("q", "hub")).alias("apart")))
    groups = marked.groupBy("sig").agg(F.count("*").alias("c"), F.max("apart").alias("open")).filter("c > 1 and open")
    rows = members.join(groups.select("sig", (F.col("c") + 1).alias("size")), "sig")
    return rows.select("sig", "class", "size").unionByName(rows.select("sig", F.col("hub").alias("class"), "size")).distinct()


def rarest(rest: DataFrame, texts: DataFrame, k: int, bands: Bands) -> DataFrame:
    """(sig, class): open members without the largest groups that each class can leave, by band (``spare``)."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hasher = Hasher(fold=True)
        for b in batches:
            for first, held in chunks(b["text"]):
                rows = [(c, band, n) for c, s in zip(b["class"].to_numpy()[first:first + len(held)], text_sets(held, hasher, k))
                        for band, n in spare(s, bands) if n]
                yield pd.DataFrame(rows, columns=["class", "band", "spare"]).astype("int64")

    own = texts.mapInPandas(run, "class long, band long, spare long").withColumn("sig", F.lit(None).cast("long")).withColumn("size", F.lit(0).cast("long"))
    both = rest.withColumn("band", F.shiftrightunsigned("sig", SEGMENT_BITS + HASH_BITS)).withColumn("spare", F.lit(0).cast("long")).unionByName(own)
    of_class = Window.partitionBy("class", "band")      # at most the signatures of one set
    return (both.withColumn("leaves", F.max("spare").over(of_class))
            .withColumn("rank", F.row_number().over(of_class.orderBy(F.desc("size"), "sig")))
            .filter("sig is not null and rank > leaves").select("sig", "class"))


def labelled(rest: DataFrame, parts: DataFrame) -> DataFrame:
    """(sig, class, size, component): members of groups that still hold several of the components found so far."""
    part = small_side(parts, MAX_BROADCAST).select(F.col("node").alias("class"), "component")
    rows = rest.join(part, "class", "left").withColumn("component", F.coalesce("component", "class"))
    several = rows.groupBy("sig").agg(F.count("*").alias("size"), F.min("component").alias("x"), F.max("component").alias("y")).filter("x < y")
    return rows.join(several.select("sig", "size"), "sig")


def block_pairs(members: DataFrame, percent: int, nearest: bool, within: bool = False) -> DataFrame:
    """(a, b) of one group but different components that may be linked, by pairs of blocks, or ``within`` blocks alone.

    With ``nearest`` only those of least distance that join the components of a pair of blocks to one another.
    """
    mine = F.pmod(F.xxhash64("class"), F.col("blocks")).cast("int")
    m = members.withColumn("blocks", F.ceil(F.col("size") / BLOCK).cast("int")).withColumn("mine", mine)
    m = m.withColumn("other", F.col("mine") if within else F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    tiles = m.select("sig", F.least("mine", "other").alias("x"), F.greatest("mine", "other").alias("y"),
                     "mine", "class", "component", "n", "sketch")

    def solve(b: pd.DataFrame) -> pd.DataFrame:
        """Pairs within whole tiles, which lie one after another: rows d apart, for every d, all at once."""
        tile = np.cumsum(np.concatenate([[0], (b[["sig", "x", "y"]].to_numpy()[1:] != b[["sig", "x", "y"]].to_numpy()[:-1]).any(1)]))
        mine, key, part, n = (b[c].to_numpy() for c in ("mine", "class", "component", "n"))
        cross, sketches, out = (b["x"] != b["y"]).to_numpy(), Sketches(b["sketch"]), []
        i = np.arange(len(b))
        for d in range(1, len(b)):
            i = i[i + d < len(b)]
            i = i[tile[i] == tile[i + d]]
            if not len(i):
                break
            j = i + d
            ok = (part[i] != part[j]) & (~cross[i] | (mine[i] != mine[j]))
            ok &= np.minimum(n[i], n[j]) * 100 >= percent * np.maximum(n[i], n[j])
            p, q = i[ok], j[ok]
            ok, bits = near(sketches, sketches, p, q, n[p], n[q], percent)
            if ok.any():
                out.append((p[ok], q[ok], bits[ok]))
        if not out:
            return pd.DataFrame({"a": key[:0], "b": key[:0]})
        i, j, bits = (np.concatenate(x) for x in zip(*out))
        a, c = np.minimum(key[i], key[j]), np.maximum(key[i], key[j])
        if nearest:                                    # ties in the order of classes, so that groups of the same members choose alike
            order = np.lexsort((c, a, bits))
            own = np.lexsort((part, tile))
            new = np.ones(len(own), bool)
            new[1:] = (tile[own[1:]] != tile[own[:-1]]) | (part[own[1:]] != part[own[:-1]])
            node = np.zeros(len(own), np.int64)
            node[own] = np.cumsum(new) - 1             # a component in a tile
            use = order[forest(node[i[order]], node[j[order]], int(new.sum()))]
            a, c = a[use], c[use]
        return pd.DataFrame({"a": a, "b": c}).drop_duplicates()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None                                    # the tile that the last batch ended in
        for b in batches:
            b = b if held is None else pd.concat([held, b], ignore_index=True)
            if not len(b):
                continue
            last = (b[["sig", "x", "y"]] != b[["sig", "x", "y"]].iloc[-1]).any(axis=1).to_numpy()
            edge = int(np.flatnonzero(last)[-1]) + 1 if last.any() else 0
            if edge:
                yield solve(b.iloc[:edge])
            held = b.iloc[edge:]
        if held is not None and len(held):
            yield solve(held)

    return (tiles.repartition("sig", "x", "y").sortWithinPartitions("sig", "x", "y")
            .mapInPandas(run, "a long, b long").distinct())


def link_classes(spark: SparkSession, docs: DataFrame, classes: DataFrame, k: int, percent: int) -> DataFrame:
    """(node, component), stored: classes that are linked, by enough verified links."""
    largest = classes.agg(F.max("n")).first()[0] or 1
    bands = Bands(percent, largest)
    texts = class_texts(docs, classes)
    members = stored(spark, pointers(texts, k, bands, {}), "members")

    def verify(pairs: DataFrame) -> DataFrame:
        return verified(spark, stored(spark, likely(pairs, classes, percent), "likely"), docs, classes, k, percent)

    # every class with the one it points to most often
    pairs = stored(spark, members.groupBy("class", "hub").agg(F.count("*").alias("c")), "pointers")
    best = stored(spark, pairs.groupBy("class").agg(F.max(F.struct("c", (-F.col("hub")).alias("order"), "hub")).alias("x"))
                  .select("class", F.col("x.hub").alias("hub")), "best")
    edges = verify(best.select(F.col("hub").alias("a"), F.col("class").alias("b")))
    # the other pointers, where two steps along those links do not end at one class
    up = edges.select(F.col("b").alias("node"), F.col("a").alias("parent"))
    above = up.select(F.col("node").alias("parent"), F.col("parent").alias("grand"))
    ends = stored(spark, up.join(small_side(above.select("parent", "grand"), MAX_BROADCAST), "parent", "left").select(
        "node", F.coalesce("grand", "parent").alias("end")), "ends")

    def end_of(column: str, name: str) -> DataFrame:
        return small_side(ends, MAX_BROADCAST).select(F.col("node").alias(column), F.col("end").alias(name))

    others = (pairs.join(best.select("class", F.col("hub").alias("tried")), "class").filter("hub != tried")
              .join(end_of("class", "p"), "class", "left").join(end_of("hub", "q"), "hub", "left")
              .filter(F.coalesce("p", "class") != F.coalesce("q", "hub")).select(F.col("hub").alias("a"), F.col("class").alias("b")))
    edges = edges.unionByName(verify(others))
    parts = stored(spark, components(spark, edges), "components")

    found = stored(spark, open_members(members, parts), "open")
    drop_stored(spark, members, pairs, best, ends)
    some = stored(spark, classes.join(found.select("class").distinct(), "class"), "open-classes")
    open_texts = class_texts(docs, some)
    rest = stored(spark, rarest(found, open_texts, k, bands), "rarest")
    drop_stored(spark, found)
    if allocation := allocate(spark, rest, some, bands):       # linked sets that are still apart are both in ``some``
        fresh = stored(spark, pointers(open_texts, k, bands, allocation, set(allocation)), "exchanged")
        grouped = fresh.select("sig", "class").unionByName(fresh.select("sig", F.col("hub").alias("class"))).distinct()
        band = F.shiftrightunsigned("sig", SEGMENT_BITS + HASH_BITS)
        rest = stored(spark, rest.filter(~band.isin(*allocation)).unionByName(grouped), "rarest-again")
    sketches, still = some.select("class", "n", "sketch"), None
    for nearest, within in ((True, True), (True, False), (False, False)):
        still = still or stored(spark, labelled(rest, parts), "still-open")
        if still.isEmpty():
            break
        if within and still.agg(F.max("size")).first()[0] <= BLOCK:     # every group is one block: the next pass does the same
            continue
        more = stored(spark, block_pairs(still.join(sketches, "class"), percent, nearest, within), "open-pairs")
        links = verified(spark, more, docs, classes, k, percent) if not more.isEmpty() else more       # their sketches have been compared
        drop_stored(spark, still)
        still = None
        if not links.isEmpty():
            edges = edges.unionByName(links)
            parts = stored(spark, components(spark, edges), "components")
        if nearest and not within and links.count() == more.count():   # the forests of all blocks are links: what may be linked is
            break
    return parts


def join_components(spark: SparkSession, docs: DataFrame, id_col="doc_id", text_col="text", shingle=5,
                    percent=80) -> DataFrame:
    """(id, text_key, n_shingles, component_id, component): the component of every row and its number, null for empty sets."""
    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("text_key"), F.col(text_col).alias("text"))
    d = stored(spark, describe(rows, shingle), "described")
    # one text per class; partial aggregates shrink groups of copies before they are shuffled
    classes = stored(spark, d.filter("n > 0").groupBy("k1", "k2", "n").agg(
        F.min(F.struct("text_key", "id")).alias("row"), F.min("id").alias("first_id"), F.first("sketch").alias("sketch"))
        .select("k1", "k2", "n", "row.*", "first_id", "sketch").withColumn("class", F.monotonically_increasing_id()), "classes")
    parts = link_classes(spark, rows, classes, shingle, percent)
    linked = classes.select("k1", "k2", "class", "first_id").join(
        small_side(parts.withColumnRenamed("node", "class"), MAX_BROADCAST), "class", "left").withColumn("component", F.coalesce("component", "class"))
    least = linked.groupBy("component").agg(F.min("first_id").alias("component_id"))
    named = stored(spark, linked.join(least, "component").select("k1", "k2", "component", "component_id"), "named")
    return (d.drop("sketch").join(named, ["k1", "k2"], "left")
            .select("id", "text_key", F.col("n").alias("n_shingles"), F.coalesce("component_id", "id").alias("component_id"), "component"))


def keep_one(spark: SparkSession, docs: DataFrame, id_col="doc_id", text_col="text", shingle=5, percent=80) -> DataFrame:
    """``docs`` with exactly one row of each group: of those with the least id, or without one if all are, the one of least
    text hash; of rows that are equal in both one, whichever.  Rows without words all stay."""
    c = stored(spark, join_components(spark, docs, id_col, text_col, shingle, percent), "members-of-components")
    some = c.filter("component is not null").groupBy("component", "id", "text_key").agg(F.count("*").alias("times"))
    first = F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "text_key"))
    chosen = some.groupBy("component").agg(first.alias("first")).select("component", F.col("first.id").alias("first_id"), F.col("first.text_key").alias("first_key"))
    stays = F.col("id").eqNullSafe(F.col("first_id")) & (F.col("text_key") == F.col("first_key"))
    gone, key, times = (new_name(docs, n) for n in ("gone", "key", "times"))
    # what is to go, and what stays but is there several times
    marked = stored(spark, some.join(chosen, "component").filter(~stays | (F.col("times") > 1)).select(
        F.col("id").alias(gone), F.col("text_key").alias(key), F.when(stays, F.col("times")).otherwise(0).alias(times)), "marked")
    both = docs.join(small_side(marked, MAX_BROADCAST), F.col(id_col).eqNullSafe(F.col(gone)) & (F.xxhash64(text_col) == F.col(key)), "left")
    single = both.filter(F.col(times).isNull()).select(*docs.columns)
    return single.unionByName(both.filter(F.col(times) > 0).dropDuplicates([gone, key]).select(*docs.columns))


def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = join_components(spark, table(spark, sf_dir, "documents"), shingle=3, percent=90)
    return found.select(F.col("id").alias("doc_id"), "n_shingles", "component_id")


ORACLE = """
with recursive t as (select doc_id, regexp_extract_all(translate(coalesce(text, ''),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') as w from documents),
s as (select doc_id, unnest(list_distinct(case when len(w) >= 3
      then [w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] for i in range(1, len(w) - 1)]
      when len(w) > 0 then [array_to_string(w, ' ')] else [] end)) as g from t),
n as (select doc_id, count(*) as n from s group by doc_id),
p as (select a.doc_id as x, b.doc_id as y, count(*) as i from s a join s b on a.g = b.g and a.doc_id < b.doc_id group by all),
l as (select x, y from p join n nx on nx.doc_id = x join n ny on ny.doc_id = y
      where 100 * i >= 90 * (nx.n + ny.n - i)),
e as (select x, y from l union select y, x from l),
r(doc_id, c) as (select doc_id, doc_id from documents union select r.doc_id, e.y from r join e on e.x = r.c)
select d.doc_id, coalesce(n.n, 0)::bigint as n_shingles, m.c as component_id
from documents d left join n using (doc_id) join (select doc_id, min(c) as c from r group by doc_id) m using (doc_id)"""
