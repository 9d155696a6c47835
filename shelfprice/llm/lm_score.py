"""LM scoring with a weighted backoff automaton of smoothed n-grams.

Training counts every word, word pair and triple of the training part of the corpus.  The automaton
has an empty state, a start state, a state for each word and one for each pair; arcs are the
pairs and triples that occur MIN_COUNT times or more, whatever the corpus.  An arc costs its
absolutely discounted probability interpolated with that of the arc one word shorter, a word alone
its add-one probability; where a state has no arc its failure arc leads to the state one word
shorter at the state's left-over mass.  Each state's probabilities add up to one.  A text is read
once, left to right, and log10 probabilities add up, its end included.

Along a text failure costs are paid at every state and taken back where an arc leaves it, so each
n-gram has a weight of its own and a text's score is the sum of its n-grams' weights.  N-grams with at least
HEAD_SHARE of the training tokens, at most 1 / HEAD_SHARE of each order, are held in the tasks; the weights of
all others are made where the texts that use them are, from counts.

Texts are put into blocks of about BLOCK_TOKENS tokens, stored as numbers of their block's words.  Three times each
block asks for what it needs to know of its different n-grams: it sends their sorted hashes and its own counts, as
compressed differences, to the parts of the hash range; a part adds up what all blocks say of an n-gram and answers
each of them in the order it asked.  First words and pairs are counted, then the triples of two pairs that are arcs
(no others can be), then the mass that arcs take from their states.  Each n-gram has one owner, the first block that
asked, whose word alone counts for the state it leaves.  So an n-gram moves once for each block that has it,
however often it occurs, and no key is hot.

Words are as in ``common`` (A-Z lower-cased), compared by 64-bit hashes; the end counts as a token.

Defined results: a null text is empty and consists of its end alone; rows with a null id are
training rows; repeated rows count and score each time; without training tokens every word is
unknown (N and V are 0); an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import BASE, Hasher, U, Words, chunks, drop_stored, lookup, mix64, stored, table

FOLDS, HELD_OUT = 7, 2
DISCOUNT, MIN_COUNT = 0.75, 2
HEAD_SHARE = 4e-6
END, START = U(0xE4D), U(0x57A)  # hashes that stand for the end and the start of a text
BLOCK_TOKENS = 1 << 20         # tokens from which on a block is full; it holds whole texts
PART_TOKENS = 1 << 21          # tokens of all texts for each part of the hash range
ROWS = "block long, step int, part int, data binary"


def with_fold(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    fold = F.pmod(F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))), F.lit(FOLDS))
    return docs.select(F.col(id_col).alias("id"), (fold == HELD_OUT).alias("held_out"), F.col(text_col).alias("text"))


def token_runs(texts) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(tokens of some texts with an END after each, index of each text's first token), in order."""
    hasher = Hasher(fold=True)
    for _, held in chunks(texts):
        w = Words(held, hasher)
        ends = w.bounds[1:]
        yield np.insert(w.hash, ends, END), w.bounds[:-1] + np.arange(len(held))


def joined(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Hash of a pair of words, or of the triple whose pairs ``x`` and ``y`` overlap in a word."""
    return mix64(mix64(x + U(1)) * U(BASE) + y + U(2))


def n_grams(tokens: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word before each token, pair ending there, places of the second and further tokens of their texts)."""
    before = np.concatenate([[START], tokens[:-1]]).astype(np.uint64)
    before[starts] = START
    later = np.ones(len(tokens), bool)
    later[starts] = False
    return before, joined(before, tokens), np.flatnonzero(later)


def packed(*arrays: np.ndarray) -> bytes:
    """Arrays of integers, compressed byte plane by byte plane."""
    out = []
    for a in arrays:
        planes = pa.compress(np.ascontiguousarray(a).view(np.uint8).reshape(len(a), -1).T.tobytes(), "zstd", asbytes=True) if len(a) else b""
        out += [np.array([len(a), a.dtype.itemsize, len(planes)], np.int64).tobytes(), planes]
    return b"".join(out)


def unpacked(data: bytes) -> list[np.ndarray]:
    out, at = [], 0
    while at < len(data):
        n, width, size = np.frombuffer(data, np.int64, 3, at).tolist()
        at += 24
        planes = pa.decompress(data[at:at + size], n * width, "zstd", asbytes=True) if n else b""
        out.append(np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(width, n).T).reshape(-1).view(f"u{width}"))
        at += size
    return out


def different(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(sorted different keys, a place of each, number of each place's key)."""
    order = np.argsort(keys)
    keys = keys[order]
    new = np.ones(len(keys), bool)
    new[1:] = keys[1:] != keys[:-1]
    number = np.empty(len(keys), np.int64)
    number[order] = np.cumsum(new) - 1
    return keys[new], order[new], number


def groups(batches: Iterator[pa.RecordBatch], name: str) -> Iterator[list[dict]]:
    """Rows that follow each other with the same value of a column."""
    held = []
    for b in batches:
        for row in b.to_pylist():
            if held and row[name] != held[0][name]:
                yield held
                held = []
            held.append(row)
    if held:
        yield held


def to_blocks(id_type: pa.DataType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def row() -> pa.RecordBatch:
            tokens, sizes = np.concatenate([t for _, t, _ in held]), np.concatenate([n for *_, n in held])
            words, places = np.unique(tokens, return_inverse=True)
            ids, folds = (pa.concat_arrays([b.column(i) for b, *_ in held]) for i in (0, 1))
            lists = [pa.ListArray.from_arrays(pa.array([0, len(sizes)], pa.int32()), a) for a in (ids.cast(id_type), folds)]
            data = packed(np.diff(words, prepend=U(0)), places.astype(np.uint32), sizes.astype(np.uint32))
            return pa.RecordBatch.from_arrays([pa.array([len(tokens)]), pa.array([data], pa.binary()), *lists], ["tokens", "data", "ids", "folds"])

        for b in batches:
            first = 0
            for tokens, starts in token_runs(b.column(2).to_pylist()):
                held.append((b.select([0, 1]).slice(first, len(starts)), tokens, np.diff(np.append(starts, len(tokens)))))
                first, size = first + len(starts), size + len(tokens)
                if size >= BLOCK_TOKENS:
                    yield row()
                    held, size = [], 0
        if held:
            yield row()
    return run


class Block:
    """Some texts and what was answered of their n-grams, from the rows of a block in order of ``step`` and ``part``.

    ``words``, ``pairs`` and ``triples`` are sorted; ``x`` and ``y`` say where the words of a pair are in ``states`` (the words and
    START) and ``words``; ``arcs`` are the pairs that are arcs, ``triples`` those of two arcs each.
    """

    def __init__(self, rows: list[dict]):
        self.ids, folds = rows[0]["ids"], np.array(rows[0]["folds"], bool)
        deltas, places, sizes = unpacked(rows[0]["data"])
        self.words, self.held_out, sizes = np.cumsum(deltas, dtype=np.uint64), folds, sizes.astype(np.int64)
        self.tokens, self.starts = self.words[places], np.cumsum(sizes) - sizes
        self.trains = np.repeat(~folds, sizes)
        _, self.pair, self.later = n_grams(self.tokens, self.starts)
        self.places, (self.pairs, first, self.pair_at) = places, different(self.pair)
        start = np.searchsorted(self.words, START)
        self.states = np.insert(self.words, start, START)
        before = np.concatenate([[0], places[:-1]]).astype(np.int64)
        before += before >= start                                  # places of words among the states
        before[self.starts] = start
        self.x, self.y = before[first], places[first]
        self.word_counts, self.pair_counts = (np.bincount(at, self.trains, n).astype(np.uint64) for at, n in (
            (places, len(self.words)), (self.pair_at, len(self.pairs))))
        answers = {}
        for r in rows[1:]:
            answers.setdefault(r["step"], []).append(unpacked(r["data"]))
        answers = {step: [np.concatenate(a) for a in zip(*parts)] for step, parts in answers.items()}
        if 1 in answers:
            self.c1, self.own1, self.c2, self.own2 = (a.astype(np.int64) for a in answers[1])
            self.arcs = np.flatnonzero(self.c2 >= MIN_COUNT)
            number = np.cumsum(self.c2 >= MIN_COUNT) - 1
            arc = (self.c2 >= MIN_COUNT)[self.pair_at]
            at = self.later[arc[self.later - 1] & arc[self.later]]
            self.triples, first, inverse = different(joined(self.pair[at - 1], self.pair[at]))
            self.triple_places, self.triple_at = at, inverse
            self.x3, self.y3 = (number[self.pair_at[p[first]]] for p in (at - 1, at))     # among the arcs
            self.triple_counts = np.bincount(inverse, self.trains[at], len(self.triples)).astype(np.uint64)
            self.c3 = self.own3 = np.zeros(len(self.triples), np.int64)
        if 2 in answers:
            self.c3, self.own3 = (a.astype(np.int64) for a in answers[2])
        if 3 in answers:
            self.taken1, self.n1, self.own_state, self.taken2, self.n2, _ = (a.astype(np.int64) for a in answers[3])

    def asked(self, step: int) -> list[tuple]:
        """(sorted keys, their values...) of each kind."""
        if step == 1:
            return [(self.words, self.word_counts), (self.pairs, self.pair_counts)]
        if step == 2:
            return [(self.triples, self.triple_counts)]
        own = self.arcs[self.own2[self.arcs] > 0]
        own3 = np.flatnonzero((self.c3 >= MIN_COUNT) & (self.own3 > 0))
        return [(keys, np.bincount(x, c, len(keys)).astype(np.uint64), np.bincount(x, minlength=len(keys)).astype(np.uint64)) for keys, x, c in (
            (self.states, self.x[own], self.c2[own]), (self.pairs[self.arcs], self.x3[own3], self.c3[own3]))]

    def weigh(self, total: int, distinct: int, texts: int) -> None:
        """Costs and weights of all its n-grams."""
        def left(mass, taken, n):
            return np.where(n > 0, np.maximum(1 - (taken - DISCOUNT * n) / np.maximum(mass, 1), 1e-12), 1.0)

        at, known = lookup(self.words, self.states)
        mass = np.where(known, self.c1[at], texts)                 # that of START
        self.left1 = left(mass, self.taken1, self.n1)
        base = np.log10((self.c1 + 1) / float(total + distinct + 1))
        c, x, y = self.c2[self.arcs], self.x[self.arcs], self.y[self.arcs]
        self.cost = np.log10((c - DISCOUNT) / np.maximum(mass[x], 1) + self.left1[x] * 10 ** base[y])
        self.left2 = left(c, self.taken2, self.n2)
        self.weight2 = self.cost - np.log10(self.left1[x]) - base[y] + np.log10(self.left2)
        self.arcs3 = np.flatnonzero(self.c3 >= MIN_COUNT)
        x, y = self.x3[self.arcs3], self.y3[self.arcs3]
        self.weight3 = (np.log10((self.c3[self.arcs3] - DISCOUNT) / c[x] + self.left2[x] * 10 ** self.cost[y])
                        - np.log10(self.left2[x]) - self.cost[y])

    def read(self, a: Automaton) -> dict:
        """Traversal of its texts: ``a`` holds the frequent n-grams, the weights of all others are its own."""
        base = np.log10(self.c1 + 1)
        pair, triple = np.zeros(len(self.pairs)), np.zeros(len(self.triples))
        pair[self.arcs], triple[self.arcs3] = self.weight2, self.weight3
        at_place = np.zeros(len(self.places))
        at_place[self.triple_places] = triple[self.triple_at]
        left = np.log10(self.left1[np.searchsorted(self.states, self.words)])
        return a.read(self.words, self.places, self.starts, (self.c1 > 0, base, base + left), pair[self.pair_at], at_place)

    def head(self, least: float) -> list[pd.DataFrame]:
        """(size, x, y, k, c, cost, left) of its own n-grams with ``least`` occurrences, and of START as one of size 0."""
        def frame(size, at, x, y, k, c, cost, left):
            return pd.DataFrame({"size": np.full(len(c[at]), size), "x": x[at].view(np.int64), "y": y[at].view(np.int64), "k": k[at].view(np.int64),
                                 "c": c[at], "cost": cost[at], "left": left[at]})

        pairs, s = self.pairs[self.arcs], np.searchsorted(self.states, self.words)
        c, c3 = self.c2[self.arcs], self.c3[self.arcs3]
        none, first = np.zeros(len(self.states)), np.flatnonzero((self.states == START) & (self.own_state > 0))
        return [frame(0, first, self.states, self.states, self.states, self.n1, none, self.left1),
                frame(1, (self.c1 >= least) & (self.c1 > 0) & (self.own1 > 0), self.words, self.words, self.words, self.c1, none[s], self.left1[s]),
                frame(2, (c >= least) & (self.own2[self.arcs] > 0), self.states[self.x[self.arcs]], self.words[self.y[self.arcs]], pairs, c, self.cost, self.left2),
                frame(3, (c3 >= least) & (self.own3[self.arcs3] > 0), pairs[self.x3[self.arcs3]], pairs[self.y3[self.arcs3]],
                      self.triples[self.arcs3], c3, self.weight3, np.ones(len(c3)))]


def ask(step: int, parts: int):
    """Rows (block, step, part, data) of what each block asks in a step."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        edges = np.arange(1, parts, dtype=np.uint64) * U((1 << 64) // parts)
        for rows in groups(batches, "block"):
            kinds = Block(rows).asked(step)
            cuts = [np.concatenate([[0], np.searchsorted(k[0], edges), [len(k[0])]]) for k in kinds]
            for p in range(parts):
                if any(c[p] < c[p + 1] for c in cuts):
                    some = [a[c[p]:c[p + 1]] for k, c in zip(kinds, cuts) for a in k]
                    keys = range(0, len(some), len(some) // len(kinds))
                    data = packed(*(np.diff(a, prepend=U(0)) if i in keys else a for i, a in enumerate(some)))
                    yield pa.RecordBatch.from_arrays([pa.array([rows[0]["block"]]), pa.array([step], pa.int32()), pa.array([p], pa.int32()),
                                                      pa.array([data], pa.binary())], ["block", "step", "part", "data"])
    return run


def answer(kinds: int):
    """Adds up what all blocks say of a key; the answers to each, and by part how many different keys of the first kind have
    a first value beyond 0, their sum, and that of END."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in groups(batches, "part"):
            asked = [unpacked(r["data"]) for r in rows]
            width, answers, stats = len(asked[0]) // kinds, [[] for _ in rows], []
            for kind in range(0, kinds * width, width):
                keys, first, at = different(np.concatenate([np.cumsum(a[kind], dtype=np.uint64) for a in asked]))
                sums = [np.bincount(at, np.concatenate([a[kind + i] for a in asked]), len(keys)).astype(np.uint64) for i in range(1, width)]
                own = np.zeros(len(at), np.uint8)
                own[first] = 1
                stats = stats or [np.count_nonzero(sums[0]), int(sums[0].sum()), int(sums[0][keys == END].sum())]
                to = np.cumsum([0] + [len(a[kind]) for a in asked])
                for i, (b, e) in enumerate(zip(to[:-1], to[1:])):
                    answers[i] += [*(s[at[b:e]] for s in sums), own[b:e]]
            for r, a in zip(rows, answers):
                columns = [pa.array([r["block"]]), pa.array([r["step"]], pa.int32()), pa.array([r["part"]], pa.int32()), pa.array([packed(*a)], pa.binary())]
                yield pa.RecordBatch.from_arrays([*columns, *(pa.array([x]) for x in stats)],
                                                 ["block", "step", "part", "data", "different", "total", "ends"])
                stats = [0, 0, 0]
    return run


class Automaton:
    """The frequent words, pairs and triples, as sorted arrays.

    ``states`` are sorted by hash and state i is the i-th; the start state comes after them.  A pair's
    arc is also a state; ``after`` is its left-over mass, and triples are pairs of arcs.
    """

    def __init__(self, words, counts, total: int, distinct: int):
        order = np.argsort(words)
        self.words, self.counts = words[order], counts[order]
        self.total, self.floor = total, total + distinct + 1
        self.states = self.words[self.words != END]
        self.left = np.ones(len(self.states) + 1)
        self.arcs, self.arc_cost, self.after = np.zeros(0, np.int64), np.zeros(0), np.zeros(0)
        self.triples, self.triple_weight = np.zeros(0, np.int64), np.zeros(0)

    def place(self, tokens: np.ndarray) -> np.ndarray:
        """State number of each token; -1 for words without a state, and for END the number of states + 1."""
        at, known = lookup(self.states, tokens)
        return np.where(known, at, np.where(tokens == END, len(self.states) + 1, -1))

    def source(self, tokens: np.ndarray) -> np.ndarray:
        """State number of each context; -1 for words without a state."""
        return np.where(tokens == START, len(self.states), self.place(tokens))

    def add_left(self, contexts: np.ndarray, left: np.ndarray) -> None:
        self.left[self.source(contexts)] = left

    def add_arcs(self, before, tokens, pair, cost, after) -> None:
        keys = self.source(before) * (len(self.states) + 2) + self.place(tokens)
        order = np.argsort(keys)
        self.arcs, self.arc_cost, self.after = keys[order], cost[order], after[order]
        by_pair = np.argsort(pair[order])
        self.pairs, self.arc_of = pair[order][by_pair], by_pair

    def add_triples(self, first, second, weight) -> None:
        at = [self.arc_of[lookup(self.pairs, p)[0]] if len(p) else np.zeros(0, np.int64) for p in (first, second)]
        keys = at[0] * len(self.arcs) + at[1]
        order = np.argsort(keys)
        self.triples, self.triple_weight = keys[order], weight[order]
        del self.pairs, self.arc_of

    def base(self, tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(log10 add-one probability, whether the word is among the frequent ones)."""
        at, known = lookup(self.words, tokens)
        c = self.counts[at] if len(self.words) else np.zeros(len(tokens))
        return np.log10((np.where(known, c, 0) + 1) / self.floor), known

    def read(self, words: np.ndarray, places: np.ndarray, starts: np.ndarray, others: tuple, pair: np.ndarray, triple: np.ndarray) -> dict:
        """Traversal of some texts, whose tokens are ``words[places]``: weights added up by text.

        ``others`` (known, base, weight of each of the words), ``pair`` and ``triple`` (weights at each place) count for the
        n-grams that it does not hold.
        """
        n, left = len(self.states), np.log10(self.left)
        base, held = self.base(words)
        more = [np.where(held, 0, x) for x in others]
        state = self.place(words)
        place = state[places]
        source = np.concatenate([[n], place[:-1]])
        source[starts] = n
        cost = (base + more[2] + np.where((state >= 0) & (state < n), left[np.minimum(state, n)], 0.0))[places]
        cost[starts] += left[-1]
        at, arc = lookup(self.arcs, source * (n + 2) + place)
        arc &= (source >= 0) & (place >= 0)
        cost += np.where(arc, 0, pair) + triple
        if len(self.arcs):
            on = np.flatnonzero(arc)
            cost[on] += self.arc_cost[at[on]] + np.log10(self.after[at[on]]) - left[source[on]] - base[places[on]]
        inner = np.ones(len(places), bool)
        inner[starts] = False                                      # a text's first token ends no triple
        second = np.flatnonzero(inner[1:] & arc[1:] & arc[:-1]) + 1
        at3, known3 = lookup(self.triples, at[second - 1] * len(self.arcs) + at[second])
        if len(self.triples):
            on = second[known3]
            cost[on] += self.triple_weight[at3[known3]] - triple[on]
        add = (lambda x: np.add.reduceat(x, starts) if len(starts) else x[:0])
        return {"n_tokens": np.diff(np.append(starts, len(places))), "n_known": add((held + more[0])[places].astype(np.int64)),
                "base": add((base + more[1])[places]), "cost": add(cost)}


def uint(column: pd.Series) -> np.ndarray:
    return column.to_numpy(np.int64).view(np.uint64)


def together(tables: list[DataFrame]) -> DataFrame:
    """The rows of each block and of the answers to it, one after the other."""
    out = tables[0].drop("tokens").withColumns({"step": F.lit(0), "part": F.lit(0)})
    for t in tables[1:]:
        out = out.unionByName(t.select("block", "step", "part", "data"), allowMissingColumns=True)
    return out.repartition("block").sortWithinPartitions("block", "step", "part")


def exchange(spark: SparkSession, tables: list[DataFrame], step: int, kinds: int, parts: int) -> DataFrame:
    asked = together(tables).mapInArrow(ask(step, parts), ROWS)
    return stored(spark, asked.repartition("part").sortWithinPartitions("part", "block")
                  .mapInArrow(answer(kinds), f"{ROWS}, different long, total long, ends long"), f"answers-{step}")


def heads(least: float, sums: tuple[int, int, int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in groups(batches, "block"):
            block = Block(rows)
            block.weigh(*sums)
            for f in block.head(least):
                yield pa.RecordBatch.from_pandas(f, preserve_index=False)
    return run


def train(spark: SparkSession, rows: DataFrame) -> tuple[tuple[list[DataFrame], tuple[int, int, int]], Automaton, int]:
    """((the stored blocks and answers to them, (training tokens, different ones, texts)), automaton of the frequent n-grams,
    training tokens)."""
    id_type = rows.schema["id"].dataType
    arrow_type = rows.select("id").limit(0).toArrow().schema.field(0).type
    blocks = stored(spark, rows.mapInArrow(to_blocks(arrow_type), f"tokens long, data binary, ids array<{id_type.simpleString()}>, folds array<boolean>")
                    .withColumn("block", F.monotonically_increasing_id()), "blocks")
    tokens = blocks.agg(F.coalesce(F.sum("tokens"), F.lit(0))).first()[0]
    parts = max(2 * spark.sparkContext.defaultParallelism, -(-tokens // PART_TOKENS))
    tables = [blocks]
    for step, kinds in ((1, 2), (2, 1), (3, 2)):
        tables.append(exchange(spark, tables, step, kinds, parts))
    distinct, total, texts = tables[1].agg(*[F.coalesce(F.sum(c), F.lit(0)) for c in ("different", "total", "ends")]).first()
    sums = (total, distinct, texts)
    found = stored(spark, together(tables).mapInArrow(heads(HEAD_SHARE * total, sums), "size long, x long, y long, k long, c long, cost double, left double"), "head")
    head = found.toPandas()                                        # at most 1 / share rows of each order
    drop_stored(spark, found)
    start, words, arcs, triples = (head[head["size"] == n] for n in range(4))
    a = Automaton(uint(words["k"]), words["c"].to_numpy(np.int64), total, distinct)
    left = pd.concat([start, words[words["k"] != int(END)]])
    a.add_left(uint(left["x"]), left["left"].to_numpy())
    a.add_arcs(uint(arcs["x"]), uint(arcs["y"]), uint(arcs["k"]), arcs["cost"].to_numpy(), arcs["left"].to_numpy())
    a.add_triples(uint(triples["x"]), uint(triples["y"]), triples["cost"].to_numpy())
    return (tables, sums), a, total


def automaton(shared) -> Automaton:
    a = Automaton.__new__(Automaton)
    a.__dict__.update(shared.value)
    return a


def read_texts(shared, sums: tuple[int, int, int], id_type: pa.DataType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a = automaton(shared)
        for rows in groups(batches, "block"):
            block = Block(rows)
            block.weigh(*sums)
            out = block.read(a)
            yield pa.RecordBatch.from_arrays([
                pa.array(block.ids, id_type), pa.array(block.held_out), pa.array(out["n_tokens"]), pa.array(out["n_known"]),
                pa.array(np.full(len(block.starts), sums[0])), pa.array(out["base"]), pa.array(out["cost"])],
                ["id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])
    return run


def score(spark: SparkSession, docs: DataFrame, id_col="doc_id", text_col="text") -> DataFrame:
    """(id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row."""
    rows = with_fold(docs, id_col, text_col)
    (tables, sums), a, _ = train(spark, rows)
    shared = spark.sparkContext.broadcast(vars(a))
    out = stored(spark, together(tables).mapInArrow(
        read_texts(shared, sums, rows.select("id").limit(0).toArrow().schema.field(0).type),
        f"id {rows.schema['id'].dataType.simpleString()}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"), "scores")
    drop_stored(spark, *tables)
    return out


def op7_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(spark, table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")
