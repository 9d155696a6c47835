"""Quality classifier: perplexity under an interpolated modified Kneser-Ney model of trusted text.

The model is of order 4 over the bytes of UTF-8 as they are, one per language: every letter of every script,
case, digit and mark is a symbol of its own.  Only n-grams that occur are held, with what each context leaves
to the one a byte shorter.  Trusted text is the documents quality 1 and not toxic, and each of them is used: three quarters, by hashes of their ids, train the
model of their language; the perplexities of all others, which the model has not seen, give the
language's threshold, their ``quantile``, read off counts of
perplexities in buckets of BUCKET in log10.  Counts are gathered in shards (each task adds up what it
reads, a grouping by language and n-gram joins the shards); the finished tables are
broadcast one by one, tasks load those they need, and every document is scored in one map over the
whole corpus.  Only where a caller asks for it (``max_trusted``), fewer documents of a language train.

A document is accepted if its perplexity is at most its language's threshold.

Defined results: a null or empty text has a null perplexity and is rejected; a null language is
one of its own; a language with fewer than MIN_CALIBRATION trusted documents that do not train, or
without any that trains, uses the model of all trusted text and the quantile of all under that model;
labels with nulls or contradicting rows are not trusted; repeated rows are scored alike; without
any trusted document every text is accepted; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import BASE, U, chunks, lookup, small_side, stored, sum_counts, table

ORDER, BYTES = 4, 256
SYMBOLS = 40              # alphabet of the whole tables of counts that ``kneser_ney`` takes too
START = 0xFF              # before a text; no byte of UTF-8
HELD_LANGUAGES = 8        # tables a task holds at a time
MAX_COUNTED = 1 << 21     # different n-grams of all its languages a task holds before it passes them on
FRONT_BITS = 17           # of the places looked at before a search
MIN_CALIBRATION = 20
QUANTILE, BUCKET = 0.998, 1e-4
MAX_BROADCAST = 1_000_000
POOLED = "\x00"           # key of the model of all trusted text


def text_grams(text: bytes) -> np.ndarray:
    """The key of the n-gram ending at each byte."""
    s = np.frombuffer(bytes([START] * (ORDER - 1)) + text, np.uint8).astype(np.int64)
    key = s[:len(text)].copy()
    for j in range(1, ORDER):
        key = key * BYTES + s[j:j + len(text)]
    return key


def discounts(counts: np.ndarray) -> np.ndarray:
    """Modified Kneser-Ney discounts for counts 0, 1, 2 and 3 or more."""
    n = [0] + [int((counts == i).sum()) for i in range(1, 5)]
    if not (n[1] and n[2]):
        return np.array([0, 0.5, 0.5, 0.5])
    y = n[1] / (n[1] + 2 * n[2])
    d = [0.0] + [i - (i + 1) * y * n[i + 1] / n[i] if n[i] else 0.5 * i for i in (1, 2, 3)]
    return np.clip(d, [0, 0.05, 0.05, 0.05], [0, 0.95, 1.95, 2.95])


class Values:
    """Values by key: sorted arrays, and before them one place for each hash, which the frequent keys take."""

    def __init__(self, keys: np.ndarray, values: np.ndarray, front: np.ndarray):
        self.keys, self.values, self.front = keys, values, front

    @classmethod
    def of(cls, keys: np.ndarray, values: np.ndarray, counts: np.ndarray) -> Values:
        front, often = np.zeros(1 << FRONT_BITS, np.int32), np.argsort(counts, kind="stable")
        front[cls.place(keys[often])] = often                      # of equal places the last counts
        return cls(keys, values.astype(np.float32), front)

    @staticmethod
    def place(keys: np.ndarray) -> np.ndarray:
        return (keys.astype(np.uint64) * U(BASE) >> U(64 - FRONT_BITS)).astype(np.int64)

    def get(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(value of each key, whether it is there)."""
        if not len(self.keys):
            return np.zeros(len(keys), np.float32), np.zeros(len(keys), bool)
        at = self.front[self.place(keys)]
        known = self.keys[at] == keys
        rest = np.flatnonzero(~known)
        at[rest], known[rest] = lookup(self.keys, keys[rest])
        return self.values[at], known


class NGrams:
    """Interpolated model of order ORDER: by order, log10 probabilities of the n-grams that occur and, of the contexts
    that do, log10 of the share that is left to the context one shorter."""

    def __init__(self, symbols: int, levels: list[tuple[Values, Values]]):
        self.symbols, self.levels = symbols, levels

    @classmethod
    def of(cls, keys: np.ndarray, counts: np.ndarray, symbols: int) -> NGrams:
        levels, out = [(keys, counts)], []                         # keys ascend
        while len(levels) < ORDER:                                 # distinct left extensions
            levels.append(np.unique(levels[-1][0] % symbols ** (ORDER - len(levels)), return_counts=True))
        lower, p = np.arange(symbols), np.full(symbols, 1 / symbols)
        for n, (keys, counts) in enumerate(reversed(levels)):
            d = discounts(counts)[np.minimum(counts, 3)]
            contexts, at, of = np.unique(keys // symbols, return_inverse=True, return_counts=True)
            total = np.bincount(at, counts, len(contexts))
            left = np.bincount(at, d, len(contexts)) / total
            p = (counts - d) / total[at] + left[at] * p[lookup(lower, keys % symbols ** max(n, 1))[0]]
            lower = keys
            out.insert(0, (Values.of(keys, np.log10(p), counts), Values.of(contexts, np.log10(left), of)))
        return cls(symbols, out)

    def parts(self) -> tuple:
        """Plain arrays, which workers without this package can read."""
        return self.symbols, [tuple(vars(x) for x in level) for level in self.levels]

    @classmethod
    def from_parts(cls, symbols: int, levels: list) -> NGrams:
        return cls(symbols, [tuple(Values(**x) for x in level) for level in levels])

    def log10_p(self, keys: np.ndarray) -> np.ndarray:
        """log10 P(last | those before) of each n-gram."""
        out, at = np.zeros(len(keys)), np.arange(len(keys))
        for n, (grams, contexts) in zip(range(ORDER - 1, -1, -1), self.levels):
            value, known = grams.get(keys)
            out[at[known]] += value[known]
            at, keys = at[~known], keys[~known]
            left, known = contexts.get(keys // self.symbols)
            out[at] += np.where(known, left, 0)
            keys = keys % self.symbols ** max(n, 1)
        out[at] -= np.log10(self.symbols)
        return out


def kneser_ney(top: pd.Series | np.ndarray) -> NGrams | np.ndarray:
    """The model of the counts of the highest order, by key over bytes in ascending order.

    Of a whole table over SYMBOLS symbols the result is one as well: log10 P(last | three before) of every n-gram.
    """
    if isinstance(top, np.ndarray):
        at = np.flatnonzero(top)
        return NGrams.of(at, top[at], SYMBOLS).log10_p(np.arange(len(top)))
    return NGrams.of(top.index.to_numpy(np.int64), top.to_numpy(np.int64), BYTES)


class Model:
    """N-grams (broadcast) and perplexity threshold of each language."""

    def __init__(self, tables: dict, thresholds: dict):
        self.tables, self.thresholds, self.loaded = tables, thresholds, []

    def key(self, lang) -> str:
        lang = lang if isinstance(lang, str) else ""
        return lang if lang in self.tables else POOLED

    def table(self, key: str) -> NGrams:
        if key not in self.loaded:
            if len(self.loaded) >= HELD_LANGUAGES:
                vars(self.tables[self.loaded.pop(0)]).pop("_value", None)      # read again when it is needed again
            self.loaded.append(key)
        return NGrams.from_parts(*self.tables[key].value)

    def perplexities(self, texts: pd.Series, langs: pd.Series) -> np.ndarray:
        out = np.full(len(texts), np.nan)
        keys = [self.key(x) for x in langs]
        for key in sorted(set(keys)):
            at, grams = np.flatnonzero([k == key for k in keys]), self.table(key)
            for first, held in chunks(texts.iloc[at]):
                sizes = np.array([len(b) for b in held])
                full = np.flatnonzero(sizes)
                if len(full):
                    logs = grams.log10_p(np.concatenate([text_grams(b) for b in held if b]))
                    starts = np.cumsum(sizes[full]) - sizes[full]
                    out[at[first + full]] = 10 ** -(np.add.reduceat(logs, starts) / sizes[full])
        return out


def trusted_ids(labels: DataFrame) -> DataFrame:
    """(trusted_id) of the documents labelled good."""
    return (labels.filter("doc_id is not null").groupBy("doc_id")
            .agg(F.min(F.coalesce("quality", F.lit(0))).alias("quality"), F.max(F.coalesce("toxic", F.lit(1))).alias("toxic"))
            .filter("quality = 1 and toxic = 0").select(F.col("doc_id").alias("trusted_id")))


def count_grams(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    held, size = {}, 0

    def frames() -> Iterator[pd.DataFrame]:
        for lang, parts in held.items():
            keys, n = sum_counts(parts)
            yield pd.DataFrame({"lang": lang, "gram": keys, "n": n})
        held.clear()

    for b in batches:
        for lang, texts in b.groupby("lang")["text"]:
            for _, some in chunks(texts):
                parts = held.setdefault(lang, [])
                parts.append(np.unique(np.concatenate([text_grams(t) for t in some]), return_counts=True))
                size += len(parts[-1][0])
                if size > 2 * MAX_COUNTED:
                    held.update({k: [sum_counts(v)] for k, v in held.items()})
                    size = sum(len(v[0][0]) for v in held.values())
                    if size > MAX_COUNTED:
                        yield from frames()
                        size = 0
    yield from frames()


def fit(spark: SparkSession, docs: DataFrame, labels: DataFrame, id_col="doc_id", text_col="text", lang_col="lang",
        max_trusted: int | None = None, quantile=QUANTILE) -> Model:
    ids = small_side(stored(spark, trusted_ids(labels), "trusted-ids"), MAX_BROADCAST)
    trusted = (docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(lang_col), F.lit("")).alias("lang"), F.col(text_col).alias("text"))
               .filter("text != ''").join(ids, F.col("id") == F.col("trusted_id")).drop("trusted_id"))
    trains = F.pmod(F.xxhash64("id", F.lit(9)), F.lit(4)) != 0
    if max_trusted is not None:
        sizes = stored(spark, trusted.groupBy("lang").agg(F.count("*").alias("size")), "trusted-sizes")
        place = F.pmod(F.xxhash64("id", F.lit(10)), F.lit(1 << 40)) / F.lit(float(1 << 40))
        trusted, trains = trusted.join(small_side(sizes, MAX_BROADCAST), "lang"), trains & (place * F.col("size") < max_trusted)
    trusted = trusted.withColumn("trains", trains).drop("size")
    counts = stored(spark, trusted.filter("trains").select("lang", "text").mapInPandas(count_grams, "lang string, gram long, n long")
                    .groupBy("lang", "gram").agg(F.sum("n").alias("n")), "gram-counts")
    others = trusted.filter("not trains").groupBy("lang").agg(F.count("*").alias("n")).filter(F.col("n") >= MIN_CALIBRATION)
    langs = sorted(r["lang"] for r in others.join(counts.select("lang").distinct(), "lang").collect())

    def shared_table(own: DataFrame):
        own = own.toPandas().sort_values("gram")                   # the different sequences of four bytes
        return spark.sparkContext.broadcast(kneser_ney(pd.Series(own["n"].to_numpy(np.int64), own["gram"].to_numpy(np.int64))).parts())

    tables = {k: shared_table(counts.filter(F.col("lang") == k).select("gram", "n")) for k in langs}
    tables[POOLED] = shared_table(counts.groupBy("gram").agg(F.sum("n").alias("n")))
    model = Model(tables, {})
    held = trusted.filter("not trains").select("lang", both_scorer(spark, model)("text", "lang").alias("ppl"))
    both = F.array(F.struct(F.col("lang").alias("key"), F.col("ppl.own").alias("ppl")),
                   F.struct(F.lit(POOLED).alias("key"), F.col("ppl.pooled").alias("ppl")))
    buckets = (held.select(F.explode(both).alias("x")).select("x.*").filter(F.col("key").isin([*langs, POOLED]))
               .groupBy("key", F.floor(F.log10("ppl") / BUCKET).alias("bucket"))
               .agg(F.count("*").alias("n"), F.max("ppl").alias("ppl")).toPandas())     # bounded by the buckets
    model.thresholds = {POOLED: float("inf")}
    for key, b in buckets.sort_values("bucket").groupby("key"):
        reached = b["n"].cumsum().to_numpy()
        model.thresholds[key] = float(b["ppl"].iloc[int(np.searchsorted(reached, quantile * reached[-1]))])
    return model


def scorer(spark: SparkSession, model: Model):
    shared = model.tables

    @F.pandas_udf("double")
    def perplexity(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        m = Model(shared, {})
        for texts, langs in batches:
            yield pd.Series(m.perplexities(texts, langs))
    return perplexity


def both_scorer(spark: SparkSession, model: Model):
    """Perplexities under a text's own model and that of all text, by one function: with two, every task holds two Python workers."""
    shared = model.tables

    @F.pandas_udf("own double, pooled double")
    def perplexities(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        m = Model(shared, {})
        for texts, langs in batches:
            yield pd.DataFrame({"own": m.perplexities(texts, langs),
                                "pooled": m.perplexities(texts, pd.Series(POOLED, index=texts.index))})
    return perplexities


def threshold_of(model: Model, lang_col: str):
    own = [F.lit(x) for key, t in sorted(model.thresholds.items()) if key != POOLED for x in (key, t)]
    pooled = F.lit(model.thresholds[POOLED])
    return F.coalesce(F.try_element_at(F.create_map(*own), F.coalesce(F.col(lang_col), F.lit(""))), pooled) if own else pooled


def classify(spark: SparkSession, docs: DataFrame, labels: DataFrame, id_col="doc_id", text_col="text", lang_col="lang",
             **options) -> DataFrame:
    """(id, lang, perplexity, threshold, accepted) of every row."""
    model = fit(spark, docs, labels, id_col, text_col, lang_col, **options)
    ppl = F.nanvl(scorer(spark, model)(text_col, lang_col), F.lit(None).cast("double"))
    rows = docs.select(F.col(id_col).alias("id"), F.col(lang_col).alias("lang"), ppl.alias("perplexity"),
                       threshold_of(model, lang_col).alias("threshold"))
    return rows.withColumn("accepted", F.coalesce(F.col("perplexity") <= F.col("threshold"), F.lit(False)))


def keep_accepted(spark: SparkSession, docs: DataFrame, labels: DataFrame, id_col="doc_id", text_col="text",
                  lang_col="lang", **options) -> DataFrame:
    """The rows of ``docs`` that the classifier accepts, all columns as they are."""
    model = fit(spark, docs, labels, id_col, text_col, lang_col, **options)
    return docs.filter(scorer(spark, model)(text_col, lang_col) <= threshold_of(model, lang_col)).filter(
        F.length(text_col) > 0)


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).withColumnRenamed("id", "doc_id")
