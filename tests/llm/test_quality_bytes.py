"""The quality model is over the bytes as they are: no letter, digit, case or mark stands for another."""

import random
from collections import Counter, defaultdict
from math import log10

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from shelfprice.llm import quality

TEXTS = ["Im Jahr 1984 kam er an.", "im jahr 1999, kam sie an", "ПРИВЕТ и привет; привет!", "é è ê ü ß", "a", "aaaaab aaab", "0123 x 0124"] * 3


def plain_kneser_ney(texts):
    """log10 P(byte | three before) by the formulas, with dictionaries."""
    counts = Counter()
    for t in texts:
        b = (255,) * 3 + tuple(t.encode())
        counts.update(b[i:i + 4] for i in range(len(b) - 3))
    levels = {4: counts}
    for n in (3, 2, 1):
        levels[n] = Counter(g[1:] for g in levels[n + 1])
    d = {n: quality.discounts(np.array(list(c.values()))) for n, c in levels.items()}
    total, off = {n: Counter() for n in levels}, {n: defaultdict(float) for n in levels}
    for n, c in levels.items():
        for g, k in c.items():
            total[n][g[:-1]] += k
            off[n][g[:-1]] += d[n][min(k, 3)]

    def p(g):
        n = len(g)
        if not n:
            return 1 / 256
        shorter = p(g[1:])
        if not total[n][g[:-1]]:
            return shorter
        k = levels[n][g]
        return (k - d[n][min(k, 3)] + off[n][g[:-1]] * shorter) / total[n][g[:-1]]
    return lambda g: log10(p(g))


def model_of(texts):
    counted = pd.concat(quality.count_grams(iter([pd.DataFrame({"lang": "x", "text": texts})])))
    grams = quality.kneser_ney(pd.Series(counted["n"].to_numpy(), counted["gram"].to_numpy()))
    return quality.Model({quality.POOLED: type("Shared", (), {"value": grams.parts()})}, {})


def test_perplexities_equal_plain_kneser_ney_over_bytes():
    p, rnd = plain_kneser_ney(TEXTS), random.Random(3)
    asked = [*TEXTS[:7], "Иной текст 1985!", "\x00\x01 new", "".join(rnd.choice("aabé1И \n") for _ in range(300))]
    got = model_of(TEXTS).perplexities(pd.Series(asked), pd.Series("x", index=range(len(asked))))
    for t, ppl in zip(asked, got):
        b = (255,) * 3 + tuple(t.encode())
        want = 10 ** -np.mean([p(b[i:i + 4]) for i in range(len(b) - 3)])
        assert abs(ppl / want - 1) < 1e-5


def test_probabilities_of_all_bytes_add_up():
    grams = model_of(TEXTS).table(quality.POOLED)
    for before in ("prä", "198", "\x07\x08\x09", "а п"):
        context = int.from_bytes(before.encode()[-3:], "big")
        assert abs((10 ** grams.log10_p(context * 256 + np.arange(256))).sum() - 1) < 1e-5


def test_other_letters_digits_and_cases_are_other_texts(spark):
    """Each text of junk has the classes of a trusted one: capitals, digits and letters beyond ASCII are dealt anew."""
    rnd = random.Random(8)
    words = ["ДОМ 17", "МОСТ 25", "Париж 17", "школа 25", "Рим 40", "ветер"]
    good = [" ".join(rnd.choices(words, k=30)) for _ in range(400)]

    def dealt(t):
        upper, lower, digits = ([chr(c) for c in range(a, b)] for a, b in ((0x410, 0x430), (0x430, 0x440), (0x30, 0x3A)))
        kind = (lambda c: upper if c.isupper() else digits if c.isdigit() else lower if c.isalpha() else [c])
        return "".join(rnd.choice(kind(c)) for c in t)

    rows = [*enumerate(good), *((1000 + i, dealt(t)) for i, t in enumerate(good[:40]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("lang", F.lit("ru"))
    labels = spark.range(400).select(F.col("id").alias("doc_id"), F.lit(1).alias("quality"), F.lit(0).alias("toxic"))
    got = {r.id: r.accepted for r in quality.classify(spark, docs, labels).collect()}
    assert sum(got[i] for i in range(400)) > 380 and not any(got[1000 + i] for i in range(40))
    ppl = model_of(["Code 1234 of Ann"] * 9).perplexities(pd.Series(["Code 1234 of Ann", "Bode 1234 of Ann", "Code 9234 of Ann"]), pd.Series(["x"] * 3))
    assert ppl[0] < min(ppl[1:])
