"""What blocks of texts ask of each other is all that moves: packed, once for each block that has an n-gram."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfprice.llm import lm_score
from shelfprice.llm.common import drop_stored


def some_texts(n=400):
    rnd = random.Random(5)
    return [(i if i % 9 else None, None if i % 50 == 7 else " ".join(f"w{int(rnd.paretovariate(0.7)) % 900}" for _ in range(rnd.randrange(0, 40))))
            for i in range(n)]


@pytest.mark.parametrize("size", [1, 50, 3000])
def test_blocks_of_any_size_give_the_same_scores(spark, monkeypatch, size):
    df = spark.createDataFrame(some_texts(), "doc_id long, text string").repartition(3, F.xxhash64("doc_id", "text"))
    want = sorted(lm_score.score(spark, df).collect(), key=str)
    monkeypatch.setattr(lm_score, "BLOCK_TOKENS", size)
    monkeypatch.setattr(lm_score, "PART_TOKENS", 200)
    got = sorted(lm_score.score(spark, df).collect(), key=str)
    assert len(got) == 400
    assert [r[:5] for r in got] == [r[:5] for r in want] and np.allclose([r[5:] for r in got], [r[5:] for r in want], rtol=0, atol=1e-9)


def test_what_moves_is_a_few_bytes_an_n_gram(spark, monkeypatch):
    """Stored blocks and answers; a row for each place with its 64-bit hashes took more than 16 bytes."""
    monkeypatch.setattr(lm_score, "HEAD_SHARE", 2)
    rnd = random.Random(1)
    texts = [(i, " ".join(f"x{rnd.randrange(2000)}" for _ in range(500))) for i in range(400)]
    (tables, (total, *_)), _, _ = lm_score.train(spark, lm_score.with_fold(spark.createDataFrame(texts, "doc_id long, text string"), "doc_id", "text"))
    tokens = tables[0].agg(F.sum("tokens")).first()[0]
    moved = sum(t.agg(F.sum(F.octet_length("data"))).first()[0] for t in tables)
    asked = lm_score.together(tables[:1]).mapInArrow(lm_score.ask(1, 8), lm_score.ROWS).agg(F.sum(F.octet_length("data"))).first()[0]
    assert tokens == 400 * 501 and 0 < total < tokens
    assert moved < 8 * tokens and asked < 9 * tokens
    drop_stored(spark, *tables)


def test_arrays_survive_packing():
    arrays = [np.array([], np.uint64), np.array([0, 2 ** 64 - 1, 5], np.uint64), np.arange(7, dtype=np.uint32), np.array([1, 0], np.uint8)]
    back = lm_score.unpacked(lm_score.packed(*arrays))
    assert [(a.dtype, a.tolist()) for a in back] == [(a.dtype, a.tolist()) for a in arrays]


def test_ids_keep_their_type_and_value(spark):
    df = spark.createDataFrame([(2 ** 62 + 1, "a b"), (None, "a"), (5, "b")], "doc_id long, text string")
    assert {r.id for r in lm_score.score(spark, df).collect()} == {2 ** 62 + 1, None, 5}
    text = df.withColumn("doc_id", F.struct(F.col("doc_id").cast("string").alias("s"), F.lit("x").alias("t")))
    got = lm_score.score(spark, text)
    assert got.schema["id"].dataType.simpleString() == text.schema["doc_id"].dataType.simpleString() and got.count() == 3
