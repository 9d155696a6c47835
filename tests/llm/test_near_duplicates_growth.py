"""What near duplicates compare and verify grows with the members of a group, not with their pairs."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfprice.llm import jaccard_join


def described(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "id long, text string").withColumn("text_key", F.xxhash64("text"))
    return jaccard_join.describe(df, 5).select(F.col("id").alias("class"), "n", "sketch")


def near_copies(count, words=40):
    return [" ".join(f"w{j}" if j else f"first{i}" for j in range(words)) for i in range(count)]


def test_large_sets_that_share_nothing_are_not_likely_pairs(spark):
    texts = [" ".join(f"{name}{j}" for j in range(6000)) for name in "abc"] + [" ".join(f"a{j}" for j in range(5900))]
    classes = described(spark, texts)
    pairs = spark.createDataFrame([(0, 1), (0, 2), (1, 2), (0, 3)], "a long, b long")
    assert [tuple(r) for r in jaccard_join.likely(pairs, classes, 80).collect()] == [(0, 3)]


def test_folded_sketches_are_those_of_fewer_cells():
    s = np.random.default_rng(5).integers(0, 1 << 63, 5000).astype(np.uint64)
    sizes = [jaccard_join.BITS, 2 * jaccard_join.BITS, jaccard_join.cells(len(s))]
    assert sizes[-1] == 8192
    both = jaccard_join.Sketches([jaccard_join.sketch(s, n) for n in sizes])
    for i in range(3):
        for j in range(3):
            size = min(sizes[i], sizes[j]) // 8
            assert both.differing(np.array([i]), both, np.array([j]), size).tolist() == [0]


@pytest.mark.parametrize("within", [False, True])
def test_nearest_pairs_of_a_group_are_a_forest(spark, within):
    classes = described(spark, near_copies(60)).withColumn("sig", F.lit(1)).withColumn("size", F.lit(60)).withColumn("component", F.col("class"))
    pairs = jaccard_join.block_pairs(classes, 80, True, within).collect()
    assert len(pairs) == 59
    assert {x for r in pairs for x in r} == set(range(60))
    assert len(jaccard_join.block_pairs(classes, 80, False).collect()) == 60 * 59 // 2


def test_forest_joins_what_its_edges_join():
    rnd = np.random.default_rng(6)
    for nodes in (1, 2, 7, 40):
        one, two = rnd.integers(0, nodes, (2, nodes))
        tree = jaccard_join.forest(one, two, nodes)

        def parts(edges):
            label = list(range(nodes))
            for e in edges:
                a, b = label[one[e]], label[two[e]]
                label = [min(a, b) if x in (a, b) else x for x in label]
            return label
        assert parts(tree) == parts(range(len(one)))
        assert len(tree) == nodes - len(set(parts(tree)))


def test_groups_of_many_blocks_keep_every_link(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "BLOCK", 4)
    rnd = np.random.default_rng(7)
    common = [f"c{j}" for j in range(12)]
    texts = []
    for group in range(12):                            # a passage all share, and ten words that some change
        base = common + [f"g{group % 6}x{j}" for j in range(30)]
        for _ in range(4):
            words = list(base)
            words[int(rnd.integers(12, 42))] = f"y{rnd.integers(0, 1000)}"
            texts.append(" ".join(words))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.id: r.component_id for r in jaccard_join.join_components(spark, df, shingle=3, percent=80).collect()}
    sets = [{tuple(t.split()[i:i + 3]) for i in range(len(t.split()) - 2)} for t in texts]
    label = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                a, b = label[i], label[j]
                label = [min(a, b) if x in (a, b) else x for x in label]
    assert got == dict(enumerate(label))


def test_stored_leaves_no_shuffle_files(spark):
    from shelfprice.llm.common import stored
    from shelfprice.session import SHUFFLE_CLEANUP

    held = []
    df = spark.range(100).withColumn("x", F.col("id") % 7).groupBy("x").count()
    write = type(df.write).parquet
    try:
        type(df.write).parquet = lambda self, path, *a, **k: (held.append(spark.conf.get(SHUFFLE_CLEANUP)), write(self, path, *a, **k))[1]
        assert stored(spark, df, "counts").count() == 7
    finally:
        type(df.write).parquet = write
    assert held == ["true"]
