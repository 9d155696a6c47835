"""Tables that a step of the suffix dedup stores are gone once no later step reads them."""

import os
import random

import pandas as pd
from pyspark.sql import functions as F

from shelfprice.llm import common, suffix_dedup
from shelfprice.session import checkpoint_root


def folders(root):
    return {os.path.join(top, d) for top, names, _ in os.walk(root) for d in names}


def test_suffix_dedup_keeps_only_what_is_still_read(spark, scratch):
    rnd = random.Random(3)
    passage = " ".join(f"w{rnd.randrange(9999)}" for _ in range(120))
    rows = [(i, " ".join(f"x{rnd.randrange(9999)}" for _ in range(80)) + " " + passage) for i in range(20)]
    path = scratch("tables")
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{path}/documents.parquet")
    root = checkpoint_root(spark).replace("file:", "")
    before = folders(root)
    got = {r.doc_id: r for r in suffix_dedup.op8_suffix_dedup(spark, path).collect()}
    assert all(got[i].n_removed >= len(passage.encode()) and got[i].n_spans == 1 for i, _ in rows)
    left = {d.rpartition("/")[2] for d in folders(root) - before}
    assert "found" in left
    assert not left & {"occurrences", "anchors", "several", "contexts", "wanted", "cuts", "crowded", "extents", "seeds", "shared-seeds", "seeds-of"}


def test_texts_reach_python_in_small_batches(spark):
    """10,000 rows make a batch whatever their size, unless the bytes of a batch are limited too."""
    def sizes(batches):
        for b in batches:
            yield pd.DataFrame({"n": [b["text"].str.len().sum()]})

    docs = spark.range(3000, numPartitions=1).select(F.rpad(F.col("id").cast("string"), 10_000, "x").alias("text"))
    seen = [r["n"] for r in common.stored(spark, docs.mapInPandas(sizes, "n long"), "sizes").collect()]
    assert sum(seen) == 3000 * 10_000 and max(seen) <= 2 * common.BATCH_BYTES
    assert spark.conf.get(common.BATCH_SETTING) != str(common.BATCH_BYTES)
