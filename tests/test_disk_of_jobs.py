"""What landing and the jobs leave on disk beside their tables: no shuffle files, no parts of the landing."""

import os

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from shelfprice.plans import jobs, queries
from shelfprice.session import SHUFFLE_CLEANUP, checkpoint_root, shuffles_removed
from shelfprice.sources.goods import FETCHED_AT, PAGE_SIZE, _pages_of, goods_pages, land_damaged_goods, land_goods, place_goods
from shelfprice.streaming.ingest_stream import stream_ingest
from test_landing_size import files, lineitem


def shuffle_files(spark):
    blocks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {name for name in blocks.mkString("\n").split("\n") if "/shuffle_" in name}


@pytest.mark.parametrize("land", [land_goods, land_damaged_goods])
def test_landing_leaves_no_shuffle_files(spark, scratch, land):
    df, before = lineitem(spark).localCheckpoint(), shuffle_files(spark)
    land(df, scratch("landing"))
    assert shuffle_files(spark) <= before


def test_jobs_leave_no_shuffle_files(spark, scratch):
    landed = land_goods(lineitem(spark), scratch("landing"))
    tables, before = jobs.Tables(scratch("tables")), shuffle_files(spark)
    jobs.ingest(spark, landed, tables, "2024-01-11", audit=False)
    jobs.export_csv(spark, landed, scratch("export"))
    stream_ingest(spark, landed, jobs.Tables(scratch("streamed")), "2024-01-11", scratch("stream-ckpt")).awaitTermination()
    assert shuffle_files(spark) <= before


def test_setting_is_put_back(spark):
    for value in (None, "false", "true"):
        spark.conf.set(SHUFFLE_CLEANUP, value) if value else spark.conf.unset(SHUFFLE_CLEANUP)
        at_first = spark.conf.get(SHUFFLE_CLEANUP, None)
        with shuffles_removed(spark):
            assert spark.conf.get(SHUFFLE_CLEANUP) == "true"
        assert spark.conf.get(SHUFFLE_CLEANUP, None) == at_first
    spark.conf.unset(SHUFFLE_CLEANUP)


def test_pages_are_put_together_where_their_rows_are_read(spark, scratch):
    """Only pages that a task or file cuts are grouped: the rows of all others are not shuffled."""
    placed = place_goods(lineitem(spark), scratch("placed"))
    plan = _pages_of(placed, FETCHED_AT)._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "collect_list(struct(rank" not in plan


@pytest.mark.parametrize("n", [1, 23, 24, 25, 3000])
def test_pages_are_whole_in_whatever_order_placed_rows_are_read(spark, scratch, n):
    df = lineitem(spark, n)
    placed = place_goods(df, scratch("placed"))
    shuffled = placed.orderBy(F.xxhash64("l_orderkey", "in_task"))

    def found(pages):
        return sorted((p.storeId, p.offset, p.total, str(p.skus)) for p in pages.collect())

    want = found(goods_pages(df))
    assert found(_pages_of(placed, FETCHED_AT)) == found(_pages_of(shuffled, FETCHED_AT)) == want
    assert sum(r.n for r in goods_pages(df).select(F.size("skus").alias("n")).collect()) == df.count()
    assert all(0 <= r.n <= PAGE_SIZE for r in goods_pages(df).select(F.size("skus").alias("n")).collect())


def test_multi_day_averages_keeps_no_part_of_the_landing(spark, tmp_path):
    pq.write_table(lineitem(spark).toArrow(), tmp_path / "lineitem.parquet")
    root = checkpoint_root(spark).replace("file:", "")
    before = set(files(root))
    assert queries.q_multi_day_averages(spark, str(tmp_path)).count() > 0
    assert not [f for f in set(files(root)) - before if "landing-" in os.path.dirname(f)]
