"""The landed goods fixture: pages of 24 items at offsets 0, 24, 48 ..., every item landed
once, one closing empty page and one total per store.  That (offset, position) follows the
goods order is what the ingest_items and crawl_coverage oracle matches show."""

from pyspark.sql import functions as F

from shelfprice.constants import PAGE_SIZE
from shelfprice.sources.goods import goods_pages

from small_data import SF_SMALL


def test_pages_bounded_and_ordered(spark):
    lineitem = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")
    pages = goods_pages(lineitem).cache()
    assert pages.select(F.max(F.size("skus"))).first()[0] <= PAGE_SIZE
    n_items = pages.select(F.sum(F.size("skus"))).first()[0]
    assert n_items == lineitem.count()
    per_store = pages.groupBy("storeId").agg(F.max_by(F.size("skus"), "offset").alias("last_size"),
                                             F.count_distinct("total").alias("totals"))
    assert all(r.last_size == 0 and r.totals == 1 for r in per_store.collect())
    assert pages.groupBy("storeId", "offset").count().filter("count > 1").count() == 0
    assert pages.filter(F.col("offset") % PAGE_SIZE != 0).count() == 0   # API-like offsets
    full = pages.filter((F.size("skus") > 0) & (F.size("skus") < PAGE_SIZE)).groupBy("storeId").count()
    assert full.filter("count > 1").count() == 0   # only a store's last item page may be short
    pages.unpersist()
