"""What landing moves and keeps: columns of ``lineitem``, then compressed pages, not the listings made of them."""

import datetime
import os
import random

from shelfprice.session import checkpoint_root
from shelfprice.sources.goods import FETCHED_AT, GOODS_ORDER, PAGE_SIZE, goods, goods_pages, land_damaged_goods, land_goods
from shelfprice.sources.landing import read_landed_pages

SCHEMA = ("l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double,"
          "l_discount double, l_returnflag string, l_shipdate timestamp_ntz")


def lineitem(spark, n=3000):
    rnd = random.Random(11)

    def maybe(x):
        return None if rnd.random() < 0.05 else x

    rows = [(i, maybe(rnd.randrange(60)), maybe(rnd.randrange(40)), maybe(rnd.randrange(1, 8)), maybe(float(rnd.randrange(1, 51))),
             maybe(rnd.randrange(100, 9000) / 4), maybe(rnd.randrange(0, 11) / 100), maybe(rnd.choice("ANR")),
             maybe(datetime.datetime(1995, 1, 1 + rnd.randrange(28)))) for i in range(n)]
    return spark.createDataFrame(rows + rows[:100], SCHEMA).repartition(5)


def files(path):
    return [os.path.join(top, f) for top, _, names in os.walk(path.replace("file:", "")) for f in names if not f.startswith((".", "_"))]


def test_landing_is_kept_compressed_and_leaves_nothing_else(spark, scratch):
    df, root = lineitem(spark), checkpoint_root(spark).replace("file:", "")
    before = set(files(root))
    for land in (land_goods, land_damaged_goods):
        landed = files(land(df, scratch("landing")))
        assert landed and all(f.endswith(".gz") for f in landed)
        assert set(files(root)) - before <= set(landed)          # no checkpoint, no placed rows
        before |= set(landed)


def test_landed_pages_hold_the_goods_in_order(spark, scratch):
    df = lineitem(spark)

    def null_first(v):
        return (v is not None, v)

    stores = {}
    for r in goods(df).collect():
        stores.setdefault(r.storeId, []).append(r)
    want = {}
    for store, rows in stores.items():
        rows.sort(key=lambda r: [null_first(r[k]) for k in GOODS_ORDER])
        total = len({r.webUrl for r in rows} - {None})
        for at in range(0, len(rows), PAGE_SIZE):
            want[store, at] = (total, [(r.code, r.title, r.webUrl, r.subTitle, r.categoryName, r.groupName, r.imageFullSize)
                                       for r in rows[at:at + PAGE_SIZE]])
        want[store, at + PAGE_SIZE] = (total, [])

    def found(pages):
        return {(p.storeId, p.offset): (p.total, [
            (s.code, s.title, s.webUrl, s.subTitle, s.categories.category.name, s.categories.group and s.categories.group.name,
             s.image and s.image.fullSize) for s in p.skus]) for p in pages.collect()}

    assert found(goods_pages(df)) == want
    landed = read_landed_pages(spark, land_goods(df, scratch("landing")))
    assert found(landed) == want and {p.fetchedAt for p in landed.collect()} == {FETCHED_AT}
