"""Keep-first by URL shuffles and sorts columns of ``lineitem``, not the text of the listings made of them."""

import contextlib
import io

from shelfprice.operators.items import keep_first, project_items
from shelfprice.plans.queries import q_keep_first_by_url
from shelfprice.sources.goods import GOODS_ORDER, goods_items

from test_landing_size import lineitem


def test_keep_first_by_url_sorts_no_listing_text(spark, scratch):
    folder = scratch("tables")
    lineitem(spark).write.parquet(f"{folder}/lineitem.parquet")
    df = spark.read.parquet(f"{folder}/lineitem.parquet")
    got, buf = q_keep_first_by_url(spark, folder), io.StringIO()
    with contextlib.redirect_stdout(buf):
        got.explain()
    plan = buf.getvalue()
    below = plan[plan.index("Exchange hashpartitioning(storeId"):]
    assert "Описание" in plan and "Описание" not in below and "Бренд" not in below
    want = project_items(keep_first(goods_items(df), ("storeId", "webUrl"), GOODS_ORDER))
    assert got.columns == want.columns
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))
