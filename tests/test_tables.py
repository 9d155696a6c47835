"""Table scans are plain at every size: no exchange, filters and columns reach the file."""

import contextlib
import io

from shelfprice.sources.tables import read_table

from small_data import SF_SMALL


def test_plain_scan_with_pushdown(spark):
    df = read_table(spark, f"{SF_SMALL}/lineitem.parquet")
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.filter("l_quantity > 10").select("l_orderkey").explain()
    plan = buf.getvalue()
    assert "Exchange" not in plan
    assert "PushedFilters: [IsNotNull(l_quantity), GreaterThan(l_quantity,10.0)]" in plan
    assert "ReadSchema: struct<l_orderkey:bigint,l_quantity:double" in plan
