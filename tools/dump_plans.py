"""Writes docs/PLANS.md: formatted physical plans of the production-shaped steps.

    python tools/dump_plans.py [sf_dir]

Plans are taken over tables as the jobs see them (a daily raw Parquet root,
landed JSON pages), not over the lineitem shim.
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def formatted(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    text = re.sub(r"#\d+L?", "", buf.getvalue())          # expression ids change run to run
    text = re.sub(r"file:[^\]\s,]+", "<path>", text)
    text = re.sub(r"plan_id=\d+", "plan_id=…", text)
    return text.strip()


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    from shelfprice.operators.aggregates import average_unit_prices, crawl_coverage
    from shelfprice.operators.items import project_items
    from shelfprice.operators.prices import price_rows
    from shelfprice.operators.stores import with_city
    from shelfprice.plans import jobs
    from shelfprice.plans.queries import _land, items_of, reference_pages
    from shelfprice.session import get_session, scratch_path
    from shelfprice.sinks.files import write_daily
    from shelfprice.sources.daily import read_daily
    from shelfprice.sources.html_tables import html_first_table
    from shelfprice.sources.landing import read_landed_pages

    spark = get_session("local[8]", shuffle_partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    raw = scratch_path(spark, "raw")
    write_daily(project_items(items_of(spark, sf_dir)), raw, "2024-01-11")
    pages = read_landed_pages(spark, _land(spark, sf_dir))

    sections = [
        ("J3 aggregate: both averages + city over the raw daily table, one day",
         average_unit_prices(price_rows(read_daily(spark, raw, ["2024-01-11"]))).transform(with_city)),
        ("J1 ingest: landed pages -> items, keep-first per (storeId, webUrl)", jobs.crawl_items(pages)),
        ("A3 crawl coverage", crawl_coverage(pages)),
        ("R3 first HTML table of every page", html_first_table(reference_pages(spark, sf_dir))),
    ]
    out = ["# Physical plans", "",
           f"Generated by `tools/dump_plans.py` on `{sf_dir}` (Spark {spark.version}, AQE on; "
           "the plans shown are before AQE's runtime re-planning).", ""]
    for title, df in sections:
        out += [f"## {title}", "", "```", formatted(df), "```", ""]
    os.makedirs(os.path.join(ROOT, "docs"), exist_ok=True)
    with open(os.path.join(ROOT, "docs", "PLANS.md"), "w", encoding="utf-8") as f:
        f.write("\n".join(out))
    spark.stop()


if __name__ == "__main__":
    main(sys.argv)
