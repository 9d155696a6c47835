"""Scale rules checked on the physical plans of every registered query and job step:
no cartesian or nested-loop joins, no window unless it is a top-k cut down map-side by a
partial group limit (otherwise a hot key lands in one task), no row-at-a-time Python
UDFs, and nothing that collects a group."""

import contextlib
import io

import pytest

import __spark_entry__ as entry
from shelfprice.plans.queries import QUERIES
from shelfprice.operators.aggregates import crawl_coverage, unit_price_sums
from shelfprice.operators.prices import price_rows
from shelfprice.plans import jobs
from shelfprice.plans.queries import _land, items_of, reference_pages
from shelfprice.sources.html_tables import html_first_table
from shelfprice.sources.landing import read_landed_pages

from small_data import SF_SMALL

FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython",
             "collect_list", "collect_set")


def plan(df):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


def violations(text):
    found = [f for f in FORBIDDEN if f in text]
    windows = text.count("+- Window [") + text.count("+- Window(")
    partial_limits = text.count(", Partial")  # WindowGroupLimit [...], row_number(), k, Partial
    if windows > partial_limits:
        found.append("Window without a partial group limit")
    return found


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_registered_query_plan(spark, name):
    assert violations(plan(entry.queries()[name](spark, SF_SMALL))) == []


def test_job_step_plans(spark):
    pages = read_landed_pages(spark, _land(spark, SF_SMALL))
    steps = [jobs.crawl_items(pages), crawl_coverage(pages),
             unit_price_sums(price_rows(items_of(spark, SF_SMALL))),
             html_first_table(reference_pages(spark, SF_SMALL))]
    for df in steps:
        text = plan(df)
        assert violations(text) == []
        assert "Exchange" in text or "ArrowEvalPythonUDTF" in text


def test_lint_flags_a_plain_window(spark):
    from pyspark.sql import Window, functions as F

    df = spark.range(10).withColumn("k", F.col("id") % 2)
    running = df.withColumn("s", F.sum("id").over(Window.partitionBy("k")))
    assert violations(plan(running)) == ["Window without a partial group limit"]
    top1 = df.withColumn("r", F.row_number().over(Window.partitionBy("k").orderBy("id"))).filter("r = 1")
    assert violations(plan(top1)) == []
