"""Registered queries: one per operator or job, each ``(spark, sf_dir) -> DataFrame``.

Every query reads whole driver tables (or data Spark derives from them); none
filters to a subset or caps rows.  Column names equal those of the matching
oracle SQL in ``plans.oracle``.  Queries of sinks and jobs write to a fresh
folder under ``spark.checkpoint.dir`` and return what they read back from it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import collapse_whitespace, pack_size, pack_size_text, parse_stamp
from ..operators.aggregates import (average_unit_prices, crawl_coverage, discount_prices,
                                    regular_prices, unit_price_sums)
from ..operators.items import flatten_json, keep_first, project_items, with_stamp
from ..operators.prices import (keep_categories, keep_unit_hints, price_rows,
                                with_pack_size, with_unit_prices)
from ..operators.stores import with_city
from ..schema import CORRUPT_COLUMN
from ..session import path_exists, remove_path, scratch_path
from ..sinks.files import read_csv, write_csv, write_daily
from ..sources.daily import read_daily
from ..sources.goods import LANDED_DS, goods_items, goods_source, land_damaged_goods, land_goods
from ..sources.html_tables import html_first_table, pages_without_table
from ..sources.landing import read_landed_pages, write_landed_pages
from ..sources.reference_pages import pages_with_table
from ..sources.tables import read_table
from . import jobs

QueryFn = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(spark, f"{sf_dir.rstrip('/')}/{name}.parquet")


def items_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return goods_items(table(spark, sf_dir, "lineitem"))


# --- scalar steps -------------------------------------------------------------

def q_pack_size(spark, sf_dir):
    s = F.col("subTitle")
    return items_of(spark, sf_dir).select(
        "subTitle", pack_size_text(s).alias("weight_text"), pack_size(s).alias("weight"))


def _unit_price(which: str) -> QueryFn:
    def q(spark, sf_dir):
        return (items_of(spark, sf_dir).transform(with_pack_size).transform(with_unit_prices)
                .select("storeId", "categoryName", "subTitle", f"{which}Price", "weight",
                        f"price_{which}_new"))
    return q


def q_category_filter(spark, sf_dir):
    return (items_of(spark, sf_dir).transform(keep_categories)
            .select("timestamp", "storeId", "categoryName", "subcategoryName", "title",
                    "subTitle", "discountPrice", "regularPrice"))


def q_unit_hint_filter(spark, sf_dir):
    return items_of(spark, sf_dir).transform(keep_unit_hints).select("storeId", "webUrl", "subTitle")


def q_store_city(spark, sf_dir):
    return items_of(spark, sf_dir).transform(with_city).select("storeId", "webUrl", "city")


# --- aggregates ---------------------------------------------------------------

def _averages(spark, sf_dir):
    return average_unit_prices(price_rows(items_of(spark, sf_dir)))


def q_avg_discount_price(spark, sf_dir):
    return discount_prices(_averages(spark, sf_dir))


def q_avg_regular_price(spark, sf_dir):
    return regular_prices(_averages(spark, sf_dir))


def q_avg_unit_prices(spark, sf_dir):
    return _averages(spark, sf_dir).transform(with_city)


def q_unit_price_sums(spark, sf_dir):
    sums = unit_price_sums(price_rows(items_of(spark, sf_dir)))
    return sums.withColumns({c: F.col(c).cast("long") for c in ("sum_discount_milli", "sum_regular_milli")})


def q_keep_first_by_url(spark, sf_dir):
    """The first listing of each store and URL: as in the crawl, its item is made of a row that is kept."""
    rows, order = goods_source(table(spark, sf_dir, "lineitem"))
    return project_items(goods_items(keep_first(rows, ("storeId", "webUrl"), order)))


# --- text, time, JSON -----------------------------------------------------------

def q_collapse_whitespace(spark, sf_dir):
    return table(spark, sf_dir, "documents").select(
        "doc_id", collapse_whitespace(F.col("text")).alias("text"))


def q_ingest_stamp(spark, sf_dir):
    return table(spark, sf_dir, "events").transform(with_stamp, "ts").select("event_id", "stamp")


def q_parse_timestamp(spark, sf_dir):
    ev = table(spark, sf_dir, "events").transform(with_stamp, "ts")
    return ev.select(
        "event_id", "stamp",
        F.unix_micros(parse_stamp(F.col("stamp"))).alias("ts_micros"),
        parse_stamp(F.col("event_type")).isNull().alias("bad_text_is_null"))


def q_json_flatten(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    return flatten_json(ev, "props", {"k": "k", "group_name": "group.name"}).select(
        "event_id", "k", "group_name")


# --- landing, sinks, jobs -----------------------------------------------------

_LANDED: dict[tuple[str, str, str], str] = {}


def _land(spark, sf_dir) -> str:
    """Landed JSON pages of the goods listings of ``sf_dir``.

    Landing stands in for the crawler (input data, not an operator under
    test), so it is done once per application and scale factor and reused.
    """
    return _landed_once(spark, sf_dir, land_goods)


def _land_damaged(spark, sf_dir) -> str:
    """The same with broken and half-broken lines, an unfinished store and a first total of 0."""
    return _landed_once(spark, sf_dir, land_damaged_goods)


def _landed_once(spark, sf_dir, land) -> str:
    key = (spark.conf.get("spark.app.id", ""), sf_dir.rstrip("/"), land.__name__)
    path = _LANDED.get(key)
    if path is None or not path_exists(spark, path + "/_SUCCESS"):
        path = land(table(spark, sf_dir, "lineitem"), scratch_path(spark, "landing"))
        _LANDED[key] = path
    return path


def _dt_text(df: DataFrame) -> DataFrame:
    return df.withColumn("DT", F.col("DT").cast("string"))


def q_landed_items(spark, sf_dir):
    pages = read_landed_pages(spark, _land(spark, sf_dir))
    return project_items(jobs.landed_items(pages))


def q_crawl_coverage(spark, sf_dir):
    return crawl_coverage(read_landed_pages(spark, _land_damaged(spark, sf_dir)))


def q_bad_lines(spark, sf_dir):
    """The ledger of broken lines that ingest writes; what a line was is read from its own text."""
    tables = jobs.Tables(scratch_path(spark, "tables"))
    jobs.ingest(spark, _land_damaged(spark, sf_dir), tables, LANDED_DS)
    line = F.col(CORRUPT_COLUMN)
    return _dt_text(read_daily(spark, tables.bad_lines)).select(
        F.regexp_extract(line, r'^\{"storeId":"(\d+)"', 1).alias("line_store"),
        F.regexp_extract(line, r'"offset":(\d+)', 1).cast("long").alias("line_offset"),
        "storeId", "offset", "reason", (F.col("source_file").isNotNull() & (F.col("line_no") > 0)).alias("traced"), "DT")


def q_ingest_items(spark, sf_dir):
    tables = jobs.Tables(scratch_path(spark, "tables"))
    jobs.ingest(spark, _land(spark, sf_dir), tables, LANDED_DS)
    return _dt_text(read_daily(spark, tables.raw))


def reference_pages(spark, sf_dir):
    return pages_with_table(table(spark, sf_dir, "pages"))


def q_html_first_table(spark, sf_dir):
    return html_first_table(reference_pages(spark, sf_dir))


def q_pages_without_table(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")      # real pages: none holds a table
    return pages_without_table(pages, html_first_table(pages))


def q_salary_tables(spark, sf_dir):
    tables = jobs.Tables(scratch_path(spark, "tables"))
    jobs.salary(reference_pages(spark, sf_dir), tables, LANDED_DS)
    return _dt_text(read_daily(spark, tables.salary))


def q_daily_run(spark, sf_dir):
    tables = jobs.Tables(scratch_path(spark, "tables"))
    jobs.daily_run(spark, _land(spark, sf_dir), reference_pages(spark, sf_dir), tables, LANDED_DS)
    return _dt_text(read_daily(spark, tables.unit_prices))


def q_salary_wide(spark, sf_dir):
    tables = jobs.Tables(scratch_path(spark, "tables"))
    jobs.salary(reference_pages(spark, sf_dir), tables, LANDED_DS, wide=True)
    return _dt_text(read_daily(spark, tables.salary_wide))


def q_multi_day_averages(spark, sf_dir):
    """Both published tables after reruns of earlier days.

    All listings are split into three days by price.  The first day is first ingested with other
    rows, and a fourth day with priced rows; after an aggregate the first is ingested with its own
    rows and the fourth with a category that is not priced, and the aggregate runs again.
    """
    tables = jobs.Tables(scratch_path(spark, "tables"))
    pages = read_landed_pages(spark, _land(spark, sf_dir))

    def third_of(s):
        return F.coalesce(F.floor(s["regularPrice"].cast("double")) % 3, F.lit(0))

    kept = {"0": lambda s: third_of(s) == 0, "1": lambda s: third_of(s) == 1, "2": lambda s: third_of(s) == 2,
            "unpriced": lambda s: s["categories"]["category"]["name"] == "Бакалея"}
    first, second, third, fourth = "2024-01-08", "2024-01-09", "2024-01-10", LANDED_DS

    def ingest(name, *days):
        """Lands a part, ingests it as each of ``days``; what was landed is gone then."""
        part = scratch_path(spark, "landing-" + name)
        write_landed_pages(pages.withColumn("skus", F.filter("skus", kept[name])), part)
        for day in days:
            jobs.ingest(spark, part, tables, day, audit=False)
        remove_path(spark, part)

    ingest("1", first, second)
    ingest("2", third, fourth)
    jobs.aggregate(spark, tables, fourth)
    ingest("0", first)
    ingest("unpriced", fourth)
    jobs.aggregate(spark, tables, fourth)
    out = [read_daily(spark, root, [fourth]).select(
        F.lit(which).alias("which"), "storeId", "categoryName", "subcategoryName",
        F.col(f"avg_price_{which}_new").alias("avg_price"), "city")
        for which, root in (("discount", tables.discount), ("regular", tables.regular))]
    return out[0].unionByName(out[1])


def q_stream_ingest_items(spark, sf_dir):
    from ..streaming.ingest_stream import stream_ingest

    tables = jobs.Tables(scratch_path(spark, "tables"))
    q = stream_ingest(spark, _land(spark, sf_dir), tables, LANDED_DS, scratch_path(spark, "stream-ckpt"))
    q.awaitTermination()
    return _dt_text(read_daily(spark, tables.raw))


def q_export_csv(spark, sf_dir):
    out = scratch_path(spark, "export")
    jobs.export_csv(spark, _land(spark, sf_dir), out)
    return read_csv(spark, out)


def q_partition_overwrite(spark, sf_dir):
    root = scratch_path(spark, "raw")
    items = project_items(items_of(spark, sf_dir))
    write_daily(items.filter(F.col("categoryName") == "Сыр"), root, LANDED_DS)  # first attempt
    write_daily(items, root, LANDED_DS)                                         # rerun replaces it
    return _dt_text(read_daily(spark, root))


def q_csv_round_trip(spark, sf_dir):
    out = scratch_path(spark, "csv")
    write_csv(project_items(items_of(spark, sf_dir)), out)
    return read_csv(spark, out)


QUERIES: dict[str, QueryFn] = {
    "pack_size": q_pack_size,
    "unit_price_discount": _unit_price("discount"),
    "unit_price_regular": _unit_price("regular"),
    "category_filter": q_category_filter,
    "unit_hint_filter": q_unit_hint_filter,
    "store_city": q_store_city,
    "avg_discount_price": q_avg_discount_price,
    "avg_regular_price": q_avg_regular_price,
    "avg_unit_prices": q_avg_unit_prices,
    "unit_price_sums": q_unit_price_sums,
    "keep_first_by_url": q_keep_first_by_url,
    "collapse_whitespace": q_collapse_whitespace,
    "ingest_stamp": q_ingest_stamp,
    "parse_timestamp": q_parse_timestamp,
    "json_flatten": q_json_flatten,
    "landed_items": q_landed_items,
    "crawl_coverage": q_crawl_coverage,
    "bad_lines": q_bad_lines,
    "ingest_items": q_ingest_items,
    "html_first_table": q_html_first_table,
    "pages_without_table": q_pages_without_table,
    "salary_tables": q_salary_tables,
    "salary_wide": q_salary_wide,
    "daily_run": q_daily_run,
    "multi_day_averages": q_multi_day_averages,
    "stream_ingest_items": q_stream_ingest_items,
    "export_csv": q_export_csv,
    "partition_overwrite": q_partition_overwrite,
    "csv_round_trip": q_csv_round_trip,
}

