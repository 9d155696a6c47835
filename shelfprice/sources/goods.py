"""``goods``: shop listings derived from the driver's ``lineitem`` table.

The test tables hold no shop listings, so ``lineitem`` is reshaped into raw
API items (``goods``) and into the cleaned 14-column item table
(``goods_items``).  The Spark spelling below and ``goods_sql()`` /
``goods_items_sql()`` (run by DuckDB as the oracle) must stay equal.

``land_goods`` turns ``goods`` into landed page envelopes (JSON Lines) so the
ingest path can be run end to end on data that grows with the driver tables.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..constants import PAGE_SIZE, WHITESPACE_RUN_RE2
from ..functions import collapse_whitespace
from ..session import remove_path, scratch_path, shuffles_removed
from ..sources.landing import LANDED_OPTIONS, write_landed_pages

# Keys that order goods rows completely within one (storeId, webUrl): two rows
# equal on all of them are equal on every item column.
GOODS_ORDER = ("l_orderkey", "l_linenumber", "l_suppkey", "l_shipdate",
               "regularPrice", "discountPrice", "subcategoryName", "subTitle")

# The columns of lineitem that goods are made of.
GOODS_SOURCE = ("l_orderkey", "l_linenumber", "l_suppkey", "l_shipdate", "l_partkey", "l_quantity",
                "l_extendedprice", "l_discount", "l_returnflag")

# The landed fixture's fetch instant, and the stamp every landed item gets.
FETCHED_AT = "2024-01-12T03:00:00Z"
FETCHED_STAMP = "2024-01-12T06:00:00+03:00"
LANDED_DS = "2024-01-11"

# Fixture values (the shim of FIXTURES.md §8): store by l_suppkey % 8 (7 -> '9999', a store
# with no city) and category by l_linenumber (5 and 7 -> 'Вино'; 'Бакалея' is a category the
# price filter drops).
_STORES = ("0124", "0091", "0210", "0203", "0179", "0238", "0209")
_CATEGORIES = {1: "Сыр", 2: "Курица", 3: "Овощи", 4: "Фрукты", 6: "Бакалея"}


def _s(c: Column) -> Column:
    return c.cast("string")


def _case(key: Column, mapping: dict, default) -> Column:
    out = None
    for k, v in mapping.items():
        out = (F.when(key == k, v) if out is None else out.when(key == k, v))
    return out.otherwise(default)


def _goods_fields(c) -> dict[str, Column]:
    """The columns of ``goods``; ``c`` gives a ``lineitem`` column by its name."""
    pk, q = c("l_partkey"), c("l_quantity").cast("int")
    code = _s(pk)
    sub_title = _case(pk % 8, {
        0: F.concat(F.lit("Россия, "), _s(q), F.lit(" г")),
        1: F.concat(F.lit("Россия, "), _s(q * 10), F.lit("г")),
        2: F.concat(F.lit("Италия, 0."), _s(q), F.lit("L")),
        3: F.lit("Италия, 0,75L"),
        4: F.concat(_s(q), F.lit(" шт")),
        5: F.concat(_s(q * 10), F.lit(" мл")),
        6: F.lit("0 г"),
    }, F.lit(None).cast("string"))
    return {
        **{k: c(k) for k in ("l_orderkey", "l_linenumber", "l_suppkey", "l_shipdate")},
        "storeId": _case(c("l_suppkey") % 8, dict(enumerate(_STORES)), F.lit("9999")),
        "code": code,
        "title": F.concat(F.lit("Товар\u00a0"), code,
                          F.when(c("l_linenumber") == 3, F.lit("\n\t новинка  ")).otherwise(F.lit(""))),
        "brand": F.when(pk % 5 != 0, F.concat(F.lit("Бренд "), _s(pk % 50))),
        "subTitle": sub_title,
        "description": F.concat(F.lit("  Описание\u2003товара\u0085"), code, F.lit(" ")),
        "regularPrice": c("l_extendedprice"),
        "discountPrice": c("l_extendedprice") * (1 - c("l_discount")),
        "imageFullSize": F.when(pk % 7 != 0, F.concat(F.lit("/img/"), code, F.lit(".jpg"))),
        "webUrl": F.concat(F.lit("/p/"), code),
        "groupName": F.when(pk % 11 != 0, F.lit("Продукты питания")),
        "categoryName": _case(c("l_linenumber"), _CATEGORIES, F.lit("Вино")),
        "subcategoryName": c("l_returnflag"),
    }


def goods(lineitem: DataFrame) -> DataFrame:
    """Raw listing rows: API field values before flattening and cleaning."""
    return lineitem.select(*[v.alias(k) for k, v in _goods_fields(F.col).items()])


def goods_source(lineitem: DataFrame) -> tuple[DataFrame, tuple[str, ...]]:
    """(the columns that ``goods`` are made of with the key of a listing, the names that order them as GOODS_ORDER does).

    A row is less than half as long as its item; only what the order needs and ``lineitem`` does not hold is built.
    """
    fields, same = _goods_fields(F.col), {"regularPrice": "l_extendedprice", "subcategoryName": "l_returnflag"}
    built = [fields[k].alias(k) for k in ("storeId", "webUrl", "discountPrice", "subTitle")]
    return lineitem.select(*GOODS_SOURCE, *built), tuple(same.get(k, k) for k in GOODS_ORDER)


def goods_items(lineitem: DataFrame) -> DataFrame:
    """The cleaned item table of ``goods`` (what ingest yields before keep-first),
    with the ordering keys kept in front."""
    g = goods(lineitem)
    return g.select(
        "l_orderkey", "l_linenumber", "l_suppkey", "l_shipdate",
        F.lit(FETCHED_STAMP).alias("timestamp"), "storeId", "code",
        collapse_whitespace(F.col("title")).alias("title"), "brand", "subTitle",
        collapse_whitespace(F.col("description")).alias("description"),
        "regularPrice", "discountPrice",
        F.coalesce("imageFullSize", F.lit("")).alias("imageUrl"), "webUrl",
        F.coalesce("groupName", F.lit("")).alias("groupName"),
        F.coalesce("categoryName", F.lit("")).alias("categoryName"),
        F.coalesce("subcategoryName", F.lit("")).alias("subcategoryName"),
    )


def _sku(row: Column) -> Column:
    """The raw API item of a struct of ``GOODS_SOURCE``."""
    g = _goods_fields(lambda name: row[name])
    named = lambda k: F.struct(g[k].alias("name"))
    return F.struct(
        *[g[k].alias(k) for k in ("code", "title", "brand", "subTitle", "description", "regularPrice", "discountPrice", "webUrl")],
        F.when(g["imageFullSize"].isNotNull(), F.struct(g["imageFullSize"].alias("fullSize"))).alias("image"),
        F.struct(
            F.when(g["groupName"].isNotNull(), named("groupName")).alias("group"),
            named("categoryName").alias("category"),
            named("subcategoryName").alias("subcategory"),
        ).alias("categories"),
    )


def place_goods(lineitem: DataFrame, path: str) -> DataFrame:
    """The ``lineitem`` columns behind ``goods`` in goods order, stored with their store, task and place in the task."""
    fields = _goods_fields(F.col)
    task = F.spark_partition_id().alias("task")
    in_task = (F.monotonically_increasing_id() - F.shiftleft(F.spark_partition_id().cast("long"), 33)).alias("in_task")
    rows = lineitem.select(*GOODS_SOURCE).orderBy(fields["storeId"], *[fields[k] for k in GOODS_ORDER])
    placed = rows.select(fields["storeId"].alias("storeId"), *GOODS_SOURCE, task, in_task)
    with shuffles_removed(lineitem.sparkSession):
        placed.write.option("compression", "zstd").parquet(path)
    return lineitem.sparkSession.read.schema(placed.schema).parquet(path)


def _stores(placed: DataFrame) -> DataFrame:
    """(storeId, n, total, last): rows, distinct URLs (one for each part) and the offset after the last item page."""
    per_store = placed.groupBy("storeId").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("l_partkey").alias("total"))
    return per_store.withColumn("last", (F.floor((F.col("n") - 1) / PAGE_SIZE) + 1) * PAGE_SIZE)


def _runs(rows: DataFrame, whole: bool) -> DataFrame:
    """(storeId, total, page, entries): rows of a page that lie one after another, if they are all of it or else if they are not.

    ``rows`` (storeId, n, total, rank, columns) are read in the order they were stored in, so nearly all pages are
    whole; one that is cut by the end of a task or file comes in pieces.
    """
    columns = [c for c in rows.columns if c not in ("storeId", "n", "total")]
    size = PAGE_SIZE

    def cut(held: pa.Table, last: bool) -> tuple[pa.RecordBatch | None, pa.Table]:
        """The runs of ``held``, and the rows of its last one if others may follow it."""
        if not len(held):
            return None, held
        rank, n = (held.column(c).to_numpy() for c in ("rank", "n"))
        store = held.column("storeId").combine_chunks()
        new = np.ones(len(rank), bool)
        same = store.slice(1).to_numpy(zero_copy_only=False) == store.slice(0, max(len(rank) - 1, 0)).to_numpy(zero_copy_only=False)
        new[1:] = ~same | (rank[1:] != rank[:-1] + 1) | (rank[1:] % size == 0)
        starts = np.flatnonzero(new)
        ends = np.append(starts[1:], len(rank))
        if not last:
            starts, ends = starts[:-1], ends[:-1]
        if not len(starts):
            return None, held
        done = held.slice(0, ends[-1])
        struct = pa.StructArray.from_arrays([done.column(c).combine_chunks() for c in columns], fields=[held.schema.field(c) for c in columns])
        entries = pa.ListArray.from_arrays(pa.array(np.append(starts, ends[-1]), pa.int32()), struct)
        complete = (rank[starts] % size == 0) & (ends - starts == np.minimum(n[starts] - rank[starts], size))
        firsts = done.take(pa.array(starts))
        out = pa.RecordBatch.from_arrays(
            [firsts.column("storeId").combine_chunks(), firsts.column("total").combine_chunks(), pa.array(rank[starts] // size), entries],
            ["storeId", "total", "page", "entries"])
        return out.filter(pa.array(complete == whole)), held.slice(ends[-1])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for b in batches:
            held = pa.Table.from_batches([b]) if held is None else pa.concat_tables([held, pa.Table.from_batches([b])])
            out, held = cut(held, last=False)
            if out is not None:
                yield out
        out = None if held is None else cut(held, last=True)[0]
        if out is not None:
            yield out

    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    entry = ", ".join(f"{c}: {kinds[c]}" for c in columns)
    return rows.mapInArrow(run, f"storeId string, total long, page long, entries array<struct<{entry}>>")


def _pages_of(placed: DataFrame, fetched_at: str) -> DataFrame:
    per_task = placed.groupBy("task", "storeId").agg(F.count(F.lit(1)).alias("n"), F.min("in_task").alias("first"))
    per_store = _stores(placed)
    before = F.sum("n").over(Window.partitionBy("storeId").orderBy("task").rowsBetween(Window.unboundedPreceding, -1))
    starts = (per_task.select("task", "storeId", (F.coalesce(before, F.lit(0)) - F.col("first")).alias("start"))
              .join(per_store.select("storeId", "n", "total"), "storeId"))
    rows = (placed.join(F.broadcast(starts), ["task", "storeId"])      # about a row for each task
                 .select("storeId", "n", "total", (F.col("start") + F.col("in_task")).alias("rank"), *GOODS_SOURCE))
    joined = (_runs(rows, whole=False).groupBy("storeId", "page")
              .agg(F.first("total").alias("total"), F.sort_array(F.flatten(F.collect_list("entries"))).alias("entries")))
    pages = (_runs(rows, whole=True).unionByName(joined)
             .select("storeId", (F.col("page") * PAGE_SIZE).alias("offset"), "total", F.transform("entries", _sku).alias("skus")))
    closing = per_store.select("storeId", F.col("last").alias("offset"), "total",
                               F.array().cast(pages.schema["skus"].dataType).alias("skus"))
    return (pages.unionByName(closing)
            .select("storeId", "offset", F.lit(fetched_at).alias("fetchedAt"), "total", "skus"))


def goods_pages(lineitem: DataFrame, fetched_at: str = FETCHED_AT) -> DataFrame:
    """Page envelopes of ``goods``: pages of ``PAGE_SIZE`` items at offsets 0, 24, 48 ...

    An item's place in its store is its rank in the goods order, found without
    a per-store window (a store may hold a third of all rows):
      * a global sort (range-partitioned, so a hot store spreads over tasks),
        after which a row's position inside its task is known;
      * the row count of each task and store, prefix-summed within the store: a
        table of about one row per task, joined on task and store, so that a
        store's rows meet it in as many pieces as there were tasks.
    The placed rows are stored, so the counts and the join read one and
    the same cut into tasks.  Page = rank div 24, position = rank mod 24, so a
    page is bounded by construction and (offset, position) follows the goods
    order.  Every store ends with one empty page, as a crawl does.
    Sorted and stored are the columns of ``lineitem``; the listings, several times
    as long, are built from them page by page.  The stored rows of a page lie together, so a page is put
    together where it is read; only those that the end of a task or file cuts are grouped.
    """
    return _pages_of(place_goods(lineitem, scratch_path(lineitem.sparkSession, "placed-goods")), fetched_at)


def land_goods(lineitem: DataFrame, path: str, fetched_at: str = FETCHED_AT) -> str:
    placed = scratch_path(lineitem.sparkSession, "placed-goods")
    write_landed_pages(_pages_of(place_goods(lineitem, placed), fetched_at), path)
    remove_path(lineitem.sparkSession, placed)
    return path


# The damaged landing: a store that was crawled to the middle, one whose first page says total 0, and
# one left whole; of the others' pages one in seven is cut off, and one in seven has a total that is no number.
UNFINISHED_STORE, ZERO_FIRST_STORE, WHOLE_STORE = "0238", "0179", "0091"
DAMAGE_CYCLE, CUT_OFF, NO_NUMBER = 7, 3, 5


def land_damaged_goods(lineitem: DataFrame, path: str) -> str:
    """Lands ``goods_pages`` with broken and half-broken lines, an unfinished store and a first total of 0."""
    stored = scratch_path(lineitem.sparkSession, "placed-goods")
    placed = place_goods(lineitem, stored)
    pages, last = _pages_of(placed, FETCHED_AT), F.broadcast(_stores(placed).select("storeId", "last"))
    store, page = F.col("storeId"), F.floor(F.col("offset") / PAGE_SIZE)
    total = F.when((store == ZERO_FIRST_STORE) & (page == 0), F.lit(0)).otherwise(F.col("total"))
    line = F.to_json(F.struct("storeId", "offset", "fetchedAt", total.alias("total"), "skus"))
    no_number = F.to_json(F.struct("storeId", "offset", "fetchedAt", F.lit("unknown").alias("total"), "skus"))
    damaged = (F.when((store != WHOLE_STORE) & (page % DAMAGE_CYCLE == CUT_OFF), F.expr("left(line, cast(length(line) / 2 as int))"))
               .when((store != WHOLE_STORE) & (page % DAMAGE_CYCLE == NO_NUMBER), no_number).otherwise(F.col("line")))
    kept = pages.join(last, "storeId").filter((store != UNFINISHED_STORE) | (F.col("offset") * 2 < F.col("last")))
    with shuffles_removed(lineitem.sparkSession):
        kept.withColumn("line", line).select(damaged.alias("value")).write.mode("overwrite").options(**LANDED_OPTIONS).text(path)
    remove_path(lineitem.sparkSession, stored)
    return path


def damaged_pages_sql() -> str:
    """DuckDB text of the damaged pages: (storeId, pn, kind, total, items, urls); needs ``items``."""
    order = ", ".join(f"{c} nulls first" for c in GOODS_ORDER)
    return f"""
ranked as (select storeId, webUrl, (row_number() over (partition by storeId order by {order}) - 1) // {PAGE_SIZE} as pn from items),
stores as (select storeId, cast(ceil(count(*) / {PAGE_SIZE}.0) as bigint) as last, count(distinct webUrl) as total from items group by storeId),
listed as (select storeId, last, total, unnest(range(0, last + 1)) as pn from stores),
pages as (select storeId, pn, case when storeId = '{ZERO_FIRST_STORE}' and pn = 0 then 0 else total end as total,
    case when storeId <> '{WHOLE_STORE}' and pn % {DAMAGE_CYCLE} = {CUT_OFF} then 'broken'
         when storeId <> '{WHOLE_STORE}' and pn % {DAMAGE_CYCLE} = {NO_NUMBER} then 'half' else 'whole' end as kind
  from listed where storeId <> '{UNFINISHED_STORE}' or pn * 2 < last)"""


def goods_sql(string_type: str = "varchar") -> str:
    """DuckDB (or Spark SQL) text of ``goods``: ``select ... from lineitem``."""
    S = string_type
    stores = " ".join(f"when {i} then '{s}'" for i, s in enumerate(_STORES))
    cats = " ".join(f"when {k} then '{v}'" for k, v in _CATEGORIES.items())
    return f"""
select l_orderkey, l_linenumber, l_suppkey, l_shipdate,
  case l_suppkey % 8 {stores} else '9999' end as storeId,
  cast(l_partkey as {S}) as code,
  'Товар' || chr(160) || cast(l_partkey as {S})
    || case when l_linenumber = 3 then chr(10) || chr(9) || ' новинка  ' else '' end as title,
  case when l_partkey % 5 <> 0 then 'Бренд ' || cast(l_partkey % 50 as {S}) end as brand,
  case l_partkey % 8
    when 0 then 'Россия, ' || cast(cast(l_quantity as int) as {S}) || ' г'
    when 1 then 'Россия, ' || cast(cast(l_quantity as int) * 10 as {S}) || 'г'
    when 2 then 'Италия, 0.' || cast(cast(l_quantity as int) as {S}) || 'L'
    when 3 then 'Италия, 0,75L'
    when 4 then cast(cast(l_quantity as int) as {S}) || ' шт'
    when 5 then cast(cast(l_quantity as int) * 10 as {S}) || ' мл'
    when 6 then '0 г' else null end as subTitle,
  '  Описание' || chr(8195) || 'товара' || chr(133) || cast(l_partkey as {S}) || ' ' as description,
  l_extendedprice as regularPrice,
  l_extendedprice * (1 - l_discount) as discountPrice,
  case when l_partkey % 7 <> 0 then '/img/' || cast(l_partkey as {S}) || '.jpg' end as imageFullSize,
  '/p/' || cast(l_partkey as {S}) as webUrl,
  case when l_partkey % 11 <> 0 then 'Продукты питания' end as groupName,
  case l_linenumber {cats} else 'Вино' end as categoryName,
  l_returnflag as subcategoryName
from lineitem"""


def goods_items_sql() -> str:
    """DuckDB text of ``goods_items``."""
    ws = WHITESPACE_RUN_RE2
    return f"""
select l_orderkey, l_linenumber, l_suppkey, l_shipdate,
  '{FETCHED_STAMP}' as timestamp, storeId, code,
  regexp_replace(title, '{ws}', ' ', 'g') as title, brand, subTitle,
  regexp_replace(description, '{ws}', ' ', 'g') as description,
  regularPrice, discountPrice, coalesce(imageFullSize, '') as imageUrl, webUrl,
  coalesce(groupName, '') as groupName, coalesce(categoryName, '') as categoryName,
  coalesce(subcategoryName, '') as subcategoryName
from ({goods_sql()}) g"""
