"""DuckDB oracle SQL, one statement per registered query.

The driver registers the parquet tables as views (``lineitem``, ``events``,
``documents``, ``pages`` ...).  Each statement is written independently of the
Spark code: plain SQL over those views, with output columns named exactly as
the Spark query names them.
"""

from __future__ import annotations

from ..constants import (ITEM_COLUMNS, PACK_SIZE_PATTERN, PRICED_CATEGORIES, STORE_CITY,
                         UNIT_HINTS, WHITESPACE_RUN_RE2, WINE_CATEGORY)
from ..sources.goods import LANDED_DS, PAGE_SIZE, damaged_pages_sql, goods_items_sql
from ..sources.reference_pages import reference_cells_sql


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


ITEMS = f"with items as ({goods_items_sql()})\n"
CATS = ", ".join(_q(c) for c in PRICED_CATEGORIES)
HINTS = " or ".join(f"contains(subTitle, {_q(h)})" for h in UNIT_HINTS)
CITY = "case storeId " + " ".join(f"when {_q(k)} then {_q(v)}" for k, v in STORE_CITY.items()) + " end"
WEIGHT = f"try_cast(regexp_extract(subTitle, {_q(PACK_SIZE_PATTERN)}, 0) as double)"
WINE = _q(WINE_CATEGORY)


def _milli(price: str) -> str:
    return (f"case when not isnan({price}) then "
            f"cast(floor(1000 * {price} / nullif(weight, 0)) as bigint) end")


def _scaled(v: str) -> str:
    return f"case when categoryName = {WINE} then ({v}) / 1000 when categoryName <> {WINE} then ({v}) end"


ITEM_LIST = ", ".join(ITEM_COLUMNS)

_AVERAGES = ITEMS + f""", rows as (
  select storeId, categoryName, subcategoryName, {WEIGHT} as weight, discountPrice, regularPrice
  from items where categoryName in ({CATS}) and ({HINTS})
), m as (
  select storeId, categoryName, subcategoryName,
    {_milli('discountPrice')} as md, {_milli('regularPrice')} as mr
  from rows
), a as (
  select storeId, categoryName, subcategoryName,
    {_scaled('sum(md) / count(md)')} as avg_price_discount_new,
    {_scaled('sum(mr) / count(mr)')} as avg_price_regular_new
  from m group by storeId, categoryName, subcategoryName
)
"""

ORACLE_SQL: dict[str, str] = {
    "pack_size": ITEMS + f"""
select subTitle, regexp_extract(subTitle, {_q(PACK_SIZE_PATTERN)}, 0) as weight_text, {WEIGHT} as weight
from items""",
}

for _which in ("discount", "regular"):
    ORACLE_SQL[f"unit_price_{_which}"] = ITEMS + f"""
, w as (select *, {WEIGHT} as weight from items)
select storeId, categoryName, subTitle, {_which}Price, weight,
  {_scaled(_milli(_which + 'Price'))} as price_{_which}_new
from w"""

ORACLE_SQL.update({
    "category_filter": ITEMS + f"""
select timestamp, storeId, categoryName, subcategoryName, title, subTitle, discountPrice, regularPrice
from items where categoryName in ({CATS})""",
    "unit_hint_filter": ITEMS + f"select storeId, webUrl, subTitle from items where {HINTS}",
    "store_city": ITEMS + f"select storeId, webUrl, {CITY} as city from items",
    "avg_discount_price": _AVERAGES + f"select storeId, categoryName, subcategoryName, avg_price_discount_new, {CITY} as city from a",
    "avg_regular_price": _AVERAGES + f"select storeId, categoryName, subcategoryName, avg_price_regular_new, {CITY} as city from a",
    "avg_unit_prices": _AVERAGES + f"""
select storeId, categoryName, subcategoryName, avg_price_discount_new, avg_price_regular_new, {CITY} as city from a""",
    "unit_price_sums": _AVERAGES + """
select storeId, categoryName, subcategoryName,
  cast(sum(md) as bigint) as sum_discount_milli, count(md) as n_discount,
  cast(sum(mr) as bigint) as sum_regular_milli, count(mr) as n_regular
from m group by storeId, categoryName, subcategoryName""",
    "keep_first_by_url": ITEMS + f"""
select {ITEM_LIST} from (
  select *, row_number() over (partition by storeId, webUrl order by
    l_orderkey nulls first, l_linenumber nulls first, l_suppkey nulls first, l_shipdate nulls first,
    regularPrice nulls first, discountPrice nulls first, subcategoryName nulls first, subTitle nulls first) as rn
  from items) where rn = 1""",
    "collapse_whitespace": f"""
select doc_id, regexp_replace(text, {_q(WHITESPACE_RUN_RE2)}, ' ', 'g') as text from documents""",
})

# Ingest stamp: the instant in Moscow time as ISO text with the zone offset,
# fraction left out when zero.  events.ts holds UTC wall-clock time.
_STAMP = """
  with l as (
    select event_id, ts, event_type, timezone('Europe/Moscow', timezone('UTC', ts)) as lt from events
  ), o as (
    select *, cast(epoch(lt) - epoch(ts) as bigint) as off from l
  )
  select event_id, ts, event_type,
    strftime(lt, '%Y-%m-%dT%H:%M:%S')
    || case when microsecond(lt) % 1000000 <> 0 then '.' || strftime(lt, '%f') else '' end
    || case when off < 0 then '-' else '+' end
    || lpad(cast(abs(off) // 3600 as varchar), 2, '0') || ':' || lpad(cast(abs(off) // 60 % 60 as varchar), 2, '0')
    || case when abs(off) % 60 <> 0 then ':' || lpad(cast(abs(off) % 60 as varchar), 2, '0') else '' end as stamp
  from o"""

ORACLE_SQL.update({
    "ingest_stamp": f"select event_id, stamp from ({_STAMP})",
    "parse_timestamp": f"""
select event_id, stamp, epoch_us(ts) as ts_micros, true as bad_text_is_null from ({_STAMP})""",
    "json_flatten": """
select event_id, coalesce(json_extract_string(props, '$.k'), '') as k,
  coalesce(json_extract_string(props, '$.group.name'), '') as group_name
from events""",
})

_KEPT = ITEMS + f""", kept as (
  select * from (
    select *, row_number() over (partition by storeId, webUrl order by
      l_orderkey nulls first, l_linenumber nulls first, l_suppkey nulls first, l_shipdate nulls first,
      regularPrice nulls first, discountPrice nulls first, subcategoryName nulls first,
      subTitle nulls first) as rn
    from items) where rn = 1)
"""
_DT = f"'{LANDED_DS}' as DT"
_NULLED = ", ".join(
    c if c in ("regularPrice", "discountPrice") else f"nullif({c}, '') as {c}" for c in ITEM_COLUMNS)

_KEPT_AVERAGES = _AVERAGES.replace(ITEMS, _KEPT).replace("from items where", "from kept where")

ORACLE_SQL.update({
    "landed_items": ITEMS + f"select {ITEM_LIST} from items",
    "crawl_coverage": ITEMS + ", " + damaged_pages_sql() + """,
seen as (select p.storeId, count(r.storeId) as items_seen, count(distinct r.webUrl) as distinct_items
  from pages p left join ranked r on r.storeId = p.storeId and r.pn = p.pn where p.kind <> 'broken' group by p.storeId),
found as (select storeId, count(*) as pages, count(*) filter (kind = 'half') as bad_lines,
    arg_min(total, pn) filter (kind = 'whole' and total <> 0) as total
  from pages where kind <> 'broken' group by storeId)
select storeId, pages, bad_lines, items_seen, distinct_items, total, distinct_items >= total as complete from found join seen using (storeId)
union all
select null, count(*), count(*), 0, 0, null, null from pages where kind = 'broken' having count(*) > 0""",
    "bad_lines": ITEMS + ", " + damaged_pages_sql() + f"""
select storeId as line_store, pn * {PAGE_SIZE} as line_offset, case when kind = 'half' then storeId end as storeId,
  case when kind = 'half' then pn * {PAGE_SIZE} end as "offset",
  case when kind = 'half' then 'unreadable: total' else 'not JSON' end as reason, true as traced, {_DT}
from pages where kind <> 'whole'""",
    "ingest_items": _KEPT + f"select {ITEM_LIST}, {_DT} from kept",
    "stream_ingest_items": _KEPT + f"select {ITEM_LIST}, {_DT} from kept",
    "html_first_table": reference_cells_sql(),
    "pages_without_table": "select page_id, url from pages",
    "salary_tables": reference_cells_sql(f", {_DT}"),
    "salary_wide": f"""
select page_id, row_no, max(cell) filter (col_no = 0) as page_id_2, max(cell) filter (col_no = 1) as url,
  max(cell) filter (col_no = 2) as chars, cast(null as varchar) as more, {_DT}
from ({reference_cells_sql()}) group by page_id, row_no""",
    # the first copy of each day; the days are those of the price
    "multi_day_averages": _KEPT_AVERAGES.replace(
        "partition by storeId, webUrl", "partition by storeId, webUrl, cast(coalesce(floor(regularPrice), 0) as bigint) % 3") + f"""
select 'discount' as which, storeId, categoryName, subcategoryName, avg_price_discount_new as avg_price, {CITY} as city from a
union all
select 'regular', storeId, categoryName, subcategoryName, avg_price_regular_new, {CITY} from a""",
    "daily_run": _KEPT_AVERAGES + f"""
select storeId, categoryName, subcategoryName, avg_price_discount_new, avg_price_regular_new,
  {CITY} as city, {_DT} from a""",
    "export_csv": _KEPT + f"select {_NULLED} from kept",
    "partition_overwrite": ITEMS + f"select {ITEM_LIST}, {_DT} from items",
    "csv_round_trip": ITEMS + f"select {_NULLED} from items",
})
