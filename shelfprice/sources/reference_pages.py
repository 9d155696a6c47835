"""Reference pages with a table: the driver's ``pages`` plus one appended table.

The driver's pages are real HTML (scripts, styles, nav) without any
``<table>``.  Appending a small table built from each page's own columns gives
a pages dataset that grows with the driver table and exercises the whole
first-table scan (header, colspan, rowspan, hidden cell, empty cell,
whitespace, entities, a second table that must be ignored).
``reference_cells_sql`` is the DuckDB text of the cells that scan must yield.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def _escape(c: Column) -> Column:
    for raw, ent in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        c = F.replace(c, F.lit(raw), F.lit(ent))
    return c


def pages_with_table(pages: DataFrame) -> DataFrame:
    pid = F.col("page_id").cast("string")
    table = F.concat(
        F.lit('<table class="t"><thead><tr><th>page_id</th><th> url </th><th>chars</th></tr></thead><tbody>'),
        F.lit("<tr><td>"), pid, F.lit("</td><td>"), _escape(F.col("url")), F.lit("</td><td>"),
        F.length("html").cast("string"), F.lit("</td></tr>"),
        F.lit('<tr><td colspan="2">page '), pid, F.lit("</td><td>  </td></tr>"),
        F.lit('<tr><td rowspan="2">r'), pid,
        F.lit('</td><td>\n  x  \t y </td><td style="display:none">hidden</td><td>y</td></tr>'),
        F.lit("<tr><td>u</td><td>v</td></tr></tbody></table>"),
        F.lit("<table><tr><th>second</th></tr><tr><td>ignored</td></tr></table>"),
    )
    return pages.select("page_id", "url", F.concat(F.col("html"), table).alias("html"))


_CELLS = [
    (0, 0, "page_id", "cast(page_id as varchar)"),
    (0, 1, "url", "url"),
    (0, 2, "chars", "cast(length(html) as varchar)"),
    (1, 0, "page_id", "'page ' || cast(page_id as varchar)"),
    (1, 1, "url", "'page ' || cast(page_id as varchar)"),
    (1, 2, "chars", "cast(null as varchar)"),
    (2, 0, "page_id", "'r' || cast(page_id as varchar)"),
    (2, 1, "url", "'x y'"),
    (2, 2, "chars", "'y'"),
    (3, 0, "page_id", "'r' || cast(page_id as varchar)"),
    (3, 1, "url", "'u'"),
    (3, 2, "chars", "'v'"),
]


def reference_cells_sql(extra_select: str = "") -> str:
    parts = [
        f"select page_id, cast({r} as integer) as row_no, cast({c} as integer) as col_no, "
        f"'{h}' as header, {cell} as cell{extra_select} from pages"
        for r, c, h, cell in _CELLS
    ]
    return "\nunion all\n".join(parts)
