"""First-table scan (R3): nation rendered per region round-trips; header and span rules."""

import html as H

from pyspark.sql import functions as F

from shelfprice.sources.html_tables import first_table_cells, html_first_table

from small_data import SF_SMALL


def test_nation_per_region_round_trip(spark):
    nation = spark.read.parquet(f"{SF_SMALL}/nation.parquet").collect()
    region = {r.r_regionkey: r.r_name for r in spark.read.parquet(f"{SF_SMALL}/region.parquet").collect()}
    pages, want = [], set()
    for rk, rname in region.items():
        rows = sorted((n for n in nation if n.n_regionkey == rk), key=lambda n: n.n_nationkey)
        body = "".join(f"<tr><td>{n.n_nationkey}</td><td> {H.escape(n.n_name)} </td></tr>" for n in rows)
        pages.append((rk, f"<html><body><h1>{H.escape(rname)}</h1><table><tr><th>n_nationkey</th>"
                          f"<th>n_name</th></tr>{body}</table></body></html>"))
        for i, n in enumerate(rows):
            want |= {(rk, i, 0, "n_nationkey", str(n.n_nationkey)), (rk, i, 1, "n_name", n.n_name)}
    df = spark.createDataFrame(pages, "page_id long, html string")
    got = {tuple(r) for r in html_first_table(df).collect()}
    assert got == want and len(got) == 50


def test_header_rules_spans_hidden_and_nesting():
    page = """<script>var s = "<table><tr><td>no</td></tr></table>";</script>
    <table>
      <thead><tr><th colspan="2">Город</th><th rowspan="2">Зарплата</th></tr>
             <tr><th>имя</th><th>код</th></tr></thead>
      <tbody>
        <tr><td rowspan="2">Москва</td><td>77</td><td>120&nbsp;000</td></tr>
        <tr><td><table><tr><td>inner</td></tr></table></td><td style="display: none">x</td><td></td></tr>
        <tr><td>Казань<td>16<td>  70
         000 </td>
      </tbody>
      <tfoot><tr><td>итого</td></tr></tfoot>
    </table><table><tr><td>second</td></tr></table>"""
    got = first_table_cells(page)
    headers = {c: h for _, c, h, _ in got}
    assert headers == {0: "Город / имя", 1: "Город / код", 2: "Зарплата"}
    cells = {(r, c): v for r, c, _, v in got}
    assert cells[(0, 0)] == "Москва" and cells[(0, 2)] == "120 000"
    assert cells[(1, 0)] == "Москва" and cells[(1, 1)] == "inner" and cells[(1, 2)] is None
    assert [cells[(2, c)] for c in range(3)] == ["Казань", "16", "70 000"]
    assert [cells[(3, c)] for c in range(3)] == ["итого", None, None]
    assert max(r for r, _ in cells) == 3


def test_leading_th_rows_are_header_and_no_header_is_null():
    got = first_table_cells("<table><tr><th>a</th><th>b</th></tr><tr><td>1</td><td>2</td></tr></table>")
    assert got == [(0, 0, "a", "1"), (0, 1, "b", "2")]
    got = first_table_cells("<TABLE><TR><TD>1</TD><TD>2</TD></TR></TABLE>")
    assert got == [(0, 0, None, "1"), (0, 1, None, "2")]


def test_pages_without_table_yield_nothing(spark):
    pages = spark.read.parquet(f"{SF_SMALL}/pages.parquet")
    assert html_first_table(pages).count() == 0
    assert first_table_cells(None) == [] and first_table_cells("<p>no</p>") == []


def test_table_without_text_is_passed_over():
    got = first_table_cells('<table><tr><td></td></tr></table><table style="display:none"><tr><td>h</td></tr>'
                            '</table><table><tr><td>x</td></tr></table>')
    assert got == [(0, 0, None, "x")]


def test_cells_to_wide(spark):
    from shelfprice.sources.html_tables import cells_to_wide

    page = ("<table><thead><tr><th>Регион</th><th>Зарплата</th></tr></thead>"
            "<tr><td>Москва</td><td>120 000</td></tr><tr><td>Казань</td><td></td></tr></table>")
    df = spark.createDataFrame([(1, page)], "page_id long, html string")
    wide = cells_to_wide(html_first_table(df), ["Регион", "Зарплата"])
    assert wide.columns == ["page_id", "row_no", "Регион", "Зарплата", "more"]
    assert sorted(tuple(r) for r in wide.collect()) == [(1, 0, "Москва", "120 000", None), (1, 1, "Казань", None, None)]


def test_cells_to_wide_keeps_equal_headers_and_further_columns(spark):
    from shelfprice.sources.html_tables import cells_to_wide

    page = "<table><tr><th>a<th>a<th><th>d</tr><tr><td>1<td>2<td>3<td>4</tr></table>"
    cells = html_first_table(spark.createDataFrame([(1, page)], "page_id long, html string"))
    assert [tuple(r) for r in cells_to_wide(cells, ["a", "a", ""]).collect()] == [(1, 0, "1", "2", "3", "4")]
    assert cells_to_wide(cells, ["a", "a", ""]).columns == ["page_id", "row_no", "a", "a_2", "column_2", "more"]


def test_end_tags_left_out_and_blank_tables():
    assert first_table_cells("<table><tr><td style='display:none'>h<td>1<td>2</tr><tr><td>3<td>4</tr></table>") == [
        (0, 0, None, "1"), (0, 1, None, "2"), (1, 0, None, "3"), (1, 1, None, "4")]
    assert first_table_cells("<p style='display:none'>x<div>y</div><table><tr><td>1</table>") == [(0, 0, None, "1")]
    assert first_table_cells("<table>\n <tr>\n <td> </td>\n</tr></table><table><tr><td>x</table>") == [(0, 0, None, "x")]


def test_spans_fill_rectangles():
    got = first_table_cells("<table><tr><td rowspan=2 colspan=2>a<td>b<tr><td>c<tr><td>d<td rowspan=2>e</table>")
    assert [(r, c, t) for r, c, _, t in got if t] == [
        (0, 0, "a"), (0, 1, "a"), (0, 2, "b"), (1, 0, "a"), (1, 1, "a"), (1, 2, "c"), (2, 0, "d"), (2, 1, "e"), (3, 1, "e")]


def test_row_without_cells_is_dropped():
    got = first_table_cells("<table><tr><td>a</td><td>b</td></tr><tr></tr><tr><td></td><td> </td></tr>"
                            "<tr><td>c</td></tr></table>")
    assert got == [(0, 0, None, "a"), (0, 1, None, "b"), (1, 0, None, None), (1, 1, None, None),
                   (2, 0, None, "c"), (2, 1, None, None)]


def test_salary_job_reports_pages_without_table(spark, scratch):
    from pyspark.sql import functions as F

    from shelfprice.plans import jobs
    from shelfprice.sources.daily import read_daily

    plain = spark.read.parquet(f"{SF_SMALL}/pages.parquet")          # real pages, none has a table
    one = plain.limit(1).select(F.lit(-1).cast("long").alias("page_id"), "url",
                                F.lit("<table><tr><td>x</td></tr></table>").alias("html"))
    pages = plain.unionByName(one)
    tables = jobs.Tables(scratch("tables"))
    jobs.salary(pages, tables, "2024-01-11")
    assert [r.page_id for r in read_daily(spark, tables.salary).collect()] == [-1]
    missing = {r.page_id for r in read_daily(spark, tables.salary_missing).collect()}
    assert missing == {r.page_id for r in plain.select("page_id").collect()}


def plain_grid(rows):
    """The table model with a dictionary for every row."""
    taken, n = {}, 0
    while n < len(rows) or any(r >= n for r, _ in taken):
        col = 0
        for _, text, rowspan, colspan in rows[n] if n < len(rows) else ():
            while (n, col) in taken:
                col += 1
            for r in range(n, n + rowspan):
                for c in range(col, col + colspan):
                    taken.setdefault((r, c), text)
        row = {c: t for (r, c), t in taken.items() if r == n}
        yield [row.get(c) for c in range(max(row, default=-1) + 1)]
        n += 1


def test_spans_equal_a_plain_grid():
    import random

    from shelfprice.sources.html_tables import _runs, _slots

    rnd = random.Random(1)
    for _ in range(500):
        rows = [[(False, f"t{rnd.randrange(99)}", rnd.choice([1, 1, 2, 3, 5]), rnd.choice([1, 1, 2, 4])) for _ in range(rnd.randrange(5))]
                for _ in range(rnd.randrange(6))]
        assert [list(_slots(r, r[-1][1] if r else 0)) for r in _runs(rows)] == list(plain_grid(rows))


def test_huge_spans_are_held_as_runs():
    """65 million slots of one cell: rows come one by one, and memory does not grow with them."""
    import tracemalloc
    from itertools import islice

    from shelfprice.sources.html_tables import iterate_first_table

    page = "<table><tr><th>h</tr><tr><td rowspan=65534 colspan=1000>x</td><td>y</table>"
    tracemalloc.start()
    cells = list(islice(iterate_first_table(page), 998, 1004))
    for _ in islice(iterate_first_table(page), 300_000):
        pass
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert cells == [(0, 998, None, "x"), (0, 999, None, "x"), (0, 1000, None, "y"), (1, 0, "h", "x"), (1, 1, None, "x"), (1, 2, None, "x")]
    assert peak < 1 << 20
