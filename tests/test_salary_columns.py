"""J2 with the pages' own headers, and J4 with days of both shapes."""

from shelfprice.plans import jobs
from shelfprice.sources.daily import read_daily
from shelfprice.sources.html_tables import cells_by_header, discover_columns, html_first_table

DS = "2024-01-11"


def pages(spark, *tables):
    return spark.createDataFrame([(i, f"/{i}", f"<table>{t}</table>") for i, t in enumerate(tables)], "page_id long, url string, html string")


def test_columns_come_from_the_pages(spark):
    cells = html_first_table(pages(
        spark, "<tr><th>Регион<th>Зарплата<th>Зарплата<th></tr><tr><td>Москва<td>120<td>130<td>x</tr>",
        "<tr><th>Зарплата<th>Регион<th>page_id</tr><tr><td>90<td>Казань<td>p</tr><tr><td>91</tr>", "<tr><td>no header<td>y</tr>"))
    columns = discover_columns(cells)
    assert columns == [("", 0), ("Зарплата", 0), ("Регион", 0), ("", 1), ("Зарплата", 1), ("page_id", 0)] or set(columns) == {
        ("", 0), ("", 1), ("Зарплата", 0), ("Зарплата", 1), ("Регион", 0), ("page_id", 0)}
    wide = cells_by_header(cells, columns)
    rows = {(r.page_id, r.row_no): r.asDict() for r in wide.collect()}
    assert rows[0, 0]["Регион"] == "Москва" and rows[0, 0]["Зарплата"] == "120" and rows[0, 0]["Зарплата_2"] == "130"
    assert rows[0, 0]["column"] == "x" and rows[1, 0]["Регион"] == "Казань" and rows[1, 0]["page_id_2"] == "p"
    assert rows[1, 1]["Зарплата"] == "91" and rows[1, 1]["Регион"] is None
    assert rows[2, 0]["column"] == "no header" and rows[2, 0]["column_2"] == "y"
    assert all(r["more"] is None for r in rows.values())


def test_columns_beyond_the_bound_are_kept_in_more(spark):
    cells = html_first_table(pages(spark, "<tr><th>a<th>b<th>c</tr><tr><td>1<td>2<td>3</tr>", "<tr><th>b</tr><tr><td>4</tr>"))
    wide = cells_by_header(cells, discover_columns(cells, max_columns=1))
    assert wide.columns == ["page_id", "row_no", "b", "more"]
    assert sorted(map(tuple, wide.collect())) == [(0, 0, "2", "1 | 3"), (1, 0, "4", None)]


def test_no_table_anywhere(spark, scratch):
    tables = jobs.Tables(scratch("tables"))
    jobs.salary(pages(spark), tables, DS, wide=True)
    assert read_daily(spark, tables.salary_wide).count() == 0
    plain = spark.createDataFrame([(1, "/u", "<p>")], "page_id long, url string, html string")
    jobs.salary(plain, tables, DS, wide=True)
    assert read_daily(spark, tables.salary_missing).count() == 1


def test_publish_sends_every_day_of_both_shapes(spark, scratch, monkeypatch):
    tables = jobs.Tables(scratch("tables"))
    first = pages(spark, "<tr><th>city<th>pay</tr><tr><td>A<td>1</tr>")
    second = pages(spark, "<tr><th>pay<th>year</tr><tr><td>2<td>2024</tr>")
    jobs.salary(first, tables, "2024-01-09")
    sent = {}
    monkeypatch.setattr(jobs, "write_jdbc", lambda df, url, name, **k: sent.update({name: df}))
    monkeypatch.setattr(jobs, "PUBLISHED", (("salary", "avg_salary"),))
    jobs.publish(spark, tables, jobs.JdbcTarget("jdbc:x"))
    assert "header" in sent["avg_salary"].columns and sent["avg_salary"].count() == 2      # all days in long form
    jobs.salary(second, tables, "2024-01-10", wide=True)
    jobs.salary(first, tables, "2024-01-11", headers=["city"])
    jobs.publish(spark, tables, jobs.JdbcTarget("jdbc:x"))
    got = sorted((str(r.DT), r.city, r.pay, r.year, r.more) for r in sent["avg_salary"].collect())
    assert got == [("2024-01-09", "A", "1", None, None), ("2024-01-10", None, "2", "2024", None), ("2024-01-11", "A", None, None, "1")]
