"""R4 (local rows, explicit schema) and K3 (JDBC writer options, no database)."""

from shelfprice.constants import ITEM_COLUMNS
from shelfprice.sinks.jdbc import write_jdbc
from shelfprice.sources.local_rows import items_frame


def test_items_frame_fixes_types_and_ignores_extra_keys(spark):
    df = items_frame(spark, [{"storeId": "0124", "regularPrice": 100, "extra": 1},
                             {"storeId": "0091", "discountPrice": 9.5, "webUrl": "/a"}])
    assert df.columns == list(ITEM_COLUMNS)
    assert dict(df.dtypes)["regularPrice"] == "double"
    rows = df.collect()
    assert rows[0].regularPrice == 100.0 and rows[0].storeId == "0124" and rows[1].regularPrice is None


class _Writer:
    def __init__(self, log):
        self.log = log

    def mode(self, m):
        self.log["mode"] = m
        return self

    def format(self, f):
        self.log["format"] = f
        return self

    def option(self, k, v):
        self.log.setdefault("options", {})[k] = v
        return self

    def save(self):
        self.log["saved"] = True


class _Frame:
    def __init__(self):
        self.log = {}

    @property
    def write(self):
        return _Writer(self.log)


def test_write_jdbc_options():
    f = _Frame()
    write_jdbc(f, "jdbc:mysql://db:3306/prices", "avg_regular_price", driver="com.mysql.cj.jdbc.Driver",
               user="u", password="", truncate=True, num_partitions=8, batchsize=5000)
    assert f.log["mode"] == "overwrite" and f.log["format"] == "jdbc" and f.log["saved"]
    assert f.log["options"] == {"url": "jdbc:mysql://db:3306/prices", "dbtable": "avg_regular_price",
                                "driver": "com.mysql.cj.jdbc.Driver", "user": "u", "password": "",
                                "numPartitions": "8", "batchsize": "5000", "truncate": "true"}


def test_publish_sends_every_day_of_three_tables(spark, scratch, monkeypatch):
    from shelfprice.plans import jobs
    from shelfprice.sinks.files import write_daily

    tables = jobs.Tables(scratch("tables"))
    for root in (tables.regular, tables.discount, tables.salary):
        write_daily(spark.createDataFrame([(1,)], "x int"), root, "2024-01-10")
        write_daily(spark.createDataFrame([(2,)], "x int"), root, "2024-01-11")
    sent = {}

    def fake_write(df, url, table, **kw):
        sent[table] = (url, sorted((r.x, str(r.DT)) for r in df.collect()), kw["truncate"])

    monkeypatch.setattr(jobs, "write_jdbc", fake_write)
    jobs.publish(spark, tables, jobs.JdbcTarget(url="jdbc:test://db/prices", truncate=True))
    days = [(1, "2024-01-10"), (2, "2024-01-11")]
    assert sent == {name: ("jdbc:test://db/prices", days, True)
                    for name in ("avg_regular_price", "avg_discount_price", "avg_salary")}
