"""The command line runs the daily chain end to end (local master, fresh folders)."""

from shelfprice.__main__ import main, parser
from shelfprice.plans import jobs
from shelfprice.plans.queries import _land, reference_pages
from shelfprice.sources.daily import read_daily

from small_data import SF_SMALL


def test_parser_requires_paths():
    a = parser().parse_args(["aggregate", "--base", "/b", "--ds", "2024-01-11", "--dates", "2024-01-10,2024-01-11"])
    assert (a.cmd, a.base, a.dates) == ("aggregate", "/b", "2024-01-10,2024-01-11")


def test_daily_and_export_commands(spark, scratch):
    landing = _land(spark, SF_SMALL)
    pages = scratch("pages")
    reference_pages(spark, SF_SMALL).write.parquet(pages)
    base = scratch("tables")
    assert main(["daily", "--landing", landing, "--pages", pages, "--base", base, "--ds", "2024-01-11"]) == 0
    t = jobs.Tables(base)
    assert read_daily(spark, t.discount).count() > 0 and read_daily(spark, t.salary).count() > 0
    out = scratch("csv")
    assert main(["export", "--landing", landing, "--out", out]) == 0
    assert spark.read.option("header", "true").csv(out).count() == read_daily(spark, t.raw).count()


def test_ingest_aggregate_stream_commands(spark, scratch):
    landing = _land(spark, SF_SMALL)
    base, sbase = scratch("tables"), scratch("stream-tables")
    assert main(["ingest", "--landing", landing, "--base", base, "--ds", "2024-01-11"]) == 0
    assert main(["aggregate", "--base", base, "--ds", "2024-01-11"]) == 0
    t = jobs.Tables(base)
    assert read_daily(spark, t.unit_prices).count() > 0 and read_daily(spark, t.audit).count() > 0
    assert main(["stream", "--landing", landing, "--base", sbase, "--ds", "2024-01-11",
                 "--checkpoint", scratch("ckpt")]) == 0
    a = sorted(map(tuple, read_daily(spark, t.raw).collect()), key=str)
    b = sorted(map(tuple, read_daily(spark, jobs.Tables(sbase).raw).collect()), key=str)
    assert a == b


def test_jdbc_target_reads_password_from_environment(monkeypatch):
    from shelfprice.__main__ import _target

    monkeypatch.setenv("PRICES_DB_PASSWORD", "s3cret")
    a = parser().parse_args(["publish", "--base", "/b", "--jdbc-url", "jdbc:x://h/db", "--jdbc-user", "u",
                             "--jdbc-password-env", "PRICES_DB_PASSWORD", "--jdbc-partitions", "4"])
    t = _target(a)
    assert (t.url, t.user, t.password, t.num_partitions, t.truncate) == ("jdbc:x://h/db", "u", "s3cret", 4, False)
    assert _target(parser().parse_args(["daily", "--landing", "l", "--pages", "p", "--base", "b",
                                        "--ds", "2024-01-11"])) is None
