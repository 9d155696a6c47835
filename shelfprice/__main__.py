"""Command line: one subcommand per daily job, for ``spark-submit`` or ``python -m shelfprice``.

    python -m shelfprice ingest    --landing L --base B --ds 2024-01-11
    python -m shelfprice salary    --pages P   --base B --ds 2024-01-11 [--wide | --headers H1,H2]
    python -m shelfprice aggregate --base B --ds 2024-01-11 [--dates D1,D2]
    python -m shelfprice publish   --base B --jdbc-url URL [--jdbc-driver ...] [--jdbc-user ...]
    python -m shelfprice daily     --landing L --pages P --base B --ds 2024-01-11 [--jdbc-url URL]
    python -m shelfprice export    --landing L --out CSV_DIR
    python -m shelfprice stream    --landing L --base B --ds 2024-01-11 --checkpoint C [--csv-out D]

``--pages`` is a Parquet dataset with ``page_id`` and ``html`` columns.  The
JDBC password is read from the environment variable named by
``--jdbc-password-env`` so it never appears on a command line.
"""

from __future__ import annotations

import argparse
import os
import sys

from .plans import jobs
from .session import get_session


def _list(text: str | None) -> list[str] | None:
    return None if text is None else [t for t in text.split(",") if t]


def _target(a) -> jobs.JdbcTarget | None:
    if not a.jdbc_url:
        return None
    return jobs.JdbcTarget(url=a.jdbc_url, driver=a.jdbc_driver, user=a.jdbc_user,
                           password=os.environ.get(a.jdbc_password_env) if a.jdbc_password_env else None,
                           truncate=a.jdbc_truncate, num_partitions=a.jdbc_partitions,
                           batchsize=a.jdbc_batchsize)


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="shelfprice")
    p.add_argument("--master", default=None, help="only for local runs; spark-submit sets it")
    sub = p.add_subparsers(dest="cmd", required=True)

    def add(name, *args):
        s = sub.add_parser(name)
        for a in args:
            s.add_argument(f"--{a}", required=a in ("landing", "base", "ds", "pages", "out", "checkpoint"))
        return s

    add("ingest", "landing", "base", "ds", "on-bad-page")
    sal = add("salary", "pages", "base", "ds", "headers")
    add("aggregate", "base", "ds", "dates")
    pub = add("publish", "base")
    daily = add("daily", "landing", "pages", "base", "ds", "dates", "on-bad-page", "headers")
    add("export", "landing", "out", "on-bad-page")
    add("stream", "landing", "base", "ds", "checkpoint", "csv-out")
    for s in (sal, daily):
        s.add_argument("--wide", action="store_true", help="one column for each header of the pages")
    for s in (pub, daily):
        s.add_argument("--jdbc-url", required=s is pub)
        s.add_argument("--jdbc-driver")
        s.add_argument("--jdbc-user")
        s.add_argument("--jdbc-password-env")
        s.add_argument("--jdbc-truncate", action="store_true")
        s.add_argument("--jdbc-partitions", type=int)
        s.add_argument("--jdbc-batchsize", type=int)
    return p


def main(argv: list[str] | None = None) -> int:
    a = parser().parse_args(argv)
    spark = get_session(a.master, app_name=f"shelfprice-{a.cmd}")
    base = getattr(a, "base", None)
    tables = jobs.Tables(base.rstrip("/")) if base else None
    bad = getattr(a, "on_bad_page", None) or "skip"
    if a.cmd == "ingest":
        jobs.ingest(spark, a.landing, tables, a.ds, on_bad_page=bad)
    elif a.cmd == "salary":
        jobs.salary(spark.read.parquet(a.pages), tables, a.ds, headers=_list(a.headers), wide=a.wide)
    elif a.cmd == "aggregate":
        jobs.aggregate(spark, tables, a.ds, dates=_list(a.dates))
    elif a.cmd == "publish":
        jobs.publish(spark, tables, _target(a))
    elif a.cmd == "daily":
        jobs.daily_run(spark, a.landing, spark.read.parquet(a.pages), tables, a.ds,
                       target=_target(a), dates=_list(a.dates), on_bad_page=bad, headers=_list(a.headers), wide=a.wide)
    elif a.cmd == "export":
        jobs.export_csv(spark, a.landing, a.out, on_bad_page=bad)
    elif a.cmd == "stream":
        from .streaming.ingest_stream import stream_ingest

        stream_ingest(spark, a.landing, tables, a.ds, a.checkpoint, csv_out=a.csv_out).awaitTermination()
    return 0


if __name__ == "__main__":
    sys.exit(main())
