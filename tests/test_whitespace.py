"""T3: the Java class equals Python's Unicode whitespace, checked on every BMP code point."""

import re

from pyspark.sql import functions as F

from shelfprice.functions import collapse_whitespace

PY_RUN = re.compile(r"[\s\r\n ]+")


def test_every_bmp_code_point(spark):
    cps = [c for c in range(0x10000) if not 0xD800 <= c <= 0xDFFF]
    rows = [(c, f"a{chr(c)}{chr(c)}b") for c in cps]
    df = spark.createDataFrame(rows, "cp int, s string")
    got = {r.cp: r.t for r in df.select("cp", collapse_whitespace(F.col("s")).alias("t")).collect()}
    bad = [hex(c) for c in cps if got[c] != PY_RUN.sub(" ", f"a{chr(c)}{chr(c)}b")]
    assert bad == []


def test_runs_collapse_without_trim(spark):
    df = spark.createDataFrame([(" \t\n a    b\u0085",), (None,)], "s string")
    assert [r.t for r in df.select(collapse_whitespace(F.col("s")).alias("t")).collect()] == [" a b ", None]
