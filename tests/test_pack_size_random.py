"""Pack-size extraction on random subtitles: Spark's regex engine vs Python's."""

import re

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from shelfprice.constants import PACK_SIZE_PATTERN
from shelfprice.functions import pack_size, pack_size_text

ALPHABET = "0123456789 .,xгмлLкшт"  # no line terminators: '.' agrees between the engines there
PY = re.compile(PACK_SIZE_PATTERN)


def expected(s):
    m = PY.search(s)
    text = m.group(0) if m else ""
    try:
        size = float(text) if text.strip() else None
    except ValueError:
        size = None
    return text, size


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(alphabet=ALPHABET, max_size=14), min_size=50, max_size=200))
def test_matches_python_regex(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "s string")
    got = [(r.t, r.w) for r in df.select(pack_size_text(F.col("s")).alias("t"),
                                         pack_size(F.col("s")).alias("w")).collect()]
    assert got == [expected(t) for t in texts]
