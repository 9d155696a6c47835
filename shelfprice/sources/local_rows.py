"""R4: a small local batch of item dicts -> DataFrame with the explicit item schema.

For a handful of rows held by the caller (a test, one API response); data of
any size lands as files and is read with R1.  Keys outside the 14 item columns
are ignored, missing keys become null, and whole-number prices are widened to
DOUBLE, so a batch never decides the column types.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..schema import ITEM


def _coerce(v, dtype):
    if v is not None and isinstance(dtype, T.DoubleType) and not isinstance(v, float):
        return float(v)
    return v


def items_frame(spark: SparkSession, rows: Iterable[dict]) -> DataFrame:
    fields = ITEM.fields
    data = [tuple(_coerce(r.get(f.name), f.dataType) for f in fields) for r in rows]
    return spark.createDataFrame(data, ITEM)
