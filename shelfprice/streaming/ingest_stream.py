"""Incremental ingest: landed pages picked up as they arrive.

The crawler writes each batch of pages as soon as it has them and remembers
which URLs of a store it has already kept, so a later copy of an item is
dropped.  Here that is a file stream over the landing folder:

  * each micro-batch is parsed once and staged; its broken lines go to the ``bad_lines`` table of the day with
    file, line number and reason (a line that is there already is not added again);
  * its items are cut to the first copy per (storeId, webUrl) by page order (the keep-first aggregate, so a
    hot key is reduced map-side);
  * a left-anti join drops URLs kept by earlier batches;
  * the rest is appended to ``<raw>/DT=<ds>``.

What earlier batches kept is an index of keys, 128 bits each, in BUCKETS folders by hash, under the checkpoint.
A batch reads only the buckets that its own keys fall in, and adds its new keys to them.  The index belongs to one
start of the stream and is built from what the day holds at its first batch, the one that may be a replay; so the written
table stays the only truth, and a batch that is replayed after a failure finds its own rows already written
and appends nothing.  A batch reads at most as many keys as are written, and at most its number of
keys times what a bucket holds.

With ``csv_out`` the new items also go to CSV (the export the crawler writes
batch by batch), in one folder per batch, ``<csv_out>/<stream>-batch-<id>``
(``<stream>`` is derived from the checkpoint path, so a new stream never
reuses an old stream's folder names); read it
back with ``read_csv(..., recursive=True)``.  Two sinks need one answer per
batch, so the batch's new items are first written to
``<checkpoint>/staged/batch-<id>`` (reused as is if a replay finds it
complete); the Parquet append anti-joins that staged table against what is
written, and the CSV folder of the batch is overwritten from it.
With ``available_now`` the stream drains what has landed and stops.
"""

from __future__ import annotations

import hashlib
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.items import DEDUPE_KEYS
from ..plans.jobs import Tables, crawl_items
from ..schema import ITEM
from ..session import list_path, path_exists, remove_path, shuffles_removed
from ..sinks.files import daily_path, write_csv
from ..sources.landing import bad_line_ledger, parse_lines, read_lines

BUCKETS = 1024


def _hashed(df: DataFrame) -> DataFrame:
    """``df`` with the two halves of its key's hash and its bucket; null is a value like any other, as in keep-first."""
    parts = [x for k in DEDUPE_KEYS for x in (F.col(k).isNull(), F.coalesce(F.col(k), F.lit("")))]
    k1 = F.xxhash64(F.lit(1), *parts)
    return df.withColumns({"k1": k1, "k2": F.xxhash64(F.lit(2), *parts), "bucket": F.pmod(k1, F.lit(BUCKETS)).cast("int")})


class KeyIndex:
    """The keys that a day's written items have, in folders by bucket."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def add(self, items: DataFrame) -> None:
        """Adds the keys of ``items``: one file in each bucket they touch."""
        keys = _hashed(items).select("bucket", "k1", "k2")
        with shuffles_removed(self.spark):
            keys.repartition("bucket").write.mode("append").partitionBy("bucket").parquet(self.path)

    def keys_of(self, buckets: list[int]) -> DataFrame:
        """(k1, k2) of the given buckets; the others are not read."""
        there = {name for name, *_ in list_path(self.spark, self.path)}
        paths = [f"{self.path}/bucket={b}" for b in buckets if f"bucket={b}" in there]
        reader = self.spark.read.schema("k1 long, k2 long")
        return reader.parquet(*paths) if paths else self.spark.createDataFrame([], "k1 long, k2 long")

    def unseen(self, items: DataFrame) -> DataFrame:
        """The rows of the stored ``items`` whose key is not in the index."""
        hashed = _hashed(items)
        buckets = sorted(r["bucket"] for r in hashed.select("bucket").distinct().collect())     # BUCKETS at most
        return hashed.join(self.keys_of(buckets), ["k1", "k2"], "left_anti").select(*items.columns)


def _add_bad_lines(lines: DataFrame, path: str) -> None:
    """Appends the broken lines of a batch that the day's table does not hold yet."""
    spark, bad = lines.sparkSession, bad_line_ledger(lines)
    if path_exists(spark, path):
        held = spark.read.schema(bad.schema).parquet(path).select("source_file", "line_no")
        bad = bad.join(held, ["source_file", "line_no"], "left_anti")
    with shuffles_removed(spark):
        bad.write.mode("append").parquet(path)


def stream_ingest(spark: SparkSession, landing: str, tables: Tables, ds: str, checkpoint: str,
                  available_now: bool = True, max_files_per_trigger: int | None = None,
                  processing_time: str = "1 minute", csv_out: str | None = None) -> StreamingQuery:
    reader = spark.readStream
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    lines = read_lines(reader, landing)
    out, bad_out = daily_path(tables.raw, ds), daily_path(tables.bad_lines, ds)
    root = checkpoint.rstrip("/")
    stream_tag = hashlib.sha1(checkpoint.encode("utf-8")).hexdigest()[:10]
    index: list[KeyIndex] = []

    def written_keys(spark_: SparkSession) -> KeyIndex:
        """The index of this start of the stream, built from the day's items at its first batch.

        Only a missing folder means "nothing written": any other read error stops
        the batch (and the stream retries it) rather than appending copies.
        """
        if not index:
            remove_path(spark_, f"{root}/keys")
            index.append(KeyIndex(spark_, f"{root}/keys/{uuid.uuid4().hex}"))
            if path_exists(spark_, out):
                index[0].add(spark_.read.schema(ITEM).parquet(out).select(*DEDUPE_KEYS))
        return index[0]

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        spark_ = batch.sparkSession
        keys = written_keys(spark_)
        parsed = f"{root}/parsed/batch-{batch_id:08d}"
        pages = parse_lines(batch)
        pages.write.mode("overwrite").option("compression", "zstd").parquet(parsed)
        landed = spark_.read.schema(pages.schema).parquet(parsed)
        _add_bad_lines(landed, bad_out)
        staged = f"{root}/staged/batch-{batch_id:08d}"
        again = csv_out is not None and path_exists(spark_, staged + "/_SUCCESS")      # an earlier try came this far
        if not again:
            first = f"{root}/first/batch-{batch_id:08d}"
            with shuffles_removed(spark_):
                crawl_items(landed.filter(~F.col("blank"))).write.mode("overwrite").option("compression", "zstd").parquet(first)
                remove_path(spark_, parsed)
                keys.unseen(spark_.read.schema(ITEM).parquet(first)).write.mode("overwrite").option("compression", "zstd").parquet(staged)
            remove_path(spark_, first)
        else:
            remove_path(spark_, parsed)
        new = spark_.read.schema(ITEM).parquet(staged)
        with shuffles_removed(spark_):
            (keys.unseen(new) if again else new).write.mode("append").option("compression", "zstd").parquet(out)
        keys.add(new.select(*DEDUPE_KEYS))
        if csv_out is None:
            remove_path(spark_, staged)
        else:
            write_csv(new, f"{csv_out.rstrip('/')}/{stream_tag}-batch-{batch_id:08d}", mode="overwrite")

    writer = lines.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=processing_time)
    return writer.start()
