"""Session defaults and the shared scratch location.

Scratch output (landed fixtures, round-trip tables, lineage cuts) goes under
the folder the cluster names in ``spark.checkpoint.dir``: a shared file system
every executor can reach.  A machine-local folder is only chosen when that
setting is absent, which happens in local tests.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings a job of this package wants on any cluster.  Shuffle width and
# file split size are left to the cluster's defaults unless given.
SESSION_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # Parquet DT partitions are overwritten by path; keep static semantics.
    "spark.sql.sources.partitionOverwriteMode": "static",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "shelfprice", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for k, v in SESSION_DEFAULTS.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    return builder.getOrCreate()


def checkpoint_root(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder; set one only where it is unset."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # a session without a local SparkContext: use the setting as is
        sc = None
    if sc is not None:
        # the setting, or a folder set with setCheckpointDir(); a local one only when neither exists
        root = root or sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
        if not root:
            # executors of a cluster cannot see the driver's own folders
            if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
                raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
            root = tempfile.mkdtemp(prefix="shelfprice-ckpt-")
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(root)
    if not root:
        raise RuntimeError("spark.checkpoint.dir is not set")
    return root.rstrip("/")


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A fresh, never reused folder below the shared checkpoint root."""
    return "/".join([checkpoint_root(spark), "shelfprice", uuid.uuid4().hex, *parts])


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder exists on the cluster's file system.

    Whatever keeps it from being asked is raised, never read as "absent".
    """
    sc = spark.sparkContext
    jvm, conf = sc._jvm, sc._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    return bool(p.getFileSystem(conf).exists(p))


def remove_path(spark: SparkSession, path: str) -> None:
    """Deletes a file or folder on the cluster's file system; nothing happens if it is absent."""
    sc = spark.sparkContext
    p = sc._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(sc._jsc.hadoopConfiguration()).delete(p, True)


SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Within it Spark removes a write's shuffle files when the write ends, not when the driver's heap happens to be collected."""
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)


def list_path(spark: SparkSession, path: str) -> list[tuple[str, bool, int]]:
    """(name, whether it is a folder, time of its last change) of what lies in a folder: one call, none if it is absent."""
    sc = spark.sparkContext
    p = sc._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(sc._jsc.hadoopConfiguration())
    if not fs.exists(p):
        return []
    return [(st.getPath().getName(), st.isDirectory(), st.getModificationTime()) for st in fs.listStatus(p)]


def create_file(spark: SparkSession, path: str) -> None:
    """An empty file; that it exists is its content, so it appears whole or not at all."""
    sc = spark.sparkContext
    p = sc._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(sc._jsc.hadoopConfiguration()).create(p, False).close()
