"""Scratch space comes from the session's spark.checkpoint.dir; every path is fresh."""

from shelfprice.session import checkpoint_root, path_exists, scratch_path


def test_checkpoint_root_is_the_configured_folder(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir", None)
    root = checkpoint_root(spark)
    if configured:
        assert root == configured.rstrip("/")
    assert spark.sparkContext.getCheckpointDir() is not None


def test_scratch_paths_are_fresh_and_below_the_root(spark):
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a != b and a.startswith(checkpoint_root(spark) + "/shelfprice/") and a.endswith("/x")
    assert not path_exists(spark, a)
    spark.range(1).write.parquet(a)
    assert path_exists(spark, a + "/_SUCCESS")
