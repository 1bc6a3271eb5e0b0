"""Session helpers: spread() acts only where a count is given; shared_dir()
uses the configured checkpoint folder."""

import pytest

from tradewell.session import checkpoint_base, shared_dir, spread, spread_few


def test_spread_only_where_asked(spark):
    df = spark.range(1000)
    assert spread(df, None) is df
    assert spread(df, 3).rdd.getNumPartitions() == 3


def test_a_cluster_needs_a_shared_folder(spark):
    class Session:
        class conf:
            get = staticmethod(lambda key, default=None: None)

        class sparkContext:
            master = "spark://host:7077"
            getCheckpointDir = staticmethod(lambda: None)

    with pytest.raises(RuntimeError):
        checkpoint_base(Session)


def test_shared_dir_uses_checkpoint_dir(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    assert shared_dir(spark, "scratch/x") == f"{base}/scratch/x"


def test_spread_few_leaves_many_partitions(spark):
    df = spark.range(100).repartition(6)
    assert spread_few(df, 6) is df
    assert spread_few(df, 9).rdd.getNumPartitions() == 9
