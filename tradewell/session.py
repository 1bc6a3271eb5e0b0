"""Spark session and shared-folder helpers."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings that matter at any scale. AQE re-plans joins from measured shuffle
# sizes (a broadcast only happens behind that measured bound), coalesces small
# partitions and splits skewed join partitions.
_DEFAULTS = {
    "spark.ui.enabled": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
}


def get_spark(master: str | None = None, app: str = "tradewell",
              shuffle_partitions: int | None = None,
              extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session. On a cluster pass master=None and let
    spark-submit decide; locally ``local[N]`` is used."""
    b = SparkSession.builder.appName(app)
    if master is None:
        master = os.environ.get("TRADEWELL_MASTER")
    if master:
        b = b.master(master)
    conf = dict(_DEFAULTS)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_base(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder.

    ``spark.checkpoint.dir`` names it on a cluster (read from the session,
    never overridden). Only on a local master, when none is configured, is one
    created under the system temp dir; on a cluster that would be each
    machine's own disk, so there it is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = spark.sparkContext.getCheckpointDir()
    if not base:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = tempfile.mkdtemp(prefix="tradewell-ckpt-")
        spark.sparkContext.setCheckpointDir(base)
    elif not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(base)
    return base


def shared_dir(spark: SparkSession, sub: str) -> str:
    """A folder under the shared checkpoint location (see checkpoint_base)."""
    base = checkpoint_base(spark)
    return os.path.join(base, sub) if "://" not in base else f"{base.rstrip('/')}/{sub}"


def written(df, name: str):
    """The table written once under the shared folder and read again, for
    results that several outputs are derived from. It survives lost executors
    and gives the planner its true size. ``drop_written`` deletes it."""
    path = f"{shared_dir(df.sparkSession, name)}-{uuid.uuid4().hex[:12]}"
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._written_path = path
    return out


def drop_written(df) -> None:
    path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df._written_path)
    path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def spread(df, partitions: int | None):
    """Spread CPU-heavy per-row work (XML / HTML parsing) over ``partitions``
    tasks, where the caller asks for it; None leaves the scan's splits."""
    return df.repartition(partitions) if partitions else df


def spread_few(df, partitions: int):
    """``spread`` where the rows lie in fewer partitions than that; more are left
    where they are, as large rows (texts) would all be written to a shuffle."""
    return df if df.rdd.getNumPartitions() >= partitions else spread(df, partitions)
