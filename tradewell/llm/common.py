"""Shared helpers of the training-data operators: scratch tables, registry."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewell.session import checkpoint_base

# Words of a text are maximal runs without these characters (fixed values).
WORD_BREAK = r"[\x20\x09-\x0D]+"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder name under the shared checkpoint folder."""
    return f"{checkpoint_base(spark).rstrip('/')}/llm/{name}-{uuid.uuid4().hex[:12]}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder and read again: cuts the lineage, survives
    lost executors, and gives the planner the true size of the table."""
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_stored(df: DataFrame) -> None:
    """Delete the files of a table that ``stored`` wrote and nobody reads again."""
    spark = df.sparkSession
    for f in {p.rsplit("/", 1)[0] for p in df.inputFiles()}:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def small_batches(spark: SparkSession, rows: int = 500) -> None:
    """Bound the rows of an Arrow batch: texts are long, and a Python worker
    holds a whole batch. A smaller setting of the session stays."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(key, "10000"))
    if now <= 0 or now > rows:
        spark.conf.set(key, str(rows))


def words_of(text) -> F.Column:
    """Array of the words of a text (null text: empty array)."""
    parts = F.split(F.coalesce(text, F.lit("")), WORD_BREAK)
    return F.array_remove(parts, "")


def word_count(text) -> F.Column:
    """Number of words of a text (null: 0), as long."""
    return F.size(words_of(text)).cast("long")


def id_bucket(id_col, n: int) -> F.Column:
    """crc32 of the id written as text, modulo n: the fixed split of labels."""
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")) % n
