"""Rows in one global order, with running totals, spread over many tasks.

``order_rows`` range-partitions by (key, tie) and numbers the rows of every
partition; a summary with one row per partition then turns these into global
row numbers and running sizes. A key with a third of all rows spans several
partitions, because the tie columns take part in the ranges.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, IntegerType, LongType, StructField, StructType

from tradewell.llm.common import stored


def as_batch(columns: list, names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in columns], names=names)


@dataclass
class Ordered:
    """rows: the input columns and part, pos (row of the part), cum (sizes of
    the part up to and with the row), opens (first row of its key). The arrays
    are indexed by part."""

    rows: DataFrame
    n_rows: int
    total: int
    row_off: np.ndarray
    size_off: np.ndarray
    opens_part: np.ndarray  # whether the part's first row opens its key


def order_rows(df: DataFrame, key: str, tie: list[str], size: str) -> Ordered:
    """``key`` must not be null (null ties come first); ``size`` is a long, 0 or more."""
    src = df.repartitionByRange(key, *tie).sortWithinPartitions(key, *tie).withColumn("part", F.spark_partition_id())
    names = src.columns

    def run(batches):
        pos, cum, last = 0, 0, None
        for b in batches:
            if not b.num_rows:
                continue
            sizes = b.column(names.index(size)).to_numpy(zero_copy_only=False).astype(np.int64)
            keys = b.column(names.index(key))
            opens = np.ones(len(sizes), bool)
            opens[0] = last is None or keys[0].as_py() != last
            if len(sizes) > 1:
                opens[1:] = pa.compute.not_equal(keys[1:], keys[:-1]).to_numpy(zero_copy_only=False)
            run_sum = cum + np.cumsum(sizes)
            yield as_batch([*b.columns, pos + np.arange(len(sizes)), run_sum, opens], [*names, "pos", "cum", "opens"])
            pos, cum, last = pos + len(sizes), int(run_sum[-1]), keys[len(sizes) - 1].as_py()

    out = StructType([*src.schema.fields, StructField("pos", LongType()), StructField("cum", LongType()),
                      StructField("opens", BooleanType())])
    rows = stored(src.mapInArrow(run, out), "ordered")
    parts = (rows.groupBy("part").agg(F.count("*").alias("n"), F.max("cum").alias("s"), F.min(key).alias("a"),
                                      F.max(key).alias("z")).orderBy("part").collect())
    n = max([p.part for p in parts], default=-1) + 1
    row_off, size_off, opens = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n, bool)
    n_rows = total = 0
    before = None
    for p in parts:
        row_off[p.part], size_off[p.part], opens[p.part] = n_rows, total, p.a != before
        n_rows, total, before = n_rows + p.n, total + p.s, p.z
    return Ordered(rows, n_rows, total, row_off, size_off, opens)


def key_starts(o: Ordered, size: str, fold, out: StructType) -> DataFrame:
    """Apply ``fold(part_batches)`` where each item is (start position, row
    number) of the rows that open a key; fold yields record batches."""
    row_off, size_off, opens_part = o.row_off, o.size_off, o.opens_part

    def run(batches):
        def items():
            for b in batches:
                part, pos, cum, sizes = (b.column(i).to_numpy(zero_copy_only=False) for i in range(4))
                opens = b.column(4).to_numpy(zero_copy_only=False) & ((pos > 0) | opens_part[part])
                part = part[opens]
                yield size_off[part] + cum[opens] - sizes[opens], row_off[part] + pos[opens]
        yield from fold(items())

    return o.rows.select("part", "pos", "cum", size, "opens").mapInArrow(run, out)


LONGS = lambda *names: StructType([StructField(n, LongType()) for n in names])
INT = IntegerType()
