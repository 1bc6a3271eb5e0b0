"""Helpers of the operators on embeddings: vectors as matrices, heaps of best rows."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

ROWS = 2048  # rows of an Arrow batch


def longest(df: DataFrame, vec_col: str) -> int:
    """Entries of the longest vector (0 for none): shorter ones are padded with zeros."""
    return df.agg(F.max(F.size(F.col(vec_col)))).first()[0] or 0


def matrix(col: pa.Array, dims: int) -> tuple[np.ndarray, np.ndarray]:
    """A list column as float64 rows padded with zeros, and which rows are
    usable: not null, no null and no non-finite entry. Unusable rows are zero."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    n = len(col)
    ok = np.asarray(col.is_valid(), bool) if n else np.zeros(0, bool)
    lens = np.where(ok, pa.compute.list_value_length(col).fill_null(0).to_numpy(zero_copy_only=False), 0).astype(np.int64)
    flat = col.flatten()  # the entries of the rows that are not null
    gap = np.asarray(flat.is_null(), bool)
    values = flat.cast(pa.float64(), safe=False).fill_null(0.0).to_numpy(zero_copy_only=False)
    bad = gap | ~np.isfinite(values)
    out = np.zeros((n, dims))
    at = np.repeat(np.arange(n), lens)
    ok[at[bad]] = False
    out[at, np.arange(len(at)) - np.repeat(np.cumsum(lens) - lens, lens)] = np.where(bad, 0.0, values)
    out[~ok] = 0.0
    return out, ok


class Heaps:
    """For each key the best ``size`` (score, id): higher scores first, ties by
    the smaller id. Heaps of two tasks merge by putting their rows together."""

    def __init__(self, keys: int, size: int, least, room: int = 1 << 20):
        self.size, self.room = size, room
        self.worst = np.full(keys, least)  # the score that a further row must reach
        self.cols: list | None = None
        self.open: list = []
        self.pending = 0

    def add(self, key, score, ident, *more):
        fit = score >= self.worst[key]
        if fit.any():
            self.open.append([x[fit] for x in (key, score, ident, *more)])
            self.pending += int(fit.sum())
            if self.pending > self.room:
                self.cut()

    def cut(self):
        if not self.open:
            return self.cols
        parts = self.open if self.cols is None else [self.cols, *self.open]
        cols = [np.concatenate(c) for c in zip(*parts)]
        order = np.lexsort((cols[2], -cols[1], cols[0]))
        cols = [c[order] for c in cols]
        key = cols[0]
        first = np.r_[True, key[1:] != key[:-1]]
        rank = np.arange(len(key)) - np.flatnonzero(first)[np.cumsum(first) - 1]
        full = rank == self.size - 1
        self.worst[key[full]] = cols[1][full]
        self.cols, self.open, self.pending = [c[rank < self.size] for c in cols], [], 0
        return self.cols


def merge_heaps(df: DataFrame, key: str, size: int, parts: int) -> DataFrame:
    """The best ``size`` rows (score, id) of each key over all tasks' heaps, with
    their rank. Over 256 tasks, heaps of 256 tasks are merged first, so that no
    key brings more than parts / 256 heaps (or 256) into one task."""
    order = [F.desc("score"), F.asc("id")]
    if parts > 256:
        salt = Window.partitionBy(key, "_salt").orderBy(*order)
        df = (df.withColumn("_salt", F.floor(F.spark_partition_id() / 256)).withColumn("_r", F.row_number().over(salt))
              .where(F.col("_r") <= size).drop("_r", "_salt"))
    w = Window.partitionBy(key).orderBy(*order)
    return df.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= size)
