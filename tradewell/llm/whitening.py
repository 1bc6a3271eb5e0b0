"""Whitening of embeddings: distinct integer vectors, their covariance in two
passes, principal components by contour integration (``feast``), projection of
every row.

The distinct list is one aggregate on a compact exact key, which shrinks copies
before the shuffle. Sums are exact integers; the covariance adds centred
products per task and then per entry. Only the means and the dims * dims matrix
reach the driver.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (BinaryType, DoubleType, IntegerType, LongType, StructField, StructType)

from tradewell.llm.common import register, small_batches, stored, table
from tradewell.llm.feast import largest_eigenpairs
from tradewell.llm.ordered import LONGS, as_batch
from tradewell.llm.vectors import ROWS, longest, matrix

OFFSET = 1_000_000
LARGEST = 2.0 ** 62   # larger components are no 64-bit integers
KINDS = [np.int8, np.int16, np.int32, np.int64]

OUT = StructType([StructField("vec_id", LongType()), StructField("component", IntegerType()), StructField("n", LongType()),
                  StructField("deviation", LongType()), StructField("whitened", DoubleType()),
                  StructField("explained", DoubleType()), StructField("identity_error", DoubleType())])


def integers(col, dims: int, scale: float) -> tuple[np.ndarray, np.ndarray]:
    """floor(scale * c) as int64 rows (without the offset) and which rows are usable."""
    x, ok = matrix(col, dims)
    with np.errstate(over="ignore"):
        x = np.floor(scale * x)
        ok &= (np.abs(x) < LARGEST).all(axis=1)
    x[~ok] = 0
    return x.astype(np.int64), ok


def keys(x: np.ndarray) -> list[bytes]:
    """One byte string for each row: the size of the smallest integer type that
    holds all entries, then the entries. Equal rows have equal keys."""
    most = np.maximum(x.max(axis=1, initial=0), -(x.min(axis=1, initial=0) + 1))
    kind = np.searchsorted([127, 32767, 2147483647], most)
    out: list = [None] * len(x)
    for k in np.unique(kind):
        small = np.ascontiguousarray(x[kind == k].astype(KINDS[k]))
        for i, row in zip(np.flatnonzero(kind == k), small):
            out[i] = bytes([k]) + row.tobytes()
    return out


def from_keys(col, dims: int) -> np.ndarray:
    found = col.to_pylist()
    kind = np.array([b[0] for b in found], np.int64)
    x = np.zeros((len(found), dims), np.int64)
    for k in np.unique(kind):
        at = np.flatnonzero(kind == k)
        x[at] = np.frombuffer(b"".join(found[i][1:] for i in at), KINDS[k]).reshape(len(at), dims)
    return x


def fit_list(src: DataFrame, dims: int, scale: float) -> DataFrame:
    def run(batches):
        for b in batches:
            x, ok = integers(b.column(0), dims, scale)
            yield as_batch([pa.array(keys(x[ok]), pa.binary())], ["key"])

    return src.select("vec").mapInArrow(run, StructType([StructField("key", BinaryType())])).distinct()


def exact_sums(fit: DataFrame, dims: int) -> list[int]:
    """Sum of each entry over the list, exact: upper and lower 32 bits apart."""
    def run(batches):
        high, low = np.zeros(dims, np.int64), np.zeros(dims, np.int64)
        for b in batches:
            x = from_keys(b.column(0), dims)
            high += (x >> 32).sum(axis=0)
            low += (x & 0xFFFFFFFF).sum(axis=0)
        yield as_batch([np.arange(dims), high, low], ["at", "high", "low"])

    out = [0] * dims
    for r in fit.mapInArrow(run, LONGS("at", "high", "low")).groupBy("at").agg(F.sum("high").alias("h"), F.sum("low").alias("l")).collect():
        out[r["at"]] = (r["h"] << 32) + r["l"]
    return out


def moment(fit: DataFrame, dims: int, width: int, project) -> np.ndarray:
    """Sum over the list of the outer products of ``project(rows)`` (width
    columns): each task adds its own, Spark adds the entries up."""
    def run(batches):
        total = np.zeros((width, width))
        for b in batches:
            y = project(from_keys(b.column(0), dims))
            total += y.T @ y
        i, j = np.triu_indices(width)
        yield as_batch([i, j, total[i, j]], ["i", "j", "v"])

    kind = StructType([StructField("i", LongType()), StructField("j", LongType()), StructField("v", DoubleType())])
    out = np.zeros((width, width))
    got = fit.mapInArrow(run, kind).groupBy("i", "j").agg(F.sum("v").alias("v")).toArrow()
    i, j, v = (got.column(k).to_numpy() for k in ("i", "j", "v"))
    out[i, j] = out[j, i] = v
    return out


def deviations(x: np.ndarray, n: int, sums: list[int]) -> pa.Array:
    """Sum of (n * x - sums) ** 2 of each row, exact; null beyond 64 bits."""
    mean_sum = np.array([float(s) for s in sums])
    about = ((n * x.astype(float) - mean_sum) ** 2).sum(axis=1)
    limit = float(2 ** 63)
    with np.errstate(over="ignore"):
        # the sum fits, so no term overflows, and wrapped products differ by the right amount
        low = np.array([s & (2 ** 64 - 1) for s in sums], np.uint64).view(np.int64)
        out = ((x * np.int64(n) - low) ** 2).sum(axis=1)
    fits = about < limit * (1 - 1e-6)
    for i in np.flatnonzero(~fits & (about < limit * (1 + 1e-6))):
        total = sum((n * int(v) - s) ** 2 for v, s in zip(x[i], sums))
        fits[i] = total < 2 ** 63
        out[i] = total if fits[i] else 0
    return pa.array(out, mask=~fits)


def whiten(rows: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", components: int = 16,
           scale: float = 64.0) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error.

    Rows whose vector is null or holds null or non-finite entries are dropped,
    as are those with an entry whose integer form exceeds 2**62. Entries become
    x = floor(scale * c) + OFFSET; the fit list is each distinct x vector once
    (n of them). Shorter vectors are padded with c = 0. Components are numbered
    by falling eigenvalue, up to the number of entries; where the covariance has
    rank r, components beyond r have explained 0 and whitened null, and take no part in
    identity_error. ``deviation`` is null beyond 64 bits. A null id stays; repeated rows stay;
    an empty table gives an empty result; other columns are not read."""
    spark = rows.sparkSession
    small_batches(spark, ROWS)
    src = rows.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).alias("vec")).where("vec IS NOT NULL")
    dims = longest(src, "vec")
    fit = stored(fit_list(src, dims, scale), "fit-list")
    n = fit.count()
    if not dims or not n:
        return spark.createDataFrame([], OUT)
    sums = exact_sums(fit, dims)
    mean = np.array([s / n for s in sums])  # without the offset, which centring removes
    cov = moment(fit, dims, dims, lambda x: x - mean) / n
    e, u = largest_eigenpairs(cov, components)
    total = float(np.trace(cov))
    turn = u / np.sqrt(e)
    worst = 0.0
    if len(e):
        worst = float(np.abs(moment(fit, dims, len(e), lambda x: (x - mean) @ turn) / n - np.eye(len(e))).max())
    shown = min(components, dims)
    share = np.zeros(shown)
    share[:len(e)] = e / total if total > 0 else 0.0

    def run(batches):
        for b in batches:
            x, ok = integers(b.column(1), dims, scale)
            x = x[ok]
            z = np.zeros((len(x), shown))
            z[:, :len(e)] = (x - mean) @ turn
            at = np.repeat(np.arange(len(x)), shown)
            which = np.tile(np.arange(shown), len(x))
            yield as_batch([b.column(0).take(pa.array(np.flatnonzero(ok))).take(pa.array(at)), (which + 1).astype(np.int32),
                            np.full(len(at), n, np.int64), deviations(x, n, sums).take(pa.array(at)),
                            pa.array(z.ravel(), mask=which >= len(e)), share[which], np.full(len(at), worst)], OUT.names)

    return src.mapInArrow(run, OUT)


@register("op13_whitening")
def op13_whitening(spark, sf_dir):
    return whiten(table(spark, sf_dir, "embeddings"))
