"""Approximate nearest neighbours by cross-polytope hashing.

A hash is a pseudo-rotation (three rounds of random signs and a fast Hadamard
transform) and then the nearest signed axis. A table joins two hashes; a bucket
is the pair of axes. A query probes, in each table, every bucket whose cost is
within a threshold: the cost of an axis is how far its coordinate lies below
the largest, and a bucket's cost is the sum over its two axes.

The threshold is fitted: a bounded sample of queries is compared with every
row, and the threshold is the least that would find the stated share of their
true neighbours. The index holds every row with its bucket of each table. Blocks of
queries (bounded in bytes) are broadcast and meet the whole index; candidates
of any table are ranked by their exact cosine, and a task sends its heaps only.
Queries that found too few candidates are compared with all rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (BinaryType, DoubleType, IntegerType, LongType, StructField, StructType)

from tradewell.llm.common import drop_stored, register, scratch, small_batches, stored, table
from tradewell.llm.ordered import as_batch
from tradewell.llm.vectors import ROWS, Heaps, longest, matrix, merge_heaps

TABLES = 32
SEED = 20240611
FOUND = 0.96              # share of the sample's true neighbours that the threshold must reach
SAMPLE = 256              # queries of the sample
BLOCK_BYTES = 32 << 20    # vectors and probes of the queries that are searched at once
PAIRS = 1 << 20           # candidates that are gathered at once
RANKED = 1 << 16          # candidates that are ranked at once

OUT = StructType([StructField("query_id", LongType()), StructField("rank", IntegerType()),
                  StructField("vec_id", LongType()), StructField("score", DoubleType())])
HEAP = StructType([StructField("query", LongType()), StructField("score", DoubleType()), StructField("id", LongType())])


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform along the first axis (a power of two),
    orthonormal; each step adds whole rows."""
    x = np.array(x, order="C")  # a copy, changed in place
    n, step = len(x), 1
    while step < n:
        pairs = x.reshape(n // (2 * step), 2, step, -1)
        first = pairs[:, 0].copy()
        pairs[:, 0] += pairs[:, 1]
        np.subtract(first, pairs[:, 1], out=pairs[:, 1])
        step *= 2
    x *= x.dtype.type(1 / np.sqrt(n))
    return x


class Polytopes:
    """The 2 * tables pseudo-rotations of vectors with ``dims`` entries."""

    def __init__(self, dims: int, tables: int):
        self.width = 1 << max(1, (max(dims, 1) - 1).bit_length())  # padded with zeros to a power of two
        self.tables = tables
        self.signs = np.random.default_rng(SEED).choice(np.array([-1.0, 1.0], np.float32), (3, 2 * tables, self.width))

    def turn(self, x: np.ndarray) -> np.ndarray:
        """(width, 2 * tables, rows) coordinates of unit rows."""
        x = np.pad(x.astype(np.float32), ((0, 0), (0, self.width - x.shape[1]))).T[:, None, :]
        for signs in self.signs:
            x = hadamard(x * signs.T[:, :, None])
        return x

    def axes(self, x: np.ndarray) -> np.ndarray:
        """(rows, 2 * tables) nearest signed axis: below width positive, above negative."""
        out = np.empty((len(x), 2 * self.tables), np.int64)
        step = max(1, (1 << 18) // (2 * self.tables * self.width))
        for lo in range(0, len(x), step):
            y = self.turn(x[lo:lo + step])
            high, low = y.max(axis=0), y.min(axis=0)
            up = high >= -low  # the larger of the two signs; the first axis that has it
            at = (y == np.where(up, high, low)).argmax(axis=0)
            out[lo:lo + step] = (at + self.width * ~up).T
        return out

    def codes(self, x: np.ndarray) -> np.ndarray:
        """(rows, tables) bucket numbers."""
        axes = self.axes(x)
        return (axes[:, 0::2] * (2 * self.width) + axes[:, 1::2]).astype(np.int32)

    def costs(self, x: np.ndarray) -> np.ndarray:
        """(rows, 2 * tables, 2 * width) cost of every signed axis."""
        y = np.ascontiguousarray(self.turn(x).transpose(2, 1, 0))
        y = np.concatenate([y, -y], axis=-1)
        return y.max(-1, keepdims=True) - y

    def probes(self, x: np.ndarray, most: float):
        """Per table (bucket numbers, query numbers) within the cost, by bucket."""
        found = [[] for _ in range(self.tables)]
        step = max(1, (1 << 21) // (2 * self.tables * 2 * self.width))
        for lo in range(0, len(x), step):
            c = self.costs(x[lo:lo + step])
            for t in range(self.tables):
                near = [np.nonzero(c[:, 2 * t + k] <= most) for k in range(2)]
                n = [np.bincount(near[k][0], minlength=len(c)) for k in range(2)]
                # every near axis of the first hash with every near axis of the second
                again = n[1][near[0][0]]
                q, a = np.repeat(near[0][0], again), np.repeat(near[0][1], again)
                start = (np.cumsum(n[1]) - n[1])[q]
                b = near[1][1][start + np.arange(len(q)) - np.repeat(np.cumsum(again) - again, again)]
                ok = c[q, 2 * t, a] + c[q, 2 * t + 1, b] <= most
                found[t].append((a[ok] * (2 * self.width) + b[ok], q[ok] + lo))
        out = []
        for parts in found:
            code, q = (np.concatenate(p) for p in zip(*parts)) if parts else (np.zeros(0, np.int64), np.zeros(0, np.int64))
            order = np.argsort(code, kind="stable")
            out.append((code[order].astype(np.int32), q[order].astype(np.int32)))
        return out


def scaled(x: np.ndarray) -> np.ndarray:
    """Rows times a power of two each (the largest entry comes near 1), so that
    no square overflows or vanishes; cosines stay the same."""
    top = np.abs(x).max(axis=1, initial=0.0)
    return np.ldexp(x, -np.frexp(top)[1][:, None])


def unit_rows(col, dims: int):
    """Scaled rows, their lengths, and which are usable (not zero, too)."""
    x, ok = matrix(col, dims)
    ok &= x.any(axis=1)
    x = scaled(x)
    size = np.sqrt(np.einsum("ij,ij->i", x, x))
    size[~ok] = 1.0
    return x, size, ok


def index_rows(src: DataFrame, dims: int, tables: int) -> DataFrame:
    """(id, vec, codes): every usable row with its bucket in every table."""
    def run(batches):
        hashes = Polytopes(dims, tables)
        for b in batches:
            x, size, ok = unit_rows(b.column(1), dims)
            at = np.flatnonzero(ok)
            codes = hashes.codes(x[at] / size[at][:, None])
            yield as_batch([b.column(0).take(pa.array(at)), b.column(1).take(pa.array(at)),
                            pa.array([c.tobytes() for c in codes], pa.binary())], ["id", "vec", "codes"])

    return src.select("id", "vec").mapInArrow(run, StructType([*src.select("id", "vec").schema.fields, StructField("codes", BinaryType())]))


def candidates(codes: np.ndarray, probes):
    """Distinct (rows, queries) that meet in a bucket of any table, in pieces."""
    lo, hi = (np.stack([np.searchsorted(bucket, codes[:, t], side=s) for t, (bucket, _) in enumerate(probes)], axis=1)
              for s in ("left", "right"))
    n = hi - lo
    made = np.cumsum(n.sum(axis=1))
    first = 0
    while first < len(codes):
        base = made[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(made, base + PAIRS, side="right")))
        rows, queries = [], []
        for t, (_, query) in enumerate(probes):
            m = n[first:last, t]
            rows.append(np.repeat(np.arange(first, last), m))
            queries.append(query[np.repeat(lo[first:last, t] - (np.cumsum(m) - m), m) + np.arange(m.sum())])
        pair = np.unique((np.concatenate(rows) << 32) | np.concatenate(queries))
        yield pair >> 32, pair & 0xFFFFFFFF
        first = last


def ranked(index: DataFrame, held, dims: int, k: int, tables: int, most: float | None) -> DataFrame:
    """(query, score, id): a task's best rows of each query of the block, among
    the candidates within the cost ``most`` or, where that is None, all rows."""
    def run(batches):
        ids, q, qsize = held.value
        hashes = Polytopes(dims, tables)
        heaps = Heaps(len(ids), k, -np.inf)
        probes = hashes.probes(q / qsize[:, None], most) if most is not None else None
        unit = q / qsize[:, None]

        def pairs(x, size, codes):
            if most is not None:
                yield from candidates(codes, probes)
                return
            step = max(1, PAIRS // max(1, len(ids)))
            for lo in range(0, len(x), step):
                # a plain product leaves out what is surely too far
                near = (x[lo:lo + step] / size[lo:lo + step][:, None]) @ unit.T >= heaps.worst[None, :] - 1e-9
                row, to = np.nonzero(near)
                yield row + lo, to

        for b in batches:
            x, size, _ = unit_rows(b.column(1), dims)
            own = b.column(0).to_numpy()
            codes = np.frombuffer(b"".join(b.column(2).to_pylist()), np.int32).reshape(-1, tables)
            for row, to in pairs(x, size, codes):
                other = ids[to] != own[row]
                row, to = row[other], to[other]
                for lo in range(0, len(row), RANKED):
                    r, t = row[lo:lo + RANKED], to[lo:lo + RANKED]
                    heaps.add(t, np.einsum("ij,ij->i", x[r], q[t]) / (size[r] * qsize[t]), own[r])
        cols = heaps.cut()
        if cols is not None:
            yield as_batch([cols[0].astype(np.int64), cols[1], cols[2]], HEAP.names)

    return index.select("id", "vec", "codes").mapInArrow(run, HEAP)


def fitted_threshold(index: DataFrame, queries: DataFrame, dims: int, k: int, tables: int, parts: int):
    """The probing threshold that finds FOUND of the true k nearest rows of at
    most SAMPLE queries (those with the least hash of their id), and the mean
    number of probes that it gives a query."""
    spark = index.sparkSession
    some = queries.orderBy(F.xxhash64("id"), "id").limit(SAMPLE).toArrow()
    x, size, _ = unit_rows(some.column("vec"), dims)
    held = spark.sparkContext.broadcast((some.column("id").to_numpy(), x, size))
    best = merge_heaps(ranked(index, held, dims, k, tables, None), "query", k, parts)
    near = stored(best.select("query", "id").distinct(), "sample-neighbours")  # at most SAMPLE * k rows
    true = near.join(index.select("id", "codes"), "id").select("query", "codes").toArrow()
    held.unpersist()
    if not true.num_rows:
        return 0.0, 1.0
    hashes = Polytopes(dims, tables)
    code = np.frombuffer(b"".join(true.column("codes").to_pylist()), np.int32).reshape(-1, tables)
    who = true.column("query").to_numpy()
    cost = np.full(len(who), np.inf)
    for q in np.unique(who):
        c = hashes.costs((x[q] / size[q])[None, :])[0]
        at = np.flatnonzero(who == q)
        a, b = code[at] // (2 * hashes.width), code[at] % (2 * hashes.width)
        t = np.arange(tables)
        cost[at] = (c[2 * t, a] + c[2 * t + 1, b]).min(axis=1)
    most = float(np.quantile(cost, FOUND, method="higher"))
    return most, sum(len(q) for _, q in hashes.probes(x / size[:, None], most)) / len(x)


def nearest_rows(rows: DataFrame, queries, id_col: str = "vec_id", vec_col: str = "embedding", k: int = 5,
                 tables: int = TABLES) -> DataFrame:
    """query_id, rank, vec_id, score: for each row that meets the condition
    ``queries``, its k nearest other rows by cosine among those the tables find.

    Rows with a null id or vector, a null or non-finite entry, or no entry but
    zeros take no part. Shorter vectors are padded with zeros. Cosines are
    computed in double precision on the vectors as given; ties go to the
    smaller id. A query's own rows are those with its id; repeated rows count
    each, a repeated query gives its rows again. A query with fewer than k
    candidates is compared with all rows. An empty table gives an empty result;
    other columns are not read."""
    spark = rows.sparkSession
    small_batches(spark, ROWS)
    src = (rows.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).alias("vec"), queries.alias("_query"))
           .where("id IS NOT NULL AND vec IS NOT NULL"))
    dims = max(1, longest(src, "vec"))
    index = stored(index_rows(src, dims, tables), "polytope-index")
    parts = index.rdd.getNumPartitions()
    asked = stored(index_rows(src.where("_query"), dims, tables), "queries")
    most, probes = fitted_threshold(index, asked, dims, k, tables, parts)
    path = scratch(spark, "nearest")

    def write(best, ids, kept):
        named = spark.sparkContext.broadcast((ids, kept))

        def name(batches):
            ids, kept = named.value
            for b in batches:
                query = b.column(0).to_numpy()
                at = pa.array(np.flatnonzero(kept[query]))
                yield as_batch([ids[query[kept[query]]], b.column(1).cast(pa.int32()).take(at), b.column(2).take(at),
                                b.column(3).take(at)], OUT.names)
        best.select("query", "rank", "id", "score").mapInArrow(name, OUT).write.mode("append").parquet(path)
        named.unpersist()

    n_rows, total = index.count(), asked.count()
    # a block's vectors and, inside the tasks, its probes stay within the bound
    blocks = max(1, -(-total // max(1, int(BLOCK_BYTES / (8 * dims + 8 * probes)))))
    asked = stored(asked.repartition(blocks).withColumn("block", F.spark_partition_id()), "query-blocks")
    for block in range(blocks):
        mine = asked.where(F.col("block") == block).select("id", "vec").orderBy("id").toArrow()
        if not mine.num_rows:
            continue
        x, size, _ = unit_rows(mine.column("vec"), dims)
        ids = mine.column("id").to_numpy()
        held = spark.sparkContext.broadcast((ids, x, size))
        best = stored(merge_heaps(ranked(index, held, dims, k, tables, most), "query", k, parts), "block-nearest")
        held.unpersist()
        got = best.groupBy("query").count().toArrow()  # one row for each query of the block
        n = np.zeros(len(ids), np.int64)
        n[got.column("query").to_numpy()] = got.column("count").to_numpy()
        enough = n >= min(k, n_rows - 1)
        write(best, ids, enough)
        short = np.flatnonzero(~enough)
        if len(short):  # too few candidates: all rows
            held = spark.sparkContext.broadcast((ids[short], x[short], size[short]))
            write(merge_heaps(ranked(index, held, dims, k, tables, None), "query", k, parts), ids[short], np.ones(len(short), bool))
            held.unpersist()
        drop_stored(best)
    spark.createDataFrame([], OUT).write.mode("append").parquet(path)
    return spark.read.schema(OUT).parquet(path)


@register("op12_nearest_vectors")
def op12_nearest_vectors(spark, sf_dir):
    return nearest_rows(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)
