"""Hard-negative mining: products of anchor and candidate tiles by Strassen's
recursion on 64-bit integers, then heaps of positives and of negatives in a
window below each positive.

Anchors are a stated share of the rows; each block of anchors (bounded in
bytes) is broadcast and meets all rows in two scans. The first multiplies an
anchor tile only with the candidates of the same label and keeps the best
positives; the second multiplies it with every candidate and keeps, per anchor
and positive, the best rows of another label inside the window. A task sends
nothing but its heaps.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from tradewell.llm.common import drop_stored, register, scratch, small_batches, stored, table
from tradewell.llm.ordered import LONGS, as_batch
from tradewell.llm.vectors import ROWS, Heaps, longest, matrix, merge_heaps

LEAF = 16                # a tile with a side up to this is multiplied directly
TILE = 1024              # anchors and candidates of one tile
BLOCK_BYTES = 8 << 20    # anchors that are broadcast at once
MOST = 2.0 ** 56         # squared length of an integer vector: 90 times a score fits in 64 bits

OUT = StructType([StructField("anchor_id", LongType()), StructField("positive_id", LongType()),
                  StructField("rank", IntegerType()), StructField("negative_id", LongType()),
                  StructField("positive_score", LongType()), StructField("negative_score", LongType())])


def strassen(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a @ b of int64 matrices with seven products of halves; odd sides get a
    zero row or column. Sums wrap modulo 2**64, so every entry that fits in 64
    bits is exact."""
    m, k, n = a.shape[0], a.shape[1], b.shape[1]
    if min(m, k, n) <= LEAF:
        return a @ b
    if m % 2 or k % 2:
        a = np.pad(a, ((0, m % 2), (0, k % 2)))
    if k % 2 or n % 2:
        b = np.pad(b, ((0, k % 2), (0, n % 2)))
    h, j, w = a.shape[0] // 2, a.shape[1] // 2, b.shape[1] // 2
    a11, a12, a21, a22 = a[:h, :j], a[:h, j:], a[h:, :j], a[h:, j:]
    b11, b12, b21, b22 = b[:j, :w], b[:j, w:], b[j:, :w], b[j:, w:]
    p1 = strassen(a11 + a22, b11 + b22)
    p2 = strassen(a21 + a22, b11)
    p3 = strassen(a11, b12 - b22)
    p4 = strassen(a22, b21 - b11)
    p5 = strassen(a11 + a12, b22)
    p6 = strassen(a21 - a11, b11 + b12)
    p7 = strassen(a12 - a22, b21 + b22)
    out = np.empty((2 * h, 2 * w), np.int64)
    out[:h, :w] = p1 + p4 - p5 + p7
    out[:h, w:] = p3 + p5
    out[h:, :w] = p2 + p4
    out[h:, w:] = p1 - p2 + p3 + p6
    return out[:m, :n]


def integer_rows(col, dims: int, scale: float) -> tuple[np.ndarray, np.ndarray]:
    """floor(scale * x) as int64 rows and which rows take part."""
    x, ok = matrix(col, dims)
    with np.errstate(over="ignore"):  # an infinite product is out of range, too
        x = np.floor(scale * x)
        ok &= np.einsum("ij,ij->i", x, x) < MOST
    x[~ok] = 0
    return x.astype(np.int64), ok


def _tiles(n: int):
    return [slice(i, min(i + TILE, n)) for i in range(0, n, TILE)]


def _positives(rows: DataFrame, held, dims: int, scale: float, size: int) -> DataFrame:
    """(anchor, score, id): a task's best rows of the anchor's label."""
    def run(batches):
        anchors = held.value
        by_label = {int(v): np.flatnonzero(anchors["label"] == v) for v in np.unique(anchors["label"])}
        heaps = Heaps(len(anchors["id"]), size, np.iinfo(np.int64).min)
        for b in batches:
            x, ok = integer_rows(b.column(2), dims, scale)
            ids, labels = (b.column(i).to_numpy(zero_copy_only=False) for i in range(2))
            for v in np.unique(labels[ok]):
                at = np.flatnonzero(ok & (labels == v))
                mine = by_label.get(int(v), np.zeros(0, np.int64))
                for tile in _tiles(len(mine)):
                    who = mine[tile]
                    s = strassen(anchors["x"][who], np.ascontiguousarray(x[at].T))
                    i, j = np.nonzero((s >= heaps.worst[who][:, None]) & (anchors["id"][who][:, None] != ids[at][None, :]))
                    heaps.add(who[i], s[i, j], ids[at[j]])
        cols = heaps.cut()
        if cols is not None:
            yield as_batch(cols, ["anchor", "score", "id"])

    return rows.mapInArrow(run, LONGS("anchor", "score", "id"))


def _negatives(rows: DataFrame, held, dims: int, scale: float, size: int) -> DataFrame:
    """(pair, score, id): a task's best rows of another label in the window of
    each anchor and positive."""
    def run(batches):
        anchors, low, high = held.value["anchors"], held.value["low"], held.value["high"]
        n, slots = low.shape  # an empty window where there is no positive
        heaps = Heaps(n * slots, size, np.iinfo(np.int64).min)
        for b in batches:
            x, ok = integer_rows(b.column(2), dims, scale)
            ids, labels = (b.column(i).to_numpy(zero_copy_only=False)[ok] for i in range(2))
            x = np.ascontiguousarray(x[ok].T)
            if not len(ids):
                continue
            for who in _tiles(n):
                for of in _tiles(len(ids)):
                    s = strassen(anchors["x"][who], np.ascontiguousarray(x[:, of]))
                    other = anchors["label"][who][:, None] != labels[of][None, :]
                    for k in range(slots):
                        pair = np.arange(who.start, who.stop) * slots + k
                        floor = np.maximum(low[who, k], heaps.worst[pair])
                        i, j = np.nonzero((s >= floor[:, None]) & (s <= high[who, k][:, None]) & other)
                        heaps.add(pair[i], s[i, j], ids[of][j])
        cols = heaps.cut()
        if cols is not None:
            yield as_batch(cols, ["pair", "score", "id"])

    return rows.mapInArrow(run, LONGS("pair", "score", "id"))


def mine_hard_negatives(rows: DataFrame, anchors, id_col: str = "vec_id", label_col: str = "label",
                        vec_col: str = "embedding", positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90,
                        scale: float = 256.0) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``anchors`` is a condition on the rows. Components become floor(scale * x);
    a score is the integer inner product, ties go to the smaller id. An anchor's
    positives are its first ``positives`` rows with another id and its label;
    for each, the first ``negatives`` rows of another label with low *
    positive_score <= 100 * negative_score <= high * positive_score.

    Rows with a null id, label or vector, or with a null or non-finite
    component, take no part, nor do vectors whose integer form has a squared
    length of 2**56 or more (their scores need not fit in 64 bits). Shorter
    vectors are padded with zeros (an empty one scores 0). Repeated rows count
    each; a repeated anchor gives its rows again. An empty table gives an empty
    result; other columns are not read."""
    spark = rows.sparkSession
    small_batches(spark, ROWS)
    src = (rows.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"),
                       F.col(vec_col).alias("vec"), anchors.alias("_anchor"))
           .where("id IS NOT NULL AND label IS NOT NULL AND vec IS NOT NULL"))
    dims = max(1, longest(src, "vec"))
    chosen = src.where("_anchor").drop("_anchor")
    src = src.drop("_anchor")
    per_block = max(1, BLOCK_BYTES // (8 * dims))
    blocks = max(1, -(-chosen.count() // per_block))
    # dealt out in turn, so that blocks are even whatever the ids
    kept = stored(chosen.repartition(blocks).withColumn("block", F.spark_partition_id()), "anchors")
    parts = src.rdd.getNumPartitions()
    path = scratch(spark, "hard-negatives")
    for block in range(blocks):
        mine = kept.where(F.col("block") == block).drop("block").toArrow()
        x, ok = integer_rows(mine.column("vec"), dims, scale)
        order = np.flatnonzero(ok)[np.argsort(mine.column("id").to_numpy()[ok], kind="stable")]
        held = {"id": mine.column("id").to_numpy()[order], "label": mine.column("label").to_numpy()[order], "x": x[order]}
        if not len(order):
            continue
        first = spark.sparkContext.broadcast(held)
        found = merge_heaps(_positives(src, first, dims, scale, positives), "anchor", positives, parts)
        found = [c.to_numpy() for c in found.select("anchor", "rank", "score", "id").toArrow().columns]
        first.unpersist()
        # integer bounds of each window; an empty one where there is no positive
        lo, hi = np.full((len(order), positives), 1, np.int64), np.zeros((len(order), positives), np.int64)
        score, who = np.zeros_like(lo), np.zeros_like(lo)
        at = found[0], found[1] - 1
        score[at], who[at] = found[2], found[3]
        lo[at], hi[at] = -(-low * found[2] // 100), high * found[2] // 100
        held = {"anchors": held, "low": lo, "high": hi}
        second = spark.sparkContext.broadcast(held)
        best = merge_heaps(_negatives(src, second, dims, scale, negatives), "pair", negatives, parts)
        names = spark.sparkContext.broadcast((held["anchors"]["id"], who.ravel(), score.ravel()))

        def name(batches, names=names, slots=positives):
            ids, pos, scores = names.value
            for b in batches:
                pair, neg, to, rank = (b.column(i).to_numpy() for i in range(4))
                yield as_batch([ids[pair // slots], pos[pair], rank.astype(np.int32), to, scores[pair], neg], OUT.names)

        best.select("pair", "score", "id", "rank").mapInArrow(name, OUT).write.mode("append").parquet(path)
        second.unpersist()
        names.unpersist()
    drop_stored(kept)
    # no usable anchor at all: nothing was written
    spark.createDataFrame([], OUT).write.mode("append").parquet(path)
    return spark.read.schema(OUT).parquet(path)


def shifted_label(id_col: str = "vec_id", label_col: str = "label"):
    """Label of a row in the query: one further, modulo 10, where 7 divides the id."""
    return F.when(F.col(id_col) % 7 == 0, (F.col(label_col).cast("long") + 1) % 10).otherwise(F.col(label_col))


SQL = """
WITH e AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, embedding
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND vec_id IS NOT NULL
    AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
x AS (SELECT vec_id, label, d, CAST(floor(256 * CAST(embedding[d] AS DOUBLE)) AS BIGINT) AS v
      FROM (SELECT vec_id, label, embedding, unnest(range(1, len(embedding) + 1)) AS d FROM e)),
s AS (SELECT a.vec_id AS anchor_id, a.label AS al, c.vec_id, c.label, CAST(sum(a.v * c.v) AS BIGINT) AS score
      FROM x a JOIN x c ON a.d = c.d AND a.vec_id <> c.vec_id
      WHERE a.vec_id % 100 = 0 GROUP BY ALL),
p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE label = al
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, p.positive_id,
       CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id) AS INTEGER) AS rank,
       s.vec_id AS negative_id, p.positive_score, s.score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND s.label <> s.al
  AND 30 * p.positive_score <= 100 * s.score AND 100 * s.score <= 90 * p.positive_score
QUALIFY row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id) <= 10
"""


@register("op11_hard_negatives", SQL)
def op11_hard_negatives(spark, sf_dir):
    rows = table(spark, sf_dir, "embeddings").withColumn("label", shifted_label())
    return mine_hard_negatives(rows, F.col("vec_id") % 100 == 0)
