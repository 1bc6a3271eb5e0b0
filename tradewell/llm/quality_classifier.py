"""Quality classifier: random-indexing word vectors, pooled, and a small net.

Every unit of a text (a run of letters and digits, or a run of signs) has a
sparse random index vector given by its hash. A unit's word vector is the sum
of the index vectors of its neighbours over the whole corpus, gathered in a
table with a fixed number of rows (units share a row by hash). A text is the
mean of the scaled word vectors of its units; a two-layer network scores it,
with its logits divided by a temperature fitted on rows kept from training.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (BinaryType, BooleanType, DoubleType, IntegerType, StructField, StructType)

from tradewell.llm.common import id_bucket, register, small_batches, stored, table
from tradewell.llm.kernels import Hasher, byte_classes, owner, text_chunks, word_spans
from tradewell.llm.ordered import as_batch

ROWS, DIMS, BLOCK, REACH = 1 << 14, 32, 64, 2


def units(data, off, hasher, classes):
    starts, ends, counts = word_spans(data, off, classes, split_signs=True)
    return hasher.spans(data, starts, ends), counts


def add_contexts(table_: np.ndarray, h: np.ndarray, doc: np.ndarray) -> None:
    """Add to the row of each unit the index vectors (two places of +1 or -1)
    of the units up to REACH before and behind it in the same text."""
    row = (h >> np.uint64(50)).astype(np.int64)
    places = [((h >> np.uint64(s)) % np.uint64(DIMS)).astype(np.int64) for s in (5, 20)]
    signs = [((h >> np.uint64(s)) & np.uint64(1)).astype(np.float32) * 2 - 1 for s in (40, 41)]
    at, val = [], []
    for k in range(1, REACH + 1):
        if len(h) <= k:
            break
        same = doc[k:] == doc[:-k]
        for p, s in zip(places, signs):
            at += [(row[k:] * DIMS + p[:-k])[same], (row[:-k] * DIMS + p[k:])[same]]
            val += [s[:-k][same], s[k:][same]]
    if at:
        table_ += np.bincount(np.concatenate(at), weights=np.concatenate(val), minlength=ROWS * DIMS)


def word_vectors(texts: DataFrame) -> np.ndarray:
    """(ROWS, DIMS): the scaled context sums over all texts. Every task sends
    the blocks of its table; the blocks are added up by key. The result has a
    fixed size (2 MB), whatever the corpus."""
    def gather(batches):
        hasher, classes = Hasher(), byte_classes()
        sums = np.zeros(ROWS * DIMS)
        for b in batches:
            for _, _, data, off in text_chunks(b.column(0)):
                h, counts = units(data, off, hasher, classes)
                add_contexts(sums, h, owner(counts))
        blocks = sums.astype(np.float32).reshape(-1, BLOCK * DIMS)
        used = np.flatnonzero(blocks.any(1))
        yield as_batch([pa.array(used, pa.int32()), pa.array([blocks[i].tobytes() for i in used], pa.binary())],
                       ["block", "sums"])

    def add(rows: pa.Table) -> pa.Table:
        total = np.zeros(BLOCK * DIMS)
        for x in rows.column("sums"):  # whole numbers: the order of addition does not matter
            total += np.frombuffer(x.as_py(), np.float32)
        return pa.table({"block": rows.column("block").slice(0, 1),
                         "sums": pa.array([total.astype(np.float32).tobytes()], pa.binary())})

    kind = StructType([StructField("block", IntegerType()), StructField("sums", BinaryType())])
    out = np.zeros((ROWS, DIMS), np.float32)
    for r in texts.mapInArrow(gather, kind).groupBy("block").applyInArrow(add, kind).collect():
        out[r.block * BLOCK:(r.block + 1) * BLOCK] = np.frombuffer(r.sums, np.float32).reshape(BLOCK, DIMS)
    return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-9)


def pool(data, off, vectors, hasher, classes) -> np.ndarray:
    """Mean word vector of each text and that vector's length (zeros without units)."""
    h, counts = units(data, off, hasher, classes)
    out = np.zeros((len(counts), DIMS + 1), np.float32)
    some = counts > 0
    if len(h):
        rows = vectors[(h >> np.uint64(50)).astype(np.int64)]
        first = np.r_[0, np.cumsum(counts)[:-1]][some]
        out[some, :DIMS] = np.add.reduceat(rows, first, axis=0) / counts[some, None]
        out[:, DIMS] = np.linalg.norm(out[:, :DIMS], axis=1)
    return out


def fit_network(x: np.ndarray, y: np.ndarray, hidden: int = 24, steps: int = 600, seed: int = 5) -> dict:
    """Two-layer network and temperature. Every fifth row only calibrates."""
    rnd = np.random.default_rng(seed)
    mean, scale = x.mean(0), x.std(0) + 1e-3
    z = np.clip((x - mean) / scale, -8, 8)
    cal = np.arange(len(x)) % 5 == 4
    p = [rnd.normal(0, 1 / np.sqrt(x.shape[1]), (x.shape[1], hidden)), np.zeros(hidden),
         rnd.normal(0, 1 / np.sqrt(hidden), hidden), np.zeros(1)]
    m, v = [np.zeros_like(a) for a in p], [np.zeros_like(a) for a in p]
    zt, yt = z[~cal], y[~cal]
    for t in range(1, steps + 1):
        a = np.tanh(zt @ p[0] + p[1])
        q = 1 / (1 + np.exp(-np.clip(a @ p[2] + p[3], -30, 30)))
        d = (q - yt) / max(1, len(yt))
        da = np.outer(d, p[2]) * (1 - a * a)
        grads = [zt.T @ da + 1e-4 * p[0], da.sum(0), a.T @ d + 1e-4 * p[2], d.sum(keepdims=True)]
        for i, g in enumerate(grads):
            m[i], v[i] = 0.9 * m[i] + 0.1 * g, 0.999 * v[i] + 0.001 * g * g
            p[i] = p[i] - 0.02 * (m[i] / (1 - 0.9 ** t)) / (np.sqrt(v[i] / (1 - 0.999 ** t)) + 1e-8)
    net = {"mean": mean, "scale": scale, "p": p, "temperature": 1.0}
    if cal.any():
        s, yc = logits(x[cal], net), y[cal]
        grid = np.geomspace(0.25, 8, 60)
        loss = [np.logaddexp(0, np.where(yc == 1, -s, s) / t).mean() for t in grid]
        net["temperature"] = float(grid[int(np.argmin(loss))])
    return net


def logits(x: np.ndarray, net: dict) -> np.ndarray:
    p = net["p"]
    return (np.tanh(np.clip((x - net["mean"]) / net["scale"], -8, 8) @ p[0] + p[1]) @ p[2] + p[3]) / net["temperature"]


def score_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  label_col: str = "quality", sample: int = 6000) -> DataFrame:
    """One row per input row: id, held_out, score (0 to 1), predicted (0 / 1).

    Labels are learned from ids whose crc32(id as text) mod 3 is not 1, about
    ``sample`` of them (the bound of the training sample; all if there are
    fewer), chosen by a hash of the id; word vectors are gathered from every
    text. Only the text enters a score. Null and empty texts are scored as
    texts without units; null labels are left out; with labels of one class, or
    none, every text scores 0.5 and is kept. Repeated rows stay; an empty table
    gives an empty result; other columns are not read."""
    spark = docs.sparkSession
    small_batches(spark)
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    marks = (labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("y"))
             .where(F.col("y").isNotNull() & F.col("id").isNotNull() & (id_bucket(F.col("id"), 3) != 1)).distinct())
    n = marks.count()
    chosen = stored(marks.where(F.pmod(F.xxhash64("id", F.lit(7)), F.lit(1 << 30)) < -(-(sample << 30) // max(1, n))),
                    "quality-labels")
    vectors = word_vectors(src.select("text"))
    sent = spark.sparkContext.broadcast(vectors)

    def profile(batches):
        hasher, classes = Hasher(), byte_classes()
        for b in batches:
            for lo, hi, data, off in text_chunks(b.column(2)):
                x = pool(data, off, sent.value, hasher, classes)
                yield as_batch([b.column(0)[lo:hi], b.column(1)[lo:hi], pa.array([r.tobytes() for r in x], pa.binary())],
                               ["id", "y", "x"])

    rows = (src.join(chosen, "id").select(F.col("id").cast("string").alias("id"), "y", "text")
            .mapInArrow(profile, "id string, y int, x binary").collect())
    rows.sort(key=lambda r: (r.id, r.y, bytes(r.x)))
    y = np.array([1.0 if r.y == 1 else 0.0 for r in rows])
    net = None
    if 0 < y.sum() < len(y):
        net = fit_network(np.array([np.frombuffer(r.x, np.float32) for r in rows]), y)
    net_sent = spark.sparkContext.broadcast(net)

    def run(batches):
        hasher, classes, known = Hasher(), byte_classes(), net_sent.value
        for b in batches:
            for lo, hi, data, off in text_chunks(b.column(2)):
                p = np.full(hi - lo, 0.5)
                if known is not None:
                    p = 1 / (1 + np.exp(-np.clip(logits(pool(data, off, sent.value, hasher, classes), known), -30, 30)))
                yield as_batch([b.column(0)[lo:hi], b.column(1)[lo:hi], p, pa.array(p >= 0.5).cast(pa.int32())],
                               [id_col, "held_out", "score", "predicted"])

    lean = src.select("id", (id_bucket(F.col("id"), 3) == 1).alias("held_out"), "text")
    return lean.mapInArrow(run, StructType([
        StructField(id_col, lean.schema[0].dataType), StructField("held_out", BooleanType()),
        StructField("score", DoubleType()), StructField("predicted", IntegerType())]))


@register("op6_quality_classifier")
def op6_quality_classifier(spark, sf_dir):
    return score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
