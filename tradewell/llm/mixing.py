"""Mixing sources to target weights by subset-sum budget fitting.

Sources get a share of all words by weight. Whole passes over a source come
first; what is left of its budget is fitted exactly: documents are counted by
length, every length gives its proportional part, and a bounded-knapsack
program over the lengths fills the rest. Which documents of a length are taken
is decided by a seeded hash, through one global order of the rows, so that a
length shared by a third of all rows is not ranked in one task.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from tradewell.llm.common import register, small_batches, stored, table, word_count
from tradewell.llm.ordered import as_batch, order_rows

REPEATS = 3          # a source gives its words at most so often
HELD_LENGTHS = 500_000  # a plan up to this size (25 MB) is broadcast, a larger one joined by shuffle
WINDOW = 1 << 16     # words that the knapsack program fills at the end


def targets(sizes: dict, weights=(1, 2, 3)) -> dict:
    """Target words of each source. Sources in code point order, null last,
    have the weights in turn; a target stops at REPEATS times its source, and
    the excess is shared among the others by weight."""
    names = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total = sum(sizes.values())
    full: set = set()
    while True:
        open_ = [s for s in names if s not in full]
        rest = total - sum(REPEATS * sizes[s] for s in full)
        share = sum(weight[s] for s in open_)
        out = {s: float(REPEATS * sizes[s]) if s in full else rest * weight[s] / share for s in names}
        above = [s for s in open_ if out[s] > REPEATS * sizes[s]]
        if not above:
            return out
        full.update(above)


def fit_budget(lengths, counts, budget: int, seed: int):
    """How many documents of each length to take so that their words come to
    the budget, or as near below it as the program gets. Lengths are distinct,
    above 0; together they hold at least the budget."""
    lengths, counts = np.asarray(lengths, np.int64), np.asarray(counts, np.int64)
    whole = int((lengths * counts).sum())
    take = np.array([int(c) * budget // whole for c in counts], np.int64) if whole else np.zeros(len(counts), np.int64)
    left = budget - int((take * lengths).sum())
    order = np.random.default_rng(seed).permutation(len(lengths))
    moved = True
    while moved and left > WINDOW:  # one more of each length, in seeded order
        moved = False
        for i in order:
            if take[i] < counts[i] and lengths[i] <= left - WINDOW // 2:
                take[i] += 1
                left -= int(lengths[i])
                moved = True
    if left > 16 * WINDOW:  # open documents are longer than left - WINDOW // 2: one at most fits, the longest is best
        fits = np.flatnonzero((take < counts) & (lengths <= left))
        if len(fits):
            i = fits[np.argmax(lengths[fits])]
            take[i] += 1
            left -= int(lengths[i])
    room = min(left, 16 * WINDOW)
    mask = (1 << (room + 1)) - 1
    reach, steps = 1, []  # bit w: w words can be made of the parts so far
    for i in order:
        n, part = int(min(counts[i] - take[i], room // lengths[i] if lengths[i] else 0)), 1
        while n > 0 and not reach >> room & 1:
            k = min(part, n)  # parts of 1, 2, 4 .. documents make up any number
            more = reach | (reach << int(k * lengths[i])) & mask
            if more != reach:
                steps.append((i, k, reach))
                reach = more
            n, part = n - k, part * 2
    at = reach.bit_length() - 1
    for i, k, before in reversed(steps):
        if not before >> at & 1:
            take[i] += k
            at -= int(k * lengths[i])
    return take


def _keyed(docs: DataFrame, id_col: str, text_col: str, source_col: str, seed: int) -> DataFrame:
    """The columns of docs and _source, _size, _key (one per source and length) and _draw."""
    key = F.concat(F.when(F.col("_source").isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), F.col("_source"))),
                   F.lit("\x00"), F.col("_size").cast("string"))
    draw = F.xxhash64(F.lit(seed), F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    return (docs.withColumns({"_source": F.col(source_col).cast("string"), "_size": word_count(F.col(text_col))})
            .withColumns({"_key": key, "_draw": draw}))


def mix_sources(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                weights=(1, 2, 3), seed: int = 17) -> DataFrame:
    """One row per input row: id, size (words), source_size, target, taken
    (words, repeats counted), copies (how often the mix has the document).

    Null and empty texts have size 0 and follow the passes of their source; a
    source without words has target 0 and gives nothing. Null is a source, the
    last one. Null ids and repeated rows are rows like others; equal rows are
    interchangeable. An empty table gives an empty result; other columns are
    not read. The driver holds one number per source; one task holds the
    lengths of one source (as many as there are different lengths)."""
    id_type = docs.select(id_col).schema[0].dataType
    rows, plan = _planned(docs, id_col, text_col, source_col, weights, seed)
    out = rows.join(plan, "key")
    copies = F.col("passes") + (F.col("row") - F.col("first") < F.col("take")).cast("long")
    return out.select(F.col("id").cast(id_type).alias(id_col), "size", "source_size", "target",
                      (F.col("size") * copies).alias("taken"), copies.cast("int").alias("copies"))


def repeat_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                     weights=(1, 2, 3), seed: int = 17) -> DataFrame:
    """The mix itself: every row as often as ``mix_sources`` takes it (ids must
    differ), rows with a null id once. What is taken of one length are the rows
    up to a last (draw, id), so a row is decided by the row of the plan for its
    source and length, and texts go through no shuffle while that plan, one row
    per source and length, is small enough to be held (else Spark joins it)."""
    spark = docs.sparkSession
    rows, plan = _planned(docs, id_col, text_col, source_col, weights, seed)
    last = rows.join(plan.where("take > 0").select("key", (F.col("first") + F.col("take") - 1).alias("row")), ["key", "row"])
    last = last.select("key", F.col("draw").alias("_last_draw"), F.col("id").alias("_last_id"))
    plan = stored(plan.select("key", "passes").join(last, "key", "left").withColumnRenamed("key", "_key"), "mix-thresholds")
    if plan.count() <= HELD_LENGTHS:  # about 50 bytes each
        plan = F.broadcast(plan)
    taken = (F.col("_draw") < F.col("_last_draw")) | ((F.col("_draw") == F.col("_last_draw")) & (F.col(id_col) <= F.col("_last_id")))
    copies = F.when(F.col(id_col).isNull(), F.lit(1)).otherwise(F.col("passes") + F.coalesce(taken, F.lit(False)).cast("long"))
    often = _keyed(docs, id_col, text_col, source_col, seed).join(plan, "_key")
    return often.select(*[docs[c] for c in docs.columns], F.explode(F.array_repeat(F.lit(0), copies.cast("int"))).alias("_")).drop("_")


def _planned(docs, id_col, text_col, source_col, weights, seed) -> tuple[DataFrame, DataFrame]:
    """rows (id, source, size, key, draw, row, opens: numbered in one order of
    key, draw and id) and the plan (key, take, first, source_size, target,
    passes: how many rows of a source and length to take beyond the passes)."""
    spark = docs.sparkSession
    small_batches(spark, 5000)
    key = F.concat(F.when(F.col("source").isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), F.col("source"))),
                   F.lit("\x00"), F.col("size").cast("string"))
    lean = stored(_keyed(docs, id_col, text_col, source_col, seed).select(
        F.col(id_col).alias("id"), F.col("_source").alias("source"), F.col("_size").alias("size"), F.col("_key").alias("key"),
        F.col("_draw").alias("draw")), "mix-rows")
    o = order_rows(lean, "key", ["draw", "id"], "size")
    sizes = {r.source: int(r.s) for r in lean.groupBy("source").agg(F.sum("size").alias("s")).collect()}
    goal = targets(sizes, weights)
    passes = {s: int(goal[s]) // sizes[s] if sizes[s] else 0 for s in sizes}

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        s = pdf["source"].iloc[0]
        s = None if pd.isna(s) else s
        pdf = pdf.sort_values("size").reset_index(drop=True)
        budget = int(goal[s]) - passes[s] * sizes[s]
        some = pdf["size"] > 0
        take = np.zeros(len(pdf), np.int64)
        if budget > 0:
            take[~some] = pdf["n"][~some] * budget // sizes[s]
            take[some] = fit_budget(pdf["size"][some], pdf["n"][some], budget, seed)
        return pdf.assign(take=take)[["source", "size", "take"]]

    hist = lean.groupBy("source", "size").agg(F.count("*").alias("n"))
    plan = hist.groupBy("source").applyInPandas(fit, StructType(
        [StructField("source", StringType()), StructField("size", LongType()), StructField("take", LongType())]))
    plan = plan.withColumn("key", key).select("key", "take")
    row_off, opens_part = o.row_off, o.opens_part

    def numbered(batches):
        for b in batches:
            part, pos, opens = (b.column(i).to_numpy(zero_copy_only=False) for i in (4, 5, 6))
            opens = opens & ((pos > 0) | opens_part[part])
            yield as_batch([*b.columns[:4], b.column(7), row_off[part] + pos, opens], [*names, "row", "opens"])

    names = ["id", "source", "size", "key", "draw"]
    rows = o.rows.select("id", "source", "size", "key", "part", "pos", "opens", "draw").mapInArrow(
        numbered, StructType([*[o.rows.schema[c] for c in names], StructField("row", LongType()), o.rows.schema["opens"]]))
    rows = stored(rows, "mix-numbered")
    first = rows.where("opens").select("key", "source", F.col("row").alias("first"))
    per_source = spark.createDataFrame(
        [(s, sizes[s], float(goal[s]), passes[s]) for s in sizes],
        "osource string, source_size long, target double, passes long")  # one row per source
    plan = (plan.join(first, "key").join(per_source, F.col("source").eqNullSafe(F.col("osource")))
            .select("key", "take", "first", "source_size", "target", "passes"))
    return rows, stored(plan, "mix-plan")  # one row per source and length


@register("op4_mixing")
def op4_mixing(spark, sf_dir):
    return mix_sources(table(spark, sf_dir, "documents"))
