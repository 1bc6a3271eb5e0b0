"""Sharding by minimax contiguous partition.

Groups that must stay together (equal texts) are ordered by their key; a shard
is a contiguous run of groups. The smallest capacity for which the groups fit
into the shards is found by binary search, each probe checked greedily, and
the cuts are made there. The driver never sees the groups: it holds cells of
the ordered positions (a bounded number, each with the first and last group
start in it). A greedy probe over cells gives a surely feasible and a surely
infeasible capacity; only the cells that the probes between the two can touch
are split further, until one capacity is left and every cut is exact.
"""

from __future__ import annotations

from bisect import bisect_left

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from tradewell.llm.common import register, stored, table
from tradewell.llm.ordered import LONGS, Ordered, as_batch, key_starts, order_rows

CELLS = 16_384  # cells asked for in one pass


def refine(o: Ordered, size: str, cells: list[tuple[int, int, int, int]], split: int):
    """Split every given cell (first, last start; their row numbers) into up to
    ``split`` cells of equal width. One pass over the ordered rows."""
    lo = np.array([c[0] for c in cells], np.int64)
    hi = np.array([c[1] for c in cells], np.int64)
    width = np.maximum(1, -(-(hi - lo + 1) // split))

    def fold(items):
        for x, row in items:
            c = np.searchsorted(lo, x, side="right") - 1
            ok = (c >= 0) & (x <= hi[c])
            x, row, c = x[ok], row[ok], c[ok]
            if not len(x):
                continue
            cell = c * split + (x - lo[c]) // width[c]
            first = np.flatnonzero(np.r_[True, cell[1:] != cell[:-1]])  # a task may read several parts, in any order
            low, high = np.minimum.reduceat, np.maximum.reduceat
            yield as_batch([cell[first], low(x, first), high(x, first), low(row, first), high(row, first)],
                           ["cell", "a", "z", "ra", "rz"])

    found = (key_starts(o, size, fold, LONGS("cell", "a", "z", "ra", "rz")).groupBy("cell")
             .agg(F.min("a").alias("a"), F.max("z").alias("z"), F.min("ra").alias("ra"), F.max("rz").alias("rz")))
    return sorted((r.a, r.z, r.ra, r.rz) for r in found.collect())


def greedy(ends: list[int], cells, total: int, n: int, cap: int, low: bool) -> list[int]:
    """Cut positions from the right, each shard as full as ``cap`` allows.
    A start inside a cell is known only by bounds: ``low`` takes the lower."""
    cuts, at = [], total
    for _ in range(n):
        want = max(0, at - cap)
        i = bisect_left(ends, want)
        if i == len(ends):
            nxt = total
        else:
            a, z = cells[i][0], cells[i][1]
            nxt = a if a >= want else (want if low else z)
        cuts.append(nxt)
        at = nxt
    return cuts


def smallest_capacity(o: Ordered, size: str, n: int):
    """(capacity, lowest cut positions, cells): exact."""
    cells = refine(o, size, [(0, o.total, 0, 0)], CELLS)
    while True:
        ends = [c[1] for c in cells]

        def least(low: bool) -> int:
            bad, good = 0, o.total
            while good - bad > 1:
                mid = (good + bad) // 2
                if greedy(ends, cells, o.total, n, mid, low)[-1] == 0:
                    good = mid
                else:
                    bad = mid
            return good

        first, last = least(True), least(False)  # the capacity lies between
        a, z = greedy(ends, cells, o.total, n, last, True), greedy(ends, cells, o.total, n, first, False)
        exact = greedy(ends, cells, o.total, n, first, False)
        if first == last and exact == greedy(ends, cells, o.total, n, first, True):
            return first, exact, cells
        touched = set()
        for x, y in zip(a, z):
            i = bisect_left(ends, min(x, y))
            while i < len(cells) and cells[i][0] <= max(x, y):
                if cells[i][0] < cells[i][1]:
                    touched.add(i)
                i += 1
        part = [cells[i] for i in sorted(touched)]
        finer = refine(o, size, part, max(2, CELLS // len(part)))
        cells = sorted([c for i, c in enumerate(cells) if i not in touched] + finer)


def cut(o: Ordered, size: str, n: int) -> tuple[int, list[int], list[int]]:
    """Capacity, start position and first row of every shard. Shards never
    exceed the smallest capacity; within it each cut goes to the known group
    start nearest to an even share of what is left, so that a huge group does
    not leave shards empty."""
    cap, back, cells = smallest_capacity(o, size, n)
    lowest = back[::-1]  # lowest[k]: the first place where shard k may start
    known = sorted({(c[0], c[2]) for c in cells} | {(c[1], c[3]) for c in cells} | {(o.total, o.n_rows)})
    at = [x for x, _ in known]
    starts, rows = [0], [0]
    for k in range(1, n):
        here = starts[-1]
        i, j = bisect_left(at, lowest[k]), bisect_left(at, here + cap + 1) - 1
        i = max(i, min(j, bisect_left(at, here + 1)))  # a group in every shard, as long as there are any
        want = here + (o.total - here) / (n - k + 1)
        m = bisect_left(at, want)
        m = min(max(m - 1 if m and (m == len(at) or want - at[m - 1] <= at[m] - want) else m, i), j)
        starts.append(at[m])
        rows.append(known[m][1])
    return cap, starts, rows


def shard_contiguous(docs: DataFrame, n_shards: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, size (UTF-8 bytes + 16), text_crc32, law
    ('bytes'), shard (0 .. n_shards-1), slot (gapless from 0 in the shard),
    grown_shard (null).

    Equal texts stay in one shard; null texts form one group (size 16, crc null),
    empty texts another. Rows with equal text and id are interchangeable. An
    empty table gives an empty result; other columns are not read. The order of
    groups is the order of the MD5 of their texts, then the id: contiguous and
    independent of the input's layout."""
    out = StructType([docs.select(id_col).schema[0], StructField("size", LongType()),
                      StructField("text_crc32", LongType()), StructField("law", StringType()),
                      StructField("shard", IntegerType()), StructField("slot", LongType()),
                      StructField("grown_shard", IntegerType())])
    raw = F.col(text_col).cast("binary")
    lean = stored(docs.select(
        F.col(id_col).alias("id"), (F.coalesce(F.octet_length(raw), F.lit(0)) + 16).cast("long").alias("size"),
        F.crc32(raw).alias("crc"), F.coalesce(F.md5(raw), F.lit("")).alias("key")), "shard-rows")
    o = order_rows(lean, "key", ["id"], "size")
    if not o.n_rows:
        return docs.sparkSession.createDataFrame([], out)
    cap, starts, first_row = cut(o, "size", n_shards)
    starts, first_row = np.array(starts), np.array(first_row)
    row_off, size_off = o.row_off, o.size_off
    names = out.names

    def assign(batches):
        for b in batches:
            size, part, pos, cum = (b.column(i).to_numpy(zero_copy_only=False) for i in (1, 3, 4, 5))
            shard = np.searchsorted(starts, size_off[part] + cum - size, side="right") - 1
            yield as_batch([b.column(0), b.column(1), b.column(2), pa.array(["bytes"] * b.num_rows, pa.string()),
                            pa.array(shard, pa.int32()), row_off[part] + pos - first_row[shard],
                            pa.nulls(b.num_rows, pa.int32())], names)

    return o.rows.select("id", "size", "crc", "part", "pos", "cum").mapInArrow(assign, out)


@register("op1_sharding")
def op1_sharding(spark, sf_dir):
    return shard_contiguous(table(spark, sf_dir, "documents"), 40)
