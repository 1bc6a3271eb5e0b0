"""N-gram Jaccard join: all links between texts whose sets of five-word
shingles have a Jaccard similarity of 0.8 or more, as components.

Equal sets are one node. Shingles are put in one order, rarest first (counts
over the whole corpus in a hashed table, then the hash). Two sets that link
share a shingle among the first fifth of each, so rows meet in tiles keyed by
such a shingle. First each tile's most typical set is compared with the
others, which joins most of a group of copies in linear work. Then, only in
tiles that still hold several components, rows are ordered by size (a set links
only with sets of its size band or the next; large tiles are cut into such
bands) and pairs of different components are taken. A pair is left out where
the places of the shingle in the two orders leave too few shingles for a link
if none before it is shared, or where one of the two shared-tile shingles
before it is in both sets (an earlier tile then has the pair); so the tile of
the first common shingle always takes a pair that may link, and few others do.
Tiles of more than a few rows bound a pair's overlap by hashed bitmap signatures at
once, the others by wider ones afterwards: a set has at least as many shingles
of its own as its bitmap has bits that the other lacks. Pairs that the bounds
leave are decided by intersecting the sorted arrays. No pair is dropped
otherwise, so no link is lost.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import (ArrayType, BinaryType, IntegerType, LongType, StructField, StructType)

from tradewell.llm.common import drop_stored, register, small_batches, stored, table
from tradewell.llm.components import components
from tradewell.llm.kernels import Hasher, byte_classes, lower_bytes, mix, owner, text_chunks, word_spans
from tradewell.llm.ordered import LONGS, as_batch

WORDS = 5           # words of a shingle
CELL_BITS = 20      # cells of the hashed shingle counts
CELL_BLOCK = 1024
BITS = 512          # bits of one bitmap
BAND = 0.8
ODD = [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F]
HELD_IDS = 1_000_000  # a set of ids up to this size (16 MB) is broadcast, a larger one joined by shuffle
TILE = 4096         # rows of a tile block
SMALL = 8           # rows of a tile whose pairs are bounded after they are gathered
WIDE_BITS = 4       # bits of a wide bitmap for each shingle of the set


def shingle_hashes(data, off, hasher, classes, lower):
    """Hashes of the shingles of each text (not yet distinct) and their counts.
    A text of fewer words is one sequence."""
    data = lower[data]
    starts, ends, counts = word_spans(data, off, classes)
    h = hasher.spans(data, starts, ends)
    doc = owner(counts)
    parts, docs = [], []
    if len(h) >= WORDS:
        x = sum((h[k:len(h) - WORDS + 1 + k] * np.uint64(ODD[k]) for k in range(1, WORDS)), h[:len(h) - WORDS + 1] * np.uint64(ODD[0]))
        ok = doc[:len(x)] == doc[WORDS - 1:]
        parts.append(mix(x[ok]))
        docs.append(doc[:len(x)][ok])
    first = np.cumsum(counts) - counts
    for k in range(1, WORDS):
        short = np.flatnonzero(counts == k)
        if len(short):
            x = sum(h[first[short] + j] * np.uint64(ODD[j]) for j in range(k))
            parts.append(mix(x + np.uint64(k)))
            docs.append(short)
    if not parts:
        return np.zeros(0, np.uint64), np.zeros(len(counts), np.int64)
    h, d = np.concatenate(parts), np.concatenate(docs)
    order = np.argsort(d, kind="stable")
    return h[order], np.bincount(d, minlength=len(counts))


def text_sets(col, hasher, classes, lower):
    """(row, sorted distinct shingle hashes) of every text."""
    for lo, _, data, off in text_chunks(col):
        h, n = shingle_hashes(data, off, hasher, classes, lower)
        end = np.cumsum(n)
        for i in range(len(n)):
            yield lo + i, np.unique(h[end[i] - n[i]:end[i]])


def shingle_counts(texts: DataFrame) -> np.ndarray:
    """Levels of hashed shingle counts over the whole corpus, 12 for each
    doubling, so that a shingle shared by a few texts stands out from the mean
    count of a cell: a table of fixed size (1 MB)."""
    def gather(batches):
        hasher, classes, lower = Hasher(), byte_classes(), lower_bytes()
        cells = np.zeros(1 << CELL_BITS, np.int64)
        for b in batches:
            for _, _, data, off in text_chunks(b.column(0)):
                h, _ = shingle_hashes(data, off, hasher, classes, lower)
                cells += np.bincount((h >> np.uint64(64 - CELL_BITS)).astype(np.int64), minlength=len(cells))
        blocks = cells.astype(np.int32).reshape(-1, CELL_BLOCK)
        used = np.flatnonzero(blocks.any(1))
        yield as_batch([pa.array(used, pa.int32()), pa.array([blocks[i].tobytes() for i in used], pa.binary())], ["block", "n"])

    def add(rows: pa.Table) -> pa.Table:
        total = np.zeros(CELL_BLOCK, np.int64)
        for x in rows.column("n"):
            total += np.frombuffer(x.as_py(), np.int32)
        logs = np.minimum(255, 12 * np.log2(np.maximum(total, 1))).astype(np.uint8)
        return pa.table({"block": rows.column("block").slice(0, 1), "n": pa.array([logs.tobytes()], pa.binary())})

    kind = StructType([StructField("block", IntegerType()), StructField("n", BinaryType())])
    out = np.zeros((1 << CELL_BITS) // CELL_BLOCK * CELL_BLOCK, np.uint8)
    for r in texts.mapInArrow(gather, kind).groupBy("block").applyInArrow(add, kind).collect():
        out[r.block * CELL_BLOCK:(r.block + 1) * CELL_BLOCK] = np.frombuffer(r.n, np.uint8)
    return out


def level_of(n):
    """Large sets put only every 2**level-th part of the hash space into their bitmap."""
    return np.maximum(0, np.log2(np.maximum(n, 1)).astype(np.int64) - 8)


def bitmaps(h: np.ndarray) -> bytes:
    """Two bitmaps: at the level of the set's size and at the next."""
    level = int(level_of(np.array([len(h)]))[0])
    out = []
    for k in (level, level + 1):
        part = h[(h & np.uint64((1 << k) - 1)) == 0]
        bits = np.zeros(BITS, np.uint8)
        bits[((part >> np.uint64(30)) % np.uint64(BITS)).astype(np.int64)] = 1
        out.append(np.packbits(bits).tobytes())
    return b"".join(out)


def may_link(na, nb, ma, mb):
    """Whether sizes and bitmaps leave a similarity of 0.8 possible. ma, mb:
    (rows, 2, BITS // 64) words."""
    small, large = np.minimum(na, nb), np.maximum(na, nb)
    ok = 100 * small >= 80 * large
    la, lb = level_of(na), level_of(nb)
    ok_at = np.flatnonzero(ok)
    top = np.maximum(la, lb)
    a = ma[ok_at, (top - la)[ok_at]]
    b = mb[ok_at, (top - lb)[ok_at]]
    own_a = np.bitwise_count(a & ~b).sum(1, dtype=np.int64)
    own_b = np.bitwise_count(b & ~a).sum(1, dtype=np.int64)
    most = np.minimum(na[ok_at] - own_a, nb[ok_at] - own_b)
    ok[ok_at] = 180 * most >= 80 * (na + nb)[ok_at]
    return ok


def bits_array(col) -> np.ndarray:
    return np.frombuffer(b"".join(col.to_pylist()), np.uint64).reshape(-1, 2, BITS // 64)


def profiles(src: DataFrame, logs) -> DataFrame:
    """(id, n, sig, typical, bits, first): first holds the rarest fifth of the set."""
    def run(batches):
        hasher, classes, lower = Hasher(), byte_classes(), lower_bytes()
        table_ = logs.value
        for b in batches:
            n, sig, typical, bits, first = [], [], [], [], []
            for _, h in text_sets(b.column(1), hasher, classes, lower):
                n.append(len(h))
                level = table_[(h >> np.uint64(64 - CELL_BITS)).astype(np.int64)]
                keep = len(h) - -(-80 * len(h) // 100) + 1 if len(h) else 0
                order = np.lexsort((h, level))[:keep]
                first.append(h[order].view(np.int64))
                typical.append(int(1000 * level.mean()) if len(h) else 0)
                sig.append(mix(h).sum(dtype=np.uint64).tobytes() + mix(h ^ np.uint64(ODD[1])).sum(dtype=np.uint64).tobytes())
                bits.append(bitmaps(h))
            yield as_batch([b.column(0), np.array(n, np.int64), pa.array(sig, pa.binary()), np.array(typical, np.int64),
                            pa.array(bits, pa.binary()), pa.array(first, pa.list_(pa.int64()))],
                           ["id", "n", "sig", "typical", "bits", "first"])

    return src.mapInArrow(run, StructType([
        StructField("id", LongType()), StructField("n", LongType()), StructField("sig", BinaryType()),
        StructField("typical", LongType()), StructField("bits", BinaryType()), StructField("first", ArrayType(LongType()))]))


def shared_tokens(rows: DataFrame) -> DataFrame:
    """Of the rows (tok, node, place) sorted by token, those whose token another
    row has, too."""
    names = ["tok", "node", "place"]

    def run(batches):
        held, shared = None, False  # the row that waits for its successor, and whether its predecessor has its token
        for b in batches:
            if not b.num_rows:
                continue
            cols = [b.column(i).to_numpy() for i in range(3)]
            if held is not None:
                cols = [np.r_[x, c] for x, c in zip(held, cols)]
            same = np.r_[shared, cols[0][1:] == cols[0][:-1], False]
            keep = (same[:-1] | same[1:])[:-1]
            yield as_batch([np.asarray(c[:-1][keep], np.int64) for c in cols], names)
            held, shared = [c[-1:] for c in cols], bool(same[-2])
        if held is not None and shared:
            yield as_batch([np.asarray(c, np.int64) for c in held], names)

    return rows.mapInArrow(run, LONGS(*names))


def with_pivots(rows: DataFrame) -> DataFrame:
    """Rows (tok, node, place, before, before2, n) sorted by token and from the
    most typical set on: each with its tile's first node and that one's size."""
    names = ["tok", "node", "place", "before", "before2", "n", "pivot", "pn"]

    def run(batches):
        last = None  # token, pivot and pivot size of the tile that is open
        for b in batches:
            if not b.num_rows:
                continue
            cols = [b.column(i).to_numpy() for i in range(6)]
            tok, node, n = cols[0], cols[1], cols[5]
            new = np.r_[last is None or tok[0] != last[0], tok[1:] != tok[:-1]]
            at = np.flatnonzero(new)
            pivot, pn = node[at], n[at]
            if not new[0]:
                pivot, pn = np.r_[last[1], pivot], np.r_[last[2], pn]
            run_no = np.cumsum(new) - (1 if new[0] else 0)
            yield as_batch([np.asarray(c, np.int64) for c in (*cols, pivot[run_no], pn[run_no])], names)
            last = tok[-1], pivot[-1], pn[-1]

    return rows.mapInArrow(run, LONGS(*names))


def wide_bitmap(h: np.ndarray) -> bytes:
    size = max(64, 1 << int(WIDE_BITS * max(1, len(h)) - 1).bit_length())
    bits = np.zeros(size, np.uint8)
    bits[((h >> np.uint64(20)) & np.uint64(size - 1)).astype(np.int64)] = 1
    return np.packbits(bits, bitorder="little").tobytes()


def wide_may_link(na: int, nb: int, a: bytes, b: bytes) -> bool:
    """Whether the wide bitmaps leave a similarity of 0.8 possible; the larger
    one is folded to the smaller one's size."""
    x, y = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
    size = min(len(x), len(y))
    x, y = (np.bitwise_or.reduce(z.reshape(-1, size), axis=0) for z in (x, y))
    most = min(na - int(np.bitwise_count(x & ~y).sum()), nb - int(np.bitwise_count(y & ~x).sum()))
    return 180 * most >= 80 * (na + nb)


def linked(pairs: DataFrame, nodes: DataFrame, src: DataFrame, bounded: bool = False) -> DataFrame:
    """Of the pairs (a, b), the links (u, v): bitmap bound (unless ``bounded``
    says that it has been applied), wide bitmap bound, then exact."""
    node = lambda x: nodes.select(F.col("node").alias(x), F.col("n").alias(f"n{x}"), F.col("bits").alias(f"bits{x}"))

    def bound(batches):
        for b in batches:
            na, nb = b.column(2).to_numpy(), b.column(4).to_numpy()
            ok = may_link(na, nb, bits_array(b.column(3)), bits_array(b.column(5))) if len(na) else np.zeros(0, bool)
            yield as_batch([b.column(0).to_numpy()[ok], b.column(1).to_numpy()[ok]], ["a", "b"])

    left = pairs if bounded else stored(
        pairs.join(node("a"), "a").join(node("b"), "b").select("a", "b", "na", "bitsa", "nb", "bitsb")
        .mapInArrow(bound, LONGS("a", "b")), "bounded-pairs")
    def of_texts(pairs, form, name):
        """(id, n, name) of the texts of some pairs; name holds form(set)."""
        ids = stored(pairs.select(F.col("a").alias("id")).union(pairs.select(F.col("b").alias("id"))).distinct(), "pair-ids")
        if ids.count() <= HELD_IDS:  # 16 bytes each
            ids = F.broadcast(ids)

        def sets(batches):
            hasher, classes, lower = Hasher(), byte_classes(), lower_bytes()
            for b in batches:
                found = [h for _, h in text_sets(b.column(1), hasher, classes, lower)]
                yield as_batch([b.column(0), np.array([len(h) for h in found], np.int64),
                                pa.array([form(h) for h in found], pa.binary())], ["id", "n", name])

        return stored(src.join(ids, "id", "left_semi").select("id", "text").mapInArrow(sets, StructType(
            [StructField("id", LongType()), StructField("n", LongType()), StructField(name, BinaryType())])), f"pair-{name}")

    def wide(batches):
        for b in batches:
            ok = np.array([wide_may_link(na, nb, x.as_py(), y.as_py()) for na, x, nb, y in zip(
                b.column(2).to_pylist(), b.column(3), b.column(4).to_pylist(), b.column(5))], bool)
            yield as_batch([b.column(0).to_numpy()[ok], b.column(1).to_numpy()[ok]], ["a", "b"])

    def intersect(batches):
        for b in batches:
            ok = []
            for x, y in zip(b.column(2), b.column(3)):
                p, q = (np.frombuffer(s.as_py(), np.uint64) for s in (x, y))
                both = len(np.intersect1d(p, q, assume_unique=True))
                ok.append(100 * both >= 80 * (len(p) + len(q) - both))
            ok = np.array(ok, bool)
            yield as_batch([b.column(0).to_numpy()[ok], b.column(1).to_numpy()[ok]], ["u", "v"])

    side = lambda t, x, *cols: t.select(F.col("id").alias(x), *[F.col(c).alias(f"{c}{x}") for c in cols])
    wides = of_texts(left, wide_bitmap, "wide")
    near = stored(left.join(side(wides, "a", "n", "wide"), "a").join(side(wides, "b", "n", "wide"), "b")
                  .select("a", "b", "na", "widea", "nb", "wideb").mapInArrow(wide, LONGS("a", "b")), "near-pairs")
    exact = of_texts(near, lambda h: h.tobytes(), "set")  # few pairs are left: their sets only now
    links = stored(near.join(side(exact, "a", "set"), "a").join(side(exact, "b", "set"), "b").select("a", "b", "seta", "setb")
                   .mapInArrow(intersect, LONGS("u", "v")), "links")
    for done in (left, wides, exact, near):
        drop_stored(done)
    return links


KEYS = ["tok", "band", "i", "j", "n", "node", "comp", "block", "lower", "place", "before", "before2"]


def banded_pairs(rows: DataFrame) -> DataFrame:
    """All pairs of rows of one tile block with different components that the
    bounds leave. Rows (KEYS and, where pairs are bounded by bitmaps at once,
    bits) come sorted; only rows that can still link are kept in memory."""
    with_bits = "bits" in rows.columns

    def run(batches):
        held = None
        for b in batches:
            if not b.num_rows:
                continue
            new = [b.column(k).to_numpy(zero_copy_only=False) for k in range(len(KEYS))]
            if with_bits:
                new.append(bits_array(b.column(len(KEYS))))
            fresh = 0 if held is None else len(held[0])
            cols = new if held is None else [np.concatenate([x, y]) for x, y in zip(held, new)]
            tok, band, bi, bj, n, node, comp, block, lower, place, b1, b2 = cols[:len(KEYS)]
            size = len(tok)
            differs = np.zeros(size, bool)
            differs[1:] = (tok[1:] != tok[:-1]) | (band[1:] != band[:-1]) | (bi[1:] != bi[:-1]) | (bj[1:] != bj[:-1])
            tile = np.cumsum(differs)
            live, d = np.arange(size), 1
            while True:
                live = live[live + d < size]
                # rows of a tile ascend by n: beyond the first too large one all are
                live = live[(tile[live] == tile[np.minimum(live + d, size - 1)]) & (100 * n[live] >= 80 * n[np.minimum(live + d, size - 1)])]
                if not len(live):
                    break
                to = live + d
                ok = (to >= fresh) & (comp[live] != comp[to]) & lower[live] & ((bi[live] == bj[live]) | (block[live] != block[to]))
                x, y = live[ok], to[ok]
                # if this is the first common shingle, no more than what follows it can be common
                fit = 9 * np.minimum(n[x] - place[x], n[y] - place[y]) >= 4 * (n[x] + n[y])
                # an earlier common shingle: an earlier tile has the pair
                fit &= (b1[x] != b1[y]) & (b1[x] != b2[y]) & (b2[x] != b1[y]) & (b2[x] != b2[y])
                x, y = x[fit], y[fit]
                if with_bits and len(x):
                    fit = may_link(n[x], n[y], cols[-1][x], cols[-1][y])
                    x, y = x[fit], y[fit]
                if len(x):
                    yield as_batch([np.minimum(node[x], node[y]), np.maximum(node[x], node[y])], ["a", "b"])
                d += 1
            keep = (tile == tile[-1]) & (100 * n >= 80 * n[-1])
            held = [c[keep] for c in cols]

    return rows.mapInArrow(run, LONGS("a", "b"))


def remaining_pairs(tiles: DataFrame, comp: DataFrame, nodes: DataFrame) -> DataFrame:
    """Pairs of nodes of different components that share a tile and may link.

    A tile of up to SMALL rows has few pairs, which are bounded later; one of up
    to TILE rows is one block. A larger one is cut into size bands (a set meets
    its own band as either partner, the band below only as the larger one), and
    a band that is still too large into pairs of row blocks."""
    keep = ["tok", "node", "n", "place", "before", "before2"]
    rows = known = stored(tiles.select(*keep).join(comp, "node", "left").select(*keep, F.coalesce("component", "node").alias("comp")),
                          "tile-components")
    drop_stored(tiles)
    kinds = stored(rows.groupBy("tok").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count("*").alias("m"))
                   .where(F.col("m") > SMALL).select("tok", (F.col("m") > TILE).alias("large"), F.expr("lo != hi").alias("mixed")), "tile-kinds")
    zero = F.lit(0).cast("long")
    few = rows.join(kinds.select("tok"), "tok", "left_anti").withColumns(
        {"band": zero, "i": zero, "j": zero, "block": zero, "lower": F.lit(True)})
    few = few.select(*KEYS).repartition("tok").sortWithinPartitions("tok", "n", "node")
    rows = rows.join(kinds.where("mixed"), "tok")
    of = F.floor(F.log(F.col("n").cast("double")) / -float(np.log(BAND))).cast("long")
    place = lambda band, lower: F.struct(band.alias("band"), F.lit(lower).alias("lower"))
    whole = F.array(place(zero, True))
    rows = rows.withColumn("at", F.explode(F.when(F.col("large"), F.array(place(of, True), place(of - 1, False))).otherwise(whole)))
    rows = rows.select(*keep, "comp", "at.band", "at.lower")
    size = stored(rows.groupBy("tok", "band").agg(F.count("*").alias("m"), F.max("lower").alias("any"))
                  .where("m > 1 AND any").select("tok", "band", F.ceil(F.col("m") / TILE).cast("long").alias("blocks")), "tile-sizes")
    rows = rows.join(size, ["tok", "band"]).withColumn("block", F.pmod(F.xxhash64("node", F.lit(3)), F.col("blocks")))
    rows = rows.withColumn("k", F.explode(F.sequence(zero, F.col("blocks") - 1)))
    rows = rows.withColumn("i", F.least("block", "k")).withColumn("j", F.greatest("block", "k"))
    rows = (rows.join(nodes.select("node", "bits"), "node").select(*KEYS, "bits")
            .repartition("tok", "band", "i", "j").sortWithinPartitions("tok", "band", "i", "j", "n", F.desc("lower"), "node"))
    pairs = stored(banded_pairs(few).union(banded_pairs(rows)).distinct(), "pairs")
    for done in (known, kinds, size):
        drop_stored(done)
    return pairs


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, n_shingles, component_id (the least id
    reachable by links, itself included).

    Texts are cut into words at blanks, A-Z lowered; five-word shingles (a
    shorter text is one sequence). Null texts, empty texts and texts without
    words have 0 shingles and link with nothing. Ids are integers; rows that
    share an id are one document; rows with a null id take no part (component
    null). Repeated rows stay; an empty table gives an empty result; other
    columns are not read."""
    spark = docs.sparkSession
    small_batches(spark)
    src = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    logs = spark.sparkContext.broadcast(shingle_counts(src.select("text")))
    prof = stored(profiles(src, logs), "profiles")
    whole = prof.where("n > 0 AND id IS NOT NULL")
    # equal sets are one node, named by its least id; the other ids stand aside
    # (Spark broadcasts them if their table is small), so the wide rows stay put
    reps = stored(whole.groupBy("sig").agg(F.min("id").alias("node")), "nodes")
    ids = whole.select("id", "sig").join(reps, "sig")
    spare = stored(ids.where("id != node").select("id", "sig").distinct(), "copies")
    nodes = whole.join(spare, ["id", "sig"], "left_anti").withColumnRenamed("id", "node")
    # only (shingle, node, place) is dealt out, and most shingles have one node
    tokens = nodes.select("node", F.posexplode("first").alias("place", "tok")).select("tok", "node", F.col("place").cast("long").alias("place"))
    shared = stored(shared_tokens(tokens.repartition("tok").sortWithinPartitions("tok", "node")), "shared")
    # the rarest shingles of every text are done with: go on with the lean columns
    lean = stored(prof.drop("first"), "lean-profiles")
    drop_stored(prof)
    prof = lean
    nodes = (prof.where("n > 0 AND id IS NOT NULL").join(spare, ["id", "sig"], "left_anti").withColumnRenamed("id", "node"))
    # the two shared shingles before each; a node's own name stands for none
    w = Window.partitionBy("node").orderBy("place")
    before = [F.coalesce(F.lag("tok", k).over(w), F.col("node")).alias(x) for k, x in ((1, "before"), (2, "before2"))]
    rows = shared.select("tok", "node", "place", *before).join(nodes.select("node", "n", "typical"), "node")
    rows = rows.repartition("tok").sortWithinPartitions("tok", F.desc("typical"), "n", "node")
    tiles = stored(with_pivots(rows.select("tok", "node", "place", "before", "before2", "n")), "tiles")
    drop_stored(shared)
    pairs = (tiles.where("node != pivot AND 100 * least(n, pn) >= 80 * greatest(n, pn)")
             .select(F.least("node", "pivot").alias("a"), F.greatest("node", "pivot").alias("b")).distinct())
    links = linked(stored(pairs, "pairs"), nodes, src)
    comp = components(links)
    more = linked(remaining_pairs(tiles, comp, nodes), nodes, src, bounded=True)
    if not more.isEmpty():
        comp = components(more.union(comp.select(F.col("node").alias("u"), F.col("component").alias("v"))))
    # a document is its set's node; rows that share an id follow the least node
    named = reps.join(comp, "node", "left").select("sig", F.coalesce("component", "node").alias("c"))
    out = prof.select("id", "n", F.when(F.expr("n > 0 AND id IS NOT NULL"), F.col("sig")).alias("sig"))
    return (out.join(stored(named, "named"), "sig", "left")
            .select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.coalesce("c", "id").alias("component_id")))


@register("op7_ngram_jaccard_join")
def op7_ngram_jaccard_join(spark, sf_dir):
    return near_duplicates(table(spark, sf_dir, "documents"))
