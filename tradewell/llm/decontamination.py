"""Benchmark decontamination by latent semantic retrieval.

Passages (runs of 24 words) are TF-IDF vectors over hashed words. A randomised
SVD over all passages of the corpus gives their leading right singular vectors:
each task multiplies its passages with a seeded random matrix and back, the
products are added up by blocks of rows, and the small remaining problem is
solved on the driver, in one pass over the corpus. Overlapping windows of every
benchmark item and of every document that can hold it (by the item's rare words)
are compared by cosine in that space; a candidate is decided by the longest common subsequence of the item and the
aligned stretch of the document. Stretches that keep most of an item in order
are copies; those that keep less are paraphrases if they also have its answer,
the words of its last sentence.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (BinaryType, IntegerType, LongType, StringType, StructField, StructType)

from tradewell.llm.common import register, small_batches, table
from tradewell.llm.kernels import BLANK, WORD, Hasher, byte_classes, owner, text_chunks, word_spans
from tradewell.llm.ordered import as_batch

FEATURES, RANK, EXTRA, BLOCK = 1 << 14, 48, 8, 64
WINDOW, STEP, ITEM_STEP = 24, 12, 4
COSINE = 0.35      # candidates: cosine in the latent space
SHARED = 0.4        # candidates: share of the shorter window's or item's words that both have
COPY = 0.8          # share of an item's words, in order, that makes a copy
PARAPHRASE = 0.6    # share that makes a paraphrase, if the answer is there too
ANSWER = 0.75       # share of the answer's words, in order
LEAST_WORDS = 8     # shorter items are no evidence of a leak and match nothing
ITEMS, ITEM_WORDS = 2048, 200_000  # a block of items: one search pass each
RARE = 4            # words that a hit has of the rarest ones of an item
MARKS = 20          # bits of the table of rare words
SLICE = 8192        # entries of sparse rows multiplied at once: they stay in the processor's cache
MOST = 1 << 21      # places of rare words compared at once


class Words:
    """Hashes of the lower-cased words (letters and digits) of texts."""

    def __init__(self):
        self.hasher = Hasher()
        c = byte_classes()
        self.classes = np.where(c == WORD, WORD, BLANK).astype(np.uint8)

    def chunks(self, col):
        col = pa.compute.utf8_lower(col.fill_null("").cast(pa.large_string()))
        for lo, hi, data, off in text_chunks(col):
            s, e, counts = word_spans(data, off, self.classes)
            yield lo, hi, self.hasher.spans(data, s, e), counts


def windows(counts: np.ndarray, step: int, whole: bool):
    """(text, first word, words) of the windows of texts. ``whole``: a last
    window ends with the text, so that every word is in a window of full length;
    else the rest is a shorter one."""
    n = np.where(counts == 0, 0, np.maximum(1, -(-(counts - (WINDOW - step if whole else 0)) // step)))
    text = owner(n)
    k = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    first = k * step
    if whole:
        first = np.minimum(first, np.maximum(counts[text] - WINDOW, 0))
    return text, first, np.minimum(WINDOW, counts[text] - first)


def vectors(h, counts, step, whole, idf=None):
    """Sparse rows of the windows: (row, feature, value), sorted by row. Without
    idf the values are 1, one for each feature of a row."""
    text, first, length = windows(counts, step, whole)
    base = (np.cumsum(counts) - counts)[text] + first
    row = owner(length)
    at = np.arange(len(row)) - np.repeat(np.cumsum(length) - length, length) + base[row]
    f = (h[at] >> np.uint64(50)).astype(np.int64)
    key, tf = np.unique(row * FEATURES + f, return_counts=True)
    row, f = key // FEATURES, key % FEATURES
    if idf is None:
        return row, f, None, (text, first, length)
    val = (tf * idf[f]).astype(np.float32)
    norm = np.sqrt(np.bincount(row, weights=val * val, minlength=len(text)))
    return row, f, val / np.maximum(norm, 1e-9)[row].astype(np.float32), (text, first, length)


def project(row, f, val, n, matrix) -> np.ndarray:
    """Rows times matrix. Every row has an entry."""
    if not n:
        return np.zeros((0, matrix.shape[1]), np.float32)
    return np.concatenate([s for _, s in group_sums(row, f, val, matrix)])


def group_sums(group, pick, val, matrix):
    """(groups, sums of their entries matrix[pick] * val) by slices of whole
    groups; entries of a group lie together."""
    first = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
    cuts = np.unique(np.r_[first[np.searchsorted(first, np.arange(0, len(group), SLICE))[:-1]] if len(group) > SLICE else 0, len(group)])
    for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
        at = first[np.searchsorted(first, a):np.searchsorted(first, b)]
        yield group[at], np.add.reduceat(matrix[pick[a:b]] * val[a:b, None], at - a, axis=0)


def summed_blocks(texts: DataFrame, width: int, fold) -> np.ndarray:
    """(FEATURES, width): the sum of the tables that ``fold(words, batches)``
    makes in every task, added up by blocks of rows."""
    def gather(batches):
        t = fold(Words(), batches).astype(np.float64).reshape(FEATURES // BLOCK, BLOCK * width)
        used = np.flatnonzero(t.any(1))
        yield as_batch([pa.array(used, pa.int32()), pa.array([t[i].astype(np.float32).tobytes() for i in used], pa.binary())],
                       ["block", "sums"])

    def add(rows: pa.Table) -> pa.Table:
        parts = sorted(x.as_py() for x in rows.column("sums"))  # one order of addition in every run
        total = np.zeros(BLOCK * width)
        for x in parts:
            total += np.frombuffer(x, np.float32)
        return pa.table({"block": rows.column("block").slice(0, 1), "sums": pa.array([total.astype(np.float64).tobytes()], pa.binary())})

    kind = StructType([StructField("block", IntegerType()), StructField("sums", BinaryType())])
    out = np.zeros((FEATURES, width))
    for r in texts.mapInArrow(gather, kind).groupBy("block").applyInArrow(add, kind).collect():
        out[r.block * BLOCK:(r.block + 1) * BLOCK] = np.frombuffer(r.sums, np.float64).reshape(BLOCK, width)
    return out


def document_frequencies(texts: DataFrame) -> tuple[np.ndarray, float]:
    """Passages with each feature, and the number of passages."""
    def fold(words, batches):
        t = np.zeros((FEATURES, 2))
        for b in batches:
            for _, _, h, counts in words.chunks(b.column(0)):
                row, f, _, (text, _, _) = vectors(h, counts, WINDOW, False)
                t[:, 0] += np.bincount(f, minlength=FEATURES)
                t[0, 1] += len(text)
        return t

    t = summed_blocks(texts, 2, fold)
    return t[:, 0], float(t[0, 1])


def latent_space(texts: DataFrame, idf: np.ndarray, seed: int = 23) -> np.ndarray:
    """(FEATURES, RANK): leading right singular vectors of all passages, each
    divided by its singular value, from one pass over the corpus."""
    spark = texts.sparkSession
    width = RANK + EXTRA
    omega = np.random.default_rng(seed).normal(size=(FEATURES, width)).astype(np.float32)
    sent = spark.sparkContext.broadcast((idf, omega))

    def fold(words, batches):
        weight, start = sent.value
        t = np.zeros((FEATURES, width))
        for b in batches:
            for _, _, h, counts in words.chunks(b.column(0)):
                row, f, val, (text, _, _) = vectors(h, counts, WINDOW, False, weight)
                if not len(row):
                    continue
                z = project(row, f, val, len(text), start)
                order = np.argsort(f, kind="stable")
                for some, sums in group_sums(f[order], row[order], val[order], z):
                    t[some] += sums
        return t

    y = summed_blocks(texts, width, fold)  # A'A times omega
    q, _ = np.linalg.qr(y)
    core = np.linalg.lstsq((q.T @ omega).T, (q.T @ y).T, rcond=None)[0].T  # Q'A'AQ from the same pass
    lam, u = np.linalg.eigh((core + core.T) / 2)
    lam, u = lam[::-1][:RANK], u[:, ::-1][:, :RANK]
    scale = np.where(lam > lam[0] * 1e-9, 1 / np.sqrt(np.maximum(lam, lam[0] * 1e-9 + 1e-300)), 0) if lam[0] > 0 else np.zeros(RANK)
    return ((q @ u) * scale).astype(np.float32)


def unit(z: np.ndarray) -> np.ndarray:
    return z / np.maximum(np.linalg.norm(z, axis=1, keepdims=True), 1e-12)


def lcs(a: list, b: list) -> int:
    """Length of the longest common subsequence, a row of bits at a time."""
    where: dict = {}
    for i, x in enumerate(a):
        where[x] = where.get(x, 0) | 1 << i
    full = row = (1 << len(a)) - 1
    for x in b:
        m = where.get(x)
        if m:
            u = row & m
            row = ((row + u) | (row - u)) & full
    return len(a) - row.bit_count()


def signatures(h, rows, n) -> np.ndarray:
    """(n, 4): 256-bit signatures of the words of each row."""
    bits = np.zeros((n, 256), np.uint8)
    bits[rows, (h & np.uint64(255)).astype(np.int64)] = 1
    return np.packbits(bits, axis=1).view(np.uint64)


def answer_start(text: str) -> int:
    """Where the last sentence (or line) starts: the item's answer."""
    body = text.rstrip(" \t\r\n.!?")
    return max(body.rfind(c) for c in ".!?\n") + 1


def item_blocks(items: DataFrame):
    """Lists of (item, words, words of the answer), a bounded block at a time."""
    words, block, size = Words(), [], 0
    for r in items.orderBy("item", "text").toLocalIterator():
        text = r.text or ""
        cut = answer_start(text)
        (_, _, h, counts), = words.chunks(pa.array([text]))
        (_, _, ha, _), = words.chunks(pa.array([text[cut:]]))
        if len(h) < LEAST_WORDS:
            continue
        block.append((r.item, h, ha if len(ha) >= 3 else h[-(len(h) // 3):]))
        size += len(h)
        if len(block) >= ITEMS or size >= ITEM_WORDS:
            yield block
            block, size = [], 0
    if block:
        yield block


def decide(item, answer, stretch):
    """(kind or None, common words) of one candidate."""
    common = lcs(item, stretch)
    if common >= COPY * len(item):
        return "copy", common
    if common >= PARAPHRASE * len(item) and lcs(answer, stretch) >= ANSWER * len(answer):
        return "paraphrase", common
    return None, common


class RareWords:
    """Which items a text may hold. A hit has PARAPHRASE of an item's words in
    order, so it lacks the rest at most; of the words that lack and RARE more,
    taken from the rarest on, RARE lie in the stretch that is compared. Where they
    do, all words of the item are counted."""

    def __init__(self, block: list, idf: np.ndarray):
        words, items, self.need, self.sets = [], [], [], []
        for n, (_, h, _) in enumerate(block):
            need = next(m for m in range(len(h) + 1) if m >= PARAPHRASE * len(h))
            self.need.append(need)
            self.sets.append(np.unique(h, return_counts=True))
            rare = h[np.argsort(-idf[(h >> np.uint64(50)).astype(np.int64)], kind="stable")[:len(h) - need + RARE]]
            words.append(np.unique(rare))
            items.append(np.full(len(words[-1]), n))
        words, items = np.concatenate(words), np.concatenate(items)
        order = np.lexsort((items, words))
        self.known, self.word = np.unique(words[order], return_inverse=True)
        self.item = items[order]
        self.marked = np.zeros(1 << MARKS, bool)
        self.marked[(self.known >> np.uint64(64 - MARKS)).astype(np.int64)] = True
        size = np.array([len(h) for _, h, _ in block])
        self.reach = size + 2 * np.maximum(STEP, size // 4)     # words of a stretch

    def pairs(self, h, counts) -> np.ndarray:
        """(texts, items): whether a stretch has enough words of the item, the rare ones first."""
        may = np.zeros((len(counts), len(self.reach)), bool)
        at = np.flatnonzero(self.marked[(h >> np.uint64(64 - MARKS)).astype(np.int64)])
        w = np.minimum(np.searchsorted(self.known, h[at]), len(self.known) - 1)
        hit = self.known[w] == h[at]
        at, w = at[hit], w[hit]
        text = owner(counts)[at]
        # places of the items one after another, a bounded number at once
        load = np.bincount(self.item, np.bincount(w, minlength=len(self.known))[self.word], len(self.reach))
        part = (np.cumsum(load) // MOST).astype(np.int64)[self.item]
        for p in np.unique(part):
            word, item = self.word[part == p], self.item[part == p]
            lo = np.searchsorted(word, w)
            n = np.searchsorted(word, w, side="right") - lo
            i = item[np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(lo, n)]
            t, place = np.repeat(text, n), np.repeat(at, n)
            order = np.lexsort((place, i, t))
            i, t, place = i[order], t[order], place[order]
            a, b = slice(0, max(0, len(i) - RARE + 1)), slice(RARE - 1, None)
            near = (i[a] == i[b]) & (t[a] == t[b]) & (place[b] - place[a] < self.reach[i[a]])
            may[t[a][near], i[a][near]] = True
        base = np.cumsum(counts) - counts
        for t, i in np.argwhere(may).tolist():
            part, (known, times), reach = h[base[t]:base[t] + counts[t]], self.sets[i], int(self.reach[i])
            j = np.minimum(np.searchsorted(known, part), len(known) - 1)
            at = np.flatnonzero(known[j] == part)
            # a stretch lies in two neighbouring bins; a word counts as often as the item has it
            bins = np.bincount(at // reach * len(known) + j[at], minlength=(len(part) // reach + 2) * len(known)).reshape(-1, len(known))
            may[t, i] = np.minimum(bins[:-1] + bins[1:], times).sum(1).max() >= self.need[i]
        return may


def search(src: DataFrame, block: list, idf: np.ndarray, space: np.ndarray) -> DataFrame:
    """Hits of one block of items in all documents."""
    rows, starts, owners = [], [], []
    for n, (_, h, _) in enumerate(block):
        count = np.array([len(h)])
        row, f, val, (text, first, _) = vectors(h, count, ITEM_STEP, True, idf)
        rows.append(unit(project(row, f, val, len(text), space)))
        starts += list(first)
        owners += [n] * len(first)
    queries = np.concatenate(rows).T.copy()
    marks = signatures(np.concatenate([h for _, h, _ in block]), owner(np.array([len(h) for _, h, _ in block])), len(block))
    sent = src.sparkSession.sparkContext.broadcast((idf, space, queries, np.array(starts), np.array(owners), marks,
                                                    [(i, h.tolist(), a.tolist()) for i, h, a in block], RareWords(block, idf)))

    def run(batches):
        weight, basis, all_q, all_start, all_item, q_marks, known, rare = sent.value
        q_bits = np.bitwise_count(q_marks).sum(1, dtype=np.int64)
        words = Words()
        sets = [set(h) for _, h, _ in known]
        for b in batches:
            found = []
            for lo, _, h, counts in words.chunks(b.column(1)):
                may = rare.pairs(h, counts)
                held = may.any(1)
                if not held.any():
                    continue
                h, counts, may, rows = h[np.repeat(held, counts)], counts[held], may[held], lo + np.flatnonzero(held)
                cols = np.flatnonzero(may.any(0)[all_item])
                q, q_start, q_item = all_q[:, cols], all_start[cols], all_item[cols]
                row, f, val, (text, first, length) = vectors(h, counts, STEP, True, weight)
                z = unit(project(row, f, val, len(text), basis))
                base = np.cumsum(counts) - counts
                of = owner(length)
                word = np.arange(len(of)) - np.repeat(np.cumsum(length) - length, length) + (base[text] + first)[of]
                marks = signatures(h[word], of, len(text))
                bits = np.bitwise_count(marks).sum(1, dtype=np.int64)
                tried = {}
                for at in range(0, len(z), 2048):
                    w, j = np.nonzero(z[at:at + 2048] @ q >= COSINE)
                    w, item = w + at, q_item[j]
                    ok = may[text[w], item]
                    w, j, item = w[ok], j[ok], item[ok]
                    both = np.bitwise_count(marks[w] & q_marks[item]).sum(1, dtype=np.int64)
                    near = both >= SHARED * np.minimum(bits[w], q_bits[item])
                    for wi, qi in zip(w[near].tolist(), j[near].tolist()):
                        # where the item would start if the two windows were the same
                        t, n = int(text[wi]), int(q_item[qi])
                        place = int(first[wi]) - int(q_start[qi])
                        size = len(known[n][1])
                        slack = max(STEP, size // 4)
                        if any(abs(place - p) <= 2 for p in tried.get((t, n), ())):
                            continue
                        tried.setdefault((t, n), []).append(place)
                        a, e = max(0, place - slack), min(int(counts[t]), place + size + slack)
                        stretch = h[base[t] + a:base[t] + e].tolist()
                        # words in common bound the subsequence from above
                        if sum(x in sets[n] for x in stretch) < PARAPHRASE * size:
                            continue
                        kind, common = decide(known[n][1], known[n][2], stretch)
                        if kind:
                            found.append((int(rows[t]), n, kind, common))
            best: dict = {}
            for i, n, kind, common in found:
                if (i, n) not in best or best[i, n][1] < common:
                    best[i, n] = (kind, common)
            keys = sorted(best)
            yield as_batch([b.column(0).take(pa.array([i for i, _ in keys], pa.int64())),
                            pa.array([known[n][0] for _, n in keys], pa.int64()),
                            pa.array([best[k][0] for k in keys], pa.string()),
                            pa.array([best[k][1] for k in keys], pa.int64()),
                            pa.array([len(known[n][1]) for _, n in keys], pa.int64())],
                           ["id", "item_id", "kind", "common_words", "item_words"])

    return src.mapInArrow(run, StructType([src.schema["id"], *HITS]))


HITS = [StructField("item_id", LongType()), StructField("kind", StringType()), StructField("common_words", LongType()),
        StructField("item_words", LongType())]


def find_leaks(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """(id, item_id, kind, common_words, item_words): benchmark items in documents.

    kind is 'copy' or 'paraphrase'; of several places of an item in a document
    the one with most words in common counts. Null and empty texts hold no
    item; items of fewer than 8 words, and null or empty ones, match nothing;
    repeated documents have their hits repeated; null ids stay; an empty table
    gives an empty result; other columns are not read. Items are searched in
    blocks of bounded size, each against all documents."""
    spark = docs.sparkSession
    small_batches(spark)
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    texts = src.select("text")
    df, n = document_frequencies(texts)
    out = spark.createDataFrame([], StructType([src.schema["id"], *HITS]))
    if n:
        idf = np.log((1 + n) / (1 + df)).astype(np.float32) + 0.1
        space = latent_space(texts, idf)
        wanted = items.select(F.col(item_col).cast("long").alias("item"), F.col(item_text_col).alias("text")).where("item IS NOT NULL")
        for block in item_blocks(wanted):
            out = out.union(search(src, block, idf, space))
    return out.withColumnRenamed("id", id_col)


@register("op2_decontamination")
def op2_decontamination(spark, sf_dir):
    return find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
