"""Language identification by error-correcting output codes.

Every language gets a codeword; one linear classifier per bit, over hashed
byte n-grams (2 and 3), predicts that bit. A text is decoded to the codeword
with the least loss, each bit weighted by how well it worked for that language
in training. If the second-best codeword is nearly as good, the text is
flagged as ambiguous.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, BooleanType, DoubleType, StringType, StructField, StructType

from tradewell.llm.common import id_bucket, register, small_batches, table
from tradewell.llm.kernels import text_chunks
from tradewell.llm.ordered import as_batch

FEATURES = 2048


def ngram_profile(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Square roots of the shares of hashed 2- and 3-grams, a row per text. A-Z
    fold to a-z; every ASCII character that is no letter is one blank."""
    fold = np.full(256, 32, np.uint64)
    fold[65:91] = np.arange(97, 123)
    fold[97:123] = np.arange(97, 123)
    fold[128:] = np.arange(128, 256)
    b = fold[data]
    n = len(off) - 1
    doc = np.repeat(np.arange(n, dtype=np.int64), np.diff(off))
    out = np.zeros(n * FEATURES, np.float32)
    code = b
    for k in (2, 3):
        if len(b) < k:
            break
        code = code[:-1] * np.uint64(257) + b[k - 1:]
        slot = ((code * np.uint64(0x9E3779B97F4A7C15) + np.uint64(k)) >> np.uint64(53)).astype(np.int64)
        same = doc[:len(slot)] == doc[k - 1:]
        out += np.bincount((doc[:len(slot)] * FEATURES + slot)[same], minlength=n * FEATURES)
    out = out.reshape(n, FEATURES)
    return np.sqrt(out / np.maximum(out.sum(1, keepdims=True), 1))


def codewords(n: int) -> np.ndarray:
    """n rows of +1/-1. Up to 6 languages: every split into two groups once;
    beyond, seeded random columns, 12 for each doubling."""
    if n == 1:
        return np.ones((1, 1))
    if n <= 6:
        cols = [[1] + [1 if c >> i & 1 else -1 for i in range(n - 1)] for c in range(2 ** (n - 1) - 1)]
    else:
        rnd = np.random.default_rng(11)
        cols = []
        while len(cols) < 12 * int(np.ceil(np.log2(n))):
            col = rnd.choice([-1, 1], n)
            if abs(col.sum()) < n:
                cols.append(list(col))
    return np.array(cols, float).T


def fit_bits(x: np.ndarray, y: np.ndarray, code: np.ndarray, steps: int = 200):
    """Logistic classifiers for all bits at once; weights (features+1, bits)
    and, per language and bit, the normalised rate of right bits."""
    want = code[y]
    xb = np.hstack([x * 8, np.ones((len(x), 1), x.dtype)]).astype(np.float32)
    w = np.zeros((xb.shape[1], code.shape[1]), np.float32)
    m, v = np.zeros_like(w), np.zeros_like(w)
    # languages of few rows weigh as much as the others
    each = (1 / np.bincount(y, minlength=len(code))[y]).astype(np.float32)
    each = (each / each.sum())[:, None]
    for t in range(1, steps + 1):
        g = xb.T @ (-want * each / (1 + np.exp(np.clip(want * (xb @ w), -30, 30)))).astype(np.float32) + 1e-5 * w
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w -= 0.05 * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
    right = (xb @ w) * want > 0
    rate = np.array([right[y == c].mean(0) if (y == c).any() else np.ones(code.shape[1]) for c in range(len(code))])
    rate = np.maximum(rate, 1e-3)
    return w, rate / rate.sum(1, keepdims=True)


def decode(x: np.ndarray, w: np.ndarray, code: np.ndarray, weight: np.ndarray, margin: float):
    """Language number, score (0 to 1) and ambiguity of each profile."""
    f = np.hstack([x * 8, np.ones((len(x), 1), x.dtype)]) @ w
    loss = np.stack([(weight[c] * np.logaddexp(0, -code[c] * f)).sum(1) for c in range(len(code))], 1)
    p = np.exp(-4 * (loss - loss.min(1, keepdims=True)))
    p /= p.sum(1, keepdims=True)
    best = p.argmax(1)
    top = np.sort(p, 1)
    close = top[:, -1] - top[:, -2] < margin if len(code) > 1 else np.zeros(len(x), bool)
    return best, p[np.arange(len(x)), best], close


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def predict_language(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                     sample_per_lang: int = 500, margin: float = 0.2) -> DataFrame:
    """One row per input row: id, held_out, lang_pred, score, ambiguous.

    Learns from rows with a language whose crc32(id as text) mod 5 is not 0:
    about ``sample_per_lang`` rows per language (the bound of the training
    sample; all rows of a language that has fewer), chosen by hash of id and
    text. Text and language of those rows are all that it learns from. Null,
    empty and letterless texts get 'und' with score 0; without training rows
    every text does. Null ids count as the empty text in the split; repeated
    rows stay; an empty table gives an empty result; other columns are not read."""
    spark = docs.sparkSession
    small_batches(spark)
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    train = src.where((id_bucket(F.col("id"), 5) != 0) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    counts = {r.lang: r.n for r in train.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    langs = sorted(counts)
    model = None
    if langs:
        part = F.pmod(F.xxhash64("id", "text"), F.lit(1 << 30))
        keep = F.lit(False)
        for lang in langs:
            keep = keep | ((F.col("lang") == lang) & (part < -(-(sample_per_lang << 30) // counts[lang])))

        def profile(batches):
            for b in batches:
                for lo, hi, data, off in text_chunks(b.column(1)):
                    x = ngram_profile(data, off)
                    yield as_batch([b.column(0)[lo:hi], pa.array([r.tobytes() for r in x], pa.binary())], ["lang", "x"])

        rows = train.where(keep).select("lang", "text").mapInArrow(profile, StructType(
            [StructField("lang", StringType()), StructField("x", BinaryType())])).collect()
        rows.sort(key=lambda r: (r.lang, bytes(r.x)))
        x = np.array([np.frombuffer(r.x, np.float32) for r in rows])
        code = codewords(len(langs))
        if len(rows):
            model = (langs, code, *fit_bits(x, np.array([langs.index(r.lang) for r in rows]), code))
    sent = spark.sparkContext.broadcast(model)

    def run(batches):
        known = sent.value
        for b in batches:
            preds, scores, close = [], [], []
            texts = b.column(2)
            for lo, hi, data, off in text_chunks(texts):
                folded = data | 32
                letter = np.r_[0, np.cumsum((folded >= 97) & (folded <= 122))]
                some = letter[off[1:]] > letter[off[:-1]]
                some |= [not s and has_letter(texts[lo + i].as_py() or "") for i, s in enumerate(some)]
                if known is None:
                    best, p, c = np.zeros(hi - lo, int), np.zeros(hi - lo), np.zeros(hi - lo, bool)
                else:
                    best, p, c = decode(ngram_profile(data, off), *known[2:3], known[1], known[3], margin)
                for i in range(hi - lo):
                    ok = bool(some[i]) and known is not None
                    preds.append(known[0][best[i]] if ok else "und")
                    scores.append(float(p[i]) if ok else 0.0)
                    close.append(bool(c[i]) if ok else False)
            yield as_batch([b.column(0), b.column(1), pa.array(preds, pa.string()), pa.array(scores, pa.float64()),
                            pa.array(close, pa.bool_())], [id_col, "held_out", "lang_pred", "score", "ambiguous"])

    lean = src.select("id", (id_bucket(F.col("id"), 5) == 0).alias("held_out"), "text")
    out = StructType([StructField(id_col, lean.schema[0].dataType), StructField("held_out", BooleanType()),
                      StructField("lang_pred", StringType()), StructField("score", DoubleType()),
                      StructField("ambiguous", BooleanType())])
    return lean.mapInArrow(run, out)


@register("op10_language_id")
def op10_language_id(spark, sf_dir):
    return predict_language(table(spark, sf_dir, "documents"))
