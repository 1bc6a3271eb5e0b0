"""Quality rules: robust multivariate outliers.

Text statistics are computed with DataFrame functions only. Per language and
source, the minimum-covariance-determinant estimate of the transformed
statistics is found by concentration steps: distances from the current centre,
the share of rows with the least distances, their mean and covariance, again
until no determinant falls. Rows whose Mahalanobis distance from the final
(reweighted) estimate exceeds the cutoff are rejected.

Distances are cut into bins, and a step sums what the moments need per group
and bin, so a group with a third of all rows is summed where its rows are; no
step gathers or sorts a group. The h-subset ends with the bin that reaches h.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tradewell.llm.common import register, stored, table, words_of

DIMS = ["x0", "x1", "x2", "x3", "x4"]
D = len(DIMS)
PAIRS = [(i, j) for i in range(D) for j in range(i + 1)]
# Prior variance: log of length, log of the mean word length, square roots of
# the shares of signs, repeated lines, repeated words. It counts in full in
# groups of up to PRIOR rows and falls as PRIOR / rows in larger ones, where the
# group's own covariance decides; LEAST keeps that one regular (shares of lines
# and of repeats move in steps of whole lines and windows).
FLOORS = [0.25, 0.02, 0.01, 0.01, 0.01]
PRIOR = 30
LEAST = [0.002, 0.0005, 0.0005, 0.004, 0.004]
SHARE = 0.75          # share of a group's rows in its h-subset
CONSISTENT = 1.41     # makes the 75 % covariance consistent at the normal law, 5 dimensions
REWEIGHT = 12.833     # 97.5 % quantile of chi-square with 5 degrees of freedom
CUTOFF = 30.856       # 99.999 % quantile of the same law: rows beyond are rejected
STEPS = 12            # concentration steps at most


def _let(value, body):
    """body(value) with the value computed once per row."""
    return F.transform(F.array(value), body)[0]


def repeated_words(words) -> F.Column:
    """Words inside three-word windows that occur twice or more in the text.

    A long per window holds the upper bits of its hash and, below, its place;
    sorted, windows with equal bits are neighbours. Only those are compared
    word by word, sorted with their places."""
    left = lambda x, k: F.call_function("shiftleft", x, k)
    right = lambda x, k: F.call_function("shiftright", x, k)

    def candidates(w, n, k):
        packed = F.transform(F.sequence(F.lit(0), n - 3),
                             lambda i: left(right(F.xxhash64(w[i], w[i + 1], w[i + 2]), k), k) + i)
        return _let(F.sort_array(packed), lambda s: F.filter(s, lambda x, j: _let(right(x, k), lambda h: (
            h == right(F.get(s, j - 1), k)) | (h == right(F.get(s, j + 1), k)))))

    def starts(w, k, found):
        at = lambda x: (x - left(right(x, k), k)).cast("int")
        cells = F.sort_array(F.transform(found, lambda x: _let(at(x), lambda i: F.struct(
            F.struct(w[i].alias("a"), w[i + 1].alias("b"), w[i + 2].alias("c")).alias("w"), i.alias("i")))))
        return _let(cells, lambda s: F.sort_array(F.transform(
            F.filter(s, lambda x, j: (F.get(s, j - 1)["w"] == x["w"]) | (F.get(s, j + 1)["w"] == x["w"])),
            lambda x: x["i"])))

    def count(found):
        # a window adds the words that the window before it did not cover
        return F.aggregate(found, F.struct(F.lit(-3).alias("p"), F.lit(0).cast("long").alias("n")),
                           lambda a, p: F.struct(p.alias("p"), (a["n"] + F.least(F.lit(3), p - a["p"])).alias("n")),
                           lambda a: a["n"])

    def covered(w, n, k):
        return _let(candidates(w, n, k), lambda c: F.when(F.size(c) == 0, F.lit(0).cast("long")).otherwise(
            count(starts(w, k, c))))

    return _let(words, lambda w: _let(F.size(w), lambda n: F.when(n < 3, F.lit(0).cast("long")).otherwise(
        _let(F.ceil(F.log2(n)).cast("int"), lambda k: covered(w, n, k)))))


def text_statistics(docs: DataFrame, id_col="doc_id", text_col="text", lang_col="lang", source_col="source") -> DataFrame:
    """id, lang, source, n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, n_lines, n_chars of every row."""
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"),
                      F.col(source_col).cast("string").alias("source"))

    def measure(w):
        return F.struct(F.size(w).cast("long").alias("n_words"),
                        F.char_length(F.array_join(w, "")).cast("long").alias("word_chars"),
                        repeated_words(w).alias("n_repeat_words"))

    s = F.struct(
        _let(words_of(F.col("text")), measure).alias("w"),
        F.char_length(F.regexp_replace(text, r"[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
        _let(lines, lambda x: F.struct((F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("dup"),
                                       F.size(x).cast("long").alias("all"))).alias("l"))
    return (src.select("id", "lang", "source", s.alias("s"))
            .select("id", "lang", "source", F.col("s.w.n_words").alias("n_words"), F.col("s.w.word_chars").alias("word_chars"),
                    F.col("s.n_symbols").alias("n_symbols"), F.col("s.l.dup").alias("n_dup_lines"),
                    F.col("s.w.n_repeat_words").alias("n_repeat_words"), F.col("s.l.all").alias("n_lines")))


def _vector(df: DataFrame) -> DataFrame:
    share = lambda a, b: F.sqrt(F.col(a) / F.greatest(F.col(b), F.lit(1)))
    return df.withColumns({
        "x0": F.log1p("n_words"), "x1": F.log1p(F.col("word_chars") / F.greatest(F.col("n_words"), F.lit(1))),
        "x2": share("n_symbols", "word_chars"), "x3": share("n_dup_lines", "n_lines"),
        "x4": share("n_repeat_words", "n_words")})


# Moments are summed as whole numbers of 2**-20, so that no order of addition changes them.
_UNIT = float(1 << 20)


def _moments():
    exact = lambda c: F.sum(F.round(c * _UNIT).cast("decimal(38,0)"))
    return ([F.max("size").alias("size"), F.count("*").alias("n")] + [exact(F.col(x)).alias(f"s{i}") for i, x in enumerate(DIMS)]
            + [exact(F.col(DIMS[i]) * F.col(DIMS[j])).alias(f"q{i}{j}") for i, j in PAIRS])


def _floor(i: int) -> F.Column:
    """Variance added in dimension i, by the group's number of rows (column size)."""
    return F.least(F.lit(1.0), PRIOR / F.col("size")) * FLOORS[i] + LEAST[i]


MOMENTS = ["n"] + [f"s{i}" for i in range(D)] + [f"q{i}{j}" for i, j in PAIRS]


def _estimate(m: DataFrame, factor: float) -> DataFrame:
    """Per group: centre m0.., Cholesky factor l00.. of the covariance (with
    floors) and logdet."""
    n = F.col("n").cast("double")
    df = m.withColumns({f"m{i}": F.col(f"s{i}").cast("double") / _UNIT / n for i in range(D)})
    df = df.withColumns({f"c{i}{j}": factor * F.greatest(
        (F.col(f"q{i}{j}").cast("double") / _UNIT / n - F.col(f"m{i}") * F.col(f"m{j}")), F.lit(0.0) if i == j else F.lit(-1e300))
        + (_floor(i) if i == j else F.lit(0.0)) for i, j in PAIRS})
    for i, j in sorted(PAIRS):
        below = sum((F.col(f"l{i}{k}") * F.col(f"l{j}{k}") for k in range(j)), F.lit(0.0))
        rest = F.col(f"c{i}{j}") - below
        df = df.withColumn(f"l{i}{j}", F.sqrt(F.greatest(rest, _floor(i) / 2)) if i == j else rest / F.col(f"l{j}{j}"))
    logdet = sum((2 * F.log(F.col(f"l{i}{i}")) for i in range(D)), F.lit(0.0))
    keep = [f"m{i}" for i in range(D)] + [f"l{i}{j}" for i, j in PAIRS]
    return df.select("lang", "source", "size", *keep, logdet.alias("logdet"))


def _distance(df: DataFrame) -> DataFrame:
    """Squared Mahalanobis distance d2: forward substitution with the factor."""
    for i in range(D):
        below = sum((F.col(f"l{i}{k}") * F.col(f"z{k}") for k in range(i)), F.lit(0.0))
        df = df.withColumn(f"z{i}", (F.col(DIMS[i]) - F.col(f"m{i}") - below) / F.col(f"l{i}{i}"))
    return df.withColumn("d2", sum((F.col(f"z{i}") * F.col(f"z{i}") for i in range(D)), F.lit(0.0)))


def _with_estimate(rows: DataFrame, est: DataFrame) -> DataFrame:
    # null languages and sources are groups of their own; Spark broadcasts the
    # estimates if their table is small and splits hot groups otherwise
    e = est.withColumnsRenamed({"lang": "elang", "source": "esource"})
    return rows.join(e, F.col("lang").eqNullSafe(F.col("elang")) & F.col("source").eqNullSafe(F.col("esource")))


def _binned(rows: DataFrame) -> DataFrame:
    """Moments per group and bin of distance (64 bins for each doubling)."""
    bin_ = F.floor(F.log2(F.col("d2") + 1e-6) * 64).cast("int")
    return rows.withColumn("bin", bin_).groupBy("lang", "source", "bin").agg(*_moments())


def _subset(binned: DataFrame) -> DataFrame:
    """Moments of the bins up to the one that reaches the share."""
    group = Window.partitionBy("lang", "source")
    run = group.orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    df = (binned.withColumn("before", F.coalesce(F.sum("n").over(run), F.lit(0)))
          .withColumn("all", F.sum("n").over(group)).where(F.col("before") < F.ceil(SHARE * F.col("all"))))
    return df.groupBy("lang", "source").agg(F.max("size").alias("size"), *[F.sum(c).cast("decimal(38,0)").alias(c) for c in MOMENTS])


def _start(rows: DataFrame) -> DataFrame:
    """Start: every coordinate's median and quartile range, from counts of
    values cut to 1/256."""
    cells = (rows.select("lang", "source", F.posexplode(F.array(*DIMS)).alias("dim", "v"))
             .groupBy("lang", "source", "dim", F.floor(F.col("v") * 256).alias("v")).agg(F.count("*").alias("n")))
    group = Window.partitionBy("lang", "source", "dim")
    cells = (cells.withColumn("upto", F.sum("n").over(group.orderBy("v"))).withColumn("all", F.sum("n").over(group)))
    at = lambda q: F.min(F.when(F.col("upto") >= q * F.col("all"), F.col("v"))) / 256.0
    q = cells.groupBy("lang", "source", "dim").agg(F.max("all").alias("size"), at(0.25).alias("lo"), at(0.5).alias("mid"), at(0.75).alias("hi"))
    pick = lambda d, c: F.max(F.when(F.col("dim") == d, F.col(c)))
    var = F.pow((F.col("hi") - F.col("lo")) / 1.349, 2)
    q = q.withColumn("var", var)
    cols = [pick(i, "mid").alias(f"m{i}") for i in range(D)]
    cols += [(F.sqrt(pick(i, "var") + F.max(_floor(i))) if i == j else F.lit(0.0)).alias(f"l{i}{j}") for i, j in PAIRS]
    return q.groupBy("lang", "source").agg(F.max("size").alias("size"), *cols).withColumn("logdet", F.lit(float("inf")))


def robust_estimates(rows: DataFrame) -> DataFrame:
    """The reweighted estimate per language and source. ``rows`` holds x0.."""
    est = stored(_start(rows), "mcd-start")
    for _ in range(STEPS):
        now = stored(_estimate(_subset(stored(_binned(_distance(_with_estimate(rows, est))), "mcd-bins")), CONSISTENT), "mcd")
        old = est.select("lang", "source", F.col("logdet").alias("was"))
        fell = now.alias("a").join(old.alias("b"), F.expr("a.lang <=> b.lang AND a.source <=> b.source")).where(
            "a.logdet < b.was - 1e-4").limit(1).count()
        est = now
        if not fell:
            break
    near = _distance(_with_estimate(rows, est)).where(F.col("d2") <= REWEIGHT)
    return stored(_estimate(near.groupBy("lang", "source").agg(*_moments()), 1.0), "mcd-final")


def quality_rules(docs: DataFrame, id_col="doc_id", text_col="text", lang_col="lang", source_col="source") -> DataFrame:
    """One row per input row: id, n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed, kept, distance (squared, null if base_failed).

    Null texts have no words and fail the base rule. Rows that fail it take no
    part in the estimates. Null languages and sources are groups of their own;
    a group of any size has an estimate: a prior variance counts in small
    groups and fades in large ones.
    Repeated rows stay; an empty table gives an empty result; other columns are
    not read."""
    stats = stored(text_statistics(docs, id_col, text_col, lang_col, source_col), "text-statistics")
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    rows = _vector(stats.withColumn("base_failed", failed))
    good = rows.where(~F.col("base_failed"))
    est = robust_estimates(good)
    measures = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    judged = _distance(_with_estimate(good, est)).select(
        "id", *measures, "base_failed", (F.col("d2") <= CUTOFF).alias("kept"), F.col("d2").alias("distance"))
    bad = rows.where("base_failed").select("id", *measures, "base_failed", F.lit(False).alias("kept"),
                                           F.lit(None).cast("double").alias("distance"))
    return judged.union(bad).withColumnRenamed("id", id_col)


@register("op3_quality_rules")
def op3_quality_rules(spark, sf_dir):
    return quality_rules(table(spark, sf_dir, "documents"))
