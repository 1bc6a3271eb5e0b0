import math
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tradewell.llm import hard_negatives
from tradewell.llm.common import table
from tradewell.llm.hard_negatives import mine_hard_negatives, strassen
from tradewell.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<double>, label int, anchor string, id int"


@settings(max_examples=40, deadline=None)
@given(st.integers(0, 70), st.integers(0, 70), st.integers(0, 70), st.integers(0, 2 ** 32))
def test_strassen_is_exact(m, k, n, seed):
    rnd = np.random.default_rng(seed)
    a, b = rnd.integers(-2 ** 27, 2 ** 27, (m, k)), rnd.integers(-2 ** 27, 2 ** 27, (k, n))
    assert (strassen(a, b) == a @ b).all()


def brute(rows, is_anchor, positives=5, negatives=10):
    ok = []
    for i, v, label in rows:
        if i is None or v is None or label is None or any(c is None or not math.isfinite(c) for c in v):
            continue
        ok.append((i, [math.floor(256 * c) for c in v], label))
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))
    out = []
    for i, x, label in ok:
        if not is_anchor(i):
            continue
        near = sorted((-dot(x, y), j) for j, y, m in ok if j != i and m == label)[:positives]
        for ps, p in near:
            far = sorted((-dot(x, y), j) for j, y, m in ok if m != label and 30 * -ps <= 100 * dot(x, y) <= 90 * -ps)[:negatives]
            out += [(i, p, k + 1, j, -ps, -ns) for k, (ns, j) in enumerate(far)]
    return sorted(out)


def test_query_equals_brute_force(spark):
    rows = [(r.vec_id, r.embedding, (r.label + 1) % 10 if r.vec_id % 7 == 0 else r.label) for r in table(spark, SF, "embeddings").collect()]
    got = sorted(tuple(r) for r in QUERIES["op11_hard_negatives"](spark, SF).collect())
    assert got == brute(rows, lambda i: i % 100 == 0) and len(got) > 100


@pytest.mark.parametrize("block", [8 << 20, 8 * 8 * 3])
def test_ties_and_odd_rows(spark, monkeypatch, block):
    """Few coordinates make many ties; blocks of three anchors; rows that take no part."""
    monkeypatch.setattr(hard_negatives, "BLOCK_BYTES", block)
    rnd = random.Random(5)
    rows = [(i, [rnd.randrange(-2, 6) / 4 for _ in range(8)], rnd.choice([0, 0, 0, 1, 2])) for i in range(160)]
    odd = [(None, [1.0] * 8, 0), (200, None, 0), (204, [1.0] * 7 + [None], 0), (208, [float("nan")] + [1.0] * 7, 0),
           (212, [float("inf")] * 8, 1), (216, [1.0] * 8, None), (220, [1e300] * 8, 0)]
    short = [(224, [1.0, 1.0], 1), (228, [], 2)]
    df = spark.createDataFrame([(*r, "x", 7) for r in [*rows, *odd, *short]], SCHEMA)
    got = sorted(tuple(r) for r in mine_hard_negatives(df, F.col("vec_id") % 4 == 0).collect())
    pad = [(i, v + [0.0] * (8 - len(v)), m) for i, v, m in short]
    assert got == brute([*rows, *pad], lambda i: i % 4 == 0)


def test_repeated_rows_and_empty_tables(spark):
    rows = [(0, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (2, [0.5, 0.5], 2), (2, [0.5, 0.5], 2), (0, [1.0, 0.0], 1)]
    df = spark.createDataFrame([(*r, None, None) for r in rows], SCHEMA)
    got = sorted(tuple(r) for r in mine_hard_negatives(df, F.col("vec_id") == 0).collect())
    # two anchors, two positives each, two negatives each: every repeated row counts
    assert got == brute(rows, lambda i: i == 0) and len(got) == 8
    assert mine_hard_negatives(df.limit(0), F.col("vec_id") == 0).count() == 0
    assert mine_hard_negatives(df, F.col("vec_id") == 9).count() == 0


def test_no_window_below_a_negative_score(spark):
    rows = [(0, [1.0, 0.0], 1), (1, [-1.0, 0.0], 1), (2, [-0.5, 0.0], 2), (3, [0.0, 1.0], 2)]
    df = spark.createDataFrame([(*r, None, None) for r in rows], SCHEMA)
    assert mine_hard_negatives(df, F.col("vec_id") == 0).count() == 0
