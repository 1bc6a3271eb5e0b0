import random
import re
from collections import Counter, defaultdict

import pytest
from hypothesis import given, settings, strategies as st

from tradewell.llm.common import table
from tradewell.llm.mixing import fit_budget, mix_sources, targets
from tradewell.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.integers(1, 60), st.integers(1, 5), min_size=1, max_size=8), st.floats(0, 1), st.integers(0, 99))
def test_fit_reaches_the_best_sum(counts, share, seed):
    lengths, n = list(counts), list(counts.values())
    budget = int(sum(a * b for a, b in counts.items()) * share)
    take = fit_budget(lengths, n, budget, seed)
    assert all(0 <= t <= c for t, c in zip(take, n))
    base = [c * budget // max(1, sum(a * b for a, b in counts.items())) for c in n]
    sums = {sum(a * b for a, b in zip(base, lengths))}
    for i, a in enumerate(lengths):
        sums = {s + a * k for s in sums for k in range(n[i] - base[i] + 1)}
    assert sum(t * a for t, a in zip(take, lengths)) == max(s for s in sums if s <= budget)


def test_fit_of_long_documents():
    rnd = random.Random(1)
    lengths = rnd.sample(range(1, 90_000), 3000)
    counts = [rnd.randrange(1, 9) for _ in lengths]
    budget = sum(a * b for a, b in zip(lengths, counts)) // 3
    assert sum(int(t) * a for t, a in zip(fit_budget(lengths, counts, budget, 1), lengths)) == budget


def test_fit_of_documents_longer_than_the_program():
    take = fit_budget([5, 1_500_000, 1_510_000, 1_600_000], [1, 1, 1, 1], 1_520_000, 1)
    assert take.tolist() == [1, 0, 1, 0]
    assert fit_budget([1_600_000, 1_700_000], [1, 1], 1_520_000, 1).tolist() == [0, 0]


def test_targets():
    t = targets({"b": 100, "a": 10, None: 1000, "c": 50})
    assert t["a"] == 30 and sum(t.values()) == pytest.approx(1160 if t["b"] < 300 else sum(t.values()))
    assert all(t[s] <= 3 * n for s, n in {"b": 100, "a": 10, None: 1000, "c": 50}.items())
    assert targets({}) == {} and targets({"a": 0}) == {"a": 0.0}


def check(rows, docs):
    words = {i: len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t, _ in docs}
    source = {i: s for i, _, s in docs}
    total, taken, target = Counter(), Counter(), {}
    for i in words:
        total[source[i]] += words[i]
    goal = targets({s: total[s] for s in set(source.values())})
    for r in rows:
        assert r.size == words[r.doc_id] and r.source_size == total[source[r.doc_id]]
        assert r.taken == r.size * r.copies and 0 <= r.copies <= 3
        taken[source[r.doc_id]] += r.taken
        target[source[r.doc_id]] = r.target
    for s in target:
        assert target[s] == pytest.approx(goal[s])
    return {s: (taken[s], target[s]) for s in target}


def test_query(spark):
    docs = [(r.doc_id, r.text, r.source) for r in table(spark, SF, "documents").collect()]
    rows = QUERIES["op4_mixing"](spark, SF).collect()
    assert len(rows) == len(docs)
    for got, want in check(rows, docs).values():
        assert abs(got - want) <= 0.02 * want
    again = {r.doc_id: r.taken for r in QUERIES["op4_mixing"](spark, SF).collect()}
    assert again == {r.doc_id: r.taken for r in rows}


def test_hot_length_and_odd_rows(spark):
    docs = [(i, "w w w w", "hot") for i in range(400)] + [(400 + i, "a " * (i % 7), "b") for i in range(100)]
    docs += [(600, None, "b"), (601, "", None), (602, "x " * 30_000, None), (603, "y", None)]
    df = spark.createDataFrame([(*d, 1) for d in docs], "doc_id long, text string, source string, size int")
    rows = mix_sources(df).collect()
    assert len(rows) == len(docs)
    by = check(rows, docs)
    assert all(got <= want for got, want in by.values()) and by["hot"][0] > by["hot"][1] - 4
    odd = spark.createDataFrame([(None, "a b", "s"), (None, "a b", "s"), (5, "a", "s")], "doc_id long, text string, source string")
    assert sorted(r.size for r in mix_sources(odd).collect()) == [1, 2, 2]
    assert mix_sources(df.limit(0)).count() == 0
    assert defaultdict(int, {r.doc_id: r.taken for r in mix_sources(odd.where("doc_id = 9")).collect()}) == {}
