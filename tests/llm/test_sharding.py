import random
import zlib
from collections import defaultdict

import pytest

from tradewell.llm import sharding
from tradewell.llm.common import table
from tradewell.llm.queries import QUERIES
from tradewell.llm.sharding import shard_contiguous

SF = "/root/testdata/sf0.001"


def least_capacity(sizes, n):
    def fits(cap):
        used, load = 1, 0
        for s in sizes:
            if s > cap:
                return False
            if load + s > cap:
                used, load = used + 1, 0
            load += s
        return used <= n
    lo, hi = 0, sum(sizes)
    while hi - lo > 1:
        mid = (lo + hi) // 2
        lo, hi = (lo, mid) if fits(mid) else (mid, hi)
    return hi


def check(rows, texts, n):
    import hashlib
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    load, slots, where, group = defaultdict(int), defaultdict(list), defaultdict(set), defaultdict(int)
    for r in rows:
        t = texts[r.doc_id]
        raw = (t or "").encode()
        assert r.size == len(raw) + 16 and r.law == "bytes" and r.grown_shard is None and 0 <= r.shard < n
        assert r.text_crc32 == (None if t is None else zlib.crc32(raw))
        load[r.shard] += r.size
        slots[r.shard].append(r.slot)
        where[t].add(r.shard)
        group["" if t is None else hashlib.md5(raw).hexdigest()] += r.size
    assert all(len(s) == 1 for s in where.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(load.values()) == least_capacity([group[k] for k in sorted(group)], n)
    return load


@pytest.mark.parametrize("cells", [16384, 8])
def test_query(spark, monkeypatch, cells):
    monkeypatch.setattr(sharding, "CELLS", cells)
    texts = {r.doc_id: r.text for r in table(spark, SF, "documents").collect()}
    check(QUERIES["op1_sharding"](spark, SF).collect(), texts, 40)


def test_hot_group_leaves_no_shard_empty(spark):
    rnd = random.Random(3)
    texts = {i: "hot " * 20 if i % 3 == 0 else "x" * rnd.randrange(1, 80) + str(i) for i in range(600)}
    texts |= {1: None, 2: None, 4: "", 5: "long " * 1000}
    df = spark.createDataFrame([(i, t, "q") for i, t in texts.items()], "doc_id long, text string, part string")
    load = check(shard_contiguous(df, 7).collect(), texts, 7)
    assert len(load) == 7


def test_odd_rows(spark):
    df = spark.createDataFrame([(None, "a", 1), (None, "a", 2), (3, None, 3), (3, None, 3)],
                               "doc_id long, text string, size int")
    got = shard_contiguous(df, 3).collect()
    assert len(got) == 4 and len({r.shard for r in got if r.doc_id is None}) == 1
    assert shard_contiguous(df.limit(0), 3).collect() == []
    assert {r.shard for r in shard_contiguous(df, 1).collect()} == {0}
