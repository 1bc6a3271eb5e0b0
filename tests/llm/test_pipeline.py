import re
from collections import Counter, defaultdict

import corpus_pipeline as cp
from tradewell.llm.common import stored, table
from test_mixing import check as check_mix
from test_ngram_join import brute
from test_sharding import check as check_shards

SF = "/root/testdata/sf0.001"


def test_stages_and_run(spark):
    docs = table(spark, SF, "documents")
    label = {r.doc_id: r.quality for r in table(spark, SF, "labels").collect()}
    items = [r.text for r in table(spark, SF, "benchmark").collect()]
    assert [n for n, _ in cp.STAGES] == ["quality", "near_copies", "decontaminated", "mixed", "sharded"]
    seen = {r.doc_id: r.text for r in docs.collect()}
    whole = dict(seen)

    good = stored(cp.quality(spark, docs, SF), "t")
    assert good.columns == docs.columns
    kept = {r.doc_id: r.text for r in good.collect()}
    clean = [i for i in seen if label.get(i) == 1]
    assert sum(i in kept for i in clean) >= 0.97 * len(clean)
    assert sum(i not in kept for i in seen if label.get(i) == 0) >= 0.5 * sum(label.get(i) == 0 for i in seen)

    one = stored(cp.near_copies(spark, good, SF), "t")
    comp = brute(kept)
    assert one.columns == docs.columns and sorted(r.doc_id for r in one.collect()) == sorted({c for _, c in comp.values()})
    kept = {r.doc_id: r.text for r in one.collect()}

    free = stored(cp.decontaminated(spark, one, SF), "t")
    left = {r.doc_id: r.text for r in free.collect()}
    assert free.columns == docs.columns
    assert not any(x in t for t in left.values() for x in items)
    gone = [i for i in kept if i not in left]
    assert all(any(x in kept[i] for x in items) for i in gone)

    mix = stored(cp.mixed(spark, free, SF), "t")
    assert mix.columns == docs.columns
    times = Counter(r.doc_id for r in mix.collect())
    assert set(times) <= set(left) and max(times.values()) <= 3
    rows = cp.mix_sources(free).collect()
    check_mix(rows, [(r.doc_id, r.text, r.source) for r in free.collect()])
    assert times == Counter({r.doc_id: r.copies for r in rows if r.copies})

    out = cp.sharded(spark, mix, SF).collect()
    assert len(out) == sum(times.values())
    slots = defaultdict(list)
    for r in out:
        slots[r.shard].append(r.slot)
        assert r.size == len(whole[r.doc_id].encode()) + 16
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    got = cp.run(spark, SF).collect()
    assert sorted((r.doc_id, r.shard) for r in got) == sorted((r.doc_id, r.shard) for r in out)


def test_odd_rows(spark):
    rows = [(None, None, None, None, 1), (None, "a b c", "en", "s", 1), (1, "", "en", None, 1), (2, "a b c d e f", "en", "s", 1),
            (2, "a b c d e f", "en", "s", 1), (3, "A b c d e f", "en", "s", 1), (4, "x y " * 20_000, "en", "t", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, id int")
    for data in (docs, docs.limit(0)):
        for name, stage in cp.STAGES:
            data = stored(stage(spark, data, SF), f"t-{name}")
    assert data.count() == 0
    one = cp.near_copies(spark, docs, SF).collect()
    assert sorted(r.doc_id or 0 for r in one) == [0, 0, 1, 2, 4]


def test_words():
    assert re.fullmatch("[a-z_]+", cp.STAGES[0][0])
    assert check_shards
