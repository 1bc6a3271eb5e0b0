import zlib

import numpy as np

from tradewell.llm.common import table
from tradewell.llm.quality_classifier import score_quality
from tradewell.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    label = {r.doc_id: r.quality for r in table(spark, SF, "labels").collect()}
    rows = QUERIES["op6_quality_classifier"](spark, SF).collect()
    assert len(rows) == table(spark, SF, "documents").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    held = [(label[r.doc_id], r.score) for r in rows if r.held_out and r.doc_id in label]
    good = np.mean([(s >= 0.5) == (y == 1) for y, s in held])
    pos, neg = [s for y, s in held if y], [s for y, s in held if not y]
    auc = np.mean([p > n for p in pos for n in neg])
    print("held out", len(held), "accuracy", good, "auc", auc)
    assert good > 0.95 and auc > 0.97
    again = {r.doc_id: r.score for r in QUERIES["op6_quality_classifier"](spark, SF).collect()}
    assert again == {r.doc_id: r.score for r in rows}


def test_odd_rows(spark):
    rows = [(i, "good words in a row " * 5, 1) for i in range(30)] + [(50 + i, "## $$ !! " * 20, 1) for i in range(30)]
    rows += [(None, None, 1), (200, "", 1), (201, "good words " * 40_000, 1), (201, "good words " * 40_000, 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, score int")
    lab = spark.createDataFrame([(i, 1, 0) for i in range(30)] + [(50 + i, 0, 0) for i in range(30)] + [(None, 1, 0), (7, None, 0)],
                                "doc_id long, quality int, text int")
    got = score_quality(df, lab).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r.predicted for r in got}
    assert by[3] == 1 and by[55] == 0 and by[201] == 1
    assert score_quality(df.limit(0), lab).count() == 0
    assert {r.score for r in score_quality(df, lab.limit(0)).collect()} == {0.5}
