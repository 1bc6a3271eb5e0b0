"""The command line over landed files: filings -> store -> event study."""

import datetime as dt
import json
import re
import os

from tradewell import cli
from tradewell.sources.sec import compact_corpus
from tradewell.sources.store import read_store

from test_filings import EXAMPLE, doc, tx
from test_screener import ROW1, ROW2, page


def _land(tmp_dir):
    base = os.path.join(tmp_dir, "in")
    os.makedirs(os.path.join(base, "index"))
    with open(os.path.join(base, "tickers.json"), "w") as f:
        json.dump({"0": {"cik_str": 320193, "ticker": "AAPL"}}, f)
    with open(os.path.join(base, "index", "CIK0000320193.json"), "w") as f:
        json.dump({"filings": {"recent": {"accessionNumber": ["0000320193-24-000002", "0000320193-24-000001"],
                                          "form": ["4", "4"], "filingDate": ["2024-01-06", "2024-01-05"]}}}, f)
    docs = {"0000320193-24-000001": doc(EXAMPLE),
            "0000320193-24-000002": doc([tx("2024-01-05", "P", "10", "20", "A")], accept="20240106100000")}
    for acc, body in docs.items():
        os.makedirs(os.path.join(base, "landing", "0000320193"), exist_ok=True)
        with open(os.path.join(base, "landing", "0000320193", f"{acc}.txt"), "w") as f:
            f.write(body)
    return base


def test_filings_then_event_study(spark, tmp_dir):
    base = _land(tmp_dir)
    cli.main(["compact", os.path.join(base, "landing") + "/*", os.path.join(base, "corpus")])
    store = os.path.join(tmp_dir, "store")
    common = ["--dictionary", os.path.join(base, "tickers.json"), "--index", os.path.join(base, "index"),
              "--corpus", os.path.join(base, "corpus"), "-s", store]
    args = cli.parser().parse_args(["filings", " aapl "] + common)
    rep = cli.run_filings(spark, args)
    assert rep.verb == "Merged" and rep.rows == 2
    rep = cli.run_filings(spark, cli.parser().parse_args(["filings", "AAPL", "-l", "1", "-r"] + common))
    assert rep.verb == "Rewrote" and rep.rows == 1            # newest filing only
    assert [r.accession for r in read_store(spark, store).collect()] == ["0000320193-24-000002"]
    cli.run_filings(spark, cli.parser().parse_args(["filings", "AAPL", "-d"] + common))
    assert read_store(spark, store).count() == 3              # by date: the Dec/Jan sale split in two

    prices = os.path.join(tmp_dir, "prices")
    spark.createDataFrame([("AAPL", dt.date(2024, 1, d), 100.0 + d) for d in range(1, 10)],
                          "ticker string, date date, close double").write.parquet(prices)
    ev = cli.run_event_study(spark, cli.parser().parse_args(
        ["event-study", "AAPL", "-sd", "2024-01-01", "-ed", "2024-01-31", "-s", store, "--prices", prices]))
    got = sorted((r.filing_day, r.bar_date, r.is_buy) for r in ev.collect())
    # 16:30 on the 5th is nearer the 6th's midnight; 10:00 on the 6th nearer the 6th
    assert got == [(dt.date(2024, 1, 5), dt.date(2024, 1, 6), False), (dt.date(2024, 1, 6), dt.date(2024, 1, 6), True)]
    default = cli.run_event_study(spark, cli.parser().parse_args(
        ["event-study", "AAPL", "-sd", "bad-date", "-s", store, "--prices", prices]), now=dt.datetime(2024, 6, 1))
    assert default.count() == 2                               # bad start falls back to a year before now
    lines = cli.run_label_lines(spark, cli.parser().parse_args(
        ["event-study", "AAPL", "-sd", "2024-01-01", "-ed", "2024-01-31", "-s", store, "--prices", prices]))
    assert lines.count() == read_store(spark, store).count()  # one line per open-market trade
    assert all(r.line.startswith("TD: ") for r in lines.collect())


def test_screener_cli(spark, tmp_dir):
    pages = os.path.join(tmp_dir, "pages")
    spark.createDataFrame([("aapl", page(ROW1, ROW2)), ("MSFT", page(ROW1))], "ticker string, html string") \
        .write.parquet(pages)
    store = os.path.join(tmp_dir, "store")
    rep = cli.run_screener(spark, cli.parser().parse_args(["screener", "AAPL", "-n", "4", "--pages", pages,
                                                           "-s", store]))
    assert rep.rows == 2
    rep = cli.run_screener(spark, cli.parser().parse_args(["screener", "AAPL", "--pages", pages, "-s", store]))
    assert read_store(spark, store).count() == 2              # merge: nothing new


def test_corpus_partitions_are_pruned(spark, tmp_dir):
    from tradewell.operators.resolve import select_documents
    from tradewell.sources.sec import read_corpus
    base = _land(tmp_dir)
    compact_corpus(spark, os.path.join(base, "landing") + "/*", os.path.join(base, "corpus2"))
    corpus = read_corpus(spark, os.path.join(base, "corpus2"))
    index = spark.createDataFrame([("0000320193", "0000320193-24-000001")], "cik string, accession string")
    ciks = spark.createDataFrame([("0000320193",)], "cik string")
    docs = select_documents(ciks, index, corpus)
    plan = docs._jdf.queryExecution().executedPlan().toString()
    # the join carries the partition column, so the join itself tells Spark which partitions it needs
    assert re.search(r"(BroadcastHashJoin|SortMergeJoin|ShuffledHashJoin)[^\n]*cik_hash", plan)
    assert [r.accession for r in docs.collect()] == ["0000320193-24-000001"]
