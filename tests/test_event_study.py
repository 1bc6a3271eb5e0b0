"""Event study: nearest bar (J4) against brute force, roll-up, labels."""

import datetime as dt

from pyspark.sql import functions as F

from tradewell.operators import event_study as ev
from tradewell.plans import fixtures as fx

D = dt.datetime


def bars_df(spark, rows):
    return spark.createDataFrame(rows, "ticker string, date date, close double")


def anchors_df(spark, rows):
    return spark.createDataFrame(rows, "ticker string, anchor_ts timestamp_ntz")


def test_nearest_cases(spark):
    bars = bars_df(spark, [("A", dt.date(2024, 1, 5), 10.0), ("A", dt.date(2024, 1, 6), 11.0),
                           ("A", dt.date(2024, 1, 8), 12.0), ("A", dt.date(2024, 1, 12), 13.0)])
    anchors = anchors_df(spark, [
        ("A", D(2024, 1, 5, 18, 0)),      # 18:00 is nearer the next midnight
        ("A", D(2024, 1, 5, 12, 0)),      # exact tie: earlier bar
        ("A", D(2024, 1, 1, 9, 0)),       # before the first bar
        ("A", D(2024, 1, 20, 9, 0)),      # after the last bar
        ("A", D(2024, 1, 7, 13, 0)),      # gap: 6th at 37h, 8th at 11h
        ("B", D(2024, 1, 5, 9, 0)),       # no bars at all
    ])
    got = {(r.anchor_ts, r.ticker): (r.bar_date, r.close) for r in ev.nearest_bar(anchors, bars).collect()}
    assert got[(D(2024, 1, 5, 18), "A")] == (dt.date(2024, 1, 6), 11.0)
    assert got[(D(2024, 1, 5, 12), "A")] == (dt.date(2024, 1, 5), 10.0)
    assert got[(D(2024, 1, 1, 9), "A")] == (dt.date(2024, 1, 5), 10.0)
    assert got[(D(2024, 1, 20, 9), "A")] == (dt.date(2024, 1, 12), 13.0)
    assert got[(D(2024, 1, 7, 13), "A")] == (dt.date(2024, 1, 8), 12.0)
    assert got[(D(2024, 1, 5, 9), "B")] == (None, None)


def test_nearest_equals_brute_force(spark):
    """Property on the smallest test tables: window result = exhaustive argmin."""
    events = fx.table(spark, "/root/testdata/sf0.001", "events")
    trades, prices = fx.event_trades(events), fx.event_prices(events)
    days = ev.day_rollup(trades)
    fast = {(r.ticker, r.filing_day): (r.bar_date, r.close) for r in ev.nearest_bar(days, prices).collect()}
    pairs = days.join(prices, "ticker").select(
        "ticker", "filing_day", "date", "close",
        F.abs(F.unix_micros(F.col("anchor_ts").cast("timestamp")) - F.unix_micros(F.col("date").cast("timestamp")))
        .alias("dist"))
    brute = {}
    for r in pairs.collect():
        k = (r.ticker, r.filing_day)
        if k not in brute or (r.dist, r.date) < brute[k][0]:
            brute[k] = ((r.dist, r.date), (r.date, r.close))
    assert brute and all(fast[k] == v[1] for k, v in brute.items())


def test_filters_and_rollup(spark):
    rows = [("A", D(2024, 1, 3, 9), dt.date(2024, 1, 2), "Doe", "CEO", "P - Purchase", 10.0, 5),
            ("A", D(2024, 1, 3, 15), dt.date(2024, 1, 3), "Roe", "Dir", "S - Sale", 11.0, -5),
            ("A", D(2024, 1, 4, 9), dt.date(2024, 1, 4), "Doe", "CEO", "S - Sale", 12.0, -1),
            ("A", D(2024, 1, 4, 9), dt.date(2024, 1, 4), "Doe", "CEO", "A - Grant", 12.0, 1),   # F3 drops
            ("a", D(2024, 1, 4, 9), dt.date(2024, 1, 4), "Doe", "CEO", "P - Purchase", 12.0, 1),  # other ticker
            ("A", D(2024, 1, 10, 9), dt.date(2024, 1, 4), "Doe", "CEO", "P - Purchase", 12.0, 1)]  # after end
    trades = spark.createDataFrame(rows, "ticker string, filing_ts timestamp_ntz, trade_date date, insider_name string, "
                                         "title string, trade_type string, price double, qty bigint")
    om = ev.open_market_trades(trades, D(2024, 1, 1), D(2024, 1, 10), tickers=["A"])
    assert om.count() == 3
    days = {r.filing_day: r for r in ev.day_rollup(om).collect()}
    assert days[dt.date(2024, 1, 3)].is_buy and days[dt.date(2024, 1, 3)].color == "green"
    assert days[dt.date(2024, 1, 3)].label_head == "Date: 2024-01-03 09:00:00"
    assert not days[dt.date(2024, 1, 4)].is_buy and days[dt.date(2024, 1, 4)].n_trades == 1
    lines = ev.label_lines(om).where(F.col("filing_day") == dt.date(2024, 1, 3)).orderBy(*ev.label_order()).collect()
    text = ev.render_label("Date: 2024-01-03 09:00:00", "2024-01-03 09:00:00", [r.line for r in lines])
    sep = "\n----------------------\n"
    assert text == ("Date: 2024-01-03 09:00:00" + sep + "TD: 2024-01-02\nTT: P - Purchase\nIN: Doe\nT: CEO\nP: 10.0 Qty: 5"
                    + sep + "Date: 2024-01-03 09:00:00" + sep
                    + "TD: 2024-01-03\nTT: S - Sale\nIN: Roe\nT: Dir\nP: 11.0 Qty: -5")


def test_event_study_offsets(spark):
    trades = spark.createDataFrame(
        [("A", D(2024, 1, d, 10), dt.date(2024, 1, d), "Doe", "CEO", "P - Purchase", 1.0, 1) for d in (3, 4, 5)],
        "ticker string, filing_ts timestamp_ntz, trade_date date, insider_name string, title string, "
        "trade_type string, price double, qty bigint")
    prices = bars_df(spark, [("A", dt.date(2024, 1, d), 100.0) for d in range(2, 8)])
    out = ev.event_study(trades, prices, D(2024, 1, 1), D(2024, 1, 31)).orderBy("anchor_ts").collect()
    assert [r.label_y for r in out] == [100.0 * 0.7, 100.0 * 1.2, 100.0 * 0.7]
    empty = ev.event_study(trades, bars_df(spark, []), D(2024, 1, 1), D(2024, 1, 31))
    assert empty.count() == 0


def test_nearest_per_trade_anchors_equal_brute_force(spark):
    """Raw per-trade anchors (many per day): same answer as exhaustive argmin."""
    events = fx.table(spark, "/root/testdata/sf0.001", "events")
    trades = fx.event_trades(events).select("ticker", "filing_ts")
    prices = fx.event_prices(events)
    fast = sorted((r.ticker, r.filing_ts, r.bar_date, r.close)
                  for r in ev.nearest_bar(trades, prices, ts_col="filing_ts").collect())
    bars = {}
    for r in prices.collect():
        bars.setdefault(r.ticker, []).append((r.date, r.close))
    brute = []
    for r in trades.collect():
        cands = bars.get(r.ticker, [])
        if not cands:
            brute.append((r.ticker, r.filing_ts, None, None))
            continue
        best = min(cands, key=lambda b: (abs((dt.datetime.combine(b[0], dt.time()) - r.filing_ts).total_seconds()), b[0]))
        brute.append((r.ticker, r.filing_ts, best[0], best[1]))
    assert fast == sorted(brute)


def test_per_day_path_equals_general_path(spark):
    events = fx.table(spark, "/root/testdata/sf0.001", "events")
    days = ev.day_rollup(fx.event_trades(events))
    prices = fx.event_prices(events)
    a = sorted(map(tuple, ev.nearest_bar(days, prices).collect()))
    b = sorted(map(tuple, ev.nearest_bar(days, prices, per_day=True).collect()))
    assert a == b and len(a) > 0


def test_price_csv_reader(spark, tmp_dir):
    import os
    from tradewell.sources.prices import read_price_csv
    d = os.path.join(tmp_dir, "prices")
    os.makedirs(d)
    with open(os.path.join(d, "aapl.csv"), "w") as f:
        f.write("Date,Open,High,Low,Close,Adj Close,Volume\n2024-01-02,1,2,0.5,185.64,185.1,100\n"
                "2024-01-03,1,2,0.5,184.25,183.9,100\nbad,1,2,0.5,1,1,1\n2024-01-04,1,2,0.5,n/a,1,1\n")
    with open(os.path.join(d, "MSFT.csv"), "w") as f:
        f.write("Date,Close\n2024-01-02 00:00:00,370.87\n")
    got = sorted(map(tuple, read_price_csv(spark, d).collect()))
    assert got == [("AAPL", dt.date(2024, 1, 2), 185.64), ("AAPL", dt.date(2024, 1, 3), 184.25),
                   ("MSFT", dt.date(2024, 1, 2), 370.87)]


def test_day_label_text_equals_rendered_lines(spark):
    """A hot day spans several range partitions and several blocks."""
    from tradewell.operators import event_study as ev
    n = 2 * ev.BLOCK + 7
    df = (spark.range(n + 40).selectExpr(
        "IF(id < %d, 'HOT', concat('T', id %% 3)) AS ticker" % n,
        "timestampadd(SECOND, CAST(id * 37 % 5000 AS INT), TIMESTAMP_NTZ '2024-01-05 10:00:00.5') AS filing_ts",
        "DATE'2024-01-03' AS trade_date", "concat('N', id % 5) AS insider_name", "'P - Purchase' AS trade_type", "CAST(id AS DOUBLE) AS price",
        "id AS qty", "'CEO' AS title"))
    got = {(r.ticker, r.filing_day): r.label for r in ev.day_label_text(df).collect()}
    lines, heads = {}, {}
    for r in ev.label_lines(df).collect():
        lines.setdefault((r.ticker, r.filing_day), []).append((r.line_no, r.line))
    for r in ev.day_rollup(df).collect():
        heads[r.ticker, r.filing_day] = r.label_head
    assert got == {k: ev.render_label(heads[k], heads[k].removeprefix("Date: "), [x for _, x in sorted(v)]) for k, v in lines.items()}
    assert ev.day_label_text(df.limit(0)).count() == 0
