"""Event study: insiders' filing days against the nearest daily close.

F2-F4  open-market trades (``P - Purchase`` / ``S - Sale``) of the chosen
       tickers, filed in ``[start, end]`` (both ends inclusive; ``end`` is a
       midnight, so filings later that day drop out, as in the reference).
A4/A5  one roll-up row per (ticker, filing day): the day's first filing time
       (the label anchor), trade count, and whether any trade is a purchase.
       The label text is kept *per trade line* (``label_lines``); a day's
       label is the concatenation of its lines in O1 order (``render_label``),
       done for the days being drawn, never as one unbounded group.
J4     nearest bar to each anchor, both directions, tie to the earlier bar:
       one window per ticker over distinct anchor days and bars (bounded by
       the calendar, not by the number of anchors), then an equi-join of the
       anchors on (ticker, day). No Cartesian product.
W3     alternating label offset: close x 0.7 on even, x 1.2 on odd positions.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tradewell.functions import scalars as S
from tradewell.session import written

# The two open-market trade types, and the separator of label blocks.
OPEN_MARKET = ["P - Purchase", "S - Sale"]
SEP = "\n----------------------\n"


def ntz_literal(t: dt.datetime) -> F.Column:
    """A wall-clock literal: text cast to timestamp_ntz, so neither the Python
    process zone nor the session zone moves it."""
    return F.lit(t.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp_ntz")


def open_market_trades(trades: DataFrame, start: dt.datetime | None = None, end: dt.datetime | None = None,
                       tickers: DataFrame | list[str] | None = None) -> DataFrame:
    """F2 + F3 + F4; an end that is None is open. ``tickers`` is a list, a one-column DataFrame
    (``ticker``) joined as a semi join, or None for all tickers."""
    df = trades.where(F.col("trade_type").isin(*OPEN_MARKET))
    if start is not None:
        df = df.where(F.col("filing_ts") >= ntz_literal(start))
    if end is not None:
        df = df.where(F.col("filing_ts") <= ntz_literal(end))
    if isinstance(tickers, list):
        df = df.where(F.col("ticker").isin(*tickers))
    elif tickers is not None:
        df = df.join(tickers.select("ticker"), "ticker", "left_semi")
    return df


def label_order():
    """O1: filing time ascending, trade date descending (NULL last), then
    stable tie-breakers (the reference relies on store order here)."""
    return [F.col("filing_ts").asc(), F.col("trade_date").desc_nulls_last(),
            F.col("insider_name").asc(), F.col("trade_type").asc(),
            F.col("price").asc(), F.col("qty").asc(), F.col("title").asc()]


def _line_text():
    def txt(c, null_text):
        return F.coalesce(F.col(c).cast("string"), F.lit(null_text))
    return F.concat(F.lit("TD: "), txt("trade_date", "NaT"), F.lit("\nTT: "), txt("trade_type", "None"),
                    F.lit("\nIN: "), txt("insider_name", "None"), F.lit("\nT: "), txt("title", "None"),
                    F.lit("\nP: "), F.coalesce(S.plain_number("price"), F.lit("nan")), F.lit(" Qty: "), txt("qty", "<NA>"))


def label_lines(trades: DataFrame) -> DataFrame:
    """One text block per trade, keyed by (ticker, filing_day), with its
    place ``line_no`` among the day's lines (O1)."""
    line = _line_text()
    day = F.to_date("filing_ts")
    place = F.row_number().over(Window.partitionBy("ticker", day).orderBy(*label_order()))
    return trades.select("ticker", day.alias("filing_day"), place.alias("line_no"), "filing_ts", "trade_date",
                         "trade_type", "insider_name", "title", "price", "qty", line.alias("line"))


BLOCK = 1024  # trades of one block of a label


def day_label_text(trades: DataFrame) -> DataFrame:
    """A4 + R19: the text of each (ticker, day), as ``render_label`` gives it.

    Two levels: the trades of a day are numbered without one task per day (range
    partitions of the O1 order, numbered within, and offsets by the counts of
    the partitions before), blocks of BLOCK lines are joined first, then a
    day's blocks. The text itself is one value, so a day must fit in a row."""
    spark = trades.sparkSession
    day = F.to_date("filing_ts")
    texts = trades.select("ticker", day.alias("filing_day"), "filing_ts", "trade_date", "insider_name", "trade_type", "price", "qty", "title",
                          _line_text().alias("line"))
    order = [F.col("ticker").asc(), F.col("filing_day").asc(), *label_order()]
    spread_out = texts.repartitionByRange(*order).sortWithinPartitions(*order)
    rows = written(spread_out.withColumn("part", F.spark_partition_id()).withColumn("at", F.monotonically_increasing_id()), "label-lines")
    # a part's rows of a day follow each other, so a difference of ids numbers them
    runs = rows.groupBy("ticker", "filing_day", "part").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n"), F.min("filing_ts").alias("ts"))
    w = Window.partitionBy("ticker", "filing_day").orderBy("part")
    runs = runs.select("ticker", "filing_day", "part", "first",
                       (F.sum("n").over(w) - F.col("n")).alias("before"), F.first("ts").over(w).alias("anchor_ts"))
    numbered = rows.join(runs.withColumnsRenamed({"ticker": "_t", "filing_day": "_d", "part": "_p"}),
                         F.col("ticker").eqNullSafe(F.col("_t")) & F.col("filing_day").eqNullSafe(F.col("_d")) & (F.col("part") == F.col("_p")))
    line_no = F.col("at") - F.col("first") + F.col("before")
    head = F.concat(F.lit("Date: "), S.py_ts_text("anchor_ts"))
    block = F.concat(F.lit(SEP), F.when(line_no > 0, F.concat(head, F.lit(SEP))).otherwise(F.lit("")), F.col("line"))
    lines = numbered.select("ticker", "filing_day", "anchor_ts", F.floor(line_no / BLOCK).alias("block"), line_no.alias("line_no"), block.alias("text"))
    joined = lambda key: F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(key, "text"))), lambda x: x["text"]), "")
    blocks = lines.groupBy("ticker", "filing_day", "anchor_ts", "block").agg(joined("line_no").alias("text"))
    days = blocks.groupBy("ticker", "filing_day", "anchor_ts").agg(joined("block").alias("text"))
    return days.select("ticker", "filing_day", F.concat(F.lit("Date: "), S.py_ts_text("anchor_ts"), F.col("text")).alias("label"))


def day_rollup(trades: DataFrame) -> DataFrame:
    """A4 + A5 (W4: consecutive date-sorted rows = grouping by day)."""
    g = (trades.groupBy("ticker", F.to_date("filing_ts").alias("filing_day"))
         .agg(F.min("filing_ts").alias("anchor_ts"),
              F.count(F.lit(1)).alias("n_trades"),
              F.bool_or(F.col("trade_type") == F.lit("P - Purchase")).alias("is_buy")))
    return g.select("ticker", "filing_day", "anchor_ts", "n_trades", "is_buy",
                    F.concat(F.lit("Date: "), S.py_ts_text("anchor_ts")).alias("label_head"),
                    F.when(F.col("is_buy"), F.lit("green")).otherwise(F.lit("red")).alias("color"))


def render_label(head: str, anchor_text: str, lines: list[str]) -> str:
    """The reference's label text from a day's lines in O1 order (Q21: later
    lines repeat the day's *first* time)."""
    out = head
    for i, ln in enumerate(lines):
        if i:
            out += SEP + f"Date: {anchor_text}"
        out += SEP + ln
    return out


def price_bars(prices: DataFrame, start: dt.datetime, end: dt.datetime) -> DataFrame:
    """Bars in ``[start, end)``."""
    return prices.where((F.col("date") >= F.lit(start.date())) & (F.col("date") < F.lit(end.date())))


def nearest_bar(anchors: DataFrame, bars: DataFrame, ts_col: str = "anchor_ts",
                per_day: bool = False) -> DataFrame:
    """Each anchor row gets ``bar_date`` and ``close`` of
    the bar whose midnight is nearest to ``ts_col``; a tie goes to the earlier
    bar; a ticker without bars gets NULLs. ``bars`` has one row per
    (ticker, date).

    Bars sit at midnight, so the two candidates of an anchor -- the last bar
    on or before its day and the first bar after it -- depend only on
    (ticker, day). The window runs over the distinct anchor days and the
    bars (both bounded by the calendar per ticker, however many anchors
    there are); anchors then take their candidates by an equi-join on
    (ticker, day) and keep the nearer one. ``per_day=True`` says the anchors
    already hold at most one row per (ticker, day) (e.g. the day roll-up):
    they then go into the window themselves, with no distinct and no join.
    """
    if per_day:
        rows = anchors.withColumn("_t", F.col(ts_col).cast("timestamp_ntz"))
        return _nearer(_neighbours(rows, bars), ts_col).select(*anchors.columns, "bar_date", "close")
    days = (anchors.select("ticker", F.to_date(F.col(ts_col)).alias("_day"))
            .where(F.col("_day").isNotNull()).distinct()
            .withColumn("_t", F.col("_day").cast("timestamp_ntz")))
    near = _neighbours(days, bars).select("ticker", "_day", "_prev", "_next")
    j = anchors.withColumn("_day", F.to_date(F.col(ts_col))).join(near, ["ticker", "_day"], "left")
    return _nearer(j, ts_col).select(*anchors.columns, "bar_date", "close")


def _neighbours(rows: DataFrame, bars: DataFrame) -> DataFrame:
    """Add ``_prev``, the last bar at or before ``_t``, and ``_next``, the first
    one after it. Linear in the rows of a
    ticker: every bar knows its successor (``lead``), and a running ``last``
    hands both on; rows before the first bar take the ticker's first bar."""
    bar = F.struct(F.col("date").alias("bar_date"), F.col("close"))
    by_date = Window.partitionBy("ticker").orderBy("date")
    b = bars.select("ticker", F.col("date").cast("timestamp_ntz").alias("_t"), F.lit(0).alias("_kind"),
                    F.struct(bar.alias("bar"), F.lead(bar).over(by_date).alias("after")).alias("_both"))
    both = b.schema["_both"].dataType
    a = rows.withColumn("_kind", F.lit(1)).withColumn("_both", F.lit(None).cast(both))
    w = Window.partitionBy("ticker").orderBy("_t", "_kind")
    held = F.last("_both", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    first = F.min(F.col("_both.bar")).over(Window.partitionBy("ticker"))
    u = (a.unionByName(b, allowMissingColumns=True).select("*", held.alias("_held"), first.alias("_first"))
         .where(F.col("_kind") == 1))
    return u.select(*rows.columns, F.col("_held.bar").alias("_prev"),
                    F.when(F.col("_held").isNull(), F.col("_first"))
                    .otherwise(F.col("_held.after")).alias("_next"))


def _nearer(rows: DataFrame, ts_col: str) -> DataFrame:
    """The nearer of ``_prev`` and ``_next``; a tie goes to the earlier bar."""
    t = F.col(ts_col).cast("timestamp_ntz")
    d_prev = S.micros_between(t, F.col("_prev.bar_date").cast("timestamp_ntz"))
    d_next = S.micros_between(t, F.col("_next.bar_date").cast("timestamp_ntz"))
    pick = (F.when(F.col("_next").isNull(), F.col("_prev"))
            .when(F.col("_prev").isNull(), F.col("_next"))
            .when(d_prev <= d_next, F.col("_prev")).otherwise(F.col("_next")))
    return rows.withColumn("bar_date", pick.getField("bar_date")).withColumn("close", pick.getField("close"))


def event_study(trades: DataFrame, prices: DataFrame, start: dt.datetime, end: dt.datetime,
                tickers=None) -> DataFrame:
    """F2-F4 -> A4/A5 -> J4 -> W3/R20: one row per (ticker, filing day)."""
    om = open_market_trades(trades, start, end, tickers)
    days = day_rollup(om)
    bars = price_bars(prices, start, end)
    if tickers is not None:
        bars = (bars.where(F.col("ticker").isin(*tickers)) if isinstance(tickers, list)
                else bars.join(tickers.select("ticker"), "ticker", "left_semi"))
    j = nearest_bar(days, bars, per_day=True).where(F.col("close").isNotNull())
    w = Window.partitionBy("ticker").orderBy("anchor_ts")
    parity = ((F.row_number().over(w) - 1) % 2).cast("double")
    return j.select("*", (F.col("close") * (F.lit(0.7) + F.lit(0.5) * parity)).alias("label_y"))
