"""Queries for the event study: S11, F2-F4, O1, A4, A5, W3-W5, J4, A7, O3,
R19, R20, R23."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tradewell.operators import event_study as ev
from tradewell.plans import fixtures as fx
from tradewell.plans.registry import register

START = dt.datetime(2024, 1, 3)
END = dt.datetime(2024, 1, 28)     # midnight: filings later on the 28th drop out

_T = {k: v for k, v in fx.EVENT_TRADE_SQL.items()}
_T["ticker"] = "printf('U%03d', user_id)"
_T["trade_date"] = "CAST(ts AS DATE) - CAST(event_id % 3 AS INTEGER)"
_TRADES_SQL = "SELECT " + ", ".join(f"{v} AS {k}" for k, v in _T.items()) + " FROM events WHERE event_type <> 'view'"
_ALL_SQL = f"SELECT * FROM ({_TRADES_SQL}) WHERE trade_type IN ('P - Purchase', 'S - Sale')"
_OM_SQL = f"{_ALL_SQL} AND filing_ts >= TIMESTAMP '{START}' AND filing_ts <= TIMESTAMP '{END}'"
_BARS_SQL = (f"SELECT printf('U%03d', user_id) AS ticker, CAST(ts AS DATE) AS date, arg_max(value, ts) AS close "
             f"FROM events WHERE event_type = 'view' GROUP BY ALL")
_BARS_IN_SQL = f"SELECT * FROM ({_BARS_SQL}) WHERE date >= DATE '{START.date()}' AND date < DATE '{END.date()}'"
_TS_TEXT = ("CASE WHEN microsecond(anchor_ts) % 1000000 <> 0 THEN strftime(anchor_ts, '%Y-%m-%d %H:%M:%S.%f') "
            "ELSE strftime(anchor_ts, '%Y-%m-%d %H:%M:%S') END")


def _days_sql(trades):
    return f"""
SELECT ticker, filing_day, anchor_ts, n_trades, is_buy, 'Date: ' || {_TS_TEXT} AS label_head,
       CASE WHEN is_buy THEN 'green' ELSE 'red' END AS color
FROM (SELECT ticker, CAST(filing_ts AS DATE) AS filing_day, min(filing_ts) AS anchor_ts,
             count(*) AS n_trades, bool_or(trade_type = 'P - Purchase') AS is_buy
      FROM ({trades}) GROUP BY ALL)"""


def _nearest_sql(trades, bars):
    return f"""
SELECT ticker, filing_day, anchor_ts, n_trades, is_buy, label_head, color, bar_date, close FROM (
  SELECT d.*, b.date AS bar_date, b.close,
         row_number() OVER (PARTITION BY d.ticker, d.filing_day
                            ORDER BY abs(epoch_us(d.anchor_ts) - epoch_us(CAST(b.date AS TIMESTAMP))), b.date) AS rn
  FROM ({_days_sql(trades)}) d JOIN ({bars}) b ON d.ticker = b.ticker) WHERE rn = 1"""


def _om(spark, sf_dir, start=None, end=None, tickers=None):
    return ev.open_market_trades(fx.event_trades(fx.table(spark, sf_dir, "events")), start, end, tickers)


def _bars(spark, sf_dir):
    return ev.price_bars(fx.event_prices(fx.table(spark, sf_dir, "events")), START, END)


@register("open_market_trades", _OM_SQL)
def open_market_trades_q(spark, sf_dir):
    return _om(spark, sf_dir, START, END)


# chosen tickers, as a table: every ticker with a gift ('error' events)
_CHOSEN_SQL = "SELECT DISTINCT printf('U%03d', user_id) AS ticker FROM events WHERE event_type = 'error'"


def _chosen(spark, sf_dir):
    events = fx.table(spark, sf_dir, "events").where("event_type = 'error'")
    return events.select(F.expr(fx.EVENT_TRADE_SQL["ticker"]).alias("ticker")).distinct()


@register("chosen_ticker_trades", f"{_OM_SQL} AND ticker IN ({_CHOSEN_SQL})")
def chosen_ticker_trades_q(spark, sf_dir):
    return _om(spark, sf_dir, START, END, _chosen(spark, sf_dir))


@register("price_bars", _BARS_IN_SQL)
def price_bars_q(spark, sf_dir):
    return _bars(spark, sf_dir)


@register("day_labels", _days_sql(_ALL_SQL))
def day_labels_q(spark, sf_dir):
    return ev.day_rollup(_om(spark, sf_dir))


@register("day_label_lines", f"""
SELECT ticker, CAST(filing_ts AS DATE) AS filing_day, filing_ts, trade_date,
       CAST(row_number() OVER (PARTITION BY ticker, CAST(filing_ts AS DATE)
            ORDER BY filing_ts, trade_date DESC NULLS LAST, insider_name, trade_type, price, qty, title) AS INTEGER) AS line_no,
       'TD: ' || coalesce(CAST(trade_date AS STRING), 'NaT') || chr(10) || 'TT: ' || trade_type || chr(10) ||
       'IN: ' || insider_name || chr(10) || 'T: ' || title || chr(10) || 'P: ' || CAST(price AS STRING) ||
       ' Qty: ' || CAST(qty AS STRING) AS line
FROM ({_ALL_SQL})""")
def day_label_lines_q(spark, sf_dir):
    return ev.label_lines(_om(spark, sf_dir)).select(
        "ticker", "filing_day", "filing_ts", "trade_date", "line_no", "line")


@register("day_direction", f"SELECT ticker, filing_day, is_buy, color FROM ({_days_sql(_ALL_SQL)})")
def day_direction_q(spark, sf_dir):
    return ev.day_rollup(_om(spark, sf_dir)).select("ticker", "filing_day", "is_buy", "color")


@register("nearest_bar", _nearest_sql(_ALL_SQL, _BARS_SQL))
def nearest_bar_q(spark, sf_dir):
    bars = fx.event_prices(fx.table(spark, sf_dir, "events"))
    return ev.nearest_bar(ev.day_rollup(_om(spark, sf_dir)), bars, per_day=True).where(F.col("close").isNotNull())


@register("event_study", f"""
SELECT *, close * (CAST(0.7 AS DOUBLE) + CAST(0.5 AS DOUBLE)
        * CAST((row_number() OVER (PARTITION BY ticker ORDER BY anchor_ts) - 1) % 2 AS DOUBLE)) AS label_y
FROM ({_nearest_sql(_OM_SQL, _BARS_IN_SQL)})""")
def event_study_q(spark, sf_dir):
    events = fx.table(spark, sf_dir, "events")
    return ev.event_study(fx.event_trades(events), fx.event_prices(events), START, END)


# The text of a day's label
@register("day_label_text", f"""
SELECT ticker, filing_day, 'Date: ' || head || string_agg(chr(10) || '----------------------' || chr(10) ||
         CASE WHEN line_no > 1 THEN 'Date: ' || head || chr(10) || '----------------------' || chr(10) ELSE '' END || line, '' ORDER BY line_no) AS label
FROM (SELECT ticker, CAST(filing_ts AS DATE) AS filing_day,
             min(strftime(filing_ts, '%Y-%m-%d %H:%M:%S') || CASE WHEN microsecond(filing_ts) % 1000000 <> 0
                 THEN '.' || lpad(CAST(microsecond(filing_ts) % 1000000 AS VARCHAR), 6, '0') ELSE '' END)
               OVER (PARTITION BY ticker, CAST(filing_ts AS DATE)) AS head,
             row_number() OVER (PARTITION BY ticker, CAST(filing_ts AS DATE)
               ORDER BY filing_ts, trade_date DESC NULLS LAST, insider_name, trade_type, price, qty, title) AS line_no,
             'TD: ' || coalesce(CAST(trade_date AS STRING), 'NaT') || chr(10) || 'TT: ' || trade_type || chr(10) ||
             'IN: ' || insider_name || chr(10) || 'T: ' || title || chr(10) || 'P: ' || CAST(price AS STRING) ||
             ' Qty: ' || CAST(qty AS STRING) AS line
      FROM ({_ALL_SQL}))
GROUP BY ticker, filing_day, head""")
def day_label_text_q(spark, sf_dir):
    return ev.day_label_text(_om(spark, sf_dir))
