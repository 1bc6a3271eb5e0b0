"""Command line with the reference tools' options, over landed inputs.

  python -m tradewell.cli filings  [SYMBOL ...] [-f FILE] [-s STORE] [-d] [-l N] [-a | -r]
                                   --dictionary JSON --index DIR --corpus PARQUET
  python -m tradewell.cli screener [SYMBOL ...] [-f FILE] [-s STORE] [-a | -r] --pages PARQUET
  python -m tradewell.cli compact  SRC_GLOB DST      (landed <cik>/<accession>.txt -> corpus Parquet)
  python -m tradewell.cli event-study TICKER [-sd YYYY-MM-DD] [-ed YYYY-MM-DD] [-s STORE]
                                   --prices PATH [--prices-format parquet|csv] [--out PARQUET]

Every job runs on Spark; nothing but the save report is brought to the
driver. ``-n`` is accepted and ignored: Spark decides the parallelism.
"""

from __future__ import annotations

import argparse
import datetime as dt
import os
import sys

from pyspark.sql import functions as F

from tradewell.functions.scalars import parse_param_date, symbol
from tradewell.operators.combine import HEADER_COLS, combine_with_rejects
from tradewell.operators.event_study import event_study, label_lines, open_market_trades
from tradewell.operators.filings import filing_items, split_items
from tradewell.operators.resolve import limit_filings, resolve_ciks, select_documents, unresolved
from tradewell.operators.screener import page_items, page_rejects, screener_trades
from tradewell.session import drop_written, get_spark, spread, written
from tradewell.sinks.store import resolve_mode, save_trades
from tradewell.sources.prices import read_price_csv, read_price_table
from tradewell.sources.screener import read_pages
from tradewell.sources.sec import (compact_corpus, form4_only, read_corpus, read_filing_index,
                                   read_filing_index_rejects, read_ticker_dictionary)
from tradewell.sources.store import read_store
from tradewell.sources.watchlist import clean_watchlist, read_watchlist_file, watchlist_from_params

# Defaults may come from the environment (store path LINK, CSV separator
# CSV_SEP); the command-line options override them.
DEFAULT_STORE = os.environ.get("LINK", "scrapes")
DEFAULT_SEP = os.environ.get("CSV_SEP", ";")


def _store_args(p: argparse.ArgumentParser):
    p.add_argument("-s", dest="store", default=DEFAULT_STORE, help="store path (or table name)")
    p.add_argument("--format", default="parquet", choices=["parquet", "csv", "table"])
    p.add_argument("--sep", default=DEFAULT_SEP, help="CSV separator")
    g = p.add_mutually_exclusive_group()
    g.add_argument("-a", "--append", action="store_true", help="append without deduplication")
    g.add_argument("-r", "--rewrite", action="store_true", help="replace the store")


def _watch(spark, args):
    lists = []
    if args.f:
        lists.append(read_watchlist_file(spark, args.f))
    if args.symbols:
        lists.append(watchlist_from_params(spark, args.symbols))
    if not lists:
        raise SystemExit("no symbols given")
    return clean_watchlist(*lists)


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="tradewell")
    sub = p.add_subparsers(dest="cmd", required=True)

    f = sub.add_parser("filings", help="Form 4 filings -> combined trades -> store")
    f.add_argument("symbols", nargs="*", help="tickers or CIKs")
    f.add_argument("-f", help="file with one ticker or CIK per line")
    f.add_argument("-d", action="store_true", help="do not combine trades of different dates")
    f.add_argument("-l", type=int, default=None, help="filing limit per CIK (0 or absent: none)")
    f.add_argument("--signed-value", action="store_true",
                   help="give Value the sign of Qty, as screener rows carry it")
    f.add_argument("--dictionary", required=True)
    f.add_argument("--index", required=True)
    f.add_argument("--corpus", required=True)
    f.add_argument("--partitions", type=int, help="spread the parsing over N tasks (default: the scan's splits)")
    f.add_argument("--rejects", help="folder for rejects and unresolved symbols (default: <store>_rejects)")
    _store_args(f)

    s = sub.add_parser("screener", help="screener pages -> trades -> store")
    s.add_argument("symbols", nargs="*")
    s.add_argument("-f")
    s.add_argument("-n", "--processes", type=int, help="ignored: Spark sets the parallelism")
    s.add_argument("--pages", required=True, help="Parquet with ticker, html, or landed pages (a pattern ending in .html or .htm)")
    s.add_argument("--rejects", help="folder for pages and rows that give no trade (default: <store>_rejects)")
    s.add_argument("--partitions", type=int, help="spread the parsing over N tasks (default: the scan's splits)")
    _store_args(s)

    c = sub.add_parser("compact", help="landed submission texts -> corpus Parquet")
    c.add_argument("src", help="e.g. landing/*  (files <cik>/<accession>.txt)")
    c.add_argument("dst")

    e = sub.add_parser("event-study", help="filing days against the nearest close")
    e.add_argument("tickers", nargs="+")
    e.add_argument("-sd", help="start date YYYY-MM-DD (default: a year before now)")
    e.add_argument("-ed", help="end date YYYY-MM-DD (default: now)")
    e.add_argument("-s", dest="store", default=DEFAULT_STORE)
    e.add_argument("--format", default="parquet", choices=["parquet", "csv", "table"])
    e.add_argument("--sep", default=DEFAULT_SEP, help="CSV separator")
    e.add_argument("--prices", required=True, help="Parquet with ticker, date, close, or a folder of <TICKER>.csv")
    e.add_argument("--prices-format", default="parquet", choices=["parquet", "csv"])
    e.add_argument("--out", help="write the result here (Parquet); default: show it")
    e.add_argument("--lines-out", help="also write the label lines (one per trade, with O1 sort keys)")
    return p


def run_filings(spark, args):
    watch = _watch(spark, args)
    ciks = resolve_ciks(watch, read_ticker_dictionary(spark, args.dictionary))
    index = limit_filings(form4_only(read_filing_index(spark, args.index)), args.l)
    docs = spread(select_documents(ciks, index, read_corpus(spark, args.corpus)), args.partitions)
    items = written(filing_items(docs, ["cik", "accession"]), "filing-items")  # one parse for trades and rejects
    tx, bad = split_items(items, ["cik", "accession"])
    # a filing that lies under issuer and owner is combined once for each CIK
    trades, lost = combine_with_rejects(tx, by_date=args.d, header_cols=HEADER_COLS,
                                        filing_key=["cik", "accession"], signed_value=args.signed_value)
    rejects = (bad.unionByName(lost, allowMissingColumns=True)
               .unionByName(read_filing_index_rejects(spark, args.index), allowMissingColumns=True)
               .unionByName(unresolved(watch, read_ticker_dictionary(spark, args.dictionary))
                            .withColumn("reject", F.lit("unresolved symbol")), allowMissingColumns=True))
    rejects.write.mode("append").parquet(args.rejects or f"{args.store.rstrip('/')}_rejects")
    report = save_trades(trades, args.store, mode=resolve_mode(args.append, args.rewrite),
                         fmt=args.format, sep=args.sep)
    drop_written(items)
    return report


def run_screener(spark, args):
    watch = _watch(spark, args)
    pages = read_pages(spark, args.pages).withColumn("ticker", symbol("ticker"))
    pages = pages.join(watch.withColumnRenamed("symbol", "ticker"), "ticker", "left_semi")
    pages = spread(pages, args.partitions).withColumnRenamed("ticker", "page_ticker")
    # trades and rejects come from one parse of the pages
    items = written(page_items(pages, ["page_ticker"]), "screener-items")
    rows = screener_trades(items.where("reject IS NULL"), ["page_ticker"], sep=args.sep)
    page_rejects(items, ["page_ticker"]).write.mode("append").parquet(args.rejects or f"{args.store.rstrip('/')}_rejects")
    report = save_trades(rows, args.store, mode=resolve_mode(args.append, args.rewrite),
                         fmt=args.format, sep=args.sep)
    drop_written(items)
    return report


def _range(args, now: dt.datetime | None):
    now = now or dt.datetime.now()
    return parse_param_date(args.sd, now - dt.timedelta(days=365)), parse_param_date(args.ed, now)


def _stored_trades(spark, args, start: dt.datetime, end: dt.datetime):
    """The store's rows of the months of the range (other partitions are not read)."""
    first, n = start.year * 12 + start.month - 1, (end.year - start.year) * 12 + end.month - start.month
    months = [f"{m // 12:04d}-{m % 12 + 1:02d}" for m in range(first, first + n + 1)]
    return read_store(spark, args.store, fmt=args.format, sep=args.sep, months=months)


def run_label_lines(spark, args, now: dt.datetime | None = None):
    """Label lines of the chosen tickers and range: a day's label is its
    lines in O1 order (``event_study.render_label``)."""
    start, end = _range(args, now)
    om = open_market_trades(_stored_trades(spark, args, start, end), start, end, list(args.tickers))
    return label_lines(om)


def run_event_study(spark, args, now: dt.datetime | None = None):
    start, end = _range(args, now)
    trades = _stored_trades(spark, args, start, end)
    prices = (read_price_csv(spark, args.prices) if args.prices_format == "csv"
              else read_price_table(spark, args.prices))
    return event_study(trades, prices, start, end, tickers=list(args.tickers))


def main(argv=None) -> int:
    args = parser().parse_args(argv)
    spark = get_spark()
    if args.cmd == "filings":
        print(run_filings(spark, args))
    elif args.cmd == "screener":
        print(run_screener(spark, args))
    elif args.cmd == "compact":
        compact_corpus(spark, args.src, args.dst)
    else:
        out = run_event_study(spark, args)
        if args.lines_out:
            run_label_lines(spark, args).write.mode("overwrite").parquet(args.lines_out)
        if args.out:
            out.write.mode("overwrite").parquet(args.out)
        else:
            n = out.count()
            out.orderBy("ticker", "anchor_ts").show(50, truncate=False)
            if n > 50:
                print(f"the first 50 of {n} rows; --out writes them all")
    return 0


if __name__ == "__main__":
    sys.exit(main())
