"""Queries for the filing path: S9, P5-P9, F6-F8, F10, R7-R9, R22 + A1."""

from __future__ import annotations

from pyspark.sql import functions as F

from tradewell.operators.combine import AMOUNT_REASON, combine_transactions, combine_with_rejects
from tradewell.operators.dedup import dedup_keep_first
from tradewell.operators.filings import CUT_REASON, REASONS, TX_REASONS, filing_items, parse_filings, split_items
from tradewell.plans import fixtures as fx
from tradewell.plans import oracle as o
from tradewell.plans.registry import register
from tradewell.session import written
from tradewell.sources.sec import corpus_rows

# DuckDB spellings of the few fixture expressions that differ from Spark's.
_DUCK = {
    "accession": "printf('%010d-%02d-%06d', o_custkey, year(o_orderdate) % 100, o_orderkey)",
    "cik": "printf('%010d', o_custkey)",
    "filing_ts": "o_orderdate + to_seconds(CAST(o_orderkey % 86400 AS BIGINT))",
    "ticker": "printf('CUSTOMER#%09d', o_custkey)",
}


def _d(k):
    return _DUCK.get(k) or fx.FILING_SQL.get(k) or fx.LINE_SQL[k]


from tradewell.operators.combine import HEADER_COLS as HEADER  # noqa: E402
OUT = ["accession", "x_flag", "filing_ts", "ticker", "insider_name", "title", "trade_type",
       "trade_date", "price", "qty", "value"]

_TX_SQL = f"""
SELECT {_d('accession')} AS accession,
       CASE WHEN o_orderstatus = 'P' THEN 'D' ELSE '' END AS x_flag,
       {_d('filing_ts')} AS filing_ts, {_d('ticker')} AS ticker,
       {o.normalize_name(_d('owner'))} AS insider_name,
       {o.owner_title(_d('is_officer'), _d('officer_title'), _d('is_director'), _d('is_ten_pct'), _d('remarks'))} AS title,
       {o.trade_type(_d('code'))} AS trade_type, {_d('a_d')} AS a_d,
       CAST(l_shipdate AS DATE) AS trade_date,
       CASE WHEN {_d('footnote_price')} THEN 0.0 ELSE l_extendedprice END AS price,
       {o.signed_qty('CASE WHEN l_linenumber = 6 THEN 0 ELSE CAST(l_quantity AS BIGINT) END', _d('a_d'))} AS qty
FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""


def filing_trades(spark, sf_dir, by_date=False):
    docs = fx.filing_documents(fx.table(spark, sf_dir, "orders"), fx.table(spark, sf_dir, "lineitem"))
    tx, _ = parse_filings(docs)
    return combine_transactions(tx, by_date=by_date, header_cols=HEADER).select(*OUT)


@register("filing_xml_to_trades", f"SELECT {', '.join(OUT)} FROM ({o.combine(_TX_SQL, False, HEADER)})")
def filing_xml_to_trades(spark, sf_dir):
    return filing_trades(spark, sf_dir, by_date=False)


@register("filing_xml_to_trades_by_date", f"SELECT {', '.join(OUT)} FROM ({o.combine(_TX_SQL, True, HEADER)})")
def filing_xml_to_trades_by_date(spark, sf_dir):
    return filing_trades(spark, sf_dir, by_date=True)


# rejects of a corpus with injected defects ---------------------------
_D = fx.DEFECT_SQL
_FILING_REASON = (f"CASE WHEN {_D['malformed']} THEN '{REASONS[1]}' WHEN {_D['no_accept']} THEN '{REASONS[2]}' "
                  f"WHEN {_D['no_ticker']} THEN '{REASONS[3]}' WHEN {_D['empty_title']} THEN '{REASONS[6]}' END")
_TX_REASON = f"CASE WHEN {_D['no_date']} THEN '{TX_REASONS[0]}' WHEN {_D['no_code']} THEN '{TX_REASONS[1]}' END"


@register("filing_rejects", f"""
SELECT accession, part, reject FROM (
  SELECT {_d('accession')} AS accession, l_linenumber AS part,
         coalesce({_FILING_REASON}, {_TX_REASON}) AS reject
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
WHERE reject IS NOT NULL""")
def filing_rejects(spark, sf_dir):
    docs = fx.filing_documents(fx.table(spark, sf_dir, "orders"), fx.table(spark, sf_dir, "lineitem"),
                               defects=True)
    _, rejects = parse_filings(docs)
    return rejects.select("accession", "part", "reject")


# The trades that survive the defects: rejected filings and transactions drop
# out, the rest is combined as usual.
@register("filing_trades_with_defects", f"""
SELECT {', '.join(OUT)} FROM ({o.combine(
    _TX_SQL + f" WHERE coalesce({_FILING_REASON}, {_TX_REASON}) IS NULL", False, HEADER)})""")
def filing_trades_with_defects(spark, sf_dir):
    docs = fx.filing_documents(fx.table(spark, sf_dir, "orders"), fx.table(spark, sf_dir, "lineitem"),
                               defects=True)
    tx, _ = parse_filings(docs)
    return combine_transactions(tx, header_cols=HEADER).select(*OUT)


# A1 + J3: every filing lies under two CIKs (issuer and owner), and the trades
# are those of one of them.
@register("filing_two_ciks", f"SELECT {', '.join(OUT)} FROM ({o.combine(_TX_SQL, False, HEADER)})")
def filing_two_ciks(spark, sf_dir):
    docs = fx.filing_documents(fx.table(spark, sf_dir, "orders"), fx.table(spark, sf_dir, "lineitem"))
    docs = docs.withColumn("cik", F.explode(F.array("cik", F.lit("9999999999"))))
    tx, _ = parse_filings(docs)
    trades = combine_transactions(tx, header_cols=HEADER, filing_key=["cik", "accession"]).drop("cik")
    return dedup_keep_first(trades, key=[c for c in OUT if c != "x_flag"], keep_cols=OUT)


# numbers at the edge, two transactions to a document, files not named
# like an accession: trades and rejects.
_X_TX = f"""
SELECT * REPLACE (CASE l_linenumber WHEN 4 THEN 1e20 WHEN 3 THEN 1e30 ELSE price END AS price,
                  CASE WHEN l_linenumber = 2 THEN CASE WHEN a_d = 'D' THEN -{fx.BIG} ELSE {fx.BIG} END ELSE qty END AS qty,
                  'D' AS x_flag)
FROM ({_TX_SQL.replace('SELECT ', 'SELECT l_linenumber, o_orderkey, ', 1)}), (SELECT unnest([1, 2]) AS copy)
WHERE l_linenumber <> 1 AND o_orderkey % 97 <> 0"""


def _extreme(spark, sf_dir):
    docs = fx.filing_documents(fx.table(spark, sf_dir, "orders"), fx.table(spark, sf_dir, "lineitem"), extremes=True)
    # the landed file's name: some are not named like an accession
    odd = F.substring("accession", -6, 6).cast("int") % 97 == 0
    name = F.when(odd, F.concat(F.lit("copy-"), F.col("accession"), F.lit("-of.txt"))).otherwise(
        F.concat(F.col("accession"), F.lit(".txt")))
    paths = docs.select(F.col("body").alias("value"), F.concat(F.lit("/data/"), F.col("cik"), F.lit("/"), name).alias("p"))
    # trades and rejects of both kinds come from one parse
    tx, bad = split_items(written(filing_items(corpus_rows(paths)), "filing-items"), ["cik", "accession"])
    trades, lost = combine_with_rejects(tx, header_cols=HEADER, filing_key=["cik", "accession"])
    return trades.drop("cik"), bad.unionByName(lost, allowMissingColumns=True)


@register("filing_extremes", f"SELECT {', '.join(OUT)} FROM ({o.combine(_X_TX, False, HEADER)})")
def filing_extremes(spark, sf_dir):
    return _extreme(spark, sf_dir)[0].select(*OUT)


_X_GROUPS = f"""SELECT accession FROM ({_X_TX}) GROUP BY accession, x_flag, filing_ts, ticker, insider_name, title, trade_type, a_d
HAVING abs(sum(qty)) > 9223372036854775807
    OR count(*) > count(TRY_CAST(CAST(CAST(price AS DOUBLE) * abs(CAST(qty AS HUGEINT)) AS VARCHAR) AS DECIMAL(38,10)))"""


@register("filing_extreme_rejects", f"""
SELECT CASE WHEN o_orderkey % 97 = 0 THEN NULL ELSE {_d('accession')} END AS accession,
       CASE WHEN o_orderkey % 97 = 0 THEN '{REASONS[7]}' ELSE '{TX_REASONS[2]}' END AS reject, count(*) AS n
FROM lineitem JOIN orders ON l_orderkey = o_orderkey, (SELECT unnest([1, 2]) AS copy)
WHERE (o_orderkey % 97 = 0 AND copy = 1) OR (o_orderkey % 97 <> 0 AND l_linenumber = 1) GROUP BY ALL
UNION ALL SELECT accession, '{AMOUNT_REASON}', count(*) FROM ({_X_GROUPS}) GROUP BY accession""")
def filing_extreme_rejects(spark, sf_dir):
    return _extreme(spark, sf_dir)[1].groupBy("accession", "reject").agg(F.count("*").alias("n"))


# Several tables, leaves at any depth, owners without a
# name, stray ampersands, documents that are cut off.
_ODD_TX = f"""SELECT * EXCLUDE (l_linenumber, copy)
FROM ({_TX_SQL.replace('SELECT ', 'SELECT l_linenumber, ', 1)}), (SELECT unnest([1, 2]) AS copy)
WHERE copy = 1 OR NOT ({fx.ODD_CUT_SQL})"""


def _odd(spark, sf_dir):
    docs = fx.odd_documents(fx.table(spark, sf_dir, "orders"), fx.table(spark, sf_dir, "lineitem"))
    return parse_filings(docs)


@register("filing_odd_documents", f"SELECT {', '.join(OUT)} FROM ({o.combine(_ODD_TX, False, HEADER)})")
def filing_odd_documents(spark, sf_dir):
    return combine_transactions(_odd(spark, sf_dir)[0], header_cols=HEADER).select(*OUT)


@register("filing_odd_rejects", f"""
SELECT {_d('accession')} AS accession, l_linenumber AS part, '{CUT_REASON}' AS reject
FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE {fx.ODD_CUT_SQL}""")
def filing_odd_rejects(spark, sf_dir):
    return _odd(spark, sf_dir)[1].select("accession", "part", "reject")


# Prices of ten decimals keep them all
_FINE = o.LINEITEM_TX.replace("l_extendedprice AS price", "l_extendedprice * 1e-8 AS price").replace(
    "CAST(l_quantity AS BIGINT)", "CAST(l_quantity AS BIGINT) * 1000003")


@register("combine_fine_prices", f"SELECT accession, x_flag, trade_type, trade_date, price, qty, value FROM ({o.combine(_FINE, False, ['x_flag'])})")
def combine_fine_prices(spark, sf_dir):
    tx = fx.lineitem_transactions(fx.table(spark, sf_dir, "lineitem"))
    tx = tx.withColumn("price", F.col("price") * F.lit(1e-8)).withColumn("qty", F.col("qty") * 1000003)
    return combine_transactions(tx).select("accession", "x_flag", "trade_type", "trade_date", "price", "qty", "value")
