"""Domain inputs derived, with Spark, from the driver's test tables.

Each function reads whole tables and maps them onto one input of the trade
pipeline (transactions, Form 4 documents, a trade store, a watch list, a
ticker dictionary, filing indexes, screener pages, trades and price bars), so
the work of every query grows with the tables. The mapping is mirrored in SQL
by ``tradewell.plans.oracle`` for the DuckDB check.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewell.functions.scalars import let, signed_qty, trade_type, wall_text
from tradewell.session import spread

TASKS_A_CORE = 8    # tasks of CPU-heavy rows for each core

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# lineitem -> transactions ----------------------------------------------------
# l_returnflag A/R/N -> transaction code P/S/M; l_linestatus O/F -> A/D code.
RETURNFLAG_CODE = {"A": "P", "R": "S", "N": "M"}
LINESTATUS_AD = {"O": "A", "F": "D"}


def _case(col: str, mapping: dict) -> F.Column:
    e = None
    for k, v in mapping.items():
        e = (F.when(F.col(col) == k, F.lit(v)) if e is None
             else e.when(F.col(col) == k, F.lit(v)))
    return e


def lineitem_accession(col="l_orderkey") -> F.Column:
    return F.format_string("%010d", F.col(col))


def lineitem_transactions(lineitem: DataFrame) -> DataFrame:
    """One transaction per lineitem row; the filing is the order."""
    code = _case("l_returnflag", RETURNFLAG_CODE)
    a_d = _case("l_linestatus", LINESTATUS_AD)
    shares = F.col("l_quantity").cast("bigint")
    return lineitem.select(
        lineitem_accession().alias("accession"),
        F.lit("").alias("x_flag"),
        trade_type(code).alias("trade_type"),
        a_d.alias("a_d"),
        F.to_date("l_shipdate").alias("trade_date"),
        F.col("l_extendedprice").alias("price"),
        signed_qty(shares, a_d).alias("qty"),
    )


# orders + lineitem -> Form 4 submission texts ----------------------------------
# A filing is an order (accession from custkey, year and orderkey; the filer
# CIK is the custkey). Each lineitem row is one document *part* of its filing
# carrying the full header and one transaction, so no document is built by
# collecting a group: parts are bounded by construction whatever the skew.
# Orders with status 'P' hold a derivative table (empty, or with the part's
# transaction when its return flag is 'N').
FILING_SQL = {
    "accession": "format_string('%010d-%02d-%06d', o_custkey, year(o_orderdate) % 100, o_orderkey)",
    "cik": "format_string('%010d', o_custkey)",
    "filing_ts": "timestampadd(SECOND, CAST(o_orderkey % 86400 AS INT), o_orderdate)",
    "ticker": "format_string('CUSTOMER#%09d', o_custkey)",
    "owner": ("CASE o_orderstatus WHEN 'F' THEN 'MCDONALD-SMITH ' WHEN 'O' THEN 'o''brien  ' "
              "ELSE 'van der  berg ' END || upper(substr(o_orderpriority, 3))"),
    "is_officer": ("CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'true' "
                   "WHEN o_orderpriority = '3-MEDIUM' THEN '1' ELSE '0' END"),
    "officer_title": ("CASE o_orderkey % 4 WHEN 0 THEN NULL WHEN 1 THEN 'See Remarks' "
                      "WHEN 2 THEN 'CEO' ELSE 'Chief Financial Officer' END"),
    "is_director": "CASE WHEN o_custkey % 2 = 0 THEN '1' ELSE 'false' END",
    "is_ten_pct": "CASE WHEN o_totalprice > 300000 THEN 'true' ELSE '0' END",
    "remarks": "CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE 'Remark for ' || o_orderstatus END",
    "has_deriv": "o_orderstatus = 'P'",
}
LINE_SQL = {
    "code": "CASE l_returnflag WHEN 'A' THEN 'P' WHEN 'R' THEN 'S' ELSE 'M' END",
    "a_d": "CASE l_linestatus WHEN 'O' THEN 'A' ELSE 'D' END",
    "shares_text": ("CASE WHEN l_linenumber = 6 THEN CAST(CAST(l_quantity AS BIGINT) AS STRING) || '.5' "
                    "ELSE CAST(CAST(l_quantity AS BIGINT) AS STRING) END"),
    "footnote_price": "l_linenumber = 5",
    "in_deriv": "o_orderstatus = 'P' AND l_returnflag = 'N'",
}
# Injected defects: whole filings (all parts) and single transactions.
DEFECT_SQL = {
    "no_accept": "o_orderpriority = '5-LOW' AND o_orderstatus = 'O'",
    "malformed": "o_orderpriority = '4-NOT SPECIFIED' AND o_orderstatus = 'O'",
    "no_ticker": "o_orderpriority = '5-LOW' AND o_orderstatus = 'F'",
    "empty_title": "o_orderpriority = '4-NOT SPECIFIED' AND o_orderstatus = 'F'",
    "no_date": "l_linenumber = 7",
    "no_code": "l_linenumber = 4 AND l_returnflag = 'R'",
}


def _el(tag, inner):
    return F.concat(F.lit(f"<{tag}>"), inner, F.lit(f"</{tag}>"))


def _opt(cond, text):
    return F.when(cond, text).otherwise(F.lit(""))


# Numbers at the edge (``extremes``): line 4 a price of 1e20, which is held;
# line 3 one of 1e30, whose value no column holds; line 2 two transactions of
# the largest share count, whose sum overflows; line 1 a count beyond 64 bits.
BIG = 9223372036854775807


def _lines_of_orders(orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    """The rows that texts are made of, spread behind the join: their parse takes
    far longer than their bytes tell, and AQE would size the join's tasks by bytes
    (a few tasks more than cores, so that most cores wait for the last ones)."""
    cores = lineitem.sparkSession.sparkContext.defaultParallelism
    return spread(lineitem.join(orders, F.col("l_orderkey") == F.col("o_orderkey")), TASKS_A_CORE * cores)


def filing_documents(orders: DataFrame, lineitem: DataFrame, defects: bool = False,
                     extremes: bool = False) -> DataFrame:
    """One text per lineitem row. With ``extremes`` every text has two
    transactions, a non-derivative and a derivative one, from the same row."""
    e = {k: F.expr(v) for k, v in {**FILING_SQL, **LINE_SQL}.items()}
    d = {k: (F.expr(v) if defects else F.lit(False)) for k, v in DEFECT_SQL.items()}
    j = _lines_of_orders(orders, lineitem)
    val = lambda x: _el("value", x)
    price = F.when(e["footnote_price"], F.lit('<footnoteId id="F1"/>')).otherwise(
        val(F.col("l_extendedprice").cast("string")))
    line = F.col("l_linenumber")
    if extremes:
        price = (F.when(line == 4, val(F.lit("1e20"))).when(line == 3, val(F.lit("1e30"))).otherwise(price))
        e["shares_text"] = (F.when(line == 2, F.lit(str(BIG))).when(line == 1, F.lit(f"{BIG}0"))
                            .otherwise(e["shares_text"]))
    tx_inner = F.concat(
        _opt(~d["no_date"], _el("transactionDate", val(F.to_date("l_shipdate").cast("string")))),
        _opt(~d["no_code"], _el("transactionCoding", F.concat(
            F.lit("<transactionFormType>4</transactionFormType>"), _el("transactionCode", e["code"])))),
        _el("transactionAmounts", F.concat(
            _el("transactionShares", val(e["shares_text"])),
            _el("transactionPricePerShare", price),
            _el("transactionAcquiredDisposedCode", val(e["a_d"])))))
    non_deriv = _el("nonDerivativeTable", _opt(~e["in_deriv"], _el("nonDerivativeTransaction", tx_inner)))
    if extremes:
        non_deriv = _el("nonDerivativeTable", _el("nonDerivativeTransaction", tx_inner))
    deriv = _el("derivativeTable", _el("derivativeTransaction", tx_inner)) if extremes else _opt(
        e["has_deriv"], _el("derivativeTable", _opt(e["in_deriv"], _el("derivativeTransaction", tx_inner))))
    officer_title = F.when(d["empty_title"], F.lit("<officerTitle/>")).otherwise(
        _opt(e["officer_title"].isNotNull(), _el("officerTitle", F.coalesce(e["officer_title"], F.lit("")))))
    is_officer = F.when(d["empty_title"], F.lit("true")).otherwise(e["is_officer"])
    rel = _el("reportingOwnerRelationship", F.concat(
        _el("isDirector", e["is_director"]), _el("isOfficer", is_officer),
        _el("isTenPercentOwner", e["is_ten_pct"]), officer_title))
    owner = _el("reportingOwner", F.concat(_el("reportingOwnerId", F.concat(
        _el("rptOwnerCik", F.format_string("%010d", F.col("l_suppkey"))),
        _el("rptOwnerName", e["owner"]))), rel))
    issuer = _el("issuer", F.concat(_el("issuerCik", e["cik"]),
                                    _opt(~d["no_ticker"], _el("issuerTradingSymbol", e["ticker"]))))
    remarks = _opt(e["remarks"].isNotNull(), _el("remarks", F.coalesce(e["remarks"], F.lit(""))))
    doc = F.concat(F.lit('<?xml version="1.0"?>\n<ownershipDocument><schemaVersion>X0508</schemaVersion>'),
                   issuer, owner, non_deriv, deriv, remarks, F.lit("</ownershipDocument>"))
    # malformed: a mismatched closing tag, the rest of the document intact
    doc = F.when(d["malformed"], F.replace(doc, F.lit("</issuer>"), F.lit("</issuer-broken>"))).otherwise(doc)
    # ``let`` takes the projection out of the stage's one generated method, which would
    # pass 8,000 bytes and never be compiled; by itself it is split into small ones
    header = F.concat(
        let(e["accession"], lambda a: F.concat(F.lit("<SEC-DOCUMENT>"), a, F.lit(".txt\n<SEC-HEADER>\n"))),
        _opt(~d["no_accept"], F.concat(F.lit("<ACCEPTANCE-DATETIME>"),
                                       wall_text(e["filing_ts"], "%04d%02d%02d%02d%02d%02d"), F.lit("\n"))),
        F.lit("CONFORMED SUBMISSION TYPE:\t4\n</SEC-HEADER>\n<DOCUMENT>\n<TYPE>4\n<TEXT>\n<XML>\n"))
    body = F.concat(header, doc, F.lit("\n</XML>\n</TEXT>\n</DOCUMENT>\n</SEC-DOCUMENT>\n"))
    return j.select(e["cik"].alias("cik"), e["accession"].alias("accession"),
                    F.col("l_linenumber").alias("part"), body.alias("body"))


# Documents as they occur in the wild (``odd_documents``): the same transaction
# in two tables, in the second with its leaves at other depths; a first owner
# without a name; a comment and a CDATA section that hold markup; stray ``&``;
# line 3 ends within its second transaction.
ODD_CUT_SQL = "l_linenumber = 3"


def odd_documents(orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    e = {k: F.expr(v) for k, v in {**FILING_SQL, **LINE_SQL}.items()}
    j = _lines_of_orders(orders, lineitem)
    val = lambda x: F.concat(F.lit('<value unit="x > y">'), x, F.lit("</value>"))
    date = _el("transactionDate", val(F.to_date("l_shipdate").cast("string")))
    code = _el("transactionCode", e["code"])
    shares = _el("transactionShares", val(e["shares_text"]))
    price = _el("transactionPricePerShare", F.when(e["footnote_price"], F.lit('<footnoteId id="F1"/>')).otherwise(
        F.concat(F.lit('<footnoteId id="F1"/>'), val(F.col("l_extendedprice").cast("string")))))
    a_d = _el("transactionAcquiredDisposedCode", val(e["a_d"]))
    usual = F.concat(date, _el("transactionCoding", code), _el("transactionAmounts", F.concat(shares, price, a_d)))
    other = F.concat(code, _el("amounts", F.concat(_el("more", a_d), _el("more", price))), F.lit("<note/>"), _el("when", date), shares)
    table = lambda x: _el("nonDerivativeTable", _el("nonDerivativeTransaction", x))
    officer = _opt(e["officer_title"].isNotNull(), _el("officerTitle", F.coalesce(e["officer_title"], F.lit(""))))
    rel = _el("reportingOwnerRelationship", F.concat(_el("isDirector", e["is_director"]), _el("isOfficer", e["is_officer"]),
                                                     _el("isTenPercentOwner", e["is_ten_pct"]), officer))
    owners = F.concat(F.lit("<reportingOwner><reportingOwnerId/>"), rel, F.lit("</reportingOwner>"),
                      _el("reportingOwner", _el("reportingOwnerId", _el("rptOwnerName", e["owner"]))))
    doc = F.concat(
        F.lit("<ownershipDocument><!-- <issuerTradingSymbol>OLD</issuerTradingSymbol> --><issuer><issuerName>A&B & Co &nbsp; <![CDATA[<remarks>&]]></issuerName>"),
        _el("deep", _el("issuerTradingSymbol", e["ticker"])), F.lit("</issuer>"), owners, _opt(e["has_deriv"], F.lit('<derivativeTable kind="none"/>')),
        _opt(e["remarks"].isNotNull(), _el("remarks", F.coalesce(e["remarks"], F.lit("")))), table(usual), table(other), F.lit("</ownershipDocument>\n</XML>"))
    doc = F.when(F.expr(ODD_CUT_SQL), F.substring_index(doc, "<note/>", 1)).otherwise(doc)
    stamp = wall_text(e["filing_ts"], "%04d%02d%02d%02d%02d%02d")
    # as in filing_documents
    body = F.concat(let(stamp, lambda t: F.concat(F.lit("<ACCEPTANCE-DATETIME>"), t, F.lit("\n<XML>\n"))), doc)
    return j.select(e["cik"].alias("cik"), e["accession"].alias("accession"), F.col("l_linenumber").alias("part"), body.alias("body"))


# customer + supplier -> ticker dictionary (JSON lines) and watch lists ---------
# Customers are the listed companies: ticker upper(c_name), CIK c_custkey, at
# dictionary position 2*c_custkey. Each supplier adds a later or earlier
# duplicate of customer 3*s_suppkey's ticker with another CIK, at position
# 2*s_suppkey+1, so "first match wins" decides.
def ticker_dictionary_json(customer: DataFrame, supplier: DataFrame) -> DataFrame:
    def entry(pos, cik, ticker):
        return F.to_json(F.create_map(pos.cast("string"), F.struct(cik.cast("bigint").alias("cik_str"),
                                                                     ticker.alias("ticker"))))
    c = customer.select(entry(F.col("c_custkey") * 2, F.col("c_custkey"), F.upper("c_name")).alias("value"))
    s = supplier.select(entry(F.col("s_suppkey") * 2 + 1, F.col("s_suppkey") + 800000,
                              F.format_string("CUSTOMER#%09d", F.col("s_suppkey") * 3)).alias("value"))
    return c.unionByName(s)


WATCH_FILE_SQL = ("CASE WHEN c_acctbal < 0 THEN '   ' WHEN c_mktsegment = 'BUILDING' "
                  "THEN '  ' || lower(c_name) || chr(9) ELSE c_name END")
WATCH_PARAM_SQL = [
    "s_name",
    "CAST(s_suppkey * 7 + 100000 AS STRING)",
    "' ' || lower(format_string('customer#%09d', s_suppkey * 3))",
    "'12345678901' || CAST(s_suppkey AS STRING)",
]


def watchlist_lines(customer: DataFrame, supplier: DataFrame):
    """(file lines, parameter symbols) as one-column DataFrames."""
    file_lines = customer.select(F.expr(WATCH_FILE_SQL.replace("chr(", "char(")).alias("symbol"))
    params = supplier.select(F.explode(F.array(*[F.expr(e) for e in WATCH_PARAM_SQL])).alias("symbol"))
    return file_lines, params


# orders -> filing index JSON shards --------------------------------------------
# One shard per (custkey, block of 1000 orderkeys): a shard never holds more
# than 1000 entries, whatever the skew of custkey. The place of an entry in its
# shard follows neither its date nor its accession.
INDEX_PLACE_SQL = "(o_orderkey * 7919) % 1000"
INDEX_FORM_SQL = "CASE o_orderpriority WHEN '1-URGENT' THEN '4/A' WHEN '2-HIGH' THEN '3' ELSE '4' END"


def filing_index_json(orders: DataFrame) -> DataFrame:
    e = orders.select(
        F.expr(FILING_SQL["cik"]).alias("cik"),
        F.floor(F.col("o_orderkey") / 1000).alias("block"),
        F.struct(F.expr(INDEX_PLACE_SQL).alias("k"), F.to_date("o_orderdate").alias("d"),
                 F.expr(FILING_SQL["accession"]).alias("a"),
                 F.expr(INDEX_FORM_SQL).alias("f")).alias("e"))
    g = e.groupBy("cik", "block").agg(F.collect_list("e").alias("es"))
    es = F.sort_array("es")
    recent = F.struct(F.transform(es, lambda x: x["a"]).alias("accessionNumber"),
                      F.transform(es, lambda x: x["f"]).alias("form"),
                      F.transform(es, lambda x: x["d"].cast("string")).alias("filingDate"))
    return g.select(F.to_json(F.struct(F.col("cik"), F.struct(recent.alias("recent")).alias("filings")))
                    .alias("value"), F.col("block").alias("shard"))


# events -> insider trades and daily price bars ---------------------------------
# ticker = the user; 'purchase' / 'click' are open-market buys / sales,
# 'signup' / 'error' are grants / gifts (filtered out by F3); 'view' events are
# price ticks whose last value of the day is the close.
EVENT_TRADE_SQL = {
    "ticker": "format_string('U%03d', user_id)",
    "filing_ts": "ts",
    "trade_date": "date_sub(CAST(ts AS DATE), CAST(event_id % 3 AS INT))",
    "insider_name": "'Insider ' || CAST(event_id % 7 AS STRING)",
    "title": "CASE CAST(event_id % 4 AS INT) WHEN 0 THEN 'CEO' WHEN 1 THEN 'Director' WHEN 2 THEN '10% Owner' ELSE 'No Title' END",
    "trade_type": ("CASE event_type WHEN 'purchase' THEN 'P - Purchase' WHEN 'click' THEN 'S - Sale' "
                   "WHEN 'signup' THEN 'A - Grant' ELSE 'G - Gift' END"),
    "price": "value",
    "qty": "CASE WHEN event_type = 'click' THEN -(event_id % 100 + 1) ELSE event_id % 100 + 1 END",
}


def event_trades(events: DataFrame) -> DataFrame:
    return events.where(F.col("event_type") != "view").select(
        *[F.expr(v).alias(k) for k, v in EVENT_TRADE_SQL.items()])


def event_prices(events: DataFrame) -> DataFrame:
    """Daily close per ticker: the last 'view' value of the day (a partial
    aggregate per (ticker, day))."""
    v = events.where(F.col("event_type") == "view")
    return (v.groupBy(F.expr(EVENT_TRADE_SQL["ticker"]).alias("ticker"), F.to_date("ts").alias("date"))
            .agg(F.max_by("value", "ts").alias("close")))


# lineitem -> screener pages ------------------------------------------------------
# One page per lineitem row (bounded by construction): a first tbody (the
# filter form) and, unless the row is a returned open item, a second tbody with
# one 16-cell row. Ticker pages group ten suppliers each.
def _money(cents_sql: str) -> str:
    from tradewell.plans.oracle import money_text
    return money_text(cents_sql)


SCREEN_SQL = {
    "page_ticker": "'T' || CAST(l_suppkey % 10 AS STRING)",
    "single": "l_returnflag = 'N' AND l_linestatus = 'O'",
    "sign": "CASE l_returnflag WHEN 'R' THEN '-' ELSE '+' END",
    "cents": "CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * 100 AS BIGINT)",
    "qty_abs": "CAST(l_quantity AS BIGINT) * l_partkey",
    "short": "l_linenumber = 2",    # the row ends after the trade type
    "upper": "l_linenumber % 3 = 0",  # tags in capitals
    "open": "l_linenumber = 6",       # no end tags of cells and rows
    "nested": "l_linenumber = 5",     # a table inside the title cell
}

# Pages that give no trades (only with ``defects``; ``single`` pages come first).
PAGE_DEFECT_SQL = {
    "absent": "(l_linenumber = 3 AND l_returnflag = 'R')",
    "bare": "(l_linenumber = 4 AND l_returnflag = 'A')",
    "wide": "(l_linenumber = 1 AND l_returnflag = 'A')",
}


def screener_pages(lineitem: DataFrame, defects: bool = False) -> DataFrame:
    """Pages as the screener's: tags inside quoted attributes, a commented
    table, tables inside cells, end tags left out, entities of all kinds."""
    s = SCREEN_SQL
    e = lambda x: F.expr(x)
    bad = {k: (e(v) if defects else F.lit(False)) for k, v in PAGE_DEFECT_SQL.items()}
    tag = lambda t: F.when(e(s["upper"]), F.lit(t.upper())).otherwise(F.lit(t))
    end = lambda t: _opt(~e(s["open"]), tag(t))
    td = lambda x: F.concat(tag("<td>"), x, end("</td>"))
    inner = lambda x: F.when(e(s["nested"]), F.concat(F.lit("<table><tbody><tr><td>"), x, F.lit("</td></tr></tbody></table>"))).otherwise(x)
    tip = """<a href="/%s" onmouseover="Tip('<img src=x width=500>', DELAY, 1)" title='a > b' onmouseout=UnTip()>"""
    cells = [
        F.when(e("l_linestatus = 'F'"), F.lit("D")).otherwise(F.lit("")),
        F.when(e("l_linenumber = 7"), F.lit("bad")).otherwise(wall_text("l_shipdate")),
        F.date_sub(F.to_date("l_shipdate"), 2).cast("string"),
        F.concat(F.format_string(tip, e(s["page_ticker"])), e(s["page_ticker"]), F.lit("</a>")),
        F.concat(F.lit('<a href="/insider/1">Doe &amp; Co&#8217;s Ren&#xE9;e&eacute; &Scaron;&lstrok;&#x1F600; &eacute &amp;lt; '), F.col("l_partkey").cast("string"), F.lit("</a>")),
        inner(F.when(e("l_discount > 0.05"), F.lit("CEO; Dir")).otherwise(F.lit("Dir"))),
        e("CASE l_returnflag WHEN 'A' THEN 'P - Purchase' WHEN 'R' THEN 'S - Sale' ELSE 'A - Grant' END"),
        F.concat(F.lit("$"), e(_money(s["cents"]))),
        F.concat(e(s["sign"]), F.split(e(_money(f"{s['qty_abs']} * 100")), r"\.").getItem(0)),
        F.lit("1,000"), F.lit("+5%"),
        F.concat(e(s["sign"]), F.lit("$"), e(_money(f"{s['cents']} * CAST(l_quantity AS BIGINT)"))),
        F.lit("-2%"), F.lit(""), F.lit("+1%"), F.lit("&nbsp;"),
    ]
    row = F.concat(tag("<tr>"), *[td(c) for c in cells[:7]], _opt(~e(s["short"]), F.concat(*[td(c) for c in cells[7:]])),
                   _opt(bad["wide"], td(F.lit("one more"))), end("</tr>"))
    data = F.concat(F.lit('<!-- <table><tbody><tr><td>old</td></tr></tbody></table> --><table class="tinytable" title="a > b">'
                          "<thead><tr><th>X</th></tr></thead>"),
                    tag("<tbody>"), _opt(~bad["bare"], row), tag("</tbody>"), F.lit("</table>"))
    html = F.concat(F.lit('<html><body><script>if (a < b) write("<tbody>")</script>'
                          '<form><table><tbody><tr><td>Filter</td></tr></tbody></table></form>'),
                    F.when(e(s["single"]), F.lit("")).otherwise(data), F.lit("</body></html>"))
    html = F.when(~bad["absent"], html)
    return lineitem.select(e(s["page_ticker"]).alias("page_ticker"), F.col("l_orderkey").alias("page_id"),
                           html.alias("html"))
