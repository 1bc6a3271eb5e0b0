"""Queries for the scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from tradewell.functions import scalars as S
from tradewell.plans import fixtures as fx
from tradewell.plans import oracle as o
from tradewell.plans.registry import register

# R1 ----------------------------------------------------------------------------
_X = "l_extendedprice * l_discount"
_Y = "l_extendedprice / l_quantity"


@register("round_half_away", f"""
SELECT l_orderkey, l_linenumber, l_partkey,
       {o.round_half_away(_X, 2)} AS disc_r2, {o.round_half_away(_X, 0)} AS disc_r0,
       {o.round_half_away(_Y, 2)} AS unit_r2, {o.round_half_away('-(' + _Y + ')', 1)} AS neg_unit_r1
FROM lineitem""")
def round_half_away_q(spark, sf_dir):
    li = fx.table(spark, sf_dir, "lineitem")
    x, y = F.expr(_X), F.expr(_Y)
    return li.select("l_orderkey", "l_linenumber", "l_partkey",
                     S.round_half_away(x, 2).alias("disc_r2"), S.round_half_away(x, 0).alias("disc_r0"),
                     S.round_half_away(y, 2).alias("unit_r2"),
                     S.round_half_away(-y, 1).alias("neg_unit_r1"))


# R2 ----------------------------------------------------------------------------
# Raw owner names built from part and nation: upper case, hyphens, Mc prefixes,
# tabs and repeated spaces.
_RAW_PART = ["upper(p_name)",
             "'MC' || upper(replace(p_name, ' ', '-'))",
             "'  ' || lower(p_type) || chr(9) || p_brand || ' '",
             "'mc' || chr(160) || upper(p_type) || '--' || lower(p_name)"]


@register("normalize_names", " UNION ALL ".join(
    [f"SELECT p_partkey AS id, {i} AS variant, {e} AS raw, {o.normalize_name(e)} AS name FROM part"
     for i, e in enumerate(_RAW_PART)]
    + [f"SELECT n_nationkey AS id, 9 AS variant, n_name AS raw, {o.normalize_name('n_name')} AS name FROM nation"]))
def normalize_names_q(spark, sf_dir):
    part = fx.table(spark, sf_dir, "part")
    nation = fx.table(spark, sf_dir, "nation")
    outs = [part.select(F.col("p_partkey").alias("id"), F.lit(i).alias("variant"),
                        F.expr(e.replace("chr(", "char(")).alias("raw"))
            for i, e in enumerate(_RAW_PART)]
    outs.append(nation.select(F.col("n_nationkey").cast("bigint").alias("id"), F.lit(9).alias("variant"),
                              F.col("n_name").alias("raw")))
    df = outs[0]
    for d in outs[1:]:
        df = df.unionByName(d)
    return df.withColumn("name", S.normalize_name("raw"))


# R3 / R4 -----------------------------------------------------------------------
# Relationship flags from part: every combination of officer flag, missing /
# empty / 'See Remarks' / plain officer title, director, 10% owner, remarks.
_REL = {
    "is_officer": "CASE p_size % 4 WHEN 0 THEN 'true' WHEN 1 THEN '1' WHEN 2 THEN '0' ELSE NULL END",
    "officer_title": "CASE p_size % 5 WHEN 0 THEN NULL WHEN 1 THEN 'See Remarks' WHEN 2 THEN '' "
                     "WHEN 3 THEN 'CFO; See Remarks' ELSE p_type END",
    "is_director": "CASE WHEN p_retailprice > 1500 THEN '1' ELSE 'false' END",
    "is_ten_pct": "CASE WHEN p_brand IN ('Brand#1', 'Brand#2', 'Brand#3') THEN 'true' ELSE '0' END",
    "remarks": "CASE p_partkey % 3 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE p_name END",
}
_REL_SQL = ", ".join(f"{v} AS {k}" for k, v in _REL.items())


@register("owner_titles", f"""
SELECT p_partkey, {o.owner_title('is_officer', 'officer_title', 'is_director', 'is_ten_pct', 'remarks')} AS title
FROM (SELECT p_partkey, {_REL_SQL} FROM part)""")
def owner_titles_q(spark, sf_dir):
    part = fx.table(spark, sf_dir, "part")
    rel = part.select("p_partkey", *[F.expr(v).alias(k) for k, v in _REL.items()])
    return rel.select("p_partkey", S.owner_title("is_officer", "officer_title", "is_director",
                                                 "is_ten_pct", "remarks").alias("title"))


# R5 ----------------------------------------------------------------------------
_CODES = "PSADGFMXCWZ"
_CODE_EXPR = f"substr('{_CODES}', CAST(l_partkey % {len(_CODES)} AS INT) + 1, 1)"


@register("trade_type_labels", f"""
SELECT code, {o.trade_type('code')} AS trade_type, count(*) AS n
FROM (SELECT {_CODE_EXPR} AS code FROM lineitem) GROUP BY code""")
def trade_type_labels_q(spark, sf_dir):
    li = fx.table(spark, sf_dir, "lineitem")
    return (li.select(F.expr(_CODE_EXPR).alias("code"))
            .groupBy("code").agg(F.count(F.lit(1)).alias("n"))
            .select("code", S.trade_type("code").alias("trade_type"), "n"))


# R12-R14 -----------------------------------------------------------------------
# Screener-style money text from lineitem: '+$1,234.56', '-$12', '$1,234.56',
# '+1,000', and 'n/a' for returned items.
_CENTS = "CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * 100 AS BIGINT)"
_QCENTS = "CAST(l_quantity AS BIGINT) * l_partkey * 100"
_SIGN = "CASE WHEN l_linestatus = 'F' THEN '-' ELSE '+' END"


def _money_sql():
    value = f"CASE WHEN l_returnflag = 'N' THEN 'n/a' ELSE {_SIGN} || '$' || {o.money_text(_CENTS)} END"
    price = f"'$' || {o.money_text(_CENTS)}"
    qty = f"CASE WHEN l_returnflag = 'N' THEN 'n/a' ELSE {_SIGN} || split_part({o.money_text(_QCENTS)}, '.', 1) END"
    return value, price, qty


@register("money_clean", f"""
SELECT l_orderkey, l_linenumber, value_text, price_text, qty_text,
       TRY_CAST(regexp_replace(value_text, '[+$,]', '', 'g') AS DOUBLE) AS value,
       TRY_CAST(regexp_replace(price_text, '[$,]', '', 'g') AS DOUBLE) AS price,
       CASE WHEN regexp_matches(regexp_replace(qty_text, '[+,]', '', 'g'), '^[+-]?[0-9]+$')
            THEN TRY_CAST(regexp_replace(qty_text, '[+,]', '', 'g') AS BIGINT) END AS qty
FROM (SELECT l_orderkey, l_linenumber, {_money_sql()[0]} AS value_text,
             {_money_sql()[1]} AS price_text, {_money_sql()[2]} AS qty_text FROM lineitem)""")
def money_clean_q(spark, sf_dir):
    li = fx.table(spark, sf_dir, "lineitem")
    v, p, q = (F.expr(e) for e in _money_sql())
    df = li.select("l_orderkey", "l_linenumber", v.alias("value_text"), p.alias("price_text"),
                   q.alias("qty_text"))
    return df.select("*", S.money_value("value_text").alias("value"),
                     S.money_price("price_text").alias("price"),
                     S.clean_qty("qty_text").alias("qty"))


# R15 ---------------------------------------------------------------------------
_TITLE = "p_name || '; ' || p_type || ', ' || p_brand"


@register("title_delimiter", f"""
SELECT p_partkey, replace({_TITLE}, ';', ',') AS title_semicolon_sep,
       replace({_TITLE}, ',', ';') AS title_comma_sep, {_TITLE} AS title_tab_sep FROM part""")
def title_delimiter_q(spark, sf_dir):
    part = fx.table(spark, sf_dir, "part")
    t = F.expr(_TITLE)
    return part.select("p_partkey", S.delimiter_safe(t, ";").alias("title_semicolon_sep"),
                       S.delimiter_safe(t, ",").alias("title_comma_sep"),
                       S.delimiter_safe(t, "\t").alias("title_tab_sep"))


# R16 / R9 ----------------------------------------------------------------------
# Filing and trade date texts from orders in several layouts, with junk.
_FILED_SPARK = ("CASE o_orderpriority WHEN '1-URGENT' THEN format_string('%04d-%02d-%02d %02d:%02d:%02d', year(o_orderdate), month(o_orderdate), day(o_orderdate), hour(o_orderdate), minute(o_orderdate), second(o_orderdate)) "
                "WHEN '2-HIGH' THEN CAST(CAST(o_orderdate AS DATE) AS STRING) "
                "WHEN '3-MEDIUM' THEN 'bad date' "
                "WHEN '4-NOT SPECIFIED' THEN format_string('%04d-%02d-%02dT%02d:%02d:%02d', year(o_orderdate), month(o_orderdate), day(o_orderdate), hour(o_orderdate), minute(o_orderdate), second(o_orderdate)) "
                "ELSE NULL END")
_FILED_DUCK = ("CASE o_orderpriority WHEN '1-URGENT' THEN strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') "
               "WHEN '2-HIGH' THEN strftime(o_orderdate, '%Y-%m-%d') "
               "WHEN '3-MEDIUM' THEN 'bad date' "
               "WHEN '4-NOT SPECIFIED' THEN strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') "
               "ELSE NULL END")
_TRADE_SPARK = ("CASE o_orderstatus WHEN 'F' THEN CAST(CAST(o_orderdate AS DATE) AS STRING) || '-05:00' "
                "WHEN 'O' THEN ' ' || CAST(CAST(o_orderdate AS DATE) AS STRING) || ' ' ELSE 'n/a' END")
_TRADE_DUCK = ("CASE o_orderstatus WHEN 'F' THEN strftime(o_orderdate, '%Y-%m-%d') || '-05:00' "
               "WHEN 'O' THEN ' ' || strftime(o_orderdate, '%Y-%m-%d') || ' ' ELSE 'n/a' END")
_TS_FMTS = ["%Y-%m-%d %H:%M:%S", "%Y-%m-%d %H:%M:%S.%f", "%Y-%m-%dT%H:%M:%S", "%Y-%m-%d %H:%M", "%Y-%m-%d"]


def _ts_sql(t):
    s = o.strip_ws(t)
    return "coalesce(" + ", ".join(f"try_strptime({s}, '{f}')" for f in _TS_FMTS) + ")"


def _date_sql(t):
    s = o.strip_ws(t)
    return (f"CASE WHEN regexp_matches({s}, '^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}') "
            f"THEN CAST(try_strptime(substr({s}, 1, 10), '%Y-%m-%d') AS DATE) END")


@register("date_coerce", f"""
SELECT o_orderkey, filed_text, trade_text, {_ts_sql('filed_text')} AS filing_ts,
       CAST({_ts_sql('filed_text')} AS DATE) AS filing_day, {_date_sql('trade_text')} AS trade_date
FROM (SELECT o_orderkey, {_FILED_DUCK} AS filed_text, {_TRADE_DUCK} AS trade_text FROM orders)""")
def date_coerce_q(spark, sf_dir):
    orders = fx.table(spark, sf_dir, "orders")
    df = orders.select("o_orderkey", F.expr(_FILED_SPARK).alias("filed_text"),
                       F.expr(_TRADE_SPARK).alias("trade_text"))
    return df.select("*", S.coerce_ts("filed_text").alias("filing_ts"),
                     S.coerce_date("filed_text").alias("filing_day"),
                     S.trade_date_text("trade_text").alias("trade_date"))


# One instant in many layouts; the layout follows the order key
_LAYOUT_TEXTS = [
    "date_format(o_orderdate, 'MM/dd/yyyy')", "date_format(o_orderdate, 'MMM d, yyyy')", "date_format(o_orderdate, 'yyyyMMdd')",
    "date_format(o_orderdate, 'yyyy-M-d')", "concat(date_format(o_orderdate, 'yyyy-MM-dd'), 'T10:00:00Z')",
    "date_format(o_orderdate, 'd MMMM yyyy')", "concat(date_format(o_orderdate, 'M/d/yyyy'), ' 10:00 PM')",
    "concat(date_format(o_orderdate, 'yyyy-MM-dd'), ' 10:00:00.5-05:00')", "concat(date_format(o_orderdate, 'yyyy'), '-13-01')",
    "concat('Foo ', date_format(o_orderdate, 'd, yyyy'))",
]
_LAYOUT_HOURS = {4: "INTERVAL 10 HOUR", 6: "INTERVAL 22 HOUR", 7: "INTERVAL 36000500 MILLISECONDS"}


@register("date_layouts", f"""
SELECT o_orderkey, CASE WHEN k < 8 THEN day + CASE k {' '.join(f'WHEN {k} THEN {v}' for k, v in _LAYOUT_HOURS.items())}
       ELSE INTERVAL 0 HOUR END END AS filing_ts,
       CASE WHEN k < 8 THEN CAST(day AS DATE) END AS trade_date, CAST(day AS DATE) AS european
FROM (SELECT o_orderkey, date_trunc('day', o_orderdate) AS day, o_orderkey % 10 AS k FROM orders)""")
def date_layouts_q(spark, sf_dir):
    orders = fx.table(spark, sf_dir, "orders")
    # date_format goes through the session zone: the day's noon is the same day in any
    day = F.to_date("o_orderdate").cast("string")
    texts = orders.select("o_orderkey", F.concat(day, F.lit(" 12:00:00")).cast("timestamp").alias("o_orderdate"))
    pick = F.element_at(F.array(*[F.expr(t) for t in _LAYOUT_TEXTS]), (F.col("o_orderkey") % 10 + 1).cast("int"))
    df = texts.select("o_orderkey", pick.alias("text"), F.date_format("o_orderdate", "dd/MM/yyyy").alias("european"))
    day_first = S.votes_day_first(df, "european")
    return df.select("o_orderkey", S.coerce_ts("text").alias("filing_ts"), S.trade_date_text("text").alias("trade_date"),
                     S.coerce_date("european", day_first).alias("european"))


# Number texts; the JVM's own number syntax is no number
_NUMBER_TEXTS = ["CAST(l_linenumber AS STRING) || '.5'", "CAST(l_linenumber AS STRING) || 'd'", "CAST(l_linenumber AS STRING) || '.5f'", "'0x1p3'",
                 "'NaN'", "'-Infinity'", "' +$1,00' || CAST(l_linenumber AS STRING) || ' '", "CAST(l_linenumber AS STRING) || 'e2'", "'1e999'", "'.'"]


@register("number_texts", """
SELECT l_orderkey, l_linenumber, k,
       CASE k WHEN 0 THEN l_linenumber + 0.5 WHEN 6 THEN 1000.0 + l_linenumber WHEN 7 THEN l_linenumber * 100.0 END::DOUBLE AS value,
       CASE k WHEN 0 THEN l_linenumber + 0.5 WHEN 6 THEN 1000.0 + l_linenumber WHEN 7 THEN l_linenumber * 100.0 END::DOUBLE AS price,
       CASE k WHEN 0 THEN l_linenumber + 0.5 WHEN 7 THEN l_linenumber * 100.0 WHEN 5 THEN -1e300 WHEN 4 THEN 1e300 WHEN 8 THEN 1e300 ELSE 0.0 END::DOUBLE AS filed
FROM (SELECT l_orderkey, l_linenumber, (l_orderkey + l_linenumber) % 10 AS k FROM lineitem)""")
def number_texts_q(spark, sf_dir):
    df = fx.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", ((F.col("l_orderkey") + F.col("l_linenumber")) % 10).alias("k"))
    text = F.element_at(F.array(*[F.expr(t) for t in _NUMBER_TEXTS]), (F.col("k") + 1).cast("int"))
    filed = S.float_or_zero(text)   # NaN and infinities stay; they are rejected later
    shown = F.when(F.isnan(filed), 1e300).when(filed > 1e300, 1e300).when(filed < -1e300, -1e300).otherwise(filed)
    return df.select("l_orderkey", "l_linenumber", "k", S.money_value(text).alias("value"), S.money_price(text).alias("price"), shown.alias("filed"))
