"""SQL text for the DuckDB oracle: the same semantics written as plain SQL.

Only the expressions that repeat across queries live here; each query's SQL
is in ``tradewell.plans.queries``.
"""

from __future__ import annotations

from tradewell.functions.scalars import TRADE_CODE_LABELS, UNKNOWN_LABEL


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def case_map(expr: str, mapping: dict, default: str = "NULL") -> str:
    whens = " ".join(f"WHEN {q(k)} THEN {q(v)}" for k, v in mapping.items())
    return f"(CASE {expr} {whens} ELSE {default} END)"


def trade_type(code: str) -> str:
    return f"({code} || ' - ' || {case_map(code, TRADE_CODE_LABELS, q(UNKNOWN_LABEL))})"


def round_half_away(x: str, precision: int = 0) -> str:
    f = float(10 ** precision)
    s = f"(CAST({x} AS DOUBLE) * {f!r})"
    r = (f"(CASE WHEN abs({s} - trunc({s})) = 0.5 THEN trunc({s}) + sign({s}) "
         f"ELSE round_even({s}, 0) END)")
    return r if precision == 0 else f"({r} / {f!r})"


def signed_qty(qty: str, a_d: str) -> str:
    return f"(CASE WHEN {a_d} = 'D' THEN -{qty} ELSE {qty} END)"


def combine(tx_sql: str, by_date: bool, header: list[str]) -> str:
    """A1 over a transactions CTE named ``tx``."""
    keys = ["accession"] + header + ["trade_type", "a_d"] + (["trade_date"] if by_date else [])
    k = ", ".join(keys)
    tv = "CAST(total_value AS DOUBLE)"
    avg = f"(CASE WHEN total_qty = 0 THEN 0.0 ELSE {tv} / abs(total_qty) END)"
    hdr = "".join(f"{h}, " for h in header if h != "x_flag")
    xin = "coalesce(x_flag, '')" if "x_flag" in header else "''"
    return f"""
WITH tx AS ({tx_sql}),
g AS (
  SELECT {k},
         CAST(sum(qty) AS BIGINT) AS total_qty,
         sum(TRY_CAST(CAST(CAST(price AS DOUBLE) * abs(CAST(qty AS HUGEINT)) AS VARCHAR) AS DECIMAL(38,10))) AS total_value,
         min(trade_date) AS first_trade_date,
         count(*) AS n_trades
  FROM tx GROUP BY {k}
  HAVING abs(sum(qty)) <= 9223372036854775807
     AND count(*) = count(TRY_CAST(CAST(CAST(price AS DOUBLE) * abs(CAST(qty AS HUGEINT)) AS VARCHAR) AS DECIMAL(38,10))))
SELECT accession, {hdr}trade_type, first_trade_date AS trade_date,
       {round_half_away(avg, 2)} AS price,
       total_qty AS qty,
       {round_half_away(tv, 0)} AS value,
       {xin} || (CASE WHEN n_trades > 1 THEN 'M' ELSE '' END) AS x_flag
FROM g"""


LINEITEM_TX = f"""
SELECT printf('%010d', l_orderkey) AS accession,
       '' AS x_flag,
       {trade_type(case_map('l_returnflag', {'A': 'P', 'R': 'S', 'N': 'M'}))} AS trade_type,
       {case_map('l_linestatus', {'O': 'A', 'F': 'D'})} AS a_d,
       CAST(l_shipdate AS DATE) AS trade_date,
       l_extendedprice AS price,
       {signed_qty('CAST(l_quantity AS BIGINT)', case_map('l_linestatus', {'O': 'A', 'F': 'D'}))} AS qty
FROM lineitem"""


# R2 in SQL. Python's whitespace set, in RE2 syntax.
from tradewell.functions.scalars import PY_WS_CHARS  # noqa: E402

PY_WS_RE2 = "[" + "".join(f"\\x{{{ord(ch):x}}}" for ch in PY_WS_CHARS) + "]"
PY_WS_SQL = "(" + " || ".join(f"chr({ord(ch)})" for ch in PY_WS_CHARS) + ")"


def normalize_name(x: str) -> str:
    cap = ("array_to_string(list_transform(string_split(w, '-'), "
           "lambda p: upper(substr(p, 1, 1)) || lower(substr(p, 2))), '-')")
    fix = (f"CASE WHEN lower({cap}) LIKE 'mc%' AND length({cap}) > 2 "
           f"THEN substr({cap}, 1, 2) || upper(substr({cap}, 3, 1)) || lower(substr({cap}, 4)) "
           f"ELSE {cap} END")
    words = f"list_filter(regexp_split_to_array({x}, '{PY_WS_RE2}+'), lambda w: w <> '')"
    return f"array_to_string(list_transform({words}, lambda w: {fix}), ' ')"


def strip_ws(x: str) -> str:
    return f"trim({x}, {PY_WS_SQL})"


def owner_title(is_off: str, off_title: str, is_dir: str, is_ten: str, remarks: str) -> str:
    text = f"(CASE WHEN {off_title} = '' THEN NULL ELSE coalesce({off_title}, 'See Remarks') END)"
    text = (f"(CASE WHEN contains({text}, 'See Remarks') AND {remarks} IS NOT NULL "
            f"THEN nullif({remarks}, '') ELSE {text} END)")
    parts = (f"list_concat(CASE WHEN {is_off} IN ('true', '1') THEN [{text}] ELSE [] END, "
             f"CASE WHEN {is_dir} IN ('true', '1') THEN ['Director'] ELSE [] END, "
             f"CASE WHEN {is_ten} IN ('true', '1') THEN ['10% Owner'] ELSE [] END)")
    return (f"(CASE WHEN list_contains(list_transform({parts}, lambda p: p IS NULL), true) THEN NULL "
            f"WHEN len({parts}) = 0 THEN 'No Title' ELSE array_to_string({parts}, ', ') END)")


def money_text(cents: str) -> str:
    """Digits with thousands commas from a non-negative integer of cents."""
    whole = f"CAST(floor({cents} / 100) AS BIGINT)"
    frac = f"lpad(CAST(({cents}) % 100 AS STRING), 2, '0')"
    th = f"CAST(floor({whole} / 1000) AS BIGINT)"
    lo = f"CAST({whole} % 1000 AS STRING)"
    return (f"(CASE WHEN {th} > 0 THEN CAST({th} AS STRING) || ',' || lpad({lo}, 3, '0') "
            f"ELSE {lo} END || '.' || {frac})")
