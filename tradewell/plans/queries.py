"""Registered queries: Spark plan + equivalent DuckDB SQL, keyed by name.

Each Spark callable takes ``(spark, sf_dir)`` and reads whole tables.
Every computed column is aliased identically on both sides.
"""

from __future__ import annotations

from tradewell.plans import fixtures as fx
from tradewell.plans import oracle as osql
from tradewell.plans.registry import ORACLE, QUERIES, register  # noqa: F401
from tradewell.operators.combine import combine_transactions


TRADE_OUT = ["accession", "x_flag", "trade_type", "trade_date", "price", "qty", "value"]


# A1 (flagship) -----------------------------------------------------------------
@register("combine_trades",
          f"SELECT {', '.join(TRADE_OUT)} FROM ({osql.combine(osql.LINEITEM_TX, False, ['x_flag'])})")
def combine_trades(spark, sf_dir):
    tx = fx.lineitem_transactions(fx.table(spark, sf_dir, "lineitem"))
    return combine_transactions(tx, by_date=False).select(*TRADE_OUT)


# A1a ---------------------------------------------------------------------------
@register("combine_trades_by_date",
          f"SELECT {', '.join(TRADE_OUT)} FROM ({osql.combine(osql.LINEITEM_TX, True, ['x_flag'])})")
def combine_trades_by_date(spark, sf_dir):
    tx = fx.lineitem_transactions(fx.table(spark, sf_dir, "lineitem"))
    return combine_transactions(tx, by_date=True).select(*TRADE_OUT)


# The other query groups register themselves on import.
from tradewell.plans import q_scalars  # noqa: E402,F401
from tradewell.plans import q_store  # noqa: E402,F401
from tradewell.plans import q_filings  # noqa: E402,F401
from tradewell.plans import q_resolve  # noqa: E402,F401
from tradewell.plans import q_events  # noqa: E402,F401
from tradewell.plans import q_screener  # noqa: E402,F401
from tradewell.plans import q_stream  # noqa: E402,F401
