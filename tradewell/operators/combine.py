"""A1: combine the transactions of a filing into volume-weighted trades.

Input: one row per parsed transaction with the filing header carried along
(``accession`` plus the header columns) and ``trade_type``, ``a_d``,
``trade_date``, ``price`` (double), ``qty`` (signed bigint), ``x_flag``.

Group key: filing, trade type, A/D code (and the trade date with
``by_date=True``). NB: without ``by_date`` *every* trade of the filing with the
same (type, A/D) merges, whatever the date gap -- the reference's behaviour.

One hash aggregate: partial sums run map-side, so a filing with a huge number
of transactions shrinks to one row per map task before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewell.functions.scalars import round_half_away

# Header columns constant within a filing: part of the key, so order-free.
HEADER_COLS = ["x_flag", "filing_ts", "ticker", "insider_name", "title"]

# A gross value is the double product price x |qty|, as the reference takes it.
# Products are summed as decimals of ten places, so that the sum does not
# depend on row order; the price itself keeps all its digits.
VALUE_DECIMAL = "decimal(38,10)"
AMOUNT_REASON = "amount out of range"


def combine_transactions(tx: DataFrame, by_date: bool = False,
                         header_cols: list[str] | None = None,
                         filing_key: str | list[str] = "accession",
                         signed_value: bool = False) -> DataFrame:
    """``signed_value=False`` keeps the reference's unsigned gross value (Q7);
    True gives the value the sign of the quantity, as screener rows carry it,
    so the same sale from both sources shares one dedup key. A group whose
    share or value sum cannot be held is left out (``combine_with_rejects``
    returns it)."""
    return combine_with_rejects(tx, by_date, header_cols, filing_key, signed_value)[0]


def combine_with_rejects(tx: DataFrame, by_date: bool = False, header_cols: list[str] | None = None,
                         filing_key: str | list[str] = "accession",
                         signed_value: bool = False) -> tuple[DataFrame, DataFrame]:
    """-> (trades, rejects): rejects has the filing key and a reason."""
    header_cols = [c for c in (HEADER_COLS if header_cols is None else header_cols)
                   if c in tx.columns]
    fkeys = [filing_key] if isinstance(filing_key, str) else list(filing_key)
    gross, lost = _gross()
    g = (tx.groupBy(*group_keys(fkeys, header_cols, by_date))
         .agg(F.try_sum("qty").alias("total_qty"),
              F.try_sum(gross).alias("total_value"),
              F.count_if(lost).alias("n_lost"),
              F.min("trade_date").alias("first_trade_date"),
              F.count(F.lit(1)).alias("n_trades")))
    return _finish(g, fkeys, header_cols, signed_value)


def group_keys(fkeys: list[str], header_cols: list[str], by_date: bool) -> list[str]:
    return fkeys + header_cols + ["trade_type", "a_d"] + (["trade_date"] if by_date else [])


def _gross() -> tuple[F.Column, F.Column]:
    """The gross value of a transaction, and whether it cannot be held."""
    gross = (F.col("price") * F.abs(F.col("qty").cast("double"))).try_cast(VALUE_DECIMAL)
    return gross, gross.isNull() & F.col("price").isNotNull() & F.col("qty").isNotNull()


# A filing whose transactions arrive in parts ------------------------------------
QTY_DECIMAL = "decimal(38,0)"


def part_sums(tx: DataFrame, by_date: bool = False, fkeys: tuple = ("cik", "accession")) -> DataFrame:
    """Mergeable sums of each group of the transactions at hand: shares, gross
    value, transactions whose value cannot be held, first date, number. Sums
    are exact decimals, so parts may be added in any order; a sum beyond 38
    digits counts as a lost value."""
    gross, lost = _gross()
    g = (tx.groupBy(*group_keys(list(fkeys), HEADER_COLS, by_date))
         .agg(F.try_sum(F.col("qty").cast(QTY_DECIMAL)).alias("sum_qty"), F.count("qty").alias("n_qty"),
              F.try_sum(gross).alias("sum_value"), F.count(gross).alias("n_value"),
              F.count_if(lost).alias("n_lost"), F.min("trade_date").alias("first_trade_date"),
              F.count(F.lit(1)).alias("n_trades")))
    return _mark_overflow(g)


def _mark_overflow(g: DataFrame) -> DataFrame:
    over = lambda s, n: (F.col(s).isNull() & (F.col(n) > 0)).cast("bigint")
    return g.withColumn("n_lost", F.col("n_lost") + over("sum_qty", "n_qty") + over("sum_value", "n_value"))


def merge_parts(parts: DataFrame, by_date: bool = False, fkeys: tuple = ("cik", "accession")) -> DataFrame:
    """The sums of several parts as one part; a partial aggregate like the combine itself."""
    g = (parts.groupBy(*group_keys(list(fkeys), HEADER_COLS, by_date))
         .agg(F.try_sum("sum_qty").cast(QTY_DECIMAL).alias("sum_qty"), F.sum("n_qty").alias("n_qty"),
              F.try_sum("sum_value").cast(VALUE_DECIMAL).alias("sum_value"), F.sum("n_value").alias("n_value"),
              F.sum("n_lost").alias("n_lost"), F.min("first_trade_date").alias("first_trade_date"),
              F.sum("n_trades").alias("n_trades")))
    return _mark_overflow(g)


def combine_parts(parts: DataFrame, by_date: bool = False, fkeys: tuple = ("cik", "accession"),
                  signed_value: bool = False) -> tuple[DataFrame, DataFrame]:
    """Parts of any number of batches -> (trades, rejects), as
    ``combine_with_rejects`` gives for all their transactions at once."""
    g = merge_parts(parts, by_date, fkeys).withColumns({
        "total_qty": F.col("sum_qty").try_cast("bigint"), "total_value": F.col("sum_value")})
    return _finish(g, list(fkeys), HEADER_COLS, signed_value)


def _finish(g: DataFrame, fkeys: list[str], header_cols: list[str], signed_value: bool) -> tuple[DataFrame, DataFrame]:
    bad = (F.col("n_lost") > 0) | F.col("total_qty").isNull() | F.col("total_value").isNull()
    rejects = g.where(bad).select(*fkeys, F.lit(AMOUNT_REASON).alias("reject"))
    g = g.where(~bad)
    total_value = F.col("total_value").cast("double")
    avg_price = F.when(F.col("total_qty") == 0, F.lit(0.0)).otherwise(
        total_value / F.abs(F.col("total_qty")))
    out = g.select(
        *fkeys,
        *[c for c in header_cols if c != "x_flag"],
        (F.col("x_flag") if "x_flag" in header_cols else F.lit(""))
        .alias("x_flag_in"),
        "trade_type",
        F.col("first_trade_date").alias("trade_date"),
        round_half_away(avg_price, 2).alias("price"),
        F.col("total_qty").alias("qty"),
        (F.when(F.col("total_qty") < 0, -round_half_away(total_value, 0))
         .otherwise(round_half_away(total_value, 0)) if signed_value
         else round_half_away(total_value, 0)).alias("value"),
        "n_trades",
    )
    out = out.withColumn(
        "x_flag",
        F.concat(F.coalesce(F.col("x_flag_in"), F.lit("")),
                 F.when(F.col("n_trades") > 1, F.lit("M")).otherwise(F.lit(""))),
    ).drop("x_flag_in")
    return out, rejects
