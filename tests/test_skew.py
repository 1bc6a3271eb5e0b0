"""Hot keys: one filing / dedup key / CIK / ticker holding a third of all
rows. Results must stay exact; the plans keep their partial (map-side) steps."""

import datetime as dt

from pyspark.sql import functions as F

from tradewell.operators import event_study as ev
from tradewell.operators.combine import combine_transactions
from tradewell.operators.dedup import dedup_keep_first
from tradewell.operators.resolve import limit_filings

N = 30_000


def test_hot_filing_combine(spark):
    ids = spark.range(N).repartition(8)
    tx = ids.select(
        F.when(F.col("id") % 3 == 0, F.lit("HOT")).otherwise(F.concat(F.lit("f"), (F.col("id") % 997).cast("string")))
        .alias("accession"),
        F.lit("").alias("x_flag"), F.lit("S - Sale").alias("trade_type"), F.lit("D").alias("a_d"),
        F.date_add(F.lit(dt.date(2024, 1, 1)), (F.col("id") % 20).cast("int")).alias("trade_date"),
        ((F.col("id") % 100) / 4).alias("price"), (-(F.col("id") % 7 + 1)).alias("qty"))
    out = combine_transactions(tx, header_cols=["x_flag"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "partial_try_sum" in plan
    hot = out.where(F.col("accession") == "HOT").collect()[0]
    want_qty = sum(-(i % 7 + 1) for i in range(0, N, 3))
    want_val = sum((i % 100) / 4 * (i % 7 + 1) for i in range(0, N, 3))
    assert hot.qty == want_qty and hot.value == round(want_val) and hot.x_flag == "M"


def test_hot_dedup_key(spark):
    ids = spark.range(N).repartition(8)
    rows = ids.select(
        F.lit("").alias("x_flag"), F.lit(dt.datetime(2024, 1, 5)).cast("timestamp_ntz").alias("filing_ts"),
        F.lit(dt.date(2024, 1, 3)).alias("trade_date"),
        F.when(F.col("id") % 3 == 0, F.lit("HOT")).otherwise(F.col("id").cast("string")).alias("ticker"),
        F.lit("Doe").alias("insider_name"), F.col("id").cast("string").alias("title"),
        F.lit("P - Purchase").alias("trade_type"), F.lit(1.0).alias("price"), F.lit(1).cast("bigint").alias("qty"),
        F.lit(1.0).alias("value"), F.col("id").cast("string").alias("accession"),
        (F.col("id") % 2).cast("int").alias("source_rank"))
    out = dedup_keep_first(rows)
    assert "partial_min_by" in out._jdf.queryExecution().executedPlan().toString()
    assert out.count() == 1 + (N - N // 3)
    hot = out.where(F.col("ticker") == "HOT").collect()[0]
    # rank 0 rows of the hot key are ids divisible by 6; smallest title text wins
    assert hot.title == min(str(i) for i in range(0, N, 6))


def test_hot_cik_limit(spark):
    ids = spark.range(N).repartition(8)
    idx = ids.select(F.when(F.col("id") % 3 != 0, F.lit("HOT")).otherwise(F.col("id").cast("string")).alias("cik"),
                     F.col("id").cast("int").alias("pos"),
                     F.format_string("acc-%08d", F.col("id")).alias("accession"),
                     F.date_add(F.lit(dt.date(2000, 1, 1)), F.col("id").cast("int")).alias("filing_date"))
    got = limit_filings(idx, 5).where(F.col("cik") == "HOT").orderBy("pos").collect()
    first = sorted(i for i in range(N) if i % 3 != 0)[:5]
    assert [r.pos for r in got] == first


def test_hot_ticker_anchors(spark):
    ids = spark.range(N).repartition(8)
    anchors = ids.select(
        F.when(F.col("id") % 3 == 0, F.lit("HOT")).otherwise(F.concat(F.lit("T"), (F.col("id") % 50).cast("string")))
        .alias("ticker"),
        (F.lit(dt.datetime(2024, 1, 1)).cast("timestamp_ntz") + F.make_dt_interval(
            F.lit(0), (F.col("id") % 700).cast("int"), F.lit(0), F.lit(0))).alias("anchor_ts"))
    bars = spark.range(0, 40, 3).select(F.lit("HOT").alias("ticker"),
                                        F.date_add(F.lit(dt.date(2024, 1, 1)), F.col("id").cast("int")).alias("date"),
                                        F.col("id").cast("double").alias("close"))
    got = ev.nearest_bar(anchors, bars).where(F.col("ticker") == "HOT")
    bad = got.where(F.col("bar_date").isNull()).count()
    assert bad == 0
    # brute force on a sample of distinct anchors of the hot ticker
    bar_days = [dt.date(2024, 1, 1) + dt.timedelta(days=d) for d in range(0, 40, 3)]
    for r in got.select("anchor_ts", "bar_date").distinct().collect():
        best = min(bar_days, key=lambda b: (abs((dt.datetime.combine(b, dt.time()) - r.anchor_ts).total_seconds()), b))
        assert r.bar_date == best
