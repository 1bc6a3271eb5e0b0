"""Daily price bars as ``(ticker, date, close)``.

Either a Parquet table with those columns, or per-ticker CSV exports with a
header holding ``Date`` and ``Close`` (other columns ignored), one file per
ticker named ``<TICKER>.csv``. Bars must be unique per (ticker, date): a
repeated date (which a daily export does not produce) keeps its highest
close, so the result never depends on file or partition order. Rows whose
date or close does not parse are dropped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewell.functions.scalars import coerce_date, strip_ws


def read_price_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).select("ticker", F.col("date").cast("date").alias("date"),
                                           F.col("close").cast("double").alias("close"))


def read_price_csv(spark: SparkSession, path: str) -> DataFrame:
    """Each file is read whole and mapped by *its own* header (Spark's CSV
    reader would apply the first file's header to every file by position).
    A per-ticker daily export is bounded by the calendar (about 252 lines a
    year), so a file per row is safe whatever the number of tickers."""
    t = spark.read.text(path, wholetext=True).select(
        F.col("_metadata.file_name").alias("_file"),
        F.filter(F.split(F.col("value"), r"\r?\n"), lambda x: x != F.lit("")).alias("lines"))
    header = F.transform(F.split(F.element_at("lines", 1), ","), lambda h: F.btrim(strip_ws(h), F.lit('"')))
    t = t.select("_file", F.array_position(header, "Date").cast("int").alias("_di"),
                 F.array_position(header, "Close").cast("int").alias("_ci"),
                 F.explode(F.slice("lines", 2, 1 << 30)).alias("_line"))
    cells = F.split(F.col("_line"), ",")
    cell = lambda i: F.when(F.col(i) > 0, F.try_element_at(cells, F.col(i)))
    bars = t.select(
        F.upper(F.regexp_extract("_file", r"^(.+?)\.csv$", 1)).alias("ticker"),
        coerce_date(cell("_di")).alias("date"),
        strip_ws(cell("_ci")).try_cast("double").alias("close"))
    bars = bars.where(F.col("date").isNotNull() & F.col("close").isNotNull() & ~F.isnan("close"))
    return bars.groupBy("ticker", "date").agg(F.max("close").alias("close"))
