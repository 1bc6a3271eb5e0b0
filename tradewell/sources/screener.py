"""Screener pages from landed files, one HTML page per ticker.

A file is named after its ticker (``AAPL.html``, ``BRK.B.htm``) and read whole;
``compact_pages`` joins the many small files into Parquet once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def page_rows(text: DataFrame) -> DataFrame:
    """``(value, name)`` -> ``(ticker, html)``; the ticker is the file name (as
    the file system's URI writes it) without its ending, in capitals."""
    stem = F.regexp_replace(F.url_decode(F.replace("name", F.lit("+"), F.lit("%2B"))), r"(?i)\.html?$", "")
    return text.select(F.upper(stem).alias("ticker"), F.col("value").alias("html"))


def read_page_files(spark: SparkSession, path: str) -> DataFrame:
    """Landed pages -> ``(ticker, html)``."""
    return page_rows(spark.read.text(path, wholetext=True).select("value", F.col("_metadata.file_name").alias("name")))


def compact_pages(spark: SparkSession, src: str, dst: str) -> None:
    """Many small files -> Parquet, file sizes by bytes."""
    read_page_files(spark, src).hint("rebalance").write.mode("errorifexists").parquet(dst)


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Pages from Parquet (``ticker``, ``html``) or, where the path ends like a
    page or a pattern of pages, from landed files."""
    if path.lower().endswith((".html", ".htm")):
        return read_page_files(spark, path)
    return spark.read.parquet(path)
