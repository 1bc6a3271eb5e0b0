"""tradewell: Form 4 insider-trade analytics as Spark DataFrame jobs.

Layout:
  functions/  column expressions (rounding, names, titles, codes, cleaners)
  sources/    readers: trade store, watch list, ticker dictionary, filing
              index, filing corpus, screener pages, price bars
  operators/  DataFrame -> DataFrame steps: filing parse, combine, dedup,
              CIK resolution, screener rows, nearest-bar join, event study
  sinks/      trade-store writers (rewrite / append / versioned merge)
  streaming/  incremental merge with Structured Streaming
  plans/      test-data views and the registered queries
"""

from tradewell.session import get_spark  # noqa: F401
