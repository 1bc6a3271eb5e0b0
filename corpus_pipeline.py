"""Corpus pipeline: quality classifier, n-gram Jaccard join, benchmark
decontamination, mixing to target weights, sharding.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame: the documents
it keeps, with the columns of ``documents`` (the last one: the shards). A stage
works on all rows of its predecessor, whose output is written as Parquet and
read again. Input columns beyond the ids and texts ride along unchanged.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewell.llm.common import stored, table
from tradewell.llm.decontamination import find_leaks
from tradewell.llm.mixing import mix_sources, repeat_documents  # noqa: F401
from tradewell.llm.ngram_join import near_duplicates
from tradewell.llm.quality_classifier import score_quality
from tradewell.llm.sharding import shard_contiguous

N_SHARDS = 40


def _decided(docs: DataFrame, verdict: DataFrame) -> DataFrame:
    """Rows of docs whose doc_id is not in ``verdict`` (column _id). Null ids are
    never in it. Spark broadcasts the ids if their table is small."""
    return docs.join(verdict, docs["doc_id"] == verdict["_id"], "left_anti")


def quality(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject. A rejected id rejects
    every row with that id and text score; null ids are kept."""
    scores = score_quality(docs, table(spark, sf_dir, "labels"))
    bad = scores.where("predicted = 0 AND doc_id IS NOT NULL").select(F.col("doc_id").alias("_id")).distinct()
    return _decided(docs, stored(bad, "rejected"))


def near_copies(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one with the least id.
    Repeated rows of that document become one row."""
    groups = near_duplicates(docs)
    extra = groups.where("component_id < doc_id").select(F.col("doc_id").alias("_id")).distinct()
    kept = _decided(docs, stored(extra, "near-copies"))
    # rows that repeat an id are copies as well; only those ids are brought together
    again = stored(groups.groupBy("doc_id").count().where("count > 1 AND doc_id IS NOT NULL").select(F.col("doc_id").alias("_id")),
                   "repeated-ids")
    return _decided(kept, again).unionByName(
        kept.join(again, kept["doc_id"] == again["_id"], "left_semi").dropDuplicates(["doc_id"]))


def decontaminated(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item."""
    leaks = find_leaks(docs, table(spark, sf_dir, "benchmark"))
    return _decided(docs, stored(leaks.where("doc_id IS NOT NULL").select(F.col("doc_id").alias("_id")).distinct(), "leaks"))


def mixed(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix has it (0 to 3 times). Ids are unique
    here but for null ones, which stay once each."""
    return repeat_documents(docs)


def sharded(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shard and slot of every row."""
    return shard_contiguous(docs, N_SHARDS)


STAGES = [("quality", quality), ("near_copies", near_copies), ("decontaminated", decontaminated), ("mixed", mixed),
          ("sharded", sharded)]
# Trained and iterative stages have no SQL: tests hold each against a brute-force version.
ORACLE_SQL = None


def run(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
