"""Corpus pipeline: quality, toxicity, near-duplicates, source mixing, packing.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame that is written and read
again as the next stage's docs. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hazegrid.llm import mixing, neardup, packing, quality, toxicity
from hazegrid.llm.common import read, written

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: Most passes over one source when sources are mixed; every document is taken at least once.
PASSES = 2.0

#: No SQL can express the trained stages; a brute-force version is in tests/llm.
ORACLE_SQL = None


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the co-trained quality classifier keeps."""
    labels = read(spark, sf_dir, "labels")
    return quality.score(docs, labels, carry=COLUMNS).filter("kept").select(*COLUMNS)


def civil_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the toxicity classifier does not flag."""
    labels = read(spark, sf_dir, "labels")
    return toxicity.score(docs, labels, carry=COLUMNS).filter("predicted = 0").select(*COLUMNS)


def distinct_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group (five words, similarity 0.8)."""
    return neardup.without_duplicates(docs, size=5, percent=80).select(*COLUMNS)


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources mixed at a temperature; small ones repeat, no document is left out."""
    return mixing.mix(docs, budget=None, passes=PASSES).select(*COLUMNS)


def packed_batches(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row in a token-budget batch of its length bucket."""
    return packing.pack(docs).select("doc_id", "source", "n_tokens", "bucket", "padded_to",
                                     "batch", "slot")


STAGES = [("quality", good_documents), ("toxicity", civil_documents),
          ("near_duplicates", distinct_documents), ("mixing", mixed_sources),
          ("packing", packed_batches)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select(*[F.col(c) for c in COLUMNS])
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
