"""From raw documents to sampled piece ids, in five stages.

Each stage takes (spark, docs, sf_dir) and works on everything its predecessor kept; all
but the last return the columns of documents.  `run` stores what a stage returns before the
next one reads it, so a lost executor costs a part of one stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from kinfold.examples.tables import table
from kinfold.llm import exact, minhash, mixing, pieces, toxic
from kinfold.llm.common import stored
from kinfold.session import tune

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
NEAR_PERCENT = 80        # shingle similarity, in percent, at which documents are one group


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not predicted toxic.  A null id cannot be traced and stays."""
    judged = toxic.toxicity(docs, table(spark, sf_dir, "labels"))
    rejected = judged.filter("predicted = 1").select(judged["doc_id"].alias("_rejected")).distinct()
    return docs.select(*COLUMNS).join(rejected, docs["doc_id"] == rejected["_rejected"], "left_anti")


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest id."""
    return exact.keep_one(docs.select(*COLUMNS))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the smallest id, of each group of near copies."""
    groups = minhash.near_dedup(docs, percent=NEAR_PERCENT)
    dropped = groups.filter("not kept").select(groups["doc_id"].alias("_dropped")).distinct()
    return docs.select(*COLUMNS).join(dropped, docs["doc_id"] == dropped["_dropped"], "left_anti")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The words that the mix takes: a row per document and pass over its source."""
    return mixing.mixed_documents(docs.select(*COLUMNS))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sampled segmentations of every text, as piece ids."""
    return pieces.encode(docs)


STAGES = [("toxicity", toxicity), ("exact dedup", exact_dedup), ("near dedup", near_dedup),
          ("mixing", mix_sources), ("pieces", encode)]

ORACLE_SQL = None        # neither the classifier nor the sampling can be said in SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    tune(spark)
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
