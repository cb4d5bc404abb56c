"""Exact de-duplication: sorted digest runs, merged in binomial rounds.

Every partition turns its texts into one run: distinct digests in order, each with the
identifier to keep and a count.  `FAN_IN` neighbouring runs meet in each round, so after
log(RUNS) rounds one run is left, which stays spread over all tasks by digest.  A digest
that a third of all rows share travels as one entry per run, never as its rows.  The
aggregate over a struct is Spark's sort aggregate: runs are sorted locally, partial
results merge in digest order.

Entries are verified at every level: the merge key is SHA-256 with the byte length and an
independent 64-bit hash of the text, so entries merge only if all three agree.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import documents, stored

RUNS = 64        # first-level runs; partitions beyond it share a run
FAN_IN = 8       # runs that meet in one round
IDENTITY = ["digest", "n_bytes", "proof"]


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    raw = F.col("text").cast("binary")
    return documents(docs, id_col, text_col).select(
        "doc_id", F.unhex(F.sha2(raw, 256)).alias("digest"),
        F.octet_length(raw).cast("long").alias("n_bytes"), F.xxhash64(raw).alias("proof"))


def merge_runs(entries: DataFrame, keep: str = "max", runs: int = RUNS,
               fan_in: int = FAN_IN) -> DataFrame:
    """One row per different text: digest, n_bytes, proof, keep_id, group_size."""
    best = F.max if keep == "max" else F.min
    # min() over structs would prefer a null id; such rows never decide against others
    held = F.struct((F.col("doc_id").isNull() if keep == "min" else F.lit(False)).alias("last"),
                    "doc_id")
    level = entries.select(F.pmod(F.spark_partition_id(), F.lit(runs)).alias("run"), *IDENTITY,
                           held.alias("held"), F.lit(1).cast("long").alias("n"))
    left = runs
    while left > 1:
        left = -(-left // fan_in)
        level = (level.withColumn("run", F.floor(F.col("run") / fan_in).cast("int"))
                 .groupBy("run", *IDENTITY)
                 .agg(best("held").alias("held"), F.sum("n").alias("n")))
    return level.select(*IDENTITY, F.col("held.doc_id").alias("keep_id"),
                        F.col("n").alias("group_size"))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                keep: str = "max") -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    Equal means identical bytes; a null text equals the empty one.  Of equal texts the row
    with the largest (`keep="min"`: smallest) id stays.  Null ids never win over others; a
    group of null ids alone keeps all its rows, and rows that repeat the winning id are
    all marked kept, for nothing tells them apart.  An empty table gives no rows.
    """
    rows = stored(digests(docs, id_col, text_col))
    merged = merge_runs(rows, keep)
    return rows.join(merged, IDENTITY).select(
        "doc_id", "keep_id", "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             keep: str = "max") -> DataFrame:
    """The documents that stay, with all their columns.  Rows of one id and text stay or go
    together."""
    stays = (exact_dedup(docs, id_col, text_col, keep).filter("kept")
             .select(F.col("doc_id").alias("_stays"), F.col("text_sha256").alias("_sha")).distinct())
    sha = F.sha2(F.coalesce(docs[text_col], F.lit("")).cast("binary"), 256)
    return docs.join(stays, docs[id_col].eqNullSafe(stays["_stays"]) & (sha == stays["_sha"]), "left_semi")
