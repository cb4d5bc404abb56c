"""Scratch tables in the cluster's shared folder, and small helpers of the operators.

Operators look only at the columns they are told to use and rename them at once, so
further columns of the input, whatever their names, never clash with their own.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kinfold.session import ensure_checkpoint_dir

WORD = r"[^\x20\x09-\x0D]+"       # the words of every contract that counts words


def scratch(spark: SparkSession) -> str:
    """A new folder below spark.checkpoint.dir (a session without one gets its own)."""
    ensure_checkpoint_dir(spark)
    root = spark.sparkContext.getCheckpointDir()
    return f"{root}/kinfold-{uuid.uuid4().hex}"


def stored(df: DataFrame) -> DataFrame:
    """`df`, written as Parquet to the shared folder and read again.

    Cuts the lineage: what follows survives the loss of any executor without
    running `df` again, and several readers do not compute it twice.
    """
    spark = df.sparkSession
    path = scratch(spark)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def arrow_url(path: str) -> str:
    """Hadoop writes file:/x where Arrow's file systems want file:///x."""
    return re.sub(r"^file:/(?!/)", "file:///", path)


def bucket_of(col: Column, n: int) -> Column:
    """A repeatable share 0..n-1 of any id, nulls included."""
    return F.pmod(F.xxhash64(col), F.lit(n))


def documents(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text) of a table; a null text becomes the empty text."""
    return df.select(F.col(f"`{id_col}`").alias("doc_id"),
                     F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))


def split_group(col: Column, modulus: int) -> Column:
    """crc32 of an id as text, modulo `modulus`: folds that need no stored list."""
    return F.pmod(F.crc32(col.cast("string").cast("binary")), F.lit(modulus))
