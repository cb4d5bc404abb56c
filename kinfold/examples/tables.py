"""Access to the test tables, and entity tables derived from them.

A derived table is one portable SQL text: Spark runs it over DataFrames, and
the same text (with plain table names) serves as a CTE of the check SQL.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def derive_all(spark: SparkSession, sf_dir: str, texts: dict[str, str]) -> dict[str, DataFrame]:
    """Run portable SQL texts whose tables are written {name}."""
    needs = {k: set(re.findall(r"\{(\w+)\}", sql)) for k, sql in texts.items()}
    loaded = {n: table(spark, sf_dir, n) for n in set().union(*needs.values())}
    return {k: spark.sql(sql, **{n: loaded[n] for n in needs[k]}) for k, sql in texts.items()}


def plain(sql: str) -> str:
    return re.sub(r"\{(\w+)\}", r"\1", sql)


def spread(df: DataFrame) -> DataFrame:
    """Share a one-file table among all cores; larger tables come split already."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
