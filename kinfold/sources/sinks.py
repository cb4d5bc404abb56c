"""Writers: dated stage output, quarantine, serving tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from .. import fixed
from .partitions import STAGE


def observed(df: DataFrame, counts: Mapping[str, Column]) -> tuple[DataFrame, Observation]:
    """`df` and counts of it that the next write of `df` collects on its way: no job of
    their own, no second scan."""
    seen = Observation()
    return df.observe(seen, *[c.alias(name) for name, c in counts.items()]), seen


def write_changes(df: DataFrame, base: str, entity: str, date: str,
                  max_records: int = fixed.MAX_RECORDS_PER_FILE) -> str:
    """Captured changes of one entity and date.  A repeated run replaces that folder and
    nothing else; without changes it holds an empty table of the same columns."""
    path = f"{base}/{entity}/{STAGE}={date}"
    df.write.mode("overwrite").option("maxRecordsPerFile", max_records).parquet(path)
    return path


def write_stage(df: DataFrame, base: str, date: str,
                max_records: int = fixed.MAX_RECORDS_PER_FILE) -> str:
    """Replace one date partition of a stage; the other dates stay."""
    (df.withColumn(STAGE, F.lit(date)).write.mode("overwrite")
       .option("partitionOverwriteMode", "dynamic")
       .option("maxRecordsPerFile", max_records)
       .partitionBy(STAGE).parquet(base))
    return f"{base}/{STAGE}={date}"


def write_table(df: DataFrame, path: str,
                max_records: int = fixed.MAX_RECORDS_PER_FILE) -> str:
    df.write.mode("overwrite").option("maxRecordsPerFile", max_records).parquet(path)
    return path


def write_serving(tables: Mapping[str, DataFrame], base: str) -> dict[str, str]:
    return {name: write_table(df, f"{base}/{name}") for name, df in tables.items()}


# --- the identity index as a bucketed table -------------------------------------------------

INDEX_BLOCK = ["pFirstName", "pLastName", "_dob"]


def write_index(index: DataFrame, name: str, date: str, buckets: int) -> None:
    """Add one date of the identity index to the catalogue table `name`, replacing that date.

    The table is bucketed by the block of the look-up (`_dob` is the trimmed birth date), so
    later runs join today's rows to it without moving it.  The number of buckets is fixed by
    the first write: about one per 128 MB that the index is to reach.
    """
    spark = index.sparkSession
    rows = index.withColumn("_dob", F.trim(F.col("DateOfBirth").cast("string"))).withColumn(STAGE, F.lit(date))
    if not spark.catalog.tableExists(name):
        (rows.write.format("parquet").partitionBy(STAGE).bucketBy(buckets, *INDEX_BLOCK)
             .sortBy(*INDEX_BLOCK).saveAsTable(name))
        return
    mode = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(mode)
    spark.conf.set(mode, "dynamic")
    try:
        rows.select(*spark.table(name).columns).write.insertInto(name, overwrite=True)
    finally:
        spark.conf.set(mode, before)


def read_index(spark, name: str, before: str) -> DataFrame:
    """Index rows of dates before `before`, as `identity.carry_over` takes them."""
    return spark.table(name).filter(F.col(STAGE).cast("string") < before).drop(STAGE)
