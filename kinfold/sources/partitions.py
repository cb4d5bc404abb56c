"""Loading entity tables kept in date partitions.

Every load is one reader on the dataset's base path plus a predicate on the
partition column, so Spark prunes folders itself; missing dates simply match
nothing.  Dates are compared as text.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import fixed
from ..operators.shape import required_columns

OPEN, CLOSED, STORED, STAGE = "ods", "nds", "vds", "p_date"


@dataclass(frozen=True)
class Entity:
    """Where one entity lives: open and archive snapshots, closed rows, increments."""

    name: str
    open_path: str
    closed_path: str
    stored_path: str
    fmt: str = "parquet"
    stored_fmt: str = "avro"
    columns: tuple = ()

    @classmethod
    def from_config(cls, entry: Mapping, columns: Sequence[str] = (),
                    versioned=fixed.VERSIONED_ENTITIES, stored_fmt: str = "avro") -> Entity:
        """Closed rows and increments lie where the entry says (closedPathUrl,
        storedPathUrl); without an entry, beside the open ones (see `beside`)."""
        base = entry["pathUrl"]
        closed = entry.get("closedPathUrl") or beside(base, "nonopen") + (
            "version" if entry["entityName"] in versioned else "")
        stored = entry.get("storedPathUrl") or beside(base, "storage")
        return cls(entry["entityName"], base, closed, stored, entry["dataFormat"], stored_fmt,
                   tuple(columns))


def beside(path: str, kind: str) -> str:
    """.../<folder>open/<entity> → .../<folder><kind>/<entity>: the last part of the parent
    folder's name changes, nothing else in the path."""
    folder, _, name = path.rstrip("/").rpartition("/")
    if not folder.endswith("open"):
        raise ValueError(f"{path}: give closedPathUrl and storedPathUrl, its folder is not ...open")
    return f"{folder.removesuffix('open')}{kind}/{name}"


def entities(config: Mapping, needed: Mapping[str, Sequence[str]] | None = None, **kw) -> list[Entity]:
    """Snapshot entities with the columns to read; without `needed`, what the config maps."""
    need = required_columns(config) if needed is None else needed
    return [Entity.from_config(e, need.get(e["entityName"], ()), **kw)
            for e in config["entityDetails"] if e["entityType"] == "snapshot"]


def _read(spark: SparkSession, path: str, fmt: str) -> DataFrame:
    return spark.read.format(fmt).load(path)


def _date(column: str):
    return F.col(column).cast("string")


def _pick(df: DataFrame, columns: Sequence[str], partition: str) -> DataFrame:
    return df.select(*columns) if columns else df.drop(partition)


def partitions_between(df: DataFrame, lo: str, hi: str, column: str,
                       include_hi: bool = True) -> DataFrame:
    upper = _date(column) <= hi if include_hi else _date(column) < hi
    return df.filter((_date(column) >= lo) & upper)


def latest_partition(df: DataFrame, column: str, upto: str | None = None) -> DataFrame:
    """Rows of the greatest partition (not after `upto`)."""
    known = df if upto is None else df.filter(_date(column) <= upto)
    newest = known.agg(F.max(_date(column)).alias("_newest"))
    return known.join(F.broadcast(newest), _date(column) == F.col("_newest"), "left_semi")


def between_or_latest(df: DataFrame, lo: str, hi: str, column: str) -> DataFrame:
    """The range, or the latest partition up to its start when the range is empty."""
    span = partitions_between(df, lo, hi, column)
    if span.select(F.lit(1)).limit(1).count():
        return span
    return latest_partition(df, column, lo)


def tag_source(df: DataFrame, label: str, column: str = "Source") -> DataFrame:
    return df.withColumn(column, F.lit(label))


def current_versions(df: DataFrame, end: str = "VersionEndUTC",
                     sentinel: str = fixed.OPEN_END) -> DataFrame:
    return df.filter(F.col(end) == sentinel)


def live_changes(df: DataFrame, op: str = "c_operationtype") -> DataFrame:
    """Increment rows other than 'A'; a null operation type is no match either."""
    return df.filter(F.col(op) != "A")


def load_snapshots(spark: SparkSession, entity: Entity, business: str, archive: str,
                   tagged: bool = False) -> DataFrame:
    df = _read(spark, entity.open_path, entity.fmt)
    df = df.filter(_date(OPEN).isin(business, archive))
    if not tagged:
        return _pick(df, entity.columns, OPEN)
    label = F.when(_date(OPEN) == business, "Open").otherwise("Archive")
    kept = _pick(df.withColumn("Source", label), (), "_none")
    return kept.select(*entity.columns, "Source") if entity.columns else kept.drop(OPEN)


def load_closed(spark: SparkSession, entity: Entity, lo: str, hi: str,
                current_only: bool = False) -> DataFrame:
    df = partitions_between(_read(spark, entity.closed_path, entity.fmt), lo, hi, CLOSED)
    df = df.filter(F.col("c_operationtype") == "D")
    if current_only:
        df = current_versions(df)
    return _pick(df, entity.columns, CLOSED)


def load_increment(spark: SparkSession, entity: Entity, lo: str, hi: str) -> DataFrame:
    df = between_or_latest(_read(spark, entity.stored_path, entity.stored_fmt), lo, hi, STORED)
    return _pick(live_changes(df), entity.columns, STORED)


def changed_rows(spark: SparkSession, entity: Entity, lo: str, hi: str) -> DataFrame:
    """The 'A' rows of the increments (change capture)."""
    df = between_or_latest(_read(spark, entity.stored_path, entity.stored_fmt), lo, hi, STORED)
    return _pick(df.filter(F.col("c_operationtype") == "A"), entity.columns, STORED)


def exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    return hadoop_path.getFileSystem(conf).exists(hadoop_path)


def load_full(spark: SparkSession, config: Mapping, start: str, end: str,
              current_only: bool = False, **kw) -> dict[str, DataFrame]:
    """Business and archive snapshots plus closed rows of the whole range."""
    out = {}
    for e in entities(config, **kw):
        tagged = e.name == "all_booking"
        df = load_snapshots(spark, e, end, start, tagged)
        if exists(spark, e.closed_path):
            closed = load_closed(spark, e, start, end,
                                 current_only and e.name in fixed.VERSIONED_ENTITIES)
            df = df.unionByName(tag_source(closed, "NonOpen") if tagged else closed)
        out[e.name] = df
    return out


def load_increments(spark: SparkSession, config: Mapping, start: str, end: str,
                    **kw) -> dict[str, DataFrame]:
    out = {}
    for e in entities(config, **kw):
        df = load_increment(spark, e, start, end)
        out[e.name] = tag_source(df, "Storage") if e.name == "all_booking" else df
    return out


def load_registered(spark: SparkSession, path: str, start: str, end: str, incremental: bool,
                    fmt: str = "orc", stored_fmt: str = "avro", closed_path: str | None = None,
                    stored_path: str | None = None) -> DataFrame:
    """Registered customers without audit and partition columns."""
    if incremental:
        stored = _read(spark, stored_path or beside(path, "storage"), stored_fmt)
        return between_or_latest(stored, start, end, STORED).drop(*fixed.AUDIT_COLUMNS, STORED)
    opened = _read(spark, path, fmt).filter(_date(OPEN).isin(end, start))
    closed = _read(spark, closed_path or beside(path, "nonopen"), fmt)
    closed = between_or_latest(closed, start, end, CLOSED)
    return (opened.drop(*fixed.AUDIT_COLUMNS, OPEN)
            .unionByName(closed.drop(*fixed.AUDIT_COLUMNS, CLOSED)))


def read_stage(spark: SparkSession, path: str, lo: str, hi: str | None = None,
               include_hi: bool = True) -> DataFrame:
    """Output of an earlier stage over [lo, hi] (one date when hi is missing)."""
    df = spark.read.parquet(path)
    return partitions_between(df, lo, lo if hi is None else hi, STAGE, include_hi).drop(STAGE)
