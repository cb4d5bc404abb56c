"""The four stages from and to storage, in the order they are run."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import fixed
from ..operators.identity import ambiguous_people, identity_index, quality_metrics
from ..operators.resolve import PersonSpec
from ..session import tune
from ..sources import partitions, sinks
from .people import resolve_people, unify_profiles
from .profile import build_profiles, source_columns
from .serving import serving_rows, tables_of

# Position of each output in the config's storageDetails.
PROFILES, CLUSTERS, UNIFIED, SERVING, QUARANTINE, INDEX, CHANGES = range(7)


@dataclass
class Options:
    """What a run may switch; the defaults are the original flow."""

    current_only: bool = False          # of closed rows, the current versions only
    on_null_key: str = "merge"          # see golden_record
    excluded_status: int | None = None  # drop profiles of this booking status
    history: DataFrame | None = None    # conversion rates: revenue in the home currency
    impute_dob: bool = False
    rates: Mapping[str, float] = field(default_factory=lambda: fixed.CURRENCY_RATES)
    serving: Mapping[str, object] = field(default_factory=dict)   # keywords of serving.tables_of
    index_table: str | None = None      # identity index as a bucketed catalogue table of this name
    index_buckets: int = 64
    near_dates: bool = False            # see PersonSpec
    readings: DataFrame | None = None   # see PersonSpec


class Stages:
    """compute_profile → compute_dedupe → compute_ucp → compute_ui over one config.

    With a reportPath in the config, block sizes, quality metrics, the most ambiguous people
    and the counts of every stage are stored there.  With a seventh storage entry an
    incremental run also keeps the changes it captures, by entity and date.
    """

    def __init__(self, spark: SparkSession, config: Mapping, stored_fmt: str = "avro",
                 options: Options | None = None) -> None:
        self.spark = tune(spark)
        self.config = config
        self.stored_fmt = stored_fmt
        self.options = options or Options()
        self.counts: dict[str, dict] = {}      # of the stages this object has written

    def write(self, which: int, name: str, df: DataFrame, date: str, **counts: Column) -> str:
        """Store a stage; its counts are taken as its rows are written."""
        df, seen = sinks.observed(df, {"n_rows": F.count(F.lit(1)), **counts})
        out = sinks.write_stage(df, self.path(which), date)
        self.counts[name] = seen.get
        fields = ", ".join(f"{c} bigint" for c in seen.get)
        self.report(f"counts/{name}/{date}", self.spark.createDataFrame([tuple(seen.get.values())], fields))
        return out

    def report(self, name: str, df: DataFrame) -> None:
        if self.config.get("reportPath"):
            sinks.write_table(df, f"{self.config['reportPath']}/{name}")

    def path(self, which: int) -> str:
        return self.config["storageDetails"][which]["pathUrl"]

    def spec(self) -> PersonSpec:
        used = {"FirstName", "LastName", "DateOfBirth", "ProvisionalPrimaryKey", "PassengerID"}
        return PersonSpec(readings=self.options.readings, near_dates=self.options.near_dates, defaults={
            c["columnName"]: c.get("defaultValue") for c in self.config["profileSchema"]
            if c["columnName"] in used})

    def capture_changes(self, start: str, end: str) -> dict[str, str]:
        """Stores the 'A' rows of every entity's increments under the end date."""
        chosen = partitions.entities(self.config, source_columns(self.config), stored_fmt=self.stored_fmt)
        return {e.name: sinks.write_changes(partitions.changed_rows(self.spark, e, start, end),
                                            self.path(CHANGES), e.name, end) for e in chosen}

    def compute_profile(self, start: str, end: str, incremental: bool = False,
                        as_of: Column | None = None) -> str:
        load = partitions.load_increments if incremental else partitions.load_full
        only = {} if incremental else {"current_only": self.options.current_only}
        frames = load(self.spark, self.config, start, end, stored_fmt=self.stored_fmt,
                      needed=source_columns(self.config), **only)
        registered = None
        if self.config.get("ciamPath"):
            registered = partitions.load_registered(
                self.spark, self.config["ciamPath"], start, end, incremental,
                stored_fmt=self.stored_fmt, closed_path=self.config.get("ciamClosedPath"),
                stored_path=self.config.get("ciamStoredPath"))
        built = build_profiles(frames, self.config, registered, as_of=as_of,
                               on_null_key=self.options.on_null_key, history=self.options.history,
                               excluded_status=self.options.excluded_status)
        if incremental and len(self.config["storageDetails"]) > CHANGES:
            self.capture_changes(start, end)
        return self.write(PROFILES, "profiles", built, end,
                          n_without_key=F.count_if(F.col("ProvisionalPrimaryKey").isNull()))

    def compute_dedupe(self, end: str) -> str:
        profiles = partitions.read_stage(self.spark, self.path(PROFILES), end)
        found = resolve_people(profiles, self.spec(), impute_dob=self.options.impute_dob)
        try:
            sinks.write_table(found.quarantined, self.path(QUARANTINE))
            self.report("block_sizes", found.blocks)
            return self.write(CLUSTERS, "clusters", found.clusters, end)
        finally:
            found.release()

    def compute_ucp(self, day0: str, end: str, incremental: bool = False) -> str:
        profiles = partitions.read_stage(self.spark, self.path(PROFILES), end)
        clusters = partitions.read_stage(self.spark, self.path(CLUSTERS), end)
        old = None
        table = self.options.index_table
        if incremental and table:
            old = sinks.read_index(self.spark, table, end)
        elif incremental:
            # Without its own date, so that a repeated run gives the same result.
            old = partitions.read_stage(self.spark, self.path(INDEX), day0, end,
                                        include_hi=False)
        unified = unify_profiles(profiles, clusters, old, self.spec())
        try:
            out = self.write(UNIFIED, "unified", unified.profiles, end,
                             n_without_id=F.count_if(F.col("passenger_hash").isNull()))
            # Built from what was just stored instead of once more.
            stored = partitions.read_stage(self.spark, self.path(UNIFIED), end)
            index = identity_index(stored, self.spec()) if old is None else unified.index
            if table:
                sinks.write_index(index, table, end, self.options.index_buckets)
            else:
                self.write(INDEX, "index", index, end)
            self.report("quality_metrics", quality_metrics(stored, self.spec()))
            self.report("ambiguous_people", ambiguous_people(stored, self.spec()))
            return out
        finally:
            unified.release()

    def compute_ui(self, day0: str, end: str, as_of: Column | None = None) -> dict[str, str]:
        profiles = partitions.read_stage(self.spark, self.path(UNIFIED), day0, end)
        rows = serving_rows(profiles, as_of, self.options.rates).persist(StorageLevel.DISK_ONLY)
        try:
            return sinks.write_serving(tables_of(rows, **self.options.serving), self.path(SERVING))
        finally:
            rows.unpersist()
