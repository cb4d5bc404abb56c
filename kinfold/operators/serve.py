"""Serving aggregates: milestones, indicator pivots, histograms, timelines, revenue."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import fixed
from ..session import ensure_checkpoint_dir
from .shape import as_list


def milestones(df: DataFrame, columns: Mapping[str, str], approximate: bool = False) -> DataFrame:
    """Distinct counts {result name: column} in one row."""
    count = F.approx_count_distinct if approximate else F.countDistinct
    return df.agg(*[count(c).alias(name) for name, c in columns.items()])


SKETCH_LOG_K = 14       # 2**14 registers: a standard error of 0.8 %, at most 16 kB a sketch


def milestone_sketches(df: DataFrame, by, columns: Mapping[str, str],
                       log_k: int = SKETCH_LOG_K) -> DataFrame:
    """One row per `by` (a date, say) with a mergeable sketch per milestone.

    Stored once a day, the rows answer distinct counts over any span of days without the
    facts.  Nulls do not count; a group that has nothing else gets an empty sketch.
    """
    return df.groupBy(*as_list(by)).agg(*[
        F.hll_sketch_agg(F.col(c).cast("string"), log_k).alias(name) for name, c in columns.items()])


def milestones_of(sketches: DataFrame, names: Sequence[str], by=()) -> DataFrame:
    """Distinct counts of merged sketches, per `by`, or in one row without it."""
    return sketches.groupBy(*as_list(by)).agg(*[
        F.hll_sketch_estimate(F.hll_union_agg(name)).alias(name) for name in names])


def revenue_by_currency(df: DataFrame, key: str, revenue: str, currency: str,
                        name: str = "Revenue") -> DataFrame:
    """Largest revenue and currency per booking, then the sum per currency."""
    per_key = df.groupBy(key).agg(F.max(revenue).alias("_r"), F.max(currency).alias(currency))
    return per_key.groupBy(currency).agg(F.sum("_r").alias(name))


def normalise_currency(df: DataFrame, amount: str, currency: str, name: str,
                       rates: Mapping[str, float] = fixed.CURRENCY_RATES) -> DataFrame:
    """Amount times the currency's rate; unknown currencies give null."""
    table = F.create_map(*[F.lit(x) for pair in rates.items() for x in pair])
    return df.withColumn(name, F.col(amount).try_cast("double") * table[F.col(currency)])


# --- indicator pivot ------------------------------------------------------------------

PIVOT_VALUES = 1000     # output columns that one pivot column may become


def safe_name(value: str) -> str:
    for char, word in fixed.PIVOT_CHAR_NAMES.items():
        value = value.replace(char, word)
    return value


def vocabulary(df: DataFrame, columns: Sequence[str], limit: int = PIVOT_VALUES) -> dict[str, list[str]]:
    """Distinct non-null values per categorical column, in one job.

    A pivot column becomes one output column per value, so more than `limit`
    values are refused rather than cut.
    """
    cells = F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value"))
        for c in columns]))
    found = (df.select(cells.alias("cell")).select("cell.*")
             .filter("value IS NOT NULL").distinct())
    rows = found.limit(limit * len(columns) + 1).collect()
    out: dict[str, list[str]] = {c: [] for c in columns}
    for row in rows:
        out[row["column"]].append(row["value"])
    for c, values in out.items():
        if len(values) > limit:
            raise ValueError(f"{c} has more than {limit} values; not a pivot column")
    return {c: sorted(v) for c, v in out.items()}


def indicator_columns(vocab: Mapping[str, Sequence[str]]) -> list[Column]:
    """One count column per (column, value), named <column>_separator_<value>."""
    out, names = [], set()
    for c, values in vocab.items():
        for v in values:
            name = f"{c}_separator_{safe_name(v)}"
            if name in names:
                raise ValueError(f"two values of {c} give the column {name}")
            names.add(name)
            hit = F.col(c).cast("string") == v
            out.append(F.sum(F.when(hit, 1).otherwise(0)).alias(name))
    return out


def entity_summary(df: DataFrame, key: str, *, largest: Sequence[str], date: str,
                   counted: str, amount: str, count_name: str, amount_name: str,
                   vocab: Mapping[str, Sequence[str]] | None = None,
                   extra: Sequence[Column] = ()) -> DataFrame:
    """Descriptive maxima, first and last date, count, amount and indicators,
    in one aggregation (partial sums before the shuffle)."""
    return df.groupBy(key).agg(
        *[F.max(c).alias(c) for c in largest],
        F.max(date).alias("LatestDate"), F.min(date).alias("FirstDate"),
        F.count(counted).alias(count_name), F.sum(amount).alias(amount_name),
        *indicator_columns(vocab or {}), *extra)


def two_phase(df: DataFrame, fine: Sequence[str], coarse: Sequence[str],
              sums: Sequence[str] = (), largest: Sequence[str] = (),
              smallest: Sequence[str] = (), rows: str = "numRows") -> DataFrame:
    """Aggregate by `fine`, then re-aggregate by `coarse` (a subset of it).

    For a hot coarse key the first step spreads its rows over the fine keys.
    """
    first = df.groupBy(*fine).agg(
        F.count("*").alias(rows), *[F.sum(c).alias(c) for c in sums],
        *[F.max(c).alias(f"max_{c}") for c in largest],
        *[F.min(c).alias(f"min_{c}") for c in smallest])
    return first.groupBy(*coarse).agg(
        F.sum(rows).alias(rows), *[F.sum(c).alias(c) for c in sums],
        *[F.max(f"max_{c}").alias(f"max_{c}") for c in largest],
        *[F.min(f"min_{c}").alias(f"min_{c}") for c in smallest])


def distinct_counterparts(df: DataFrame, key: str, other: str, name: str) -> DataFrame:
    return df.groupBy(key).agg(F.countDistinct(other).alias(name))


# --- top n per key -----------------------------------------------------------------------

def top_n_per_key(df: DataFrame, keys, order: Sequence[Column], n: int | None,
                  tie: Sequence[str], rank: str = "row_num", spread: int = 64) -> DataFrame:
    """The first n rows per key, ranked (all of them with n None).

    Ranked twice: first within a share of the key, then among the at most
    spread * n survivors.  `tie` names columns that make the order total; their
    hash also cuts a key's rows into shares.
    """
    keys = as_list(keys)
    total = [*order, *[F.col(t) for t in tie]]
    share = F.pmod(F.xxhash64(*tie), F.lit(spread))
    local = Window.partitionBy(*keys, "_share").orderBy(*total)
    final = Window.partitionBy(*keys).orderBy(*total)
    if n is None:
        return df.withColumn(rank, F.row_number().over(final))
    near = (df.withColumn("_share", share)
              .withColumn("_local", F.row_number().over(local))
              .filter(F.col("_local") <= n).drop("_share", "_local"))
    return near.withColumn(rank, F.row_number().over(final)).filter(F.col(rank) <= n)


def rank_in_slices(df: DataFrame, keys, order: Sequence[Column], slices: int | None = None,
                   rank: str = "row_num", total: str = "n_rows") -> DataFrame:
    """Adds a row's rank in its key and the key's row count, for keys of any size.

    Rows are dealt by range of (keys, order), so a hot key lies over many slices; the
    slices are checkpointed, for a later stage must find the same ones.  A rank is the
    rows of the key in earlier slices plus the rank inside the slice.  Rows that tie in
    `order` share a slice.
    """
    keys = as_list(keys)
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    slices = slices or int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = (df.repartitionByRange(slices, *keys, *order)
             .withColumn("_slice", F.spark_partition_id()).checkpoint())
    whole = Window.partitionBy(*keys)
    ahead = whole.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    counts = dealt.groupBy(*keys, "_slice").agg(F.count("*").alias("_n"))
    counts = counts.select(
        *[F.col(k).alias(f"_key_{i}") for i, k in enumerate(keys)], F.col("_slice").alias("_at"),
        F.coalesce(F.sum("_n").over(ahead), F.lit(0)).alias("_before"),
        F.sum("_n").over(whole).alias(total))
    same = F.col("_slice") == F.col("_at")
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_key_{i}"))
    inside = F.row_number().over(Window.partitionBy(*keys, "_slice").orderBy(*order))
    return (dealt.withColumn("_inside", inside).join(counts, same)
            .select(*df.columns, (F.col("_before") + F.col("_inside")).alias(rank), total))


PART_ROWS = 1000        # entries in one part of a long JSON text


def _parts(ranked: DataFrame, keys, entry: Column, body, name: str, per_part: int) -> DataFrame:
    """JSON objects in parts of `per_part` entries; `ranked` comes from rank_in_slices."""
    part = F.floor((F.col("row_num") - 1) / per_part).cast("long")
    n_parts = F.ceil(F.col("n_rows") / per_part).cast("long")
    met = ranked.withColumns({"part": part, "n_parts": n_parts}).groupBy(*keys, "part", "n_parts").agg(
        F.sort_array(F.collect_list(entry)).alias("_entries"))
    text = F.concat(F.when(F.col("part") == 0, "{").otherwise(","), body(F.col("_entries")),
                    F.when(F.col("part") == F.col("n_parts") - 1, "}").otherwise(""))
    return met.select(*keys, "part", "n_parts", text.alias(name))


# --- histograms ------------------------------------------------------------------------------

def value_counts(df: DataFrame, key: str, columns: Sequence[str],
                 nulls_as: str | None = None, blank_as: str = fixed.UNKNOWN) -> DataFrame:
    """(key, column, value, n) for several columns at once.  Blank text counts as
    `blank_as`; nulls are left out unless `nulls_as` is given."""
    cells = F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value"))
        for c in columns]))
    long = df.select(F.col(key), cells.alias("cell")).select(key, "cell.*")
    value = F.col("value")
    if nulls_as is None:
        long = long.filter(value.isNotNull())
        value = F.when(value == "", blank_as).otherwise(value)
    else:
        value = F.when(F.trim(value) == "", blank_as).otherwise(F.coalesce(value, F.lit(nulls_as)))
    long = long.withColumn("value", value)
    return long.groupBy(key, "column", "value").agg(F.count("*").alias("n"))


def _counted() -> Column:
    return F.struct((-F.col("n")).alias("neg"), "value")


def _counts_json(entries: Column) -> Column:
    return F.to_json(F.map_from_entries(F.transform(
        entries, lambda e: F.struct(e["value"].alias("key"), (-e["neg"]).alias("value")))))


def histogram_json(df: DataFrame, key: str, columns: Sequence[str], cap: int | None = None,
                   nulls_as: str | None = None) -> DataFrame:
    """One {value: count} JSON text per key and column; with `cap`, the most
    frequent values only."""
    counts = value_counts(df, key, columns, nulls_as)
    if cap is not None:
        counts = top_n_per_key(counts, [key, "column"], [F.desc("n")], cap, ["value"])
    texts = counts.groupBy(key, "column").agg(
        _counts_json(F.sort_array(F.collect_list(_counted()))).alias("json"))
    return texts.groupBy(key).agg(*[
        F.coalesce(F.max(F.when(F.col("column") == c, F.col("json"))), F.lit("{}")).alias(c)
        for c in columns])


def histogram_parts(df: DataFrame, key: str, columns: Sequence[str], nulls_as: str | None = None,
                    per_part: int = PART_ROWS, slices: int | None = None) -> DataFrame:
    """The uncapped histograms in rows of (key, column, part, n_parts, json).

    The parts of a key and column, joined in order, are the text of `histogram_json`; no
    task holds more than `per_part` values of it.  Where that text is {} there is no part.
    """
    counts = value_counts(df, key, columns, nulls_as)
    ranked = rank_in_slices(counts, [key, "column"], [F.desc("n"), F.col("value")], slices)

    def body(entries: Column) -> Column:
        text = _counts_json(entries)
        return F.substring(text, F.lit(2), F.length(text) - 2)

    return _parts(ranked, [key, "column"], _counted(), body, "json", per_part)


# --- timelines ------------------------------------------------------------------------------------

def timeline_json(df: DataFrame, key: str, fields: Mapping[str, Column], order: str,
                  tie: Sequence[str], n: int | None = fixed.TIMELINE_ROWS,
                  name: str = "Details") -> DataFrame:
    """The newest n rows of a key as an indexed JSON object of text maps.

    Null fields are left out, values are text; at most n rows meet in a key (all with
    n None).
    """
    rows = top_n_per_key(_dated(df, key, fields, order, tie), key, [F.desc_nulls_last("_order")], n,
                         [f"_tie_{t}" for t in tie])
    ordered = F.sort_array(F.collect_list(_numbered()))
    return rows.groupBy(key).agg(
        F.concat(F.lit("{"), _timeline_body(ordered), F.lit("}")).alias(name))


def _dated(df: DataFrame, key: str, fields: Mapping[str, Column], order: str,
           tie: Sequence[str]) -> DataFrame:
    return df.select(F.col(key), F.col(order).alias("_order"),
                     *[F.col(t).alias(f"_tie_{t}") for t in tie],
                     F.from_json(F.to_json(F.struct(*[c.alias(f) for f, c in fields.items()])),
                                 "map<string,string>").alias("_entry"))


def _numbered() -> Column:
    return F.struct("row_num", F.to_json("_entry").alias("json"))


def _timeline_body(entries: Column) -> Column:
    return F.array_join(F.transform(
        entries, lambda r: F.concat(F.lit('"'), (r["row_num"] - 1).cast("string"),
                                    F.lit('":'), r["json"])), ",")


def timeline_parts(df: DataFrame, key: str, fields: Mapping[str, Column], order: str,
                   tie: Sequence[str], name: str = "Details", per_part: int = PART_ROWS,
                   slices: int | None = None) -> DataFrame:
    """All rows of a key in rows of (key, part, n_parts, text), however many there are.

    The parts of a key, joined in order, are the text of `timeline_json` with n None; no
    task holds more than `per_part` rows of it.
    """
    newest_first = [F.desc_nulls_last("_order"), *[F.col(f"_tie_{t}") for t in tie]]
    ranked = rank_in_slices(_dated(df, key, fields, order, tie), key, newest_first, slices)
    return _parts(ranked, [key], _numbered(), _timeline_body, name, per_part)


def combine(stats: DataFrame, others: Sequence[tuple[DataFrame, str]], key: str) -> DataFrame:
    """Join per-key results; all sides hold one row per key."""
    for other, how in others:
        stats = stats.join(other, key, how)
    return stats
