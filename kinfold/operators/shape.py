"""Row shaping: collapse, fold, path, latest, de-duplication, defaults."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import fixed

TYPE_NAMES = ("string", "integer", "long", "double", "boolean", "date")


def as_list(x) -> list[str]:
    return [x] if isinstance(x, str) else list(x)


def not_null(keys: Sequence[str]) -> Column:
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(k).isNotNull()
    return cond


def prefix_columns(df: DataFrame, prefix: str) -> DataFrame:
    return df.toDF(*[f"{prefix}_{c}" for c in df.columns])


def apply_predicates(frames: Mapping[str, DataFrame],
                     predicates: Mapping[str, str] = fixed.ENTITY_PREDICATES,
                     ) -> dict[str, DataFrame]:
    return {name: df.filter(predicates[name]) if name in predicates else df
            for name, df in frames.items()}


def golden_record(df: DataFrame, key: str, on_null_key: str = "merge") -> DataFrame:
    """One row per key holding the maximum of every other column.

    Null keys form one group ("merge"), pass through row by row ("keep") or
    are left out ("drop").
    """
    if on_null_key not in ("merge", "keep", "drop"):
        raise ValueError(f"on_null_key: {on_null_key}")
    others = [c for c in df.columns if c != key]
    known = df if on_null_key == "merge" else df.filter(F.col(key).isNotNull())
    out = known.groupBy(key).agg(*[F.max(c).alias(c) for c in others])
    if on_null_key == "keep":
        out = out.unionByName(df.filter(F.col(key).isNull()).select(out.columns))
    return out


def fold_rows(df: DataFrame, key: str, code: str, values: Sequence[str] | None = None,
              order: Sequence[str] | None = None) -> DataFrame:
    """One row per (key, code): the last one by `order` (by the values if not given)."""
    if values is None:
        values = [c for c in df.columns if c not in (key, code)]
    groups = df.filter(F.col(code).isNotNull()).groupBy(key, code)
    if len(values) == 1 and not order:
        return groups.agg(F.max(values[0]).alias(values[0]))
    # without an order of its own the row is its order: what moves holds it once
    last = F.max_by(F.struct(*values), F.struct(*order)) if order else F.max(F.struct(*values))
    return (groups.agg(last.alias("_last"))
            .select(key, code, *[F.col("_last")[v].alias(v) for v in values]))


def fold_code_values(df: DataFrame, key: str, code: str,
                     values: Sequence[str] | None = None,
                     order: Sequence[str] | None = None) -> DataFrame:
    """Fold code/value rows into one map per value column and key.

    Repeated codes are reduced first (combined map-side), so what a key
    collects is bounded by the code vocabulary, not by its row count.
    """
    if values is None:
        values = [c for c in df.columns if c not in (key, code)]
    entries = [
        F.map_from_entries(F.array_sort(F.collect_list(
            F.struct(F.col(code).alias("key"), F.col(v).alias("value"))))).alias(v)
        for v in values
    ]
    return fold_rows(df, key, code, values, order).groupBy(key).agg(*entries)


def ordered_path(df: DataFrame, key: str, seq: Sequence[str], value: str,
                 sep: str = "_") -> DataFrame:
    """Distinct steps of a key joined in sequence order.

    The order is part of the aggregate, so no shuffle can disturb it; repeated
    rows vanish in the map-side part of collect_set.
    """
    step = F.when(F.col(value).isNotNull(), F.struct(*as_list(seq), value))
    steps = F.array_sort(F.collect_set(step))
    return df.groupBy(key).agg(
        F.array_join(F.transform(steps, lambda s: s[value].cast("string")), sep)
        .alias(value))


def solo_or_group(df: DataFrame, key: str, member: str,
                  name: str = "TravelSoloOrGroup") -> DataFrame:
    """More than one distinct member: 'Group', else 'Solo'.  min <> max says so
    without counting the members of a hot key."""
    several = F.min(member) != F.max(member)
    return df.groupBy(key).agg(F.when(several, "Group").otherwise("Solo").alias(name))


def latest_per_key(df: DataFrame, key: str, order: str) -> DataFrame:
    """Rows that carry their key's greatest `order`; ties stay."""
    top = df.groupBy(key).agg(F.max(order).alias(order))
    return df.join(top, [key, order], "left_semi")


def latest_document(df: DataFrame, key: str, doc_type: str = "P",
                    type_col: str = "DocTypeCode",
                    columns=("DocNumber", "IssuedByCode", "ExpirationDate")) -> DataFrame:
    of_type = df.filter(F.upper(type_col) == doc_type).select(key, *columns)
    return latest_per_key(of_type, key, "ExpirationDate")


def first_in_group(df: DataFrame, firsts: Mapping[str, int]) -> DataFrame:
    for column, value in firsts.items():
        df = df.filter(F.col(column) == value)
    return df


def dedup_by_key(df: DataFrame, keys, order: Sequence[str] | None = None,
                 descending: bool = False) -> DataFrame:
    """One whole row per key, the first (or last) by a total order.

    An aggregate rather than a window: every map task reduces its part of a
    hot key to one row before the shuffle.
    """
    keys = as_list(keys)
    others = [c for c in df.columns if c not in keys]
    if not others:
        return df.distinct()
    types = dict(df.dtypes)
    rest = [c for c in others if not types[c].startswith("map")]
    ranked = list(order or []) + [c for c in rest if c not in (order or [])]
    if set(ranked) == set(others):
        # the order holds the whole row: what moves holds it once
        row = (F.max if descending else F.min)(F.struct(*ranked))
    else:
        pick = F.max_by if descending else F.min_by
        row = pick(F.struct(*others), F.struct(*(ranked or [F.lit(0)])))
    return (df.groupBy(*keys).agg(row.alias("_row"))
              .select(*[F.col(k) if k in keys else F.col("_row")[k].alias(k)
                        for k in df.columns]))


def declared_columns(schema: Iterable[Mapping]) -> dict[str, str]:
    """Config schema entries → {column: Spark type name}; unknown types are left out."""
    spark_name = {"integer": "int", "long": "bigint"}
    return {s["columnName"]: spark_name.get(s["dataType"], s["dataType"])
            for s in schema if s["dataType"] in TYPE_NAMES}


def cast_to_schema(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    return df.select([F.col(c).try_cast(t).alias(c) for c, t in types.items()])


def fill_defaults(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    """Null → the column's default; a default of another type leaves its column alone."""
    groups: dict = defaultdict(list)
    for column, value in defaults.items():
        if value is not None and column in df.columns:
            groups[(type(value).__name__, value)].append(column)
    for (_, value), columns in groups.items():
        df = df.fillna(value, subset=columns)
    return df


def restore_defaults(df: DataFrame, defaults: Mapping[str, object],
                     token: str = fixed.NULL_TOKEN) -> DataFrame:
    """The reverse: a value equal to its default becomes the null token (as text)."""
    out = []
    for c in df.columns:
        default = defaults.get(c)
        if default is None:
            out.append(F.col(c))
        else:
            text = F.col(c).cast("string")
            same = F.coalesce(text == F.lit(str(default)), F.lit(False))
            out.append(F.when(same, F.lit(token)).otherwise(text).alias(c))
    return df.select(out)


def required_columns(config: Mapping) -> dict[str, list[str]]:
    """Columns each entity must deliver: attribute sources plus direct mappings."""
    need: dict[str, dict[str, None]] = defaultdict(dict)
    for rule in config.get("attributeMapping", []):
        for s in rule["sourceColumns"]:
            need[s["entityName"]][s["columnName"]] = None
    for m in config.get("columnMapping", []):
        need[m["sourceEntity"]][m["sourceColumn"]] = None
    return {entity: list(columns) for entity, columns in need.items()}


def split_quarantine(df: DataFrame, rule: Column) -> tuple[DataFrame, DataFrame]:
    """(kept, quarantined); rows for which the rule is null are kept."""
    hit = F.coalesce(rule, F.lit(False))
    return df.filter(~hit), df.filter(hit)
