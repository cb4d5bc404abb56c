"""Row-shaping and source operators over the test tables, with check SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import fixed
from ..functions import text
from ..functions.dates import date_part, local_date
from ..operators import joins, shape
from ..operators.resolve import block_sizes
from ..sources import partitions
from .tables import table

QUERIES: dict = {}


def query(name: str, sql: str):
    def keep(fn):
        QUERIES[name] = (fn, sql)
        return fn
    return keep


@query("golden_record", """
SELECT user_id, max(event_type) AS event_type, max(value) AS value, max(props) AS props,
       max(event_id) AS event_id FROM events GROUP BY user_id""")
def golden_record(spark, sf):
    rows = table(spark, sf, "events").select("user_id", "event_type", "value", "props", "event_id")
    return shape.golden_record(rows, "user_id")


@query("golden_record_null_keys", """
SELECT nullif(o_orderstatus, 'P') AS status, max(o_totalprice) AS price
FROM orders WHERE o_orderstatus <> 'P' GROUP BY 1
UNION ALL SELECT NULL, o_totalprice FROM orders WHERE o_orderstatus = 'P'""")
def golden_record_null_keys(spark, sf):
    rows = table(spark, sf, "orders").select(
        F.nullif("o_orderstatus", F.lit("P")).alias("status"), F.col("o_totalprice").alias("price"))
    return shape.golden_record(rows, "status", on_null_key="keep")


@query("code_value_fold", """
SELECT l_orderkey, l_returnflag AS code, max(l_extendedprice) AS price
FROM lineitem GROUP BY 1, 2""")
def code_value_fold(spark, sf):
    rows = table(spark, sf, "lineitem").select("l_orderkey", "l_returnflag", "l_extendedprice")
    folded = shape.fold_code_values(rows, "l_orderkey", "l_returnflag")
    return folded.select("l_orderkey", F.explode("l_extendedprice").alias("code", "price"))


@query("ordered_path", """
SELECT l_orderkey, string_agg(l_returnflag, '_' ORDER BY l_linenumber, l_returnflag) AS path
FROM (SELECT DISTINCT l_orderkey, l_linenumber, l_returnflag FROM lineitem) GROUP BY 1""")
def ordered_path(spark, sf):
    return (shape.ordered_path(table(spark, sf, "lineitem"), "l_orderkey", ["l_linenumber"],
                               "l_returnflag").withColumnRenamed("l_returnflag", "path"))


@query("solo_or_group", """
SELECT l_orderkey, CASE WHEN count(DISTINCT l_partkey) > 1 THEN 'Group' ELSE 'Solo' END AS party
FROM lineitem GROUP BY 1""")
def solo_or_group(spark, sf):
    return shape.solo_or_group(table(spark, sf, "lineitem"), "l_orderkey", "l_partkey", "party")


@query("latest_per_key", """
SELECT o_custkey, o_orderkey, o_totalprice FROM orders
WHERE (o_custkey, o_orderdate) IN (SELECT o_custkey, max(o_orderdate) FROM orders GROUP BY 1)""")
def latest_per_key(spark, sf):
    rows = table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_totalprice", "o_orderdate")
    return shape.latest_per_key(rows, "o_custkey", "o_orderdate").drop("o_orderdate")


@query("first_in_group", """
SELECT l_orderkey, l_partkey, l_quantity FROM lineitem
WHERE l_linenumber = 1 AND l_returnflag = 'A'""")
def first_in_group(spark, sf):
    rows = shape.first_in_group(table(spark, sf, "lineitem"),
                                {"l_linenumber": 1, "l_returnflag": "A"})
    return rows.select("l_orderkey", "l_partkey", "l_quantity")


@query("dedup_by_key", """
SELECT user_id, event_type, event_id, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS rn
  FROM events) WHERE rn = 1""")
def dedup_by_key(spark, sf):
    rows = table(spark, sf, "events").select("user_id", "event_type", "ts", "event_id", "value")
    return shape.dedup_by_key(rows, ["user_id", "event_type"], ["ts", "event_id"]).drop("ts")


@query("distinct_rows", """
SELECT DISTINCT l_returnflag, l_linestatus, l_linenumber FROM lineitem""")
def distinct_rows(spark, sf):
    rows = table(spark, sf, "lineitem").select("l_returnflag", "l_linestatus", "l_linenumber")
    return shape.dedup_by_key(rows, rows.columns)


@query("defaults_round_trip", f"""
SELECT event_id, coalesce(nullif(event_type, 'error'), 'Unknown') AS filled,
       CASE WHEN coalesce(nullif(event_type, 'error'), 'Unknown') = 'Unknown' THEN '{fixed.NULL_TOKEN}'
            ELSE event_type END AS restored FROM events""")
def defaults_round_trip(spark, sf):
    rows = table(spark, sf, "events").select(
        "event_id", F.nullif("event_type", F.lit("error")).alias("filled"))
    defaults = {"filled": "Unknown", "event_id": "not a number"}
    filled = shape.fill_defaults(rows, defaults)
    return shape.restore_defaults(filled.withColumn("restored", F.col("filled")),
                                  {"restored": "Unknown"})


@query("cast_to_schema", """
SELECT try_cast(c_name AS BIGINT) AS name_number, try_cast(c_acctbal AS INTEGER) IS NULL AS no_int,
       cast(c_custkey AS VARCHAR) AS key_text FROM customer""")
def cast_to_schema(spark, sf):
    rows = table(spark, sf, "customer").select(
        F.col("c_name").alias("name_number"), F.col("c_acctbal").alias("balance"),
        F.col("c_custkey").alias("key_text"))
    types = shape.declared_columns([
        {"columnName": "name_number", "dataType": "long"},
        {"columnName": "balance", "dataType": "integer"},
        {"columnName": "key_text", "dataType": "string"},
        {"columnName": "ignored", "dataType": "blob"}])
    cast = shape.cast_to_schema(rows, types)
    return cast.select("name_number", F.col("balance").isNull().alias("no_int"), "key_text")


@query("entity_predicates", """
SELECT 'orders' AS entity, count(*) AS n FROM orders WHERE o_orderstatus <> 'P'
UNION ALL SELECT 'lineitem', count(*) FROM lineitem WHERE l_returnflag IN ('A', 'N')
UNION ALL SELECT 'customer', count(*) FROM customer""")
def entity_predicates(spark, sf):
    frames = shape.apply_predicates(
        {n: table(spark, sf, n) for n in ("orders", "lineitem", "customer")},
        {"orders": "o_orderstatus != 'P'", "lineitem": "l_returnflag IN ('A', 'N')",
         "absent": "false"})
    counts = [df.agg(F.lit(n).alias("entity"), F.count("*").alias("n"))
              for n, df in frames.items()]
    return counts[0].unionByName(counts[1]).unionByName(counts[2])


@query("prefix_rename", """
SELECT n_nationkey AS nation_n_nationkey, n_name AS nation_n_name,
       n_regionkey AS nation_n_regionkey FROM nation""")
def prefix_rename(spark, sf):
    return shape.prefix_columns(table(spark, sf, "nation"), "nation")


@query("quarantine_split", """
SELECT doc_id, CASE WHEN source = 'src0' AND lang IN ('en', 'fr') THEN 'quarantined'
               ELSE 'kept' END AS fate FROM documents""")
def quarantine_split(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "source", "lang")
    kept, aside = shape.split_quarantine(
        docs, (F.col("source") == "src0") & F.col("lang").isin("en", "fr"))
    return (kept.select("doc_id", F.lit("kept").alias("fate"))
            .unionByName(aside.select("doc_id", F.lit("quarantined").alias("fate"))))


@query("partition_range_union", """
SELECT o_orderkey, 'Open' AS Source FROM orders WHERE year(o_orderdate) = 1998
UNION ALL
SELECT o_orderkey, 'NonOpen' FROM orders
WHERE year(o_orderdate) BETWEEN 1995 AND 1997 AND o_orderstatus = 'F'""")
def partition_range_union(spark, sf):
    orders = table(spark, sf, "orders").withColumn("nds", F.year("o_orderdate").cast("string"))
    opened = partitions.tag_source(
        partitions.partitions_between(orders, "1998", "1998", "nds"), "Open")
    closed = partitions.partitions_between(orders, "1995", "1997", "nds")
    closed = partitions.tag_source(closed.filter("o_orderstatus = 'F'"), "NonOpen")
    return opened.unionByName(closed).select("o_orderkey", "Source")


@query("latest_partition", """
SELECT event_id FROM events WHERE cast(ts AS DATE) =
 (SELECT max(cast(ts AS DATE)) FROM events WHERE cast(ts AS DATE) <= DATE '2024-01-17')""")
def latest_partition(spark, sf):
    events = table(spark, sf, "events").withColumn("vds", F.col("ts").cast("date"))
    return partitions.latest_partition(events, "vds", "2024-01-17").select("event_id")


@query("newest_partition", """
SELECT event_id FROM events WHERE cast(ts AS DATE) = (SELECT max(cast(ts AS DATE)) FROM events)""")
def newest_partition(spark, sf):
    events = table(spark, sf, "events").withColumn("vds", F.col("ts").cast("date"))
    return partitions.latest_partition(events, "vds").select("event_id")


@query("current_versions", """
SELECT event_id FROM events WHERE CASE event_type WHEN 'error' THEN NULL WHEN 'view' THEN 'A'
 ELSE 'D' END <> 'A' AND value > 10""")
def current_versions(spark, sf):
    log = table(spark, sf, "events").withColumns({
        "c_operationtype": F.when(F.col("event_type") == "view", "A")
                            .when(F.col("event_type") != "error", "D"),
        "VersionEndUTC": F.when(F.col("value") > 10, "9999-12-31 00:00:00.000")
                          .otherwise("2024-01-31 00:00:00.000")})
    return partitions.current_versions(partitions.live_changes(log)).select("event_id")


@query("heavy_keys", """
SELECT l_partkey, count(*) AS n_rows FROM lineitem GROUP BY 1
ORDER BY n_rows DESC, l_partkey LIMIT 50""")
def heavy_keys(spark, sf):
    return joins.heavy_keys(table(spark, sf, "lineitem"), "l_partkey")


@query("frequent_keys", """
SELECT CASE WHEN l_linenumber = 1 THEN -l_orderkey ELSE l_suppkey END AS k, count(*) AS n_rows
FROM lineitem GROUP BY 1 ORDER BY n_rows DESC, k LIMIT 50""")
def frequent_keys(spark, sf):
    """Many rare keys and some frequent ones."""
    key = F.when(F.col("l_linenumber") == 1, -F.col("l_orderkey")).otherwise(F.col("l_suppkey"))
    return joins.frequent_keys(table(spark, sf, "lineitem").select(key.alias("k")), "k")


@query("group_sizes", """
SELECT lang, source, count(*) AS n_members, count(*) * (count(*) - 1) // 2 AS n_pairs
FROM documents GROUP BY 1, 2""")
def group_sizes(spark, sf):
    return block_sizes(table(spark, sf, "documents"), ["lang", "source"])


@query("phone_email_clean", """
SELECT c_custkey, regexp_replace(c_name, '[^0-9]', '', 'g') AS phone,
       lower(c_mktsegment) AS email FROM customer""")
def phone_email_clean(spark, sf):
    return table(spark, sf, "customer").select(
        "c_custkey", text.digits_only(F.col("c_name")).alias("phone"),
        text.email_key(F.col("c_mktsegment")).alias("email"))


# Addresses that pass (every fourth) and that fail: no "@", a label with a leading hyphen, two dots.
@query("email_shape", """
SELECT c_custkey, regexp_matches(lower(CASE c_custkey % 4
   WHEN 0 THEN replace(c_name, '#', '.') || '@shop-' || c_nationkey || '.example.com'
   WHEN 1 THEN c_name WHEN 2 THEN c_name || '@-bad.example.com' ELSE c_name || '..x@example.com' END),
 '^[a-z0-9!#$%&''*+/=?^_`{|}~-]+(\\.[a-z0-9!#$%&''*+/=?^_`{|}~-]+)*@([a-z0-9]([a-z0-9-]*[a-z0-9])?\\.)+[a-z]{2,}$')
 AS ok FROM customer""")
def email_shape(spark, sf):
    name, kind = F.col("c_name"), F.col("c_custkey") % 4
    address = (F.when(kind == 0, F.concat(F.replace(name, F.lit("#"), F.lit(".")), F.lit("@shop-"),
                                          F.col("c_nationkey").cast("string"), F.lit(".example.com")))
               .when(kind == 1, name).when(kind == 2, F.concat(name, F.lit("@-bad.example.com")))
               .otherwise(F.concat(name, F.lit("..x@example.com"))))
    return table(spark, sf, "customer").select("c_custkey", text.is_email(address).alias("ok"))


@query("local_date_shift", """
SELECT event_id, cast(cast(ts + INTERVAL 8 HOUR AS DATE) AS VARCHAR) AS local_day,
       cast(cast(ts AS DATE) AS VARCHAR) AS utc_day FROM events""")
def local_date_shift(spark, sf):
    return table(spark, sf, "events").select(
        "event_id", local_date(F.col("ts")).cast("string").alias("local_day"),
        date_part(F.col("ts")).alias("utc_day"))
