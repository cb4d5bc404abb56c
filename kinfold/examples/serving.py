"""Serving aggregates over the test tables, with check SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import dates
from ..operators import serve
from .tables import table

QUERIES: dict = {}


def query(name: str, sql: str):
    def keep(fn):
        QUERIES[name] = (fn, sql)
        return fn
    return keep


def cents(c: str):
    return F.col(c).cast("decimal(18,2)")


@query("milestones", """
SELECT count(DISTINCT o_custkey) AS customers, count(DISTINCT l_partkey) AS journeys,
       count(DISTINCT l_suppkey) AS bookers, count(DISTINCT o_orderkey) AS bookings
FROM orders JOIN lineitem ON o_orderkey = l_orderkey""")
def milestones(spark, sf):
    rows = table(spark, sf, "orders").join(table(spark, sf, "lineitem"),
                                           F.col("o_orderkey") == F.col("l_orderkey"))
    return serve.milestones(rows, {"customers": "o_custkey", "journeys": "l_partkey",
                                   "bookers": "l_suppkey", "bookings": "o_orderkey"})


@query("milestones_by_month", """
WITH m AS (SELECT date_trunc('month', o_orderdate) AS d, o_custkey, o_orderkey FROM orders),
     days AS (SELECT DISTINCT d FROM m)
SELECT strftime(days.d, '%Y-%m') AS month, count(DISTINCT o_custkey) AS customers,
       count(DISTINCT o_orderkey) AS bookings, true AS customers_near, true AS bookings_near
FROM days JOIN m ON m.d <= days.d AND m.d > days.d - INTERVAL 3 MONTH GROUP BY ALL""")
def milestones_by_month(spark, sf):
    """Customers and bookings of three months, from one stored sketch per month; next to
    the exact counts, and whether they are within four standard errors of them."""
    month = F.trunc("o_orderdate", "month")
    rows = table(spark, sf, "orders").select(month.alias("d"), "o_custkey", "o_orderkey")
    columns = {"customers": "o_custkey", "bookings": "o_orderkey"}
    sketches = serve.milestone_sketches(rows, "d", columns)

    def spans(df):      # a month counts in its own span and in the next two
        return df.withColumn("end", F.explode(F.transform(
            F.array(F.lit(0), F.lit(1), F.lit(2)), lambda i: F.add_months("d", i))))

    merged = serve.milestones_of(spans(sketches), list(columns), "end")
    exact = spans(rows).groupBy("end").agg(*[F.countDistinct(c).alias(f"exact_{n}")
                                             for n, c in columns.items()])
    months = sketches.select(F.col("d").alias("end"))
    near = [(F.abs(F.col(n) - F.col(f"exact_{n}")) <= F.ceil(4 * 0.0082 * F.col(f"exact_{n}")))
            .alias(f"{n}_near") for n in columns]
    return merged.join(exact, "end").join(months, "end").select(
        F.date_format("end", "yyyy-MM").alias("month"),
        *[F.col(f"exact_{n}").alias(n) for n in columns], *near)


STATUSES = ["F", "O", "P"]
PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


def _pivot_sql() -> str:
    cells = []
    for column, values in (("o_orderstatus", STATUSES), ("o_orderpriority", PRIORITIES)):
        for v in values:
            cells.append(f"count(*) FILTER (WHERE {column} = '{v}') "
                         f"AS {column}_separator_{serve.safe_name(v)}")
    return ", ".join(cells)


@query("indicator_pivot", f"SELECT o_custkey, {_pivot_sql()} FROM orders GROUP BY o_custkey")
def indicator_pivot(spark, sf):
    orders = table(spark, sf, "orders")
    vocab = serve.vocabulary(orders, ["o_orderstatus", "o_orderpriority"])
    return orders.groupBy("o_custkey").agg(*serve.indicator_columns(vocab))


@query("entity_stats", f"""
SELECT o_custkey, max(o_orderpriority) AS o_orderpriority, max(o_orderstatus) AS o_orderstatus,
       cast(max(o_orderdate) AS DATE) AS LatestDate, cast(min(o_orderdate) AS DATE) AS FirstDate,
       count(o_orderkey) AS n_bookings,
       cast(sum(cast(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS revenue, {_pivot_sql()}
FROM orders GROUP BY o_custkey""")
def entity_stats(spark, sf):
    orders = table(spark, sf, "orders").withColumns({
        "o_orderdate": F.col("o_orderdate").cast("date"), "o_totalprice": cents("o_totalprice")})
    out = serve.entity_summary(
        orders, "o_custkey", largest=["o_orderpriority"], date="o_orderdate",
        counted="o_orderkey", amount="o_totalprice", count_name="n_bookings",
        amount_name="revenue", extra=[F.max("o_orderstatus").alias("o_orderstatus")],
        vocab=serve.vocabulary(orders, ["o_orderstatus", "o_orderpriority"]))
    return out.withColumn("revenue", F.col("revenue").cast("double"))


@query("two_phase_stats", """
SELECT l_orderkey, count(*) AS numRows, cast(sum(l_quantity) AS DOUBLE) AS l_quantity,
       max(l_extendedprice) AS max_l_extendedprice, min(l_discount) AS min_l_discount
FROM lineitem GROUP BY 1""")
def two_phase_stats(spark, sf):
    return serve.two_phase(table(spark, sf, "lineitem"), ["l_orderkey", "l_returnflag"],
                           ["l_orderkey"], ["l_quantity"], ["l_extendedprice"], ["l_discount"])


@query("distinct_counterparts", """
SELECT l_suppkey, count(DISTINCT l_orderkey) AS UniqueClients FROM lineitem GROUP BY 1""")
def distinct_counterparts(spark, sf):
    return serve.distinct_counterparts(table(spark, sf, "lineitem"), "l_suppkey", "l_orderkey",
                                       "UniqueClients")


@query("revenue_two_level", """
SELECT o_orderstatus, cast(sum(r) AS DOUBLE) AS Revenue FROM
 (SELECT l_orderkey, max(cast(l_extendedprice AS DECIMAL(18,2))) AS r,
         max(o_orderstatus) AS o_orderstatus
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1) GROUP BY 1""")
def revenue_two_level(spark, sf):
    rows = table(spark, sf, "lineitem").select("l_orderkey", cents("l_extendedprice").alias("r"))
    rows = rows.join(table(spark, sf, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    out = serve.revenue_by_currency(rows, "l_orderkey", "r", "o_orderstatus")
    return out.withColumn("Revenue", F.col("Revenue").cast("double"))


RATES = {"1-URGENT": 0.5, "2-HIGH": 2.25, "5-LOW": 1.0}


@query("currency_normalise", """
SELECT o_orderkey, o_totalprice * r AS converted FROM orders LEFT JOIN
 (VALUES ('1-URGENT', 0.5::DOUBLE), ('2-HIGH', 2.25::DOUBLE), ('5-LOW', 1.0::DOUBLE)) t(c, r)
 ON o_orderpriority = c""")
def currency_normalise(spark, sf):
    return serve.normalise_currency(table(spark, sf, "orders"), "o_totalprice", "o_orderpriority",
                                    "converted", RATES).select("o_orderkey", "converted")


_BANDS = " ".join(f"WHEN a BETWEEN {n} AND {n + 9} THEN '{n}_to_{n + 9}'" for n in range(1, 100, 10))


@query("age_band", f"""
SELECT o_orderkey, CASE WHEN dob = 'Unknown' THEN 'Unknown' ELSE cast(a AS VARCHAR) END AS age,
  CASE WHEN dob = 'Unknown' THEN 'Unknown' {_BANDS} ELSE 'Above100' END AS band FROM
 (SELECT *, 2004 - year(try_cast(dob AS DATE)) AS a FROM
  (SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 'Unknown'
     WHEN '2-HIGH' THEN '19xx-xxx' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS dob FROM orders))""")
def age_band(spark, sf):
    dob = (F.when(F.col("o_orderpriority") == "1-URGENT", "Unknown")
            .when(F.col("o_orderpriority") == "2-HIGH", "19xx-xxx")
            .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")))
    age = dates.age(dob, F.lit("2004-06-30").cast("date"))
    return table(spark, sf, "orders").select("o_orderkey", age.alias("age"),
                                             dates.age_band(age).alias("band"))


@query("month_indicator", """
SELECT monthname(o_orderdate) AS BookingMonth, count(*) AS n FROM orders GROUP BY 1""")
def month_indicator(spark, sf):
    return (table(spark, sf, "orders")
            .groupBy(dates.month_name(F.col("o_orderdate")).alias("BookingMonth"))
            .agg(F.count("*").alias("n")))


@query("until_yesterday", """
SELECT event_id FROM events WHERE cast(ts AS DATE) <= DATE '2024-01-10' - 1""")
def until_yesterday(spark, sf):
    as_of = F.lit("2024-01-10").cast("date")
    return table(spark, sf, "events").filter(
        dates.until_yesterday(F.col("ts"), as_of)).select("event_id")


@query("top_n_timeline", """
SELECT o_custkey, o_orderkey, row_num FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey
  ORDER BY o_orderdate DESC, o_orderkey) AS row_num FROM orders) WHERE row_num <= 5""")
def top_n_timeline(spark, sf):
    out = serve.top_n_per_key(table(spark, sf, "orders"), "o_custkey", [F.desc("o_orderdate")], 5,
                              ["o_orderkey"])
    return out.select("o_custkey", "o_orderkey", "row_num")


@query("timeline_json", """
WITH t AS (SELECT o_custkey, o_orderkey, o_orderpriority, strftime(o_orderdate, '%Y-%m-%d') AS d,
  row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey) AS n FROM orders)
SELECT o_custkey, '{' || string_agg('"' || (n - 1) || '":{' ||
  CASE WHEN o_orderpriority = '5-LOW' THEN '' ELSE '"priority":"' || o_orderpriority || '",' END ||
  '"travel_date":"' || d || '","locator":"' || o_orderkey || '"}', ',' ORDER BY n) || '}' AS Details
FROM t WHERE n <= 250 GROUP BY 1""")
def timeline_json(spark, sf):
    fields = {"priority": F.nullif("o_orderpriority", F.lit("5-LOW")),
              "travel_date": dates.date_part(F.col("o_orderdate")),
              "locator": F.col("o_orderkey")}
    return serve.timeline_json(table(spark, sf, "orders"), "o_custkey", fields, "o_orderdate",
                               ["o_orderkey"])


@query("value_histogram", """
SELECT user_id, 'event_type' AS "column", CASE event_type WHEN 'view' THEN 'Unknown'
  WHEN 'error' THEN 'Unknown' ELSE event_type END AS value, count(*) AS n
FROM events GROUP BY ALL""")
def value_histogram(spark, sf):
    kind = (F.when(F.col("event_type") == "view", " ")
             .when(F.col("event_type") != "error", F.col("event_type")))
    rows = table(spark, sf, "events").select("user_id", kind.alias("event_type"))
    return serve.value_counts(rows, "user_id", ["event_type"], nulls_as="Unknown")


@query("histogram_json", """
WITH c AS (SELECT l_suppkey, CAST(l_linenumber AS VARCHAR) AS v, count(*) AS n,
   row_number() OVER (PARTITION BY l_suppkey ORDER BY count(*) DESC, CAST(l_linenumber AS VARCHAR)) AS r
   FROM lineitem GROUP BY 1, 2),
 f AS (SELECT l_suppkey, l_returnflag AS v, count(*) AS n FROM lineitem GROUP BY 1, 2)
SELECT c.l_suppkey, c.lines AS l_linenumber, f.flags AS l_returnflag FROM
 (SELECT l_suppkey, '{' || string_agg('"' || v || '":' || n, ',' ORDER BY r) || '}' AS lines
  FROM c WHERE r <= 5 GROUP BY 1) c JOIN
 (SELECT l_suppkey, '{' || string_agg('"' || v || '":' || n, ',' ORDER BY n DESC, v) || '}' AS flags
  FROM f GROUP BY 1) f ON c.l_suppkey = f.l_suppkey""")
def histogram_json(spark, sf):
    return serve.histogram_json(table(spark, sf, "lineitem"), "l_suppkey",
                                ["l_linenumber", "l_returnflag"], cap=5)


@query("timeline_parts", """
WITH t AS (SELECT o_custkey, o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS d,
  row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey) - 1 AS n,
  count(*) OVER (PARTITION BY o_custkey) AS total FROM orders)
SELECT o_custkey, n // 7 AS part, (total + 6) // 7 AS n_parts,
  CASE WHEN n // 7 = 0 THEN '{' ELSE ',' END || string_agg(
  '"' || n || '":{"travel_date":"' || d || '","locator":"' || o_orderkey || '"}', ',' ORDER BY n)
  || CASE WHEN n // 7 = (total + 6) // 7 - 1 THEN '}' ELSE '' END AS Details
FROM t GROUP BY o_custkey, n // 7, total""")
def timeline_parts(spark, sf):
    fields = {"travel_date": dates.date_part(F.col("o_orderdate")), "locator": F.col("o_orderkey")}
    return serve.timeline_parts(table(spark, sf, "orders"), "o_custkey", fields, "o_orderdate",
                                ["o_orderkey"], per_part=7)


@query("histogram_parts", """
WITH c AS (SELECT l_suppkey, CAST(l_partkey AS VARCHAR) AS v, count(*) AS n FROM lineitem GROUP BY 1, 2),
 r AS (SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY n DESC, v) - 1 AS i,
   count(*) OVER (PARTITION BY l_suppkey) AS total FROM c)
SELECT l_suppkey, 'l_partkey' AS "column", i // 50 AS part, (total + 49) // 50 AS n_parts,
  CASE WHEN i // 50 = 0 THEN '{' ELSE ',' END || string_agg('"' || v || '":' || n, ',' ORDER BY i)
  || CASE WHEN i // 50 = (total + 49) // 50 - 1 THEN '}' ELSE '' END AS json
FROM r GROUP BY l_suppkey, i // 50, total""")
def histogram_parts(spark, sf):
    return serve.histogram_parts(table(spark, sf, "lineitem"), "l_suppkey", ["l_partkey"], per_part=50)
