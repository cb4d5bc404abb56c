"""Join operators over the test tables, with check SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import joins
from ..plans.profile import merge_master, revenue_in_home_currency
from .tables import table

QUERIES: dict = {}


def query(name: str, sql: str):
    def keep(fn):
        QUERIES[name] = (fn, sql)
        return fn
    return keep


def _money(c: str):
    return F.col(c).cast("decimal(9,2)")


@query("null_safe_star", """
WITH b AS (SELECT o_orderkey, nullif(o_custkey, 7) AS who FROM orders),
     a AS (SELECT nullif(c_custkey, 3) AS agent, c_nationkey FROM customer)
SELECT b.o_orderkey, b.who, a.agent, n.n_name FROM b
FULL JOIN a ON b.who IS NOT DISTINCT FROM a.agent
LEFT JOIN nation n ON a.c_nationkey IS NOT DISTINCT FROM n.n_nationkey""")
def null_safe_star(spark, sf):
    b = table(spark, sf, "orders").select(
        "o_orderkey", F.nullif("o_custkey", F.lit(7)).alias("who"))
    a = table(spark, sf, "customer").select(
        F.nullif("c_custkey", F.lit(3)).alias("agent"), "c_nationkey")
    base = joins.full_outer(b, a, "who", "agent", rows_per_salt=20)
    star = joins.star_join(base, [(table(spark, sf, "nation"), "c_nationkey", "n_nationkey")])
    return star.select("o_orderkey", "who", "agent", "n_name")


@query("reference_join", """
SELECT l_orderkey, l_linenumber, p_name FROM lineitem LEFT JOIN
 (SELECT p_partkey, p_name FROM part WHERE p_size > 10) p ON l_partkey = p_partkey""")
def reference_join(spark, sf):
    names = table(spark, sf, "part").filter("p_size > 10").select("p_partkey", "p_name")
    return joins.star_join(table(spark, sf, "lineitem"), [(names, "l_partkey", "p_partkey")],
                           null_safe=False).select("l_orderkey", "l_linenumber", "p_name")


@query("conditional_left", """
SELECT c_custkey, n_name FROM customer LEFT JOIN nation
 ON c_nationkey = n_nationkey AND c_mktsegment = 'MACHINERY'""")
def conditional_left(spark, sf):
    c, n = table(spark, sf, "customer"), table(spark, sf, "nation")
    return joins.conditional_left(c, n, c["c_nationkey"] == n["n_nationkey"],
                                  c["c_mktsegment"] == "MACHINERY").select("c_custkey", "n_name")


@query("flag_by_join", """
SELECT o_orderkey, CASE WHEN EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey
 AND l_discount >= 0.09) THEN 'yes' ELSE 'no' END AS deep FROM orders""")
def flag_by_join(spark, sf):
    deep = table(spark, sf, "lineitem").filter("l_discount >= 0.09").select(
        F.col("l_orderkey").alias("o_orderkey"))
    return joins.flag_by_key(table(spark, sf, "orders").select("o_orderkey"), deep,
                             "o_orderkey", "deep")


@query("anti_exclusion", """
SELECT c_custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders
 WHERE o_custkey = c_custkey AND o_orderpriority = '1-URGENT')""")
def anti_exclusion(spark, sf):
    urgent = table(spark, sf, "orders").filter("o_orderpriority = '1-URGENT'")
    return joins.exclude_by_key(table(spark, sf, "customer").select("c_custkey"),
                                urgent.select(F.col("o_custkey").alias("c_custkey")), "c_custkey")


@query("asof_rate_join", """
WITH v AS (SELECT user_id, ts, value, lead(ts) OVER (PARTITION BY user_id ORDER BY ts, value) AS nxt
           FROM events WHERE event_type = 'purchase'),
     f AS (SELECT event_id, user_id, cast(ts + INTERVAL 8 HOUR AS DATE) AS d
           FROM events WHERE event_type <> 'purchase')
SELECT f.event_id, v.value AS rate, cast(v.ts AS VARCHAR) AS valid_from,
       cast(v.nxt AS VARCHAR) AS valid_to
FROM f LEFT JOIN v ON f.user_id = v.user_id AND f.d >= cast(v.ts AS DATE)
 AND f.d < cast(coalesce(v.nxt, TIMESTAMP '9999-12-31 00:00:00') AS DATE)""")
def asof_rate_join(spark, sf):
    events = table(spark, sf, "events")
    rates = events.filter("event_type = 'purchase'").select(
        "user_id", F.col("ts").alias("valid_from"), F.col("value").alias("rate"))
    facts = events.filter("event_type != 'purchase'").select(
        "event_id", "user_id", (F.col("ts") + F.expr("INTERVAL 8 HOURS")).cast("date").alias("d"))
    out = joins.asof_rate_join(facts, rates, "user_id", "d", "valid_from", ["rate"],
                               rows_per_salt=20)
    return out.select("event_id", "rate", F.col("valid_from").cast("string").alias("valid_from"),
                      F.col("effective_end").cast("string").alias("valid_to"))


@query("convert_revenue", """
WITH v AS (SELECT user_id, ts, value, lead(ts) OVER (PARTITION BY user_id ORDER BY ts, value) AS nxt
           FROM events WHERE event_type = 'purchase'),
     f AS (SELECT event_id, user_id, cast(value AS DECIMAL(9,2)) AS amount,
           cast(ts + INTERVAL 8 HOUR AS DATE) AS d,
           CASE WHEN event_type = 'click' THEN 'PHP' ELSE 'USD' END AS currency FROM events)
SELECT f.event_id, f.currency, cast(CASE WHEN currency <> 'PHP'
   THEN round(amount * cast(v.value AS DECIMAL(9,2)), 2) ELSE amount END AS DOUBLE) AS revenue
FROM f LEFT JOIN v ON f.user_id = v.user_id AND f.d >= cast(v.ts AS DATE)
 AND f.d < cast(coalesce(v.nxt, TIMESTAMP '9999-12-31 00:00:00') AS DATE)""")
def convert_revenue(spark, sf):
    events = table(spark, sf, "events")
    rates = events.filter("event_type = 'purchase'").select(
        "user_id", F.col("ts").alias("valid_from"), _money("value").alias("ConversionRate"))
    facts = events.select(
        "event_id", "user_id", _money("value").alias("Revenue"),
        (F.col("ts") + F.expr("INTERVAL 8 HOURS")).cast("date").alias("d"),
        F.when(F.col("event_type") == "click", "PHP").otherwise("USD").alias("BookingCurrency"))
    out = joins.asof_rate_join(facts, rates, "user_id", "d", "valid_from", ["ConversionRate"])
    out = joins.convert_revenue(out, "PHP")
    return out.select("event_id", F.col("BookingCurrency").alias("currency"),
                      F.col("Revenue").cast("double").alias("revenue"))


@query("revenue_home", """
WITH v AS (SELECT CASE user_id % 2 WHEN 0 THEN 'USD' ELSE 'JPY' END AS c, ts, cast(value AS DECIMAL(9,2)) AS rate,
             lead(ts) OVER (PARTITION BY user_id % 2 ORDER BY ts, value) AS nxt
           FROM events WHERE event_type = 'purchase'),
     f AS (SELECT event_id, cast(value AS DECIMAL(9,2)) AS amount, cast(ts + INTERVAL 8 HOUR AS DATE) AS d,
             CASE WHEN event_type = 'click' THEN 'PHP' WHEN user_id % 3 = 0 THEN 'USD' ELSE 'JPY' END AS currency
           FROM events)
SELECT event_id, currency, cast(CASE WHEN currency <> 'PHP' THEN round(amount * rate, 2)
   ELSE amount END AS DOUBLE) AS revenue
FROM f LEFT JOIN v ON f.currency = v.c AND f.d >= cast(v.ts AS DATE)
 AND f.d < cast(coalesce(v.nxt, TIMESTAMP '9999-12-31 00:00:00') AS DATE)""")
def revenue_home(spark, sf):
    events = table(spark, sf, "events")
    history = events.filter("event_type = 'purchase'").select(
        F.when(F.col("user_id") % 2 == 0, "USD").otherwise("JPY").alias("FromCurrencyCode"),
        F.col("ts").alias("VersionStartUTC"), _money("value").alias("ConversionRate"))
    profiles = events.select(
        "event_id", _money("value").alias("Revenue"), F.col("ts").alias("BookingDate"),
        F.when(F.col("event_type") == "click", "PHP").when(F.col("user_id") % 3 == 0, "USD")
        .otherwise("JPY").alias("BookingCurrency"))
    out = revenue_in_home_currency(profiles, history, "PHP")
    return out.select("event_id", F.col("BookingCurrency").alias("currency"),
                      F.col("Revenue").cast("double").alias("revenue"))


# '5-LOW' and '3-MEDIUM' exist on the left only, 'none' on the right only.
STATUS = """(SELECT CASE o_orderpriority WHEN '3-MEDIUM' THEN 'none' ELSE o_orderpriority END
             AS status_key, min(o_custkey) AS first_cust
             FROM orders WHERE o_orderpriority <> '5-LOW' GROUP BY 1)"""


def _status(spark, sf):
    key = F.when(F.col("o_orderpriority") == "3-MEDIUM", "none").otherwise(F.col("o_orderpriority"))
    return (table(spark, sf, "orders").filter("o_orderpriority != '5-LOW'")
            .groupBy(key.alias("status_key")).agg(F.min("o_custkey").alias("first_cust")))


@query("salted_join", f"""
SELECT o_orderkey, o_orderpriority, first_cust FROM orders
JOIN {STATUS} ON o_orderpriority = status_key""")
def salted_join(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    return joins.salted_join(orders, _status(spark, sf), "o_orderpriority",
                             "status_key", rows_per_salt=1000).drop("status_key")


@query("salted_left_join", f"""
SELECT o_orderkey, o_orderpriority, first_cust FROM orders
LEFT JOIN {STATUS} ON o_orderpriority = status_key""")
def salted_left_join(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    return joins.salted_join(orders, _status(spark, sf), "o_orderpriority", "status_key",
                             "left", rows_per_salt=1000).drop("status_key")


@query("salted_full_join", f"""
SELECT o_orderkey, o_orderpriority, status_key, first_cust FROM orders
FULL JOIN {STATUS} ON o_orderpriority = status_key""")
def salted_full_join(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    return joins.salted_join(orders, _status(spark, sf), "o_orderpriority", "status_key", "full",
                             rows_per_salt=1000)


@query("master_merge", """
WITH m AS (SELECT o_orderkey, nullif(o_custkey, 5) AS who, p.l_orderkey, p.n FROM orders LEFT JOIN
  (SELECT l_orderkey, count(*) AS n FROM lineitem WHERE l_returnflag = 'A' GROUP BY 1) p
   ON o_orderkey = p.l_orderkey)
SELECT m.o_orderkey, m.n, m.who, c.c_custkey FROM (SELECT * FROM m WHERE who IS NOT NULL) m
FULL JOIN customer c ON m.who = c.c_custkey""")
def master_merge(spark, sf):
    orders = table(spark, sf, "orders").select(
        "o_orderkey", F.nullif("o_custkey", F.lit(5)).alias("who"))
    prior = (table(spark, sf, "lineitem").filter("l_returnflag = 'A'")
             .groupBy("l_orderkey").agg(F.count("*").alias("n")))
    out = merge_master(orders, prior, table(spark, sf, "customer").select("c_custkey"),
                       "o_orderkey", "l_orderkey", "who", "c_custkey")
    return out.select("o_orderkey", "n", "who", "c_custkey")


@query("impute_by_group", """
WITH e AS (SELECT event_id, user_id, event_type,
            CASE WHEN event_type = 'error' OR value < 5 THEN NULL ELSE value END AS v FROM events)
SELECT event_id, coalesce(v, max(CASE WHEN v >= 8 AND v < 40 THEN v END) OVER w,
       max(v) OVER w) AS v FROM e WINDOW w AS (PARTITION BY user_id, event_type)""")
def impute_by_group(spark, sf):
    v = F.when((F.col("event_type") != "error") & (F.col("value") >= 5), F.col("value"))
    rows = table(spark, sf, "events").select("event_id", "user_id", "event_type", v.alias("v"))
    plausible = (F.col("v") >= 8) & (F.col("v") < 40)
    return joins.impute_by_group(rows, ["user_id", "event_type"], "v", plausible) \
                .select("event_id", "v")


@query("semi_membership", """
SELECT s_suppkey, s_name FROM supplier WHERE s_suppkey IN
 (SELECT l_suppkey FROM lineitem WHERE l_quantity >= 45)""")
def semi_membership(spark, sf):
    big = table(spark, sf, "lineitem").filter("l_quantity >= 45").select(
        F.col("l_suppkey").alias("s_suppkey"))
    suppliers = table(spark, sf, "supplier").select("s_suppkey", "s_name")
    return joins.flag_by_key(suppliers, big, "s_suppkey", "_in").filter("_in = 'yes'").drop("_in")
