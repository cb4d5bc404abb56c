"""Compare a Spark result with DuckDB's, order-free, columns sorted by name."""

import datetime
import decimal
import math

import duckdb

from kinfold.examples.tables import TABLES


def connect(sf_dir):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def cell(v):
    if v is None:
        return "∅"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, (float, decimal.Decimal)):
        v = float(v)
        return "nan" if math.isnan(v) else f"{v:.9g}"
    if isinstance(v, int):
        return str(v)
    if isinstance(v, (datetime.datetime, datetime.date)):
        return v.isoformat()
    return str(v)


def normal(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(cell(r[i]) for i in order) for r in rows)


def duck_rows(con, sql):
    cursor = con.execute(sql)
    columns = [d[0] for d in cursor.description]
    return columns, cursor.fetchall()


def compare(df, con, sql):
    columns, expected = duck_rows(con, sql)
    assert sorted(df.columns) == sorted(columns), (sorted(df.columns), sorted(columns))
    got = normal(df.columns, [tuple(r) for r in df.collect()])
    want = normal(columns, expected)
    assert len(got) == len(want), f"{len(got)} rows, expected {len(want)}"
    wrong = [(g, w) for g, w in zip(got, want) if g != w]
    assert not wrong, f"{len(wrong)} rows differ, first {wrong[:2]}"
    return len(got)


def shuffles_left(spark):
    """Numbers of the shuffles whose files lie on this machine's disk."""
    manager = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    names = [f.getName() for f in spark.sparkContext._jvm.scala.jdk.javaapi.CollectionConverters.asJava(manager.getAllFiles())]
    return {n.split("_")[1] for n in names if n.startswith("shuffle_")}


def leaves(spark, make):
    """How many shuffles still have files when `make()` has been written to nowhere."""
    before = shuffles_left(spark)
    make().write.format("noop").mode("overwrite").save()
    return len(shuffles_left(spark) - before)
