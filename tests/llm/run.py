"""python tests/llm/run.py [sf_dir] [query ...]: run queries, compare with their check SQL, print times."""

import os
import sys
import time
import traceback

HERE = os.path.dirname(os.path.abspath(__file__))
ROOT = os.path.dirname(os.path.dirname(HERE))
sys.path[:0] = [os.path.dirname(HERE), ROOT]
os.environ["PYTHONPATH"] = ROOT

from checking import compare, connect  # noqa: E402
from pyspark.sql import SparkSession  # noqa: E402

from kinfold.llm.queries import QUERIES  # noqa: E402
from kinfold.session import tune  # noqa: E402

if __name__ == "__main__":
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = tune(SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
                 .config("spark.sql.session.timeZone", "UTC").config("spark.driver.memory", "6g")
                 .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf)
    for name in sys.argv[2:] or list(QUERIES):
        fn, sql = QUERIES[name]
        t = time.time()
        try:
            df = fn(spark, sf)
            if sql:
                n = compare(df, con, sql)
            else:
                rows = df.collect()
                n = len(rows)
                print(rows[:3])
            print(f"{'ok' if sql else 'ran'} {name} {n} rows {time.time() - t:.1f} s", flush=True)
        except Exception as e:
            traceback.print_exc(limit=-3)
            print("FAIL", name, str(e)[:1500], flush=True)
