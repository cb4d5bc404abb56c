"""Run every catalogue query against its check SQL and print times.

python tests/check_all.py [sf_dir] [name ...]
"""

import os
import sys
import time
import traceback

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
os.environ["PYTHONPATH"] = sys.path[0] + os.pathsep + os.environ.get("PYTHONPATH", "")

from checking import compare, connect  # noqa: E402
from pyspark.sql import SparkSession  # noqa: E402

from kinfold.examples import catalogue  # noqa: E402


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:]
    spark = (SparkSession.builder.master("local[8]")
             .config("spark.sql.shuffle.partitions", "8")
             .config("spark.sql.session.timeZone", "UTC")
             .config("spark.driver.memory", "12g").config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false")
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf)
    bad = 0
    for name, (fn, sql) in catalogue().items():
        if names and name not in names:
            continue
        t = time.time()
        try:
            df = fn(spark, sf)
            df.write.format("noop").mode("overwrite").save()
            took = time.time() - t
            n = compare(df, con, sql) if sql else df.count()
            print(f"{'ok' if sql else 'ran':4} {name:26} {n:8} rows  spark {took:6.2f}s"
                  f"  with check {time.time() - t:6.2f}s", flush=True)
        except Exception as e:
            bad += 1
            print(f"FAIL {name:28} {type(e).__name__}: {str(e)[:700]}", flush=True)
            if "-v" in os.environ.get("CHECK", ""):
                traceback.print_exc()
    print("failed:", bad)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
