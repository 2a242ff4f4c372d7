"""Command line: compare registered queries with their SQL (name prefixes as arguments)."""

import os
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]

import oracle  # noqa: E402
from pyspark.sql import SparkSession  # noqa: E402

import __spark_entry__ as entry  # noqa: E402

if __name__ == "__main__":
    sf = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.01")
    spark = (SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
             .config("spark.ui.enabled", "false").config("spark.driver.memory", "12g")
             .config("spark.sql.session.timeZone", "UTC").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    con = oracle.connect(sf)
    wanted, sql, bad = sys.argv[1:], entry.oracle_sql(), 0
    for name, fn in entry.queries().items():
        if wanted and not any(name.startswith(w) for w in wanted):
            continue
        start = time.time()
        try:
            if name in sql:
                verdict = oracle.compare(spark, con, fn, sql[name], sf)
            else:
                verdict = None if fn(spark, sf).count() else "no rows"
        except Exception as error:  # noqa: BLE001 - report every query
            verdict = f"{type(error).__name__}: {str(error)[:600]}"
        bad += verdict is not None
        print(f"{'ok ' if verdict is None else 'BAD'} {name} {time.time() - start:.1f}s {verdict or ''}"[:900], flush=True)
    print("failed:", bad)
