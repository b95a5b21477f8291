"""python tests/check_queries.py [sf_dir] [key …]: compare queries with their SQL, with timings."""

import sys
import time
from pathlib import Path

sys.path[:0] = [str(Path(__file__).resolve().parent), str(Path(__file__).resolve().parent.parent)]

from pyspark.sql import SparkSession  # noqa: E402

import __spark_entry__ as entry  # noqa: E402
from compare import connect, difference, spark_rows, sql_rows  # noqa: E402

if __name__ == "__main__":
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    keys = sys.argv[2:]
    spark = (SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
             .config("spark.ui.enabled", "false").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    queries, sql = entry.queries(), entry.oracle_sql()
    bad = 0
    for key in keys or queries:
        start = time.time()
        try:
            got = spark_rows(queries[key](spark, sf_dir))
            took = time.time() - start
            problem = difference(got, sql_rows(con, sql[key]))
        except Exception as error:
            problem, got, took = f"{type(error).__name__}: {str(error)[:1500]}", ([], []), time.time() - start
        bad += bool(problem)
        print(f"{key:22s} {len(got[1]):7d} rows {took:6.2f}s {problem or 'ok'}", flush=True)
    print(f"{bad} of {len(keys or queries)} differ; no SQL for {sorted(set(queries) - set(sql))}")
    spark.stop()
    sys.exit(bool(bad))
