"""Compare every query with its SQL: python tests/run_all.py [folder] [name part ...]"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

import __spark_entry__ as entry  # noqa: E402
from tests.compare import compare, connect  # noqa: E402


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    parts = sys.argv[2:]
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    sqls = entry.oracle_sql()
    bad = 0
    for name, fn in entry.queries().items():
        if parts and not any(p in name for p in parts):
            continue
        try:
            problem, rows, seconds = compare(spark, con, sf_dir, fn, sqls.get(name))
        except Exception as error:  # noqa: BLE001
            problem, rows, seconds = f"{type(error).__name__}: {str(error)[:600]}", -1, 0.0
        bad += problem is not None
        print(f"{'BAD ' if problem else 'ok  '} {name:26s} {rows:8d} rows {seconds:6.2f}s {problem or ''}", flush=True)
    print("problems:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(main())
