"""Times the headline queries; prints one JSON line.

BENCH_SF_DIR   table folder, default /root/testdata/sf0.1
BENCH_CPUS     cores, default 8
BENCH_RUNS     timed runs per query, default 3 (the median counts)

Raw files are written from the tables by an untimed first run. A timed run
makes the whole plan and writes every row to Spark's `noop` sink.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from rawgate import build_session

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from catalog import QUERIES  # noqa: E402

HEADLINE = [
    "intake_orders",
    "intake_orders_gzip",
    "intake_fixed_width",
    "intake_documents",
    "intake_parts",
    "intake_xml",
    "scan_delimited",
    "scan_multiline",
    "scan_fixed_width",
    "split_good_bad",
    "bad_row_report",
    "check_sum",
    "check_integrity",
    "rule_outcomes",
    "rule_list",
    "clean_cells",
    "remove_chars",
    "deobfuscate",
    "cast_types",
    "publish_stage",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = build_session(
        f"local[{cpus}]",
        "bench",
        spark__sql__shuffle__partitions=cpus,
        spark__ui__enabled="false",
        spark__driver__memory="12g",
        spark__log__level="ERROR",
    )
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    seconds = {}
    for name in HEADLINE:
        run(name)
        seconds[name] = round(statistics.median(run(name) for _ in range(runs)), 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    total = round(sum(seconds.values()), 3)
    line = {
        "metric": "sum of median seconds over headline queries",
        "value": total,
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(line), flush=True)


if __name__ == "__main__":
    main()
