"""A query over many small order files: its result, and the tasks that it takes to list and read them."""

import glob
import uuid

from catalog import QUERIES
from rawgate import session

FILES = 100
SCHEMA = "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp, o_orderpriority string"


def test_row_counts_of_many_files_take_few_tasks(spark, tmp_path):
    rows = spark.range(2 * FILES).selectExpr(
        "id div 2 * 1000 + id % 2 o_orderkey", "id o_custkey", "'O' o_orderstatus", "id + 0.5D o_totalprice",
        "timestamp'2024-01-01' o_orderdate", "'3-MEDIUM' o_orderpriority",
    )
    rows.select(*[c.split()[0] for c in SCHEMA.split(", ")]).write.parquet(f"{tmp_path}/orders.parquet")
    context, group = spark.sparkContext, uuid.uuid4().hex
    keys = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {k: spark.conf.get(k) for k in keys}
    try:
        spark.conf.set(keys[0], "16m")
        spark.conf.set(keys[1], str(session.DEFAULT_OPEN_BYTES))
        context.setJobGroup(group, "row counts")
        with session.registered_staging() as staged:
            got = QUERIES["check_row_count"](spark, str(tmp_path)).collect()
    finally:
        context._jsc.clearJobGroup()
        for k, v in before.items():
            spark.conf.set(k, v)
    assert sorted((r.file_nm, r.outcome) for r in got) == [
        (f"orders_{i:06d}.csv", "Fail" if i % 5 == 3 else "Pass") for i in range(FILES)
    ]
    tracker = context.statusTracker()
    stages = [s for j in tracker.getJobIdsForGroup(group) for s in tracker.getJobInfo(j).stageIds]
    assert max(tracker.getStageInfo(s).numTasks for s in stages if tracker.getStageInfo(s)) <= 4 * context.defaultParallelism < FILES
    records = [p for p in staged if "/orders-" in p and "/raw-" not in p]
    assert len(records) == 1 and len(glob.glob(f"{records[0]}/part-*")) < FILES // 4
