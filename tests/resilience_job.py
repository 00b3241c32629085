"""Run by tests/test_resilience.py in its own process: a session that allows
task retries (``local[4,4]``), an input whose first task attempt fails (as
when an executor is lost), and the enrichment workflow on top of it. Prints
the sorted output rows as JSON."""

import datetime as dt
import json
import os
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark import TaskContext  # noqa: E402
from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from joinery import run_enrichment  # noqa: E402
from joinery.plans.domain import WORK_ITEM_PARTS  # noqa: E402


def main(flaky: bool, work: str) -> None:
    spark = (
        SparkSession.builder.master("local[4,4]")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.checkpoint.dir", os.path.join(work, "ckpt"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")

    @F.udf("string")
    def fail_first_attempt(v):
        ctx = TaskContext.get()
        if flaky and ctx.partitionId() == 1 and ctx.attemptNumber() == 0:
            raise RuntimeError("simulated lost executor")
        return v

    n = 2000
    base = spark.range(0, n, 1, 4).select(
        F.when(F.col("id") % 5 == 0, F.lit("CART")).otherwise(F.lit("X")).alias("data_source"),
        *[(F.col("id") % (3 + i)).cast("string").alias(c) for i, c in enumerate(WORK_ITEM_PARTS[1:])],
        F.col("id").cast("int").alias("event_id"),
        F.to_json(F.struct((F.col("id") % 50).cast("string").alias("employee_number"))).alias("additional_features"),
    )
    primary = base.withColumn("process", fail_first_attempt("process"))
    activity = spark.range(0, 30).select(
        F.concat_ws("|", F.lit("X"), *[(F.col("id") % (3 + i)).cast("string") for i in range(7)]).alias("JoinKey"),
        F.lit("C").alias("New_Center"),
        F.col("id").cast("string").alias("Capacity_Planning_Group"),
    )
    hierarchy = spark.range(0, 60).select(
        F.col("id").cast("string").alias("employeeid"),
        F.concat(F.lit("name"), F.col("id").cast("string")).alias("employeename"),
        F.lit(dt.datetime(2024, 1, 1)).alias("snap_date"),
    )
    cfg = {
        "primary_data_source": primary,
        "activity_list_data_source": activity,
        "employee_hierarchy_source": hierarchy,
        "include_activity_data_enrichment": True,
        "include_employee_hierarchy_enrichment": True,
        "employee_info_json_column": "additional_features",
        "activity_data_output_path": os.path.join(work, "a"),
        "employee_hierarchy_output_path": os.path.join(work, "h"),
        "output_path": os.path.join(work, "o"),
        "as_of": dt.date(2024, 1, 31),
    }
    written = run_enrichment(spark, cfg)
    rows = spark.read.parquet(written["merged"]).collect()
    out = sorted(json.dumps([None if v is None else str(v) for v in r]) for r in rows)
    tracker = spark.sparkContext.statusTracker()
    failed = 0
    for job in tracker.getJobIdsForGroup(None):
        info = tracker.getJobInfo(job)
        for stage in info.stageIds if info else []:
            st = tracker.getStageInfo(stage)
            failed += st.numFailedTasks if st else 0
    print("FAILED_TASKS " + str(failed))
    print("RESULT " + json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1] == "flaky", tempfile.mkdtemp(prefix="joinery-resilience-"))
