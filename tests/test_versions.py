"""Versions of outputs, restarts of the job and bad lines kept apart."""

import json
import os
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from joinery import read_version, scan_with_quarantine, write_dated, write_version
from joinery.plans import domain, run_enrichment
from joinery.sources import config_digest, drop_old_versions, finished, input_fingerprint, versions

DAY = "2024-05-06"
SCRIPT = os.path.join(os.path.dirname(os.path.abspath(__file__)), "restart_job.py")


def test_versions_follow_each_other(spark, tmp_dir):
    with pytest.raises(FileNotFoundError):
        read_version(spark, tmp_dir, "output", DAY)
    assert versions(spark, tmp_dir, "output", DAY) == []
    a = write_version(spark.range(10), tmp_dir, "output", DAY)
    before = read_version(spark, tmp_dir, "output", DAY)
    b = write_version(spark.range(20).withColumn("k", F.col("id") % 2), tmp_dir, "output", DAY, partition_by=["k"])
    assert (a.seq, a.rows, b.seq, b.rows) == (1, 10, 2, 20)
    assert read_version(spark, tmp_dir, "output", DAY).count() == 20
    assert before.count() == 10  # a reader on the first version is left alone
    assert read_version(spark, tmp_dir, "output", DAY, a.version).count() == 10
    assert drop_old_versions(spark, tmp_dir, "output", DAY) == [a.data]
    assert read_version(spark, tmp_dir, "output", DAY).count() == 20
    with pytest.raises(ValueError):
        drop_old_versions(spark, tmp_dir, "output", DAY, keep=0)
    with pytest.raises(ValueError):
        write_version(spark.range(1).selectExpr("id", "id"), tmp_dir, "output", DAY)


def test_failed_write_is_never_seen(spark, tmp_dir):
    broken = spark.range(100).select(F.when(F.col("id") == 77, F.raise_error(F.lit("lost")).cast("long")).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception, match="lost"):
        write_version(broken, tmp_dir, "output", DAY)
    with pytest.raises(FileNotFoundError):
        read_version(spark, tmp_dir, "output", DAY)
    write_version(spark.range(5), tmp_dir, "output", DAY)
    with pytest.raises(Exception, match="lost"):
        write_version(broken, tmp_dir, "output", DAY)
    assert read_version(spark, tmp_dir, "output", DAY).count() == 5


def test_finished_compares_inputs_config_and_rows(spark, tmp_dir):
    write_version(spark.range(5), tmp_dir, "output", DAY, "i", "c")
    assert finished(spark, tmp_dir, "output", DAY, "i", "c").rows == 5
    assert finished(spark, tmp_dir, "output", DAY, "j", "c") is None
    assert finished(spark, tmp_dir, "output", DAY, "i", "d") is None
    write_version(spark.range(5), tmp_dir, "output", DAY, None, "c")
    assert finished(spark, tmp_dir, "output", DAY, None, "c") is None
    row = write_version(spark.range(5), tmp_dir, "output", DAY, "i", "c")
    spark.range(2).write.mode("append").parquet(row.data)
    assert finished(spark, tmp_dir, "output", DAY, "i", "c") is None
    drop_old_versions(spark, tmp_dir, "output", DAY)
    assert finished(spark, tmp_dir, "absent", DAY, "i", "c") is None


def test_fingerprints(spark, tmp_dir):
    path = f"{tmp_dir}/a"
    spark.range(5).write.parquet(path)
    one = input_fingerprint(spark.read.parquet(path))
    assert one == input_fingerprint(spark.read.parquet(path))
    assert one != input_fingerprint(spark.read.parquet(path).filter("id > 1"))
    spark.range(6).write.mode("overwrite").parquet(path)
    assert one != input_fingerprint(spark.read.parquet(path))
    assert input_fingerprint(spark.createDataFrame([(1,)], "a int")) is None
    assert config_digest({"a": 1, "b": spark}) == config_digest({"b": spark, "a": 1}) != config_digest({"a": 2, "b": spark})


def _sources(spark, tmp_dir):
    keys = [F.concat(F.lit(n), F.col("id") % 20).alias(n) for n in domain.WORK_ITEM_PARTS]
    primary = spark.range(200).select("id", *keys, F.concat(F.lit('{"employee_number": "'), F.col("id") % 30, F.lit('"}')).alias("info"))
    labels = domain.work_item_key(primary.filter("id < 15").drop("id", "info")).select("JoinKey", F.lit("C").alias("New_Center"), F.lit("G").alias("Capacity_Planning_Group"))
    snaps = spark.range(25).select(F.col("id").alias("employeeid"), F.lit("n").alias("employeename"), F.current_date().alias("snap_date"))
    for name, df in (("primary", primary), ("labels", labels), ("snaps", snaps)):
        df.write.mode("overwrite").parquet(f"{tmp_dir}/{name}.parquet")
    return {
        "primary_data_source": f"{tmp_dir}/primary.parquet", "activity_list_data_source": f"{tmp_dir}/labels.parquet",
        "employee_hierarchy_source": f"{tmp_dir}/snaps.parquet", "employee_info_json_column": "info",
        "include_activity_data_enrichment": True, "include_employee_hierarchy_enrichment": True, "restart": True, "as_of": DAY,
        "activity_data_output_path": f"{tmp_dir}/out", "employee_hierarchy_output_path": f"{tmp_dir}/out", "output_path": f"{tmp_dir}/out",
    }


def _start(cfg, tmp_dir, *more):
    config, report = f"{tmp_dir}/cfg.json", f"{tmp_dir}/report.json"
    with open(config, "w") as f:
        json.dump({**cfg, "checkpoint": f"{tmp_dir}/ckpt"}, f)
    run = subprocess.run([sys.executable, SCRIPT, config, report, *more], capture_output=True, text=True, timeout=300)
    if run.returncode:
        return run.returncode, run.stderr[-2000:]
    with open(report) as f:
        return 0, json.load(f)


def test_killed_job_makes_only_the_rest(spark, tmp_dir):
    cfg = _sources(spark, tmp_dir)
    names = domain.OUTPUT_NAMES
    code, said = _start(cfg, tmp_dir, names["activity"])
    assert code == 3, said
    first = versions(spark, f"{tmp_dir}/out", names["activity"], DAY)
    assert len(first) == 1 and versions(spark, f"{tmp_dir}/out", names["merged"], DAY) == []
    code, said = _start(cfg, tmp_dir)
    assert code == 0, said
    assert said["made"] == [names["hierarchy"], names["merged"]]
    assert said["written"]["activity"] == first[0].data
    plain = run_enrichment(spark, {**cfg, "restart": False, **{k: f"{tmp_dir}/plain" for k in cfg if k.endswith("output_path")}})
    want, got = (sorted(map(tuple, spark.read.parquet(x["merged"]).collect()), key=str) for x in (plain, said["written"]))
    assert got == want and want
    # nothing to do, then a changed setting and a changed file
    assert run_enrichment(spark, cfg) == said["written"]
    changed = run_enrichment(spark, {**cfg, "mode": "merge_null_safe"})
    assert not set(changed.values()) & set(said["written"].values())
    spark.range(25).select(F.col("id").alias("employeeid"), F.lit("m").alias("employeename"), F.current_date().alias("snap_date")).write.mode("overwrite").parquet(f"{tmp_dir}/snaps.parquet")
    again = run_enrichment(spark, {**cfg, "mode": "merge_null_safe"})
    assert not set(again.values()) & set(changed.values())


def test_partitions_are_replaced_one_by_one(spark, tmp_dir):
    rows = spark.createDataFrame([(1, "a"), (2, "b")], "v int, k string")
    path = write_dated(rows, tmp_dir, "output", DAY, partition_by=["k"], replace="partitions")
    write_dated(spark.createDataFrame([(3, "b"), (4, "c")], "v int, k string"), tmp_dir, "output", DAY, partition_by=["k"], replace="partitions")
    assert sorted((r.v, r.k) for r in spark.read.parquet(path).collect()) == [(1, "a"), (3, "b"), (4, "c")]
    write_dated(rows, tmp_dir, "output", DAY, partition_by=["k"])
    assert sorted((r.v, r.k) for r in spark.read.parquet(path).collect()) == [(1, "a"), (2, "b")]
    with pytest.raises(ValueError):
        write_dated(rows, tmp_dir, "output", DAY, replace="partitions")


def test_bad_lines_are_kept_apart(spark, tmp_dir):
    lines = ["id,name,amount", "1,ann,2.5", "x,bob,1", "3,,", "", "4,cid", "5,dora,1,extra", '6,"a,b",7', "7,eve,oops", ",,", "9999999999,big,1"]
    os.makedirs(f"{tmp_dir}/csv")
    with open(f"{tmp_dir}/csv/a.csv", "w") as f:
        f.write("\n".join(lines) + "\n")
    with open(f"{tmp_dir}/csv/b.csv", "w") as f:
        f.write("id,name,amount\n8,fay,3\n")
    ddl = "id int, name string, amount double"
    good, found = scan_with_quarantine(spark, f"{tmp_dir}/csv", ddl, f"{tmp_dir}/q")
    assert found == {"good": 5, "bad": 5}
    assert good.columns == ["id", "name", "amount"]
    # one column alone gives the same rows
    assert sorted(r.id or 0 for r in good.select("id").collect()) == [0, 1, 3, 6, 8]
    bad = spark.read.parquet(f"{tmp_dir}/q/bad").collect()
    assert sorted(r.line for r in bad) == sorted(["x,bob,1", "4,cid", "5,dora,1,extra", "7,eve,oops", "9999999999,big,1"])
    assert all(r.file.endswith("a.csv") and r["at"] for r in bad)
    with pytest.raises(ValueError, match="50.00%|are bad"):
        scan_with_quarantine(spark, f"{tmp_dir}/csv", ddl, f"{tmp_dir}/q2", most_bad=0.4)
    assert spark.read.parquet(f"{tmp_dir}/q2/bad").count() == 5
    with pytest.raises(FileNotFoundError):
        scan_with_quarantine(spark, f"{tmp_dir}/none", ddl, f"{tmp_dir}/q3")
    with pytest.raises(ValueError):
        scan_with_quarantine(spark, f"{tmp_dir}/csv", "_bad_line string", f"{tmp_dir}/q4")


def test_no_bad_lines(spark, tmp_dir):
    with open(f"{tmp_dir}/a.csv", "w") as f:
        f.write("id\n1\n")
    good, found = scan_with_quarantine(spark, f"{tmp_dir}/a.csv", "id int", f"{tmp_dir}/q", most_bad=0.0)
    assert found == {"good": 1, "bad": 0} and [r.id for r in good.collect()] == [1]
    assert spark.read.parquet(f"{tmp_dir}/q/bad").count() == 0
