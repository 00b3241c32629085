import datetime as dt
import os

import pytest

from joinery import ActivityStep, HierarchyStep, enrich_frame, run_enrichment
from joinery.plans.domain import WORK_ITEM_PARTS
from joinery.streaming import enrich_stream

PRIMARY_SPEC = [
    {"name": c, "type": "StringType", "nullable": True} for c in WORK_ITEM_PARTS
] + [
    {"name": "event_id", "type": "IntegerType", "nullable": True},
    {"name": "additional_features", "type": "StringType", "nullable": True},
]
ACTIVITY_SPEC = [
    {"name": "JoinKey", "type": "StringType", "nullable": True},
    {"name": "New_Center", "type": "StringType", "nullable": True},
    {"name": "Capacity_Planning_Group", "type": "StringType", "nullable": True},
]


def _primary(spark):
    rows = [
        ("CART", "P1", "a", "b", "c", "d", "e", "f", 1, '{"employee_number": "100"}'),
        ("X", "P2", "a", "b", "c", "d", "e", "f", 2, '{"employee_number": "200"}'),
        ("X", "P3", None, None, None, None, None, None, 3, None),
    ]
    ddl = ", ".join(f"{c} string" for c in WORK_ITEM_PARTS) + ", event_id int, additional_features string"
    return spark.createDataFrame(rows, ddl)


def _activity(spark):
    return spark.createDataFrame(
        [("CART|P1|A|B|C|E|F", "North", "G1"), ("X|P2|A|B|C|D|E|F", "South", None)],
        "JoinKey string, New_Center string, Capacity_Planning_Group string",
    )


def _raw_hierarchy(spark):
    return spark.createDataFrame(
        [("100", "Ann", dt.datetime(2024, 1, 1)), ("100", "Ann", dt.datetime(2024, 2, 1)), ("200", "Bo", dt.datetime(2024, 1, 5))],
        "employeeid string, employeename string, snap_date timestamp",
    )


def _steps(spark):
    from joinery import latest_snapshot

    snap = latest_snapshot(_raw_hierarchy(spark), ["employeeid", "employeename"], "snap_date", "latest_snap_date")
    return ActivityStep(lookup=_activity(spark)), HierarchyStep(snapshot=snap, json_col="additional_features")


def test_enrich_frame_modes_agree(spark):
    act, hier = _steps(spark)
    prim = _primary(spark)
    merged = enrich_frame(prim, activity=act, hierarchy=hier, mode="merge")
    chained = enrich_frame(prim, activity=act, hierarchy=hier, mode="chain")
    safe = enrich_frame(prim, activity=act, hierarchy=hier, mode="merge_null_safe")
    cols = sorted(merged.columns)
    assert cols == sorted(chained.columns) == sorted(safe.columns)
    rows = lambda df: sorted(tuple(r[c] for c in cols) for r in df.collect())
    # the third row has NULL subprocess columns: the faithful merge repeats it
    assert merged.count() == 4
    assert rows(chained) == rows(safe)
    got = {r.event_id: (r.Center, r.Capacity_Planning_Group, r.employeename) for r in chained.collect()}
    assert got == {1: ("North", "G1", "Ann"), 2: ("South", "Not Defined", "Bo"), 3: ("Not Defined", "Not Defined", None)}


def test_enrich_frame_single_and_none(spark):
    act, hier = _steps(spark)
    prim = _primary(spark)
    only_act = enrich_frame(prim, activity=act)
    assert "Center" in only_act.columns and "employeename" not in only_act.columns
    only_hier = enrich_frame(prim, hierarchy=hier)
    assert "employeename" in only_hier.columns and "Center" not in only_hier.columns
    keyed = enrich_frame(prim)
    assert keyed.columns[-1] == "JoinKey"


def test_run_enrichment_writes_dated_outputs(spark, tmp_dir):
    prim_path = os.path.join(tmp_dir, "primary")
    _primary(spark).write.parquet(prim_path)
    act_path = os.path.join(tmp_dir, "activity_csv")
    _activity(spark).write.option("header", True).csv(act_path)
    hier_path = os.path.join(tmp_dir, "hier")
    _raw_hierarchy(spark).write.parquet(hier_path)
    cfg = {
        "primary_data_source": prim_path,
        "schemas": {"primary_data_schema": PRIMARY_SPEC, "activity_data_schema": ACTIVITY_SPEC},
        "activity_list_data_source": act_path,
        "include_activity_data_enrichment": True,
        "include_employee_hierarchy_enrichment": True,
        "employee_hierarchy_source": hier_path,
        "employee_info_json_column": "additional_features",
        "activity_data_output_path": os.path.join(tmp_dir, "out_a"),
        "employee_hierarchy_output_path": os.path.join(tmp_dir, "out_h"),
        "output_path": os.path.join(tmp_dir, "out"),
        "as_of": dt.date(2024, 6, 30),
    }
    written = run_enrichment(spark, cfg)
    assert written["activity"].endswith("out_a/activity_data_20240630")
    assert written["hierarchy"].endswith("out_h/employee_hierarchy_20240630")
    assert written["merged"].endswith("out/output_20240630")
    merged = spark.read.parquet(written["merged"])
    assert merged.count() == 4
    assert spark.read.parquet(written["activity"]).count() == 3

    chain_cfg = dict(cfg, mode="chain", output_path=os.path.join(tmp_dir, "out_chain"),
                     activity_data_output_path=None, employee_hierarchy_output_path=None)
    w2 = run_enrichment(spark, chain_cfg)
    assert list(w2) == ["merged"]
    assert spark.read.parquet(w2["merged"]).count() == 3

    safe_cfg = dict(cfg, mode="merge_null_safe", output_path=os.path.join(tmp_dir, "out_safe"),
                    activity_data_output_path=None, employee_hierarchy_output_path=None)
    w3 = run_enrichment(spark, safe_cfg)  # merge sides come from reliable checkpoints
    assert spark.read.parquet(w3["merged"]).count() == 3

    latest = dict(cfg, mode="chain", hierarchy_latest_only=True, output_path=os.path.join(tmp_dir, "out_latest"),
                  activity_data_output_path=None, employee_hierarchy_output_path=None)
    w4 = run_enrichment(spark, latest)
    assert spark.read.parquet(w4["merged"]).count() == 3

    off = dict(cfg, include_activity_data_enrichment=False, include_employee_hierarchy_enrichment=False)
    assert run_enrichment(spark, off) == {}


def test_enrich_stream_matches_batch(spark, tmp_dir):
    src = os.path.join(tmp_dir, "stream_src")
    _primary(spark).write.parquet(src)
    act, hier = _steps(spark)
    stream = spark.readStream.schema(_primary(spark).schema).parquet(src)
    out = enrich_stream(stream, key=None, activity=ActivityStep(lookup=_activity(spark).withColumnRenamed("JoinKey", "k"), on=("subprocess_1", "k")), hierarchy=hier)
    q = out.writeStream.format("memory").queryName("enriched_stream").outputMode("append").start()
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    assert spark.table("enriched_stream").count() == 3
    with pytest.raises(ValueError):
        enrich_stream(_primary(spark), activity=act)


def test_enrich_frame_writes_and_reads_back(spark, tmp_dir):
    act, hier = _steps(spark)
    bases = {k: os.path.join(tmp_dir, k) for k in ("activity", "hierarchy", "merged")}
    out = enrich_frame(_primary(spark), activity=act, hierarchy=hier, mode="merge_null_safe",
                       write_to=bases, as_of="2024-02-29")
    assert os.path.isdir(os.path.join(bases["activity"], "activity_data_20240229"))
    assert os.path.isdir(os.path.join(bases["hierarchy"], "employee_hierarchy_20240229"))
    assert "output_20240229" in out.inputFiles()[0]
    assert out.count() == 3
    only = enrich_frame(_primary(spark), activity=act, write_to={"activity": os.path.join(tmp_dir, "solo")}, as_of="2024-02-29")
    assert "activity_data_20240229" in only.inputFiles()[0]
