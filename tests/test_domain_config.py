"""The work-item job driven by a config shaped like the original one: 20-column
primary with a JSON column, 14-column activity list read from CSV, raw
hierarchy snapshots, three dated outputs."""

import datetime as dt
import json
import os

from pyspark.sql import functions as F

from joinery import run_enrichment

# The columns and types of the configured schemas.
PRIMARY = [
    ("data_source", "StringType"), ("event_id", "IntegerType"), ("activity_reference_id", "StringType"),
    ("activity_received_timestamp", "TimestampType"), ("activity_latest_timestamp", "TimestampType"),
    ("activity_latest_status", "StringType"), ("touch_start_timestamp", "TimestampType"),
    ("touch_status", "StringType"), ("process", "StringType"), ("subprocess_1", "StringType"),
    ("subprocess_2", "StringType"), ("subprocess_3", "StringType"), ("subprocess_4", "StringType"),
    ("subprocess_5", "StringType"), ("subprocess_6", "StringType"), ("incoming_volume", "IntegerType"),
    ("duration", "IntegerType"), ("csc_date", "TimestampType"), ("within_sla", "BooleanType"),
    ("additional_features", "StringType"),
]
ACTIVITY = [
    ("DataSource", "StringType"), ("Process", "StringType"), ("SubProcess1", "StringType"),
    ("SubProcess2", "StringType"), ("SubProcess3", "StringType"), ("SubProcess4", "StringType"),
    ("SubProcess5", "StringType"), ("SubProcess6", "StringType"), ("ActivityDescription", "StringType"),
    ("Centre", "StringType"), ("Capacity_Planning_Group", "StringType"), ("SLATarget", "TimestampType"),
    ("SLATargetUnit", "TimestampType"), ("JoinKey", "StringType"),
]


def _spec(fields):
    return [{"name": n, "type": t, "nullable": True} for n, t in fields]


def _ddl(fields):
    m = {"StringType": "string", "IntegerType": "int", "TimestampType": "timestamp", "BooleanType": "boolean"}
    return ", ".join(f"{n} {m[t]}" for n, t in fields)


def test_original_shaped_config(spark, tmp_dir):
    t = dt.datetime(2024, 3, 1, 9, 30)
    prim_rows = [
        ("CART", 1, "r1", t, t, "open", t, "done", "Pay Ments", "a/b", "N/A", "x", "dropped", "y", "z", 3, 10, t, True,
         json.dumps({"employee_number": "100", "other": 1})),
        ("Legacy", 2, "r2", t, t, "open", t, "done", "Claims", "c", "d", "e", "f", "g", "h", 1, 5, t, False,
         "{'employee_number': '200'}"),
        ("Legacy", 3, "r3", t, t, "open", t, "done", "Claims", None, None, None, None, None, None, 0, 0, t, None, None),
    ]
    prim_path = os.path.join(tmp_dir, "primary")
    spark.createDataFrame(prim_rows, _ddl(PRIMARY)).write.parquet(prim_path)
    act_rows = [
        ("CART", "Pay Ments", "a/b", "N/A", "x", None, "y", "z", "desc", "North", "CPG-1", None, None,
         "CART|PAYMENTS|AB|NA|X|Y|Z"),
        ("Legacy", "Claims", "c", "d", "e", "f", "g", "h", "desc", "South", None, None, None,
         "LEGACY|CLAIMS|C|D|E|F|G|H"),
    ]
    act_path = os.path.join(tmp_dir, "activity_csv")
    spark.createDataFrame(act_rows, _ddl(ACTIVITY)).write.option("header", True).csv(act_path)
    hier_path = os.path.join(tmp_dir, "hierarchy")
    spark.createDataFrame(
        [("100", "Ann", t), ("100", "Ann", t + dt.timedelta(days=3)), ("200", "Bo", t)],
        "employeeid string, employeename string, snap_date timestamp",
    ).write.parquet(hier_path)

    out = os.path.join(tmp_dir, "out")
    cfg = {
        "primary_data_source": prim_path,
        "activity_list_data_source": act_path,
        "activity_data_output_path": out,
        "employee_hierarchy_output_path": out,
        "output_path": out,
        "include_activity_data_enrichment": True,
        "include_employee_hierarchy_enrichment": True,
        "employee_info_json_column": "additional_features",
        "employee_hierarchy_source": hier_path,
        "activity_take": {"Center": "Centre", "Capacity_Planning_Group": "Capacity_Planning_Group"},
        "schemas": {"primary_data_schema": _spec(PRIMARY), "activity_data_schema": _spec(ACTIVITY)},
        "as_of": dt.date(2024, 3, 31),
        "mode": "merge_null_safe",
        "merge_unique": True,
        "activity_unique": True,
        "hierarchy_unique": True,
    }
    written = run_enrichment(spark, cfg)
    assert sorted(os.path.basename(p) for p in written.values()) == [
        "activity_data_20240331", "employee_hierarchy_20240331", "output_20240331",
    ]
    merged = spark.read.parquet(written["merged"])
    got = {r.event_id: (r.JoinKey, r.Center, r.Capacity_Planning_Group, r.employeename) for r in merged.collect()}
    assert got == {
        1: ("CART|PAYMENTS|AB|NA|X|Y|Z", "North", "CPG-1", "Ann"),
        2: ("LEGACY|CLAIMS|C|D|E|F|G|H", "South", "Not Defined", "Bo"),
        3: ("LEGACY|CLAIMS||||||", "Not Defined", "Not Defined", None),
    }
    assert merged.filter(F.col("latest_snap_date") == t + dt.timedelta(days=3)).count() == 1
