import datetime as dt
import os

import pytest
from pyspark.sql import types as T

from joinery import assert_schema, conform, dated_path, scan, schema_from_spec, write_csv, write_dated
from joinery.sources import MULTI_LINE, detect_format

SPEC = [
    {"name": "id", "type": "IntegerType", "nullable": True},
    {"name": "name", "type": "StringType", "nullable": True},
    {"name": "at", "type": "TimestampType", "nullable": True},
    {"name": "ok", "type": "BooleanType", "nullable": False},
]


def test_schema_from_spec_forms():
    st = schema_from_spec(SPEC)
    assert [f.dataType for f in st.fields] == [T.IntegerType(), T.StringType(), T.TimestampType(), T.BooleanType()]
    assert st.fields[3].nullable is False
    assert schema_from_spec(st) is st


def test_schema_from_spec_ddl_and_wider_types(spark):
    st = schema_from_spec("a BIGINT, b DATE, c DECIMAL(10,2)")
    assert [f.dataType for f in st.fields] == [T.LongType(), T.DateType(), T.DecimalType(10, 2)]
    st2 = schema_from_spec([{"name": "x", "type": "LongType"}, {"name": "y", "type": "decimal(12,3)"}])
    assert st2.fields[1].dataType == T.DecimalType(12, 3)
    with pytest.raises(ValueError):
        schema_from_spec([{"name": "x", "type": "NoSuchType"}])


def test_assert_schema(spark):
    df = spark.createDataFrame([(1, "a")], "id int, name string")
    assert_schema(df, "id INT, name STRING")
    with pytest.raises(ValueError, match="name: string != int"):
        assert_schema(df, "id INT, name INT")
    with pytest.raises(ValueError, match="column order"):
        assert_schema(df, "name STRING, id INT")
    # nullability only on request
    assert_schema(df, T.StructType([T.StructField("id", T.IntegerType(), False), T.StructField("name", T.StringType())]))
    with pytest.raises(ValueError):
        assert_schema(df, "id INT NOT NULL, name STRING", check_nullable=True)


def test_scan_errors(spark, tmp_dir):
    csv_dir = os.path.join(tmp_dir, "c")
    write_csv(spark.createDataFrame([(1, "a")], "id int, name string"), csv_dir)
    with pytest.raises(ValueError, match="schema"):
        scan(spark, csv_dir)
    with pytest.raises(FileNotFoundError):
        scan(spark, os.path.join(tmp_dir, "missing"))
    with pytest.raises(FileNotFoundError):
        scan(spark, os.path.join(tmp_dir, "missing.parquet"))
    with pytest.raises(ValueError):
        scan(spark, 42)


def test_scan_passthrough_and_parquet_dir(spark, tmp_dir):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id int, name string")
    assert scan(spark, df) is df
    path = write_dated(df, tmp_dir, "things", dt.date(2024, 3, 9))
    assert path.endswith("/things_20240309")
    back = scan(spark, path, schema="id INT, name STRING")
    assert sorted(back.collect()) == sorted(df.collect())
    with pytest.raises(ValueError):
        scan(spark, path, schema="id BIGINT, name STRING")


def test_csv_header_checked_unless_positional(spark, tmp_dir):
    p = os.path.join(tmp_dir, "swapped")
    write_csv(spark.createDataFrame([("a", 1)], "name string, id int"), p)
    with pytest.raises(Exception):
        scan(spark, p, schema="id INT, name STRING", format="csv").collect()
    rows = scan(spark, p, schema="id STRING, name STRING", format="csv", by_position=True).collect()
    assert rows[0].id == "a" and rows[0].name == "1"


def test_csv_bad_value_null_or_fail(spark, tmp_dir):
    p = os.path.join(tmp_dir, "bad")
    write_csv(spark.createDataFrame([("x", "1"), ("2", "2")], "id string, name string"), p)
    rows = scan(spark, p, schema="id INT, name STRING", format="csv").orderBy("name").collect()
    assert [r.id for r in rows] == [None, 2]
    with pytest.raises(Exception):
        scan(spark, p, schema="id INT, name STRING", format="csv", bad_records="fail").collect()


def test_conform(spark):
    df = spark.createDataFrame([("7", "2024-01-01", "x", "keep")], "a string, b string, c string, d string")
    out = conform(df, "a INT, b DATE, c INT")
    assert out.columns == ["a", "b", "c", "d"]
    assert out.collect()[0] == (7, dt.date(2024, 1, 1), None, "keep")
    with pytest.raises(Exception):
        conform(df, "c INT", on_error="fail").collect()
    withnull = conform(df, "a INT, e BOOLEAN", missing="null")
    assert withnull.columns[-1] == "e" and withnull.collect()[0].e is None
    with pytest.raises(ValueError):
        conform(df, "e BOOLEAN", missing="error")


def test_conform_keeps_null_as_null(spark):
    df = spark.createDataFrame([(None, None, None)], "a string, b string, c string")
    assert tuple(conform(df, "a INT, b BOOLEAN, c STRING").collect()[0]) == (None, None, None)


def test_dated_path():
    assert dated_path("hdfs://nn/out/", "output", "2024-05-06") == "hdfs://nn/out/output_20240506"
    with pytest.raises(ValueError):
        dated_path("", "x", dt.date.today())
    with pytest.raises(ValueError):
        dated_path("/a", "../x", dt.date.today())


def test_write_dated_rejects_duplicate_names(spark, tmp_dir):
    df = spark.createDataFrame([(1, 2)], "a int, b int").toDF("a", "a")
    with pytest.raises(ValueError, match="duplicate"):
        write_dated(df, tmp_dir, "dup", dt.date(2024, 1, 1))


def test_scan_table(spark):
    from joinery import latest_snapshot, scan_table

    spark.createDataFrame(
        [("e1", "A", dt.datetime(2024, 1, 1)), ("e1", "A", dt.datetime(2024, 2, 1))],
        "employeeid string, employeename string, snap_date timestamp",
    ).createOrReplaceTempView("hierarchy_snapshots")
    raw = scan_table(spark, "hierarchy_snapshots", schema="employeeid STRING, employeename STRING, snap_date TIMESTAMP")
    snap = latest_snapshot(raw, ["employeeid", "employeename"], "snap_date").collect()
    assert [tuple(r) for r in snap] == [("e1", "A", dt.datetime(2024, 2, 1))]
    with pytest.raises(ValueError):
        scan_table(spark, "hierarchy_snapshots", schema="employeeid INT")


def test_csv_round_trip_keeps_blanks_and_empty_strings(spark, tmp_dir):
    rows = [(1, "  lead"), (2, "trail  "), (3, ""), (4, None), (5, 'q"uote,comma'), (6, " ")]
    df = spark.createDataFrame(rows, "id int, s string")
    p = write_csv(df, os.path.join(tmp_dir, "blanks"), options={"nullValue": "\\N"})
    back = scan(spark, p, schema="id INT, s STRING", format="csv", options={"nullValue": "\\N"})
    assert [tuple(r) for r in back.orderBy("id").collect()] == rows
    p2 = write_csv(df, os.path.join(tmp_dir, "blanks_default"))
    back2 = {r.id: r.s for r in scan(spark, p2, schema="id INT, s STRING", format="csv").collect()}
    assert back2[1] == "  lead" and back2[2] == "trail  "


def test_write_dated_csv_has_header(spark, tmp_dir):
    df = spark.createDataFrame([(1, " a ")], "id int, name string")
    path = write_dated(df, tmp_dir, "things_csv", "2024-04-01", format="csv")
    back = scan(spark, path, schema="id INT, name STRING", format="csv").collect()
    assert [tuple(r) for r in back] == [(1, " a ")]


def test_csv_with_line_ends(spark, tmp_dir):
    df = spark.createDataFrame([(1, 'line1\nline2 "q", x'), (2, "\r\n\\"), (3, None), (4, "")], "id int, t string")
    with pytest.raises(Exception, match="line end"):
        write_csv(df, os.path.join(tmp_dir, "plain"))
    mark = {"nullValue": "\\N"}
    path = write_csv(df, os.path.join(tmp_dir, "multi"), multi_line=True, options=mark)
    back = scan(spark, path, schema=df.schema, format="csv", options={**MULTI_LINE, **mark})
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))


def test_probe_looks_at_one_level(spark, tmp_dir):
    df = spark.createDataFrame([(1, "a")], "id int, part string")
    write_csv(df, os.path.join(tmp_dir, "mixed", "top"))
    df.write.partitionBy("part").parquet(os.path.join(tmp_dir, "dated"))
    df.write.parquet(os.path.join(tmp_dir, "mixed", "below"))
    assert detect_format(spark, os.path.join(tmp_dir, "dated")) == "parquet"
    assert detect_format(spark, os.path.join(tmp_dir, "mixed")) == "csv"
