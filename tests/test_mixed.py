"""Folders of Parquet files that differ."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from joinery.sources import scan_mixed
from joinery.sources.mixed import wider


def days(spark, path):
    spark.createDataFrame([(1, "a", 1.5), (2, None, None)], "id int, name string, x float").repartition(2).write.parquet(f"{path}/day1")
    spark.createDataFrame([(2**40, "b", 2.25, True, dt.date(2024, 1, 2))], "id bigint, name string, x double, flag boolean, d date").write.parquet(f"{path}/day2")
    spark.createDataFrame([("c", dt.datetime(2024, 1, 3, 4))], "name string, d timestamp_ntz").write.parquet(f"{path}/more/day3")


def test_added_and_widened_columns(spark, tmp_dir):
    days(spark, tmp_dir)
    df, report = scan_mixed(spark, tmp_dir)
    assert df.schema.simpleString() == "struct<id:bigint,name:string,x:double,flag:boolean,d:timestamp_ntz>"
    assert sorted(map(tuple, df.collect()), key=str) == sorted([
        (1, "a", 1.5, None, None), (2, None, None, None, None), (2**40, "b", 2.25, True, dt.datetime(2024, 1, 2)), (None, "c", None, None, dt.datetime(2024, 1, 3, 4))], key=str)
    assert [r["missing"] for r in report] == [["flag", "d"], [], ["id", "x", "flag"]]
    assert report[0]["cast"] == [("id", "int", "bigint"), ("x", "float", "double")] and report[1]["cast"] == [("d", "date", "timestamp_ntz")]
    assert report[0]["files"] == 2 and report[2]["folders"][0].endswith("more/day3")


def test_given_schema(spark, tmp_dir):
    days(spark, tmp_dir)
    df, report = scan_mixed(spark, tmp_dir, "name string, id bigint, extra string")
    assert df.columns == ["name", "id", "extra"] and df.filter("id > 5").count() == 1
    assert report[1]["ignored"] == ["x", "flag", "d"]
    plan = df.filter("id > 5").select("id")._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall("PushedFilters: .*id", plan)) >= 1 and "name" not in " ".join(re.findall("ReadSchema: (.*)", plan))
    with pytest.raises(ValueError, match="id"):
        scan_mixed(spark, tmp_dir, "id int")


def test_files_of_one_folder_differ(spark, tmp_dir):
    spark.range(3).select(F.col("id").cast("int")).coalesce(1).write.mode("append").parquet(f"{tmp_dir}/p")
    spark.range(3).selectExpr("id + 5000000000 AS id", "'x' AS t").coalesce(1).write.mode("append").parquet(f"{tmp_dir}/p")
    df, report = scan_mixed(spark, f"{tmp_dir}/p", every_file=True)
    assert sorted(r.id for r in df.collect()) == [0, 1, 2, 5000000000, 5000000001, 5000000002] and len(report) == 2
    with pytest.raises(FileNotFoundError):
        scan_mixed(spark, f"{tmp_dir}/none")


def test_types_that_do_not_meet(spark, tmp_dir):
    spark.range(1).selectExpr("id AS v").write.parquet(f"{tmp_dir}/a")
    spark.range(1).selectExpr("'x' AS v").write.parquet(f"{tmp_dir}/b")
    with pytest.raises(ValueError, match="v"):
        scan_mixed(spark, tmp_dir)
    assert wider(T.DecimalType(10, 2), T.DecimalType(8, 4)) == T.DecimalType(12, 4)
    assert wider(T.DecimalType(38, 0), T.DecimalType(38, 2)) is None
    assert wider(T.LongType(), T.DoubleType()) is None and wider(T.DoubleType(), T.IntegerType()) == T.DoubleType()
    assert wider(T.ByteType(), T.LongType()) == T.LongType() and wider(T.StringType(), T.DateType()) is None
