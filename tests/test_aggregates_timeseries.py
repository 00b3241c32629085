import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from joinery import expand_days, latest_snapshot, match_stats, span_bounds

D = dt.date


def test_latest_snapshot(spark):
    df = spark.createDataFrame(
        [("e1", "A", D(2024, 1, 1)), ("e1", "A", D(2024, 1, 2)), ("e1", "B", D(2024, 1, 3))],
        "employeeid string, employeename string, snap_date date",
    )
    got = latest_snapshot(df, ["employeeid", "employeename"], "snap_date").orderBy("employeename").collect()
    assert [tuple(r) for r in got] == [("e1", "A", D(2024, 1, 2)), ("e1", "B", D(2024, 1, 3))]
    only = latest_snapshot(df, ["employeeid", "employeename"], "snap_date", latest_only=True).collect()
    assert [tuple(r) for r in only] == [("e1", "B", D(2024, 1, 3))]


SPANS = [
    (1, D(2024, 1, 1), D(2024, 1, 3)),
    (2, D(2024, 1, 1), D(2024, 1, 1)),
    (3, D(2024, 1, 3), D(2024, 1, 1)),
    (4, None, D(2024, 1, 1)),
]


@pytest.fixture()
def spans(spark):
    return spark.createDataFrame(SPANS, "id int, StartDate date, EndDate date")


def _counts(df):
    return {r.id: r.n for r in df.groupBy("id").agg(F.count("snap_date").alias("n")).collect()}


def test_expand_days_faithful(spans):
    out = expand_days(spans, "StartDate", "EndDate")
    assert _counts(out) == {1: 3, 2: 1, 3: 3}
    desc = [r.snap_date for r in out.filter("id = 3").collect()]
    assert desc == [D(2024, 1, 3), D(2024, 1, 2), D(2024, 1, 1)]


def test_expand_days_drop_and_keep_null(spans):
    assert _counts(expand_days(spans, "StartDate", "EndDate", on_reversed="drop")) == {1: 3, 2: 1}
    kept = expand_days(spans, "StartDate", "EndDate", on_reversed="drop", keep_null=True)
    assert kept.count() == 3 + 1 + 1 + 1
    assert kept.filter("snap_date IS NULL").count() == 2


def test_expand_days_timestamps_and_row_count_property(spark):
    random.seed(11)
    rows = []
    for i in range(300):
        s = dt.datetime(2024, 1, 1, 13, 30) + dt.timedelta(days=random.randint(0, 400))
        rows.append((i, s, s + dt.timedelta(days=random.randint(0, 40), hours=random.randint(0, 20))))
    df = spark.createDataFrame(rows, "id int, s timestamp_ntz, e timestamp_ntz")
    expected = sum((e.date() - s.date()).days + 1 for _, s, e in rows)
    assert expand_days(df, "s", "e").count() == expected


def test_span_bounds_single_job(spark, spans):
    """One pass, one job (measured with AQE off: AQE submits each query stage
    of the same pass as its own job)."""
    sc = spark.sparkContext
    tracker = sc.statusTracker()
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        sc.setJobGroup("bounds", "span bounds")
        row = span_bounds(spans, "StartDate", "EndDate").collect()
        jobs = set(tracker.getJobIdsForGroup("bounds"))
        sc.setJobGroup("other", "other")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert tuple(row[0]) == (D(2024, 1, 1), D(2024, 1, 3))
    assert len(jobs) == 1


def test_match_stats(spark):
    df = spark.createDataFrame([("a", None), ("Not Defined", "x"), (None, "y")], "c1 string, c2 string")
    got = {r.column: (r.total_rows, r.matched_rows) for r in match_stats(df, ["c1", "c2"], unmatched="Not Defined").collect()}
    assert got == {"c1": (3, 1), "c2": (3, 2)}
    plain = {r.column: r.matched_rows for r in match_stats(df, "c1").collect()}
    assert plain == {"c1": 2}


def test_latest_only_ties_and_nulls_are_deterministic(spark):
    df = spark.createDataFrame(
        [("e1", "A", D(2024, 1, 2)), ("e1", "C", D(2024, 1, 2)), ("e1", "Z", None), ("e2", "Q", None)],
        "id string, name string, d date",
    )
    got = {r.id: (r.name, r.latest_snap_date) for r in latest_snapshot(df, ["id", "name"], "d", latest_only=True).collect()}
    assert got == {"e1": ("C", D(2024, 1, 2)), "e2": (None, None)}


def test_expand_days_text_bounds(spark):
    df = spark.createDataFrame([(1, "2024-01-01", "2024-01-02"), (2, "2024-13-45", "2024-01-02")], "id int, s string, e string")
    assert _counts(expand_days(df, "s", "e")) == {1: 2}


def test_latest_only_returns_a_row_that_exists(spark):
    rows = [(1, "Ann", "HR", 5), (1, "Bob", "AA", 5), (1, "Zoe", "ZZ", 4), (2, None, "x", None)]
    df = spark.createDataFrame(rows, "id int, name string, unit string, d int")
    got = {tuple(r) for r in latest_snapshot(df, ["id", "name", "unit"], "d", latest_only=True).collect()}
    assert got == {(1, "Bob", "AA", 5), (2, None, None, None)}
