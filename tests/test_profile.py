import pytest
from pyspark.sql import functions as F

from joinery import advise_broadcast, checked_broadcast, join_profile, profiles_frame, row_width, with_profile

MB = 1024 * 1024


def _p(size, keys):
    return {"est_bytes": size, "data_bytes": 0, "keys": keys}


def test_advise_broadcast_rule():
    assert advise_broadcast(_p(1 * MB, 10), _p(2 * MB, 10)) == "left"
    assert advise_broadcast(_p(1 * MB, 10), _p(1 * MB, 10)) == "right"
    assert advise_broadcast(_p(1 * MB, 6000), _p(20 * MB, 10)) is None
    assert advise_broadcast(_p(20 * MB, 10), _p(1 * MB, 10)) == "right"
    assert advise_broadcast(_p(1 * MB, 10), _p(2 * MB, 10), threshold=-1) is None


def test_row_width(spark):
    df = spark.createDataFrame([], "a bigint, b int, c string, d boolean, e date, f double, g timestamp")
    assert row_width(df.schema) == 8 + 4 + 20 + 1 + 4 + 8 + 8


def test_join_profile_exact_and_approx(spark):
    df = spark.createDataFrame([(1,), (1,), (1,), (2,), (None,), (None,)], "k int")
    ex = join_profile(df, "k", exact=True).collect()[0]
    assert (ex.rows, ex.keys, ex.null_keys, ex.max_key_rows) == (6, 2, 2, 3)
    assert ex.row_width == 4 and ex.est_bytes == 24
    ap = join_profile(df, "k").collect()[0]
    assert (ap.rows, ap.keys, ap.null_keys, ap.max_key_rows) == (6, 2, 2, None)
    hashed = join_profile(df, "k", hash_keys=True).collect()[0]
    assert hashed.keys == 2
    multi = join_profile(spark.createDataFrame([(1, "a"), (1, None), (1, "a")], "x int, y string"), ["x", "y"], exact=True).collect()[0]
    assert (multi.keys, multi.null_keys, multi.max_key_rows) == (1, 1, 2)


def test_join_profile_empty(spark):
    ex = join_profile(spark.createDataFrame([], "k int"), "k", exact=True).collect()[0]
    assert (ex.rows, ex.keys, ex.null_keys, ex.est_bytes) == (0, 0, 0, 0)


def test_checked_broadcast_uses_one_job(spark):
    df = spark.range(100).select(F.col("id").alias("k"))
    sc = spark.sparkContext
    tracker = sc.statusTracker()
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        sc.setJobGroup("advice", "advice")
        out, prof = checked_broadcast(df, key=F.col("k"), threshold=10 * MB, max_keys=5000)
        jobs = tracker.getJobIdsForGroup("advice")
        sc.setJobGroup("other", "other")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(jobs) == 1
    assert prof["rows"] == 100
    assert out is not df  # small: hinted
    kept, prof2 = checked_broadcast(df, key=F.col("k"), threshold=10, max_keys=None)
    assert prof2["rows"] == 100
    assert kept is df  # over the threshold: returned unhinted


PROFILES = {
    "default": {"include_activity": True, "include_hierarchy": True},
    "sourceA": {"include_activity": True, "include_hierarchy": False},
    "sourceB": {"include_activity": False, "include_hierarchy": True},
}


def test_with_profile(spark):
    df = spark.createDataFrame([("sourceA",), ("sourceB",), ("other",), (None,)], "data_source string")
    out = with_profile(df, profiles_frame(spark, PROFILES), "data_source").collect()
    got = {r.data_source: (r.include_activity, r.include_hierarchy) for r in out}
    assert got == {"sourceA": (True, False), "sourceB": (False, True), "other": (True, True), None: (True, True)}


def test_with_profile_whole_default_no_merge(spark):
    profs = {"default": {"a": "d", "b": "d"}, "x": {"a": "x", "b": None}}
    df = spark.createDataFrame([("x",)], "s string")
    row = with_profile(df, profiles_frame(spark, profs), "s").collect()[0]
    assert (row.a, row.b) == ("x", None)


def test_with_profile_needs_default(spark):
    df = spark.createDataFrame([("x",)], "s string")
    with pytest.raises(ValueError, match="default"):
        with_profile(df, profiles_frame(spark, {"x": {"a": 1}}), "s")


def test_with_profile_rejects_duplicate_sources(spark):
    df = spark.createDataFrame([("x",)], "s string")
    profs = spark.createDataFrame([("default", 1), ("x", 2), ("x", 3)], "source string, a bigint")
    with pytest.raises(ValueError, match="more than once"):
        with_profile(df, profs, "s")


def test_advise_join_two_jobs(spark):
    from joinery import advise_join

    big = spark.range(20000).select((F.col("id") % 7000).alias("k"), F.col("id").alias("v"))
    small = spark.range(50).select(F.col("id").alias("k"), F.lit("x").alias("lbl"))
    sc = spark.sparkContext
    tracker = sc.statusTracker()
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        sc.setJobGroup("advise", "advise")
        advice, pl, pr = advise_join(big, small, "k", "k", threshold=10 * MB)
        jobs = tracker.getJobIdsForGroup("advise")
        sc.setJobGroup("other", "other")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert advice == "right"  # the big side has about 7000 keys, over the 5000 limit
    assert pl["rows"] == 20000 and pr["rows"] == 50
    assert len(jobs) == 2
