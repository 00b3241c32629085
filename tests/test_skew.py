"""A key holding a third of the rows is split over several tasks (AQE skew
join) in the sort-merge plans of ``enrich`` and ``merge``; thresholds are
lowered so that the local data counts as skewed."""

import pytest
from pyspark.sql import functions as F

from joinery import enrich, merge

SKEW_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.shuffle.partitions": "16",
}


@pytest.fixture()
def skew_conf(spark):
    old = {k: spark.conf.get(k, None) for k in SKEW_CONF}
    for k, v in SKEW_CONF.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def _hot_primary(spark, n=30000):
    # one key in three rows is "HOT"; the rest spread over 500 keys
    return spark.range(n).select(
        F.col("id"),
        F.when(F.col("id") % 3 == 0, F.lit("HOT")).otherwise((F.col("id") % 500).cast("string")).alias("k"),
        F.sha2(F.col("id").cast("string"), 256).alias("payload"),
    )


def _final(df) -> str:
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_enrich_hot_key_is_split(spark, skew_conf):
    prim = _hot_primary(spark)
    look = spark.range(500).select(F.col("id").cast("string").alias("k"), F.lit("L").alias("v"))
    look = look.union(spark.createDataFrame([("HOT", "H")], "k string, v string"))
    out = enrich(prim, look, "k", ["v"], strategy="shuffle")
    plan = _final(out)
    assert "SortMergeJoin" in plan
    assert "skew=true" in plan, plan[:3000]
    assert out.filter(F.col("v") == "H").count() == 10000
    assert out.count() == 30000


def _one_per_key(spark, col):
    keys = spark.range(500).select(F.col("id").cast("string").alias("k"))
    keys = keys.union(spark.createDataFrame([("HOT",)], "k string"))
    return keys.select("k", F.lit("x").alias(col))


@pytest.mark.parametrize("hot_side", ["a", "b"])
def test_split_merge_hot_key_is_split(spark, skew_conf, hot_side):
    hot = _hot_primary(spark).select("k", F.col("payload").alias(f"p{hot_side}"))
    other = _one_per_key(spark, "pb" if hot_side == "a" else "pa")
    a, b = (hot, other) if hot_side == "a" else (other, hot)
    out = merge(a, b, on=["k"])
    plan = _final(out)
    assert "skew=true" in plan, plan[:3000]
    assert out.count() == 30000
    plain = merge(a, b, on=["k"], skew_split=False)
    assert "skew=true" not in _final(plain)
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, plain.collect()))


def test_enrich_null_key_rows_are_split(spark, skew_conf):
    """Rows switched off by a flag (or with a NULL key) never match; a third
    of them meet in one hash partition, which AQE splits like a hot key."""
    prim = _hot_primary(spark).withColumn("on", F.col("k") != "HOT")
    look = spark.range(500).select(F.col("id").cast("string").alias("k"), F.lit("L").alias("v"))
    out = enrich(prim, look, "k", ["v"], strategy="shuffle", only_where=F.col("on"))
    plan = _final(out)
    assert "skew=true" in plan, plan[:3000]
    assert out.filter(F.col("v") == "Not Defined").count() == 10000
    assert out.count() == 30000
