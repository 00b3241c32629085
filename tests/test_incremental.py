"""Sketches that merge, snapshots kept up to date and long spans in pieces."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from joinery import SnapshotState, advise_broadcast, expand_days, join_profile, key_sketches, latest_snapshot, union_profile, write_sketches
from joinery.operators.sketches import error_bound


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.mark.parametrize("key", ["k", "t", "d", ["k", "t"]])
def test_union_of_parts_is_the_profile_of_all(spark, tmp_dir, key):
    df = spark.range(60_000).select((F.col("id") % 7).alias("day"), F.when(F.col("id") % 11 != 0, F.hash("id") % 20_000).alias("k"),
                                    F.concat(F.lit("t"), F.col("id") % 9000).alias("t"), F.date_add(F.lit("2020-01-01").cast("date"), (F.col("id") % 5000).cast("int")).alias("d"))
    exact = join_profile(df, key, exact=True).first()
    path = f"{tmp_dir}/s"
    write_sketches(key_sketches(df.filter("day < 4"), key, ["day"]), path, ["day"])
    write_sketches(key_sketches(df.filter("day >= 3"), key, ["day"]), path, ["day"])  # day 3 again: replaced
    got = union_profile(spark.read.parquet(path)).first()
    assert got.asDict().keys() == exact.asDict().keys()
    assert (got.rows, got.null_keys, got.data_bytes, got.est_bytes, got.row_width) == (exact.rows, exact.null_keys, exact.data_bytes, exact.est_bytes, exact.row_width)
    assert abs(got["keys"] - exact["keys"]) <= error_bound() * exact["keys"]
    assert advise_broadcast(got, got, threshold=1 << 40, max_keys=None) == "right"
    assert union_profile(spark.read.parquet(path), ["day"]).count() == 7


def test_sketches_of_nothing(spark):
    df = spark.createDataFrame([], "day int, k string")
    got = union_profile(key_sketches(df, "k", ["day"])).first()
    assert (got.rows, got["keys"], got.null_keys, got.data_bytes) == (0, 0, 0, 0)
    nulls = spark.createDataFrame([(None, None), (None, None)], "day int, k string")
    got = union_profile(key_sketches(nulls, "k", ["day"])).first()
    assert (got.rows, got["keys"], got.null_keys) == (2, 0, 2)
    with pytest.raises(ValueError):
        key_sketches(df, "k", [])


def snapshot_rows(rng, n=300):
    day = lambda: None if rng.random() < 0.05 else dt.date(2024, 1, 1) + dt.timedelta(days=rng.randrange(30))
    return [(rng.choice([None, *range(12)]), rng.choice([None, "a", "b", "c"]), day()) for _ in range(n)]


@pytest.mark.parametrize("latest_only", [False, True])
def test_any_split_gives_the_same_state(spark, tmp_dir, latest_only):
    rng = random.Random(int(latest_only))
    rows = snapshot_rows(rng)
    ddl = "id int, name string, day date"
    want = rows_of(latest_snapshot(spark.createDataFrame(rows, ddl), ["id", "name"], "day", latest_only=latest_only))
    for k in range(3):
        state = SnapshotState(spark, f"{tmp_dir}/{k}", ["id", "name"], "day", latest_only=latest_only)
        with pytest.raises(FileNotFoundError):
            state.read()
        order = rng.sample(rows, len(rows))
        cuts = sorted(rng.sample(range(1, len(rows)), 3))
        parts = [order[a:b] for a, b in zip([0, *cuts], [*cuts, len(rows)])]
        for n, part in enumerate([*parts, parts[0], []]):
            count = state.update(spark.createDataFrame(part, ddl), f"b{n}")
        assert rows_of(state.read()) == want and count == len(want)


def test_replayed_and_failed_batches(spark, tmp_dir):
    state = SnapshotState(spark, tmp_dir, ["id"], "day")
    one = spark.createDataFrame([(1, dt.date(2024, 1, 1))], "id int, day date")
    state.update(one, "a")
    broken = one.withColumn("day", F.raise_error(F.lit("lost")).cast("date"))
    with pytest.raises(Exception, match="lost"):
        state.update(broken, "b")
    assert rows_of(state.read()) == [(1, dt.date(2024, 1, 1))]
    assert state.update(broken, "a") == 1  # merged before: not looked at
    state.update(spark.createDataFrame([(1, dt.date(2023, 1, 1)), (2, None)], "id int, day date"), "b")
    assert rows_of(state.read()) == [(1, dt.date(2024, 1, 1)), (2, None)]


def test_stream_of_files(spark, tmp_dir):
    df = spark.range(400).select((F.col("id") % 13).alias("id"), F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 50).cast("int")).alias("day"))
    df.repartition(6).write.parquet(f"{tmp_dir}/in")
    state = SnapshotState(spark, f"{tmp_dir}/state", ["id"], "day")
    for _ in range(2):  # started again: nothing new
        stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 2).parquet(f"{tmp_dir}/in")
        state.follow(stream, f"{tmp_dir}/ckpt").awaitTermination()
        assert rows_of(state.read()) == rows_of(latest_snapshot(df, ["id"], "day"))
    df.withColumn("day", F.date_add("day", 100)).write.mode("append").parquet(f"{tmp_dir}/in")
    state.follow(stream, f"{tmp_dir}/ckpt").awaitTermination()
    assert rows_of(state.read()) == rows_of(latest_snapshot(df.withColumn("day", F.date_add("day", 100)), ["id"], "day"))


SPANS = [(1, "2024-01-01", "2024-01-10"), (2, "2024-01-10", "2024-01-01"), (3, "2024-01-05", "2024-01-05"), (4, None, "2024-01-05"),
         (5, "2024-01-05", None), (6, "bad", "2024-01-05"), (7, "2023-12-30", "2024-01-02"), (8, "2024-01-02", "2023-12-30")]


@pytest.mark.parametrize("chunk", [1, 3, 4, 100])
@pytest.mark.parametrize("more", [{}, {"on_reversed": "drop"}, {"keep_null": True}, {"on_reversed": "drop", "keep_null": True}])
def test_pieces_give_the_same_days(spark, chunk, more):
    df = spark.createDataFrame(SPANS, "id int, a string, b string")
    assert rows_of(expand_days(df, "a", "b", chunk_days=chunk, partitions=3, **more)) == rows_of(expand_days(df, "a", "b", **more))


def test_a_long_span_is_dealt_out(spark):
    """One span with a third of all days: no task makes much more than its share."""
    day = dt.date(1900, 1, 1)
    rows = [(0, day, day + dt.timedelta(days=29_999))] + [(i, day, day + dt.timedelta(days=5)) for i in range(1, 10_001)]
    df = spark.createDataFrame(rows, "id int, a date, b date")
    out = expand_days(df, "a", "b", chunk_days=100, partitions=8)
    sizes = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 90_000 and len(sizes) == 8 and max(sizes) < 1.5 * 90_000 / 8
    with pytest.raises(ValueError):
        expand_days(df, "a", "b", chunk_days=0)
