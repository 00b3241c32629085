"""Properties on generated rows (Hypothesis). Each example is one batch of rows
run through Spark, so examples are few and batches large."""

import datetime as dt

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from joinery import enrich, expand_days, json_put, merge, normalise

SETTINGS = settings(max_examples=4, deadline=None)

texts = st.lists(st.one_of(st.none(), st.text(max_size=12)), min_size=50, max_size=200)


@SETTINGS
@given(texts)
def test_normalise_idempotent(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v string").select(normalise("v").alias("n"))
    assert df.filter(normalise("n") != F.col("n")).count() == 0
    assert df.filter(F.col("n").isNull()).count() == 0


json_values = st.one_of(
    st.none(),
    st.dictionaries(st.text(alphabet="abcf", min_size=1, max_size=3), st.text(alphabet="xyz19 ", max_size=4), max_size=4)
    .map(lambda d: "{" + ",".join(f'"{k}": "{v}"' for k, v in d.items()) + "}"),
    st.text(max_size=6),
)


@SETTINGS
@given(st.lists(json_values, min_size=50, max_size=150))
def test_json_put_twice_is_once(spark, payloads):
    df = spark.createDataFrame([(i, p) for i, p in enumerate(payloads)], "id int, j string")
    once = json_put(df, "j", "f", F.lit("v"))
    twice = json_put(once, "j", "f", F.lit("v"))
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect()))


spans = st.lists(
    st.tuples(st.integers(0, 400), st.integers(-5, 30)),
    min_size=20, max_size=100,
)


@SETTINGS
@given(spans)
def test_expand_days_row_count(spark, rows):
    base = dt.date(2024, 1, 1)
    data = [(i, base + dt.timedelta(days=s), base + dt.timedelta(days=s + n)) for i, (s, n) in enumerate(rows)]
    df = spark.createDataFrame(data, "id int, s date, e date")
    assert expand_days(df, "s", "e").count() == sum(abs(n) + 1 for _, n in rows)
    assert expand_days(df, "s", "e", on_reversed="drop").count() == sum(n + 1 for _, n in rows if n >= 0)


keyed_rows = st.lists(st.one_of(st.none(), st.sampled_from(["a", "b", "c", "hot", "hot", "hot"])), min_size=30, max_size=150)


@SETTINGS
@given(keyed_rows)
def test_enrich_and_null_safe_merge_keep_row_count(spark, keys):
    prim = spark.createDataFrame(list(enumerate(keys)), "id int, k string")
    look = spark.createDataFrame([("a", "A"), ("hot", "H"), ("zzz", "Z")], "k string, v string")
    a = enrich(prim, look, "k", {"va": "v"})
    b = enrich(prim, look, "k", {"vb": "v"})
    n = len(keys)
    assert a.count() == n
    assert merge(a, b, null_safe=True).count() == n
    # the faithful merge repeats rows with a NULL key once per side
    assert merge(a, b).count() == n + sum(k is None for k in keys)
    assert sorted(map(tuple, merge(a, b).collect()), key=str) == sorted(
        map(tuple, merge(a, b, skew_split=False).collect()), key=str
    )
