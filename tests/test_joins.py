import pytest
from pyspark.sql import functions as F

from joinery import common_columns, enrich, enrich_hierarchy, enrich_sql, inner_sql, merge
from joinery.operators import joins as op_joins


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture()
def primary(spark):
    return spark.createDataFrame([(1, "Key1"), (2, "Key9"), (3, None)], "id int, JoinKey string")


@pytest.fixture()
def activity(spark):
    return spark.createDataFrame([("Key1", "C1", None)], "JoinKey string, New_Center string, Capacity_Planning_Group string")


TAKE = {"Center": "New_Center", "Capacity_Planning_Group": "Capacity_Planning_Group"}


def test_enrich_defaults(primary, activity):
    out = enrich(primary, activity, "JoinKey", TAKE).orderBy("id")
    assert out.columns == ["id", "JoinKey", "Center", "Capacity_Planning_Group"]
    assert [tuple(r) for r in out.collect()] == [
        (1, "Key1", "C1", "Not Defined"),
        (2, "Key9", "Not Defined", "Not Defined"),
        (3, None, "Not Defined", "Not Defined"),
    ]


def test_enrich_sql_matches_dataframe_form(spark, primary, activity):
    a = enrich(primary, activity, "JoinKey", TAKE)
    b = enrich_sql(spark, primary, activity, "JoinKey", TAKE)
    assert a.columns == b.columns
    assert sorted(a.collect(), key=str) == sorted(b.collect(), key=str)


def test_enrich_rejects_clash(primary, activity):
    with pytest.raises(ValueError, match="already exist"):
        enrich(primary, activity, "JoinKey", {"id": "New_Center"})


def test_enrich_duplicates_multiply_or_fail(spark, primary):
    dup = spark.createDataFrame([("Key1", "A"), ("Key1", "B")], "JoinKey string, c string")
    assert enrich(primary, dup, "JoinKey", ["c"]).count() == 4
    with pytest.raises(Exception, match="not unique"):
        enrich(primary, dup, "JoinKey", ["c"], unique=True).collect()
    uniq = spark.createDataFrame([("Key1", "A"), ("Key9", "B")], "JoinKey string, c string")
    assert enrich(primary, uniq, "JoinKey", ["c"], unique=True).count() == 3


def test_enrich_keeps_row_count_with_unique_lookup(spark):
    prim = spark.range(5000).select(F.col("id"), (F.col("id") % 37).cast("string").alias("k"))
    look = spark.range(20).select(F.col("id").cast("string").alias("k"), F.lit("x").alias("v"))
    assert enrich(prim, look, "k", ["v"]).count() == 5000


def test_enrich_strategies_plan(primary, activity):
    b = enrich(primary, activity, "JoinKey", TAKE, strategy="broadcast")
    assert "BroadcastHashJoin" in _plan(b)
    s = enrich(primary, activity, "JoinKey", TAKE, strategy="shuffle")
    assert "SortMergeJoin" in _plan(s)
    assert sorted(b.collect(), key=str) == sorted(s.collect(), key=str)


def test_enrich_auto_does_not_hint_many_keys(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        prim = spark.range(100).select(F.col("id").cast("string").alias("k"))
        big = spark.range(6000).select(F.col("id").cast("string").alias("k"), F.lit("v").alias("v"))
        out = enrich(prim, big, "k", ["v"], strategy="auto")  # 6000 keys >= 5000: no hint
        assert "BroadcastHashJoin" not in _plan(out)
        assert out.filter(F.col("v") == "v").count() == 100
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_enrich_only_where(spark, activity):
    prim = spark.createDataFrame([(1, "Key1", True), (2, "Key1", False)], "id int, JoinKey string, on boolean")
    out = enrich(prim, activity, "JoinKey", TAKE, only_where=F.col("on")).orderBy("id").collect()
    assert out[0].Center == "C1" and out[1].Center == "Not Defined"


def test_enrich_hierarchy_try_cast(spark):
    prim = spark.createDataFrame(
        [(1, '{"employee_number": "31"}'), (2, '{"employee_number": "x31"}'), (3, None)],
        "id int, details string",
    )
    snap = spark.createDataFrame([(31, "R. Ames")], "employeeid bigint, employeename string")
    out = enrich_hierarchy(prim, snap, "details").orderBy("id")
    assert out.columns == ["id", "details", "employee_number", "employeeid", "employeename"]
    assert [r.employeename for r in out.collect()] == ["R. Ames", None, None]


def test_enrich_hierarchy_string_key(spark):
    prim = spark.createDataFrame([(1, '{"e": 5}')], "id int, j string")
    snap = spark.createDataFrame([("5", "n")], "employeeid string, employeename string")
    assert enrich_hierarchy(prim, snap, "j", field="e").collect()[0].employeename == "n"


def test_inner_sql(spark):
    t1 = spark.createDataFrame([(1, "a"), (2, "b")], "key_column int, column1 string")
    t2 = spark.createDataFrame([(1, "x"), (3, "y")], "key_column int, column2 string")
    out = inner_sql(spark, t1, t2, "key_column", ["column1"], ["column2"])
    assert out.columns == ["column1", "column2", "key_column"]
    assert [tuple(r) for r in out.collect()] == [("a", "x", 1)]


def test_common_columns(spark):
    a = spark.createDataFrame([(1, "a")], "col1 int, col2 string")
    b = spark.createDataFrame([(1, "b")], "col3 int, col2 string")
    assert common_columns(a, b) == ["col2"]


def test_merge_faithful_and_null_safe(spark):
    a = spark.createDataFrame([(1, "x", "A"), (2, None, "B")], "k int, s string, av string")
    b = spark.createDataFrame([(1, "x", "E"), (2, None, "F")], "k int, s string, bv string")
    faithful = merge(a, b)
    assert faithful.columns == ["k", "s", "av", "bv"]
    assert sorted(map(tuple, faithful.collect()), key=str) == sorted(
        [(1, "x", "A", "E"), (2, None, "B", None), (2, None, None, "F")], key=str
    )
    safe = merge(a, b, null_safe=True)
    assert safe.columns == ["k", "s", "av", "bv"]
    assert sorted(map(tuple, safe.collect()), key=str) == sorted([(1, "x", "A", "E"), (2, None, "B", "F")], key=str)


def test_merge_without_common_columns_raises(spark):
    a = spark.createDataFrame([(1,)], "a int")
    b = spark.createDataFrame([(1,)], "b int")
    with pytest.raises(ValueError, match="no common columns"):
        merge(a, b)


def test_null_safe_merge_of_two_enrichments_keeps_count(spark):
    prim = spark.range(3000).select(
        "id", F.when(F.col("id") % 3 == 0, None).otherwise((F.col("id") % 11).cast("string")).alias("k")
    )
    look = spark.range(11).select(F.col("id").cast("string").alias("k"), F.lit("L").alias("v"))
    a = enrich(prim, look, "k", {"va": "v"})
    b = enrich(prim, look, "k", {"vb": "v"})
    assert merge(a, b, null_safe=True).count() == 3000
    # a NULL in a shared column never matches: those 1000 rows come out once per side
    assert merge(a, b).count() == 4000


@pytest.mark.parametrize("null_safe", [False, True])
def test_split_merge_equals_full_outer(spark, null_safe):
    """Hot key (a third of the rows), NULL keys and duplicates on both sides."""
    import random

    random.seed(21 + null_safe)

    def rows(n, tag):
        out = []
        for i in range(n):
            r = random.random()
            k = "hot" if r < 0.33 else (None if r < 0.45 else f"k{random.randint(0, 40)}")
            k2 = None if random.random() < 0.1 else random.randint(0, 3)
            out.append((k, k2, f"{tag}{i % 7}"))
        return out

    a = spark.createDataFrame(rows(300, "a"), "k string, k2 int, va string")
    b = spark.createDataFrame(rows(200, "b"), "k string, k2 int, vb string")
    plain = merge(a, b, null_safe=null_safe, skew_split=False)
    split = merge(a, b, null_safe=null_safe, skew_split=True)
    assert split.columns == plain.columns
    assert sorted(map(tuple, split.collect()), key=str) == sorted(map(tuple, plain.collect()), key=str)


def test_merge_with_map_column_and_complex_key(spark):
    a = spark.createDataFrame([(1, None, {"x": "1"}), (2, "k", {"y": "2"})], "id int, k string, m map<string,string>")
    b = spark.createDataFrame([(1, None, "B1"), (2, "k", "B2")], "id int, k string, v string")
    out = merge(a, b, on=["id", "k"])
    assert out.count() == 3  # NULL k comes out once per side
    arr_a = spark.createDataFrame([([1, 2], "a")], "k array<int>, va string")
    arr_b = spark.createDataFrame([([1, 2], "b")], "k array<int>, vb string")
    assert merge(arr_a, arr_b).collect()[0].vb == "b"


def test_reserved_column_names_are_rejected(spark, activity):
    prim = spark.createDataFrame([(1, "Key1")], "__jk int, JoinKey string")
    with pytest.raises(ValueError, match="reserved"):
        enrich(prim, activity, "JoinKey", TAKE)
    a = spark.createDataFrame([(1, 2)], "k int, __mt int")
    with pytest.raises(ValueError, match="reserved"):
        merge(a, a.withColumnRenamed("__mt", "x"))


@pytest.mark.parametrize("null_safe", [False, True])
def test_merge_unique_guard(spark, null_safe):
    a = spark.createDataFrame([(1, "x", "A"), (2, None, "B"), (2, None, "B2")], "k int, s string, av string")
    b = spark.createDataFrame([(1, "x", "E"), (3, "y", "F")], "k int, s string, bv string")
    if null_safe:
        # (2, NULL) repeats and can match under <=>: the job fails
        with pytest.raises(Exception, match="repeats on side a"):
            merge(a, b, null_safe=True, unique=True).collect()
    else:
        # NULL keys never match, so their repeats are allowed
        assert merge(a, b, unique=True).count() == 4
    dup = b.union(b.limit(1))
    with pytest.raises(Exception, match="repeats on side b"):
        merge(a.limit(1), dup, null_safe=null_safe, unique=True).collect()


def test_enrich_hierarchy_unique(spark):
    prim = spark.createDataFrame([(1, '{"employee_number": "5"}')], "id int, j string")
    snap = spark.createDataFrame([(5, "a"), (5, "b"), (6, "c")], "employeeid bigint, employeename string")
    assert enrich_hierarchy(prim, snap, "j").count() == 2
    with pytest.raises(Exception, match="not unique"):
        enrich_hierarchy(prim, snap, "j", unique=True).collect()
    ok = enrich_hierarchy(prim, snap.filter("employeename <> 'b'"), "j", unique=True)
    assert ok.columns == ["id", "j", "employee_number", "employeeid", "employeename"]
    assert ok.collect()[0].employeename == "a"


def test_merge_keys_of_different_types(spark):
    a = spark.createDataFrame([(1, "A"), (2, "B")], "k int, va string")
    b = spark.createDataFrame([(1.0, "E"), (3.5, "F")], "k double, vb string")
    out = sorted(map(tuple, merge(a, b).collect()), key=str)
    assert out == sorted([(1.0, "A", "E"), (2.0, "B", None), (3.5, None, "F")], key=str)
    assert sorted(map(tuple, merge(a, b, unique=True).collect()), key=str) == out
    with pytest.raises(ValueError, match="comparable"):
        merge(a, b.withColumn("k", F.lit("1")), unique=True)


def test_enrich_sql_strategies(spark, primary, activity):
    s = enrich_sql(spark, primary, activity, "JoinKey", TAKE, strategy="shuffle")
    assert "SortMergeJoin" in _plan(s)
    b = enrich_sql(spark, primary, activity, "JoinKey", TAKE, strategy="auto")
    assert "BroadcastHashJoin" in _plan(b)
    assert sorted(s.collect(), key=str) == sorted(b.collect(), key=str)


@pytest.mark.parametrize("n", [65, 130])
def test_null_safe_merge_on_many_keys(spark, n):
    """One row for each NULL position around a word's 63rd bit, an all-NULL row and a full one."""
    keys = [f"c{i}" for i in range(n)]
    rows = [[None if i == gap else 0 for i in range(n)] for gap in (61, 62, 63, 64)] + [[None] * n, [0] * n]
    ddl = ", ".join(f"{k} int" for k in keys)
    a = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], ddl + ", left_no int")
    b = spark.createDataFrame([(*r, i) for i, r in list(enumerate(rows))[1:]], ddl + ", right_no int")
    split, plain = (sorted(map(str, merge(a, b, null_safe=True, skew_split=s).collect())) for s in (True, False))
    assert split == plain and len(split) == len(rows)


def test_unique_ignores_keys_that_never_match(spark):
    prim = spark.createDataFrame([(1, "{}"), (None, None)], "k int, j string")
    look = spark.createDataFrame([(1, "a"), (None, "b"), (None, "c")], "k2 int, v string")
    assert enrich(prim, look, ("k", "k2"), ["v"], unique=True).count() == 2
    snap = look.withColumnRenamed("k2", "employeeid")
    assert enrich_hierarchy(prim, snap, "j", unique=True).count() == 2


def test_sql_twins_take_any_key_types(spark):
    prim = spark.createDataFrame([("1", 1), ("abc", 2), (None, 3)], "k string, id int")
    look = spark.createDataFrame([(1, 10), (2, 20)], "k2 int, v int")
    want = sorted(map(str, enrich(prim, look, ("k", "k2"), ["v"]).collect()))
    assert sorted(map(str, enrich_sql(spark, prim, look, ("k", "k2"), ["v"]).collect())) == want
    assert [tuple(r) for r in inner_sql(spark, prim, look, ("k", "k2"), ["id"], ["v"]).collect()] == [(1, 10, "1")]
    with pytest.raises(ValueError):
        inner_sql(spark, prim, look, ("k", "k2"), ["k"], ["v"])


def test_merge_of_mixed_and_null_types(spark):
    a = spark.createDataFrame([(1, "x"), (2, "y"), (None, "z")], "k int, v string")
    b = spark.createDataFrame([(2.0, "p"), (2.5, "q")], "k double, w string")
    for safe in (False, True):
        split, plain = (sorted(map(str, merge(a, b, null_safe=safe, skew_split=s).collect())) for s in (True, False))
        assert split == plain
    void = a.select(F.lit(None).alias("k"), "v")
    assert merge(void, void.withColumnRenamed("v", "w"), null_safe=True).count() == 9
    with pytest.raises(ValueError):
        merge(a, a, on=["k"], unique=True)


@pytest.mark.parametrize("null_safe", [False, True])
def test_merge_of_sides_with_the_same_keys(spark, null_safe):
    rows = [(1, 0.0, "a", [1]), (1, -0.0, "a", [1]), (2, float("nan"), None, None), (2, float("nan"), "b", [2]),
            (None, 1.5, "c", [3]), (None, None, None, None), (None, None, None, None), (4, 2.5, "", [])] + [(9, 1.0, "hot", [9])] * 5
    frame = spark.createDataFrame(rows, "i int, f double, t string, l array<int>").repartition(3)
    a, b = frame.withColumn("x", F.hash("i", "t")), frame.withColumn("y", F.length("t"))
    for drop in ([], ["l"]):  # with a nested key, and without
        one, two = a.drop(*drop), b.drop(*drop)
        want = merge(one, two, null_safe=null_safe, skew_split=False)
        got = merge(one, two, null_safe=null_safe, same_keys=True)
        assert got.columns == want.columns
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
        assert "LeftAnti" not in _plan(got)
    assert merge(a.filter("false"), b.filter("false"), null_safe=null_safe, same_keys=True).count() == 0


def test_merge_on_many_keys_shuffles_a_digest(spark):
    """The other columns of wide keys stay out of the shuffles, whatever is read of them."""
    import datetime as dt
    import decimal

    texts = ["", ",", "N", "N,", "1:a", "a", None, "1"]
    kinds = [("string", texts), ("long", [0, -1, 12, None]), ("double", [0.0, -0.0, float("nan"), 1.5, None]), ("binary", [b"", b"\x00", b"N", None]),
             ("boolean", [True, False, None]), ("date", [dt.date(2024, 2, 29), None]), ("timestamp", [dt.datetime(2024, 10, 27, 1, 30), None]),
             ("decimal(9,2)", [decimal.Decimal("1.10"), None])]
    width = op_joins.DIGEST_KEYS + 1
    kinds = (kinds * 3)[:width]
    rows = []
    for n in range(width):
        for value in kinds[n][1]:
            rows.append([value if i == n else k[1][0] for i, k in enumerate(kinds)])
    for x in texts:
        for y in texts:
            rows.append([x] + [k[1][0] for k in kinds[1:8]] + [y] + [k[1][0] for k in kinds[9:]])
    ddl = ", ".join(f"k{i} {k}" for i, (k, _) in enumerate(kinds))
    a = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], ddl + ", x long")
    b = spark.createDataFrame([(*r, i) for i, r in enumerate(rows) if i % 3] + [(*([None] * width), -1)], ddl + ", y long")
    for null_safe in (True, False):
        split, plain = (merge(a, b, null_safe=null_safe, skew_split=s) for s in (True, False))
        key = lambda df: sorted((r.x is None, r.x or 0, r.y is None, r.y or 0, str(r.k0), str(r.k8)) for r in df.select("x", "y", "k0", "k8").collect())
        assert key(split) == key(plain)
        plan = split.select("k1", "x", "y")._jdf.queryExecution().executedPlan().toString()
        dealt = [line for line in plan.split("\n") if "hashpartitioning(" in line]
        assert dealt and all("hashpartitioning(__md" in line for line in dealt)


def _longest_method(df):
    """Bytes of the longest method in the plan's fused code; the JVM never compiles one of over 8000."""
    code = df._jdf.queryExecution().debug().codegenToSeq()
    return max(code.apply(i)._3().maxMethodCodeSize() for i in range(code.size()))


@pytest.mark.parametrize("null_safe", [True, False])
def test_merge_on_many_keys_is_compiled(spark, null_safe):
    """The digest of wide keys is not fused into one method that the JVM only interprets."""
    old = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # the plan as it runs, not one that still has to be made
    try:
        keys = [F.when(F.col("id") % 7 != i % 8, F.col("id") % (i + 2)).alias(f"k{i}") for i in range(40)]
        texts = [F.when(F.col("id") % 5 != i % 6, F.concat(F.lit("t"), F.col("id") % (i + 2))).alias(f"t{i}") for i in range(20)]
        frame = spark.range(60).repartition(2).select("id", *keys, *texts)
        a, b = frame.withColumnRenamed("id", "x").distinct(), frame.filter("id % 3 <> 0").withColumnRenamed("id", "y").distinct()
        # the frame itself is as long as it is: only what the merge adds is measured
        own = _longest_method(a.select("x", "k1").union(b.select("y", "k1")))
        out = merge(a, b, null_safe=null_safe).select("k1", "x", "y")
        assert _longest_method(out) <= max(own, 8000)
        assert "LeftAnti" not in _plan(out)
        plain = merge(a, b, null_safe=null_safe, skew_split=False).select("k1", "x", "y")
        assert sorted(map(str, out.collect())) == sorted(map(str, plain.collect()))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", old)


def test_merge_wide_is_compiled(spark):
    from conftest import SF001

    from joinery.plans.catalog import QUERIES

    old = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        assert _longest_method(QUERIES["merge_wide"](spark, SF001)) <= 8000
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", old)


def test_digests_differ_where_keys_do(spark):
    """Lengths, NULLs and marks of neighbouring keys cannot make up for each other."""
    import itertools

    texts = ["", "a", "ab", "b", "]", "1]", ",1", None]
    rows = list(itertools.product(texts, [b"", b"a", b"]", None], [0, 1, 11, -1, None], [1.5, -1.5, None]))
    width = op_joins.DIGEST_KEYS - 3
    frame = spark.createDataFrame(rows, "t string, b binary, n int, f float")
    frame = frame.select("*", *[F.lit(None).cast("long").alias(f"k{i}") for i in range(width)])
    assert len(frame.columns) == op_joins.DIGEST_KEYS + 1
    digests = frame.select(op_joins._digest(frame, frame.columns).alias("md")).collect()
    assert len({bytes(r.md) for r in digests}) == len(rows) and {len(r.md) for r in digests} == {16}
