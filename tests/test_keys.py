import random

from pyspark.sql import functions as F

from joinery import normalise, with_join_key, work_item_key
from joinery.plans.domain import WORK_ITEM_PARTS


def test_normalise_fixtures(spark):
    df = spark.createDataFrame([(" N/A",), ("n/a",), ("x-1",), (None,), ("É_b c",)], "v string")
    got = [r[0] for r in df.select(normalise("v")).collect()]
    assert got == ["NA", "NA", "X1", "", "_BC"]


def test_normalise_equals_longer_form(spark):
    """Dropping \\W already implies the N/A→NA rewrite and the trim."""
    random.seed(3)
    alphabet = "aN/A b-_é\t1 .n/a"
    vals = ["".join(random.choice(alphabet) for _ in range(random.randint(0, 12))) for _ in range(3000)] + [None]
    df = spark.createDataFrame([(v,) for v in vals], "v string")
    longer = F.trim(F.upper(F.regexp_replace(F.regexp_replace(F.coalesce(F.col("v"), F.lit("")), "N/A", "NA"), r"\W", "")))
    assert df.filter(normalise("v") != longer).count() == 0


def test_normalise_idempotent(spark):
    random.seed(5)
    vals = ["".join(chr(random.randint(32, 400)) for _ in range(random.randint(0, 10))) for _ in range(2000)]
    df = spark.createDataFrame([(v,) for v in vals], "v string").select(normalise("v").alias("n"))
    assert df.filter(normalise("n") != F.col("n")).count() == 0


def test_work_item_key(spark):
    parts = [f"Step {i}!" for i in range(len(WORK_ITEM_PARTS) - 1)]
    rows = [("CART", *parts), ("Cart", *parts), ("web shop", *parts[:3], None, *parts[4:]), (None,) * len(WORK_ITEM_PARTS)]
    df = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in WORK_ITEM_PARTS))
    got = [r.JoinKey for r in work_item_key(df).collect()]
    steps = [f"STEP{i}" for i in range(len(parts))]
    assert got == [
        "|".join(["CART", *steps[:4], *steps[5:]]),
        "|".join(["CART", *steps]),
        "|".join(["WEBSHOP", *steps[:3], "", *steps[4:]]),
        "|" * (len(WORK_ITEM_PARTS) - 1),
    ]


def test_with_join_key_variants_and_non_text_parts(spark):
    df = spark.createDataFrame([("A", 1, "x y"), ("B", None, "z"), (None, 3, None)], "t string, n int, s string")
    out = with_join_key(df, ["t", "n", "s"], variants=[(F.col("t") == "B", ["t", "s"])], out="k", sep="#")
    assert [r.k for r in out.collect()] == ["A#1#XY", "B#Z", "#3#"]
