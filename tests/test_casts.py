from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from joinery.functions.casts import try_cast_text

TARGETS = [T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType(), T.FloatType(), T.DoubleType(),
           T.DecimalType(10, 2), T.DecimalType(38, 0), T.BooleanType()]

EDGE = ["1.5", "1.", "-.5", ".5", " 12 ", "+5", "- 5", "1e3", "0x10", "2147483648", "-2147483648",
        "9223372036854775807", "9223372036854775808", "", " ", "\t7\n", "٣", "１", "1,000",
        "0007", "-0", "+", "-", ".", "1.0", "1.9", "-1.9", "12abc", "\x007\x1f", None,
        "inf", "-Infinity", "+INF", "NaN", "nan", "-nan", "1e400", "1.5d", "2f", "0x1p3", "1E-5", " 3.25 ",
        "0x1.8p1", "0X10", "0x.8P-2d", "1e", "1e+", ".e1", "1.e2", "٣.٥", "١e٢", "5-LOW", "1-URGENT", "Infinityx",
        "true", "TRUE", " t ", "Yes", "no", "N", "f", "False", "1", "0", "2", "yess", "tru", "on", "off"]

text = st.text(alphabet="0123456789+-. \t\n\x00\x1feE,x_٣１infatrueysoldpPFDXAbc", max_size=10)


def _mismatches(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "s string")
    bad = 0
    for dst in TARGETS:
        plain = F.col("s").try_cast(dst)
        guarded = try_cast_text(F.col("s"), T.StringType(), dst)
        bad += df.filter(~plain.eqNullSafe(guarded)).count()
    return bad


def test_guarded_cast_equals_try_cast_on_edges(spark):
    assert _mismatches(spark, EDGE) == 0


@settings(max_examples=5, deadline=None)
@given(st.lists(text, min_size=200, max_size=400))
def test_guarded_cast_equals_try_cast(spark, values):
    assert _mismatches(spark, values) == 0


def test_other_targets_plain(spark):
    c = try_cast_text(F.col("s"), T.StringType(), T.DateType())
    df = spark.createDataFrame([("2024-01-02",), ("x",)], "s string")
    assert [str(r[0]) for r in df.select(c).collect()] == ["2024-01-02", "None"]
