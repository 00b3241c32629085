import json

import pytest

from pyspark.sql import functions as F

from joinery import json_get, json_put, with_indicator


def test_json_get(spark):
    df = spark.createDataFrame(
        [("{'employee_number': '12345'}",), ('{"employee_number": 7}',), ("bad",), (None,)], "j string"
    )
    got = [r.employee_number for r in json_get(df, "j", "employee_number").collect()]
    assert got == ["12345", "7", None, None]


def test_indicator_then_json_put(spark):
    codes = spark.createDataFrame([(7, "gold"), (8, None), (9, "tin")], "no bigint, code string")
    data = spark.createDataFrame(
        [(1, '{"colour": "red"}', 9), (2, '{"flag": "old", "size": "2"}', 7), (3, None, 4), (4, "{}", 8)],
        "id bigint, extra string, owner bigint",
    )
    flagged = with_indicator(data, codes, ("owner", "no"), "code", out="flag")
    out = json_put(flagged, "extra", "flag", "flag").orderBy("id")
    assert out.columns == ["id", "extra", "owner", "flag"]
    assert [r.extra for r in out.collect()] == [
        '{"colour":"red","flag":"tin"}', '{"size":"2","flag":"gold"}', '{"flag":"N"}', '{"flag":"N"}',
    ]


@pytest.mark.parametrize("payload, want", [
    ('{"a":"1"} trailing', None), ('{"a":"1"}],[{"b":"2"}', None), ('{"a":"1"},{"b":"2"}', None), ('[{"a":"1"}]', None), ("", None), ("1", None),
    ('{"a":"1","a":"2","b":"3"}', {"a": "2", "b": "3", "f": "N"}), (' {"a":null}\n', {"a": None, "f": "N"}), ('{"f":"x","f":"y"}', {"f": "N"}),
    ('{"a":1.10,"b":true,"c":{"d":"}"}}', {"a": "1.1", "b": "true", "c": '{"d":"}"}', "f": "N"}),
])
def test_json_put_keeps_what_is_no_object(spark, payload, want):
    row = json_put(spark.createDataFrame([(payload,)], "j string"), "j", "f", F.lit("N"), flag="bad").first()
    assert row.bad == (want is None)
    assert row.j == payload if want is None else json.loads(row.j) == want


def test_json_put_parses_once(spark):
    out = json_put(spark.createDataFrame([("{}",)], "j string"), "j", "f", F.lit("N"), flag="bad")
    assert out._jdf.queryExecution().optimizedPlan().toString().count("from_json") == 1


def test_json_put_upsert_and_bad_payload(spark):
    df = spark.createDataFrame([(1, '{"f":"x","a":"1"}'), (2, "bad"), (3, '{"n": {"b": 2}, "m": 3}')], "id int, j string")
    out = json_put(df, "j", "f", F.lit("N"), flag="_corrupt").orderBy("id").collect()
    assert out[0].j == '{"a":"1","f":"N"}' and out[0]._corrupt is False
    assert out[1].j == "bad" and out[1]._corrupt is True
    assert json.loads(out[2].j) == {"n": '{"b":2}', "m": "3", "f": "N"}
    nulled = json_put(df, "j", "f", F.lit("N"), on_bad="null").orderBy("id").collect()
    assert nulled[1].j is None


def test_json_put_twice_is_once(spark):
    df = spark.createDataFrame([('{"a":"1"}',), (None,), ('{"f":"old"}',), ("[1]",)], "j string")
    once = json_put(df, "j", "f", F.lit("v"))
    twice = json_put(once, "j", "f", F.lit("v"))
    assert sorted(map(tuple, once.collect()), key=str) == sorted(map(tuple, twice.collect()), key=str)


LOSSLESS = [
    ('{"a":1.10}', '{"a":1.10,"f":"v"}'),
    ('{}', '{"f":"v"}'),
    (' { \n} ', '{"f":"v"}'),
    (None, '{"f":"v"}'),
    ('{"f":1}', '{"f":"v"}'),
    ('{"f":{"f":2},"a":[1, {"f":3}] }', '{"a":[1, {"f":3}] ,"f":"v"}'),
    ('{"a":"x,y}","b":"\\"{","f":"old","c":1e5}', '{"a":"x,y}","b":"\\"{","c":1e5,"f":"v"}'),
    ('{"a":12345678901234567890123.4500, "a":2}', '{"a":12345678901234567890123.4500, "a":2,"f":"v"}'),
    ('{"\\u0066":1,"é":null}', '{"é":null,"f":"v"}'),
    ("{'f':1,'b':'x\"y'}", "{'b':'x\"y',\"f\":\"v\"}"),
    ('{"f":1', '{"f":1'),
    ('[1]', '[1]'),
    ('{"a":1} tail', '{"a":1} tail'),
]


def test_lossless_put_keeps_other_fields_as_written(spark):
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(LOSSLESS)], "i int, j string")
    out = {r.i: r for r in json_put(df, "j", "f", F.lit("v"), flag="bad", lossless=True).collect()}
    assert [out[i].j for i in range(len(LOSSLESS))] == [want for _, want in LOSSLESS]
    assert [i for i in out if out[i].bad] == [10, 11, 12]
    twice = json_put(json_put(df, "j", "f", F.lit("u"), lossless=True), "j", "f", F.lit("v"), lossless=True)
    assert [r.j for r in twice.orderBy("i").collect()] == [want for _, want in LOSSLESS]
    odd = json_put(df.filter("i = 0"), "j", 'q"\\', F.lit('say "v"\n'), lossless=True).first().j
    assert odd == '{"a":1.10,"q\\"\\\\":"say \\"v\\"\\n"}'
