"""Scalar expressions over JSON text columns (P3, P6)."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from .keys import ColumnLike, as_col

_SIMPLE_KEY = re.compile(r"^[A-Za-z_][A-Za-z0-9_]*$")

MAP_TYPE = "map<string,string>"


def json_path(key: str) -> str:
    """``$.key`` for plain names, ``$['key']`` otherwise."""
    if _SIMPLE_KEY.match(key):
        return f"$.{key}"
    if "'" in key or "]" in key:
        raise ValueError(f"unsupported JSON field name: {key!r}")
    return f"$['{key}']"


def json_value(c: ColumnLike, key: str) -> Column:
    """Top-level field of a JSON text as text. Numbers come back as their text,
    malformed JSON and a missing field give NULL (Spark's ``get_json_object``;
    single-quoted JSON is accepted too)."""
    return F.get_json_object(as_col(c), json_path(key))


def parse_flat(c: ColumnLike) -> Column:
    """JSON object text → ``map<string,string>``; nested values become their text, numbers
    the text Spark gives them (``1.10`` becomes ``1.1``); malformed text gives NULL, and so
    does text behind the object. A repeated field stays repeated in the map's entries:
    pass it through ``last_entries`` before building a map again."""
    text = as_col(c)
    # Spark parses the first value of a text and ignores the rest: as the first of two
    # elements, the second one marked by a hash of the text, it must be all of it
    mark = F.hex(F.xxhash64(text))
    whole = F.from_json(F.concat(F.lit("["), text, F.lit(',{"'), mark, F.lit('":""}]')), f"array<{MAP_TYPE}>")
    alone = F.filter(F.array(whole), lambda w: (F.size(w) == 2) & (F.map_keys(F.get(w, F.lit(1))) == F.array(mark)))
    return F.get(F.transform(alone, lambda w: F.get(w, F.lit(0))), F.lit(0))


def last_entries(parsed: Column) -> Column:
    """The entries of a parsed map with the last value of every key, in order of first
    appearance."""
    entries = F.map_entries(parsed)
    keys = F.array_distinct(F.map_keys(parsed))
    last = F.transform(keys, lambda k: F.element_at(F.filter(entries, lambda e: e["key"] == k), -1))
    # the search for each key is for the rare object that repeats one
    return F.when(F.size(keys) == F.size(parsed), entries).otherwise(last)


def upsert_field(parsed: Column, field: str, value: Column) -> Column:
    """``parsed`` with ``field`` set to ``value``: an existing entry is removed first, the
    new entry goes last; of repeated fields the last value counts."""
    kept = F.filter(last_entries(parsed), lambda e: e["key"] != F.lit(field))
    new = F.array(F.struct(F.lit(field).alias("key"), value.cast("string").alias("value")))
    return F.map_from_entries(F.concat(kept, new))


#: A JSON text's strings, marks, blanks and other values.
_TOKEN = r"""(?s)"(?:[^"\\]|\\.)*"|'(?:[^'\\]|\\.)*'|[{}\[\]:,]|[\x20\t\r\n]+|[^\x20\t\r\n{}\[\]:,"']+"""
_NAME = r"""(?s)^[\x20\t\r\n]*("(?:[^"\\]|\\.)*"|'(?:[^'\\]|\\.)*')"""


def raw_entries(text: Column) -> Column:
    """The entries of a JSON object as they are written, ``"name": value`` with all blanks,
    in their order; only for text that is one JSON object. Nested values are not looked
    into: commas inside them belong to them."""
    start = F.struct(F.lit(0).alias("depth"), F.lit("").alias("now"), F.array().cast("array<string>").alias("done"))

    def step(s: Column, t: Column) -> Column:
        up, down = t.isin("{", "["), t.isin("}", "]")
        ends = (s["depth"] == 1) & (down | (t == ","))
        depth = s["depth"] + F.when(up, 1).when(down, -1).otherwise(0)
        now = F.when(ends | (s["depth"] == 0), "").otherwise(F.concat(s["now"], t))
        done = F.when(ends & (F.btrim(s["now"], F.lit(" \t\r\n")) != ""), F.concat(s["done"], F.array(s["now"]))).otherwise(s["done"])
        return F.struct(depth.alias("depth"), now.alias("now"), done.alias("done"))

    return F.aggregate(F.regexp_extract_all(text, F.lit(_TOKEN), F.lit(0)), start, step, lambda s: s["done"])


def put_raw(text: Column, field: str, value: Column) -> Column:
    """The JSON object ``text`` with ``field`` set to the text ``value`` as its last entry
    and all other entries as they were written."""
    name = lambda e: F.get_json_object(F.concat(F.lit('{"n":'), F.regexp_extract(e, _NAME, 1), F.lit("}")), "$.n")
    kept = F.filter(raw_entries(text), lambda e: ~name(e).eqNullSafe(F.lit(field)))
    entry = F.to_json(F.create_map(F.lit(field), value.cast("string")))
    return F.concat(F.lit("{"), F.array_join(F.concat(kept, F.array(F.substring(entry, 2, 1 << 30))), ","))
