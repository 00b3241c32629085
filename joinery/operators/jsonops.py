"""JSON field upsert on a text column (P6)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.jsonfields import parse_flat, put_raw, upsert_field
from ..functions.keys import as_col

ON_BAD = ("keep", "null")


def json_put(
    df: DataFrame,
    json_col: str,
    field: str,
    value: Column | str,
    on_bad: str = "keep",
    flag: str | None = None,
    lossless: bool = False,
) -> DataFrame:
    """Set ``field`` to ``value`` in the flat JSON object held by ``json_col``.

    * NULL payload: a new one-field object.
    * object payload: parsed as ``map<string,string>`` (nested values become text,
      numbers are rewritten as Spark prints them, so ``1.10`` turns into ``"1.1"``
      and digits beyond double precision are lost), ``field`` replaced or appended
      last, of a repeated field the last value kept, serialised without blanks.
    * payload that is not one JSON object, such as text behind an object: kept unchanged with
      ``on_bad="keep"`` (and ``flag``, if named, set true), or NULL with
      ``on_bad="null"``.

    ``value`` is a column name or a Column; it is stored as text.

    With ``lossless`` all other fields stay exactly as they are written: numbers with their
    digits, nested objects and arrays, blanks, repeats of other fields. Only the field's own
    entries go and the new one is put last. It reads the text token by token, which costs
    more than the flat form.
    """
    if on_bad not in ON_BAD:
        raise ValueError(f"on_bad must be one of {ON_BAD}")
    src = F.col(f"`{json_col}`")
    val = as_col(value).cast("string")
    names = list(df.columns)
    df = df.select("*", parse_flat(src).alias("__parsed"))  # parsed once
    parsed = F.col("__parsed")
    fresh = F.to_json(F.create_map(F.lit(field), val))
    updated = put_raw(src, field, val) if lossless else F.to_json(upsert_field(parsed, field, val))
    bad = src.isNotNull() & parsed.isNull()
    new = F.when(src.isNull(), fresh).when(bad, src if on_bad == "keep" else F.lit(None).cast("string")).otherwise(updated)
    cols = [new.alias(json_col) if c == json_col else F.col(f"`{c}`") for c in names]
    if flag:
        if flag in names:
            raise ValueError(f"column {flag!r} already exists")
        cols.append(bad.alias(flag))
    return df.select(*cols)
