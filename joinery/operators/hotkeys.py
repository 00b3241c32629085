"""Frequent keys by a sketch: one pass, counts within a stated error (A4, J1, J4)."""

from __future__ import annotations

import math
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.keys import ColumnLike, as_col

#: Keys that hold this share of the rows or more are frequent.
SHARE = 0.01
#: Keys the sketch tracks: its counts are off by at most ``3.5 / TRACKED`` of the rows.
TRACKED = 10_000

_PLAIN = (T.StringType, T.IntegralType, T.DateType, T.TimestampType, T.TimestampNTZType, T.DecimalType, T.BooleanType, T.FractionalType)


def error_share(tracked: int) -> float:
    """The share of all rows by which a count of a frequent-items sketch of ``tracked``
    entries can be too high, however many parts it was merged from."""
    return 3.5 / tracked


def frequent_keys(df: DataFrame, key: ColumnLike, share: float = SHARE, tracked: int = TRACKED) -> DataFrame:
    """``(key, rows, error, total)`` of the keys that hold ``share`` of the rows or more.

    One pass with map-side sketches of a fixed size (``approx_top_k``, a frequent-items
    sketch); no shuffle of rows. Every key that reaches ``share`` is listed. ``rows`` is
    never too low and too high by ``error`` at most, so a key may be listed that falls
    short by that much; with no more than ``tracked`` distinct keys it is exact. NULL keys
    count in ``total`` and are not listed; an empty table gives no rows. At most
    ``1 / (share - error)`` keys are listed, whatever the table."""
    off = error_share(tracked)
    if not off < share <= 1:
        raise ValueError(f"share must be above the sketch's error {off:.2g} and at most 1")
    value = as_col(key)
    kind = df.select(value.alias("key")).schema["key"].dataType
    if not isinstance(kind, _PLAIN):
        raise ValueError(f"frequent keys need one plain column, not {kind.simpleString()}")
    most = min(tracked, math.ceil(1 / (share - off)) + 2)
    counted = df.select(value.alias("key")).agg(
        F.call_function("approx_top_k", F.col("key"), F.lit(most), F.lit(tracked)).alias("top"), F.count(F.lit(1)).alias("total"))
    listed = counted.select(F.explode("top").alias("t"), "total")
    listed = listed.select(F.col("t.item").alias("key"), F.col("t.count").alias("rows"), F.floor(F.col("total") * off).cast("long").alias("error"), "total")
    return listed.filter(F.col("key").isNotNull() & (F.col("rows") >= F.col("total") * share))


def frequent_values(df: DataFrame, key: ColumnLike, share: float = SHARE, tracked: int = TRACKED) -> list[Any]:
    """The frequent keys as values on the driver: at most ``1 / (share - error)`` of them."""
    return [r.key for r in frequent_keys(df, key, share, tracked).collect()]
