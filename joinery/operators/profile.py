"""Join-side profiles, broadcast advice and per-source option profiles
(A3, A4, A5, P9, W3).

A profile is one aggregate over one side (one job when collected). Only its
one-row result reaches the driver; the advice built from it decides whether a
side is broadcast. Without advice, Catalyst and AQE choose the join strategy
from measured sizes."""

from __future__ import annotations

import logging
import re
from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.keys import ColumnLike, as_col

log = logging.getLogger(__name__)

# The advice rule's defaults (bytes and distinct keys).
DEFAULT_BROADCAST_BYTES = 10 * 1024 * 1024
DEFAULT_MAX_KEYS = 5000


def type_width(dt: T.DataType) -> int:
    """Per-value width estimate in bytes, the widths Spark uses as default sizes:
    8 long/double/timestamp, 4 int/date/float, 1 boolean/byte, 2 short,
    20 string, 100 binary; containers add up their parts."""
    if isinstance(dt, (T.LongType, T.DoubleType, T.TimestampType, T.TimestampNTZType)):
        return 8
    if isinstance(dt, (T.IntegerType, T.DateType, T.FloatType)):
        return 4
    if isinstance(dt, (T.BooleanType, T.ByteType)):
        return 1
    if isinstance(dt, T.ShortType):
        return 2
    if isinstance(dt, T.DecimalType):
        return 8 if dt.precision <= 18 else 16
    if isinstance(dt, T.StringType):
        return 20
    if isinstance(dt, T.BinaryType):
        return 100
    if isinstance(dt, T.ArrayType):
        return type_width(dt.elementType)
    if isinstance(dt, T.MapType):
        return type_width(dt.keyType) + type_width(dt.valueType)
    if isinstance(dt, T.StructType):
        return sum(type_width(f.dataType) for f in dt.fields)
    return 8


def row_width(schema: T.StructType) -> int:
    return sum(type_width(f.dataType) for f in schema.fields)


def _measured_row_bytes(schema: T.StructType) -> Column:
    """Bytes a row takes in Spark's binary row format, roughly: an 8-byte slot
    per field plus the variable-length payload of strings and binaries (other
    nested values counted by their width estimate)."""
    fixed = 8 + 8 * len(schema.fields)
    parts: list[Column] = [F.lit(fixed).cast("long")]
    for f in schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            parts.append(F.coalesce(F.octet_length(c).cast("long"), F.lit(0).cast("long")))
        elif isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            parts.append(F.lit(type_width(f.dataType)).cast("long"))
    total = parts[0]
    for p in parts[1:]:
        total = total + p
    return total


def _key_expr(key: ColumnLike | Sequence[ColumnLike], hash_keys: bool) -> tuple[Column, Column]:
    """(key value, key-is-null) for one column or several (NULL if any part is)."""
    if isinstance(key, (list, tuple)):
        cols = [as_col(k) for k in key]
        value = F.struct(*cols)
        is_null = F.lit(False)
        for c in cols:
            is_null = is_null | c.isNull()
        if hash_keys:
            value = F.sha2(F.to_json(value), 256)
        return value, is_null
    c = as_col(key)
    value = F.sha2(c.cast("string"), 256) if hash_keys else c
    return value, c.isNull()


def join_profile(
    df: DataFrame,
    key: ColumnLike | Sequence[ColumnLike],
    exact: bool = False,
    hash_keys: bool = False,
    measure: bool = True,
) -> DataFrame:
    """One-row profile of a join side.

    Columns: ``rows``; ``keys`` (distinct non-NULL keys: HyperLogLog++ sketch by
    default, exact with ``exact=True``); ``null_keys`` (rows that can never
    match); ``max_key_rows`` (rows of the most frequent key, the fan-out and skew
    measure; exact mode only, NULL otherwise); ``row_width`` (schema width
    estimate); ``est_bytes`` = rows × row_width; ``data_bytes`` (measured size in
    row format).

    Approximate mode is a single pass with map-side partial aggregation.
    Exact mode groups by the key first (one shuffle of at most one row per key
    per map task, since the count is pre-aggregated), then folds the groups.
    ``hash_keys`` sketches ``sha2`` of the key's text instead of the key.
    ``measure=False`` leaves ``data_bytes`` at 0 and reads the key column alone.
    """
    width = row_width(df.schema)
    value, is_null = _key_expr(key, hash_keys)
    measured = _measured_row_bytes(df.schema) if measure else F.lit(0).cast("long")
    if not exact:
        prof = df.agg(
            F.count(F.lit(1)).alias("rows"),
            F.approx_count_distinct(F.when(~is_null, value)).cast("long").alias("keys"),
            F.count(F.when(is_null, 1)).alias("null_keys"),
            F.lit(None).cast("long").alias("max_key_rows"),
            F.sum(measured).alias("data_bytes"),
        )
    else:
        per_key = df.groupBy(
            F.when(~is_null, value).alias("__k"),
        ).agg(F.count(F.lit(1)).alias("__n"), F.sum(measured).alias("__b"))
        prof = per_key.agg(
            F.coalesce(F.sum("__n"), F.lit(0)).cast("long").alias("rows"),
            F.count("__k").alias("keys"),
            F.coalesce(F.sum(F.when(F.col("__k").isNull(), F.col("__n"))), F.lit(0)).cast("long").alias("null_keys"),
            F.max(F.when(F.col("__k").isNotNull(), F.col("__n"))).cast("long").alias("max_key_rows"),
            F.sum("__b").alias("data_bytes"),
        )
    return prof.select(
        "rows",
        "keys",
        "null_keys",
        "max_key_rows",
        F.lit(width).alias("row_width"),
        (F.col("rows") * F.lit(width)).cast("long").alias("est_bytes"),
        F.coalesce(F.col("data_bytes"), F.lit(0)).cast("long").alias("data_bytes"),
    )


def _get(p: Any, name: str) -> Any:
    return p[name] if isinstance(p, Mapping) else getattr(p, name)


def qualifies(profile: Any, threshold: int, max_keys: int | None) -> bool:
    """Size below ``threshold`` (the larger of the width estimate and the
    measured size) and, if ``max_keys`` is set, fewer distinct keys than that."""
    size = max(_get(profile, "est_bytes") or 0, _get(profile, "data_bytes") or 0)
    if threshold is None or threshold < 0 or size >= threshold:
        return False
    return max_keys is None or (_get(profile, "keys") or 0) < max_keys


def advise_broadcast(
    left: Any,
    right: Any,
    threshold: int = DEFAULT_BROADCAST_BYTES,
    max_keys: int | None = DEFAULT_MAX_KEYS,
) -> str | None:
    """``"left"``, ``"right"`` or ``None`` from two collected profiles.

    A side qualifies below the size threshold and the key limit. If both do, the
    smaller estimate wins and a tie goes to the right; if none does, ``None``.
    """
    ql, qr = qualifies(left, threshold, max_keys), qualifies(right, threshold, max_keys)
    if ql and qr:
        return "left" if _get(left, "est_bytes") < _get(right, "est_bytes") else "right"
    if ql:
        return "left"
    if qr:
        return "right"
    return None


def advise_join(
    left: DataFrame,
    right: DataFrame,
    left_key: ColumnLike | Sequence[ColumnLike],
    right_key: ColumnLike | Sequence[ColumnLike],
    threshold: int | None = None,
    max_keys: int | None = DEFAULT_MAX_KEYS,
    hash_keys: bool = False,
) -> tuple[str | None, dict, dict]:
    """Profile both join sides (one aggregate job each) and advise which one to
    broadcast: ``("left" | "right" | None, left_profile, right_profile)``.
    ``threshold`` defaults to the session's broadcast threshold. Only the right
    side of a left-outer join can be broadcast; callers hint accordingly. Of the left
    side only the key column is read; its size is the width estimate."""
    limit = broadcast_threshold(left.sparkSession) if threshold is None else threshold
    pl = join_profile(left, left_key, hash_keys=hash_keys, measure=False).first().asDict()
    pr = join_profile(right, right_key, hash_keys=hash_keys).first().asDict()
    return advise_broadcast(pl, pr, limit, max_keys), pl, pr


_SIZE = re.compile(r"^\s*(-?\d+)\s*([kmgt]?)i?b?\s*$", re.IGNORECASE)


def broadcast_threshold(spark: SparkSession) -> int:
    """``spark.sql.autoBroadcastJoinThreshold`` in bytes (-1: disabled)."""
    raw = spark.conf.get("spark.sql.autoBroadcastJoinThreshold", str(DEFAULT_BROADCAST_BYTES))
    m = _SIZE.match(str(raw))
    if not m:
        return DEFAULT_BROADCAST_BYTES
    n = int(m.group(1))
    mult = {"": 1, "k": 1 << 10, "m": 1 << 20, "g": 1 << 30, "t": 1 << 40}[m.group(2).lower()]
    return n * mult


def checked_broadcast(
    df: DataFrame,
    key: ColumnLike | Sequence[ColumnLike] | None = None,
    threshold: int | None = None,
    max_keys: int | None = None,
) -> tuple[DataFrame, dict]:
    """``broadcast(df)`` only if one profile job proves it small; otherwise the
    frame unchanged (Catalyst/AQE then pick a shuffle join, or broadcast on
    measured sizes). Returns the frame and the collected profile."""
    spark = df.sparkSession
    limit = broadcast_threshold(spark) if threshold is None else threshold
    prof_key = key if key is not None else F.lit(1)
    row = join_profile(df, prof_key, exact=False).first()
    prof = row.asDict()
    if qualifies(prof, limit, max_keys):
        return F.broadcast(df), prof
    log.info("not broadcasting: profile %s exceeds %s bytes / %s keys", prof, limit, max_keys)
    return df, prof


def profiles_frame(spark: SparkSession, profiles: Mapping[str, Mapping[str, Any]], source_col: str = "source") -> DataFrame:
    """Profile table from the config shape ``{source: {option: value}}``.
    Option types come from the Python values (bool, int, float, str; all
    profiles must agree); a missing option is NULL."""
    names: list[str] = []
    types: dict[str, str] = {}
    for opts in profiles.values():
        for k, v in opts.items():
            if k not in types:
                names.append(k)
            if v is None:
                types.setdefault(k, None)
                continue
            t = "boolean" if isinstance(v, bool) else "bigint" if isinstance(v, int) else "double" if isinstance(v, float) else "string"
            if types.get(k) not in (None, t):
                raise ValueError(f"option {k!r} has mixed types")
            types[k] = t
    ddl = ", ".join([f"`{source_col}` string"] + [f"`{n}` {types[n] or 'string'}" for n in names])
    rows = [tuple([src] + [opts.get(n) for n in names]) for src, opts in profiles.items()]
    return spark.createDataFrame(rows, ddl)


def with_profile(
    df: DataFrame,
    profiles: DataFrame,
    key: str,
    default: str = "default",
    source_col: str = "source",
    max_profiles: int = 100_000,
) -> DataFrame:
    """Append the option columns of the profile whose ``source_col`` equals the
    row's ``key``. A row whose source has no profile (or is NULL) takes the
    **whole** default profile — options are not merged one by one.

    One exact profile job over the profile table rejects a source named twice
    (``ValueError``) and measures its size: it is broadcast only below the
    broadcast threshold, otherwise joined by shuffle. The default profile
    (exactly one row, else ``ValueError``) becomes a literal.
    """
    opts = [c for c in profiles.columns if c != source_col]
    clash = [c for c in opts if c in df.columns]
    if clash:
        raise ValueError(f"profile options clash with columns {clash}")
    dflt = profiles.filter(F.col(source_col) == F.lit(default)).limit(2).collect()
    if len(dflt) != 1:
        raise ValueError(f"profile table must hold exactly one {default!r} profile")
    types = {f.name: f.dataType for f in profiles.schema.fields}
    dstruct = F.struct(*[F.lit(dflt[0][o]).cast(types[o]).alias(o) for o in opts])
    table = profiles.select(F.col(source_col).alias("__src"), F.struct(*[F.col(f"`{o}`") for o in opts]).alias("__opt"))
    # one exact profile job: rejects a source named twice (it would multiply
    # rows) and proves the size before broadcasting
    prof = join_profile(table, "__src", exact=True).first().asDict()
    if (prof["max_key_rows"] or 0) > 1:
        raise ValueError(f"profile table names a {source_col} more than once")
    if qualifies(prof, broadcast_threshold(df.sparkSession), max_profiles):
        table = F.broadcast(table)
    joined = df.join(table, df[key] == table["__src"], "left")
    chosen = F.coalesce(F.col("__opt"), dstruct)
    return joined.select(*[df[c] for c in df.columns], *[chosen.getField(o).alias(o) for o in opts])
