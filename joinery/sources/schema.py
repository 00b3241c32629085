"""Declared schemas: build them from a spec, check frames against them, and
conform a frame's column types to them (S7, S11, V1)."""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.casts import try_cast_text

log = logging.getLogger(__name__)

# Type names accepted in a JSON field list. Any atomic class name of
# pyspark.sql.types works ("StringType", "IntegerType", "TimestampType",
# "BooleanType", "LongType", ...); anything else is read as a DDL type string
# ("decimal(12,2)", "array<string>").
_ATOMIC = {
    name: cls
    for name, cls in vars(T).items()
    if isinstance(cls, type)
    and issubclass(cls, T.AtomicType)
    and cls.__module__ == T.__name__
    and not name.startswith("_")
}

SchemaLike = T.StructType | str | Sequence[Mapping[str, Any]]


def _type_of(name: str) -> T.DataType:
    cls = _ATOMIC.get(name)
    if cls is not None:
        try:
            return cls()
        except TypeError:
            pass
    try:
        return T.DataType.fromDDL(name)
    except Exception as e:  # noqa: BLE001 - re-raised with context
        raise ValueError(f"unknown type name {name!r}") from e


def schema_from_spec(spec: SchemaLike) -> T.StructType:
    """``StructType`` from a ``StructType``, a DDL string
    (``"id INT, name STRING"``) or a list of ``{name, type, nullable}``."""
    if isinstance(spec, T.StructType):
        return spec
    if isinstance(spec, str):
        return T.StructType.fromDDL(spec)
    fields = []
    for f in spec:
        if "name" not in f or "type" not in f:
            raise ValueError(f"field spec needs 'name' and 'type': {f!r}")
        fields.append(T.StructField(f["name"], _type_of(f["type"]), bool(f.get("nullable", True))))
    return T.StructType(fields)


def _strip_nullability(dt: T.DataType) -> T.DataType:
    if isinstance(dt, T.StructType):
        return T.StructType([T.StructField(f.name, _strip_nullability(f.dataType), True) for f in dt.fields])
    if isinstance(dt, T.ArrayType):
        return T.ArrayType(_strip_nullability(dt.elementType), True)
    if isinstance(dt, T.MapType):
        return T.MapType(_strip_nullability(dt.keyType), _strip_nullability(dt.valueType), True)
    return dt


def schema_diff(actual: T.StructType, expected: T.StructType, check_nullable: bool = False) -> list[str]:
    """Human-readable differences; empty when the schemas agree."""
    a = actual if check_nullable else _strip_nullability(actual)
    e = expected if check_nullable else _strip_nullability(expected)
    if a == e:
        return []
    out = []
    an, en = [f.name for f in a.fields], [f.name for f in e.fields]
    missing = [n for n in en if n not in an]
    extra = [n for n in an if n not in en]
    if missing:
        out.append(f"missing columns {missing}")
    if extra:
        out.append(f"unexpected columns {extra}")
    if not missing and not extra and an != en:
        out.append(f"column order {an} != {en}")
    ad = {f.name: f for f in a.fields}
    for f in e.fields:
        g = ad.get(f.name)
        if g is None:
            continue
        if g.dataType != f.dataType:
            out.append(f"{f.name}: {g.dataType.simpleString()} != {f.dataType.simpleString()}")
        elif check_nullable and g.nullable != f.nullable:
            out.append(f"{f.name}: nullable {g.nullable} != {f.nullable}")
    return out or ["schemas differ"]


def assert_schema(df: DataFrame, expected: SchemaLike, check_nullable: bool = False) -> DataFrame:
    """Raise ``ValueError`` unless ``df`` has the expected names, order and types.

    Nullability is ignored by default: Parquet files always read back as
    nullable, so a declared ``nullable: false`` could never match a file source.
    Runs no job.
    """
    diff = schema_diff(df.schema, schema_from_spec(expected), check_nullable)
    if diff:
        raise ValueError("data schema does not match the expected schema: " + "; ".join(diff))
    return df


def conform(
    df: DataFrame,
    schema: SchemaLike,
    on_error: str = "null",
    missing: str = "ignore",
    guard: bool = True,
) -> DataFrame:
    """Cast every column that the schema names to the schema's type; other
    columns pass through unchanged, in the frame's order.

    ``on_error="null"`` turns a value that does not convert into NULL
    (``try_cast``); ``"fail"`` fails the job (ANSI ``cast``). NULL stays NULL.
    ``missing``: what to do with schema columns absent from the frame —
    ``"ignore"``, ``"null"`` (append as typed NULLs) or ``"error"``.
    ``guard`` puts text going to numbers / booleans through a regex first
    (see ``functions.casts``): much faster on junk, a little slower on clean
    text.
    """
    if on_error not in ("null", "fail"):
        raise ValueError("on_error must be 'null' or 'fail'")
    if missing not in ("ignore", "null", "error"):
        raise ValueError("missing must be 'ignore', 'null' or 'error'")
    st = schema_from_spec(schema)
    wanted = {f.name: f.dataType for f in st.fields}
    current = {f.name: f.dataType for f in df.schema.fields}
    cols = []
    for name in df.columns:
        dt = wanted.get(name)
        if dt is None or dt == current[name]:
            cols.append(F.col(f"`{name}`"))
        elif on_error == "null":
            cols.append(try_cast_text(F.col(f"`{name}`"), current[name], dt, guard).alias(name))
        else:
            cols.append(F.col(f"`{name}`").cast(dt).alias(name))
    absent = [f for f in st.fields if f.name not in current]
    if absent and missing == "error":
        raise ValueError(f"columns missing from the frame: {[f.name for f in absent]}")
    if absent and missing == "null":
        cols += [F.lit(None).cast(f.dataType).alias(f.name) for f in absent]
    return df.select(*cols)
