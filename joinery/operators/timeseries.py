"""Span expansion: one row per day of a ``[start, end]`` span (T1).

A narrow transformation (``explode(sequence(...))``): no shuffle, rows are
generated inside the task that reads them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _as_date(df: DataFrame, name: str) -> Column:
    """The bound as a date: timestamps at their date, text parsed (a bad date
    gives NULL, so no days, instead of failing the job)."""
    dt = df.schema[name].dataType
    c = F.col(f"`{name}`")
    if isinstance(dt, T.DateType):
        return c
    if isinstance(dt, T.StringType):
        return c.try_cast("date")
    return c.cast("date")


def expand_days(
    df: DataFrame,
    start: str,
    end: str,
    out: str = "snap_date",
    on_reversed: str = "keep",
    keep_null: bool = False,
    chunk_days: int | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """Every input row once per day from ``start`` to ``end``, both included,
    in column ``out`` (timestamps are taken at their date).

    ``on_reversed="keep"`` gives an end-before-start span its days in
    descending order (Spark's ``sequence``); ``"drop"`` gives it none.
    A NULL bound gives no day; ``keep_null=True`` keeps such rows (and dropped
    reversed ones) once with a NULL ``out``.

    With ``chunk_days`` a span is cut into pieces of that many days first, and the pieces are
    dealt evenly to ``partitions`` (default: the session's shuffle partitions) before their
    days are made: no array and no task holds a long span whole, at the price of a shuffle of
    one row a piece. The rows are the same.
    """
    if on_reversed not in ("keep", "drop"):
        raise ValueError("on_reversed must be 'keep' or 'drop'")
    if out in df.columns:
        raise ValueError(f"column {out!r} already exists")
    s, e = _as_date(df, start), _as_date(df, end)
    if chunk_days is not None:
        return _expand_chunks(df, s, e, out, on_reversed, keep_null, chunk_days, partitions)
    days = F.sequence(s, e)
    if on_reversed == "drop":
        days = F.when(e >= s, days)
    gen = F.explode_outer(days) if keep_null else F.explode(days)
    return df.select("*", gen.alias(out))


def _expand_chunks(df: DataFrame, s: Column, e: Column, out: str, on_reversed: str, keep_null: bool, chunk: int, partitions: int | None) -> DataFrame:
    if chunk < 1:
        raise ValueError("chunk_days must be 1 or more")
    explode = F.explode_outer if keep_null else F.explode
    if on_reversed == "drop":
        e = F.when(e >= s, e)
    piece = F.floor(F.abs(F.datediff(e, s)) / F.lit(chunk)).cast("int")
    spans = df.select("*", s.alias("__s"), e.alias("__e"), explode(F.sequence(F.lit(0), piece)).alias("__piece"))
    partitions = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # by number, not by key: the pieces of one span go to as many partitions as there are
    spans = spans.repartition(partitions)
    away = F.when(F.col("__e") >= F.col("__s"), 1).otherwise(-1)
    first = F.date_add("__s", (F.col("__piece") * chunk * away).cast("int"))
    last = F.date_add(first, (F.lit(chunk - 1) * away).cast("int"))
    last = F.when(away == 1, F.least(last, F.col("__e"))).otherwise(F.greatest(last, F.col("__e")))
    return spans.select(*[F.col(f"`{c}`") for c in df.columns], explode(F.sequence(first, last)).alias(out))
