"""Aggregates: latest snapshot per entity, global span bounds, match counts
(A1, A2, V2). All aggregate map-side first, so a hot group costs one partial row
per map task in the shuffle; maxima of text and ``max_by`` run as sort aggregates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.keys import ColumnLike, as_col


def latest_snapshot(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    out: str = "latest_snap_date",
    latest_only: bool = False,
) -> DataFrame:
    """``MAX(ts) AS out`` per ``keys``.

    By default every key column is a grouping column (an entity whose name
    changed has one row per name). With ``latest_only=True`` the first key is
    the entity id and all further keys come from one and the same latest row of
    that id, giving one row per id. Ties on the latest ``ts`` take the greatest
    row of further keys, so a recomputed task gives the same answer.
    """
    keys = list(keys)
    if not keys:
        raise ValueError("latest_snapshot needs at least one key")
    if not latest_only:
        return df.groupBy(*keys).agg(F.max(ts).alias(out))
    ident, rest = keys[0], keys[1:]
    if not rest:
        return df.groupBy(ident).agg(F.max(ts).alias(out))
    row = F.struct(*[F.col(k).alias(f"r{i}") for i, k in enumerate(rest)])
    last = F.max_by(row, F.when(F.col(ts).isNotNull(), F.struct(F.col(ts).alias("t"), row.alias("r"))))
    found = df.groupBy(ident).agg(last.alias("__last"), F.max(ts).alias(out))
    return found.select(ident, *[F.col(f"__last.r{i}").alias(k) for i, k in enumerate(rest)], out)


def span_bounds(
    df: DataFrame,
    start: str,
    end: str,
    out: tuple[str, str] = ("min_start_date", "max_end_date"),
) -> DataFrame:
    """One-row frame: the earliest ``start`` and the latest ``end`` (one job)."""
    return df.agg(F.min(start).alias(out[0]), F.max(end).alias(out[1]))


def match_stats(
    df: DataFrame,
    cols: Sequence[ColumnLike] | str,
    unmatched: object | None = None,
) -> DataFrame:
    """Per column: ``total_rows`` and ``matched_rows`` (not NULL and, when
    ``unmatched`` is given, different from that default label), in one pass.
    Returns one row per column (``column``, ``total_rows``, ``matched_rows``)."""
    if isinstance(cols, str):
        cols = [cols]
    names = [c if isinstance(c, str) else f"col{i}" for i, c in enumerate(cols)]
    aggs = [F.count(F.lit(1)).alias("__total")]
    for i, c in enumerate(cols):
        c = as_col(c)
        hit = c.isNotNull() if unmatched is None else c.isNotNull() & (c != F.lit(unmatched))
        aggs.append(F.count(F.when(hit, 1)).alias(f"__m{i}"))
    wide = df.agg(*aggs)
    pairs = ", ".join(f"'{n.replace(chr(39), chr(39) * 2)}', __m{i}" for i, n in enumerate(names))
    return wide.selectExpr(f"stack({len(names)}, {pairs}) AS (`column`, matched_rows)", "__total AS total_rows").select(
        "column", "total_rows", "matched_rows"
    )
