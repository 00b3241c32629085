"""Composite join key column (P2)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame

from ..functions.keys import ColumnLike, join_key_with_variants


def with_join_key(
    df: DataFrame,
    parts: Sequence[ColumnLike],
    variants: Sequence[tuple[Column, Sequence[ColumnLike]]] = (),
    out: str = "JoinKey",
    sep: str = "|",
) -> DataFrame:
    """Append ``out``: the normalised ``parts`` joined by ``sep``; a row meeting a
    condition in ``variants`` uses that variant's part list instead."""
    return df.withColumn(out, join_key_with_variants(parts, variants, sep))
