"""Scalar expressions for normalised composite join keys (P1, P2)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnLike = str | Column


def as_col(c: ColumnLike) -> Column:
    return F.col(c) if isinstance(c, str) else c


def apart(c: Column, otherwise: Column) -> Column:
    """``c``, or ``otherwise`` where it is NULL, in a projection that Spark does not fuse with
    the operators around it.

    Spark writes a fused projection as one method, and the JVM interprets a method of over
    8000 bytes for good: some 70 columns of arithmetic run ten times slower then. A lambda
    keeps the whole projection out of the fused code, so it is written as many small methods;
    it runs only where ``c`` is NULL. ``c`` has to be nullable, else it is all that is left."""
    return F.coalesce(c, F.get(F.transform(F.array(otherwise), lambda x: x), F.lit(0)))


def normalise(c: ColumnLike) -> Column:
    """Key-part normaliser: NULL becomes ``""``, every non-word character
    (ASCII ``\\W`` of Java regex, so accented letters go too) is dropped, the rest
    is upper-cased.

    The original job also mapped ``N/A`` to ``NA`` and trimmed; both are implied by
    dropping ``\\W`` (it removes ``/`` and blanks), so they are not repeated.
    Non-string parts are cast to text first.
    """
    text = F.coalesce(as_col(c).cast("string"), F.lit(""))
    return F.upper(F.regexp_replace(text, r"\W+", ""))


def join_key(parts: Sequence[ColumnLike], sep: str = "|") -> Column:
    """Normalised parts joined by ``sep``. Parts are never NULL after
    normalising, so an empty part keeps its slot and the key is never NULL."""
    if not parts:
        raise ValueError("a join key needs at least one part")
    return F.concat_ws(sep, *[normalise(p) for p in parts])


def join_key_with_variants(
    parts: Sequence[ColumnLike],
    variants: Sequence[tuple[Column, Sequence[ColumnLike]]] = (),
    sep: str = "|",
) -> Column:
    """Key whose part list depends on the row: the first matching condition of
    ``variants`` picks its own part list, other rows use ``parts``.

    A condition that is NULL (e.g. a NULL selector) counts as not matching.
    """
    if not variants:
        return join_key(parts, sep)
    expr = None
    for cond, vparts in variants:
        key = join_key(vparts, sep)
        expr = F.when(cond, key) if expr is None else expr.when(cond, key)
    return expr.otherwise(join_key(parts, sep))
