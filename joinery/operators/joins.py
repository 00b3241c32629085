"""Lookup enrichment, inner joins and the merge of two enrichments
(J1-J8, J10, J11, P4, P5, P7, P8).

Every join is an equi-join that Catalyst plans: a broadcast hash join when the
lookup side is proven small (by AQE's measured sizes, or by a profile when
``strategy`` asks for advice), otherwise a sort-merge join that shuffles both
sides on the key. For left-outer joins AQE splits a skewed (hot-key) primary
partition into several tasks, so a key that holds a third of the rows does not
end up in one task."""

from __future__ import annotations

import functools
import logging
import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.casts import try_cast_text
from ..functions.jsonfields import json_value
from ..functions.keys import apart
from .hotkeys import SHARE, frequent_values
from .profile import DEFAULT_MAX_KEYS, broadcast_threshold, checked_broadcast

log = logging.getLogger(__name__)

# Fixed value: the label given to unmatched rows.
NOT_DEFINED = "Not Defined"

STRATEGIES = ("catalyst", "auto", "broadcast", "shuffle", "split")

_L, _R = "__l", "__r"


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _lcol(name: str) -> Column:
    return F.col(f"{_L}.{_q(name)}")


def _rcol(name: str) -> Column:
    return F.col(f"{_R}.{_q(name)}")


def _pair(on: str | tuple[str, str]) -> tuple[str, str]:
    if isinstance(on, str):
        return on, on
    left, right = on
    return left, right


def _takes(take: Mapping[str, str] | Sequence[str]) -> dict[str, str]:
    if isinstance(take, Mapping):
        return dict(take)
    return {c: c for c in take}


def _defaults(defaults, outs: Sequence[str]) -> dict[str, object]:
    if defaults is None:
        return {}
    if isinstance(defaults, Mapping):
        return {o: defaults[o] for o in outs if o in defaults}
    return {o: defaults for o in outs}


def _aligned(left: Column, ltype: T.DataType, rtype: T.DataType) -> Column:
    """The left key, comparable with the right one without failing under ANSI:
    text against a non-text key is ``try_cast`` (NULL, so no match, when it is
    not a value of that type); a non-text key against a text key is compared as
    text; other pairs are left to Spark's type widening."""
    if ltype == rtype:
        return left
    if isinstance(ltype, T.StringType):
        return try_cast_text(left, ltype, rtype)
    if isinstance(rtype, T.StringType):
        return left.cast("string")
    return left


_INTERNAL = re.compile(r"^__(jk|v\d+|m\d+|z\d+|md|mt|n)$")


def _check_internal(*dfs: DataFrame) -> None:
    """Reject input columns that collide with the helper columns used inside
    the joins."""
    bad = sorted({c for df in dfs for c in df.columns if _INTERNAL.match(c)})
    if bad:
        raise ValueError(f"column names reserved by joinery: {bad}")


def _dtype(df: DataFrame, name: str) -> T.DataType:
    for f in df.schema.fields:
        if f.name == name:
            return f.dataType
    raise ValueError(f"no column {name!r} in {df.columns}")


def _apply_strategy(right: DataFrame, strategy: str, max_keys: int | None) -> DataFrame:
    if strategy not in STRATEGIES:
        raise ValueError(f"strategy must be one of {STRATEGIES}")
    if strategy in ("catalyst", "split"):
        return right
    if strategy == "shuffle":
        return right.hint("merge")
    # "broadcast" asks for it, "auto" follows the advice rule (size and keys);
    # both only broadcast what one profile job proves small.
    keys = max_keys if strategy == "auto" else None
    out, prof = checked_broadcast(right, key=F.col("__jk"), threshold=broadcast_threshold(right.sparkSession), max_keys=keys)
    log.info("lookup profile %s", prof)
    return out


def _left_outer(left: DataFrame, right: DataFrame, lk: Column, rk: Column, outs: Sequence[Column], strategy: str, hot_share: float) -> DataFrame:
    """``left`` joined to ``right`` where ``lk = rk``, as the columns ``outs``.

    ``"split"`` asks a sketch for the keys that hold ``hot_share`` of the left rows or more.
    Their rows, and those without a key, are joined where they are to a broadcast of the few
    lookup rows they need; only the others are shuffled, and no key of theirs is large. If
    the lookup rows of the hot keys are not small themselves, nothing is broadcast and the
    join is the plain one."""
    whole = lambda a, b: a.join(b, lk == rk, "left_outer").select(*outs)
    if strategy != "split":
        return whole(left, right)
    hot = frequent_values(left, lk, hot_share)
    few = right.filter(rk.isin(hot)) if hot else right.filter(F.lit(False))
    limit = broadcast_threshold(left.sparkSession)
    few, profile = checked_broadcast(few, rk, threshold=limit)
    if hot and not max(profile["est_bytes"], profile["data_bytes"]) < limit:
        log.info("lookup rows of %d hot keys are not small: %s", len(hot), profile)
        return whole(left, right)
    here = F.coalesce(lk.isin(hot), F.lit(True)) if hot else lk.isNull()
    others = right.filter(~rk.isin(hot)) if hot else right
    return whole(left.filter(here), few).unionAll(whole(left.filter(~here), others.hint("merge")))


def enrich(
    primary: DataFrame,
    lookup: DataFrame,
    on: str | tuple[str, str],
    take: Mapping[str, str] | Sequence[str],
    defaults: object | Mapping[str, object] | None = NOT_DEFINED,
    strategy: str = "catalyst",
    unique: bool = False,
    only_where: Column | None = None,
    max_keys: int | None = DEFAULT_MAX_KEYS,
    hot_share: float = SHARE,
) -> DataFrame:
    """Left-outer lookup enrichment: every primary column, then one column per
    ``take`` entry (``{output_name: lookup_column}``), where an unmatched row or
    a NULL value gets its default (``"Not Defined"``; ``None`` keeps NULL; a text
    default turns a non-text value into text).

    ``on`` is a shared key name or ``(primary_key, lookup_key)``; a primary key
    of another type is ``try_cast`` to the lookup's. NULL keys never match.
    Duplicate lookup keys multiply primary rows, as a join does; with
    ``unique=True`` the job fails instead. ``only_where`` restricts matching to
    primary rows where it holds (others get defaults). ``strategy``:
    ``"catalyst"`` (default: Catalyst/AQE decide), ``"broadcast"`` / ``"auto"``
    (broadcast the lookup if one profile job proves it small; ``auto`` also
    needs fewer than ``max_keys`` keys), ``"shuffle"`` (sort-merge join), ``"split"``
    (rows of primary keys that hold ``hot_share`` of the rows, and rows without a key, meet
    a broadcast of their few lookup rows; the others a sort-merge join. One sketch of the
    key column and two scans of the primary, but no hot key is shuffled).
    """
    lkey, rkey = _pair(on)
    takes = _takes(take)
    clash = [o for o in takes if o in primary.columns]
    if clash:
        raise ValueError(f"output columns already exist on the primary: {clash}")
    _check_internal(primary)
    dflt = _defaults(defaults, list(takes))
    rtype = _dtype(lookup, rkey)
    ltype = _dtype(primary, lkey)

    right = lookup.select(
        F.col(_q(rkey)).alias("__jk"),
        *[F.col(_q(src)).alias(f"__v{i}") for i, src in enumerate(takes.values())],
    )
    if unique:
        vals = [f"__v{i}" for i in range(len(takes))]
        right = right.filter(F.col("__jk").isNotNull()).groupBy("__jk").agg(F.count(F.lit(1)).alias("__n"), *[F.first(v).alias(v) for v in vals])
        right = right.select(
            F.when(F.col("__n") > 1, F.raise_error(F.lit(f"lookup key {rkey} is not unique"))).otherwise(F.col("__jk")).alias("__jk"),
            *vals,
        )
    right = _apply_strategy(right, strategy, max_keys)

    left = primary.alias(_L)
    lk = _aligned(_lcol(lkey), ltype, rtype)
    if only_where is not None:
        lk = F.when(only_where, lk)
    outs = []
    for i, (out, _src) in enumerate(takes.items()):
        v = F.col(f"__v{i}")
        if out in dflt:
            d = dflt[out]
            vtype = right.schema[f"__v{i}"].dataType
            if isinstance(d, str) and not isinstance(vtype, T.StringType):
                v = v.cast("string")
            v = F.coalesce(v, F.lit(d))
        outs.append(v.alias(out))
    return _left_outer(left, right, lk, F.col("__jk"), [*[_lcol(c) for c in primary.columns], *outs], strategy, hot_share)


def enrich_sql(
    spark: SparkSession,
    primary: DataFrame,
    lookup: DataFrame,
    on: str | tuple[str, str],
    take: Mapping[str, str] | Sequence[str],
    default: str = NOT_DEFINED,
    strategy: str = "catalyst",
    max_keys: int | None = DEFAULT_MAX_KEYS,
) -> DataFrame:
    """The same enrichment as one Spark SQL statement over the two frames
    (``SELECT p.*, COALESCE(a.x, :default) AS … LEFT OUTER JOIN``).

    ``strategy="auto"`` / ``"broadcast"`` profile the lookup's key and
    label columns (one job) and add a ``BROADCAST(a)`` hint only when the profile
    proves them small (``auto`` also needs fewer than ``max_keys`` keys);
    ``"shuffle"`` adds a ``MERGE(a)`` hint."""
    lkey, rkey = _pair(on)
    takes = _takes(take)
    clash = [o for o in takes if o in primary.columns]
    if clash:
        raise ValueError(f"output columns already exist on the primary: {clash}")
    if strategy not in STRATEGIES:
        raise ValueError(f"strategy must be one of {STRATEGIES}")
    hint = ""
    if strategy == "shuffle":
        hint = "/*+ MERGE(a) */ "
    elif strategy in ("auto", "broadcast"):
        used = lookup.select(F.col(_q(rkey)), *[F.col(_q(src)) for src in dict.fromkeys(takes.values()) if src != rkey])
        keys = max_keys if strategy == "auto" else None
        hinted, _prof = checked_broadcast(used, key=F.col(_q(rkey)), threshold=broadcast_threshold(spark), max_keys=keys)
        if hinted is not used:
            hint = "/*+ BROADCAST(a) */ "
    _check_internal(primary)
    lookup = lookup.select(
        F.col(_q(rkey)).alias("__jk"),
        *[(F.col(_q(src)) if isinstance(_dtype(lookup, src), T.StringType) else F.col(_q(src)).cast("string")).alias(f"__v{i}")
          for i, src in enumerate(takes.values())],
    )
    # the same key rule as in enrich(): text against another type never fails the job
    primary_cols = ", ".join(f"p.{_q(c)}" for c in primary.columns)
    keyed = primary.select("*", _aligned(F.col(_q(lkey)), _dtype(primary, lkey), _dtype(lookup, "__jk")).alias("__jk"))
    sel = ",\n       ".join(f"COALESCE(a.__v{i}, :dflt) AS {_q(out)}" for i, out in enumerate(takes))
    query = (
        f"SELECT {hint}{primary_cols},\n       {sel}\n"
        f"FROM {{primary}} p\nLEFT OUTER JOIN {{lookup}} a\n  ON p.__jk = a.__jk"
    )
    return spark.sql(query, args={"dflt": default}, primary=keyed, lookup=lookup)


def inner_sql(
    spark: SparkSession,
    left: DataFrame,
    right: DataFrame,
    on: str | tuple[str, str],
    left_cols: Sequence[str],
    right_cols: Sequence[str],
) -> DataFrame:
    """Inner equi-join in SQL: the chosen left columns, the chosen right
    columns, then the left key (which may not be chosen again). Keys of different
    types compare as in ``enrich``."""
    lkey, rkey = _pair(on)
    names = [*left_cols, *right_cols, lkey]
    twice = sorted({c for c in names if names.count(c) > 1})
    if twice:
        raise ValueError(f"output columns named twice: {twice}")
    _check_internal(left, right)
    cols = [f"t1.{_q(c)}" for c in left_cols] + [f"t2.{_q(c)}" for c in right_cols] + [f"t1.{_q(lkey)}"]
    query = (
        f"SELECT {', '.join(cols)}\nFROM {{t1}} t1\nINNER JOIN {{t2}} t2\n"
        f"  ON t1.__jk = t2.{_q(rkey)}"
    )
    keyed = left.select("*", _aligned(F.col(_q(lkey)), _dtype(left, lkey), _dtype(right, rkey)).alias("__jk"))
    return spark.sql(query, t1=keyed, t2=right)


def json_get(df: DataFrame, json_col: str, field: str, out: str = "employee_number") -> DataFrame:
    """Append the text of top-level ``field`` of a JSON text column as ``out``
    (NULL for a missing field or malformed text)."""
    if out in df.columns and out != json_col:
        raise ValueError(f"column {out!r} already exists")
    return df.withColumn(out, json_value(json_col, field))


def enrich_hierarchy(
    primary: DataFrame,
    snapshot: DataFrame,
    json_col: str,
    field: str = "employee_number",
    right_key: str = "employeeid",
    out: str | None = None,
    strategy: str = "catalyst",
    only_where: Column | None = None,
    unique: bool = False,
    hot_share: float = SHARE,
) -> DataFrame:
    """Take ``field`` out of the primary's JSON column (as column ``out``,
    default the field name) and left-join the snapshot on it, keeping **all**
    snapshot columns. The extracted text is ``try_cast`` to the snapshot key's
    type, so a non-numeric value does not match instead of failing the job.
    ``only_where`` restricts matching to primary rows where it holds. A
    snapshot key that repeats (e.g. a renamed employee) multiplies primary
    rows; ``unique=True`` fails the job instead. ``strategy`` and ``hot_share`` are those
    of ``enrich``."""
    out = out or field
    snap_cols = list(snapshot.columns)
    with_no = json_get(primary, json_col, field, out)
    clash = [c for c in snapshot.columns if c in with_no.columns]
    if clash:
        raise ValueError(f"snapshot columns clash with primary columns: {clash}")
    _check_internal(primary, snapshot)
    if unique:
        others = [c for c in snapshot.columns if c != right_key]
        counted = snapshot.filter(F.col(_q(right_key)).isNotNull()).groupBy(F.col(_q(right_key)).alias(right_key)).agg(
            F.count(F.lit(1)).alias("__n"), *[F.first(_q(c)).alias(c) for c in others]
        )
        guard = F.when(F.col("__n") > 1, F.raise_error(F.lit(f"snapshot key {right_key} is not unique")))
        snapshot = counted.select(guard.otherwise(F.col(_q(right_key))).alias(right_key), *[F.col(_q(c)) for c in others])
        snapshot = snapshot.select(*[F.col(_q(c)) for c in snap_cols])
    right = _apply_strategy_frame(snapshot, right_key, strategy)
    left = with_no.alias(_L)
    r = right.alias(_R)
    lk = _aligned(_lcol(out), T.StringType(), _dtype(snapshot, right_key))
    if only_where is not None:
        lk = F.when(only_where, lk)
    outs = [*[_lcol(c) for c in with_no.columns], *[_rcol(c) for c in snapshot.columns]]
    return _left_outer(left, r, lk, _rcol(right_key), outs, strategy, hot_share)


def _apply_strategy_frame(right: DataFrame, key: str, strategy: str) -> DataFrame:
    if strategy not in STRATEGIES:
        raise ValueError(f"strategy must be one of {STRATEGIES}")
    if strategy in ("catalyst", "split"):
        return right
    if strategy == "shuffle":
        return right.hint("merge")
    keys = DEFAULT_MAX_KEYS if strategy == "auto" else None
    out, _prof = checked_broadcast(right, key=F.col(_q(key)), threshold=broadcast_threshold(right.sparkSession), max_keys=keys)
    return out


def with_indicator(
    df: DataFrame,
    lookup: DataFrame,
    on: str | tuple[str, str],
    code: str,
    out: str = "indicator",
    missing: str = "N",
    strategy: str = "catalyst",
) -> DataFrame:
    """Indicator column: the lookup's ``code`` where the row's key matches and
    the code is not NULL, else ``missing``. The lookup's columns are not kept."""
    return enrich(df, lookup, on, {out: code}, defaults=missing, strategy=strategy)


def common_columns(a: DataFrame, b: DataFrame) -> list[str]:
    """Column names present in both frames, in the order of ``a`` (no job)."""
    bset = set(b.columns)
    cols = [c for c in a.columns if c in bset]
    if not cols:
        log.warning("no common columns")
    return cols


def merge(
    a: DataFrame,
    b: DataFrame,
    on: Sequence[str] | None = None,
    null_safe: bool = False,
    skew_split: bool = True,
    unique: bool = False,
    same_keys: bool = False,
) -> DataFrame:
    """Full-outer merge of two frames on ``on`` (default: every common column).

    Output: the key columns once (the value of whichever side has the row),
    then the other columns of ``a``, then those of ``b``.

    ``null_safe=False`` is the plain USING join: NULL never equals NULL, so a
    row with a NULL in any key column comes out once per side, and n duplicate
    rows come out n × n times. ``null_safe=True`` compares with ``<=>``, so two
    enrichments of one duplicate-free frame merge back to its row count.

    ``skew_split=True`` (default) computes the same rows as an inner join plus
    the rows of each side whose key the other side lacks (two anti joins
    against the other side's distinct keys). Unlike a full-outer join, these
    joins let AQE split a hot key of either side over several tasks. Rows
    whose key can never match (a NULL key without ``null_safe``) are spread
    over all partitions by a hash of the row instead of meeting in one.
    ``skew_split=False`` plans one full-outer sort-merge join (also used for
    array, map or struct keys, and for keys whose type differs between the
    sides).

    ``unique=True`` fails the job when a key that can match repeats on either
    side, instead of emitting every pair of the repeated rows; the check rides
    on the key counts the skew-tolerant plan computes anyway.

    ``same_keys=True`` states that every key of one side is on the other too, as it is
    when both are left-join enrichments of one frame that reads the same each time. Then
    no side has rows of its own but those with a NULL key (none with ``null_safe``): the
    merge is an inner join and, for those rows, a filter, with no key sets and no anti
    joins. ``unique=True`` and equal non-key names use the plans above.

    Frames without a common column raise ``ValueError``: a cross product is not
    offered.
    """
    keys = list(on) if on is not None else common_columns(a, b)
    if not keys:
        raise ValueError("no common columns to merge on (a cross product is not offered)")
    missing = [k for k in keys if k not in a.columns or k not in b.columns]
    if missing:
        raise ValueError(f"merge columns missing on one side: {missing}")
    _check_internal(a, b)
    kset = set(keys)
    a_rest = [c for c in a.columns if c not in kset]
    b_rest = [c for c in b.columns if c not in kset]
    if same_keys and not unique and not set(a_rest) & set(b_rest):
        return _merge_same_keys(a, b, keys, a_rest, b_rest, null_safe)
    if set(a_rest) & set(b_rest):
        if unique:
            raise ValueError(f"unique=True needs distinct output names: {sorted(set(a_rest) & set(b_rest))} are on both sides")
        if skew_split:
            log.info("merge: equal non-key names, planned as one full outer join without splitting hot keys")
        skew_split = False  # duplicate output names: keep Spark's USING semantics
    complex_keys = any(isinstance(_dtype(df, k), _COMPLEX) for df in (a, b) for k in keys)
    if not complex_keys and (skew_split or unique):
        a, b = _same_key_types(a, b, keys)
    mixed_types = any(_dtype(a, k) != _dtype(b, k) for k in keys)
    if complex_keys or mixed_types:
        # nested or NULL-typed keys, and types without a common one, use the plain plan
        if unique:
            raise ValueError("unique=True needs scalar merge keys of comparable types on both sides")
        if skew_split:
            log.info("merge: nested or incomparable keys, planned as one full outer join without splitting hot keys")
        skew_split = False
    if skew_split or unique:
        return _merge_split(a, b, keys, a_rest, b_rest, null_safe, unique)
    if not null_safe:
        return a.join(b, keys, "full_outer")
    la, rb = a.alias(_L), b.alias(_R)
    cond = functools.reduce(lambda x, y: x & y, [_lcol(k).eqNullSafe(_rcol(k)) for k in keys])
    joined = la.join(rb, cond, "full_outer")
    return joined.select(
        *[F.coalesce(_lcol(k), _rcol(k)).alias(k) for k in keys],
        *[_lcol(c) for c in a_rest],
        *[_rcol(c) for c in b_rest],
    )


def _merge_same_keys(a, b, keys, a_rest, b_rest, null_safe):
    """The merge of two sides with the same keys: matched pairs, and the rows whose NULL
    key matches nothing. AQE can split a hot key of either side in the inner join."""
    la, rb = a.alias(_L), b.alias(_R)
    equal = (lambda k: _lcol(k).eqNullSafe(_rcol(k))) if null_safe else (lambda k: _lcol(k) == _rcol(k))
    cond = functools.reduce(lambda x, y: x & y, [equal(k) for k in keys])
    both = la.join(rb, cond, "inner").select(
        *[F.coalesce(_lcol(k), _rcol(k)).alias(k) for k in keys], *[_lcol(c) for c in a_rest], *[_rcol(c) for c in b_rest])
    if null_safe:
        return both
    any_null = functools.reduce(lambda x, y: x | y, [F.col(_q(k)).isNull() for k in keys])

    def alone(df: DataFrame, own: Sequence[str]) -> DataFrame:
        have = set(own)
        rest = [(c, _dtype(a if c in a_rest else b, c)) for c in [*a_rest, *b_rest]]
        return df.filter(any_null).select(
            *[F.col(_q(k)) for k in keys],
            *[F.col(_q(c)) if c in have else F.lit(None).cast(t).alias(c) for c, t in rest])

    return both.unionByName(alone(a, a_rest)).unionByName(alone(b, b_rest))


_COMPLEX = (T.ArrayType, T.MapType, T.StructType, T.NullType)
_NUMBERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType)


def _same_key_types(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Both sides with keys of different numeric types cast to the type Spark widens them
    to, so that they can be split like others. Other pairs stay as they are."""
    wider: dict[str, T.DataType] = {}
    for k in keys:
        ta, tb = _dtype(a, k), _dtype(b, k)
        if ta != tb and isinstance(ta, _NUMBERS) and isinstance(tb, _NUMBERS):
            at, bt = (next(i for i, n in enumerate(_NUMBERS) if isinstance(t, n)) for t in (ta, tb))
            whole = min(at, bt) <= 3 < max(at, bt)
            # a long against a float widens to double
            wider[k] = T.DoubleType() if whole and (max(at, bt) == 5 or min(at, bt) >= 2) else _NUMBERS[max(at, bt)]()
    if not wider:
        return a, b

    def cast(df: DataFrame) -> DataFrame:
        return df.select(*[F.col(_q(c)).cast(wider[c]).alias(c) if c in wider else F.col(_q(c)) for c in df.columns])

    return cast(a), cast(b)


def _has_map(dt: T.DataType) -> bool:
    """Map values cannot be hashed by Spark's hash functions."""
    if isinstance(dt, T.MapType):
        return True
    if isinstance(dt, T.ArrayType):
        return _has_map(dt.elementType)
    if isinstance(dt, T.StructType):
        return any(_has_map(f.dataType) for f in dt.fields)
    return False


def _sentinel(dt: T.DataType) -> Column:
    """Any non-NULL value of the type (stands in for NULL inside a join key
    whose NULL-ness is carried by a separate tag)."""
    if isinstance(dt, _COMPLEX):
        raise TypeError("complex merge keys use the plain full-outer plan")
    if isinstance(dt, T.BooleanType):
        return F.lit(False)
    if isinstance(dt, (T.StringType, T.BinaryType)):
        return F.lit("").cast(dt)
    if isinstance(dt, T.DateType):
        return F.lit("1970-01-01").cast(dt)
    if isinstance(dt, (T.TimestampType, T.TimestampNTZType)):
        return F.lit("1970-01-01 00:00:00").cast(dt)
    return F.lit(0).cast(dt)


def _key_type(dt: T.DataType) -> T.DataType:
    return T.StringType() if isinstance(dt, (T.FloatType, T.DoubleType)) else dt


def _join_value(c: Column, dt: T.DataType) -> Column:
    """A floating-point key as its exact text, with NaN and -0.0 made canonical
    (the equality Spark's joins use). Keeping float keys out of the join lets a
    pre-aggregated side keep the partitioning the join needs."""
    if isinstance(dt, (T.FloatType, T.DoubleType)):
        return F.when(F.isnan(c), F.lit("NaN")).when(c == 0, F.lit("0.0")).otherwise(c.cast("string"))
    return c


#: More merge keys than this meet by a digest of them.
DIGEST_KEYS = 16


def _key_parts(c: Column, dt: T.DataType) -> tuple[Column, Column | None] | None:
    """A key as a whole number (NULL for NULL) and, for kinds that are no whole numbers, the
    bytes of which the number is the length; None for types without such a form."""
    if isinstance(dt, (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.BooleanType)):
        return c.cast("long"), None
    if isinstance(dt, T.DateType):
        return F.unix_date(c).cast("long"), None
    if isinstance(dt, T.TimestampType):
        return F.unix_micros(c), None
    if isinstance(dt, T.StringType):
        if getattr(dt, "collation", "UTF8_BINARY") != "UTF8_BINARY":
            return None
    elif isinstance(dt, (T.NumericType, T.TimestampNTZType)):
        c = _join_value(c, dt).cast("string")
    elif not isinstance(dt, T.BinaryType):
        return None
    return F.octet_length(c).cast("long"), F.coalesce(c.cast("binary"), F.lit(b""))


def _digest(df: DataFrame, keys: Sequence[str]) -> Column | None:
    """128 bits of SHA-256 over all keys, never NULL; None if there are few keys or one has
    no bytes. So a shuffle carries 16 bytes, not every key twice and its NULL flag.

    The whole numbers and lengths go in as one JSON array, whose end is its first ``]``, the
    bytes follow: different keys give different input. The digest is computed ``apart``, as
    an expression over so many columns is too long to be compiled in one method."""
    if len(keys) <= DIGEST_KEYS:
        return None
    parts = [_key_parts(F.col(_q(k)), _dtype(df, k)) for k in keys]
    if any(p is None for p in parts):
        return None
    numbers = F.to_json(F.array(*[n for n, _ in parts])).cast("binary")
    whole = F.concat(numbers, *[text for _, text in parts if text is not None])
    return F.coalesce(apart(F.substring(F.unhex(F.sha2(whole, 256)), 1, 16), F.lit(b"")), F.lit(b""))


def _merge_keys(df: DataFrame, keys: Sequence[str], null_safe: bool, side: int) -> DataFrame:
    """Append non-nullable join-key columns ``__m0..`` (of many keys one digest, ``__md``)
    and a tag ``__mt``.

    With ``null_safe`` a flag ``__z<i>`` beside each key tells whether it is NULL (so
    NULL matches NULL), however many keys there are. Otherwise a row with any NULL key can never match: its tag is a hash
    of the whole row, positive on side 1 and negative on side 2, so such rows
    match nothing and spread over all partitions."""
    types = {f.name: f.dataType for f in df.schema.fields}
    cols = [F.coalesce(_join_value(F.col(_q(k)), types[k]), _sentinel(_key_type(types[k]))).alias(f"__m{i}")
            for i, k in enumerate(keys)]
    digest = _digest(df, keys)
    if digest is not None:
        cols = [digest.alias("__md")]
        if null_safe:  # NULL is in the digest, every key can match
            return df.select("*", *cols)
    flags: list[Column] = []
    if null_safe:
        tag = F.lit(0).cast("long")
        flags = [F.col(_q(k)).isNull().alias(f"__z{i}") for i, k in enumerate(keys)]
    else:
        any_null = functools.reduce(lambda x, y: x | y, [F.col(_q(k)).isNull() for k in keys])
        hashable = [F.col(_q(f.name)) for f in df.schema.fields if not _has_map(f.dataType)]
        h = F.coalesce(F.pmod(F.xxhash64(*hashable), F.lit((1 << 62) - 1)), F.lit(0)) + F.lit(1)
        tag = F.when(any_null, h if side == 1 else -h).otherwise(F.lit(0).cast("long"))
    return df.select("*", *cols, *flags, tag.alias("__mt"))


def _fail_on_repeats(key_counts: DataFrame, names: Sequence[str], side: str, null_safe: bool) -> DataFrame:
    """The key set with a guard on its first key column: the job fails when a
    key that can match occurs more than once. Without ``null_safe`` only tag 0
    keys can match (a non-zero tag marks a NULL key); with it every key can."""
    repeated = F.col("__n") > 1
    if not null_safe:
        repeated = repeated & (F.col("__mt") == 0)
    first = names[0]
    guarded = F.when(repeated, F.raise_error(F.lit(f"merge key repeats on side {side}"))).otherwise(F.col(first))
    return key_counts.select(guarded.alias(first), *[F.col(n) for n in names[1:]], "__n")


def _merge_split(a, b, keys, a_rest, b_rest, null_safe, unique=False):
    """``a ⋈ b`` (matched pairs) ∪ ``a ▷ keys(b)`` ∪ ``b ▷ keys(a)`` (rows of
    one side whose key the other side lacks).

    AQE may split a hot key of either side in the inner join, and of the
    streamed side in each anti join. The other side of an anti join is the
    ``distinct`` set of keys, aggregated map-side first, so a hot key reaches
    its reducer as about one row per map task. Each side's full rows are
    shuffled once and shared by its inner and anti join (both read the side's
    key columns, the inner join through the coalesce)."""
    ka = _merge_keys(a, keys, null_safe, 1).alias(_L)
    kb = _merge_keys(b, keys, null_safe, 2).alias(_R)
    added = [c for c in ka.columns if c not in set(a.columns)]
    names = [*(c for c in added if not c.startswith("__z")), *(c for c in added if c.startswith("__z"))]
    cond = functools.reduce(lambda x, y: x & y, [_lcol(n) == _rcol(n) for n in names])
    atypes = {f.name: f.dataType for f in a.schema.fields}
    btypes = {f.name: f.dataType for f in b.schema.fields}
    # groupBy (not distinct) keeps the key order, so the aggregate's shuffle
    # already has the partitioning the anti join needs
    if len(names) == 1 and not unique:  # one column has but one order, and nobody counts
        a_keys, b_keys = ka.select(_lcol(names[0])).distinct(), kb.select(_rcol(names[0])).distinct()
    else:
        a_keys = ka.groupBy(*[_lcol(n) for n in names]).agg(F.count(F.lit(1)).alias("__n"))
        b_keys = kb.groupBy(*[_rcol(n) for n in names]).agg(F.count(F.lit(1)).alias("__n"))
    if unique:
        a_keys = _fail_on_repeats(a_keys, names, "a", null_safe)
        b_keys = _fail_on_repeats(b_keys, names, "b", null_safe)
    a_keys, b_keys = a_keys.alias(_L), b_keys.alias(_R)
    both = ka.join(kb, cond, "inner").select(
        *[F.coalesce(_lcol(k), _rcol(k)).alias(k) for k in keys], *[_lcol(c) for c in a_rest], *[_rcol(c) for c in b_rest]
    )

    def lacking(df, others, missing):
        if "__md" not in names:
            return df.join(others, cond, "left_anti")
        # Spark moves an anti join with a small key set below an aggregate, where each row's digest is
        # computed anew. A digest is never NULL, so this has the same rows
        return df.join(others, cond, "left_outer").filter(missing("__md").isNull())

    only_a = lacking(ka, b_keys, _rcol).select(
        *[_lcol(k).alias(k) for k in keys], *[_lcol(c) for c in a_rest],
        *[F.lit(None).cast(btypes[c]).alias(c) for c in b_rest],
    )
    only_b = lacking(kb, a_keys, _lcol).select(
        *[_rcol(k).alias(k) for k in keys], *[F.lit(None).cast(atypes[c]).alias(c) for c in a_rest],
        *[_rcol(c) for c in b_rest],
    )
    return both.unionByName(only_a).unionByName(only_b)
