"""Parquet folders whose files differ in columns or types (V1, S2)."""

from __future__ import annotations

import functools
from collections import defaultdict

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .readers import _not_found
from .schema import SchemaLike, schema_from_spec

_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def wider(a: T.DataType, b: T.DataType) -> T.DataType | None:
    """The type that holds every value of both exactly, ``None`` if there is none: whole
    numbers and floats by size, whole numbers up to 32 bits as doubles, decimals with all
    their digits, dates as timestamps."""
    if a == b:
        return a
    for x, y in ((a, b), (b, a)):
        if isinstance(x, _WHOLE) and isinstance(y, _WHOLE):
            return max(x, y, key=lambda t: [type(t) is w for w in _WHOLE].index(True))
        if isinstance(x, T.FloatType) and isinstance(y, T.DoubleType):
            return y
        if isinstance(x, _WHOLE[:3]) and isinstance(y, T.DoubleType):
            return y
        if isinstance(x, T.DecimalType) and isinstance(y, T.DecimalType):
            scale = max(x.scale, y.scale)
            digits = max(x.precision - x.scale, y.precision - y.scale) + scale
            return T.DecimalType(digits, scale) if digits <= 38 else None
        if isinstance(x, T.DateType) and isinstance(y, T.TimestampNTZType):
            return y
    return None


def _listed(spark: SparkSession, path: str) -> dict[str, list[str]]:
    """Parquet files by folder, from Spark's listing; no content is read."""
    try:
        found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(path).select("path")
        folders: dict[str, list[str]] = defaultdict(list)
        for r in found.toLocalIterator():
            folders[r.path.rpartition("/")[0]].append(r.path)
        return folders
    except AnalysisException as e:
        if _not_found(e):
            raise FileNotFoundError(f"path does not exist: {path}") from e
        raise


def scan_mixed(spark: SparkSession, path: str, schema: SchemaLike | None = None, every_file: bool = False) -> tuple[DataFrame, list[dict]]:
    """A folder of Parquet files as one typed frame, and a report of what differed.

    Files are grouped by their schema: one footer a folder is read, since a write makes all
    files of a folder alike, or with ``every_file`` one a file. Each group is read with its
    own schema, conformed and united by name: a column that a group lacks is NULL there, and
    a column whose type differs is cast to the type that holds all of them (``wider``).
    Without ``schema`` the columns are those of all groups, in order of first appearance;
    with it those are taken that it names, cast to its types, and the job fails
    (``ValueError``, before anything is read) if a cast could lose values. Types without a
    common one raise ``ValueError``. Every group keeps its own pushed filters and pruned
    columns.

    The report has a dict for each group, in order of path: ``files``, ``folders``,
    ``missing`` columns, ``cast`` columns (name, from, to) and ``ignored`` ones."""
    folders = _listed(spark, path)
    if not folders:
        raise FileNotFoundError(f"no Parquet file under {path}")
    groups: dict[str, dict] = {}
    for folder in sorted(folders):
        files = sorted(folders[folder])
        for one in files if every_file else files[:1]:
            read = spark.read.parquet(one).schema
            group = groups.setdefault(read.json(), {"schema": read, "paths": [], "files": 0})
            group["paths"].append(one if every_file else folder)
            group["files"] += 1 if every_file else len(files)
    target: dict[str, T.DataType] = {f.name: f.dataType for f in schema_from_spec(schema).fields} if schema is not None else {}
    given = set(target)
    for group in groups.values():
        for f in group["schema"].fields:
            if given and f.name not in given:
                continue
            common = wider(target.get(f.name, f.dataType), f.dataType)
            if common is None or (given and common != target[f.name]):
                raise ValueError(f"column {f.name}: {f.dataType.simpleString()} in {group['paths'][0]} does not fit {target[f.name].simpleString()}")
            target[f.name] = common
    parts, report = [], []
    for group in groups.values():
        have = {f.name: f.dataType for f in group["schema"].fields}
        df = spark.read.schema(group["schema"]).parquet(*group["paths"])
        name = lambda c: F.col("`" + c.replace("`", "``") + "`")
        parts.append(df.select(*[(name(c).cast(t) if c in have else F.lit(None).cast(t)).alias(c) for c, t in target.items()]))
        report.append({
            "files": group["files"], "folders": sorted({p if not every_file else p.rpartition("/")[0] for p in group["paths"]}),
            "missing": [c for c in target if c not in have],
            "cast": [(c, have[c].simpleString(), t.simpleString()) for c, t in target.items() if c in have and have[c] != t],
            "ignored": [c for c in have if c not in target],
        })
    return functools.reduce(DataFrame.unionByName, parts), report
