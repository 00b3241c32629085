"""Sinks: date-stamped Parquet overwrite, bucketed tables and CSV with a header (K1, K2).

Both are plain Spark writes: the file commit protocol makes a finished write
all-or-nothing, and failed tasks are retried on other executors."""

from __future__ import annotations

import datetime as dt
import re
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_NAME = re.compile(r"^[A-Za-z0-9_.-]+$")


def dated_path(base: str, name: str, as_of: dt.date | dt.datetime | str) -> str:
    """``{base}/{name}_{YYYYMMDD}``. ``base`` is a full URI or path and is used as
    given; ``as_of`` is explicit so a rerun writes the same place."""
    if not base:
        raise ValueError("base path is empty")
    if not _NAME.match(name):
        raise ValueError(f"bad output name {name!r}")
    if isinstance(as_of, str):
        stamp = dt.date.fromisoformat(as_of).strftime("%Y%m%d")
    else:
        stamp = as_of.strftime("%Y%m%d")
    return f"{base.rstrip('/')}/{name}_{stamp}"


def write_dated(
    df: DataFrame,
    base: str,
    name: str,
    as_of: dt.date | dt.datetime | str,
    format: str = "parquet",  # noqa: A002
    mode: str = "overwrite",
    partition_by: list[str] | None = None,
    replace: str = "all",
) -> str:
    """Write ``df`` to ``{base}/{name}_{YYYYMMDD}`` (overwrite by default) and
    return the path. Output names must be unique (Parquet rejects duplicates).

    ``replace="partitions"`` overwrites only the partitions (``partition_by``) that ``df``
    has rows for. An overwrite deletes before it commits: where readers must not see that,
    use ``write_version``."""
    if replace not in ("all", "partitions") or (replace == "partitions" and not partition_by):
        raise ValueError("replace is 'all', or 'partitions' together with partition_by")
    dupes = {c for c in df.columns if df.columns.count(c) > 1}
    if dupes:
        raise ValueError(f"duplicate output columns {sorted(dupes)}")
    path = dated_path(base, name, as_of)
    w = df.write.mode(mode).format(format)
    if format == "csv":
        w = (w.option("header", True)
             .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False))
    if partition_by:
        w = w.partitionBy(*partition_by).option("partitionOverwriteMode", "dynamic" if replace == "partitions" else "static")
    w.save(path)
    return path


#: Reader options for CSV written with ``multi_line=True``.
MULTI_LINE = {"multiLine": "true", "escape": '"', "lineSep": "\n"}


def _one_line(field: T.StructField) -> Column:
    c = F.col("`" + field.name.replace("`", "``") + "`")
    if not isinstance(field.dataType, T.StringType):
        return c
    fail = F.raise_error(F.lit(f"column {field.name} holds a line end: write it with multi_line=True"))
    return F.when(c.contains("\n") | c.contains("\r"), fail).otherwise(c).alias(field.name)


def write_csv(
    df: DataFrame,
    path: str,
    mode: str = "errorifexists",
    header: bool = True,
    options: dict[str, str] | None = None,
    multi_line: bool = False,
) -> str:
    """CSV with a header row; by default fails if the path exists.

    Leading and trailing blanks of text values are kept (Spark's writer trims
    them by default). With Spark's default markers an empty string reads back
    as NULL; pass e.g. ``options={"nullValue": "\\N"}`` here and to ``scan``
    to keep the two apart.

    A text with a line end would read back as two rows: the job fails on one, unless
    ``multi_line=True``; then quotes are doubled, every text is quoted, and the file
    must be read with ``MULTI_LINE`` in the options of ``scan``."""
    if multi_line:
        options = {**MULTI_LINE, "quoteAll": "true", **(options or {})}
    else:
        df = df.select(*[_one_line(f) for f in df.schema.fields])
    w = (df.write.mode(mode).option("header", header)
         .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False))
    for k, v in (options or {}).items():
        w = w.option(k, v)
    w.csv(path)
    return path


def write_bucketed(df: DataFrame, name: str, keys: Sequence[str], buckets: int, path: str) -> str:
    """Save ``df`` as the external catalog table ``name`` under ``path``, bucketed and sorted
    by ``keys``; returns the name. Joins and aggregates on ``keys`` then read the table
    without a shuffle: a daily enrichment of it shuffles its lookup alone, and two tables
    with the same buckets meet as they lie.

    Rows are dealt to the buckets before the write, so each bucket is one file and not one
    per task. A table that exists keeps its old rows until the new ones are written, under a
    folder of their own, and then takes their location: readers never see a gap. Its columns
    and buckets must be the same (``ValueError``)."""
    spark = df.sparkSession
    place = f"{path.rstrip('/')}/{uuid.uuid4().hex}"

    def save(table: str) -> None:
        dealt = df.repartition(buckets, *keys)
        dealt.write.format("parquet").bucketBy(buckets, *keys).sortBy(*keys).option("path", place).saveAsTable(table)

    if not spark.catalog.tableExists(name):
        save(name)
        return name
    old = spark.table(name).schema
    if [(f.name, f.dataType) for f in old.fields] != [(f.name, f.dataType) for f in df.schema.fields]:
        raise ValueError(f"table {name} has other columns: {old.simpleString()}")
    had = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE EXTENDED {name}").collect()}
    listed = "[" + ", ".join(f"`{k}`" for k in keys) + "]"
    if (had.get("Num Buckets"), had.get("Bucket Columns")) != (str(buckets), listed):
        raise ValueError(f"table {name} has other buckets: {had.get('Num Buckets')} of {had.get('Bucket Columns')}")
    fresh = f"{name}__{uuid.uuid4().hex}"
    save(fresh)
    spark.sql(f"ALTER TABLE {name} SET LOCATION '{place}'")
    spark.sql(f"DROP TABLE {fresh}")  # external: its files stay
    spark.catalog.refreshTable(name)
    return name
