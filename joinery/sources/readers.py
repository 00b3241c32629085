"""Sources: Parquet files or folders, CSV with a declared schema, catalog tables,
or a frame passed straight through (S1-S6, S8, S10)."""

from __future__ import annotations

import logging

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .schema import SchemaLike, assert_schema, schema_from_spec

log = logging.getLogger(__name__)

_CSV_SUFFIXES = (".csv", ".csv.gz", ".txt")


def _not_found(e: AnalysisException) -> bool:
    cond = getattr(e, "getCondition", None) or getattr(e, "getErrorClass", None)
    code = cond() if cond else None
    return code == "PATH_NOT_FOUND" or "PATH_NOT_FOUND" in str(e)


def _holds_parquet(spark: SparkSession, path: str) -> bool:
    """Does the folder hold at least one ``*.parquet`` file, itself or in ``name=value``
    folders? Spark's own file listing (``binaryFile`` with only the path column, so no
    content is read) descends into partition folders and no others."""
    listing = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.parquet")
        .load(path)
        .select("path")
    )
    return listing.limit(1).count() > 0


def detect_format(spark: SparkSession, path: str) -> str:
    """``parquet`` for a ``.parquet`` path or a folder holding Parquet files,
    ``csv`` otherwise. A missing path raises ``FileNotFoundError``."""
    low = path.lower().rstrip("/")
    if low.endswith(".parquet"):
        return "parquet"
    if low.endswith(_CSV_SUFFIXES):
        return "csv"
    try:
        return "parquet" if _holds_parquet(spark, path) else "csv"
    except AnalysisException as e:
        if _not_found(e):
            raise FileNotFoundError(f"path does not exist: {path}") from e
        raise


def scan(
    spark: SparkSession,
    source: str | DataFrame,
    schema: SchemaLike | None = None,
    format: str = "auto",  # noqa: A002 - mirrors DataFrameReader.format
    by_position: bool = False,
    bad_records: str = "null",
    check_nullable: bool = False,
    options: dict[str, str] | None = None,
) -> DataFrame:
    """Load a source as a frame.

    * ``DataFrame``: passed through.
    * Parquet file or folder: the file schema is used; when ``schema`` is given
      the frame must match it (names, order, types; nullability only on request).
    * anything else is CSV with a header row and needs ``schema``
      (``ValueError`` without one). The header must name the schema's columns
      in order unless ``by_position=True``; a value that does not parse becomes
      NULL, or fails the job with ``bad_records="fail"``. Blanks around values
      are kept. ``options`` are further CSV reader options (e.g. ``nullValue``;
      ``multiLine`` for texts with line ends, written with ``multi_line=True``).

    A missing path raises ``FileNotFoundError``; another source type ``ValueError``.
    Errors are logged before they propagate.
    """
    try:
        return _scan(spark, source, schema, format, by_position, bad_records, check_nullable, options)
    except Exception as e:
        log.error("failed to load %r: %s", source if isinstance(source, str) else type(source).__name__, e)
        raise


def _scan(spark, source, schema, format, by_position, bad_records, check_nullable, options):  # noqa: A002
    if isinstance(source, DataFrame):
        df = source
    elif isinstance(source, str):
        fmt = detect_format(spark, source) if format == "auto" else format
        try:
            if fmt == "parquet":
                df = spark.read.parquet(source)
            elif fmt == "csv":
                if schema is None:
                    raise ValueError("a schema must be given for CSV sources")
                reader = (
                    spark.read.schema(schema_from_spec(schema))
                    .option("header", True)
                    .option("enforceSchema", by_position)
                    .option("mode", "FAILFAST" if bad_records == "fail" else "PERMISSIVE")
                )
                for k, v in (options or {}).items():
                    reader = reader.option(k, v)
                df = reader.csv(source)
            else:
                df = spark.read.format(fmt).load(source)
        except AnalysisException as e:
            if _not_found(e):
                raise FileNotFoundError(f"path does not exist: {source}") from e
            raise
    else:
        raise ValueError("source must be a path (str) or a DataFrame")
    if schema is not None:
        assert_schema(df, schema, check_nullable=check_nullable)
    return df


#: The column that holds the text of a line that does not parse.
BAD_LINE = "_bad_line"


def scan_with_quarantine(
    spark: SparkSession,
    source: str,
    schema: SchemaLike,
    quarantine: str,
    by_position: bool = False,
    options: dict[str, str] | None = None,
    most_bad: float | None = None,
) -> tuple[DataFrame, dict[str, int]]:
    """The rows of a CSV source that parse, and ``{"good": n, "bad": n}``; the others are
    written to ``{quarantine}/bad`` as Parquet, a row each: the line's text, its file and the time.

    A line is bad if a value does not parse as its type or if it has too few or too many
    values; good + bad are the lines of the files (records, with ``multiLine``), header and
    empty lines aside. Both parts come from one read, so they cannot disagree; it counts
    them as well. That read writes all lines by kind under ``{quarantine}/lines``, from where
    the good rows come, so later use does not parse again, and the bad ones go to
    ``{quarantine}/bad``. The folder must be new. With ``most_bad`` the call
    fails (``ValueError``) when a larger share of the lines is bad; the bad lines are kept for
    a look at them."""
    expected = schema_from_spec(schema)
    if BAD_LINE in expected.names:
        raise ValueError(f"{BAD_LINE} is the name of the bad lines' column")
    # all columns are parsed whatever is selected later: what is bad does not depend on it
    reader = (
        spark.read.schema(T.StructType([*expected.fields, T.StructField(BAD_LINE, T.StringType())]))
        .option("header", True).option("enforceSchema", by_position).option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", BAD_LINE).option("columnPruning", "false")
    )
    for k, v in (options or {}).items():
        reader = reader.option(k, v)
    place = quarantine.rstrip("/")
    bad = F.col(BAD_LINE).isNotNull()
    counts = Observation()
    try:
        lines = reader.csv(source).withColumn("__file", F.input_file_name())
    except AnalysisException as e:
        if _not_found(e):
            raise FileNotFoundError(f"path does not exist: {source}") from e
        raise
    lines = lines.observe(counts, F.count(F.when(~bad, 1)).alias("good"), F.count(F.when(bad, 1)).alias("bad"))
    lines.withColumn("__bad", bad).write.partitionBy("__bad").parquet(f"{place}/lines")
    kept = T.StructType([*expected.fields, T.StructField(BAD_LINE, T.StringType()), T.StructField("__file", T.StringType()), T.StructField("__bad", T.BooleanType())])
    whole = spark.read.schema(kept).parquet(f"{place}/lines")
    whole.filter("__bad").select(F.col(BAD_LINE).alias("line"), F.col("__file").alias("file"), F.current_timestamp().alias("at")).write.parquet(f"{place}/bad")
    good = whole.filter("NOT __bad").select(*[F.col("`" + c.replace("`", "``") + "`") for c in expected.names])
    found = {k: counts.get[k] for k in ("good", "bad")}
    if found["bad"]:
        log.warning("%d of %d lines of %s are bad, kept in %s/bad", found["bad"], sum(found.values()), source, place)
    if most_bad is not None and found["bad"] > most_bad * sum(found.values()):
        raise ValueError(f"{found['bad']} of {sum(found.values())} lines of {source} are bad, more than {most_bad:.2%}")
    return good, found


def scan_table(spark: SparkSession, name: str, schema: SchemaLike | None = None) -> DataFrame:
    """A catalog table by (qualified) name, optionally checked against a schema."""
    df = spark.table(name)
    if schema is not None:
        assert_schema(df, schema)
    return df
