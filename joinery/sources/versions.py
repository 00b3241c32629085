"""Outputs as versions: every write goes to a folder of its own, and a manifest row, written
after it, makes it the current one (K1, W1).

Readers follow the manifest, so a write that fails or is still running is never seen, and
what was readable stays so: no output is deleted before its successor is finished. The rows
of the manifest also say what an output was made from, so a job that is started again can
tell what is finished already. Everything goes through Spark's readers and writers; the
folder can be in any store they reach."""

from __future__ import annotations

import datetime as dt
import hashlib
import json
import logging
import uuid
from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F

from .readers import _not_found
from .sinks import dated_path

log = logging.getLogger(__name__)

MANIFEST = "version string, seq long, data string, rows long, inputs string, config string, written timestamp"


def _folder(base: str, name: str, as_of: dt.date | dt.datetime | str) -> tuple[str, str]:
    path = dated_path(base, name, as_of)
    return path, f"{path}/manifest"


def versions(spark: SparkSession, base: str, name: str, as_of: dt.date | dt.datetime | str) -> list[Row]:
    """The manifest rows of an output, the current one first; none if it was never finished."""
    _, manifest = _folder(base, name, as_of)
    try:
        rows = spark.read.schema(MANIFEST).json(manifest).filter("version IS NOT NULL").collect()
    except AnalysisException as e:
        if _not_found(e):
            return []
        raise
    return sorted(rows, key=lambda r: (r.seq, r.version), reverse=True)


def write_version(
    df: DataFrame,
    base: str,
    name: str,
    as_of: dt.date | dt.datetime | str,
    inputs: str | None = None,
    config: str | None = None,
    partition_by: Sequence[str] = (),
) -> Row:
    """Write ``df`` as a new version of ``{base}/{name}_{YYYYMMDD}`` and make it the current
    one; returns its manifest row. ``rows`` is counted by the write itself. ``inputs`` and
    ``config`` are what ``finished`` compares."""
    spark = df.sparkSession
    dupes = {c for c in df.columns if df.columns.count(c) > 1}
    if dupes:
        raise ValueError(f"duplicate output columns {sorted(dupes)}")
    path, manifest = _folder(base, name, as_of)
    before = versions(spark, base, name, as_of)
    version = uuid.uuid4().hex
    data = f"{path}/data/{version}"
    seen = Observation()
    writer = df.observe(seen, F.count(F.lit(1)).alias("rows")).write
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(data)
    row = Row(version=version, seq=(before[0].seq if before else 0) + 1, data=data, rows=seen.get["rows"], inputs=inputs, config=config, written=dt.datetime.now())
    # one file that appears when its write is committed: the switch
    spark.createDataFrame([row], MANIFEST).coalesce(1).write.mode("append").json(manifest)
    return row


def read_version(spark: SparkSession, base: str, name: str, as_of: dt.date | dt.datetime | str, version: str | None = None) -> DataFrame:
    """The current version of an output, or the one named. ``FileNotFoundError`` if there is
    none that was finished."""
    known = [r for r in versions(spark, base, name, as_of) if version in (None, r.version)]
    if not known:
        raise FileNotFoundError(f"no finished version of {dated_path(base, name, as_of)}")
    return spark.read.parquet(known[0].data)


def finished(spark: SparkSession, base: str, name: str, as_of: dt.date | dt.datetime | str, inputs: str | None, config: str | None) -> Row | None:
    """The current version if it was made from these ``inputs`` and this ``config`` and holds
    as many rows as were written; otherwise ``None``, as for inputs that cannot be told
    (``None``)."""
    known = versions(spark, base, name, as_of)
    if not known or inputs is None or (known[0].inputs, known[0].config) != (inputs, config):
        return None
    try:
        rows = spark.read.parquet(known[0].data).count()  # from the footers
    except AnalysisException:
        return None
    if rows != known[0].rows:
        log.warning("%s holds %d rows, %d were written: made again", known[0].data, rows, known[0].rows)
        return None
    return known[0]


def drop_old_versions(spark: SparkSession, base: str, name: str, as_of: dt.date | dt.datetime | str, keep: int = 1) -> list[str]:
    """Delete the data of all but the ``keep`` newest versions; returns their folders. Only
    for when no reader is on them any more."""
    if keep < 1:
        raise ValueError("the current version stays")
    gone = []
    for row in versions(spark, base, name, as_of)[keep:]:
        where = spark._jvm.org.apache.hadoop.fs.Path(row.data)
        if where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True):
            gone.append(row.data)
    return gone


def config_digest(config: Mapping[str, Any]) -> str:
    """A digest of plain settings (frames and other objects count by their type)."""
    return hashlib.sha256(json.dumps(config, sort_keys=True, default=lambda x: type(x).__name__).encode()).hexdigest()


def _plan_text(df: DataFrame) -> str:
    """The analysed plan without the ids that differ from run to run, all fields named.
    (``semanticHash`` differs between processes.)"""
    limit, spark = "spark.sql.debug.maxToStringFields", df.sparkSession
    before = spark.conf.get(limit)
    spark.conf.set(limit, "100000")
    try:
        return df._jdf.queryExecution().analyzed().canonicalized().toString()
    finally:
        spark.conf.set(limit, before)


def input_fingerprint(*frames: DataFrame) -> str | None:
    """What the frames read: path, size and time of change of every file, and the plans over
    them. ``None`` if one reads no files (rows made in memory): nothing tells whether they
    changed. The files are listed by Spark, none is read; the digest is made by an
    aggregate."""
    parts = []
    for df in frames:
        files = df.inputFiles()
        if not files:
            return None
        spark = df.sparkSession
        listed = spark.read.format("binaryFile").load(files).select("path", "modificationTime", "length")
        row = listed.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64(*listed.columns)).alias("a"),
                         F.sum(F.xxhash64(F.lit(1), *listed.columns).cast("decimal(38,0)")).cast("string").alias("b")).first()
        parts.append([row.n, row.a, row.b, _plan_text(df)])
    return hashlib.sha256(json.dumps(parts).encode()).hexdigest()
