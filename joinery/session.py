"""Session helpers: a local session for tests and benches, and the shared folder
that jobs use to cut lineage (``spark.checkpoint.dir``)."""

from __future__ import annotations

import atexit
import logging
import tempfile
import uuid

from pyspark.sql import SparkSession

log = logging.getLogger(__name__)


def recommended_conf(shuffle_partitions: int = 8) -> dict[str, str]:
    """Settings the operators are designed around (a cluster deployment sets
    ``spark.sql.shuffle.partitions`` to its own scale, e.g. a few thousand for
    tens of TB; AQE then coalesces small partitions).

    * AQE on, with partition coalescing and skew-join splitting: a hot key on
      the primary side of a left-outer join is split over several tasks.
    * ``fileCompressionFactor`` 4: Catalyst's static size estimate of a Parquet
      scan is its compressed file size; scaling it up keeps a lookup whose
      decoded size exceeds the broadcast limit from being broadcast on an
      under-estimate. AQE's runtime decision uses measured shuffle sizes.
    """
    return {
        "spark.sql.shuffle.partitions": str(shuffle_partitions),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.sources.fileCompressionFactor": "4.0",
        "spark.sql.session.timeZone": "UTC",
    }


def local_session(cores: int | str = "*", app: str = "joinery", **conf) -> SparkSession:
    """A local session configured like the tests expect: few shuffle partitions,
    AQE on, UTC, ANSI left at Spark's default (on)."""
    b = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for k, v in recommended_conf(int(conf.pop("shuffle_partitions", 8))).items():
        b = b.config(k, v)
    b = b.config("spark.ui.enabled", "false").config("spark.driver.memory", conf.pop("driver_memory", "8g"))
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this must be set by the deployment (a folder every executor and
    the driver can reach). Only a local-mode session without the setting gets a
    private temporary folder, as in tests.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if root:
        if not spark.sparkContext.getCheckpointDir():
            spark.sparkContext.setCheckpointDir(root)
        return root
    master = spark.sparkContext.master or ""
    if not master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set: name a shared folder (HDFS, S3, ...) "
            "reachable by every executor"
        )
    root = tempfile.mkdtemp(prefix="joinery-ckpt-")
    spark.sparkContext.setCheckpointDir(root)
    log.warning("local session without spark.checkpoint.dir: using %s", root)
    return root


_made: dict[str, SparkSession] = {}


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint root. It is removed when the
    Python process ends, if the session still lives then."""
    root = checkpoint_root(spark).rstrip("/")
    path = f"{root}/joinery/{name}-{uuid.uuid4().hex}"
    if not _made:
        atexit.register(_remove_made)
    _made[path] = spark
    return path


def _remove_made() -> None:
    """Delete the folders handed out, through the file system that Spark uses for them."""
    for path, spark in _made.items():
        try:
            where = spark._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
        except Exception as e:  # noqa: BLE001 - the session may have ended before
            log.debug("left %s behind: %s", path, e)
            return
