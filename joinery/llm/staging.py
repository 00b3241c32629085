"""Tables that cut lineage, in the folder all executors share."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..session import shared_path


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once under ``spark.checkpoint.dir`` and read back: later jobs,
    retries and lost executors start from the files."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
