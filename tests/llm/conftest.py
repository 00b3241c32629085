import hashlib
import os
import sys

import pytest
from pyspark.sql import Row

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def corpus(spark):
    """The sf0.01 tables as Python rows."""

    class Corpus:
        sf_dir = "/root/testdata/sf0.01"
        _kept: dict = {}

        def __getattr__(self, name):
            if name not in self._kept:
                self._kept[name] = spark.read.parquet(f"{self.sf_dir}/{name}.parquet").collect()
            return self._kept[name]

    return Corpus()


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def frame(spark, rows, ddl):
    return spark.createDataFrame([Row(*r) for r in rows], ddl)
