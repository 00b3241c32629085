"""The corpus pipeline: five stages over ``documents``, each written as Parquet and read
again as the next one's input."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from joinery.llm.decontaminate import decontaminate
from joinery.llm.line_dedup import dedup_lines
from joinery.llm.near_dup import drop_near_duplicates
from joinery.llm.packing import pack_documents
from joinery.llm.staging import staged
from joinery.llm.texts import q
from joinery.llm.toxicity import drop_toxic
from pyspark.sql import functions as F


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored toxic go; the labels of the input train the model."""
    return drop_toxic(docs, _table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Blocks of lines that an earlier document holds are cut; a document that loses all
    its words goes. ``n_chars`` follows the text."""
    free = docs.select(*[q(c).alias(f"__in_{c}" if c not in ("doc_id", "text") else c) for c in docs.columns])
    out = dedup_lines(free)
    cut = F.col("n_deleted") > 0
    out = out.filter(~cut | F.col("text").rlike(r"[^\x20\x09-\x0D]"))

    def column(c: str):
        if c == "n_chars":
            return F.when(cut, F.length("text")).otherwise(F.col("__in_n_chars")).cast(docs.schema[c].dataType).alias(c)
        return q(c if c in ("doc_id", "text") else f"__in_{c}").alias(c)

    return out.select(*[column(c) for c in docs.columns])


def near_dup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays: five-word shingles, similarity 0.8."""
    return drop_near_duplicates(docs, width=5, percent=80)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    return decontaminate(docs, _table(spark, sf_dir, "benchmark"), remove="documents")


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Training sequences: every piece of the documents that are left, with its text and its
    place in the sequence."""
    return pack_documents(docs, texts=True)


STAGES = [
    ("toxicity", toxicity),
    ("line_dedup", line_dedup),
    ("near_dup", near_dup),
    ("decontamination", benchmark_leaks),
    ("packing", packing),
]

#: Training, alignment and packing are beyond SQL; the tests hold the stages against
#: brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline_{name}")
    return docs
