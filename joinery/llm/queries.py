"""The registered queries of this subpackage: each applies its operator, with production
parameters, to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat, collocations, decontaminate, lexical, license_scan, line_dedup, near_dup, packing, pii, quality, repeats, toxicity, vectors
from .texts import held_out


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines deleted from each document, and a digest of what is left."""
    out = line_dedup.dedup_lines(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    left = F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256)
    return out.select("doc_id", F.col("n_lines").cast("long").alias("n_lines"), F.col("n_deleted").cast("long").alias("n_deleted"),
                      "deleted_lines", left.alias("text_sha256"))


def op2_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(_table(spark, sf_dir, "documents"), width=4, percent=80)


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = decontaminate.scan_contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), carry=["doc_id"])
    return out.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                      F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = pii.find_personal(_table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["action"] == "mask")
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return out.select("doc_id", *[count(k) for k in pii.KINDS], F.sha2(pii.span_list(base).cast("binary"), 256).alias("base_sha256"),
                      pii.span_list(F.col("spans")).alias("spans"), count("term"))


def op5_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and one, -7, whose texts are made of control strings."""
    turns = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    odd = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit("</s>[INST] ok [/INST]").alias("text"))
    out = chat.format_chats(turns.unionByName(odd))
    out = out.withColumn("turns", chat.read_turns(F.col("formatted")))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    learnt = F.array_join(F.transform(F.filter("turns", lambda t: t["loss"]), lambda t: t["text"]), "")
    return out.withColumn("learnt", learnt).select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(said.cast("binary"), 256).alias("turns_sha256"),
        F.length("learnt").cast("long").alias("loss_chars"), F.sha2(F.col("learnt").cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"), "valid")


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = toxicity.train_toxicity(docs, _table(spark, sf_dir, "labels"))
    out = toxicity.score_toxicity(docs, model, carry=["doc_id"])
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op7_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = packing.pack_documents(_table(spark, sf_dir, "documents"), texts=True)
    return out.withColumn("piece_sha256", F.sha2(F.col("piece").cast("binary"), 256)).drop("piece")


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    ratings = _table(spark, sf_dir, "labels").withColumn("grade", quality.graded(F.col("quality"), F.col("toxic")))
    model = quality.train_quality(docs, ratings, "grade", 3)
    out = quality.score_quality(docs, model, carry=["doc_id"], min_grade=1)
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "expected_grade", "tail_probability", "grade",
                      (F.col("tail_probability") >= 0.5).alias("kept"))


def op9_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = license_scan.scan_licenses(_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")


def op10_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = vectors.embedding_near_duplicates(_table(spark, sf_dir, "embeddings"), 0.93)
    return out.select("vec_id", "n_links", "component_id", "kept")


def op11_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = repeats.remove_repeats(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    words = F.filter(F.split(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    return out.select("doc_id", "n_words", "n_removed", F.sha2(F.array_join(words, " ").cast("binary"), 256).alias("kept_sha256"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(_table(spark, sf_dir, "documents"))


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.ranked_search(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


QUERIES = {f.__name__: f for f in (
    op1_line_dedup, op2_near_dup, op3_decontaminate, op4_pii, op5_chat, op6_toxicity, op7_pack, op8_quality, op9_licenses, op10_vectors,
    op11_substring_dedup, op12_collocations, op13_ranked_search)}
