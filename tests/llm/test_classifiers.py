import math
import zlib

import numpy as np
import pytest

from joinery.llm import features, quality, toxicity
from joinery.llm.queries import op6_toxicity, op8_quality
from .conftest import frame
from pyspark.sql import functions as F

SF1 = "/root/testdata/sf0.1"


def held(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 5 == 0


def auc(pairs):
    ranked = sorted(pairs)
    ranks, i = {}, 0
    while i < len(ranked):
        j = i
        while j < len(ranked) and ranked[j][0] == ranked[i][0]:
            j += 1
        ranks[ranked[i][0]] = (i + j + 1) / 2
        i = j
    pos = [ranks[s] for s, y in ranked if y]
    n = len(ranked) - len(pos)
    return (sum(pos) - len(pos) * (len(pos) + 1) / 2) / (len(pos) * n)


def test_toxicity_on_held_out_rows(spark):
    truth = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF1}/labels.parquet").collect()}
    rows = op6_toxicity(spark, SF1).collect()
    assert len(rows) == spark.read.parquet(f"{SF1}/documents.parquet").count()
    assert all(r.held_out == held(r.doc_id) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    out = [(r.score, truth[r.doc_id]) for r in rows if r.held_out and r.doc_id in truth]
    assert auc(out) > 0.97
    assert sum((s >= 0.5) == bool(y) for s, y in out) / len(out) > 0.97


def test_quality_on_held_out_rows(spark):
    truth = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF1}/labels.parquet").collect()}
    rows = op8_quality(spark, SF1).collect()
    assert all(0 <= r.expected_grade <= 2 and 0 <= r.tail_probability <= 1 and r.kept == (r.tail_probability >= 0.5) for r in rows)
    out = [(r.tail_probability, truth[r.doc_id]) for r in rows if r.held_out and r.doc_id in truth]
    assert auc(out) > 0.97
    assert sum((s >= 0.5) == bool(y) for s, y in out) / len(out) > 0.95


def test_every_grade_is_found(spark):
    labels = spark.read.parquet(f"{SF1}/labels.parquet").collect()
    truth = {r.doc_id: 0 if r.quality == 0 else 1 if r.toxic else 2 for r in labels if r.quality is not None}
    rows = [r for r in op8_quality(spark, SF1).collect() if r.held_out and r.doc_id in truth]
    for grade, least in ((0, 0.9), (1, 0.5), (2, 0.95)):
        own = [r for r in rows if truth[r.doc_id] == grade]
        assert sum(r.grade == grade for r in own) / len(own) >= least, grade
    mean = [sum(r.expected_grade for r in rows if truth[r.doc_id] == g) / sum(truth[r.doc_id] == g for r in rows) for g in range(3)]
    assert mean[0] + 0.5 < mean[1] < mean[2] - 0.2


def test_gradient_of_the_cumulative_link():
    t, f, e = np.array([-1.3, 0.4, 2.0]), 0.7, 1e-6

    def loss(t, f, k):
        s = [0.0, *(1 / (1 + math.exp(-(x - f))) for x in t), 1.0]
        return -math.log(s[k + 1] - s[k])

    for k in range(4):
        by_f, by_t = quality.gradient(t, f, k)
        assert by_f == pytest.approx((loss(t, f + e, k) - loss(t, f - e, k)) / (2 * e), abs=1e-5)
        for j in range(3):
            d = e * (np.arange(3) == j)
            assert by_t[j] == pytest.approx((loss(t + d, f, k) - loss(t - d, f, k)) / (2 * e), abs=1e-5)


def test_one_id_with_a_third_of_the_rows(spark):
    docs, labels, rows = small(spark)
    hot = [(4, f"kind words of copy {i % 150}", 1) for i in range(600)]
    many = docs.unionByName(frame(spark, hot, "doc_id long, text string, Score int"))
    got = features.labelled_features(many, labels, "toxic", features.word_grams, sample_rows=100)
    assert 60 < got.count() < 140
    whole = features.labelled_features(many, labels, "toxic", features.word_grams).collect()
    ids = [i for i in range(300) if not held(i)]
    assert not held(4) and len(whole) == len(ids) + 150 and len({r.ordr for r in whole}) == len(whole)


def small(spark):
    docs = [(i, ("you utter clown number " if i % 3 == 0 else "a kind word for ") + f"x{i}", 1) for i in range(300)]
    docs += [(None, None, 1), (7000, "", 1), (7001, "clown " * 30_000, 1), (5, docs[5][1], 1), (7002, "...", 1)]
    labels = [(i, 1, int(i % 3 == 0)) for i in range(300)] + [(None, 1, 1), (7000, None, None), (1, 1, 0)]
    return frame(spark, docs, "doc_id long, text string, Score int"), frame(spark, labels, "doc_id long, quality int, toxic int"), docs


def test_toxicity_edges(spark):
    docs, labels, rows = small(spark)
    model = toxicity.train_toxicity(docs, labels)
    out = toxicity.score_toxicity(docs, model)
    assert out.columns == ["doc_id", "text", "score"]
    got = out.collect()
    assert len(got) == len(rows) and all(r.score is not None for r in got)
    assert len({r.score for r in got if not r.text or r.text == "..."}) == 1
    assert all((r.score >= 0.5) == ("clown" in (r.text or "")) for r in got)
    kept = toxicity.drop_toxic(docs, labels)
    assert kept.columns == docs.columns and not any("clown" in (r.text or "") for r in kept.collect())
    assert {r.score for r in toxicity.score_toxicity(docs, toxicity.train_toxicity(docs, labels.filter("false"))).collect()} == {0.0}
    assert toxicity.score_toxicity(docs.filter("false"), model).count() == 0


def test_held_out_rows_teach_nothing(spark):
    docs, labels, _ = small(spark)
    odd = labels.withColumn("toxic", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = (toxicity.train_toxicity(docs, x) for x in (labels, odd))
    assert (a.dense() == b.dense()).all() and a.bias == b.bias
    assert (toxicity.train_toxicity(docs.repartition(7), labels).dense() == a.dense()).all()


def test_quality_edges(spark):
    docs, labels, rows = small(spark)
    ratings = labels.withColumn("grade", quality.graded(F.col("quality"), F.col("toxic")))
    model = quality.train_quality(docs, ratings, "grade", 3)
    assert model.thresholds[0] <= model.thresholds[1]
    got = quality.score_quality(docs, model, min_grade=2).collect()
    assert len(got) == len(rows)
    assert all(r.tail_probability < 0.5 for r in got if r.text and "clown" in r.text and r.doc_id != 7001)
    assert all(r.tail_probability > 0.5 for r in got if r.text and "kind" in r.text)
    none = quality.train_quality(docs, ratings.filter("false"), "grade", 3)
    assert all(r.expected_grade == pytest.approx(1.0) for r in quality.score_quality(docs, none).collect())


def test_sample_is_bounded(spark):
    docs, labels, _ = small(spark)
    rows = features.labelled_features(docs, labels, "toxic", features.word_grams, sample_rows=60).count()
    assert 20 < rows < 110


def test_long_and_short_texts_share_features():
    import numpy as np

    text = " ".join(f"w{i % 977}" for i in range(60_000)).encode()
    h = features.word_grams(text)
    assert (np.diff(h) > 0).all() and set(features.word_grams(b"w1 w2 w3")) <= set(h)
    assert len(features.word_grams(None)) == 0 and len(features.style_grams(b"")) > 0
