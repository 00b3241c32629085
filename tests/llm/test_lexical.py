"""Ranked search against a brute force that scores every document."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from joinery.llm import lexical
from joinery.llm.lexical import Block, _best, ranked_search
from .conftest import frame


def terms(text):
    return re.findall("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, queries, k=10):
    held = [(i, Counter(terms(t))) for i, t in docs]
    held = [(i, c) for i, c in held if c]
    big, total = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    out = []
    for item, text in queries:
        scored = []
        for i, c in held:
            m = 100 - 75 + 75 * sum(c.values()) * big // total
            s = sum(n * math.floor(1000 * math.log((2 * big + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t, n in Counter(terms(text)).items() if t in c)
            if s > 0:
                scored.append((-s, i is None, i or 0, i))
        out += [(item, rank, s[3], -s[0]) for rank, s in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=str)


def got(spark, docs, queries, **more):
    out = ranked_search(frame(spark, docs, "doc_id long, text string").repartition(3), frame(spark, queries, "item_id long, text string"), **more)
    assert out.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted((tuple(r) for r in out.collect()), key=str)


def made(seed, n=400):
    rng = random.Random(seed)
    vocabulary = [f"t{i}" for i in range(120)] + ["Éa", "éa", "ABC"]
    weights = [1 / (i + 1) for i in range(len(vocabulary))]
    text = lambda most: rng.choice([" ", "-", "_"]).join(rng.choices(vocabulary, weights, k=rng.randrange(most)))
    return [(i if rng.random() < 0.95 else rng.choice([None, 3]), text(40)) for i in range(n)], [(i, text(12)) for i in range(40)]


@pytest.mark.parametrize("seed,more", [(0, {}), (1, {"k": 1}), (2, {"k": 3, "block_terms": 50}), (3, {"k": 1000})])
def test_random_texts(spark, seed, more):
    docs, queries = made(seed)
    assert got(spark, docs, queries, **more) == brute(docs, queries, more.get("k", 10))


def test_small_posting_blocks(spark, monkeypatch):
    docs, queries = made(9)
    monkeypatch.setattr(lexical, "BLOCK_POSTINGS", 1)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "20")
    try:
        assert got(spark, docs, queries) == brute(docs, queries)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_edges(spark):
    docs = [(1, None), (2, ""), (3, "... ---"), (4, "one two"), (4, "one two"), (None, "one two"), (2**63 - 1, "one two"), (7, "one " * 30_000), (8, "two three"), (9, "ONE one")]
    queries = [(1, "one"), (1, "one"), (2, None), (3, ""), (4, "absent"), (5, "Two two TWO three"), (None, "three"), (6, "...")]
    assert got(spark, docs, queries) == brute(docs, queries)
    assert got(spark, [], queries) == [] and got(spark, docs, []) == [] and got(spark, docs[:3], queries) == []
    with pytest.raises(ValueError):
        ranked_search(frame(spark, [("a", "b")], "doc_id string, text string"), frame(spark, queries, "item_id long, text string"))


def test_accumulators_stop():
    """A rare heavy term fills the k best, so the frequent light one makes no accumulators."""
    n, k = 1000, 5
    docs = np.concatenate((np.arange(10), np.arange(n)))
    which = np.array([0] * 10 + [1] * n)
    block = Block(docs, np.full(n, 100), which, np.ones(n + 10, np.int64), np.array([5000, 10]))
    acc, seen = np.zeros(n, np.int64), np.zeros(n, bool)
    at, scores = block.answer([(0, 1), (1, 2)], k, 0, acc, seen)
    assert sorted(at.tolist()) == list(range(10)) and not acc.any() and not seen.any()
    one = 10**9 // (1000 + 800)
    assert set(scores.tolist()) == {5000 * one + 2 * 10 * one}
    at, _ = block.answer([(1, 1)], k, 0, acc, seen)
    assert len(at) == n


def test_best_breaks_ties():
    ids, null = np.array([5, 3, 4, 0, 9] * 4), np.array([False, False, False, True, False] * 4)
    scores = np.array([7, 7, 7, 7, 9] * 4)
    assert [(bool(null[i]), int(ids[i])) for i in _best(ids, null, scores, 6)] == [(False, 9)] * 4 + [(False, 3)] * 2
