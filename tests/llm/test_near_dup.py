import random

import numpy as np
import pytest

from joinery.llm import near_dup
from joinery.llm.components import connected_components
from joinery.llm.queries import op2_near_dup
from .conftest import frame


def shingles(text, width):
    words = (text or "").encode().lower().split()
    if not words:
        return frozenset()
    return frozenset(tuple(words[i:i + width]) for i in range(max(1, len(words) - width + 1)))


def brute(docs, width, percent):
    """Exact components by an inverted index over all pairs."""
    sets = {}
    for i, t in docs:
        s = shingles(t, width)
        if s:
            sets.setdefault(s, []).append(i)
    names = list(sets)
    index, common = {}, {}
    for k, s in enumerate(names):
        for x in s:
            for o in index.setdefault(x, []):
                common[o, k] = common.get((o, k), 0) + 1
            index[x].append(k)
    root = list(range(len(names)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for (a, b), n in common.items():
        if 100 * n >= percent * (len(names[a]) + len(names[b]) - n):
            root[max(find(a), find(b))] = min(find(a), find(b))
    least = {}
    for k, s in enumerate(names):
        ids = [i for i in sets[s] if i is not None]
        least.setdefault(find(k), []).extend(ids)
    comp = {s: min(least[find(k)], default=None) for k, s in enumerate(names)}
    out = []
    for i, t in docs:
        s = shingles(t, width)
        c = comp[s] if s else i
        out.append((i, len(s), c, i == c))
    return out


def same(got, want):
    key = lambda r: tuple(str(x) for x in r)
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)


def test_query_equals_brute_force(spark, corpus):
    same(op2_near_dup(spark, corpus.sf_dir).collect(), brute([(d.doc_id, d.text) for d in corpus.documents], 4, 80))


def variants(seed, n, base_words, edits, shared=0):
    rnd = random.Random(seed)
    base = [f"w{seed}x{k}" for k in range(base_words)]
    out = []
    for _ in range(n):
        w = list(base)
        for _ in range(rnd.randint(0, edits)):
            w[rnd.randrange(shared, base_words)] = f"e{rnd.random()}"
        out.append(" ".join(w))
    return out


@pytest.fixture(scope="module")
def groups():
    texts = variants(1, 60, 200, 4) + variants(2, 40, 60, 3) + variants(3, 40, 300, 60, 150) + ["same text here now"] * 30
    texts += ["Two words", "two WORDS", "", None, "   ", "one", "the rain in spain stays mainly"] + [" ".join(["again"] * 500)]
    random.Random(5).shuffle(texts)
    return [(i * 3, t) for i, t in enumerate(texts)]


def test_groups_repeats_and_nulls(spark, groups):
    docs = groups + [(None, groups[0][1]), (None, "only null ids hold this text at all"), groups[4], groups[4]]
    df = frame(spark, docs, "doc_id long, text string")
    same(near_dup.near_duplicates(df, width=5).collect(), brute(docs, 5, 80))


def test_unsettled_buckets_in_blocks(spark, groups, monkeypatch):
    monkeypatch.setattr(near_dup, "BLOCK", 7)
    # links between groups that their smallest and largest members don't make
    chain = []
    words = [f"c{k}" for k in range(100)]
    for step in range(30):
        chain.append((1000 + step, " ".join(words[step * 2:step * 2 + 40])))
    docs = groups + chain
    df = frame(spark, docs, "doc_id long, text string").repartition(5)
    same(near_dup.near_duplicates(df, width=5).collect(), brute(docs, 5, 80))


def test_drop(spark, groups):
    docs = [(*g, "k") for g in groups] + [(*groups[0], "k"), (*groups[0], "k")]
    df = frame(spark, docs, "doc_id long, text string, Kept string")
    kept = near_dup.drop_near_duplicates(df)
    assert kept.columns == df.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(r[0] for r in brute(groups, 5, 80) if r[3])


def test_empty(spark):
    df = frame(spark, [(1, "a")], "doc_id long, text string").filter("false")
    assert near_dup.near_duplicates(df).count() == 0


def test_sketch_keeps_similar_pairs():
    rng = np.random.default_rng(3)
    limit = near_dup.sketch_limit(0.8)
    far = 0
    for _ in range(200):
        pool = rng.integers(0, 1 << 63, 1200, dtype=np.uint64)
        a, b = np.unique(pool[:900]), np.unique(pool[100:1000])  # similarity 0.8
        c = np.unique(np.concatenate((pool[:300], pool[1000:])))
        odd = [near_dup.odd_sketch(near_dup.minhash(x)) for x in (a, b, c)]
        assert np.bitwise_count(odd[0] ^ odd[1]).sum() <= limit
        far += np.bitwise_count(odd[0] ^ odd[2]).sum() > limit
    assert far > 150


def test_components(spark):
    rnd = random.Random(9)
    edges = [(i, i + 1) for i in range(0, 200)] + [(500, x) for x in range(501, 700)] + [(9, 9), (3, 2)]
    rnd.shuffle(edges)
    got = {r.node: r.root for r in connected_components(frame(spark, edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(201)}, **{x: 500 for x in range(500, 700)}}
    assert connected_components(frame(spark, edges, "a long, b long").filter("false")).count() == 0
