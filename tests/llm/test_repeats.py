"""Substring dedup against a brute force over word tuples."""

import random

import pytest

from joinery.llm.repeats import PhraseAutomaton, merged, remove_repeats, runs
from .conftest import frame

SPACE = " \t\n\x0b\x0c\r"


def words(text):
    out, now = [], ""
    for ch in text or "":
        if ch in SPACE:
            out.append(now)
            now = ""
        else:
            now += ch
    return [w for w in [*out, now] if w]


def brute(rows, window):
    first = {}
    large = max([i for i, _ in rows if i is not None], default=0) + 1
    for ident, text in rows:
        w, at = words(text), large if ident is None else ident
        for i in range(len(w) - window + 1):
            key = tuple(w[i:i + window])
            first[key] = min(first.get(key, at), at)
    out = []
    for ident, text in rows:
        w, at, gone = words(text), large if ident is None else ident, set()
        for i in range(len(w) - window + 1):
            if first[tuple(w[i:i + window])] < at:
                gone |= set(range(i, i + window))
        left = " ".join(x for i, x in enumerate(w) if i not in gone) if gone else text
        out.append((ident, len(w), len(gone), left))
    return out


def result(spark, rows, window, **more):
    docs = frame(spark, rows, "doc_id long, text string")
    return [(r.doc_id, r.n_words, r.n_removed, r.text) for r in remove_repeats(docs, window=window, **more).collect()]


def key(row):
    return tuple(str(x) for x in row)


def made(seed, n=60):
    """Texts of few words with shared passages, some of them inside each other or repeated."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    passages = [[rng.choice(vocabulary) for _ in range(rng.choice([8, 9, 10, 14, 25]))] for _ in range(6)]
    passages.append(passages[0] + passages[1])
    passages.append(["a"] * 30)
    rows = []
    for i in range(n):
        text = []
        for _ in range(rng.randrange(5)):
            text += [rng.choice(vocabulary) for _ in range(rng.randrange(12))]
            if rng.random() < 0.7:
                p = rng.choice(passages)
                text += p[rng.randrange(2):len(p) - rng.randrange(2)]
        rows.append((i, rng.choice(SPACE).join(text)))
    return rows + [(rng.randrange(n), rows[k][1]) for k in range(4)]


@pytest.mark.parametrize("seed,window,shard", [(0, 8, 1_000_000), (1, 9, 40), (2, 2, 200), (3, 13, 1)])
def test_random_texts(spark, seed, window, shard):
    rows = made(seed)
    got = result(spark, rows, window, shard_words=shard)
    want = brute(rows, window)
    assert sorted(got, key=key) == sorted(want, key=key)
    assert any(r[2] for r in got)


def test_edges(spark):
    long = " ".join(f"v{i}" for i in range(30_000))
    passage = " ".join(f"p{i}" for i in range(50))
    rows = [
        (5, passage), (5, passage + " tail"), (3, None), (4, ""), (None, "x " + passage), (None, passage), (7, passage), (9, f"Ü{passage} z"),
        (10, " ".join(f"p{i}" for i in range(49))), (11, long), (12, "start " + long), (13, "  " + passage + "\n\n" + passage + "  "), (1, "p0 p1"),
        (2**63 - 1, passage),
    ]
    got = result(spark, rows, 50)
    assert sorted(got, key=key) == sorted(brute(rows, 50), key=key)
    assert {r[0]: r[2] for r in got if r[0] in (10, 11, 12, 13)} == {10: 0, 11: 0, 12: 30_000, 13: 100}


def test_columns_and_empty_table(spark):
    passage = " ".join(f"p{i}" for i in range(10))
    docs = frame(spark, [(1, passage, "a", 5), (2, "b " + passage + " c", None, 6)], "doc_id int, text string, N_Words string, k int")
    out = remove_repeats(docs, window=10)
    assert out.columns == ["doc_id", "text", "k", "n_words", "n_removed", "removed"]
    assert [(r.doc_id, r.text, r.k, r.n_words, r.n_removed, [tuple(x) for x in r.removed]) for r in out.orderBy("doc_id").collect()] == [
        (1, passage, 5, 10, 0, []), (2, "b c", 6, 12, 10, [(1, 11)])]
    assert remove_repeats(docs.filter("false"), window=10).count() == 0
    with pytest.raises(ValueError):
        remove_repeats(docs.selectExpr("'x' AS doc_id", "text"))
    with pytest.raises(ValueError):
        remove_repeats(docs, window=1)


def test_hot_passage(spark):
    """One passage in a third of all texts, and one owner that more texts wait for than go to
    one copy of its passages."""
    passage = " ".join(f"p{i}" for i in range(12))
    rows = [(i, (f"{passage} z{i} " if i % 3 == 0 else "") + " ".join(f"u{i}x{j}" for j in range(5))) for i in range(7000)]
    got = result(spark, rows, 10)
    assert sorted(r[0] for r in got if r[2]) == [i for i in range(3, 7000, 3)]
    assert all(r[2] in (0, 12) for r in got)


def test_automaton_finds_runs_of_its_owner_only():
    phrases = PhraseAutomaton(4)
    phrases.add(1, "a b c d e f")
    phrases.add(2, "c d e f g h")
    phrases.compile()
    assert phrases.find(1, "x a b c d e f g h") == [(1, 7)]
    assert phrases.find(2, "x a b c d e f g h") == [(3, 9)]
    assert phrases.find(1, "a b c x d e f") == []
    assert phrases.find(3, "a b c d e f") == []
    empty = PhraseAutomaton(4)
    empty.compile()
    assert empty.find(1, "a b") == []


def test_ranges():
    assert runs([3, 1, 2, 9], 4) == [(1, 7), (9, 13)]
    assert runs([1, 3], 4) == [(1, 5), (3, 7)]
    assert merged([(1, 5), (3, 7), (9, 10)]) == [(1, 7), (9, 10)]
