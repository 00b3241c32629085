import re

import pytest

from joinery.llm.decontaminate import cut_spans, decontaminate, scan_contamination
from joinery.llm.queries import op3_decontaminate
from .conftest import frame, sha
from pyspark.sql import functions as F

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, bench):
    out = []
    windows = {}
    for item, text in bench:
        w = words(text)
        if w and item is not None:
            n = min(10, len(w))
            for i in range(len(w) - n + 1):
                windows.setdefault(tuple(w[i:i + n]), set()).add(str(item))
    sizes = {len(k) for k in windows}
    for doc, text in docs:
        w, hit, items = words(text), set(), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                if found := windows.get(tuple(w[i:i + n])):
                    items |= found
                    hit |= set(range(i, i + n))
        out.append((doc, len(w), len(hit), len(items), sha(",".join(sorted(items))), bool(hit)))
    return out


def test_query_equals_brute_force(spark, corpus):
    got = [tuple(r) for r in op3_decontaminate(spark, corpus.sf_dir).collect()]
    want = brute([(d.doc_id, d.text) for d in corpus.documents], [(b.item_id, b.text) for b in corpus.benchmark])
    assert sorted(got) == sorted(want)
    assert any(r[5] for r in got)


ITEM = "Alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu"
DOCS = [
    (1, "x alpha BETA gamma, delta epsilon zeta eta theta iota kappa lambda y"),
    (2, ITEM + " gap Éa short one " + ITEM), (2, ITEM), (2, ITEM), (3, None), (4, ""), (None, "the short one is here"),
    (5, "clean text without a hit " * 3000), (6, "Éa short one"), (7, "éa short one"), (8, "... ---"),
]
BENCH = [(10, ITEM), (9, ITEM.upper()), (11, "Éa, short one"), (12, None), (13, ""), (None, ITEM), (14, "alpha")]


@pytest.mark.parametrize("limit", [500_000, 4])
def test_edges_and_many_parts(spark, limit):
    docs = frame(spark, [(*d, f"n{i}") for i, d in enumerate(DOCS)], "doc_id long, text string, N_Words string")
    bench = frame(spark, BENCH, "item_id long, text string")
    out = scan_contamination(docs, bench, broadcast_words=limit)
    assert out.columns == ["doc_id", "text", "n_words", "n_hit", "items", "hit_words", "hit_spans"]
    got = [(r.doc_id, r.n_words, r.n_hit, len(r["items"]), sha(",".join(r["items"])), r.n_hit > 0) for r in out.collect()]
    key = lambda r: tuple(str(x) for x in r)
    assert sorted(got, key=key) == sorted(brute(DOCS, BENCH), key=key)
    for r in out.collect():
        for s, w in zip(r.hit_spans, r.hit_words, strict=True):
            assert words(r.text[s.start:s.end]) == words(r.text)[w.start:w.end]


def test_removal(spark):
    docs = frame(spark, [(1, "Ünique before " + ITEM + " after"), (2, "clean"), (3, None)], "doc_id long, text string")
    bench = frame(spark, BENCH[:1], "item_id long, text string")
    kept = decontaminate(docs, bench)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [2, 3]
    cut = {r.doc_id: r.text for r in decontaminate(docs, bench, remove="spans").collect()}
    assert cut == {1: "Ünique before   after", 2: "clean", 3: None}
    with pytest.raises(ValueError):
        decontaminate(docs, bench, remove="words")


def test_empty_tables(spark):
    docs = frame(spark, DOCS[:2], "doc_id long, text string")
    bench = frame(spark, BENCH, "item_id long, text string")
    assert scan_contamination(docs.filter("false"), bench).count() == 0
    assert [r.n_hit for r in scan_contamination(docs, bench.filter("false")).collect()] == [0, 0]
    assert spark.range(1).select(cut_spans(F.lit("abc"), F.expr("array(struct(1 as start, 2 as end))")).alias("t")).first().t == "a c"
