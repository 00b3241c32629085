import random
import re

from joinery.llm import license_scan as ls
from joinery.llm.queries import op9_licenses
from .conftest import frame

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def brute(docs):
    """Base phrases by search; templates by lining up grams, word for word."""
    out = []
    templates = [(label, ls._words(n)) for label, notices in ls.TEMPLATES.items() for n in notices]
    for doc, text in docs:
        w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        places = [(i, label) for phrase, label in ls.PHRASES.items() for i in range(len(w)) if w[i:i + len(phrase.split())] == phrase.split()]
        base = {label for _, label in places}
        found, best = set(), 0.0
        where = {}
        for i in range(len(w) - ls.GRAM + 1):
            where.setdefault(tuple(w[i:i + ls.GRAM]), []).append(i)
        for label, t in templates:
            size = len(t) - ls.GRAM + 1
            hits = sorted((i - j, i, j) for j in range(size) for i in where.get(tuple(t[j:j + ls.GRAM]), []))
            spans = []
            for d, i, j in hits:
                if not spans or d - spans[-1][-1][0] > ls.SLACK:
                    spans.append([])
                spans[-1].append((d, i, j))
            for span in spans:
                for a in {i for _, i, _ in span}:  # every start, as far as a copy may reach
                    share = len({j for _, i, j in span if a <= i <= a + 2 * len(t) - ls.GRAM}) / size
                    if share >= ls.COVER:
                        found.add(label)
                        best = max(best, share)
        at = [i for i, _ in places]
        out.append((doc, len(w), len(at), min(at, default=None), max(at, default=None), ",".join(sorted(base)),
                    ",".join(sorted(base | found)), 1.0 if at else best))
    return out


def same(got, want):
    key = lambda r: tuple(str(x) for x in r)
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)


COLUMNS = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]


def test_query_equals_brute_force(spark, corpus):
    got = op9_licenses(spark, corpus.sf_dir).collect()
    same(got, brute([(d.doc_id, d.text) for d in corpus.documents]))
    assert any(r.n_base for r in got) and any(r.labels != r.base_labels for r in got)


MIT = ls.TEMPLATES["mit"][1]
DOCS = [
    (1, "x " + MIT + " y"), (2, MIT.replace("free of", "FREE really of") + " tail"), (3, "Licensed under CC--BY, cc by"), (4, None), (5, ""),
    (None, "All rights  reserved"), (6, "general public licence General PUBLIC License general-public\nlicense"), (6, "plain"), (7, "cc by"), (7, "cc by"),
    (8, "by cc all rights"), (9, ("all rights reserved. " + MIT + " ") * 300), (10, "Éa word Ünique"), (11, " ".join(MIT.split()[:6])),
]


def test_edges(spark):
    df = frame(spark, [(*d, 0.5) for d in DOCS], "doc_id long, text string, Score double").repartition(3)
    out = ls.scan_licenses(df)
    same(out.select(COLUMNS).collect(), brute(DOCS))
    spans = {r.doc_id: r.spans for r in out.collect()}
    assert [(s.label, s.start, s.end) for s in spans[1]] == [("mit", 1, 1 + len(ls._words(MIT)))]


NOTICE = "Licensed under CC BY-NC 4.0"


def test_copies_inside_long_chains(spark):
    """Words of the template around a whole copy never cost the copy."""
    rnd = random.Random(5)
    words = ls._words(MIT)
    noise = lambda n: " ".join(" ".join(words[k:k + rnd.randint(3, 6)]) for k in (rnd.randrange(len(words)) for _ in range(n)))
    docs = [(1, "licensed under cc " * 20 + NOTICE + " end"), (2, NOTICE), (3, "licensed under cc " * 200 + NOTICE + " licensed under cc" * 200 + " " + NOTICE)]
    docs += [(10 + k, f"{noise(30)} {MIT if k % 2 else ''} {noise(30)}") for k in range(30)]
    out = ls.scan_licenses(frame(spark, docs, "doc_id long, text string").repartition(3))
    rows = out.collect()
    same([[r[c] for c in COLUMNS] for r in rows], brute(docs))
    labels = {r.doc_id: r.labels for r in rows}
    assert labels[1] == labels[2] == labels[3] == "cc-by,cc-by-nc-4.0"
    spans = {r.doc_id: [(s.label, s.start, s.end) for s in r.spans or ()] for r in rows}
    assert spans[1] == [("cc-by-nc-4.0", 60, 67)] and ("cc-by-nc-4.0", 600, 607) in spans[3]
    assert all("mit" in labels[i] for i in labels if i >= 10 and i % 2)


def test_shuffled_templates_and_empty(spark):
    df = frame(spark, DOCS, "doc_id long, text string")
    grams = ls.template_grams(spark)
    few = ls.hits(df, grams, "doc_id", "text").exceptAll(ls.hits(df, grams, "doc_id", "text", broadcast_grams=0))
    assert few.count() == 0
    assert ls.scan_licenses(df.filter("false")).count() == 0
