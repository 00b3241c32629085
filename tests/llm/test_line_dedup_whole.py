"""Blocks that earlier versions of line dedup lost."""

import random

import pyarrow as pa

from joinery.llm import line_dedup as ld
from .conftest import frame
from .test_line_dedup import lines_of


def sentences(rnd, n, words=12):
    return [" ".join(f"u{rnd.randrange(10 ** 9)}" for _ in range(words)) for _ in range(n)]


def deleted(spark, rows):
    return {r.doc_id: r.deleted_lines for r in ld.dedup_lines(frame(spark, rows, "doc_id long, text string").repartition(5)).collect()}


def test_adjoining_popular_passages(spark):
    rnd = random.Random(21)
    p, r = sentences(rnd, 4), sentences(rnd, 4)
    own = lambda: sentences(rnd, 2)
    rows = [(i, "\n".join([*own(), *p, *own()])) for i in range(70)]
    rows += [(100 + i, "\n".join([*own(), *r, *own()])) for i in range(90)]
    rows += [(900, "\n".join([*own(), *p, *r, *own()]))]
    out = deleted(spark, rows)
    assert out[0] == out[100] == [] and out[1] == out[101] == [2, 3, 4, 5]
    assert out[900] == [2, 3, 4, 5, 6, 7, 8, 9]


def test_block_of_lines_that_each_stand_elsewhere_before(spark):
    rnd = random.Random(22)
    s = sentences(rnd, 5)
    own = lambda: sentences(rnd, 2)
    rows = [(i, "\n".join([*own(), line, *own()])) for i, line in enumerate(s)]
    rows += [(10 + i, "\n".join([*own(), *s, *own()])) for i in range(3)]
    out = deleted(spark, rows)
    assert all(out[i] == [] for i in range(5)) and out[10] == []
    assert out[11] == out[12] == [2, 3, 4, 5, 6]


def test_windows_cover_every_block():
    rnd = random.Random(23)
    for _ in range(500):
        words = [rnd.randint(3, rnd.choice([5, 30])) for _ in range(rnd.randrange(15))]
        found = list(ld.block_windows(words))
        assert len(found) == len(set(found)) <= 2 * len(words)
        assert all(sum(words[a:b]) >= ld.BLOCK_WORDS for a, b in found)
        for a in range(len(words)):
            for b in range(a + 1, len(words) + 1):
                if sum(words[a:b]) >= ld.BLOCK_WORDS:
                    assert set(range(a, b)) == {k for x, y in found if a <= x and y <= b for k in range(x, y)}


def test_swapped_passages(spark):
    rnd = random.Random(24)
    p, r = sentences(rnd, 5), sentences(rnd, 5)
    own = lambda: sentences(rnd, 2)
    out = deleted(spark, [(1, "\n".join([*own(), *p, *r])), (2, "\n".join([*own(), *r, *p, *own()]))])
    assert out == {1: [], 2: list(range(2, 12))}


def test_doubled_passage(spark):
    rnd = random.Random(25)
    p = sentences(rnd, 5)
    own = lambda: sentences(rnd, 2)
    out = deleted(spark, [(1, "\n".join([*own(), *p, *own()])), (2, "\n".join([*own(), *p, *own(), *p, *own()]))])
    assert out == {1: [], 2: [*range(2, 7), *range(9, 14)]}


def test_pieces_of_texts():
    rnd = random.Random(26)
    marks = ["a", "bc.", "d!", "e?\")", " ", "  ", "\t", "\n", "\r\n", "same same", "é", "long " * 9, "x y " * 30, *sentences(rnd, 5, 30)]
    for _ in range(400):
        text = "".join(rnd.choice(marks) + rnd.choice(["", " "]) for _ in range(rnd.randrange(120)))
        data = text.encode()
        assert [(n, data[a:b].decode()) for n, a, b, _ in ld.text_lines(data)] == lines_of(text)
        assert ld.without_lines(data, []) == data


def test_passages_without_sentence_ends():
    """None of many passages of 51 to 60 words is missed, nor more than its ends kept."""
    rnd = random.Random(27)
    words = lambda n, of=10 ** 9: [f"v{rnd.randrange(of)}" for _ in range(n)]
    for k in range(3000):
        passage = words(rnd.randint(51, 60), 10 ** 9 if k % 3 else 200)
        first, second = (" ".join([*words(rnd.randint(1, 40)), *passage, *words(rnd.randint(1, 40))]).encode() for _ in range(2))
        (a, *_), (b, n, at, _) = ld.line_table(first), ld.line_table(second)
        gone = ld.aligned_blocks(b, a, n)
        assert sum(n[i] for i in gone) >= ld.BLOCK_WORDS, passage
        left = ld.without_lines(second, [at[i] for i in gone]).decode().split()
        assert len(left) + sum(n[i] for i in gone) == len(second.split())


def test_many_texts_are_cut_at_once_in_chunks_of_bounded_size():
    rnd = random.Random(31)
    marks = [". ", "? ", "! ", "\n", ".\n", '.") ', " ", " ", " ", " ", "\t", "\r"]
    texts = ["".join(rnd.choice(["a", "bb", "ccc"]) + rnd.choice(marks) for _ in range(rnd.choice([0, 3, 30, 300]))) for _ in range(200)]
    texts[7], texts[8], texts[-1] = None, " \n\n", "a b c d. " * (ld.CHUNK_BYTES // 8)
    rows = pa.RecordBatch.from_arrays([pa.array(range(200)), pa.array(range(200)), pa.array(texts)], names=["__id", "__th", "__text"])
    whole = pa.RecordBatch.from_arrays([pa.array(range(1000)), pa.array(range(1000)), pa.array([x or " " for x in texts[:-1]] * 5 + [texts[-1]] * 5)], names=["__id", "__th", "__text"])
    # no more than a chunk is held as Python values, whatever the batch
    assert len(list(ld._lines(ld.LINE_WORDS, ld.BLOCK_WORDS)(iter([whole])))) > 4
    got = [r for b in ld._lines(ld.LINE_WORDS, ld.BLOCK_WORDS)(iter([rows])) for r in b.to_pylist()]
    assert [r["__id"] for r in got] == list(range(200))
    for r, text in zip(got[:-1], texts):
        held = [] if text is None else lines_of(text)
        counting = [(i, len(p.split())) for i, (_, p) in enumerate(held) if len(p.split()) >= ld.LINE_WORDS]
        assert r["n_lines"] == len(held) and list(zip(r["numbers"], r["words"])) == counting
        assert len(set(r["windows"])) == len(r["windows"]) <= len(list(ld.block_windows(r["words"])))


def test_pairs_are_python_values_a_slice_at_a_time(monkeypatch):
    rnd = random.Random(32)
    rows = []
    for th in range(1000):
        other = [rnd.randrange(20) for _ in range(12)]
        rows.append({"th": th, "lines": other[4:9] + [100, 101], "words": [rnd.randint(3, 9) for _ in range(7)], "other": other})
    batch = pa.RecordBatch.from_pylist(rows)
    seen = []
    aligned = ld.aligned_blocks
    monkeypatch.setattr(ld, "aligned_blocks", lambda *a: seen.append(1) or aligned(*a))
    got = {r["th"]: r["gone"] for b in ld._align(ld.BLOCK_WORDS)(iter([batch])) for r in b.to_pylist()}
    assert len(seen) == 1000 and ld.ALIGN_ROWS < 1000
    for r in rows:
        a, b, w = r["lines"], r["other"], r["words"]
        want = {k for i in range(7) for j in range(i + 1, 8) if sum(w[i:j]) >= ld.BLOCK_WORDS
                and any(b[m:m + j - i] == a[i:j] for m in range(len(b))) for k in range(i, j)}
        assert got.get(r["th"], []) == sorted(want)
