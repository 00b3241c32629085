"""The pipeline against its brute-force versions, stage by stage."""

import corpus_pipeline as cp
from joinery.llm.staging import staged
from . import test_decontaminate, test_line_dedup, test_near_dup, test_packing
from .conftest import frame


def test_stages(spark, corpus):
    docs = spark.read.parquet(f"{corpus.sf_dir}/documents.parquet")
    toxic = {r.doc_id for r in spark.read.parquet(f"{corpus.sf_dir}/labels.parquet").collect() if r.toxic}
    bench = [(b.item_id, b.text) for b in corpus.benchmark]
    seen = []
    before = docs
    for name, stage in cp.STAGES:
        after = staged(stage(spark, before, corpus.sf_dir), f"test_{name}")
        rows = after.collect()
        if name != "packing":
            assert after.schema == docs.schema or after.columns == docs.columns
        was = [(r.doc_id, r.text) for r in before.collect()]
        if name == "toxicity":
            left = {r.doc_id for r in rows}
            assert len(toxic & left) <= 0.5 * len(toxic)  # fifty toxic labels teach little; the classifier's own test has more
            assert len(left) > 0.9 * (len(was) - len(toxic))
        elif name == "line_dedup":
            want = {r[0]: r[4] for r in test_line_dedup.brute(was) if not r[2] or r[4].split()}
            assert {r.doc_id: r.text for r in rows} == want
            assert all(r.n_chars == len(r.text) for r in rows if dict(was)[r.doc_id] != r.text)
        elif name == "near_dup":
            assert sorted(r.doc_id for r in rows) == sorted(r[0] for r in test_near_dup.brute(was, 5, 80) if r[3])
        elif name == "decontamination":
            assert sorted(r.doc_id for r in rows) == sorted(r[0] for r in test_decontaminate.brute(was, bench) if not r[5])
        else:
            test_packing.check(rows, {i: [len(t.encode().split())] for i, t in was}, test_packing.packing.SIZES)
        seen.append(name)
        before = after
    assert seen == [n for n, _ in cp.STAGES] and len(seen) == 5


def test_run_equals_its_stages(spark, corpus):
    out = cp.run(spark, "/root/testdata/sf0.001")
    assert out.count() > 0 and set(out.columns) >= {"doc_id", "bin", "bin_size"}


def test_stages_take_odd_columns(spark, corpus):
    rows = [(i, f"some clean words of document {i} " * 10, "en", "s", None, 0.5, True) for i in range(20)] + [(None, None, None, None, None, None, None)] * 2
    docs = frame(spark, rows, "doc_id long, text string, lang string, source string, n_chars long, Score double, KEPT boolean")
    for _, stage in cp.STAGES[:-1]:
        out = stage(spark, docs, corpus.sf_dir)
        assert out.columns == docs.columns
        assert {r.doc_id for r in out.collect()} >= set(range(20))
        assert stage(spark, docs.filter("false"), corpus.sf_dir).count() == 0
