from joinery.llm.decontaminate import decontaminate, scan_contamination
from .conftest import frame
from .test_decontaminate import BENCH, DOCS, ITEM


def test_items_without_an_id_are_hit(spark):
    docs = frame(spark, [(1, f"x {ITEM} y"), (2, "clean text")], "doc_id long, text string")
    for bench in ([(None, ITEM)], [(None, ITEM), (8, "another item of the benchmark")]):
        for limit in (500_000, 4):
            out = scan_contamination(docs, frame(spark, bench, "item_id long, text string"), broadcast_words=limit)
            assert {r.doc_id: (r.n_hit, r["items"]) for r in out.collect()} == {1: (12, []), 2: (0, [])}
    left = decontaminate(docs, frame(spark, [(None, ITEM)], "item_id long, text string"))
    assert [r.doc_id for r in left.collect()] == [2]


def test_one_part_at_a_time(spark):
    docs = frame(spark, DOCS, "doc_id long, text string")
    out = scan_contamination(docs, frame(spark, BENCH, "item_id long, text string"), broadcast_words=4)
    assert out._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow") == 1
