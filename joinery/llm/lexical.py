"""Ranked lexical search: accumulator-limited term-at-a-time over document blocks.

Every task holds a block of documents as postings of the query terms and answers all
queries on it: terms rarest first, each adding to an accumulator per document. Once the
bounds of the terms that are left cannot lift a document without an accumulator over the
k-th best partial score, no new ones are made; those that exist are updated to their exact
scores. Blocks return their k best per query, so that only these are shuffled."""

from __future__ import annotations

import pickle
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .staging import staged
from .texts import item_word_array, item_words, q

#: Results of a query.
TOP = 10
#: Distinct terms of the queries that are broadcast together; more queries are answered in blocks.
BLOCK_TERMS = 200_000
#: Postings that a task gathers before it answers the queries on them.
BLOCK_POSTINGS = 2_000_000

#: What holds for the score, in whole numbers: a term's weight is ``WEIGHT`` ln((2N+2)/(2df+1)),
#: a document's length counts as 100 - LENGTH + LENGTH n N / L.
WEIGHT, TF, K1, LENGTH = 1000, 1_000_000_000, 8, 75


def _count(terms):
    """Documents as ``(__id, n, ids, tfs)``: all their terms, and the query terms among them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = pickle.loads(terms.value)
        for batch in batches:
            n, ids, tfs = [], [], []
            for cell in batch.column("__text").cast(pa.binary()):
                words = item_words(cell.as_py())
                held = Counter(map(known.get, words))
                held.pop(None, None)
                n.append(len(words))
                ids.append(list(held))
                tfs.append(list(held.values()))
            yield pa.RecordBatch.from_arrays([batch.column("__id"), pa.array(n, pa.int64()), pa.array(ids, pa.list_(pa.int32())), pa.array(tfs, pa.list_(pa.int32()))],
                                             names=["__id", "n", "ids", "tfs"])

    return run


class Block:
    """Postings of the query terms in one block of documents, with their exact scores."""

    def __init__(self, docs: np.ndarray, m: np.ndarray, terms: np.ndarray, tfs: np.ndarray, weights: np.ndarray):
        order = np.argsort(terms, kind="stable")
        self.docs, self.terms = docs[order], terms[order]
        tf = tfs[order].astype(np.int64)
        self.scores = weights[self.terms] * ((TF * tf) // (1000 * tf + K1 * m[self.docs]))
        self.held, self.first = np.unique(self.terms, return_index=True)
        self.last = np.append(self.first[1:], len(self.terms))
        self.place = {int(t): i for i, t in enumerate(self.held)}
        self.most = np.maximum.reduceat(self.scores, self.first) if len(self.held) else np.zeros(0, np.int64)

    def answer(self, query: list[tuple[int, int]], k: int, floor: int, acc: np.ndarray, seen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``(documents, scores)`` that can be among the ``k`` best; ``query`` are (term,
        repeats), rarest first; ``floor`` is a score that ``k`` others reach already.
        ``acc`` and ``seen`` are zero before and after."""
        mine = [(self.place[t], n) for t, n in query if t in self.place]
        left = sum(int(self.most[p]) * n for p, n in mine)
        made, grow, partial = [], True, floor
        for p, n in mine:
            docs, add = self.docs[self.first[p]:self.last[p]], self.scores[self.first[p]:self.last[p]] * n
            if grow and made:
                # the k-th best partial score so far: final scores can only be higher
                held = acc[np.concatenate(made)]
                partial = max(floor, int(np.partition(held, len(held) - k)[len(held) - k]) if len(held) >= k else 0)
                grow = left >= partial
            elif grow:
                grow = left >= partial
            if grow:
                fresh = docs[~seen[docs]]
                seen[fresh] = True
                made.append(fresh)
                acc[docs] += add
            else:
                old = seen[docs]
                acc[docs[old]] += add[old]
            left -= int(self.most[p]) * n
        out = np.concatenate(made) if made else np.zeros(0, np.int64)
        scores = acc[out]
        acc[out], seen[out] = 0, False
        return out, scores


def _best(ids: np.ndarray, null: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Positions of the ``k`` best: score descending, then id ascending, null ids last."""
    if len(scores) > 4 * k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        some = np.flatnonzero(scores >= least)
        return some[_best(ids[some], null[some], scores[some], k)] if len(some) < len(scores) else np.lexsort((ids, null, -scores))[:k]
    return np.lexsort((ids, null, -scores))[:k]


def _search(shared, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries, weights, n_docs, n_terms = pickle.loads(shared.value)
        top: dict[int, list[tuple[int, bool, int]]] = {}

        def answer(parts: list[tuple]) -> None:
            ids, null, n, sizes, terms, tfs = (np.concatenate(x) for x in zip(*parts, strict=True))
            m = 100 - LENGTH + (LENGTH * n * n_docs) // max(1, n_terms)
            block = Block(np.repeat(np.arange(len(ids)), sizes), m, terms, tfs, weights)
            acc, seen = np.zeros(len(ids), np.int64), np.zeros(len(ids), bool)
            for which, query in queries:
                best = top.get(which, [])
                at, scores = block.answer(query, k, best[-1][0] if len(best) == k else 0, acc, seen)
                some = scores > 0
                at, scores = at[some], scores[some]
                if len(at):
                    at = at[(won := _best(ids[at], null[at], scores, k))]
                    fresh = zip(scores[won].tolist(), null[at].tolist(), ids[at].tolist(), strict=True)
                    top[which] = sorted([*best, *fresh], key=lambda r: (-r[0], r[1], r[2]))[:k]

        parts, size = [], 0
        for batch in batches:
            ids = batch.column("__id")
            parts.append((ids.fill_null(0).to_numpy(), ids.is_null().to_numpy(zero_copy_only=False), batch.column("n").to_numpy(),
                          pc.list_value_length(batch.column("ids")).to_numpy(), batch.column("ids").flatten().to_numpy(), batch.column("tfs").flatten().to_numpy()))
            size += len(parts[-1][4])
            if size >= BLOCK_POSTINGS:
                answer(parts)
                parts, size = [], 0
        if parts:
            answer(parts)
        rows = [(which, r[0], None if r[1] else r[2]) for which, best in top.items() for r in best]
        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()), pa.array([r[2] for r in rows], pa.int64())],
                                         names=["__query", "score", "__id"])

    return run


def _blocks(queries: DataFrame, block_terms: int) -> tuple[DataFrame, int]:
    """Queries dealt to blocks, by a hash, so that a block's terms can be broadcast."""
    total = queries.agg(F.sum(F.size("__terms"))).first()[0] or 0
    blocks = max(1, -(-2 * total // block_terms) if total > block_terms else 1)
    return queries.withColumn("__block", F.pmod(F.xxhash64("__query"), F.lit(blocks))), blocks


def ranked_search(docs: DataFrame, queries: DataFrame, id_col: str = "doc_id", text_col: str = "text", query_id: str = "item_id",
                  query_text: str = "text", k: int = TOP, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """``(query_id, rank, id_col, score)``: of every query the ``k`` documents that score
    highest, all above 0 if they are fewer; equal scores by ascending id, a null id last.

    Terms are runs of ASCII letters, digits and non-ASCII characters, A-Z lower-cased; null
    texts have none. Every row of either table stands for itself: queries that repeat an id
    are ranked each, documents that repeat one are ranked each. A query without terms, or
    whose terms no document holds, has no rows; neither have empty tables. Ids of documents
    are integers. Collection figures (documents with a term, terms, documents with each
    term) cover all documents.

    The queries are answered in blocks of about ``block_terms`` terms, which is what the
    broadcast holds; each block reads the documents once, and its postings twice."""
    spark = docs.sparkSession
    if not isinstance(docs.schema[id_col].dataType, T.IntegralType):
        raise ValueError(f"{id_col} must be an integer column")
    asked = queries.select(q(query_id).alias("__name"), q(query_text).alias("__text"))
    asked = asked.select("__name", item_word_array(F.col("__text")).alias("__terms")).filter(F.size("__terms") > 0)
    asked = asked.withColumn("__query", F.monotonically_increasing_id())  # fixed once it is written
    asked, blocks = _blocks(staged(asked, "search_queries"), block_terms)
    plain = docs.select(q(id_col).cast("long").alias("__id"), q(text_col).cast("string").alias("__text"))
    found = None
    for block in range(blocks):
        mine = [(r["__query"], Counter(r["__terms"])) for r in asked.filter(F.col("__block") == block).toLocalIterator()]
        known = {t: i for i, t in enumerate(sorted(set().union(*(terms for _, terms in mine))))}
        shared = spark.sparkContext.broadcast(pickle.dumps({t.encode(): i for t, i in known.items()}))
        index = staged(plain.mapInArrow(_count(shared), "__id long, n long, ids array<int>, tfs array<int>"), "search_index")
        sums = index.agg(F.count(F.when(F.col("n") > 0, 1)), F.sum("n")).first()
        n_docs, n_terms = sums[0] or 0, sums[1] or 0
        df = np.zeros(len(known), np.int64)
        for r in index.select(F.explode("ids").alias("t")).groupBy("t").count().toLocalIterator():
            df[r.t] = r["count"]
        weights = np.floor(WEIGHT * np.log((2 * n_docs + 2) / (2 * df + 1))).astype(np.int64)
        rarest = [(which, sorted(((known[t], n) for t, n in terms.items() if df[known[t]]), key=lambda x: (df[x[0]], x[0]))) for which, terms in mine]
        figures = spark.sparkContext.broadcast(pickle.dumps((rarest, weights, n_docs, n_terms)))
        part = index.filter(F.size("ids") > 0).mapInArrow(_search(figures, k), "__query long, score long, __id long")
        if blocks > 1:
            part = staged(part, "search_found")
        found = part if found is None else found.unionByName(part)
    best = Window.partitionBy("__query").orderBy(F.col("score").desc(), F.col("__id").asc_nulls_last())
    ranked = found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    ranked = ranked.join(asked.select("__query", "__name"), "__query")
    return ranked.select(F.col("__name").alias(query_id), "rank", F.col("__id").alias(id_col), "score")
