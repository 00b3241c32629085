"""MinHash near-duplicates with odd sketches (Mitzenmacher, Pagh, Pham 2014).

A document's MinHash samples are folded twice: in bands, whose equal values propose
pairs, and into a parity bitmap (each sample flips one bit). The population count of the
XOR of two bitmaps estimates how many samples differ, precisely where similarity is high,
so most proposed pairs fall away without their texts. Those that remain are confirmed on
their full shingle sets."""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce
from operator import add

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .components import connected_components
from .staging import staged
from .texts import blank_words, int64s, lists, mix64, q, word_hashes

#: Bands and samples per band: a pair at similarity 0.8 shares no band with probability
#: (1 - 0.8 ** 6) ** 32 = 6e-5, one at 0.85 with 4e-8.
BANDS, ROWS = 32, 6
#: MinHash samples in a sketch (the bands use the first of them) and its 64-bit words.
SAMPLES, SKETCH_LONGS = 1024, 32
#: Standard deviations by which a sketch may miss the threshold: a pair right at it falls
#: away with probability 3e-5, half of what the bands lose.
SLACK = 4.0
#: Members of one side of a block when an unsettled bucket is compared in blocks.
BLOCK = 2_048

_RNG = np.random.default_rng(20240229)
_XOR = _RNG.integers(0, 1 << 32, SAMPLES, dtype=np.uint32)[:, None]
_MUL = (_RNG.integers(0, 1 << 32, SAMPLES, dtype=np.uint32) | np.uint32(1))[:, None]
_SKETCH = [f"s{i}" for i in range(SKETCH_LONGS)]


def shingle_set(words: list[bytes], width: int) -> np.ndarray:
    """The distinct shingles as sorted 64-bit hashes; fewer words than ``width`` make one."""
    n = len(words)
    if not n:
        return np.empty(0, np.uint64)
    h = word_hashes(words)
    if n < width:
        acc = np.uint64(n)
        for x in h:
            acc = mix64(np.array([acc], np.uint64) + x)[0]
        return np.array([acc], np.uint64)
    acc = np.zeros(n - width + 1, np.uint64)
    for j in range(width):
        acc = mix64(acc + h[j:n - width + 1 + j])
    return np.unique(acc)


def minhash(shingles: np.ndarray) -> np.ndarray:
    """One 32-bit minimum per sample."""
    x = (shingles >> np.uint64(32)).astype(np.uint32)
    low = np.full(SAMPLES, 0xFFFFFFFF, np.uint32)
    for k in range(0, len(x), 256):
        y = x[k:k + 256] ^ _XOR
        y *= _MUL
        np.minimum(low, y.min(axis=1), out=low)
    return low


def odd_sketch(samples: np.ndarray) -> np.ndarray:
    """Parity bitmap: sample i with value v flips bit hash(i, v)."""
    bit = mix64((np.arange(SAMPLES, dtype=np.uint64) << np.uint64(32)) | samples) >> np.uint64(64 - 6 - int(math.log2(SKETCH_LONGS)))
    odd = np.flatnonzero(np.bincount(bit.astype(np.int64), minlength=64 * SKETCH_LONGS) & 1)
    out = np.zeros(SKETCH_LONGS, np.uint64)
    np.bitwise_xor.at(out, odd >> 6, np.uint64(1) << (odd & 63).astype(np.uint64))
    return out


def sketch_limit(similarity: float) -> int:
    """Largest XOR population count of a pair that may reach ``similarity``.

    Of k samples k (1 - J) differ on average, and each differing one flips two of the n
    bits of the XOR. The limit is the mean of the odd bits plus ``SLACK`` deviations, of the
    samples and of the flips that fall together."""
    n, k = 64 * SKETCH_LONGS, SAMPLES
    m = 2 * k * (1 - similarity)
    lone, twin = (1 - 2 / n) ** m, (1 - 4 / n) ** m
    folding = n / 4 * (1 - twin) + n * n / 4 * (twin - lone * lone)
    sampling = 4 * k * similarity * (1 - similarity) * lone * lone
    return math.ceil(n / 2 * (1 - lone) + SLACK * math.sqrt(max(0.0, folding) + sampling))


def _signatures(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            count, node, bands, sketches = [], [], [], []
            for cell in batch.column("__text").cast(pa.binary()):
                own = shingle_set(blank_words(cell.as_py()), width)
                count.append(len(own))
                if not len(own):
                    node.append(0)
                    bands.append(np.empty(0, np.uint64))
                    sketches.append(np.zeros(SKETCH_LONGS, np.uint64))
                    continue
                node.append(int(mix64(np.array([np.bitwise_xor.reduce(mix64(own)) + np.uint64(len(own))], np.uint64))[0] >> np.uint64(1)))
                low = minhash(own)
                key = np.arange(BANDS, dtype=np.uint64)
                for part in low[:BANDS * ROWS].reshape(BANDS, ROWS).T:
                    key = mix64(key + part)
                bands.append(key)
                sketches.append(odd_sketch(low))
            ends = np.concatenate(([0], np.cumsum([len(b) for b in bands])))
            flat = pa.array(int64s(np.concatenate(bands))) if bands else pa.array([], pa.int64())
            table = int64s(np.array(sketches, np.uint64).reshape(-1, SKETCH_LONGS))
            yield pa.RecordBatch.from_arrays(
                [batch.column("__id"), batch.column("__th"), pa.array(count, pa.int64()), pa.array(node, pa.int64()),
                 lists(ends, flat), *[pa.array(np.ascontiguousarray(table[:, i])) for i in range(SKETCH_LONGS)]],
                names=["__id", "__th", "n_shingles", "node", "bands", *_SKETCH],
            )

    return run


def _confirm(width: int, percent: int):
    """Pairs whose sets reach the similarity, decided in whole numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, left = None, None  # pairs come sorted by their first member
        for batch in batches:
            a, b = [], []
            for one, two, ta, tb in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist(),
                                        batch.column("ta").cast(pa.binary()), batch.column("tb").cast(pa.binary()), strict=True):
                if one != last:
                    last, left = one, shingle_set(blank_words(ta.as_py()), width)
                right = shingle_set(blank_words(tb.as_py()), width)
                both = len(np.intersect1d(left, right, assume_unique=True))
                if 100 * both >= percent * (len(left) + len(right) - both):
                    a.append(one)
                    b.append(two)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return run


def _cross_pairs(limit: int):
    """Within a block pair of an unsettled bucket: the pairs of different components whose
    sketches allow the similarity. Members of the largest component are not compared with
    each other, so the work is (members outside it) x (members). A pair that meets in
    several buckets counts in the first of its common bands only."""

    def run(table: pa.Table) -> pa.Table:
        sketch = np.column_stack([table.column(s).to_numpy() for s in _SKETCH]).view(np.uint64)
        node, comp = table.column("node").to_numpy(), table.column("comp").to_numpy()
        side, diagonal = table.column("t").to_numpy(), table.column("i")[0] == table.column("j")[0]
        bands = table.column("bands").combine_chunks().flatten().to_numpy().reshape(len(node), -1)
        bucket = table.column("bucket")[0].as_py()
        names, size = np.unique(comp, return_counts=True)
        largest = names[size.argmax()]
        a, b = [], []
        for x in np.flatnonzero(comp != largest):
            other = (comp != comp[x]) & ((comp == largest) | (node > node[x]))
            if not diagonal:
                other &= side != side[x]
            at = np.flatnonzero(other)
            if len(at):
                near = at[np.bitwise_count(sketch[at] ^ sketch[x]).sum(axis=1) <= limit]
                first = (bands[near] == bands[x]).argmax(axis=1)
                near = near[bands[x][first] == bucket]
                a.append(np.minimum(node[near], node[x]))
                b.append(np.maximum(node[near], node[x]))
        none = [np.empty(0, np.int64)]
        return pa.table({"a": pa.array(np.concatenate(a or none)), "b": pa.array(np.concatenate(b or none))})

    return run


class NearDuplicates:
    """The parts of the job over ``docs``; ``rows`` has the result."""

    def __init__(self, docs: DataFrame, id_col: str, text_col: str, width: int, percent: int) -> None:
        self.width, self.percent = width, percent
        self.limit = sketch_limit(percent / 100)
        self.docs = docs.select(q(id_col).alias("__id"), q(text_col).cast("string").alias("__text")).withColumn("__th", F.xxhash64("__text"))
        fields = [f for f in self.docs.schema.fields if f.name == "__id"]
        schema = T.StructType([*fields, *T.StructType.fromDDL(
            "__th long, n_shingles long, node long, bands array<long>, " + ", ".join(f"{s} long" for s in _SKETCH)).fields])
        self.signed = staged(self.docs.select("__id", "__th", "__text").mapInArrow(_signatures(width), schema), "nd_signatures")
        # one class per distinct set, however many rows hold it, led by its smallest id
        lead = F.struct(F.col("__id").isNull().alias("no"), F.col("__id").alias("id"), F.col("__th").alias("th"))
        classes = self.signed.filter("n_shingles > 0").groupBy("node").agg(
            F.min(lead).alias("lead"), F.first("bands").alias("bands"), *[F.first(s).alias(s) for s in _SKETCH])
        self.classes = staged(classes, "nd_classes")

    def buckets(self) -> DataFrame:
        """(bucket, node, n) of every bucket that ``n`` > 1 different sets share."""
        members = self.classes.select(F.explode("bands").alias("bucket"), "node")
        shared = members.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))
        return staged(members.join(shared.filter("n > 1"), "bucket"), "nd_buckets")

    @staticmethod
    def stars(buckets: DataFrame) -> DataFrame:
        """Pairs of every bucket's members with its hub and its smallest node. The hub is
        the member that meets most others over all buckets: the text that the rest of a
        group was made from is nearer to each of them than they are to one another."""
        crowd = buckets.groupBy("node").agg(F.sum(F.col("n") - 1).alias("crowd"))
        heads = buckets.join(crowd, "node").groupBy("bucket").agg(
            F.max(F.struct("crowd", "node")).getField("node").alias("hub"), F.min("node").alias("low"))
        joined = buckets.join(heads, "bucket")
        return joined.select(F.least("node", "hub").alias("a"), F.greatest("node", "hub").alias("b")).union(
            joined.select(F.least("node", "low").alias("a"), F.greatest("node", "low").alias("b"))).filter("a < b").distinct()

    def sketched(self, pairs: DataFrame) -> DataFrame:
        """The pairs (a < b) whose sketches allow the similarity."""
        left = self.classes.select(F.col("node").alias("a"), *[F.col(s).alias(f"a{s}") for s in _SKETCH])
        right = self.classes.select(F.col("node").alias("b"), *[F.col(s).alias(f"b{s}") for s in _SKETCH])
        apart = reduce(add, [F.bit_count(F.col(f"a{s}").bitwiseXOR(F.col(f"b{s}"))) for s in _SKETCH])
        return pairs.join(left, "a").join(right, "b").filter(apart <= self.limit).select("a", "b")

    def confirmed(self, near: DataFrame) -> DataFrame:
        """The pairs that reach the similarity on their full sets."""
        near = staged(near, "nd_near")
        # only texts of a surviving pair travel, one for each set
        wanted = near.select(F.col("a").alias("node")).union(near.select("b")).distinct().join(self.classes.select("node", "lead"), "node")
        wanted = wanted.select("node", F.col("lead.id").alias("__wid"), F.col("lead.th").alias("__wth"))
        texts = self.docs.join(wanted, F.col("__id").eqNullSafe(F.col("__wid")) & (F.col("__th") == F.col("__wth")))
        texts = staged(texts.dropDuplicates(["__wid", "__wth"]).select("node", "__text"), "nd_texts")
        both = near.join(texts.select(F.col("node").alias("b"), F.col("__text").alias("tb")), "b")
        both = both.join(texts.select(F.col("node").alias("a"), F.col("__text").alias("ta")), "a")
        both = both.select("a", "b", "ta", "tb").sortWithinPartitions("a")
        return staged(both.mapInArrow(_confirm(self.width, self.percent), "a long, b long"), "nd_links")

    def links(self) -> DataFrame:
        """Links that connect every component: first each bucket's members with its
        hub and its smallest node, then, for buckets still in several components, all
        pairs between them that the sketches allow, in blocks."""
        buckets = self.buckets()
        tried = staged(self.stars(buckets), "nd_star")
        links = self.confirmed(self.sketched(tried))
        comp = connected_components(links).withColumnRenamed("root", "comp")
        placed = buckets.join(comp, "node", "left").select("bucket", "node", "n", F.coalesce("comp", "node").alias("comp"))
        # two members have met already
        open_ = placed.groupBy("bucket").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.max("n").alias("n"))
        open_ = open_.filter("lo < hi and n > 2").select("bucket")
        sketch = self.classes.select("node", "bands", *_SKETCH)
        blocks = F.ceil(F.col("n") / F.lit(BLOCK)).cast("int")
        rows = placed.join(open_, "bucket").join(sketch, "node").withColumn("t", F.pmod(F.xxhash64("node"), blocks).cast("int"))
        rows = rows.withColumn("o", F.explode(F.sequence(F.lit(0), blocks - 1)))
        rows = rows.withColumn("i", F.least("t", "o")).withColumn("j", F.greatest("t", "o")).drop("o", "n")
        more = rows.groupBy("bucket", "i", "j").applyInArrow(_cross_pairs(self.limit), "a long, b long")
        more = self.confirmed(more.join(tried, ["a", "b"], "left_anti"))
        return links.union(more)

    def rows(self) -> DataFrame:
        """``__id, __th, n_shingles, component_id, kept`` for every input row."""
        comp = connected_components(self.links())
        placed = self.classes.select("node", "lead").join(comp, "node", "left").withColumn("root", F.coalesce("root", "node"))
        least = placed.groupBy("root").agg(F.min("lead").alias("first"))
        placed = placed.join(least, "root").select("node", F.col("first.id").alias("component_id"), F.col("first.th").alias("keep_th"))
        own = self.signed.select("__id", "__th", "n_shingles", "node").join(placed, "node", "left")
        alone = F.col("n_shingles") == 0
        return own.select(
            "__id", "__th", "n_shingles", F.when(alone, F.col("__id")).otherwise(F.col("component_id")).alias("component_id"),
            F.when(alone, F.col("__th")).otherwise(F.col("keep_th")).alias("keep_th"),
        ).withColumn("kept", F.col("__id").eqNullSafe(F.col("component_id")))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, percent: int = 80) -> DataFrame:
    """One row per input row: ``id_col``, ``n_shingles`` (distinct shingles of ``width``
    words), ``component_id`` (smallest id reachable by links, its own included) and ``kept``
    (the row's id is that id).

    Two documents are linked when 100 x common shingles >= ``percent`` x shingles of either.
    Equal sets form one class, so copies cost one row. A document without words is linked
    with nothing. Rows that repeat an id are compared like any others. A row with a null id
    takes part; it is kept only if all ids of its component are null. An empty table gives
    an empty result."""
    rows = NearDuplicates(docs, id_col, text_col, width, percent).rows()
    return rows.select(F.col("__id").alias(id_col), "n_shingles", "component_id", "kept")


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` (its columns) with one row of each component: the smallest id's, of rows
    that share it the one whose text hashes lowest, of identical rows any one. Rows without
    words all stay, except exact repeats of id and text."""
    rows = NearDuplicates(docs, id_col, text_col, width, percent).rows()
    keep = rows.filter("kept and __th = keep_th").select(F.col("__id").alias("__kid"), F.col("__th").alias("__kth")).distinct()
    plain = docs.select(*[q(c).alias(f"__c{i}") for i, c in enumerate(docs.columns)])
    ident, text = (f"__c{docs.columns.index(c)}" for c in (id_col, text_col))
    plain = plain.withColumn("__th", F.xxhash64(F.col(text).cast("string")))
    kept = plain.join(keep, F.col(ident).eqNullSafe(F.col("__kid")) & (F.col("__th") == F.col("__kth")), "left_semi")
    kept = kept.dropDuplicates([ident, "__th"])
    return kept.select(*[F.col(f"__c{i}").alias(c) for i, c in enumerate(docs.columns)])


