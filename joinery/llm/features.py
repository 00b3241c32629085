"""Hashed text features and the labelled sample that the classifiers learn from."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .staging import staged
from .texts import held_out, item_words, q

#: Hash space of the features.
BITS = 20
#: Labelled rows a model learns from: all of them up to this expected number, beyond it a
#: share chosen by a hash of id and text.
SAMPLE_ROWS = 20_000
#: Rows of a shard, on average; shards learn side by side and are averaged.
SHARD_ROWS = 5_000
#: Bytes of a stem.
STEM = 5

Extract = Callable[[bytes | None], np.ndarray]


def _slots(h: np.ndarray) -> np.ndarray:
    return ((h * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - BITS)).astype(np.int32)


def word_grams(text: bytes | None) -> np.ndarray:
    """Distinct slots of the words, their stems (first bytes, so that an inflected word is
    known by its root), word pairs and pairs that skip one word."""
    words = item_words(text)
    h = np.fromiter(map(crc32, words), np.uint64, len(words)) + np.uint64(1)
    pairs = h[:-1] * np.uint64(0x2545F491) + h[1:]
    stems = np.fromiter(map(crc32, [w[:STEM] for w in words]), np.uint64, len(words)) + np.uint64(1 << 61)
    skips = h[:-2] * np.uint64(0x6C8E9CF5) + h[2:] + np.uint64(1 << 60)
    seen = np.zeros(1 << BITS, bool) if len(h) > 50_000 else None
    slots = _slots(np.concatenate((h, stems, pairs, skips)))
    if seen is None:
        return np.unique(slots)
    seen[slots] = True
    return np.flatnonzero(seen).astype(np.int32)


class _Shapes(dict):
    """Token class strings with repeats squeezed, numbered by a hash; forgets when large."""

    def __missing__(self, token: bytes) -> int:
        if len(self) > 200_000:
            self.clear()
        squeezed = bytes(c for i, c in enumerate(token) if not i or token[i - 1] != c)
        self[token] = out = crc32(squeezed)
        return out


_CLASSES = bytes(
    65 if 65 <= b <= 90 else 97 if 97 <= b <= 122 or b >= 128 else 48 if 48 <= b <= 57 else b for b in range(256)
)
_SHAPES = _Shapes()


def style_grams(text: bytes | None) -> np.ndarray:
    """Distinct slots of the words and of the text's manner: which share of its tokens has
    each shape (``Aa``, ``A!``, ``|``, ...), how varied the words are, how long it is."""
    text = text or b""
    words = item_words(text)
    n = len(words)
    h = np.fromiter(map(crc32, words), np.uint64, n)
    distinct = np.unique(h)
    tokens = text.translate(_CLASSES).split()
    shape, count = np.unique(np.fromiter(map(_SHAPES.__getitem__, tokens), np.uint64, len(tokens)), return_counts=True)
    share = np.ceil(np.log2(count / max(1, len(tokens)) + 1e-9)).clip(-9, 0).astype(np.int64).astype(np.uint64)
    longest = int(count.max()) if len(count) else 0
    manner = [
        (1 << 40) + round(12 * len(distinct) / n) if n else 1 << 41,
        (1 << 42) + int(math.log2(len(tokens) + 1)),
        (1 << 43) + round(12 * longest / max(1, len(tokens))),
        (1 << 44) + round(4 * len(text) / max(1, len(tokens))) // 2,
        (1 << 45) + round(math.log2(n + 1) - math.log2(len(distinct) + 1)),
    ]
    kinds = shape * np.uint64(0x2545F491) + share + np.uint64(1 << 46)
    return np.unique(_slots(np.concatenate((distinct + np.uint64(1), kinds, np.array(manner, np.uint64)))))


def labelled_features(docs: DataFrame, labels: DataFrame, target: str, extract: Extract,
                      text_col: str = "text", id_col: str = "doc_id", sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """``(shard, ordr, y, slots)`` of the labelled documents that are not held out, each
    different text of an id once: all of them or a hashed share of about ``sample_rows``;
    ``target`` is a column of ``labels``. Both the sample and the shards go by id and text,
    so an id with many texts is dealt over all shards and counts for the bound with each.
    A null or conflicting label: nulls are left out, the largest label of an id counts."""
    known = (
        labels.filter(q(id_col).isNotNull() & ~held_out(q(id_col)))
        .groupBy(q(id_col).alias("__id")).agg(F.max(q(target)).alias("__y")).filter(F.col("__y").isNotNull())
    )
    total = known.count()
    if total > sample_rows:
        known = known.filter(F.pmod(F.xxhash64("__id"), F.lit(1_000_000)) < int(1_000_000 * sample_rows / total))
    # at most about sample_rows pairs of numbers, so the broadcast is bounded
    rows = docs.select(q(id_col).alias("__id"), q(text_col).cast("string").alias("__text")).join(F.broadcast(known), "__id")
    rows = rows.withColumn("ordr", F.xxhash64("__id", "__text"))
    pairs = rows.select("__id", "ordr").distinct().count()
    if pairs > 1.1 * sample_rows:
        rows = rows.filter(F.pmod(F.xxhash64("ordr", F.lit(2)), F.lit(1_000_000)) < int(1_000_000 * sample_rows / pairs))
    shards = -(-max(1, min(pairs, sample_rows)) // SHARD_ROWS)
    rows = rows.groupBy("__id", "ordr").agg(F.max("__y").cast("int").alias("y"), F.max("__text").alias("__text"))
    rows = rows.select(F.pmod(F.xxhash64("ordr", F.lit(1)), F.lit(shards)).cast("int").alias("shard"), "ordr", "y", "__text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            slots = [extract(x.as_py()) for x in batch.column("__text").cast(pa.binary())]
            yield pa.RecordBatch.from_arrays(
                [batch.column("shard"), batch.column("ordr"), batch.column("y"), pa.array(slots, pa.list_(pa.int32()))],
                names=["shard", "ordr", "y", "slots"],
            )

    return rows.mapInArrow(run, "shard int, ordr bigint, y int, slots array<int>")


def in_order(table: pa.Table) -> tuple[np.ndarray, list[np.ndarray]]:
    """Labels and slots of a shard in an order that a rerun repeats."""
    table = table.sort_by("ordr")
    column = table.column("slots").combine_chunks()
    flat, ends = column.flatten().to_numpy(), column.offsets.to_numpy()
    return table.column("y").to_numpy(), [flat[s:e] for s, e in zip(ends[:-1], ends[1:], strict=True)]


def averaged(parts: DataFrame, size: int) -> np.ndarray:
    """The mean over shards of ``(slot, weight)`` rows, which are written out, so that the
    shards learn once; at most ``size`` rows come back."""
    parts = staged(parts, "weights")
    shards = max(1, parts.select("shard").distinct().count())
    out = np.zeros(size, np.float64)
    for r in parts.groupBy("slot").agg(F.sum("weight").alias("w")).filter("w <> 0").toLocalIterator():
        out[r.slot] = r.w / shards
    return out


def scored(docs: DataFrame, carry: list[str], text_col: str, names: list[str], score, extract: Extract) -> DataFrame:
    """``carry`` and double columns ``names`` for every row: ``score(slots) -> values``."""
    rows = docs.select(*[q(c) for c in carry], q(text_col).cast("string").alias("__text"))
    ddl = [f for f in rows.schema.fields if f.name != "__text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [score(extract(x.as_py())) for x in batch.column("__text").cast(pa.binary())]
            cols = [pa.array([v[i] for v in values], pa.float64()) for i in range(len(names))]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in carry], *cols], names=[*carry, *names])

    schema = docs.sparkSession.createDataFrame([], ", ".join(f"{n} double" for n in names)).schema
    return rows.mapInArrow(run, type(schema)([*ddl, *schema.fields]))
