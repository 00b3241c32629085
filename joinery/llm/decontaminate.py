"""Benchmark decontamination: a broadcast set of normalised test n-grams, scanned
over the word windows of training documents."""

from __future__ import annotations

import pickle
from collections.abc import Iterator, Sequence
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .staging import staged
from .texts import ITEM_GAP, free_columns, item_bytes, item_word_array, q

#: Words of a window, as the benchmark contract states it.
WINDOW = 10
#: Words of benchmark text that one broadcast may hold (about 16 bytes each, with its n-grams
#: some 100 MB in a Python worker); a larger benchmark takes one scan of the documents per part.
BROADCAST_WORDS = 500_000
#: Window starts in one piece of a long benchmark item.
PIECE = 1_000

SPANS = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))
ADDED = ("n_words", "n_hit", "items", "hit_words", "hit_spans")


class GramIndex:
    """The n-grams of some benchmark pieces: a vocabulary, sorted window hashes for the
    scan and the exact word sequences for verification."""

    def __init__(self, pieces: Sequence[tuple[str, Sequence[str]]], window: int = WINDOW) -> None:
        self.vocab: dict[bytes, int] = {}
        self.items: dict[bytes, list[str]] = {}
        self.names: list[str] = []
        numbers: dict[str, int] = {}
        grams: dict[int, dict[bytes, set[int]]] = {}
        for item, words in pieces:
            ids = np.array([self.vocab.setdefault(w.encode(), len(self.vocab)) for w in words], np.int32)
            length = min(window, len(ids))
            number = numbers.setdefault(item, len(numbers))
            own = grams.setdefault(length, {})
            for i in range(len(ids) - length + 1):
                own.setdefault(ids[i:i + length].tobytes(), set()).add(number)
        self.names = list(numbers)
        self.by_length = {}
        for length, own in grams.items():
            rows = np.frombuffer(b"".join(own), np.int32).reshape(-1, length)
            self.by_length[length] = (np.sort(_rolled(rows)), own)

    def find(self, words: Sequence[bytes]) -> tuple[list[tuple[int, int]], set[int]]:
        """Merged word ranges inside any occurring window, and the numbers of the items."""
        n = len(words)
        ids = np.fromiter(map(self.vocab.get, words, repeat(-1)), np.int32, n)
        unknown = np.concatenate(([0], np.cumsum(ids < 0)))
        hit, items = np.zeros(n + 1, np.int32), set()
        for length, (hashes, own) in self.by_length.items():
            if n < length:
                continue
            at = np.flatnonzero(unknown[length:] == unknown[:-length])
            if not len(at):
                continue
            rows = ids[at[:, None] + np.arange(length)]
            h = _rolled(rows)
            place = np.minimum(np.searchsorted(hashes, h), len(hashes) - 1)
            for k in np.flatnonzero(hashes[place] == h):
                found = own.get(rows[k].tobytes())
                if found is not None:
                    items |= found
                    hit[at[k]] += 1
                    hit[at[k] + length] -= 1
        if not items:
            return [], items
        inside = np.concatenate(([0], (np.cumsum(hit[:n]) > 0).astype(np.int8), [0]))
        edges = np.flatnonzero(np.diff(inside))
        return list(zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True)), items


def _rolled(rows: np.ndarray) -> np.ndarray:
    h = np.zeros(len(rows), np.uint64)
    for j in range(rows.shape[1]):
        h = h * np.uint64(0x9E3779B97F4A7C15) + rows[:, j].astype(np.uint64) + np.uint64(1)
    return h ^ (h >> np.uint64(29))


def _merged(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for s, e in sorted(ranges):
        if out and s <= out[-1][1]:
            out[-1] = (out[-1][0], max(e, out[-1][1]))
        else:
            out.append((s, e))
    return out


def _char_spans(text: bytes, blanked: bytes, ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Word ranges as code point spans of the text."""
    raw = np.frombuffer(blanked, np.uint8)
    inside = np.concatenate(([False], raw != 32, [False]))
    edges = np.flatnonzero(np.diff(inside))
    points = np.concatenate(([0], np.cumsum((np.frombuffer(text, np.uint8) & 0xC0) != 0x80)))
    starts, ends = points[edges[::2]], points[edges[1::2]]
    return [(int(starts[s]), int(ends[e - 1])) for s, e in ranges]


def _scan(index, text_col: str, carry: Sequence[str], first: bool):
    names = None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams = pickle.loads(index.value)
        for batch in batches:
            before = None if first else batch.select(["items", "hit_words"]).to_pylist()
            n_words, n_hit, items, words_at, spans = [], [], [], [], []
            for row, cell in enumerate(batch.column(text_col).cast(pa.binary())):
                text = cell.as_py() or b""
                blanked = item_bytes(text)
                words = blanked.split()
                ranges, found = grams.find(words) if words else ([], set())
                known = {grams.names[k] for k in found} - {None}
                if before and before[row]["hit_words"]:
                    known |= set(before[row]["items"])
                    ranges = _merged(ranges + [(x["start"], x["end"]) for x in before[row]["hit_words"]])
                n_words.append(len(words))
                n_hit.append(sum(e - s for s, e in ranges))
                items.append(sorted(known))
                words_at.append([{"start": s, "end": e} for s, e in ranges])
                spans.append([{"start": s, "end": e} for s, e in _char_spans(text, blanked, ranges)] if ranges else [])
            pair = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in carry], pa.array(n_words, pa.int64()), pa.array(n_hit, pa.int64()),
                 pa.array(items, pa.list_(pa.string())), pa.array(words_at, pair), pa.array(spans, pair)],
                names=[*carry, *ADDED],
            )

    return run


def benchmark_pieces(benchmark: DataFrame, item_col: str = "item_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """``(item, words)``: every item with words, without an id too, cut into overlapping pieces of bounded
    length so that each window lies whole in one piece."""
    words = benchmark.select(q(item_col).cast("string").alias("item"), item_word_array(q(text_col)).alias("w"))
    words = words.filter(F.size("w") > 0)
    last = F.greatest(F.ceil((F.size("w") - (window - 1)) / F.lit(PIECE)).cast("int") - 1, F.lit(0))
    cut = words.select("item", "w", F.explode(F.sequence(F.lit(0), last)).alias("k"))
    return cut.select("item", F.slice("w", F.col("k") * PIECE + 1, F.lit(PIECE + window - 1)).alias("words"))


def scan_contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    text_col: str = "text",
    carry: Sequence[str] | None = None,
    window: int = WINDOW,
    broadcast_words: int = BROADCAST_WORDS,
) -> DataFrame:
    """Every row of ``docs`` (columns ``carry``, default all) with ``n_words``, ``n_hit``
    (words inside an occurring window), ``items`` (ids of occurring items as text, sorted),
    ``hit_words`` and ``hit_spans`` (merged ranges in words and in code points).

    A window is ``window`` consecutive item words of one benchmark item, or the whole item
    when it has fewer. Matches are verified word by word. Null text: no words. An item with
    a null id is hit without a name in ``items``; one without words has no windows. Empty tables give empty or hitless results.

    The n-grams reach the executors as a broadcast of at most ``broadcast_words`` words,
    counted first; a larger benchmark is split by a hash of its pieces and the documents are
    scanned once per part, each scan adding to the ranges of the one before. Every scan but
    the last is written out, so that one part's n-grams live at a time."""
    spark = docs.sparkSession
    pieces = benchmark_pieces(benchmark, window=window)
    total = pieces.agg(F.sum(F.size("words"))).first()[0] or 0
    parts = max(1, -(-total // max(1, broadcast_words // 2)) if total > broadcast_words else 1)
    out = docs if carry is None else docs.select(*[q(c) for c in dict.fromkeys([*carry, text_col])])
    keep = free_columns(out, ADDED)
    out = out.select(*[q(c) for c in keep])
    for part in range(parts):
        mine = pieces if parts == 1 else pieces.filter(F.pmod(F.xxhash64("item", "words"), F.lit(parts)) == part)
        grams = GramIndex([(r.item, r.words) for r in mine.toLocalIterator()], window)
        index = spark.sparkContext.broadcast(cloudpickle.dumps(grams))
        final = part == parts - 1
        kept = [c for c in keep if not final or carry is None or c in carry]
        fields = [f for c in kept for f in out.schema.fields if f.name == c]
        schema = T.StructType([
            *fields, T.StructField("n_words", T.LongType()), T.StructField("n_hit", T.LongType()),
            T.StructField("items", T.ArrayType(T.StringType())), T.StructField("hit_words", SPANS), T.StructField("hit_spans", SPANS),
        ])
        out = out.mapInArrow(_scan(index, text_col, kept, part == 0), schema)
        if not final:
            out = staged(out, "decontaminate")
            index.destroy()
    return out


def cut_spans(text, spans):
    """``text`` without the code point spans (sorted, apart), each gap closed by one blank."""
    starts = F.concat(F.array(F.lit(0)), F.transform(spans, lambda s: s["end"]))
    ends = F.concat(F.transform(spans, lambda s: s["start"]), F.array(F.length(text)))
    pieces = F.zip_with(starts, ends, lambda s, e: F.substring(text, s + 1, e - s))
    return F.when(F.size(spans) > 0, F.array_join(pieces, " ")).otherwise(text)


def decontaminate(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", remove: str = "documents") -> DataFrame:
    """``docs`` (its columns) without contamination: hit rows dropped
    (``remove="documents"``) or their hit spans cut out of the text (``"spans"``). Rows
    without a hit come back unchanged."""
    if remove not in ("documents", "spans"):
        raise ValueError("remove must be 'documents' or 'spans'")
    plain = docs.select(*[q(c).alias(f"__c{i}") for i, c in enumerate(docs.columns)])
    text = f"__c{docs.columns.index(text_col)}"
    scanned = scan_contamination(plain, benchmark, text)
    if remove == "documents":
        scanned = scanned.filter("n_hit = 0")
    else:
        scanned = scanned.withColumn(text, cut_spans(F.col(text), F.col("hit_spans")))
    return scanned.select(*[F.col(f"__c{i}").alias(c) for i, c in enumerate(docs.columns)])
