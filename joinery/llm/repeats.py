"""Substring dedup: passages that an earlier document holds too are confirmed by joins of
window hashes, compiled into sharded Aho-Corasick automata over word ids, and every document
that may hold one is streamed through its shards; the occurrences found, word for word, go.

A window is ``WINDOW`` consecutive words of one text. The work is laid out so that what is
shuffled is a small share of the texts:

1. Each window picks the least hash of its ``GRAM``-word grams, its *anchor*: equal windows
   pick equal anchors, and neighbours mostly share theirs, so a text has few. Anchors held
   under two ids are aggregated first.
2. Only windows with such an anchor are hashed, and each recurring one is given its owner,
   the text with the smallest id that holds it. Owners' runs of owned windows are the
   *passages*.
3. A passage is cut into blocks of half a window: every window inside it holds a whole block.
   The blocks of a shard's passages become one automaton; the stretches of later texts that
   wait for these passages pass through it, and each hit is grown word by word."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .staging import staged
from .texts import free_columns, int64s, mix64, q, word_hashes

#: Words of a window.
WINDOW = 50
#: Words of an automaton shard's passages and of the stretches sent to it, about.
SHARD_WORDS = 200_000
#: Texts that wait for one owner's passages and go to one copy of them.
COPY_TEXTS = 2000
ADDED = ("n_words", "n_removed", "removed")
NO_ID = 2**63 - 1

_BASE = 0x9E3779B97F4A7C15
_BACK = pow(_BASE, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.cumprod(out)


def rolling(hashes: np.ndarray, width: int) -> np.ndarray:
    """The hash of every ``width`` consecutive values."""
    n = len(hashes)
    if n < width:
        return np.zeros(0, np.uint64)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(hashes * _powers(_BASE, n), out=sums[1:])
    return mix64((sums[width:] - sums[:-width]) * _powers(_BACK, n - width + 1))


def least_of(values: np.ndarray, width: int) -> np.ndarray:
    """The least of every ``width`` consecutive values."""
    step = 1
    while step * 2 <= width:
        values = np.minimum(values[:-step], values[step:])
        step *= 2
    rest = width - step
    return np.minimum(values[:-rest], values[rest:]) if rest else values


def anchors(hashes: np.ndarray, window: int) -> np.ndarray:
    """The anchor of every window of a text with these word hashes."""
    gram = max(1, window // 3)
    return least_of(rolling(hashes, gram), window - gram + 1) if len(hashes) >= window else np.zeros(0, np.uint64)


def runs(starts: Sequence[int], window: int) -> list[tuple[int, int]]:
    """Merged word ranges of windows that start at ``starts``; windows one word apart only
    are one range."""
    out: list[tuple[int, int]] = []
    for s in sorted(set(starts)):
        if out and out[-1][1] == s + window - 1:
            out[-1] = (out[-1][0], s + window)
        else:
            out.append((s, s + window))
    return out


def _anchor_table(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_words, found = [], []
            for cell in batch.column("__text").cast(pa.binary()):
                words = (cell.as_py() or b"").split()
                n_words.append(len(words))
                found.append(int64s(np.unique(anchors(word_hashes(words), window))) if len(words) >= window else [])
            yield pa.RecordBatch.from_arrays([batch.column("th"), batch.column("ord"), pa.array(n_words, pa.int64()), pa.array(found, pa.list_(pa.int64()))],
                                             names=["th", "ord", "n_words", "anchors"])

    return run


def _windows(window: int):
    """Of a text with its recurring anchors: the windows that have one, and the words of the
    stretches these cover."""
    stretch = pa.list_(pa.struct([("start", pa.int32()), ("words", pa.string())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cols: list[list] = [[], [], [], []]
            for cell, known in zip(batch.column("__text").cast(pa.binary()), batch.column("known"), strict=True):
                words = cell.as_py().split()
                hashes = word_hashes(words)
                picked = anchors(hashes, window)
                at = np.flatnonzero(np.isin(picked, known.values.to_numpy().view(np.uint64)))
                # a second hash of the words: not of the sums that the anchors come from
                whole = rolling(mix64(hashes ^ np.uint64(_BACK)), window)
                cols[0].append(int64s(picked[at]))
                cols[1].append(int64s(whole[at]))
                cols[2].append(at.astype(np.int32))
                cols[3].append([{"start": a, "words": b" ".join(words[a:b]).decode()} for a, b in runs(at.tolist(), window)])
            kinds = (pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.int32()), stretch)
            yield pa.RecordBatch.from_arrays([batch.column("k"), batch.column("ord"), *[pa.array(c, t) for c, t in zip(cols, kinds, strict=True)]],
                                             names=["k", "ord", "anchor", "whole", "at", "stretches"])

    return run


def _cut(window: int, name: str):
    """The words of the runs of windows ``at``, out of a text's stretches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for row in batch.to_pylist():
                held = [(s["start"], s["words"].split(" ")) for s in row["stretches"]]
                which = 0
                for a, b in runs(row["at"], window):
                    while held[which][0] + len(held[which][1]) < b:
                        which += 1
                    start, words = held[which]
                    out.append((row["owner"], row[name], a, b - a, " ".join(words[a - start:b - start])))
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.string()))],
                                             names=["owner", name, "start", "n", "words"])

    return run


class PhraseAutomaton:
    """An Aho-Corasick automaton over the word ids of passages, each under its owner."""

    def __init__(self, window: int):
        self.window, self.block = window, max(1, window // 2)
        self.ids: dict[str, int] = {}
        self.passages: list[list[int]] = []
        self.places: list[dict[int, list[tuple[int, int]]]] = []
        self.blocks: dict[tuple[int, ...], int] = {}
        self.automaton = None

    def add(self, owner: int, words: str) -> None:
        ids = self.ids
        passage = [ids.setdefault(w, len(ids) + 1) for w in words.split(" ")]
        self.passages.append(passage)
        for at in range(0, len(passage) - self.block + 1, self.block):
            key = tuple(passage[at:at + self.block])
            n = self.blocks.setdefault(key, len(self.blocks))
            if n == len(self.places):
                self.places.append({})
            self.places[n].setdefault(owner, []).append((len(self.passages) - 1, at))

    def compile(self) -> None:
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS, ahocorasick.KEY_SEQUENCE)
        for key, n in self.blocks.items():
            self.automaton.add_word(key, n)
        if self.blocks:
            self.automaton.make_automaton()
        self.blocks = {}

    def find(self, owner: int, words: str) -> list[tuple[int, int]]:
        """Merged ranges of the words that lie in a window of a passage of ``owner``."""
        text = [self.ids.get(w, 0) for w in words.split(" ")]
        found: list[tuple[int, int]] = []
        seen: dict[int, int] = {}  # by diagonal of a passage: how far it is known
        for last, n in self.automaton.iter(tuple(text)) if self.places else ():
            first = last - self.block + 1
            for which, at in self.places[n].get(owner, ()):
                passage, line = self.passages[which], (which << 40) + first - at + (1 << 32)
                if seen.get(line, -1) > last:
                    continue
                a, i = first, at
                while a and i and text[a - 1] == passage[i - 1]:
                    a, i = a - 1, i - 1
                b, i = last + 1, at + self.block
                while b < len(text) and i < len(passage) and text[b] == passage[i]:
                    b, i = b + 1, i + 1
                seen[line] = b
                if b - a >= self.window:
                    found.append((a, b))
        return merged(found)


def merged(ranges: Sequence[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(ranges):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], b))
        else:
            out.append((a, b))
    return out


def _locate(window: int):
    """A task's rows come sorted: of each shard first the passages (k null), then the
    stretches, of which one batch lives at a time beside the shard's automaton."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, phrases = None, PhraseAutomaton(window)
        for batch in batches:
            ks, starts, ends = [], [], []
            for s, owner, k, start, words in zip(*[batch.column(c).to_pylist() for c in ("shard", "owner", "k", "start", "words")], strict=True):
                if s != shard:
                    shard, phrases = s, PhraseAutomaton(window)
                if k is None:
                    phrases.add(owner, words)
                    continue
                if phrases.automaton is None:
                    phrases.compile()
                for a, b in phrases.find(owner, words):
                    ks.append(k)
                    starts.append(start + a)
                    ends.append(start + b)
            yield pa.RecordBatch.from_arrays([pa.array(ks, pa.int64()), pa.array(starts, pa.int32()), pa.array(ends, pa.int32())], names=["k", "start", "end"])

    return run


_RANGES = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))


def _without(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows that lose words: their text is what is left of it, joined by blanks."""
    for batch in batches:
        at = batch.schema.get_field_index("__text")
        texts, left, gone = [], [], []
        for text, found in zip(batch.column(at).cast(pa.binary()), batch.column("removed"), strict=True):
            text, found = text.as_py(), merged([(r["start"], r["end"]) for r in found.as_py() or ()])
            if found:
                words, kept, end = text.split(), [], 0
                for a, b in found:
                    kept += words[end:a]
                    end = b
                text = b" ".join(kept + words[end:])
            texts.append(text)
            left.append(sum(b - a for a, b in found))
            gone.append([{"start": a, "end": b} for a, b in found])
        cols = [*batch.columns]
        cols[at] = pa.array(texts, pa.binary()).cast(pa.string())
        cols[batch.schema.get_field_index("n_removed")] = pa.array(left, pa.int64())
        cols[batch.schema.get_field_index("removed")] = pa.array(gone, _RANGES)
        yield pa.RecordBatch.from_arrays(cols, names=batch.schema.names)


def repeated_ranges(rows: DataFrame, window: int = WINDOW, shard_words: int = SHARD_WORDS) -> DataFrame:
    """Per distinct text of ``rows`` (th, ord, __text): ``th``, ``ord`` (the least), its
    ``n_words`` and ``ranges``, the words of windows that a text with a smaller ``ord`` holds."""
    listed = rows.mapInArrow(_anchor_table(window), "th binary, ord long, n_words long, anchors array<long>")
    texts = listed.groupBy("th").agg(F.min("ord").alias("ord"), F.first("n_words").alias("n_words"), F.first("anchors").alias("anchors"))
    texts = staged(texts.withColumn("k", F.monotonically_increasing_id()), "rep_texts")  # k: fixed once it is written
    posted = texts.select("k", "ord", F.explode("anchors").alias("h"))
    known = posted.groupBy("h").agg(F.min("ord").alias("a"), F.max("ord").alias("b")).filter("a < b").select("h")
    known = posted.join(known, "h").groupBy("k").agg(F.collect_list("h").alias("known"))
    known = staged(texts.select("k", "th", "ord").join(known, "k"), "rep_known")

    cand = rows.select("th", "ord", "__text").join(known.hint("merge"), ["th", "ord"])
    cand = cand.select("k", "ord", "known", "__text").mapInArrow(
        _windows(window), "k long, ord long, anchor array<long>, whole array<long>, at array<int>, stretches array<struct<start:int,words:string>>")
    # rows that repeat an id and a text are one text
    cand = staged(cand, "rep_windows")
    held = cand.select("k", "ord", F.explode(F.arrays_zip("anchor", "whole", "at")).alias("w")).select("k", "ord", "w.*")
    owners = held.groupBy("anchor", "whole").agg(F.min(F.struct("ord", "k", "at")).alias("o"), F.max("ord").alias("last"))
    owners = staged(owners.filter("o.ord < last").select("anchor", "whole", F.col("o.ord").alias("first"), F.col("o.k").alias("owner"), F.col("o.at").alias("there")), "rep_owners")

    waiting = held.join(owners, ["anchor", "whole"]).filter("first < ord").groupBy("owner", "k").agg(F.collect_set("at").alias("at"))
    waiting = staged(waiting, "rep_waiting")
    stretches = cand.groupBy("k").agg(F.first("stretches").alias("stretches"))
    passages = owners.groupBy("owner").agg(F.collect_list("there").alias("at"))
    passages = passages.join(stretches.withColumnRenamed("k", "owner"), "owner").withColumn("k", F.lit(None).cast("long"))
    schema = "owner long, k long, start int, n int, words string"
    passages = passages.select("owner", "k", "at", "stretches").mapInArrow(_cut(window, "k"), schema)
    waits = waiting.join(stretches, "k").select("owner", "k", "at", "stretches").mapInArrow(_cut(window, "k"), schema)

    # an owner that many texts wait for has its passages copied, once for every COPY_TEXTS of them
    copies = waiting.groupBy("owner").agg(F.ceil(F.count(F.lit(1)) / COPY_TEXTS).cast("int").alias("copies"))
    total = waiting.agg(F.sum(F.size("at") + window)).first()[0] or 0
    shards = max(1, -(-total // shard_words))
    shard = lambda copy: F.pmod(F.xxhash64("owner", copy), F.lit(shards)).alias("shard")
    passages = passages.join(copies, "owner").withColumn("copy", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)))
    waits = waits.join(copies, "owner").withColumn("copy", F.pmod(F.xxhash64("k"), F.col("copies")).cast("int"))
    cols = ["owner", "k", "start", "words"]
    stream = passages.select(shard(F.col("copy")), *cols).unionByName(waits.select(shard(F.col("copy")), *cols))
    stream = stream.repartition(shards, "shard").sortWithinPartitions("shard", F.col("k").asc_nulls_first())
    found = stream.mapInArrow(_locate(window), "k long, start int, end int")
    found = found.groupBy("k").agg(F.collect_set(F.struct("start", "end")).alias("ranges"))
    return staged(texts.select("th", "ord", "n_words", "k").join(found, "k", "left").drop("k"), "rep_ranges")


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, shard_words: int = SHARD_WORDS) -> DataFrame:
    """Every row of ``docs`` without the words that a window covers whose words also start in
    a row with a smaller id; with ``n_words``, ``n_removed`` and ``removed`` (merged ranges of
    words, from 0, end exclusive).

    Words are what stands between ASCII white space, unchanged. Windows are judged on the
    input, not on what is left of it. A text that loses words is what remains, joined by
    single blanks; others come back as they were. Ids are integers; a null id counts as
    larger than all. Rows that repeat an id are not earlier than each other. Null and empty
    texts and those of fewer than ``window`` words lose nothing. An empty table gives an
    empty result."""
    if window < 2:
        raise ValueError("window must be 2 words at least")
    keep = free_columns(docs, ADDED)
    plain = docs.select(*[q(c).alias(f"__c{i}") for i, c in enumerate(keep)])
    ident, text = (f"__c{keep.index(c)}" for c in (id_col, text_col))
    if not isinstance(plain.schema[ident].dataType, T.IntegralType):
        raise ValueError(f"{id_col} must be an integer column")
    plain = plain.withColumn("__text", F.col(text).cast("string")).drop(text)
    plain = plain.withColumn("th", F.unhex(F.md5(F.coalesce("__text", F.lit("")).cast("binary"))))
    plain = plain.withColumn("ord", F.coalesce(F.col(ident).cast("long"), F.lit(NO_ID)))
    ranges = repeated_ranges(plain.select("th", "ord", "__text"), window, shard_words)
    rows = plain.join(ranges.withColumnRenamed("ord", "first").hint("merge"), "th")
    whole = F.array(F.struct(F.lit(0).alias("start"), F.col("n_words").cast("int").alias("end")))
    # an exact copy under a larger id starts every window in the first holder
    rows = rows.withColumn("removed", F.when(F.col("ord") > F.col("first"), F.when(F.col("n_words") >= window, whole)).otherwise(F.col("ranges")))
    others = [c for c in plain.columns if c.startswith("__c")]
    rows = rows.select(*others, "__text", "n_words", F.lit(0).cast("long").alias("n_removed"), "removed")
    out = rows.mapInArrow(_without, T.StructType([T.StructField(f.name, f.dataType) for f in rows.schema.fields]))
    return out.select(*[F.col("__text" if f"__c{i}" == text else f"__c{i}").alias(c) for i, c in enumerate(keep)], *ADDED)
