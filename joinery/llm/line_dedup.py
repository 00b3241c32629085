"""Line deduplication by pairwise alignment: documents that share rare line hashes are
aligned with patience diff, and aligned blocks are deleted from the later one.

A line here is a sentence of a text line, so that a passage in the middle of a paragraph
is found too: see ``text_lines``."""

from __future__ import annotations

import zlib
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .staging import staged
from .texts import free_columns, int64s, lists, mix64, q

#: Words a line needs to count; shorter and blank lines neither match nor break a block.
LINE_WORDS = 3
#: A sentence of more words than this is cut further, after words that their own hash picks.
LONG_WORDS = 40
#: Of so many consecutive words one at least is picked, the one with the least hash.
CUT_WITHIN = 8
#: Words an aligned block needs to be deleted.
BLOCK_WORDS = 20
#: Pairs whose lines are Python lists at once.
ALIGN_ROWS = 256
#: Kept for callers that pass it: results no longer depend on how many texts hold a line.
RARE_TEXTS = 64
ADDED = ("n_lines", "n_deleted", "deleted_lines")


def patience(a: Sequence[int], b: Sequence[int]) -> list[tuple[int, int]]:
    """Matched positions, increasing in both: common heads and tails, then lines that are
    unique on both sides along their longest increasing run, then the gaps in between."""
    out: list[tuple[int, int]] = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        al, ah, bl, bh = todo.pop()
        while al < ah and bl < bh and a[al] == b[bl]:
            out.append((al, bl))
            al, bl = al + 1, bl + 1
        while al < ah and bl < bh and a[ah - 1] == b[bh - 1]:
            ah, bh = ah - 1, bh - 1
            out.append((ah, bh))
        if al == ah or bl == bh:
            continue
        once = {x for x, n in Counter(a[al:ah]).items() if n == 1} & {x for x, n in Counter(b[bl:bh]).items() if n == 1}
        if not once:
            continue
        at = {b[j]: j for j in range(bl, bh) if b[j] in once}
        pairs = [(i, at[a[i]]) for i in range(al, ah) if a[i] in once]
        tops: list[int] = []
        piles: list[int] = []
        back = [-1] * len(pairs)
        for k, (_, j) in enumerate(pairs):
            p = bisect_left(tops, j)
            back[k] = piles[p - 1] if p else -1
            if p == len(tops):
                tops.append(j)
                piles.append(k)
            else:
                tops[p], piles[p] = j, k
        chain, k = [], piles[-1]
        while k >= 0:
            chain.append(pairs[k])
            k = back[k]
        chain.reverse()
        out.extend(chain)
        edge = (al, bl)
        for i, j in [*chain, (ah, bh)]:
            if edge[0] < i and edge[1] < j:
                todo.append((edge[0], i, edge[1], j))
            edge = (i + 1, j + 1)
    return sorted(out)


def block_windows(words: Sequence[int], least: int = BLOCK_WORDS) -> Iterator[tuple[int, int]]:
    """``(first, end)`` of the shortest stretches of ``least`` words or more, from each line
    onwards and up to each line: those inside a block cover all of it."""
    first, before, n = 0, -1, 0
    for end, w in enumerate(words, 1):
        n += w
        while n - words[first] >= least:
            n -= words[first]
            first += 1
        if n >= least:
            # from the starts up to ``first`` that fell short at the line before, and up to this line
            yield from ((k, end) for k in range(min(before + 1, first), first + 1))
            before = first


def aligned_blocks(later: Sequence[int], earlier: Sequence[int], words: Sequence[int], least: int = BLOCK_WORDS) -> list[int]:
    """Positions of ``later`` in common blocks (lines that follow each other in both) of
    ``least`` words or more.

    Patience diff takes what lies in the same order on both sides. Blocks that cross it or
    repeat have no place there, so the windows (``block_windows``) of the lines that it
    leaves are looked up anywhere in ``earlier``: together both find every common block."""
    here = set(earlier)
    mine = [i for i, x in enumerate(later) if x in here]
    if sum(words[i] for i in mine) < least:
        return []
    # a line that the other side lacks has no match: patience diff runs on the others
    common = {later[i] for i in mine}
    theirs = [j for j, x in enumerate(earlier) if x in common]
    out: set[int] = set()
    block: list[int] = []
    last = None
    pairs = patience([later[i] for i in mine], [earlier[j] for j in theirs])
    for i, j in [*((mine[i], theirs[j]) for i, j in pairs), (-1, -1)]:
        if last is None or i != last[0] + 1 or j != last[1] + 1:
            if block and sum(words[k] for k in block) >= least:
                out.update(block)
            block = []
        block.append(i)
        last = (i, j)
    if len(out) == len(mine):
        return mine
    # windows lie in runs of common lines
    left: list[tuple[int, int]] = []
    run: list[int] = []
    for i in [*mine, len(later) + 1]:
        if run and i != run[-1] + 1:
            if any(k not in out for k in run):
                of = block_windows([words[k] for k in run], least)
                left.extend((run[0] + a, run[0] + b) for a, b in of if any(k not in out for k in range(run[0] + a, run[0] + b)))
            run = []
        run.append(i)
    held: dict[int, set[tuple[int, ...]]] = {}
    for a, b in left:
        if b - a not in held:
            held[b - a] = {tuple(earlier[j:j + b - a]) for j in range(len(earlier) - (b - a) + 1)}
        if tuple(later[a:b]) in held[b - a]:
            out.update(range(a, b))
    return sorted(out)


#: Classes of bytes: 0 white space, 1 a line end, 2 closing marks, 3 sentence ends, 4 the rest.
_CLASS = bytes(1 if c == 10 else 0 if c in b"\x20\x09\x0B\x0C\x0D" else 2 if c in b"\"')]" else 3 if c in b".!?" else 4 for c in range(256))
#: Bytes of texts that are cut at once.
CHUNK_BYTES = 1 << 18


def _distinct(values: np.ndarray) -> np.ndarray:
    """Sorted ``values`` without repeats."""
    fresh = np.ones(len(values), bool)
    fresh[1:] = values[1:] != values[:-1]
    return values[fresh]


def _picked(hashes: np.ndarray, of: np.ndarray, within: int = CUT_WITHIN) -> np.ndarray:
    """Positions of the least of every ``within`` consecutive values of one sentence, the
    last of equals; ``of`` tells the sentence of a value."""
    if len(hashes) < within:
        return np.zeros(0, np.int64)
    # the value, then the place from behind, in one number
    keys = (hashes.astype(np.int64) << 31) - np.arange(len(hashes))
    least = np.lib.stride_tricks.sliding_window_view(keys, within).min(axis=1)
    return _distinct(-least[of[within - 1:] == of[:len(of) - within + 1]] & ((1 << 31) - 1))


def _long_cuts(buffer: bytes, cuts: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Where the sentences that ``cuts`` end are cut further, if they are long."""
    upto = np.searchsorted(begins, cuts)
    size = np.diff(upto, prepend=0)
    long = np.flatnonzero(size > LONG_WORDS)
    if not len(long):
        return cuts[:0]
    size = size[long]
    of = np.repeat(np.arange(len(long)), size)
    word = np.arange(len(of)) + np.repeat(upto[long] - np.cumsum(size), size)
    hashes = np.array([zlib.crc32(buffer[a:b]) for a, b in zip(begins[word].tolist(), ends[word].tolist())], np.int64)
    picked = _picked(hashes, of)
    return begins[word[picked[word[picked] + 1 < upto[long][of[picked]]]] + 1]


class _Lines(NamedTuple):
    """Lines of texts joined by line ends: text line (from 0 in the joined bytes), start,
    end and words of each; where each text's lines begin, and its text lines."""

    buffer: bytes
    number: np.ndarray
    start: np.ndarray
    end: np.ndarray
    words: np.ndarray
    first: np.ndarray
    first_number: np.ndarray


def _cut(texts: Sequence[bytes], least: int) -> _Lines:
    """The lines of many texts, as ``text_lines`` tells them."""
    buffer = b"\n".join(texts)
    kinds = np.frombuffer((buffer + b"\n").translate(_CLASS), np.uint8)
    blank = kinds <= 1
    # words begin and end where white space and other bytes meet
    turns = np.flatnonzero(blank[1:] != blank[:-1]) + 1
    if not blank[0]:
        turns = np.concatenate([[0], turns])
    begins, ends = turns[::2], turns[1::2]
    # a word ends a sentence by its last byte before closing marks
    last = ends - 1
    closing = np.flatnonzero(kinds[last] == 2)
    while len(closing):
        last[closing] -= 1
        closing = closing[(last[closing] >= begins[closing]) & (kinds[np.maximum(last[closing], 0)] == 2)]
    stops = np.flatnonzero((kinds[np.maximum(last, 0)] == 3) & (last >= begins))
    # its white space belongs to it as far as the line's end
    line_ends = np.flatnonzero(kinds == 1)
    line = np.searchsorted(line_ends, ends[stops])
    after = np.minimum(np.append(begins, len(buffer) + 1)[stops + 1], line_ends[line])
    inside = ends[stops] < line_ends[line]
    cuts = _distinct(np.sort(np.concatenate([after[inside], line_ends])))
    cuts = _distinct(np.sort(np.concatenate([cuts, _long_cuts(buffer, cuts, begins, ends)])))
    upto = np.searchsorted(begins, cuts)
    words = np.diff(upto, prepend=0)
    number = np.searchsorted(line_ends, cuts)
    stop = line_ends[number] == cuts
    # a piece of enough words ends a line; so do short ones that together have enough
    ended = words >= least
    short = np.flatnonzero(~ended)
    n, before = 0, -1
    for i, more, stops_before in zip(short.tolist(), words[short].tolist(), stop[short - 1].tolist()):
        n = more if i != before + 1 or stops_before else n + more
        if n >= least:
            ended[i] = True
            n = 0
        before = i
    # what is left at the end of a text line joins the line before it there
    left = np.flatnonzero(stop & ~ended)
    so_far = np.flatnonzero(ended)
    earlier = np.searchsorted(so_far, left) - 1
    joined = so_far[earlier[(earlier >= 0)]]
    joined = joined[number[joined] == number[left[earlier >= 0]]]
    ended[joined] = False
    ended[left] = True
    end, number, stop = cuts[ended], number[ended], stop[ended]
    start = np.concatenate([[0], (end + stop)[:-1]])
    first_number = np.concatenate([[0], np.cumsum([t.count(b"\n") + 1 for t in texts])])
    return _Lines(buffer, number, start, end, np.diff(upto[ended], prepend=0), np.searchsorted(number, first_number), first_number)


def text_lines(text: bytes | None, least: int = LINE_WORDS) -> Iterator[tuple[int, int, int, int]]:
    """``(text line, start, end, words)`` of every line, in order; they cover the text but
    for its line ends.

    A text line (up to a line end) is cut after each sentence end that white space
    follows, and a sentence of more than ``LONG_WORDS`` words also after words picked by
    their hash, the least of every ``CUT_WITHIN`` words. A piece of fewer than ``least``
    words joins the next one, at the end of a text line the one before. So where two texts
    share a passage, its sentences are cut alike whatever stands around it; without a
    sentence end it is cut alike but for ``CUT_WITHIN`` words at either end, and short
    pieces next to them."""
    cut = _cut([text or b""], least)
    return zip(cut.number.tolist(), cut.start.tolist(), cut.end.tolist(), cut.words.tolist())


def line_table(text: bytes | None, least: int = LINE_WORDS) -> tuple[list[int], list[int], list[int], int]:
    """Of the counting lines: hashes, words and line numbers; and how many lines there are."""
    hashes, words, numbers, i = [], [], [], -1
    for i, (_, start, end, n) in enumerate(text_lines(text, least)):
        if n >= least:
            hashes.append(xxhash.xxh64_intdigest(text[start:end].strip()) >> 1)
            words.append(n)
            numbers.append(i)
    return hashes, words, numbers, 0 if text is None else i + 1


def _left(cut: _Lines, text: int, gone: Sequence[int]) -> bytes:
    """A text of ``cut`` less the lines with these numbers."""
    drop, left = set(gone), {}
    own = slice(cut.first[text], cut.first[text + 1])
    for i, (number, start, end) in enumerate(zip(cut.number[own].tolist(), cut.start[own].tolist(), cut.end[own].tolist())):
        if i not in drop:
            left.setdefault(number, []).append(cut.buffer[start:end])
    return b"\n".join([b"".join(x) for x in left.values()])


def without_lines(text: bytes, gone: Sequence[int], least: int = LINE_WORDS) -> bytes:
    """``text`` less the lines with these numbers. A text line that loses all of itself
    goes with its line end."""
    return _left(_cut([text], least), 0, gone)


def _chunks(sizes: Sequence[int | None]) -> Iterator[tuple[int, int]]:
    """``(first, end)`` of stretches of texts of about ``CHUNK_BYTES``."""
    first = size = 0
    for i, n in enumerate(sizes, 1):
        size += n or 0
        if size >= CHUNK_BYTES or i == len(sizes):
            yield first, i
            first, size = i, 0


def _windows(words: np.ndarray, lines: np.ndarray, of: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """A hash of each of the ``block_windows`` of many texts' counting lines, and its text;
    ``of`` tells the text of a line."""
    n = len(words)
    total = np.concatenate([[0], np.cumsum(words, dtype=np.int64)])
    text_first, text_end = np.searchsorted(of, of), np.searchsorted(of, of, "right")
    at = np.arange(n)
    # the shortest from a line onwards, and the shortest up to one that no such one is
    onward = np.searchsorted(total, total[:-1] + least)
    good = onward <= text_end
    one = at[good], onward[good]
    up = np.searchsorted(total, total[1:] - least, "right") - 1
    good = up >= text_first
    two = up[good], at[good] + 1
    other = onward[two[0]] != two[1]
    firsts, ends = np.concatenate([one[0], two[0][other]]), np.concatenate([one[1], two[1][other]])
    size = ends - firsts
    hashes, values = mix64(size.astype(np.uint64)), lines.view(np.uint64)
    for k in range(size.max(initial=0)):
        some = np.flatnonzero(size > k)
        hashes[some] = mix64(mix64(hashes[some]) + values[firsts[some] + k])
    return int64s(hashes >> np.uint64(1)), of[firsts]


def _lines(line_words: int, block_words: int):
    def table(rows: pa.RecordBatch) -> pa.RecordBatch:
        texts = rows.column("__text").cast(pa.binary()).to_pylist()
        cut = _cut([t or b"" for t in texts], line_words)
        size = np.diff(cut.first)
        keep = cut.words >= line_words
        of = np.repeat(np.arange(len(texts)), size)[keep]
        lines = np.array([xxhash.xxh64_intdigest(cut.buffer[a:b].strip()) >> 1 for a, b in zip(cut.start[keep].tolist(), cut.end[keep].tolist())], np.int64)
        words = cut.words[keep].astype(np.int32)
        numbers = (np.arange(len(keep)) - np.repeat(cut.first[:-1], size))[keep].astype(np.int32)
        offsets = np.searchsorted(of, np.arange(len(texts) + 1))
        hashes, of = _windows(words, lines, of, block_words)
        order = np.lexsort((hashes, of))
        hashes, of = hashes[order], of[order]
        fresh = np.ones(len(of), bool)
        fresh[1:] = (hashes[1:] != hashes[:-1]) | (of[1:] != of[:-1])
        hashes, of = hashes[fresh], of[fresh]
        cols = [lists(offsets, pa.array(lines)), lists(offsets, pa.array(words)), lists(offsets, pa.array(numbers)),
                pa.array([0 if t is None else n for t, n in zip(texts, size.tolist())], pa.int32()),
                lists(np.searchsorted(of, np.arange(len(texts) + 1)), pa.array(hashes))]
        return pa.RecordBatch.from_arrays([rows.column("__id"), rows.column("__th"), *cols],
                                          names=["__id", "__th", "lines", "words", "numbers", "n_lines", "windows"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end in _chunks(pc.binary_length(batch.column("__text")).to_pylist()):
                yield table(batch.slice(first, end - first))

    return run


def _align(least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            th, gone = [], []
            for first in range(0, batch.num_rows, ALIGN_ROWS):
                for row in batch.slice(first, ALIGN_ROWS).to_pylist():
                    found = aligned_blocks(row["lines"], row["other"], row["words"], least)
                    if found:
                        th.append(row["th"])
                        gone.append(found)
            yield pa.RecordBatch.from_arrays([pa.array(th, pa.int64()), pa.array(gone, pa.list_(pa.int32()))], names=["th", "gone"])

    return run


def shared_line_pairs(texts: DataFrame) -> DataFrame:
    """``(th, owner)``: texts to align, each with the earliest texts that hold its windows
    (``block_windows``). ``texts`` has th, first_id, windows.

    Every line of a block that an earlier text holds lies in a window inside that block, so
    a text that holds this window whole is always proposed. A window proposes its first
    holder alone, so one in a third of all texts proposes one pair for each of them, never
    pairs among them."""
    posted = texts.select("th", "first_id", F.explode("windows").alias("h"))
    known = posted.groupBy("h").agg(F.count(F.lit(1)).alias("df")).filter("df > 1").select("h")
    # written out, so that the joins on them can split a hot window
    posted = staged(posted.join(staged(known, "ld_known"), "h"), "ld_posted")
    order = F.struct(F.col("first_id").isNull().alias("no"), F.col("first_id").alias("id"), F.col("th").alias("th"))
    owners = staged(posted.groupBy("h").agg(F.min(order).alias("owner")), "ld_owners")
    shared = posted.join(owners, "h")
    earlier = ~F.col("owner.id").eqNullSafe(F.col("first_id")) & F.col("owner.id").isNotNull()
    return shared.filter(earlier).select("th", F.col("owner.th").alias("owner")).distinct()


def deletions(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", line_words: int = LINE_WORDS,
              block_words: int = BLOCK_WORDS, rare_texts: int = RARE_TEXTS) -> DataFrame:
    """Per distinct text (``th``): the first id that holds it, how many lines it has, the
    line numbers to delete from it and those to delete from its later copies.
    ``rare_texts`` has no effect."""
    rows = docs.select(q(id_col).alias("__id"), F.xxhash64(q(text_col).cast("string")).alias("__th"), q(text_col).cast("string").alias("__text"))
    schema = T.StructType([f for f in rows.schema.fields if f.name in ("__id", "__th")]
                          + T.StructType.fromDDL("lines array<long>, words array<int>, numbers array<int>, n_lines int, windows array<long>").fields)
    lines = rows.mapInArrow(_lines(line_words, block_words), schema)
    texts = staged(lines.groupBy(F.col("__th").alias("th")).agg(
        F.min("__id").alias("first_id"), F.count(F.lit(1)).alias("copies"),
        F.first("lines").alias("lines"), F.first("words").alias("words"), F.first("numbers").alias("numbers"), F.first("n_lines").alias("n_lines"), F.first("windows").alias("windows")), "ld_texts")
    pairs = shared_line_pairs(texts)
    pairs = pairs.join(texts.select("th", "lines", "words"), "th")
    pairs = pairs.join(texts.select(F.col("th").alias("owner"), F.col("lines").alias("other")), "owner")
    gone = pairs.select("th", "lines", "words", "other").mapInArrow(_align(block_words), "th long, gone array<int>")
    gone = gone.groupBy("th").agg(F.array_distinct(F.flatten(F.collect_list("gone"))).alias("gone"))
    found = texts.join(gone, "th", "left").withColumn("gone", F.coalesce("gone", F.expr("cast(array() as array<int>)")))
    enough = F.aggregate("words", F.lit(0).cast("long"), lambda s, w: s + w) >= block_words
    numbered = F.transform("gone", lambda k: F.expr("numbers")[k])
    copy = F.when(enough & (F.col("copies") > 1), F.col("numbers")).otherwise(F.slice("numbers", 1, 0))
    return staged(found.select("th", "first_id", "n_lines", numbered.alias("own"), copy.alias("copy")), "ld_gone")


def _without(line_words: int):
    @F.pandas_udf(T.BinaryType())
    def run(text: pd.Series, gone: pd.Series) -> pd.Series:
        out: list[bytes | None] = [None] * len(text)
        some = [i for i, t in enumerate(text) if t is not None]
        for first, end in _chunks([len(text.iat[i]) for i in some]):
            here = some[first:end]
            cut = _cut([bytes(text.iat[i]) for i in here], line_words)
            for k, i in enumerate(here):
                out[i] = _left(cut, k, gone.iat[i])
        return pd.Series(out, dtype=object)

    return run


def _with_gone(rows: DataFrame, gone: DataFrame, ident: str) -> DataFrame:
    """``__n`` and ``__gone``: how many lines a row (its ``__th``, its id) has, and the
    numbers of those it loses."""
    # by a shuffle whatever the size: a hot text's rows are split, and the plan is the same at any scale
    joined = rows.join(gone.hint("merge"), rows["__th"] == gone["th"], "left")
    return joined.withColumn("__n", F.col("n_lines")).withColumn("__gone", F.when(F.col(ident).eqNullSafe(F.col("first_id")), F.col("own")).otherwise(F.col("copy")))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", line_words: int = LINE_WORDS,
                block_words: int = BLOCK_WORDS, rare_texts: int = RARE_TEXTS) -> DataFrame:
    """Every row of ``docs`` with its text less the deleted lines, and ``n_lines``,
    ``n_deleted``, ``deleted_lines`` (numbers from 0).

    A row is later than those with a smaller id; null ids come last and, like rows that
    repeat an id, are not later than each other. Lines (``text_lines``: sentences) are
    compared without surrounding blanks. Of an exact copy all counting lines go if they
    make a block. Deleting leaves the other lines where they stand, blank ones included; a
    text line that loses all of itself goes with its line end, and a text whose lines all
    go becomes empty. Null stays null, with no lines."""
    gone = deletions(docs, id_col, text_col, line_words, block_words, rare_texts)
    keep = free_columns(docs, ADDED)
    plain = docs.select(*[q(c).alias(f"__c{i}") for i, c in enumerate(keep)])
    ident, text = (f"__c{keep.index(c)}" for c in (id_col, text_col))
    plain = plain.withColumn("__th", F.xxhash64(F.col(text).cast("string")))
    rows = _with_gone(plain, gone, ident)
    # only texts that lose lines pass through Python
    some = F.size("__gone") > 0
    left = _without(line_words)(F.when(some, F.col(text).cast("binary")), F.col("__gone")).cast("string")
    rows = rows.withColumn("__left", F.when(some, left).otherwise(F.col(text)))
    return rows.select(*[F.col("__left" if f"__c{i}" == text else f"__c{i}").alias(c) for i, c in enumerate(keep)],
                       F.col("__n").alias("n_lines"), F.size("__gone").alias("n_deleted"), F.array_sort("__gone").alias("deleted_lines"))
