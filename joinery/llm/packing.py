"""Best-fit packing into sequences of several permitted lengths."""

from __future__ import annotations

import heapq
from bisect import bisect_left, insort
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .staging import staged
from .texts import q

#: Permitted sequence lengths, in tokens.
SIZES = (512, 1024, 2048, 4096)
#: Fixed cost of a sequence, in tokens (its start-up and padding mask).
OVERHEAD = 16
#: Pieces that one task packs, on average.
SHARD_PIECES = 20_000

TOKEN = r"[^\x20\x09-\x0D]+"


def token_count(text: Column) -> Column:
    """White-space tokens; another tokenizer's counts can be passed as a column instead."""
    return F.regexp_count(F.coalesce(text.cast("string"), F.lit("")), F.lit(TOKEN)).cast("int")


def fills(lengths: np.ndarray, sizes: Sequence[int]) -> dict[tuple[int, int], int]:
    """For each length n and each size that holds it: the most tokens that a sequence of
    that size can carry when a piece of n tokens is its longest. A bit field of the sums
    that the pieces up to n can make, each as often as it is there, tells."""
    cap = max(sizes)
    mask, sums, out = (1 << (cap + 1)) - 1, 1, {}
    for n, count in zip(*(x.tolist() for x in np.unique(lengths, return_counts=True)), strict=True):
        left, times = min(count - 1, cap // n), 1
        while left > 0:
            times = min(times, left)
            sums |= (sums << (n * times)) & mask
            left, times = left - times, times * 2
        for size in sizes:
            if size >= n:
                out[n, size] = n + (sums & ((1 << (size - n + 1)) - 1)).bit_length() - 1
        sums |= (sums << n) & mask
    return out


def place(lengths: np.ndarray, mix: Sequence[int], sizes: Sequence[int], overhead: int,
          most: dict[tuple[int, int], int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best fit with bins of the sizes of ``mix``: bin number and offset of every piece and
    the final size of every bin.

    Pieces come longest first (ties by position). Each goes to the open bin that it fills
    best. If none has room, a bin is opened of the size of ``mix`` (a piece longer than all
    of them: of the smallest of ``sizes``) whose cost for each token that it can get is
    least: what ``fills`` says, and no more than the tokens still to come. At last every bin
    shrinks to the smallest permitted size that holds its contents."""
    order = np.argsort(-lengths, kind="stable")
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    used: list[int] = []
    rooms: list[int] = []  # distinct free spaces, sorted
    by_room: dict[int, list[int]] = {}  # heaps of bins with that space
    rest, spare = int(lengths.sum()), 0
    for i in order.tolist():
        n = int(lengths[i])
        rest -= n
        at = bisect_left(rooms, n)
        if at < len(rooms):
            room = rooms[at]
            b = heapq.heappop(by_room[room])
            if not by_room[room]:
                del by_room[room], rooms[at]
            spare -= room
        else:
            fit = [size for size in mix if size >= n] or [sizes[bisect_left(sizes, n)]]
            room = min(fit, key=lambda size: (size + overhead) / min(most[n, size], n + max(0, rest - spare)))
            b = len(used)
            used.append(0)
        bins[i], offsets[i] = b, used[b]
        used[b] += n
        room -= n
        spare += room
        if room:
            if room not in by_room:
                by_room[room] = []
                insort(rooms, room)
            heapq.heappush(by_room[room], b)
    final = np.array([sizes[bisect_left(sizes, u)] for u in used], np.int64)
    return bins, offsets, final


def pack(lengths: np.ndarray, sizes: Sequence[int] = SIZES, overhead: int = OVERHEAD) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin number and offset of every piece and final size of every bin.

    The permitted sizes are chosen jointly: starting from the cheapest single size, the size
    that saves most is added to the mix as long as one saves anything; all sizes together
    are tried too. What counts is the whole cost, final sizes and ``overhead`` of each bin,
    so the result is never dearer than best fit into any single size."""
    sizes = sorted(sizes)
    most = fills(lengths, sizes)

    def tried(mix: tuple[int, ...]):
        out = place(lengths, mix, sizes, overhead, most)
        return int(out[2].sum()) + overhead * len(out[2]), mix, out

    best = min((tried((size,)) for size in sizes), key=lambda t: t[0])
    while len(best[1]) < len(sizes):
        more = min((tried(tuple(sorted((*best[1], size)))) for size in sizes if size not in best[1]), key=lambda t: t[0])
        if more[0] >= best[0]:
            break
        best = more
    return min(best, tried(tuple(sizes)), key=lambda t: t[0])[2]


def _pack_shard(sizes: Sequence[int], overhead: int):
    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("n_tokens", "descending"), ("__id", "ascending"), ("start", "ascending"),
                               ("__k", "ascending"), ("__copy", "ascending")])
        bins, offsets, final = pack(table.column("n_tokens").to_numpy(), sizes, overhead)
        shard = np.int64(table.column("__shard")[0].as_py())
        used = np.bincount(bins, weights=table.column("n_tokens").to_numpy(), minlength=len(final)).astype(np.int64)
        return pa.table({
            "__id": table.column("__id"), "__k": table.column("__k"), "start": table.column("start"), "n_tokens": table.column("n_tokens"),
            "bin": pa.array([f"{shard}-{b}" for b in bins]), "bin_offset": pa.array(offsets),
            "bin_size": pa.array(final[bins]), "bin_tokens": pa.array(used[bins]),
        })

    return run


def pack_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokens: Column | None = None,
                   sizes: Sequence[int] = SIZES, overhead: int = OVERHEAD, shard_pieces: int = SHARD_PIECES,
                   texts: bool = False) -> DataFrame:
    """One row per piece: ``id_col``, ``start`` (first token), ``n_tokens``, ``bin`` (name),
    ``bin_offset``, ``bin_size`` (a permitted length), ``bin_tokens`` (tokens in the bin).
    With ``texts`` also ``piece``, the piece's tokens joined by blanks, so that the pieces of
    a bin by ``bin_offset`` are the training sequence with its document boundaries
    (``sequences`` gathers them); it needs white-space tokens, ``tokens`` unset.

    A document longer than the largest size is cut into pieces of that size and a
    remainder; pieces of the full size fill a bin each and are never gathered. The others
    are dealt by hash into shards of about ``shard_pieces`` pieces (a number that follows
    their count), and each shard is packed on its own, so a task's work is bounded and a
    lost one repeats with the same result. A document without tokens has no piece. Rows
    that repeat are packed once each; a null id is kept."""
    sizes = sorted(sizes)
    if not sizes or sizes[0] < 1:
        raise ValueError("sizes must be positive")
    if texts and tokens is not None:
        raise ValueError("texts are cut at white space: leave tokens unset")
    full = sizes[-1]
    n = token_count(q(text_col)) if tokens is None else tokens
    rows = docs.select(q(id_col).alias("__id"), F.xxhash64(q(text_col)).alias("__k"), n.cast("int").alias("__n")).filter("__n > 0")
    # a few numbers per document: the texts are read once
    rows = staged(rows.groupBy("__id", "__k", "__n").agg(F.count(F.lit(1)).alias("__copies")), "pack_lengths")
    rows = rows.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__copies"))))
    cut = rows.select("__id", "__k", "__copy", "__n", F.explode(F.sequence(F.lit(0), F.col("__n") - 1, F.lit(full))).alias("start"))
    cut = cut.withColumn("n_tokens", F.least(F.col("__n") - F.col("start"), F.lit(full)))
    whole = cut.filter(F.col("n_tokens") == full)
    part = cut.filter(F.col("n_tokens") < full)
    shards = max(1, -(-part.count() // shard_pieces))
    dealt = part.select("__id", "__k", "__copy", F.col("start").cast("long"), F.col("n_tokens").cast("long"),
                        F.pmod(F.xxhash64("__id", "__k", "__copy", "start"), F.lit(shards)).alias("__shard"))
    id_type = docs.select(q(id_col)).schema.fields[0].dataType.simpleString()
    packed = dealt.groupBy("__shard").applyInArrow(
        _pack_shard(sizes, overhead),
        f"__id {id_type}, __k long, start long, n_tokens long, bin string, bin_offset long, bin_size long, bin_tokens long",
    )
    alone = whole.select(
        "__id", "__k", F.col("start").cast("long"), F.col("n_tokens").cast("long"),
        F.concat_ws("-", F.lit("w"), F.coalesce(F.col("__id").cast("string"), F.lit("null")), F.hex("__k"), F.col("__copy"), F.col("start")).alias("bin"),
        F.lit(0).cast("long").alias("bin_offset"), F.lit(full).cast("long").alias("bin_size"), F.lit(full).cast("long").alias("bin_tokens"),
    )
    out = packed.unionByName(alone)
    if texts:
        out = _with_pieces(out, docs.select(q(id_col).alias("__id"), q(text_col).alias("__text")), full)
    return out.select(F.col("__id").alias(id_col), *[c for c in out.columns if c not in ("__id", "__k")])


def _with_pieces(packed: DataFrame, docs: DataFrame, full: int) -> DataFrame:
    """``packed`` with ``piece``. A text is split once and cut into its pieces before they
    are shuffled, so a very long one is dealt over all tasks; equal rows are cut to one
    before the join, which reads them from that same shuffle."""
    key = [F.coalesce(F.col("__id").cast("string"), F.lit("")).alias("__i"), F.col("__id").isNull().alias("__null")]
    words = F.filter(F.split(F.col("__text").cast("string"), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    cut = F.transform(F.array(words), lambda w: F.when(F.size(w) > 0, F.transform(
        F.sequence(F.lit(0), F.size(w) - 1, F.lit(full)),
        lambda at: F.struct(at.cast("long").alias("start"), F.array_join(F.slice(w, at + 1, F.lit(full)), " ").alias("piece")))))
    pieces = docs.select(*key, F.xxhash64("__text").alias("__k"), F.explode(F.get(cut, F.lit(0))).alias("__p"))
    pieces = pieces.select("__i", "__null", "__k", "__p.*").groupBy("__i", "__null", "__k", "start").agg(F.max("piece").alias("piece"))
    return packed.select("*", *key).join(pieces, ["__i", "__null", "__k", "start"]).select(*packed.columns, "piece")


def sequences(packed: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """One row per bin of ``pack_documents(..., texts=True)``: ``bin``, ``bin_size``,
    ``bin_tokens``, ``pieces`` (``id_col``, ``start``, ``n_tokens``, ``bin_offset``, in
    order) and ``text``, all tokens joined by blanks. A bin holds at most ``bin_size``
    tokens, so a group is bounded."""
    parts = F.sort_array(F.collect_list(F.struct("bin_offset", q(id_col), "start", "n_tokens", "piece")))
    out = packed.groupBy("bin", "bin_size", "bin_tokens").agg(parts.alias("__parts"))
    inside = F.transform("__parts", lambda p: F.struct(p[id_col].alias(id_col), p["start"].alias("start"),
                                                       p["n_tokens"].alias("n_tokens"), p["bin_offset"].alias("bin_offset")))
    return out.select("bin", "bin_size", "bin_tokens", inside.alias("pieces"),
                      F.array_join(F.transform("__parts", lambda p: p["piece"]), " ").alias("text"))


def piece_text(text: Column, start: Column, n_tokens: Column) -> Column:
    """The tokens of one piece, joined by blanks."""
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    return F.array_join(F.slice(words, start.cast("int") + 1, n_tokens.cast("int")), " ")
