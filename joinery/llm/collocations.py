"""Phrase collocations: contiguous phrases are counted in HAT-tries, a shallow trie of word
ids over hash containers that burst when they grow; a trie over its bound spills whole
subtrees as sorted runs, and the runs of a prefix are merged in one partition.

Longer phrases are counted only where both phrases of one word less inside them reach the
least count: these reach the tasks as a bit field of a fixed size, which may let others
through, never the reverse; the counts themselves are exact."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator, Sequence
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .staging import staged
from .texts import mix64, q, word_hashes

#: Occurrences that make a phrase a candidate.
LEAST = 10
#: Entries a trie holds before it spills, and a container before it bursts.
TRIE_ENTRIES = 1_000_000
BURST = 2048
#: Bytes of text that a task counts at a time.
CHUNK = 2 << 20
#: Bits of the broadcast field of frequent phrases: 8 MB, whatever the corpus.
FILTER_BITS = 1 << 26
#: A first word with more than this share of all words has its prefix dealt in slices.
HOT_SHARE, SLICES = 1 / 1000, 64
#: Parts that single words are merged in, by a hash.
WORD_PARTS = 1024
#: Entries of the runs that a task writes, or merges, together, about.
RUN_ENTRIES, MERGE_ENTRIES = 100_000, 500_000

# the fixed separators: a piece ends at one of .,;:!? and the line ends \x0A-\x0D; words
# stand between blanks and tabs
_PIECE_ENDS = b".,;:!?\n\x0b\x0c\r"
_FOLD = bytes(10 if b in _PIECE_ENDS else 32 if b == 9 else b + 32 if 65 <= b <= 90 else b for b in range(256))
_EMPTY, _END = 0, 1


class HatTrie:
    """Counts of phrases of ``depth`` words under a shallow trie: the first word's subtree is
    a hash container of the packed other words, which bursts into one container per second
    word when it outgrows ``BURST``. Single words stand in one container, under word 0."""

    def __init__(self, depth: int):
        self.depth, self.size = depth, 0
        self.roots: dict[int, dict] = {}
        self.burst: set[int] = set()

    def add(self, first: int, rest: Sequence[int], counts: Sequence[int]) -> None:
        """Counts of phrases that start with ``first``, each ``rest`` once."""
        root = self.roots.setdefault(first, {})
        if first in self.burst:
            for key, n in zip(rest, counts, strict=True):
                node = root.setdefault(key >> 32, {})
                had = node.get(key & 0xFFFFFFFF)
                if had is None:
                    self.size += 1
                node[key & 0xFFFFFFFF] = n + (had or 0)
            return
        before = len(root)
        get = root.get
        for key, n in zip(rest, counts, strict=True):
            root[key] = get(key, 0) + n
        self.size += len(root) - before
        if self.depth > 2 and len(root) > BURST:
            nodes: dict[int, dict[int, int]] = defaultdict(dict)
            for key, n in root.items():
                nodes[key >> 32][key & 0xFFFFFFFF] = n
            self.roots[first] = dict(nodes)
            self.burst.add(first)

    def weight(self, first: int) -> int:
        root = self.roots[first]
        return sum(map(len, root.values())) if first in self.burst else len(root)

    def take(self, firsts: Sequence[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The entries of whole subtrees, which go: first word, packed other words, count."""
        nodes = [(f, second << 32, node) for f in firsts for second, node in (self.roots[f].items() if f in self.burst else ((0, self.roots[f]),))]
        sizes = np.array([len(node) for _, _, node in nodes])
        n = int(sizes.sum())
        first = np.repeat(np.array([f for f, _, _ in nodes], np.int64), sizes)
        keys = np.fromiter(chain.from_iterable(node for _, _, node in nodes), np.int64, n) + np.repeat(np.array([s for _, s, _ in nodes], np.int64), sizes)
        counts = np.fromiter(chain.from_iterable(node.values() for _, _, node in nodes), np.int64, n)
        self.size -= n
        for f in firsts:
            self.burst.discard(f)
            del self.roots[f]
        return first, keys, counts

    def spill(self, keep: int) -> list[int]:
        """First words of the subtrees to write, the heaviest first, until ``keep`` entries stay."""
        sizes = sorted(((self.weight(f), f) for f in self.roots), reverse=True)
        out, left = [], self.size
        for n, first in sizes:
            if left <= keep:
                break
            out.append(first)
            left -= n
        return out


def bit_places(hashes: np.ndarray, bits: int) -> np.ndarray:
    return (mix64(hashes) & np.uint64(bits - 1)).astype(np.int64)


def phrase_hashes(words: Sequence[np.ndarray]) -> np.ndarray:
    """Hashes of phrases from those of their words, in order."""
    out = words[0]
    for w in words[1:]:
        out = mix64(out * np.uint64(0x9E3779B97F4A7C15) + w)
    return out


class _Words:
    """Word ids of one task and language."""

    def __init__(self):
        self.ids: dict[bytes, int] = defaultdict(lambda: len(self.ids))
        self.ids[b""], self.ids[b"\n"]
        self.hashes = np.zeros(2, np.uint64)
        self.words: list[bytes] = [b"", b"\n"]

    def of(self, text: bytes) -> np.ndarray:
        words = text.translate(_FOLD).replace(b"\n", b" \n ").split(b" ")
        ids = np.fromiter(map(self.ids.__getitem__, words), np.int64, len(words))
        if len(self.ids) > len(self.words):
            fresh = list(self.ids)[len(self.words):]
            self.words += fresh
            self.hashes = np.concatenate((self.hashes, word_hashes(fresh)))
        return ids[ids != _EMPTY]


def _grams(ids: np.ndarray, depth: int, ok: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct phrases of ``depth`` words inside pieces, in the order of their ids: first
    word (0 for single words), the others packed, count. ``ok``: starts that may count."""
    if depth == 1:
        counts = np.bincount(ids, minlength=2)
        counts[_END] = 0
        words = np.flatnonzero(counts)
        return np.zeros(len(words), np.int64), words, counts[words]
    n = max(len(ids) - depth + 1, 0)
    inside = np.ones(n, bool) if ok is None else ok
    for j in range(depth):
        inside = inside & (ids[j:n + j] != _END)
    at = np.flatnonzero(inside)
    if depth == 2:
        code, counts = np.unique(ids[at] << 32 | ids[at + 1], return_counts=True)
        return code >> 32, code & 0xFFFFFFFF, counts
    if len(ids) and ids.max() >= 1 << 21:
        rows, counts = np.unique(np.stack([ids[at + j] for j in range(3)]), axis=1, return_counts=True)
        return rows[0], rows[1] << 32 | rows[2], counts
    code, counts = np.unique(ids[at] << 42 | ids[at + 1] << 21 | ids[at + 2], return_counts=True)
    low = (1 << 21) - 1
    return code >> 42, (code >> 21 & low) << 32 | code & low, counts


def _runs(lang: str, words: _Words, trie: HatTrie, firsts: Sequence[int], often: frozenset[bytes]) -> Iterator[pa.RecordBatch]:
    """Writes subtrees as runs ``(lang, prefix, slice, rests, counts)``, in the order of the
    words, and drops them."""
    names = words.words
    rank = np.empty(len(names), np.int64)
    rank[sorted(range(len(names)), key=names.__getitem__)] = np.arange(len(names))
    arrow = pa.array(names, pa.binary())
    slices = np.fromiter((SLICES if w in often else 1 for w in names), np.int64, len(names))
    slices[0] = WORD_PARTS
    firsts = sorted(firsts, key=rank.__getitem__)
    sizes = np.cumsum([trie.weight(f) for f in firsts]) // RUN_ENTRIES
    for some in np.split(np.array(firsts, np.int64), np.flatnonzero(np.diff(sizes)) + 1) if firsts else ():
        first, keys, counts = trie.take(some.tolist())
        second, last = keys >> 32, keys & 0xFFFFFFFF
        part = (phrase_hashes([words.hashes[second], words.hashes[last]]) % slices[first].astype(np.uint64)).astype(np.int64)
        order = np.lexsort((rank[last], rank[second], part, rank[first]))
        first, second, last, part = first[order], second[order], last[order], part[order]
        starts = np.flatnonzero(np.append(True, (np.diff(first) != 0) | (np.diff(part) != 0)))
        rests = arrow.take(pa.array(last))
        if trie.depth > 2:
            rests = pc.binary_join_element_wise(arrow.take(pa.array(second)), rests, b" ")
        offsets = pa.array(np.append(starts, len(first)).astype(np.int32))
        for a in range(0, len(starts), 10_000):
            at = starts[a:a + 10_000]
            lists = offsets[a:a + len(at) + 1]
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(at), pa.string()), arrow.take(pa.array(first[at])).cast(pa.string()), pa.array(part[at], pa.int32()),
                 pa.ListArray.from_arrays(lists, rests.cast(pa.string())), pa.ListArray.from_arrays(lists, pa.array(counts[order]))],
                names=["lang", "prefix", "slice", "rests", "counts"])


def _count(depth: int, shared, hot, bits: int, entries: int):
    """Sorted runs of the phrases of a task's texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        field = np.frombuffer(shared.value, np.uint64) if shared else None
        often = hot.value if hot else frozenset()
        tries: dict[str, tuple[_Words, HatTrie]] = {}

        def counted(lang: str, text: bytes) -> Iterator[pa.RecordBatch]:
            if lang not in tries:
                tries[lang] = (_Words(), HatTrie(depth))
            words, trie = tries[lang]
            ids = words.of(text)
            ok = None
            if field is not None:
                # both phrases of one word less are frequent
                n = max(len(ids) - depth + 2, 0)
                at = bit_places(phrase_hashes([words.hashes[ids[j:n + j]] for j in range(depth - 1)]), bits)
                part = (field[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1) == 1
                ok = part[:-1] & part[1:]
            first, rest, counts = _grams(ids, depth, ok)
            edges = [0, *(np.flatnonzero(np.diff(first)) + 1).tolist(), len(first)] if len(first) else []
            first, rest, counts = first.tolist(), rest.tolist(), counts.tolist()
            for s, e in zip(edges, edges[1:]):
                trie.add(first[s], rest[s:e], counts[s:e])
            if trie.size > entries:
                yield from _runs(lang, words, trie, trie.spill(entries // 2), often)
            if len(words.words) > entries:
                yield from _runs(lang, words, trie, list(trie.roots), often)
                del tries[lang]

        for batch in batches:
            texts: dict[str, list[bytes]] = defaultdict(list)
            sizes: dict[str, int] = defaultdict(int)
            for lang, cell in zip(batch.column("lang").to_pylist(), batch.column("text").cast(pa.binary()), strict=True):
                text = cell.as_py()
                texts[lang].append(text)
                sizes[lang] += len(text)
                if sizes[lang] > CHUNK:
                    yield from counted(lang, b"\n".join(texts.pop(lang)))
                    sizes[lang] = 0
            for lang, some in texts.items():
                yield from counted(lang, b"\n".join(some))
            while sum(t.size for _, t in tries.values()) > entries * 5 // 4:  # several languages
                lang = max(tries, key=lambda x: tries[x][1].size)
                yield from _runs(lang, *tries[lang], list(tries[lang][1].roots), often)
                del tries[lang]
        for lang, (words, trie) in tries.items():
            yield from _runs(lang, words, trie, list(trie.roots), often)

    return run


def _merge(least: int):
    """Sums the runs of each (lang, prefix, slice), which follow each other: phrases of
    ``least`` occurrences or more, and for single words (prefix empty) the sum of all."""
    keys = ["lang", "prefix", "slice"]

    def summed(parts: list[pa.Table]) -> pa.Table:
        out = pa.concat_tables(parts).group_by([*keys, "rest"], use_threads=False).aggregate([("f", "sum")])
        return out.rename_columns([*keys, "rest", "f"])

    def phrases(table: pa.Table) -> Iterator[pa.RecordBatch]:
        single = pc.equal(table.column("prefix"), "")
        sums = table.filter(single).group_by("lang", use_threads=False).aggregate([("f", "sum")])
        table = table.filter(pc.greater_equal(table.column("f"), least))
        single = pc.equal(table.column("prefix"), "")
        name = pc.if_else(single, table.column("rest"), pc.binary_join_element_wise(table.column("prefix"), table.column("rest"), " "))
        out = pa.table({"lang": table.column("lang"), "phrase": name, "f": table.column("f")})
        total = pa.table({"lang": sums.column("lang"), "phrase": pa.nulls(len(sums), pa.string()), "f": sums.column("f_sum")})
        yield from pa.concat_tables([out, total]).combine_chunks().to_batches()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, kept = [], 0, 0
        for batch in batches:
            for at in range(0, len(batch), 1000):
                some = batch.slice(at, 1000)
                of = pc.list_parent_indices(some.column("rests"))
                held.append(pa.table({**{c: some.column(c).take(of) for c in keys}, "rest": pc.list_flatten(some.column("rests")), "f": pc.list_flatten(some.column("counts"))}))
                size += len(of)
                if size > MERGE_ENTRIES + 2 * kept:
                    table = summed(held)
                    # more runs of the last key may follow
                    last = pc.and_(pc.and_(*[pc.equal(table.column(c), some.column(c)[len(some) - 1]) for c in keys[:2]]), pc.equal(table.column("slice"), some.column("slice")[len(some) - 1]))
                    yield from phrases(table.filter(pc.invert(last)))
                    held = [table.filter(last)]
                    size = kept = len(held[0])
        if held:
            yield from phrases(summed(held))

    return run


def _bits(bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            phrases = [p.split(b" ") for p in batch.column("phrase").cast(pa.binary()).to_pylist()]
            at = np.zeros(0, np.int64)
            if phrases:
                at = np.unique(bit_places(phrase_hashes([word_hashes(w) for w in zip(*phrases, strict=True)]), bits))
            yield pa.RecordBatch.from_arrays([pa.array(at >> 6, pa.int64()), pa.array(np.left_shift(np.int64(1), at & 63), pa.int64())], names=["place", "bit"])

    return run


def _field(frequent: DataFrame, bits: int):
    """A broadcast of ``bits`` bits: those that the hashes of the frequent phrases name."""
    rows = frequent.select("phrase").mapInArrow(_bits(bits), "place long, bit long").groupBy("place").agg(F.bit_or("bit").alias("bit"))
    field = np.zeros(bits // 64, np.int64)
    for r in rows.toLocalIterator():
        field[r.place] = r.bit
    return frequent.sparkSession.sparkContext.broadcast(field.tobytes())


def phrase_counts(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", max_words: int = 3, least: int = LEAST,
                  entries: int = TRIE_ENTRIES, bits: int = FILTER_BITS) -> list[DataFrame]:
    """For each length from 1 to ``max_words``: ``(lang, phrase, f)`` of the phrases of
    ``least`` occurrences or more; among those of one word, ``phrase`` null has the
    occurrences of all words, in parts."""
    if not 1 <= max_words <= 3:
        raise ValueError("max_words must be 1, 2 or 3")
    texts = docs.select(F.coalesce(q(lang_col).cast("string"), F.lit("und")).alias("lang"), F.coalesce(q(text_col).cast("string"), F.lit("")).alias("text"))
    context, out, hot, field = docs.sparkSession.sparkContext, [], None, None
    for depth in range(1, max_words + 1):
        found = texts.mapInArrow(_count(depth, field, hot, bits, entries), "lang string, prefix string, slice int, rests array<string>, counts array<long>")
        found = found.repartition("lang", "prefix", "slice").sortWithinPartitions("lang", "prefix", "slice")
        out.append(staged(found.mapInArrow(_merge(least), "lang string, phrase string, f long"), f"phrases_{depth}"))
        named = out[-1].filter("phrase IS NOT NULL")
        if depth == 1 < max_words:
            # at most 1 / HOT_SHARE words can have that share
            total = out[0].filter("phrase IS NULL").agg(F.sum("f")).first()[0] or 0
            often = named.groupBy("phrase").agg(F.sum("f").alias("f")).filter(F.col("f") > HOT_SHARE * total).toLocalIterator()
            hot = context.broadcast(frozenset(r.phrase.encode() for r in often))
        if depth < max_words:
            field = _field(named, bits)
    return out


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", max_words: int = 3, least: int = LEAST, top: int = 2000,
                 inside_percent: int = 50, entries: int = TRIE_ENTRIES, bits: int = FILTER_BITS) -> DataFrame:
    """The ``top`` phrases of two to ``max_words`` (at most 3) words of each language:
    ``lang, rank, phrase, a, l, r, n, score``.

    A-Z is lower-cased; pieces end at ``.,;:!?`` and line ends, words stand between blanks and
    tabs. ``a`` is how often a phrase stands inside pieces, overlaps included, ``least`` at
    least; ``n`` are the words of the language. Cut after its first words, a phrase has
    ``l`` and ``r``, the counts of the parts, and floor(1000000 a a / (l r)); its lowest
    counts, on a tie that after fewer words. A phrase inside a longer candidate with
    ``inside_percent`` of its count or more is left out. By score, then ``a``, descending,
    then phrase by bytes. Null texts are empty, a null language is ``und``; rows that repeat
    count again; an empty table gives no rows."""
    singles, *longer = phrase_counts(docs, text_col, lang_col, max_words, least, entries, bits)
    spark = docs.sparkSession
    totals = singles.filter("phrase IS NULL").groupBy("lang").agg(F.sum("f").alias("n"))
    counts = singles.filter("phrase IS NOT NULL")
    scored, inside = None, None
    for depth, table in enumerate(longer, 2):
        words = F.split("phrase", " ", -1)
        part = lambda a, n: F.array_join(F.slice(words, a, n), " ")  # noqa: E731, B023
        cuts = None
        for k in range(1, depth):
            cut = table.select("lang", "phrase", F.col("f").alias("a"), F.lit(k).alias("k"), part(1, k).alias("left"), part(k + 1, depth - k).alias("right"))
            cuts = cut if cuts is None else cuts.unionByName(cut)
        for side, name in (("left", "l"), ("right", "r")):
            known = counts.select("lang", F.col("phrase").alias(side), F.col("f").alias(name))
            cuts = cuts.join(known, ["lang", side])
        big = lambda c: F.col(c).cast("decimal(18,0)")
        product = (big("a") * big("a")).cast("decimal(31,0)") * F.lit(1_000_000).cast("decimal(7,0)")
        cuts = cuts.withColumn("score", F.call_function("div", product, (big("l") * big("r")).cast("decimal(36,0)")))
        best = cuts.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("best"))
        best = best.select("lang", "phrase", "a", "best.l", "best.r", "best.score", F.lit(depth).alias("words"))
        scored = best if scored is None else scored.unionByName(best)
        counts = counts.unionByName(table)
        if depth > 2:
            for start in (1, 2):
                sub = table.select("lang", part(start, depth - 1).alias("phrase"), F.col("f").alias("longer"))
                inside = sub if inside is None else inside.unionByName(sub)
    if scored is None:
        return spark.createDataFrame([], "lang string, rank long, phrase string, a long, l long, r long, n long, score long")
    if inside is not None:
        inside = inside.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
        scored = scored.join(inside, ["lang", "phrase"], "left").filter(F.col("longer").isNull() | (F.lit(100) * F.col("longer") < F.lit(inside_percent) * F.col("a")))
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase").asc()]
    # the best of each of many parts of a language first, so that no task orders all of it
    parts = scored.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(SLICES)))
    some = parts.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))).filter(F.col("rank") <= top)
    ranked = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).filter(F.col("rank") <= top)
    ranked = ranked.join(totals, "lang")
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", F.col("score").cast("long").alias("score"))
