"""Embedding near-duplicates by int8 quantised tile products.

Each unit vector is stored as int8 codes with a scale and the norm of what quantisation
lost. The product of two code tiles then brackets every cosine of the tile; only pairs
whose upper bound reaches the threshold are computed again in double precision.

Tiles are cut out of cells: rings around pivots, which a bounded sample supplies. By the
triangle inequality of angles a vector has links into a cell only if its angle to the
pivot is within the threshold's angle of the cell's ring, so other tiles are not met."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .components import connected_components
from .staging import staged
from .texts import free_columns, q

#: Distinct vectors on one side of a tile, on average.
TILE = 2_048
#: Room for rounding in the single precision tile product (codes are exact, scales are not).
ROUNDING = 1e-5
#: Candidate pairs recomputed at a time.
CHUNK = 200_000
#: Pivots of all labels together at most, about; candidates for each of them.
PIVOTS, CANDIDATES = 1_024, 4
#: Room for rounding in angles (arc cosines near 1 lose half of a double's digits).
ANGLE_ROUNDING = 1e-6
ADDED = ("n_links", "component_id", "kept")


def usable(vector: Column, label: Column) -> Column:
    """Neither label nor vector null, every component a finite number, not all zero."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    return F.coalesce(label.isNotNull() & vector.isNotNull() & (F.size(vector) > 0) & ~bad
                      & F.exists(vector, lambda x: x != 0), F.lit(False))


def quantise(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes, scales and error norms of the unit vectors of ``vectors`` (double)."""
    top = np.abs(vectors).max(axis=1, keepdims=True)
    unit = vectors / top  # first by the largest, so that squares neither vanish nor overflow
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    scale = np.abs(unit).max(axis=1) / 127
    codes = np.rint(unit / scale[:, None]).astype(np.int8)
    return codes, scale, np.linalg.norm(unit - codes * scale[:, None], axis=1)


def unit_vectors(vectors: np.ndarray) -> np.ndarray:
    unit = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return unit / np.linalg.norm(unit, axis=1, keepdims=True)


def angles(unit: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(unit @ pivots.T, -1, 1))


def spread_out(unit: np.ndarray, count: int) -> np.ndarray:
    """``count`` of the rows at most, each the farthest from those before it; repeats end it."""
    picked, near = [0], angles(unit, unit[:1])[:, 0]
    while len(picked) < count and near.max() > ANGLE_ROUNDING:
        picked.append(int(near.argmax()))
        near = np.minimum(near, angles(unit, unit[picked[-1:]])[:, 0])
    return unit[picked]


def choose_pivots(rows: DataFrame, tile: int, most: int = PIVOTS) -> dict:
    """Pivots by (label, length): one for each ``tile`` of rows, ``most`` in all, chosen from
    a hashed sample of about ``CANDIDATES`` times as many rows. A label that the sample
    misses, or that has one candidate, has none and is one cell."""
    total = rows.count()
    want = min(most, total // tile)
    if want < 2:
        return {}
    share = int(CANDIDATES * want / total * (1 << 30))
    groups: dict = {}
    for r in sorted(rows.filter(F.pmod(F.xxhash64("node", F.lit(3)), F.lit(1 << 30)) < share).select("node", "label", "vector").collect()):
        groups.setdefault((r.label, len(r.vector)), []).append(r.vector)
    return {key: spread_out(unit_vectors(np.array(own, np.float64)), -(-len(own) // CANDIDATES)) for key, own in groups.items() if len(own) > 1}


def _by_key(batch: pa.RecordBatch, lengths: np.ndarray) -> Iterator[tuple[tuple, np.ndarray]]:
    """Row numbers of a batch by label and vector length."""
    own: dict = {}
    for k, key in enumerate(zip(batch.column("label").to_pylist(), lengths.tolist(), strict=True)):
        own.setdefault(key, []).append(k)
    for key, at in own.items():
        yield key, np.array(at)


def _codes(pivots: dict, ring: float):
    """Codes, and the cell of each vector: its nearest pivot's ring of width ``ring``."""
    rings = int(np.pi / ring) + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("vector")
            flat = column.flatten().to_numpy()
            ends = np.concatenate(([0], np.cumsum(column.value_lengths().to_numpy())))
            size = len(column)
            codes, raw = [b""] * size, [b""] * size
            scale, error, angle, cell = np.zeros(size), np.zeros(size), np.zeros(size), np.zeros(size, np.int32)
            for (label, length), at in _by_key(batch, np.diff(ends)):
                v = flat[ends[at][:, None] + np.arange(length)]
                c, scale[at], error[at] = quantise(v)
                for k, one, own in zip(at, c, v, strict=True):
                    codes[k], raw[k] = one.tobytes(), own.tobytes()
                if (label, length) in pivots:
                    far = angles(unit_vectors(v), pivots[label, length])
                    near = far.argmin(axis=1)
                    angle[at] = far[np.arange(len(at)), near]
                    cell[at] = near * rings + (angle[at] / ring).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column("node"), batch.column("label"), batch.column("n"), pa.array(codes, pa.binary()), pa.array(scale),
                 pa.array(error), pa.array(raw, pa.binary()), pa.array(np.diff(ends).astype(np.int32)), pa.array(cell), pa.array(angle)],
                names=["node", "label", "n", "codes", "scale", "error", "raw", "dim", "cell", "angle"],
            )

    return run


def _sends(pivots: dict, cells: dict, ring: float, reach: float):
    """The other cells in which a vector may have links. Of two cells one sends to the
    other, by the parity of their sum, so that each pair of vectors meets once."""
    rings = int(np.pi / ring) + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            home, raw = batch.column("cell").to_numpy(), batch.column("raw").to_pylist()
            sends = [[]] * len(home)
            for (label, length), own in _by_key(batch, batch.column("dim").to_numpy()):
                if (label, length) not in pivots:
                    continue
                cell, low, high = cells[label, length]
                for at in np.split(own, range(1_000, len(own), 1_000)):
                    v = np.frombuffer(b"".join(raw[k] for k in at), np.float64).reshape(len(at), length)
                    far = angles(unit_vectors(v), pivots[label, length])[:, cell // rings]
                    from_ = home[at][:, None]
                    turn = (from_ < cell) == ((from_ + cell) % 2 == 0)
                    hit = (far >= low - reach) & (far <= high + reach) & turn & (from_ != cell)
                    for k, row in zip(at, hit, strict=True):
                        sends[k] = cell[row].tolist()
            yield batch.append_column("sends", pa.array(sends, pa.list_(pa.int32())))

    return run


def cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row by row in double precision."""
    return np.einsum("ij,ij->i", a, b) / (np.sqrt(np.einsum("ij,ij->i", a, a)) * np.sqrt(np.einsum("ij,ij->i", b, b)))


def tile_pairs(codes, scale, error, raw, left, right, threshold: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Linked pairs (index arrays) between rows ``left`` and ``right``; on one and the same
    set each pair once.

    With a = a' + ea and b = b' + eb (codes and what they lost), |a.b - a'.b'| is at most
    |eb| + |ea| |b'| <= |eb| + |ea| (1 + |eb|), as a is a unit vector."""
    same = left is right
    codes = codes.astype(np.float32)  # products of int8 sums below 2 ** 24 are exact in it
    step = max(1, 4_000_000 // max(1, len(right)))
    for k in range(0, len(left), step):
        rows = left[k:k + step]
        upper = (codes[rows] @ codes[right].T) * scale[rows][:, None].astype(np.float32) * scale[right].astype(np.float32)
        upper += (error[right][None, :] + error[rows][:, None] * (1 + error[right][None, :])).astype(np.float32)
        i, j = np.nonzero(upper >= threshold - ROUNDING)
        i, j = rows[i], right[j]
        if same:
            i, j = i[i < j], j[i < j]
        for c in range(0, len(i), CHUNK):
            x, y = i[c:c + CHUNK], j[c:c + CHUNK]
            linked = cosines(raw[x], raw[y]) >= threshold
            yield x[linked], y[linked]


def _tile(threshold: float):
    """Per vector of a tile: weight of its links there, and a spanning forest of them."""

    def run(table: pa.Table) -> pa.Table:
        node, n, t = (table.column(c).to_numpy() for c in ("node", "n", "t"))
        codes = np.frombuffer(b"".join(table.column("codes").to_pylist()), np.int8).reshape(len(node), -1)
        raw = np.frombuffer(b"".join(table.column("raw").to_pylist()), np.float64).reshape(len(node), -1)
        scale, error = table.column("scale").to_numpy(), table.column("error").to_numpy()
        first, second = table.column("i")[0].as_py(), table.column("j")[0].as_py()
        left = np.flatnonzero(t == first)
        right = left if first == second else np.flatnonzero(t == second)
        links, root = np.zeros(len(node), np.int64), np.arange(len(node))
        for x, y in tile_pairs(codes, scale, error, raw, left, right, threshold):
            np.add.at(links, x, n[y])
            np.add.at(links, y, n[x])
            while True:  # hook the larger root under the smaller, then shorten the paths
                a, b = root[x], root[y]
                apart = a != b
                if not apart.any():
                    break
                x, y, a, b = x[apart], y[apart], a[apart], b[apart]
                np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
                while (root[root] != root).any():
                    root = root[root]
        at = np.flatnonzero(links)
        return pa.table({"node": pa.array(node[at]), "links": pa.array(links[at]), "root": pa.array(node[root[at]])})

    return run


def vector_tiles(rows: DataFrame, threshold: float, tile: int = TILE) -> DataFrame:
    """The tiles to compare, as rows ``(label, dim, cell, i, j, t, node, n, codes, scale,
    error, raw)`` to be grouped by the first five: the rows with ``t = i`` against those
    with ``t = j``.

    The vectors of one label and length are dealt into cells, those of a cell by hash into
    blocks of about ``tile``. Each pair of a cell's blocks is a tile, and so is each of its
    blocks with each block (``j`` < 0) of the vectors that other cells send: a tile has
    about 2 x ``tile`` rows, however many vectors a label or a cell has."""
    label = dict(rows.dtypes)["label"]
    reach = float(np.arccos(np.clip(threshold, -1, 1))) + ANGLE_ROUNDING
    ring = max(reach, 0.05)
    pivots = choose_pivots(rows, tile)
    columns = f"node long, label {label}, n long, codes binary, scale double, error double, raw binary, dim int, cell int, angle double"
    coded = staged(rows.select("node", "label", "n", "vector").mapInArrow(_codes(pivots, ring), columns), "vec_codes")
    of = ["label", "dim", "cell"]
    body = ["node", "n", "codes", "scale", "error", "raw"]
    cells = coded.groupBy(*of).agg(F.ceil(F.count(F.lit(1)) / F.lit(tile)).cast("int").alias("blocks"), F.min("angle").alias("low"), F.max("angle").alias("high"))
    home = coded.join(cells.select(*of, "blocks"), of).withColumn("t", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    within = home.withColumn("o", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    within = within.select(*of, F.least("t", "o").alias("i"), F.greatest("t", "o").alias("j"), "t", *body)
    if not pivots:
        return within
    known: dict = {}  # at most a few rings for each pivot
    split = F.broadcast(rows.sparkSession.createDataFrame([(k[0], k[1]) for k in pivots], f"label {label}, dim int"))
    for r in sorted(cells.join(split, ["label", "dim"], "left_semi").select(*of, "low", "high").collect()):
        known.setdefault((r.label, r.dim), []).append((r.cell, r.low, r.high))
    known = {k: (np.array([x[0] for x in v], np.int32), np.array([x[1] for x in v]), np.array([x[2] for x in v])) for k, v in known.items()}
    sent = staged(coded.mapInArrow(_sends(pivots, known, ring, reach), columns + ", sends array<int>").filter(F.size("sends") > 0), "vec_sends")
    sent = sent.select("label", "dim", F.explode("sends").alias("cell"), *body)
    guests = sent.groupBy(*of).agg(F.ceil(F.count(F.lit(1)) / F.lit(tile)).cast("int").alias("chunks"))
    sent = sent.join(guests, of).join(cells.select(*of, "blocks"), of)
    sent = sent.withColumn("t", -1 - F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int"))
    sent = sent.withColumn("i", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    hosts = home.join(guests, of).withColumn("c", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    hosts = hosts.select(*of, F.col("t").alias("i"), (-1 - F.col("c")).alias("j"), "t", *body)
    return within.unionByName(hosts).unionByName(sent.select(*of, "i", F.col("t").alias("j"), "t", *body))


def vector_links(rows: DataFrame, threshold: float, tile: int = TILE) -> tuple[DataFrame, DataFrame]:
    """For distinct vectors ``(node, label, n, vector)``: ``(node, links)`` with the weight
    of the other vectors linked to each, and ``(a, b)`` links that span the components.
    A tile returns a row for each of its vectors at most."""
    tiles = vector_tiles(rows, threshold, tile).groupBy("label", "dim", "cell", "i", "j")
    found = staged(tiles.applyInArrow(_tile(threshold), "node long, links long, root long"), "vec_links")
    return found.groupBy("node").agg(F.sum("links").alias("links")), found.select(F.col("node").alias("a"), F.col("root").alias("b"))


def embedding_near_duplicates(vectors: DataFrame, threshold: float = 0.93, id_col: str = "vec_id", vector_col: str = "embedding",
                              label_col: str = "label", tile: int = TILE) -> DataFrame:
    """Every row of ``vectors`` (all columns) with ``n_links`` (other rows linked directly),
    ``component_id`` (smallest id reachable, its own included) and ``kept`` (its id is that).

    Rows are linked when their labels are equal and their cosine in double precision is
    ``threshold`` or more; vectors of different length are not comparable. A null label, and
    a vector that is null, empty, zero or holds null or non-finite components, is linked
    with nothing. Equal vectors are compared once and count as often as they occur; -0.0
    equals 0.0. A row with a null id takes part and is kept only if its whole component has
    null ids."""
    keep = free_columns(vectors, ADDED)
    plain = vectors.select(*[q(c).alias(f"__c{i}") for i, c in enumerate(keep)])
    ident, vector, label = (f"__c{keep.index(c)}" for c in (id_col, vector_col, label_col))
    clean = F.transform(F.col(vector), lambda x: x.cast("double") + F.lit(0.0))
    plain = plain.withColumn("__node", F.when(usable(F.col(vector), F.col(label)), F.xxhash64(F.col(label), clean)))
    rows = plain.filter("__node is not null").select(F.col("__node").alias("node"), F.col(label).alias("label"), clean.alias("vector"), F.col(ident).alias("id"))
    distinct = staged(rows.groupBy("node").agg(F.first("label").alias("label"), F.first("vector").alias("vector"),
                                               F.count(F.lit(1)).alias("n"), F.min("id").alias("first_id")), "vec_distinct")
    links, spanning = vector_links(distinct, threshold, tile)
    comp = connected_components(spanning)
    placed = distinct.select("node", "n", "first_id").join(comp, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = placed.groupBy("root").agg(F.min("first_id").alias("component_id"))
    result = placed.join(least, "root").join(links, "node", "left").select(
        F.col("node").alias("__n2"), (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("__links"), F.col("component_id").alias("__comp"))
    out = plain.join(result, plain["__node"] == result["__n2"], "left")
    comp_id = F.when(F.col("__n2").isNull(), F.col(ident)).otherwise(F.col("__comp"))
    return out.select(*[F.col(f"__c{i}").alias(c) for i, c in enumerate(keep)], F.coalesce("__links", F.lit(0)).cast("long").alias("n_links"),
                      comp_id.alias("component_id"), F.col(ident).eqNullSafe(comp_id).alias("kept"))
