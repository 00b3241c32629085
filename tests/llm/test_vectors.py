import random

import numpy as np
from pyspark.sql import functions as F

from joinery.llm import vectors
from joinery.llm.queries import op10_vectors
from .conftest import frame


def brute(rows, threshold=0.93):
    def fit(v, label):
        return label is not None and v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(v)

    good = [k for k, (_, v, label) in enumerate(rows) if fit(v, label)]
    links, root = [0] * len(rows), list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for p, a in enumerate(good):
        for b in good[p + 1:]:
            (_, va, la), (_, vb, lb) = rows[a], rows[b]
            if la == lb and len(va) == len(vb):
                va, vb = np.array(va, float), np.array(vb, float)
                if va @ vb / (np.sqrt(va @ va) * np.sqrt(vb @ vb)) >= threshold:
                    links[a] += 1
                    links[b] += 1
                    root[find(a)] = find(b)
    groups = {}
    for k in range(len(rows)):
        groups.setdefault(find(k), []).append(k)
    out = [None] * len(rows)
    for members in groups.values():
        comp = min((rows[k][0] for k in members if rows[k][0] is not None), default=None)
        for k in members:
            out[k] = (rows[k][0], links[k], comp, rows[k][0] == comp)
    return out


def same(got, want):
    key = lambda r: tuple(str(x) for x in r)
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)


def test_query_equals_brute_force(spark, corpus):
    same(op10_vectors(spark, corpus.sf_dir).collect(), brute([(r.vec_id, r.embedding, r.label) for r in corpus.embeddings]))


def made():
    rng = np.random.default_rng(8)
    rows = []
    for g in range(12):
        centre = rng.normal(size=16)
        for _ in range(25):
            rows.append([float(np.float32(x)) for x in centre + rng.normal(size=16) * rng.uniform(0.05, 0.5)])
    rows = [(i, v, i % 2) for i, v in enumerate(rows)]
    copies = [(1000 + i, rows[3][1], rows[3][2]) for i in range(40)]
    inf, nan = float("inf"), float("nan")
    odd = [(2000, None, 1), (2001, [0.0] * 16, 1), (2002, [nan] + [1.0] * 15, 1), (2003, [inf] + [1.0] * 15, 1), (2004, [None] + [1.0] * 15, 1),
           (2005, rows[3][1], None), (2006, [], 1), (2007, [1.0, 2.0], 1), (2008, [2.0, 4.0], 1), (None, rows[3][1], rows[3][2]), (None, [3.0], 0),
           (2009, [-0.0, 1.0, 0.0], 1), (2010, [0.0, 1.0, -0.0], 1), rows[7], rows[7]]
    out = rows + copies + odd
    random.Random(2).shuffle(out)
    return out


def test_made_vectors_in_small_tiles(spark):
    rows = made()
    df = frame(spark, [(*r, 5) for r in rows], "vec_id long, embedding array<float>, label int, N_links int").repartition(5)
    out = vectors.embedding_near_duplicates(df, tile=16)
    assert out.columns == ["vec_id", "embedding", "label", "n_links", "component_id", "kept"]
    same(out.select("vec_id", "n_links", "component_id", "kept").collect(), brute(rows))


def clustered(count, size, dim=24):
    rng = np.random.default_rng(3)
    out = []
    for _ in range(count):
        centre = rng.normal(size=dim)
        out += [[float(x) for x in centre + rng.normal(size=dim) * 0.2] for _ in range(size)]
    return [(i, v, 1) for i, v in enumerate(out)]


def test_cells_spare_tiles_and_lose_no_link(spark):
    rows = clustered(40, 50)
    same([tuple(r) for r in vectors.embedding_near_duplicates(
        frame(spark, rows, "vec_id long, embedding array<double>, label int").repartition(5), tile=32)
        .select("vec_id", "n_links", "component_id", "kept").collect()], brute(rows))
    nodes = frame(spark, [(i, 1, 1, v) for i, v, _ in rows], "node long, label int, n long, vector array<double>")
    tiles = vectors.vector_tiles(nodes, 0.93, tile=32).groupBy("label", "dim", "cell", "i", "j").agg(
        F.sum((F.col("t") == F.col("i")).cast("long")).alias("a"), F.sum((F.col("t") == F.col("j")).cast("long")).alias("b"))
    met = tiles.select(F.sum(F.when(F.col("i") == F.col("j"), F.col("a") * (F.col("a") - 1) / 2).otherwise(F.col("a") * F.col("b")))).first()[0]
    assert met < 0.25 * len(rows) * (len(rows) - 1) / 2
    assert tiles.agg(F.max(F.col("a") + F.col("b"))).first()[0] < 6 * 32


def test_every_threshold(spark):
    rows = clustered(6, 20, 5)
    df = frame(spark, rows, "vec_id long, embedding array<double>, label int")
    for threshold in (0.2, 0.99):
        out = vectors.embedding_near_duplicates(df, threshold, tile=16)
        same(out.select("vec_id", "n_links", "component_id", "kept").collect(), brute(rows, threshold))


def test_bounds_hold():
    rng = np.random.default_rng(1)
    v = rng.normal(size=(400, 24)) * rng.uniform(1e-3, 1e3, size=(400, 1))
    codes, scale, error = vectors.quantise(v)
    unit = v / np.linalg.norm(v, axis=1, keepdims=True)
    about = (codes.astype(float) * scale[:, None]) @ (codes.astype(float) * scale[:, None]).T
    bound = error[None, :] + error[:, None] * (1 + error[None, :])
    assert (np.abs(unit @ unit.T - about) <= bound + 1e-12).all()


def test_empty(spark):
    df = frame(spark, made()[:3], "vec_id long, embedding array<float>, label int").filter("false")
    assert vectors.embedding_near_duplicates(df).count() == 0
