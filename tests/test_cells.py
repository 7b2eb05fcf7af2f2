"""DBSCAN by the graph of cells against brute force."""
import numpy as np
import pytest

from quarry.operators import cluster as C


def brute(ids, x, y, eps, least):
    n = len(ids)
    d = np.sqrt((x[:, None] - x[None]) ** 2 + (y[:, None] - y[None]) ** 2) <= eps
    core = d.sum(1) >= least
    comp = np.full(n, -1)
    for i in np.flatnonzero(core):
        if comp[i] < 0:
            comp[i], work = i, [i]
            while work:
                j = work.pop()
                for m in np.flatnonzero(d[j] & core & (comp < 0)):
                    comp[m] = i
                    work.append(m)
    name = {c: min(ids[(comp == c) & core]) for c in set(comp[core])}
    out = {}
    for i in range(n):
        near = [name[comp[j]] for j in np.flatnonzero(d[i] & core)]
        out[int(ids[i])] = (int(name[comp[i]]) if core[i] else min(near, default=None), bool(core[i]))
    rank = {c: k for k, c in enumerate(sorted({c for c, _ in out.values() if c is not None}))}
    return {i: (rank.get(c, -1), core) for i, (c, core) in out.items()}


def run(spark, ids, x, y, eps, least):
    df = spark.createDataFrame([(int(i), float(a), float(b)) for i, a, b in zip(ids, x, y)], "id long, x double, y double")
    return {r["id"]: (r["label"], r["is_core"]) for r in C.dbscan(df.repartition(5), "id", eps, least, xy=("x", "y")).collect()}


@pytest.mark.parametrize("kind", ["blobs", "lattice", "rings", "line", "copies"])
def test_equal_to_brute_force(spark, kind):
    rng = np.random.default_rng(3)
    n = 700
    if kind == "blobs":
        x, y, eps, least = rng.normal(size=n) + 3 * rng.integers(0, 3, n), rng.normal(size=n), 0.3, 5
    elif kind == "lattice":                       # many distances of exactly eps, and of just above it
        x, y = rng.integers(0, 30, n).astype(float), rng.integers(0, 30, n).astype(float)
        eps, least = 1.0, 3
    elif kind == "rings":
        t, r = rng.random(n) * 2 * np.pi, rng.choice([1.0, 2.0, 2.25], n)
        x, y, eps, least = r * np.cos(t), r * np.sin(t), 0.2, 4
    elif kind == "line":
        x, y, eps, least = np.cumsum(rng.random(n) * 0.2), np.zeros(n), 0.12, 2
    else:
        x, y, eps, least = rng.integers(0, 6, n) * 0.7, rng.integers(0, 6, n) * 0.7, 0.7 * np.sqrt(2), 30
    ids = rng.permutation(n) + 10
    assert run(spark, ids, x, y, eps, least) == brute(ids, x, y, eps, least)


def test_two_dense_cells_just_apart(spark):
    """Boxes are halved until the closest points decide."""
    rng = np.random.default_rng(4)
    for gap, joined in ((1.0, True), (1.0 + 1e-6, False)):
        left = np.c_[-0.6 * rng.random(300), 0.6 * rng.random(300)]
        right = np.c_[gap + 0.6 * rng.random(300), 0.6 * rng.random(300)]
        pts = np.r_[left, [[0.0, 0.3]], right, [[gap, 0.3]]]
        got = run(spark, np.arange(len(pts)), pts[:, 0], pts[:, 1], 1.0, 5)
        assert len({label for label, _ in got.values()}) == (1 if joined else 2)


def test_hot_cell_and_odd_rows(spark):
    from pyspark.sql import functions as F
    hot = spark.range(100_000).select("id", F.lit(5.0).alias("x"), F.lit(5.0).alias("y"))
    rest = spark.createDataFrame([(200_000, 5.2, 5.0), (200_001, 9.0, 9.0), (200_002, None, 1.0), (200_003, float("nan"), 1.0),
                                  (200_004, 5.45, 5.0)], "id long, x double, y double")
    got = C.dbscan(hot.unionByName(rest), "id", 0.3, 10, xy=("x", "y"))
    count = {(r["label"], r["is_core"]): r["n"] for r in got.groupBy("label", "is_core").agg(F.count("*").alias("n")).collect()}
    assert count == {(0, True): 100_001, (0, False): 1, (-1, False): 3}
    assert C.dbscan(rest.limit(0), "id", 0.3, 10, xy=("x", "y")).collect() == []
