"""Laplacian eigenvectors and the tall QR against numpy."""
import numpy as np

from quarry.operators import reduce as R
from quarry.operators import spectral as SP


def frame(spark, x):
    return spark.createDataFrame([(int(i), [float(v) for v in a]) for i, a in enumerate(x)], "id long, v array<double>").repartition(3)


def test_eigenvalues_equal_numpy(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(500, 3)) + 4 * rng.normal(size=(4, 3))[np.arange(500) % 4]
    edges = SP.knn_affinity(frame(spark, x), "id", "v", 8, gamma=0.3)
    w = np.zeros((500, 500))
    for r in edges.collect():
        w[r["i"], r["j"]] += r["w"]
    assert np.allclose(w, w.T)
    root = np.sqrt(w.sum(1))
    values, vectors = np.linalg.eigh(np.eye(500) - w / root[:, None] / root)
    got = SP.laplacian_embedding(edges, 6)
    assert np.allclose(got.eigenvalues, values[:6], atol=1e-7)
    rows = {r["id"]: r["x"] for r in got.rows.collect()}
    mine = np.stack([rows[i] for i in range(500)]) * root[:, None]
    # the same space: each of numpy's vectors lies in ours where the gap to the next value is wide
    gap = int(np.argmax(np.diff(values[:7]))) + 1
    q = np.linalg.qr(mine[:, :gap])[0]
    assert np.allclose(np.linalg.norm(q.T @ vectors[:, :gap], axis=0), 1, atol=1e-4)


def test_rings_are_split(spark):
    rng = np.random.default_rng(2)
    t, ring = rng.random(300) * 2 * np.pi, np.arange(300) % 2
    x = (1 + 2 * ring + 0.05 * rng.normal(size=300))[:, None] * np.c_[np.cos(t), np.sin(t)]
    got = {r["id"]: r["cluster"] for r in SP.spectral_clusters(frame(spark, x), "id", "v", 2, n_neighbors=6, gamma=None).collect()}
    sides = [{got[i] for i in range(300) if ring[i] == k} for k in (0, 1)]
    assert len(sides[0]) == len(sides[1]) == 1 and sides[0] != sides[1]


def test_randomised_pca_keeps_small_axes(spark):
    rng = np.random.default_rng(3)
    u = np.linalg.qr(rng.normal(size=(1500, 8)))[0]
    v = np.linalg.qr(rng.normal(size=(8, 8)))[0]
    x = (u * np.logspace(0, -7, 8)) @ v.T
    x -= x.mean(0)
    want = np.linalg.svd(x, compute_uv=False) ** 2 / 1499
    got = R.randomized_pca(frame(spark, x), "v", 8)
    assert np.allclose(got.explained_variance, want, rtol=1e-8)
    r = R.tall_qr(frame(spark, x), "v", lambda a: a, 8, groups=2)
    assert np.allclose(np.sort(np.linalg.svd(r, compute_uv=False))[::-1], np.sqrt(want * 1499), rtol=1e-8)
    assert np.allclose(np.tril(r, -1), 0)
