import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.operators import cluster as C
from quarry.operators import density as D
from quarry.operators import joins as J
from quarry.operators import metrics as E


@pytest.fixture(scope="module")
def blobs(spark):
    rng = np.random.default_rng(5)
    centers = np.array([[0, 0], [5, 5], [0, 6]], dtype=float)
    lab = np.arange(300) % 3
    X = centers[lab] + rng.normal(scale=0.5, size=(300, 2))
    df = spark.createDataFrame([(i, [float(v) for v in X[i]], int(lab[i]), float(X[i, 0]),
                                 float(X[i, 1])) for i in range(300)],
                               "id long, v array<double>, g int, x double, y double")
    return df, X, lab


def test_lloyd_matches_numpy(blobs):
    df, X, lab = blobs
    init = X[:3].tolist()
    r = C.lloyd(df, "v", init, max_iter=5, tol=0)
    c = np.array(init)
    for _ in range(5):
        a = np.argmin(((X[:, None] - c[None]) ** 2).sum(-1), 1)
        c = np.stack([X[a == j].mean(0) if (a == j).any() else c[j] for j in range(3)])
    assert np.allclose(np.array(r["centroids"]), c, atol=1e-9)


def test_knn_join_matches_brute_force(blobs):
    df, X, _ = blobs
    k = J.knn_join(df, df, 4, "id", "v", exclude_self=True, block_rows=64)
    got = {(r["qid"], r["rank"]): r["nid"] for r in k.collect()}
    D2 = np.sqrt(((X[:, None] - X[None]) ** 2).sum(-1))
    np.fill_diagonal(D2, np.inf)
    for q in range(0, 300, 37):
        order = np.lexsort((np.arange(300), D2[q]))[:4]
        assert [got[(q, i + 1)] for i in range(4)] == list(order)


def test_radius_grid_equals_blocked_equals_brute(blobs):
    df, X, _ = blobs
    eps = 0.3
    g = {(r[0], r[1]) for r in J.radius_join_grid(df, "id", "x", "y", eps).select("id_a", "id_b").collect()}
    b = {(r[0], r[1]) for r in J.radius_join_blocked(df, "id", "v", eps, block_rows=64)
         .select("id_a", "id_b").collect()}
    D2 = np.sqrt(((X[:, None] - X[None]) ** 2).sum(-1))
    brute = {(i, j) for i in range(300) for j in range(300) if i != j and D2[i, j] <= eps}
    assert g == brute == b


def test_dbscan_vs_brute_force(blobs):
    df, X, _ = blobs
    eps, ms = 0.6, 5
    lab = {r["id"]: (r["label"], r["is_core"]) for r in
           C.dbscan(df, "id", eps, ms, xy=("x", "y")).collect()}
    D2 = np.sqrt(((X[:, None] - X[None]) ** 2).sum(-1))
    nb = D2 <= eps
    core = nb.sum(1) >= ms
    # components of the core graph
    comp = -np.ones(300, dtype=int)
    for s in np.where(core)[0]:
        if comp[s] >= 0:
            continue
        stack, comp[s] = [s], s
        while stack:
            u = stack.pop()
            for v in np.where(nb[u] & core)[0]:
                if comp[v] < 0:
                    comp[v] = s
                    stack.append(v)
    for i in range(300):
        assert lab[i][1] == bool(core[i])
        if not core[i]:
            cs = [comp[j] for j in np.where(nb[i] & core)[0]]
            if not cs:
                assert lab[i][0] == -1
    # same partition of core points
    pairs = [(i, j) for i in range(0, 300, 7) for j in range(0, 300, 11) if core[i] and core[j]]
    for i, j in pairs:
        assert (lab[i][0] == lab[j][0]) == (comp[i] == comp[j])


def test_silhouette_matches_numpy(blobs):
    df, X, lab = blobs
    s = {r["id"]: r["silhouette"] for r in E.silhouette(df, "id", "v", "g", block_rows=64).collect()}
    D2 = np.sqrt(((X[:, None] - X[None]) ** 2).sum(-1))
    for i in range(0, 300, 29):
        own = lab == lab[i]
        a = D2[i, own].sum() / (own.sum() - 1)
        b = min(D2[i, lab == c].mean() for c in range(3) if c != lab[i])
        assert abs(s[i] - (b - a) / max(a, b)) < 1e-9


def test_em_recovers_blobs_and_bic(blobs):
    df, X, lab = blobs
    m = D.em(df, "v", 3, "full", max_iter=50, id_col="id")
    got = sorted(map(tuple, np.round(m.means)))
    assert got == sorted([(0.0, 0.0), (5.0, 5.0), (0.0, 6.0)])
    assert abs(m.bic() - (-2 * m.log_likelihood + m.n_parameters() * np.log(300))) < 1e-9
    for ct in ("tied", "diag", "spherical"):
        assert np.isfinite(D.em(df, "v", 3, ct, max_iter=10, id_col="id").log_likelihood)


def test_density_integrates_to_one(spark, blobs):
    df, X, _ = blobs
    m = D.em(df, "v", 3, "full", max_iter=30, id_col="id")
    from quarry.functions.mathfn import grid
    g = grid(spark, (-6, 11), (-6, 12), 120, 120).withColumn("p", F.array("x", "y"))
    dens = g.select(F.exp(D.score_samples("p", m)).alias("d")).agg(F.sum("d")).first()[0]
    cell = (17 / 119) * (18 / 119)
    assert abs(dens * cell - 1.0) < 0.02


def test_roc_auc_matches_numpy(spark):
    rng = np.random.default_rng(9)
    s = np.round(rng.random(500), 2)
    y = (rng.random(500) < s).astype(int)
    df = spark.createDataFrame([(float(a), int(b)) for a, b in zip(s, y)], "s double, y int")
    auc = E.roc_auc(df, "s", "y").first()[0]
    pos, neg = s[y == 1], s[y == 0]
    ref = ((pos[:, None] > neg[None]).sum() + 0.5 * (pos[:, None] == neg[None]).sum()) / (len(pos) * len(neg))
    assert abs(auc - ref) < 1e-12


def test_digamma():
    from quarry.operators.density import _digamma
    assert abs(_digamma(1.0) + 0.5772156649015329) < 1e-10
    assert abs(_digamma(0.5) + 1.9635100260214235) < 1e-10


def test_variational_gmm_prunes_extra_components(blobs):
    df, X, lab = blobs
    m = D.vb_gmm(df, "v", 6, "id", max_iter=100, weight_prior=0.001)
    big = sorted(w for w in m.weights if w > 0.05)
    assert len(big) == 3 and abs(sum(big) - 1.0) < 0.05
