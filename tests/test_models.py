import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from quarry.operators import linear as L
from quarry.operators import reduce as R
from quarry.operators.aggregate import gram


@pytest.fixture(scope="module")
def reg(spark):
    rng = np.random.default_rng(3)
    X = rng.normal(size=(400, 3))
    y = X @ np.array([1.5, -2.0, 0.5]) + 4.0 + rng.normal(scale=0.1, size=400)
    rows = [(i, [float(v) for v in X[i]], float(y[i])) for i in range(400)]
    df = spark.createDataFrame(rows, "id long, x array<double>, y double")
    return df.withColumn("features", array_to_vector("x")), X, y


def test_normal_equation_matches_numpy(reg):
    df, X, y = reg
    fit = L.fit_linear(df.repartition(5), "features", "y")
    Xa = np.hstack([np.ones((len(X), 1)), X])
    th = np.linalg.lstsq(Xa, y, rcond=None)[0]
    assert np.allclose(np.concatenate([[fit.intercept], fit.coef]), th, atol=1e-9)


def test_gradient_descent_converges(reg):
    df, X, y = reg
    m = gram(df, "features", "y")
    ne = L.solve_normal(m)
    bgd = L.batch_gd(m, eta=0.1, n_iter=3000)
    assert np.allclose(bgd.coef, ne.coef, atol=1e-6)
    mb = L.minibatch_gd(L.batch_moments(df, "features", "y", 10, ["id"]), n_epochs=50)
    assert np.allclose(mb.coef, ne.coef, atol=0.05)


def test_ridge_mapping_matches_closed_form(spark, reg):
    df, X, y = reg
    n = len(y)
    alpha = 10.0
    m = L.regularized("ridge", alpha, n, float(np.std(y)), label="y").fit(df)
    Xc, yc = X - X.mean(0), y - y.mean()
    w = np.linalg.solve(Xc.T @ Xc + alpha * np.eye(3), Xc.T @ yc)
    assert np.allclose(m.coefficients.toArray(), w, atol=1e-4)


def test_learning_curve_monotone_sizes(reg):
    df, _, _ = reg
    lc = L.learning_curve(df, "features", "y", ["id"], n_steps=5)
    sizes = [s for s, _, _ in lc]
    assert sizes == sorted(sizes) and all(v < 1.0 for _, _, v in lc[1:])


def test_pca_matches_numpy_and_invariants(spark):
    rng = np.random.default_rng(1)
    X = rng.normal(size=(300, 5)) @ rng.normal(size=(5, 5))
    df = spark.createDataFrame([(i, [float(v) for v in X[i]]) for i in range(300)],
                               "id long, x array<double>")
    p = R.pca(df, "x", 5)
    Xc = X - X.mean(0)
    _, s, vt = np.linalg.svd(Xc, full_matrices=False)
    assert np.allclose(p.explained_variance, s ** 2 / 299, rtol=1e-8)
    for a, b in zip(p.components, vt):
        assert abs(abs(a @ b) - 1) < 1e-8
    # full reconstruction is exact, partial is lossy
    e5 = R.reconstruction_errors(df, "x", p).agg(F.max("rec_error")).first()[0]
    e2 = R.reconstruction_errors(df, "x", R.pca(df, "x", 2)).agg(F.avg("rec_error")).first()[0]
    assert e5 < 1e-18 * 1e6 and e2 > 1e-3
    inc = R.incremental_pca(df.withColumn("b", F.col("id") % 4), "x", "b", 3)
    assert np.allclose(inc.explained_variance, p.explained_variance[:3], rtol=1e-10)
    rp = R.randomized_pca(df, "x", 2)
    assert all(abs(abs(a @ b) - 1) < 1e-6 for a, b in zip(rp.components, p.components[:2]))


def test_lda_separates_planted_classes(spark):
    rng = np.random.default_rng(2)
    X = rng.normal(size=(200, 4))
    y = np.arange(200) % 2
    X[:, 0] += 4 * y
    df = spark.createDataFrame([(int(y[i]), [float(v) for v in X[i]]) for i in range(200)],
                               "y int, x array<double>")
    r = R.lda(df, "x", "y", 1)
    assert abs(r["axes"][0][0]) > 0.9
