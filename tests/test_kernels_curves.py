"""Random features, stick-breaking mixtures, learning curves of any estimator."""
import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from quarry.operators import density as D
from quarry.operators import histtrees as H
from quarry.operators import linear as L
from quarry.operators import randomfeatures as RF
from quarry.operators import selection as G


def frame(spark, x, y=None):
    y = np.zeros(len(x)) if y is None else y
    return spark.createDataFrame([(int(i), [float(v) for v in a], float(b)) for i, (a, b) in enumerate(zip(x, y))],
                                 "id long, x array<double>, label double").repartition(3)


def test_fourier_features_stay_near_the_kernel():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(60, 5))
    z = RF.FourierFeatures.draw(5, 4000, 0.3).rows(x)
    want = np.exp(-0.3 * ((x[:, None] - x[None]) ** 2).sum(-1))
    # Hoeffding over 1,770 pairs: 8 exp(-D e^2 / 8) per pair
    assert np.abs(z @ z.T - want).max() < np.sqrt(8 * np.log(8 * 1770 / 1e-3) / 4000)
    assert np.abs(z @ z.T - want).mean() < 2 / np.sqrt(4000)


@pytest.mark.parametrize("degree", [1, 2, 3])
def test_tensor_sketch_stays_near_the_kernel(degree):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(40, 4))
    x /= np.linalg.norm(x, axis=1)[:, None]
    want = (1 + x @ x.T) ** degree
    errors = [RF.TensorSketch.draw(4, 1024, degree, seed=s).rows(x) for s in range(8)]
    errors = np.array([z @ z.T - want for z in errors])
    bound = 2.0 ** degree * np.sqrt(3.0 ** degree / 1024)          # root of the variance bound
    assert np.sqrt((errors ** 2).mean()) < bound and np.abs(errors.mean(0)).max() < 3 * bound
    small = RF.TensorSketch.draw(4, 64, degree).rows(x)
    assert np.sqrt(((small @ small.T - want) ** 2).mean()) > np.sqrt((errors ** 2).mean()) / 2


def test_kernel_svm_and_svr_learn_what_lines_cannot(spark):
    rng = np.random.default_rng(3)
    x = rng.uniform(-1, 1, size=(500, 2))
    ring = ((x ** 2).sum(1) < 0.5).astype(float)
    df = frame(spark, x, ring)
    for drawn in (RF.FourierFeatures.draw(2, 200, 2.0), RF.TensorSketch.draw(2, 200, 2)):
        m, drawn = RF.kernel_svc(df, "x", "label", drawn, C=50.0)
        got = m.transform(RF.with_features(df, "x", drawn, "z")).select("label", "prediction").collect()
        assert np.mean([r["label"] == r["prediction"] for r in got]) > 0.95
    y = np.sin(4 * x[:, 0])
    drawn = RF.FourierFeatures.draw(2, 100, 2.0)
    fit = RF.kernel_svr(frame(spark, x, y), "x", "label", drawn, epsilon=0.1, C=1000.0)
    d = RF.with_features(frame(spark, x, y), "x", drawn, "z")
    share = L.off_margin(d, "z", "label", fit, 0.1).count() / 500
    flat = frame(spark, x, y).withColumn("v", array_to_vector("x"))
    line = L.linear_svr(flat, "v", "label", epsilon=0.1, C=1000.0)
    assert share < 0.1 < L.off_margin(flat, "v", "label", line, 0.1).count() / 500
    odd = spark.createDataFrame([(1, None, 1.0), (2, [None, 1.0], 1.0)], "id long, x array<double>, label double")
    assert [r["z"] for r in RF.with_features(odd, "x", drawn, "z").collect()] == [None, None]


def test_stick_breaking_bound_never_falls_and_prunes(spark):
    rng = np.random.default_rng(4)
    centres = np.array([[0, 0], [6, 0], [0, 6], [6, 6], [12, 3]], float)
    x = centres[np.arange(600) % 5] + 0.6 * rng.normal(size=(600, 2))
    m = D.vb_gmm(frame(spark, x), "x", 8, "id", max_iter=60, tol=1e-5, weight_prior=0.01, prior="stick_breaking")
    assert len(m.lower_bounds) > 3
    assert (np.diff(m.lower_bounds) >= -1e-6 * np.abs(m.lower_bounds[:-1])).all()
    assert abs(m.weights.sum() - 1) < 1e-9 and (m.weights > 0.02).sum() == 5
    kept = m.means[m.weights > 0.02]
    assert all(np.linalg.norm(kept - c, axis=1).min() < 0.2 for c in centres)
    with pytest.raises(ValueError):
        D.vb_gmm(frame(spark, x), "x", 8, "id", prior="other")


def test_learning_curve_of_a_tree_and_a_logistic_model(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(900, 3))
    df = frame(spark, x, (x[:, 0] + 0.3 * rng.normal(size=900) > 0).astype(float)).withColumn("features", array_to_vector("x"))
    wrong = lambda p: p.agg(F.avg((F.col("prediction") != F.col("label")).cast("double"))).first()[0]
    seen = []

    def tree(d):
        seen.append({r["id"] for r in d.collect()})
        return H.best_first_tree(d, max_leaf_nodes=8)
    sizes = [20, 100, 500]
    curve = G.learning_curve_of(df, tree, wrong, ["id"], sizes)
    assert [r[0] for r in curve] == sizes and seen[0] < seen[1] < seen[2]
    assert all(t <= v + 0.02 for _, t, v in curve) and curve[-1][2] < 0.25
    line = G.learning_curve_of(df, lambda d: L.logistic(C=1.0, n=d.count(), max_iter=20).fit(d), wrong, ["id"], sizes)
    assert [r[0] for r in line] == sizes and line[-1][2] < 0.2
    with pytest.raises(ValueError):
        G.learning_curve_of(df, tree, wrong, ["id"], [5000])
