"""Statistics of values far from zero, and keys without an SQL twin."""
import numpy as np

from quarry.operators import reduce as R
from quarry.operators import text as TX
from quarry.session import scratch_path
from quarry.streaming import incremental as D

SF = "/root/testdata/sf0.001"


def frame(spark, x, y):
    return spark.createDataFrame([([float(v) for v in a], int(b)) for a, b in zip(x, y)], "x array<double>, y int").repartition(3)


def test_lda_far_from_zero(spark):
    rng = np.random.default_rng(1)
    y = rng.integers(0, 3, 600)
    x = rng.normal(size=(600, 4)) + 3 * np.eye(4)[:3][y]
    near, far = R.lda(frame(spark, x, y), "x", "y"), R.lda(frame(spark, x + 1e8, y), "x", "y")
    assert np.allclose(near["eigenvalues"], far["eigenvalues"], rtol=1e-6)
    assert np.allclose(near["axes"], far["axes"], atol=1e-6)
    centre = x.mean(0)
    sw = sum(np.cov(x[y == c].T, ddof=0) * (y == c).sum() for c in range(3))
    sb = sum((y == c).sum() * np.outer(x[y == c].mean(0) - centre, x[y == c].mean(0) - centre) for c in range(3))
    want = np.sort(np.linalg.eigvals(np.linalg.solve(sw, sb)).real)[::-1][:2]
    assert np.allclose(near["eigenvalues"], want, rtol=1e-5)


def test_streamed_pca_far_from_zero(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(400, 3)) * [3, 2, 1]
    path = scratch_path(spark, "digits")
    for part in np.split(x + 1e8, 4):
        frame(spark, part, np.zeros(100)).coalesce(1).write.mode("append").parquet(path)
    stream = spark.readStream.schema("x array<double>, y int").option("maxFilesPerTrigger", 1).parquet(path)
    store = D.StateStore(spark, scratch_path(spark, "digits-state"))
    D.incremental_pca_stream(stream, "x", store, scratch_path(spark, "digits-ckpt"))
    got = D.pca_from_state(store.latest(), 3)
    want = np.sort(np.linalg.eigvalsh(np.cov(x.T)))[::-1]
    assert np.allclose(got.explained_variance, want, rtol=1e-6)


def test_vectors_equal_their_long_form(spark):
    rows = [(1, "a", 3), (1, "b", 1), (1, "zz", 2), (1, "yy", 5), (2, "b", 70), (3, "zz", 1)]
    counts = spark.createDataFrame(rows, "id long, word string, count long")
    vocab = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], "word string, idx int")
    got = {r["id"]: r["features"] for r in TX.counts_to_vector(counts, vocab, "id", 3).collect()}
    assert {i: (v.size, v.indices.tolist(), v.values.tolist()) for i, v in got.items()} == {
        1: (4, [0, 1, 2], [7.0, 3.0, 1.0]), 2: (4, [2], [70.0]), 3: (4, [0], [1.0])}


def run(spark, name):
    import __spark_entry__ as E
    return E.queries()[name](spark, SF).collect()


def test_named_keys(spark):
    """Keys that only ran until now."""
    assert all(r["before"] == r["after"] for r in run(spark, "s5_model_roundtrip"))
    assert max(r["accuracy"] for r in run(spark, "r6_kernel_parameter_search")) > 0.9
    by = {}
    for r in run(spark, "l29_lda"):
        by.setdefault(r["group"], []).append(r["ld"])
    mean = {g: np.mean(v, axis=0) for g, v in by.items()}
    spread = np.mean([np.std(v, axis=0).mean() for v in by.values()])
    assert min(np.linalg.norm(mean[a] - mean[b]) for a in mean for b in mean if a < b) > 2 * spread
    assert np.mean([r["train_auc"] for r in run(spark, "u2_custom_predictor")]) > 0.9
