"""Statistics passes with NULLs, tie rules, caps that are gone, trainers that learn."""
import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.operators import joins as J
from quarry.operators import linear as L
from quarry.operators import split as T
from quarry.operators.aggregate import gram
from quarry.operators.cluster import connected_components
from quarry.plans.registry import all_queries
from quarry.streaming.incremental import StateStore

SF = "/root/testdata/sf0.001"


def rows_with_nulls(spark, n=1000, offset=0.0):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(n, 3)) + offset
    y = x @ [1.0, -2.0, 0.5] + 3 + rng.normal(size=n) * 0.1
    data = [(i, [float(v) for v in r], float(t)) for i, (r, t) in enumerate(zip(x, y))]
    data[17] = (17, data[17][1], None)
    data[18] = (18, [1.0, None, 2.0], 1.0)
    data[19] = (19, None, 1.0)
    data[20] = (20, data[20][1], float("nan"))
    keep = np.setdiff1d(np.arange(n), [17, 18, 19, 20])
    return spark.createDataFrame(data, "id long, x array<double>, y double"), x[keep], y[keep]


@pytest.mark.parametrize("parts", [1, 4, 17])
def test_gram_drops_incomplete_rows(spark, parts):
    df, x, y = rows_with_nulls(spark)
    m = gram(df.repartition(parts), "x", "y")
    assert m.n == len(x)
    assert np.allclose(m.sx, x.sum(0)) and np.allclose(m.xtx, x.T @ x) and np.allclose(m.xty, x.T @ y)
    assert m.sy == pytest.approx(y.sum()) and m.syy == pytest.approx((y * y).sum())
    assert np.allclose(m.cov(), np.cov(x.T))


def test_covariance_far_from_zero(spark):
    df, x, y = rows_with_nulls(spark, offset=1e8)
    whole = gram(df.repartition(5), "x", "y")
    assert np.allclose(whole.cov(), np.cov(x.T), rtol=1e-6)
    parts = gram(df.withColumn("g", F.pmod("id", F.lit(3))), "x", "y", group="g")
    merged = parts[0].merge(parts[1]).merge(parts[2])
    assert np.allclose(merged.cov(), np.cov(x.T), rtol=1e-6)


def test_gram_without_rows_and_text_groups(spark):
    df, _, _ = rows_with_nulls(spark)
    assert gram(df.limit(0), "x", "y") is None and gram(df.limit(0).withColumn("g", F.lit(1)), "x", group="g") == {}
    with pytest.raises(ValueError):
        gram(df.withColumn("g", F.lit("a")), "x", "y", group="g")


def test_statistics_pass_raises_on_nan(spark):
    df = spark.createDataFrame([([1.0], None)], "x array<double>, y double")
    with pytest.raises(Exception, match="NULL or NaN"):
        L.sum_pass(df, lambda X, pdf: np.array([pdf["y"].to_numpy(dtype=float).sum()]), 1)


def test_long_chain_is_one_component(spark):
    edges = spark.range(999).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    got = connected_components(edges, spark.range(1003))
    assert {r["comp"] for r in got.where("id < 1000").collect()} == {0}
    assert sorted(r["comp"] for r in got.where("id >= 1000").collect()) == [1000, 1001, 1002]


def test_components_match_union_find(spark):
    rng = np.random.default_rng(3)
    pairs = [(int(a), int(b)) for a, b in rng.integers(0, 400, (300, 2))] + [(7, i) for i in range(100, 180)]
    up = list(range(400))

    def find(i):
        while up[i] != i:
            i = up[i]
        return i
    for a, b in pairs:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    got = connected_components(spark.createDataFrame(pairs, "a long, b long"), spark.range(400))
    assert {r["id"]: r["comp"] for r in got.collect()} == {i: find(i) for i in range(400)}


def test_knn_ties_go_by_id(spark):
    rng = np.random.default_rng(5)
    same = rng.normal(size=8).tolist()
    data = [(int(i), same) for i in rng.permutation(200)] + [(i, rng.normal(size=8).tolist()) for i in range(200, 300)]
    df = spark.createDataFrame(data, "id long, v array<double>")
    got = J.knn_join(df.where("id = 0"), df, 3, "id", "v", exclude_self=True, block_rows=64)
    assert [r["nid"] for r in got.orderBy("rank").collect()] == [1, 2, 3]
    few = J.knn_join(df.where("id = 0"), df.where("id < 2"), 5, "id", "v", exclude_self=True)
    assert [r["nid"] for r in few.collect()] == [1]


@pytest.mark.parametrize("rate", [0.3, 1.0, 100.0, 900.0])
def test_poisson_weights_keep_their_mean(spark, rate):
    thr = T.poisson_thresholds(rate)
    assert thr[-1] == pytest.approx(1.0, abs=1e-9) and all(a <= b for a, b in zip(thr, thr[1:]))
    w = T.bootstrap(spark.range(3000), 1, ["id"], max_samples=rate).agg(F.avg("weight"), F.var_samp("weight")).first()
    assert w[0] == pytest.approx(rate, rel=0.06) and w[1] == pytest.approx(rate, rel=0.15)


def test_stratified_sizes_keep_null_strata(spark):
    df = spark.range(100).withColumn("s", F.when(F.col("id") % 5 == 0, None).otherwise((F.col("id") % 3).cast("string")))
    for parts in (1, 7):
        out = T.split_stratified_sizes(df.repartition(parts), ["s"], 20, ["id"]).collect()
        assert len(out) == 100 and sum(r["in_test"] for r in out) == 20
        assert sum(r["in_test"] for r in out if r["s"] is None) == 4


def test_shuffle_split_refills_empty_sets(spark):
    got = T.shuffle_split(spark.range(500), n_sets=40, size=3, ids=["id"]).groupBy("set_id").count().collect()
    assert len(got) == 40 and {r["count"] for r in got} == {3}


def test_unreadable_state_is_an_error(spark, tmp_path):
    store = StateStore(spark, str(tmp_path / "state"))
    assert store.latest() is None
    store.save(3, {"a": 1})
    assert store.latest() == {"a": 1} and store.latest(before=3) is None
    for f in (tmp_path / "state" / "batch_id=3").glob("part-*"):
        f.write_bytes(b"not a parquet file")
    spark.catalog.clearCache()
    with pytest.raises(Exception):
        store.latest()


# ------------------------------------------------------------------ trainers
def test_early_stopping_stops(spark):
    rows = all_queries()["l6_early_stopping"](spark, SF).collect()
    best = next(r for r in rows if r["best"])
    assert best["epoch"] < max(r["epoch"] for r in rows) and best["val_mse"] < 0.5


def test_softmax_learns_and_breaks(spark):
    rows = all_queries()["l8b_softmax_bgd"](spark, SF).orderBy("iteration").collect()
    loss = [r["val_loss"] for r in rows]
    assert len(loss) < 300 and min(loss) < 0.6 and loss[-1] > min(loss)


def test_sgd_classifiers_beat_the_constant(spark):
    rows = all_queries()["l12_sgd_classifier"](spark, SF).collect()
    assert {r["loss"] for r in rows} == {"hinge", "log"} and all(r["train_accuracy"] > 0.85 for r in rows)


def test_svr_leaves_its_margin_share(spark):
    off = all_queries()["l14_linear_svr"](spark, SF).count()
    n = spark.read.parquet(f"{SF}/lineitem.parquet").count()
    assert 0.3 * n < off < 0.6 * n


# --------------------------------------------------------- bounded value buckets
@pytest.mark.parametrize("n", [10**3, 10**7, 10**9, 10**12])
def test_bucket_plan_bounds_rows(n):
    from quarry.operators.window import MAX_BUCKET_ROWS, bucket_plan
    buckets, err = bucket_plan(n)
    assert n * (1 / buckets + 2 * err) <= MAX_BUCKET_ROWS * 1.0001


@pytest.mark.parametrize("n", [2_000, 20_000])
def test_no_bucket_outgrows_its_bound(spark, n):
    from quarry.operators.window import value_bucket
    df = spark.range(n).withColumn("x", F.when(F.col("id") % 3 == 0, 7.0).otherwise(F.pow(F.col("id") % 997, 2.0)))
    d = value_bucket(df, "x", n_buckets=8, max_rows=300)
    worst = d.groupBy("_vb").agg(F.count("*").alias("n"), F.countDistinct("x").alias("v")).where("v > 1")
    assert (worst.agg(F.max("n")).first()[0] or 0) <= 300
