"""Bagging, boosting, search scores, mixtures and the streaming sink."""
import numpy as np
import pytest
from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from quarry.operators import density as D
from quarry.operators import selection as G
from quarry.operators import trees as TR
from quarry.plans.registry import all_queries
from quarry.session import scratch_path
from quarry.streaming import incremental as INC

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def points(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(600, 3))
    y = (x[:, 0] > 0).astype(int) + (x[:, 1] > 0.5)
    rows = [(i, [float(v) for v in r], float(t)) for i, (r, t) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, "id long, x array<double>, label double") \
        .withColumn("features", array_to_vector("x")).cache()


@pytest.mark.parametrize("max_samples", [1.0, 100])
def test_bagging(spark, points, max_samples):
    ens = TR.bagging(points, "id", 8, max_samples, maxDepth=4)
    oob = ens["oob"].collect()
    assert all(sum(r["oob_proba"]) == pytest.approx(1, abs=1e-9) for r in oob)
    assert 0.75 < ens["oob_score"] <= 1 and ens["oob_score"] == pytest.approx(
        np.mean([r["oob_pred"] == r["label"] for r in oob]))
    p = TR.bagging_predict(ens, points)
    assert p.count() == 600 and p.where("prediction = label").count() > 480
    assert {r[0] for r in p.select(F.round(F.aggregate("proba", F.lit(0.0), lambda a, x: a + x), 9)).collect()} == {1.0}
    if max_samples == 100:                # few rows a replica: most rows are out of bag
        assert len(oob) == 600


def test_bagging_makes_no_copies(spark, points):
    plan = TR.bagging(points, "id", 3, maxDepth=2)["oob"]._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan and "Union" not in plan


@pytest.mark.parametrize("algorithm", ["SAMME", "SAMME.R"])
def test_adaboost(spark, points, algorithm):
    ens = TR.adaboost(points, 8, 0.5, max_depth=1, algorithm=algorithm)
    one = ens["models"][0].transform(points).where("prediction = label").count()
    got = TR.adaboost_predict(ens, points)
    assert got.where("prediction = label").count() >= (one if algorithm == "SAMME" else max(one, 450))
    assert got.columns == [*points.columns, "ada_score", "prediction"]


def test_reweighting_by_hand(spark, points):
    def fit(d):
        return DecisionTreeClassifier(weightCol="w", maxDepth=1, seed=1).fit(d)
    models = TR.reweighted_sequence(points, fit, 3, learning_rate=1.0)
    splits = {m.toDebugString.split("\n", 1)[1] for m in models}
    assert len(models) == 3 and len(splits) > 1         # later stumps look elsewhere


def test_search_scores(spark, points):
    from pyspark.ml.evaluation import MulticlassClassificationEvaluator
    from quarry.operators.split import kfold
    e = kfold(points, 3, ["id"]).cache()
    tree = DecisionTreeClassifier(seed=1)
    maps = G.grid(tree, [{"maxDepth": [1, 6]}])
    ev = MulticlassClassificationEvaluator(metricName="accuracy")
    model, res = G.grid_search(tree, maps, ev, e, collect_sub_models=True)
    per = G.fold_scores(model, e, ev).collect()
    assert len(per) == 6
    for r in res.collect():
        own = [p for p in per if p["map_id"] == r["map_id"]]
        assert r["mean_score"] == pytest.approx(np.mean([p["test_score"] for p in own]), abs=1e-9)
    assert max(p["train_score"] for p in per if p["map_id"] == 1) > max(p["train_score"] for p in per if p["map_id"] == 0)
    scores = []
    for parts in (1, 5):
        best, table = G.held_out_search(tree, maps, ev, points.repartition(parts), ["id"])
        scores.append([r["mean_score"] for r in table.orderBy("map_id").collect()])
        assert best.getMaxDepth() == 6
    assert scores[0] == scores[1]


def test_mixture_does_not_depend_on_partitions(spark):
    rng = np.random.default_rng(2)
    x = np.concatenate([rng.normal(size=(150, 2)) + c for c in ([0, 0], [6, 0], [0, 6])]) + 1e6
    df = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(x)], "id long, v array<double>")
    out = [D.bic_table(df.repartition(p), "v", [2, 3], ["full"], id_col="id", n_init=2) for p in (1, 4, 17)]
    for other in out[1:]:
        for a, b in zip(out[0], other):
            assert a[2] == pytest.approx(b[2], rel=1e-6)
    assert min(out[0], key=lambda r: r[3])[0] == 3
    mix = D.em(df, "v", 3, id_col="id", n_init=2)
    assert np.allclose(sorted(mix.means.sum(1) - 2e6), [0, 6, 6], atol=0.5)
    with pytest.raises(ValueError):
        D.em(df, "v", 3)


def test_streaming_mean_keeps_the_latest(spark, tmp_path):
    src = str(tmp_path / "in")
    for k, rows in enumerate([[(1, 2.0), (2, 5.0)], [(1, 4.0), (3, None)], [(2, 1.0)]]):
        spark.createDataFrame(rows, "k int, v double").coalesce(1).write.mode("append").parquet(src)
    stream = INC.file_stream(spark, src, spark.read.parquet(src).schema)
    sink, ckpt = scratch_path(spark, "t-sink"), scratch_path(spark, "t-ckpt")
    want = {1: (2, 3.0), 2: (2, 3.0), 3: (1, None)}
    for _ in range(2):                     # a restart with nothing new changes nothing
        got = INC.running_mean_stream(stream, "k", "v", sink, ckpt).collect()
        assert {r["k"]: (r["n"], r["mean"]) for r in got} == want


def test_ensemble_queries(spark):
    rows = all_queries()["l23_adaboost"](spark, SF).collect()
    assert np.mean([r["prediction"] == r["label"] for r in rows]) > 0.7
    rows = all_queries()["l20_bagging_oob"](spark, SF).collect()
    assert 0.3 < rows[0]["oob_score"] <= 1
