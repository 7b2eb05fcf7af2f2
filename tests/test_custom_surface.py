"""Custom functions, clones and aggregates."""
import numpy as np
from pyspark.ml import Pipeline

from quarry.operators import custom as C
from quarry.operators.aggregate import gram
from quarry.operators.columns import RatioFeatures


def test_row_and_array_functions_keep_nulls(spark):
    df = spark.createDataFrame([(1, "a#b", [1.0, 5.0]), (2, None, None), (3, "c", [2.0]), (4, "d", [])],
                               "id long, s string, v array<double>")
    head = C.apply_rows(lambda s: s.split("#")[0], "string")
    total = C.apply_arrays(lambda x: x.sum(axis=1), "double")
    assert [tuple(r) for r in df.select("id", head("s"), total("v")).orderBy("id").collect()] == [
        (1, "a", 6.0), (2, None, None), (3, "c", 2.0), (4, "d", 0.0)]


def test_clone_leaves_the_original_alone(spark):
    df = spark.createDataFrame([(6.0, 3.0, 2.0)], "a double, b double, c double")
    inner = Pipeline(stages=[RatioFeatures(ratios=["r,a,b"], addOptional=False)])
    outer = Pipeline(stages=[inner, RatioFeatures(ratios=["q,r,c"], addOptional=False)])
    other = C.clone(outer, {"0__0__ratios": ["r,a,c"], "1__ratios": ["q,r,b"]})
    assert outer.fit(df).transform(df).first()["q"] == 1.0
    assert other.fit(df).transform(df).select("r", "q").first() == (3.0, 1.0)
    assert outer.fit(df).transform(df).first()["r"] == 2.0


def test_parts_of_an_aggregate_add_up(spark):
    rng = np.random.default_rng(1)
    x, y = rng.normal(size=(200, 3)) + 1e6, rng.integers(0, 3, 200)
    df = spark.createDataFrame([([float(v) for v in a], int(b)) for a, b in zip(x, y)], "x array<double>, y long")
    parts = C.merge_aggregate([gram(df.where(df.y < 1), "x", group="y"), gram(df.where(df.y > 0), "x", group="y"),
                               gram(df.where("y = 1"), "x", group="y"), {}])
    assert sorted(parts) == [0, 1, 2] and parts[1].n == 2 * (y == 1).sum()
    assert np.allclose(parts[0].cov(), np.cov(x[y == 0].T), rtol=1e-6)
    assert np.allclose(parts[1].cov(ddof=0), np.cov(x[y == 1].T, ddof=0), rtol=1e-6)
