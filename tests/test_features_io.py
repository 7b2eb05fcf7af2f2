import math

from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from quarry.operators import features as X
from quarry.session import scratch_path
from quarry.sources.tables import lp_view
from tests.conftest import SF_SMALL


def test_column_transformer_roundtrip_and_names(spark):
    lp = lp_view(spark, SF_SMALL, nulls=True)
    pipe = X.column_transformer(["l_quantity", "l_tax"], ["l_returnflag"],
                                ratios=["tax_per_qty,l_tax__imp,l_quantity__imp"])
    model = pipe.fit(lp)
    path = scratch_path(spark, "ct")
    model.write().overwrite().save(path)
    back = PipelineModel.load(path)
    a = model.transform(lp).select("features").collect()
    b = back.transform(lp).select("features").collect()
    assert a == b
    names = X.feature_names(model.transform(lp))
    assert names[:3] == ["l_quantity__imp__std", "l_tax__imp__std", "tax_per_qty__std"]
    assert len(names) == 3 + lp.select("l_returnflag").distinct().count()


def test_imputer_strategies(spark):
    df = spark.createDataFrame([(1.0, "a"), (None, "b"), (3.0, "b"), (10.0, None)],
                               "x double, s string")
    med = X.Imputer(inputCols=["x"], strategy="median").fit(df).statistics()["x"]
    mean = X.Imputer(inputCols=["x"], strategy="mean").fit(df).statistics()["x"]
    mf = X.Imputer(inputCols=["s"], strategy="most_frequent").fit(df).statistics()["s"]
    assert med == 3.0 and math.isclose(mean, 14 / 3) and mf == "b"
    approx = X.Imputer(inputCols=["x"], strategy="median_approx").fit(df).statistics()["x"]
    assert approx == 3.0


def test_population_scaler_and_inverse(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (4.0,)], "x double")
    m = X.StandardScaler(inputCols=["x"], outputCols=["z"]).fit(df)
    z = [r[0] for r in m.transform(df).select("z").collect()]
    assert math.isclose(sum(v * v for v in z) / 4, 1.0)
    back = [r[0] for r in m.inverse(m.transform(df), ["z"], ["xb"]).select("xb").collect()]
    assert all(math.isclose(a, b) for a, b in zip(back, [1.0, 2.0, 3.0, 4.0]))


def test_min_max_constant_column_is_zero(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "a double, c double")
    r = X.min_max_scale(df, ["a", "c"]).select("a_mm", "c_mm").collect()
    assert [tuple(x) for x in r] == [(0.0, 0.0), (1.0, 0.0)]


def test_polynomial_order_matches_reference_convention(spark):
    names = [n for _, n in X.polynomial_terms(["x", "y"], 2, bias=True)]
    assert names == ["1", "x", "y", "x^2", "x y", "y^2"]
