import math

import numpy as np
from pyspark.sql import functions as F

from quarry.operators import profile as P


def test_exact_quantiles_match_numpy(spark):
    rng = np.random.default_rng(0)
    x = np.round(rng.normal(size=997), 2)          # with ties
    df = spark.createDataFrame([(float(v), int(i % 3)) for i, v in enumerate(x)], "x double, g int")
    probs = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]
    q = P.exact_quantiles(df.repartition(7), "x", probs).first()
    for p in probs:
        assert math.isclose(q[f"p{int(round(p * 100))}"], np.quantile(x, p), abs_tol=1e-12)
    per = {r["g"]: r for r in P.exact_quantiles(df, "x", [0.5], ["g"]).collect()}
    for g in range(3):
        assert math.isclose(per[g]["p50"], np.median(x[np.arange(len(x)) % 3 == g]), abs_tol=1e-12)


def test_quantiles_nulls_and_single_row(spark):
    df = spark.createDataFrame([(1.0,), (None,), (3.0,)], "x double")
    assert P.exact_quantiles(df, "x", [0.5]).first()["p50"] == 2.0
    one = spark.createDataFrame([(5.0,)], "x double")
    assert P.exact_quantiles(one, "x", [0.25]).first()["p25"] == 5.0


def test_t_ppf():
    assert abs(P.t_ppf(0.975, 10) - 2.228138851986) < 1e-6
    assert abs(P.t_ppf(0.975, 1000) - 1.962339) < 1e-5


def test_info_counts_nulls(spark):
    df = spark.createDataFrame([(1, None), (None, "a"), (3, "b")], "a int, b string")
    r = {x["column"]: x for x in P.info(df).collect()}
    assert r["a"]["non_null"] == 2 and r["b"]["null_count"] == 1


def test_histogram_last_bin_closed(spark):
    df = spark.createDataFrame([(float(v),) for v in [0, 1, 2, 3, 4, 10]], "x double")
    h = {r["bin"]: r["count"] for r in P.histogram(df, "x", 5).collect()}
    assert h[4] == 1 and sum(h.values()) == 6


def test_corr_constant_column_is_null(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 2.0), (3.0, 2.0)], "a double, b double")
    r = {(x["col_a"], x["col_b"]): x["corr"] for x in P.corr_matrix(df, ["a", "b"]).collect()}
    assert r[("a", "b")] is None or math.isnan(r[("a", "b")])


def test_quantiles_with_a_hot_value(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=3000)
    x[::3] = 0.25                                   # a third of the rows share one value
    df = spark.createDataFrame([(float(v),) for v in x], "x double")
    probs = [0.05, 0.3, 0.33, 0.5, 0.6, 0.95]
    q = P.exact_quantiles(df.repartition(5), "x", probs, names=[f"q{i}" for i in range(6)]).first()
    for i, p in enumerate(probs):
        assert math.isclose(q[f"q{i}"], np.quantile(x, p), abs_tol=1e-12)


def test_sort_positions_with_hot_ties(spark):
    from quarry.operators.window import sort_positions
    rng = np.random.default_rng(8)
    v = np.round(rng.normal(size=2000), 3)
    v[::3] = 1.5
    df = spark.createDataFrame([(int(i), float(x)) for i, x in enumerate(v)], "id long, v double")
    got = {r["id"]: r["pos"] for r in sort_positions(df.repartition(6), "v", ["id"]).collect()}
    order = np.lexsort((np.arange(2000), v))
    assert all(got[int(i)] == k + 1 for k, i in enumerate(order))
    got_d = {r["id"]: r["pos"] for r in sort_positions(df, "v", ["id"], descending=True).collect()}
    order_d = np.lexsort((np.arange(2000), -v))
    assert all(got_d[int(i)] == k + 1 for k, i in enumerate(order_d))


def test_approx_quantiles_close_to_exact(spark):
    rng = np.random.default_rng(11)
    x = rng.normal(size=5000)
    df = spark.createDataFrame([(float(v),) for v in x], "x double")
    q = P.approx_quantiles(df, "x", [0.1, 0.5, 0.9]).first()
    for p, n in ((0.1, "p10"), (0.5, "p50"), (0.9, "p90")):
        # rank error at most n / accuracy = 0.5 rows here
        assert abs(np.searchsorted(np.sort(x), q[n]) / 5000 - p) < 0.002
