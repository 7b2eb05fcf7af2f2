"""Registered supervised-model and model-selection queries (L, G)."""

from __future__ import annotations

import numpy as np
from pyspark.ml import Pipeline
from pyspark.ml.classification import LinearSVC, LogisticRegression
from pyspark.ml.evaluation import (MulticlassClassificationEvaluator, RegressionEvaluator)
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from quarry.functions.arrays import argmax
from quarry.functions.hashing import rnd
from quarry.operators import features as X
from quarry.operators import histtrees as H
from quarry.operators import linear as L
from quarry.operators import neighbors as N
from quarry.operators import randomfeatures as RF
from quarry.operators import randomtrees as R
from quarry.operators import selection as G
from quarry.operators import split as T
from quarry.operators import trees as TR
from quarry.operators.aggregate import gram
from quarry.plans import sqlfrag as S
from quarry.plans.q_columns import DL_SQL_CTE
from quarry.plans.registry import query
from quarry.sources.tables import dl_view, emb_vectors, emb_view, lp_view

LP_FEATS = ["l_quantity", "l_discount", "p_retailprice", "is_a"]


def _lp(spark, sf):
    lp = lp_view(spark, sf).withColumn("is_a", (F.col("l_returnflag") == "A").cast("double"))
    return VectorAssembler(inputCols=LP_FEATS, outputCol="features").transform(lp)


def _emb(spark, sf, planted=False):
    return emb_vectors(emb_view(spark, sf, planted=planted))


@query("l1b_simple_regression", f"""WITH {S.LP_CTE}
SELECT {S.rnd('regr_slope(y_rule, l_quantity)', 9)} AS slope,
       {S.rnd('regr_intercept(y_rule, l_quantity)', 9)} AS intercept,
       {S.rnd('regr_r2(y_rule, l_quantity)', 9)} AS r2 FROM lp""")
def l1b_simple_regression(spark, sf):
    s = L.simple_regression(lp_view(spark, sf), "l_quantity", "y_rule")
    return s.select(*[rnd(c, 9).alias(c) for c in ("slope", "intercept", "r2")])


def _elimination_sql() -> str:
    """The normal equations of four features by elimination on their covariances."""
    xs = {"e": "l_quantity", "f": "l_discount", "g": "p_retailprice", "h": "CASE WHEN l_returnflag = 'A' THEN 1.0 ELSE 0.0 END"}
    names = list(xs)
    cols = [(i, j) for k, i in enumerate(names) for j in names[k:] + ["y"]]
    out = [S.LP_CTE, "t AS (SELECT y_rule AS y, " + ", ".join(f"{e} AS {n}" for n, e in xs.items()) + " FROM lp)",
           "m0 AS (SELECT " + ", ".join(f"covar_pop({i}, {j}) AS {i}{j}" for i, j in cols) + ", "
           + ", ".join(f"avg({n}) AS mean_{n}" for n in [*names, "y"]) + " FROM t)"]
    for step, p in enumerate(names[:-1]):
        out.append(f"m{step + 1} AS (SELECT * REPLACE (" + ", ".join(
            f"{i}{j} - {p}{i} * {p}{j} / {p}{p} AS {i}{j}" for i, j in cols if i > p) + f") FROM m{step})")
    last = "m3"
    for k in range(len(names) - 1, -1, -1):
        n, known = names[k], names[k + 1:]
        out.append(f"s{k} AS (SELECT *, (" + " - ".join([f"{n}y", *(f"{n}{m} * beta_{m}" for m in known)])
                   + f") / {n}{n} AS beta_{n} FROM {last})")
        last = f"s{k}"
    terms = {"intercept": "mean_y - " + " - ".join(f"beta_{n} * mean_{n}" for n in names),
             **{t: f"beta_{n}" for t, n in zip(LP_FEATS, names)}}
    return "WITH " + ",\n".join(out) + "\n" + " UNION ALL ".join(
        f"SELECT '{t}' AS term, " + ", ".join(f"{S.rnd(e, 4)} AS {m}" for m in ("solve", "lstsq", "pinv")) + " FROM s0"
        for t, e in terms.items())


@query("l1c_normal_equation", _elimination_sql())
def l1c_normal_equation(spark, sf):
    m = gram(_lp(spark, sf), "features", "y_rule")
    fits = {k: L.solve_normal(m, method=k) for k in ("solve", "lstsq", "pinv")}
    names = ["intercept"] + LP_FEATS
    rows = [(n, *[round(float(np.concatenate([[f.intercept], f.coef])[i]), 4) for f in fits.values()])
            for i, n in enumerate(names)]
    return spark.createDataFrame(rows, "term string, solve double, lstsq double, pinv double")


@query("l2_batch_gd")
def l2_batch_gd(spark, sf):
    d = _lp(spark, sf)
    scaler = X.StandardScaler(inputCols=["l_quantity", "l_discount", "p_retailprice"],
                              outputCols=["q", "d", "p"]).fit(d)
    s = VectorAssembler(inputCols=["q", "d", "p", "is_a"], outputCol="xs").transform(
        scaler.transform(d))
    m = gram(s, "xs", "y_rule")
    bgd = L.batch_gd(m, eta=0.1, n_iter=2000)
    ne = L.solve_normal(m)
    names = ["intercept", "q", "d", "p", "is_a"]
    a = np.concatenate([[bgd.intercept], bgd.coef])
    b = np.concatenate([[ne.intercept], ne.coef])
    return spark.createDataFrame([(n, float(x), float(y)) for n, x, y in zip(names, a, b)],
                                 "term string, bgd double, normal double")


@query("l3_minibatch_sgd")
def l3_minibatch_sgd(spark, sf):
    d = _lp(spark, sf)
    sc = X.StandardScaler(inputCols=["l_quantity", "l_discount", "p_retailprice"],
                          outputCols=["q", "d", "p"]).fit(d)
    s = VectorAssembler(inputCols=["q", "d", "p", "is_a"], outputCol="xs").transform(sc.transform(d))
    batches = L.batch_moments(s, "xs", "y_rule", 20, ["l_orderkey", "l_partkey", "l_suppkey",
                                                      "l_linenumber", "l_extendedprice"])
    fit = L.minibatch_gd(batches, n_epochs=50, t0=5, t1=50)
    names = ["intercept", "q", "d", "p", "is_a"]
    th = np.concatenate([[fit.intercept], fit.coef])
    return spark.createDataFrame([(n, float(v)) for n, v in zip(names, th)], "term string, value double")


@query("l4_regularized")
def l4_regularized(spark, sf):
    d = _lp(spark, sf).cache()
    n, sd_pop, sd_samp = d.agg(F.count("y_rule"), F.stddev_pop("y_rule"),
                               F.stddev_samp("y_rule")).first()
    rows = []
    for kind, sd in (("ridge", sd_pop), ("lasso", sd_pop), ("elastic", sd_pop)):
        m = L.regularized(kind, 1.0 if kind == "ridge" else 0.1, n, sd, 0.5,
                          label="y_rule").fit(d)
        rows += [(kind, "intercept", float(m.intercept))] + \
            [(kind, f, float(c)) for f, c in zip(LP_FEATS, m.coefficients.toArray())]
    d.unpersist()
    return spark.createDataFrame(rows, "model string, term string, value double")


@query("l5_polynomial_regression", f"""WITH {S.LP_CTE},
t AS (SELECT l_quantity / 50.0 AS e, power(l_quantity / 50.0, 2) AS f, y_rule + 2.0 * power(l_quantity / 50.0, 2) AS y FROM lp),
m AS (SELECT covar_pop(e, e) AS ee, covar_pop(e, f) AS ef, covar_pop(f, f) AS ff, covar_pop(e, y) AS ey, covar_pop(f, y) AS fy,
             avg(e) AS mean_e, avg(f) AS mean_f, avg(y) AS mean_y FROM t),
b AS (SELECT *, (fy - ef * ey / ee) / (ff - ef * ef / ee) AS beta_f FROM m),
c AS (SELECT *, (ey - ef * beta_f) / ee AS beta_e FROM b)
SELECT 'intercept' AS term, {S.rnd('mean_y - beta_e * mean_e - beta_f * mean_f', 5)} AS value FROM c
UNION ALL SELECT 'x', {S.rnd('beta_e', 5)} FROM c UNION ALL SELECT 'x^2', {S.rnd('beta_f', 5)} FROM c""")
def l5_polynomial_regression(spark, sf):
    lp = lp_view(spark, sf).withColumn("x", F.col("l_quantity") / 50.0).withColumn(
        "y2", F.col("y_rule") + 2.0 * F.pow(F.col("l_quantity") / 50.0, 2))
    p = X.polynomial_features(lp, ["x"], 2, bias=False)
    v = VectorAssembler(inputCols=["x", "`x^2`"], outputCol="pf").transform(p)
    fit = L.fit_linear(v, "pf", "y2")
    return spark.createDataFrame([("intercept", round(float(fit.intercept), 5)), ("x", round(float(fit.coef[0]), 5)),
                                  ("x^2", round(float(fit.coef[1]), 5))], "term string, value double")


@query("l6_early_stopping")
def l6_early_stopping(spark, sf):
    d = _lp(spark, sf)
    ids = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice"]
    d = T.split_three_way(d, [0.8, 0.2], ids, out="part")
    tr = L.batch_moments(d.filter("part = 0"), "features", "y_rule", 4, ids)
    val = gram(d.filter("part = 1"), "features", "y_rule")
    best, ep, errs = L.early_stopping(tr, val, n_epochs=500)
    return spark.createDataFrame([(i, float(e), i == ep) for i, e in enumerate(errs)],
                                 "epoch int, val_mse double, best boolean")


def _dl(spark, sf):
    d = dl_view(spark, sf).withColumn("len_k", F.col("n_words") / 1000.0)
    return VectorAssembler(inputCols=["distinct_share", "len_k"], outputCol="features") \
        .transform(d).withColumn("label", F.col("quality").cast("double"))


@query("l7_logistic")
def l7_logistic(spark, sf):
    d = _dl(spark, sf)
    n = d.count()
    m = L.logistic(C=10.0, n=n).fit(d)
    return m.transform(d).select("doc_id", "prediction",
                                 vector_to_array("probability")[1].alias("p1"))


@query("l8_softmax")
def l8_softmax(spark, sf):
    e = _emb(spark, sf).withColumn("label", F.col("c_rule").cast("double"))
    m = L.logistic(C=10.0, n=e.count(), multinomial=True).fit(e)
    return m.transform(e).select("vec_id", "prediction", "label")


def _scaled(df):
    """Features with mean 0 and deviation 1 (gradient steps assume that)."""
    from pyspark.ml.feature import StandardScaler
    raw = df.withColumnRenamed("features", "raw")
    return StandardScaler(inputCol="raw", outputCol="features", withMean=True).fit(raw).transform(raw).drop("raw")


@query("l8b_softmax_bgd")
def l8b_softmax_bgd(spark, sf):
    e = T.split_three_way(_scaled(_emb(spark, sf)), [0.8, 0.2], ["vec_id"], out="part")
    tr, va = e.filter("part = 0"), e.filter("part = 1")
    r = L.softmax_bgd(tr, "features", "c_rule", 3, eta=0.3, alpha=1e-3, val=va)
    return spark.createDataFrame([(i, float(v)) for i, v in enumerate(r["history"])],
                                 "iteration int, val_loss double")


@query("l9_one_vs_rest")
def l9_one_vs_rest(spark, sf):
    e = _emb(spark, sf).withColumn("label", F.col("c_rule").cast("double"))
    m = L.one_vs_rest(L.linear_svc(C=1.0, n=e.count(), max_iter=50)).fit(e)
    return m.transform(e).select("vec_id", "prediction", "label")


@query("l10_linear_svc")
def l10_linear_svc(spark, sf):
    e = _emb(spark, sf).withColumn("label", (F.col("c_rule") == 0).cast("double"))
    m = L.linear_svc(C=1.0, n=e.count(), max_iter=50).fit(e)
    return m.transform(e).select("vec_id", "prediction",
                                 vector_to_array("rawPrediction")[1].alias("decision"))


@query("l11_svm_bgd")
def l11_svm_bgd(spark, sf):
    e = _scaled(_emb(spark, sf)).withColumn("y", (F.col("c_rule") == 0).cast("int"))
    fit = L.svm_bgd(e, "features", "y", C=1.0, eta0=1.0, eta_d=1000.0, n_epochs=100)
    sv = L.support_vectors(e, "features", "y", fit)
    return sv.select("vec_id", "y")


@query("l12_sgd_classifier")
def l12_sgd_classifier(spark, sf):
    e = _scaled(_emb(spark, sf)).withColumn("y", (F.col("c_rule") == 0).cast("int"))
    rows = []
    for loss in ("hinge", "log"):
        fit = L.sgd_classifier(e, "features", "y", loss=loss, ids=["vec_id"])
        pred = e.withColumn("p", (fit.predict_expr("features") > 0).cast("int"))
        rows.append((loss, pred.agg(F.avg((F.col("p") == F.col("y")).cast("double"))).first()[0]))
    return spark.createDataFrame(rows, "loss string, train_accuracy double")


@query("l13_kernel_svm")
def l13_kernel_svm(spark, sf):
    e = emb_view(spark, sf)
    lm = [r["emb"] for r in T.sample_without_replacement(e, 20, ["vec_id"]).orderBy("vec_id")
          .select("emb").collect()]                     # 20 landmarks (a parameter)
    f = e.withColumn("rbf", X.rbf_landmarks("emb", lm, 2.0))
    f = emb_vectors(f, "rbf", "features").withColumn("label", (F.col("c_rule") == 0).cast("double"))
    m = L.linear_svc(C=10.0, n=f.count(), max_iter=50).fit(f)
    return m.transform(f).select("vec_id", "prediction", "label")


@query("l13b_fourier_svm")
def l13b_fourier_svm(spark, sf):
    e = emb_view(spark, sf).withColumn("label", (F.col("c_rule") == 0).cast("double"))
    m, drawn = RF.kernel_svc(e, "emb", "label", RF.FourierFeatures.draw(64, 256, 1.0), C=10.0, max_iter=50)
    return m.transform(RF.with_features(e, "emb", drawn, "z")).select("vec_id", "prediction", "label")


@query("l13c_sketched_polynomial_svm")
def l13c_sketched_polynomial_svm(spark, sf):
    e = emb_view(spark, sf).withColumn("label", (F.col("c_rule") == 0).cast("double"))
    m, drawn = RF.kernel_svc(e, "emb", "label", RF.TensorSketch.draw(64, 256, 3), C=10.0, max_iter=50)
    return m.transform(RF.with_features(e, "emb", drawn, "z")).select("vec_id", "prediction", "label")


@query("l14_linear_svr")
def l14_linear_svr(spark, sf):
    d = _lp(spark, sf)
    fit = L.linear_svr(d, "features", "y_rule", epsilon=0.5, C=100.0)
    off = L.off_margin(d, "features", "y_rule", fit, 0.5)
    return off.select("l_orderkey", "l_linenumber", "y_rule")


_KNN_SQL = f"""WITH {S.EMB_CTE},
nn AS (SELECT a.vec_id AS qid, b.vec_id AS nid, b.label AS y,
              row_number() OVER (PARTITION BY a.vec_id ORDER BY list_distance(a.emb, b.emb), b.vec_id) AS rk
       FROM emb a, emb b WHERE a.vec_id <> b.vec_id QUALIFY rk <= 5)"""


@query("l15_knn_classifier", f"""{_KNN_SQL}
SELECT qid, y AS prediction FROM (SELECT qid, y, count(*) AS v FROM nn GROUP BY 1, 2)
QUALIFY row_number() OVER (PARTITION BY qid ORDER BY v DESC, y) = 1""")
def l15_knn_classifier(spark, sf):
    e = emb_view(spark, sf)
    p = N.knn_classify(e, e, 5, "vec_id", "emb", "label", exclude_self=True, block_rows=256)
    return p.select("qid", "prediction")


@query("l16_knn_multilabel", f"""{_KNN_SQL},
t AS (SELECT qid, 0 AS pos, CAST(y >= 5 AS INTEGER) AS val FROM nn
      UNION ALL SELECT qid, 1, CAST(y % 2 AS INTEGER) FROM nn)
SELECT qid, pos, val FROM (SELECT qid, pos, val, count(*) AS c FROM t GROUP BY 1, 2, 3)
QUALIFY row_number() OVER (PARTITION BY qid, pos ORDER BY c DESC, val) = 1""")
def l16_knn_multilabel(spark, sf):
    e = emb_view(spark, sf).withColumn("targets", F.array(
        (F.col("label") >= 5).cast("int"), F.pmod("label", F.lit(2)).cast("int")))
    p = N.knn_multilabel(e, e, 5, "vec_id", "emb", "targets", exclude_self=True, block_rows=256)
    return p.select("qid", F.posexplode("prediction").alias("pos", "val"))


def _emb_cls(spark, sf):
    return _emb(spark, sf).withColumn("label", F.col("c_rule").cast("double"))


@query("l17_decision_tree")
def l17_decision_tree(spark, sf):
    e = _emb_cls(spark, sf)
    m = TR.decision_tree(maxDepth=4, min_samples_leaf=2, seed=42).fit(e)
    return m.transform(e).select("vec_id", "prediction", vector_to_array("probability")
                                 .alias("probability"))


@query("l17b_tree_regressor")
def l17b_tree_regressor(spark, sf):
    d = _lp(spark, sf)
    m = TR.decision_tree("regressor", maxDepth=4, labelCol="y_rule", seed=42).fit(d)
    return m.transform(d).select("l_orderkey", "l_linenumber", "prediction")


@query("l17c_best_first_tree")
def l17c_best_first_tree(spark, sf):
    e = _emb_cls(spark, sf)
    m = H.best_first_tree(e, max_leaf_nodes=16, min_samples_split=20)
    return m.transform(e).select("vec_id", "prediction", "probability")


@query("l17d_best_first_regressor")
def l17d_best_first_regressor(spark, sf):
    d = _lp(spark, sf)
    m = H.best_first_tree(d, label="y_rule", criterion="variance", max_leaf_nodes=12, min_samples_leaf=50)
    return m.transform(d).select("l_orderkey", "l_linenumber", "prediction")


@query("l18_random_forest")
def l18_random_forest(spark, sf):
    d = _lp(spark, sf)
    m = TR.random_forest("regressor", max_features=2, numTrees=10, maxDepth=5,
                         labelCol="y_rule", seed=42).fit(d)
    return spark.createDataFrame(TR.named_importances(m, LP_FEATS), "feature string, importance double")


@query("l19_extra_trees")
def l19_extra_trees(spark, sf):
    e = _emb_cls(spark, sf)
    m = R.extra_trees(e, n_estimators=20, max_depth=6)
    return m.transform(e).select("vec_id", "prediction", "probability")


@query("l20_bagging_oob")
def l20_bagging_oob(spark, sf):
    e = _emb_cls(spark, sf)
    r = TR.bagging(e, "vec_id", n_estimators=5, maxDepth=5)
    return r["oob"].select("vec_id", "oob_proba", "oob_pred").withColumn("oob_score", F.lit(r["oob_score"]))


@query("l20b_bagging_small_trees")
def l20b_bagging_small_trees(spark, sf):
    r = TR.bagging_small(_emb_cls(spark, sf), "vec_id", n_estimators=500, max_samples=100, max_depth=6)
    return r["oob"].select("vec_id", "oob_proba", "oob_pred").withColumn("oob_score", F.lit(r["oob_score"]))


_VOTE_MEMBERS = {"m0": (0, 3), "m1": (0, 4), "m2": (1, 3)}


def _member_preds(e):
    out = None
    for name, (a, b) in _VOTE_MEMBERS.items():
        p = e.select("vec_id", F.lit(name).alias("member"),
                     (argmax(F.slice("emb", a + 1, b - a)) + a).alias("prediction"))
        out = p if out is None else out.unionByName(p)
    return out


@query("l21_voting", f"""WITH {S.EMB_CTE},
p AS (""" + "\nUNION ALL\n".join(
    f"SELECT vec_id, '{n}' AS member, (list_position(list_slice(emb, {a + 1}, {b}), list_max(list_slice(emb, {a + 1}, {b}))) - 1 + {a})::INTEGER AS prediction FROM emb"
    for n, (a, b) in _VOTE_MEMBERS.items()) + """)
SELECT vec_id, prediction AS vote FROM (SELECT vec_id, prediction, count(*) AS c FROM p GROUP BY 1, 2)
QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY c DESC, prediction) = 1""")
def l21_voting(spark, sf):
    return TR.vote(_member_preds(emb_view(spark, sf)), "vec_id")


@query("l21b_soft_voting")
def l21b_soft_voting(spark, sf):
    e = _emb_cls(spark, sf)
    models = {"tree": TR.decision_tree(maxDepth=3, seed=1).fit(e),
              "lr": L.logistic(C=10.0, n=e.count(), multinomial=True, max_iter=30).fit(e)}
    preds = TR.members_long(models, e, "vec_id", with_proba=True)
    return TR.vote(preds, "vec_id", proba_col="proba")


@query("l22_small_tree_forest")
def l22_small_tree_forest(spark, sf):
    e = _emb_cls(spark, sf)
    e = T.split_three_way(e, [0.8, 0.2], ["vec_id"], out="part")
    r = TR.small_tree_forest(e.filter("part = 0"), e.filter("part = 1"), "vec_id", n_sets=1000,
                             size=100, max_depth=4)
    return spark.createDataFrame([(r["mean_tree_accuracy"], r["vote_accuracy"])],
                                 "mean_tree_accuracy double, vote_accuracy double")


@query("l23_adaboost")
def l23_adaboost(spark, sf):
    e = _emb(spark, sf).withColumn("label", (F.col("c_rule") == 0).cast("double"))
    ens = TR.adaboost(e, n_estimators=10, learning_rate=0.5, max_depth=1, algorithm="SAMME.R")
    return TR.adaboost_predict(ens, e).select("vec_id", "prediction", "label")


@query("l24_gbt_staged")
def l24_gbt_staged(spark, sf):
    d = G.stored(_lp(spark, sf).select("features", "y_rule"), "l24-rows", plain=True)
    m = TR.gbt_regressor(max_iter=10, step_size=0.3, labelCol="y_rule", seed=42).fit(d)
    errs = TR.staged_errors(m, d)
    return spark.createDataFrame([(i + 1, float(v)) for i, v in enumerate(errs)],
                                 "n_trees int, train_error double")


@query("l24b_residual_boosting")
def l24b_residual_boosting(spark, sf):
    d = _lp(spark, sf)
    models = TR.residual_boosting(d, 3, "features", "y_rule")
    p = TR.residual_predict(models, d)
    return p.select("l_orderkey", "l_linenumber", "y_rule", "prediction_sum")


@query("l25_gbt_early_stopping")
def l25_gbt_early_stopping(spark, sf):
    d = T.split_by_hash(_lp(spark, sf), "l_orderkey", 0.2, "md5", out="is_val")
    d = G.stored(d.select("features", "y_rule", "is_val"), "l25-rows", plain=True)
    m = TR.gbt_regressor(max_iter=30, step_size=0.3, labelCol="y_rule",
                         validation_col="is_val", seed=42).fit(d)
    return spark.createDataFrame([(m.getNumTrees,)], "n_trees int")


@query("l25b_boosted_eval_set")
def l25b_boosted_eval_set(spark, sf):
    d = T.split_by_hash(_lp(spark, sf), "l_orderkey", 0.2, "md5", out="is_val")
    m = H.boosted_trees(d.filter("NOT is_val"), label="y_rule", eval_set=d.filter("is_val"), n_estimators=30,
                        learning_rate=0.5, max_depth=3, max_bins=64, early_stopping_rounds=2)
    return spark.createDataFrame([(i + 1, float(x), i == m.best_iteration) for i, x in enumerate(m.eval_losses)],
                                 "n_trees int, eval_loss double, is_best boolean")


@query("l26_mlp")
def l26_mlp(spark, sf):
    e = _emb_cls(spark, sf)
    m = TR.mlp([64, 16, 3], max_iter=50).fit(e)
    return m.transform(e).select("vec_id", "prediction", "label")


@query("l27_stacking")
def l27_stacking(spark, sf):
    e = _emb_cls(spark, sf)
    e = T.split_three_way(e, [0.6, 0.2, 0.2], ["vec_id"], out="part")
    tr, hold, te = (e.filter(f"part = {i}") for i in range(3))
    members = {"tree": TR.decision_tree(maxDepth=4, seed=1).fit(tr),
               "lr": L.logistic(C=10.0, n=tr.count(), multinomial=True, max_iter=30).fit(tr)}
    blender, va = TR.stacking(members, hold, "vec_id", numTrees=10, maxDepth=3)
    p = TR.stacking_predict(members, blender, va, te, "vec_id")
    return p.select("vec_id", "prediction")


@query("l28_constant_baseline", f"""WITH {S.EMB_CTE},
m AS (SELECT c_rule FROM emb GROUP BY c_rule ORDER BY count(*) DESC, c_rule LIMIT 1)
SELECT vec_id, (SELECT c_rule FROM m) AS prediction FROM emb""")
def l28_constant_baseline(spark, sf):
    e = emb_view(spark, sf).select("vec_id", "c_rule")
    return TR.constant_baseline(e, "c_rule").select("vec_id", "prediction")


# ---------------------------------------------------------------- model selection
def _folded_emb(spark, sf):
    return T.kfold(_emb_cls(spark, sf), 3, ["vec_id"], stratify="c_rule")


@query("g1_cross_val_score")
def g1_cross_val_score(spark, sf):
    e = _folded_emb(spark, sf).cache()
    ev = MulticlassClassificationEvaluator(metricName="accuracy")
    s = G.cross_val_score(TR.decision_tree(maxDepth=4, seed=42), e, ev, "fold", 3)
    return spark.createDataFrame([(i, float(v)) for i, v in enumerate(s)], "fold int, accuracy double")


@query("g2_cross_val_predict")
def g2_cross_val_predict(spark, sf):
    d = T.kfold(_dl(spark, sf), 3, ["doc_id"], stratify="quality")
    return G.cross_val_predict(LogisticRegression(maxIter=50), d, "fold", ["doc_id"]) \
        .select("doc_id", "fold", "prediction")


@query("g3_grid_search")
def g3_grid_search(spark, sf):
    e = _folded_emb(spark, sf).cache()
    rf = TR.random_forest(seed=42)
    maps = G.grid(rf, [{"numTrees": [5, 10], "maxDepth": [3, 5]}, {"numTrees": [5],
                                                                    "bootstrap": [False]}])
    ev = MulticlassClassificationEvaluator(metricName="accuracy")
    model, res = G.grid_search(rf, maps, ev, e, parallelism=4, collect_sub_models=True)
    train = G.fold_scores(model, e, ev).groupBy("map_id").agg(F.avg("train_score").alias("mean_train_score"))
    e.unpersist()
    return res.join(train, "map_id")


@query("g4_random_search")
def g4_random_search(spark, sf):
    e = _folded_emb(spark, sf).select("features", "label", "fold")
    lr = LogisticRegression(maxIter=30, family="multinomial")
    maps = G.random_param_maps(lr, {"regParam": ("reciprocal", 1e-3, 1.0),
                                    "elasticNetParam": ("uniform", 0.0, 1.0)}, 10)
    _, res = G.grid_search(lr, maps, MulticlassClassificationEvaluator(metricName="accuracy"), e)
    return res


@query("g5_preparation_search")
def g5_preparation_search(spark, sf):
    lp = T.kfold(lp_view(spark, sf, nulls=True), 3, ["l_orderkey", "l_partkey", "l_suppkey",
                                                       "l_linenumber", "l_extendedprice"],
                 portable=False)
    imp = X.Imputer(inputCols=["l_quantity", "l_tax", "p_retailprice"],
                    outputCols=["q", "t", "p"], strategy="median")
    va = VectorAssembler(inputCols=["q", "t", "p"], outputCol="features")
    from pyspark.ml.regression import LinearRegression
    pipe = Pipeline(stages=[imp, va, LinearRegression(labelCol="y_rule")])
    maps = [{imp.strategy: s} for s in ("mean", "median")]
    _, res = G.grid_search(pipe, maps, RegressionEvaluator(labelCol="y_rule",
                                                           metricName="rmse"),
                           lp.select("l_quantity", "l_tax", "p_retailprice", "y_rule", "fold"))
    return res


@query("g6_held_out_search")
def g6_held_out_search(spark, sf):
    e = _emb_cls(spark, sf)
    dt = TR.decision_tree(seed=42)
    maps = G.grid(dt, {"maxDepth": [2, 4, 6]})
    _, res = G.held_out_search(dt, maps, MulticlassClassificationEvaluator(metricName="accuracy"), e, ["vec_id"])
    return res


@query("g7_final_test")
def g7_final_test(spark, sf):
    ids = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice"]
    rows = G.stored(_lp(spark, sf).select(*ids, "features", "y_rule"), "g7-rows")      # one join
    d = T.split_three_way(rows, [0.8, 0.2], ids, out="part")
    tr = T.kfold(d.filter("part = 0"), 3, ids, portable=False).select("features", "y_rule", "fold")
    from pyspark.ml.regression import LinearRegression
    lr = LinearRegression(labelCol="y_rule")
    ev = RegressionEvaluator(labelCol="y_rule", metricName="rmse")
    best, res = G.grid_search(lr, G.grid(lr, {"regParam": [0.0, 0.1]}), ev, tr)
    score = G.final_evaluation(best, d.filter("part = 1"), ev)
    return res.withColumn("test_rmse_of_best", F.lit(score))


@query("t13_learning_curve")
def t13_learning_curve(spark, sf):
    d = _lp(spark, sf)
    lc = L.learning_curve(d, "features", "y_rule", ["l_orderkey", "l_partkey", "l_suppkey",
                                                    "l_linenumber", "l_extendedprice"], 8)
    return spark.createDataFrame(lc, "n_train long, train_rmse double, val_rmse double")


@query("t13b_learning_curve_any")
def t13b_learning_curve_any(spark, sf):
    e = _emb_cls(spark, sf)
    wrong = lambda p: p.agg(F.avg((F.col("prediction") != F.col("label")).cast("double"))).first()[0]
    n = e.count()
    sizes = [n // 8, n // 4, n // 2]
    fits = {"tree": lambda d: H.best_first_tree(d, max_leaf_nodes=12),
            "logistic": lambda d: L.logistic(C=1.0, n=d.count(), multinomial=True, max_iter=30).fit(d)}
    rows = [(name, *r) for name, fit in fits.items() for r in G.learning_curve_of(e, fit, wrong, ["vec_id"], sizes)]
    return spark.createDataFrame(rows, "model string, n_train long, train_error double, val_error double")


@query("u2_custom_predictor")
def u2_custom_predictor(spark, sf):
    from pyspark.ml.evaluation import BinaryClassificationEvaluator
    from quarry.operators.custom import LinearSVMClassifier
    e = _emb(spark, sf).withColumn("label", (F.col("c_rule") == 0).cast("double"))
    est = LinearSVMClassifier(C=10.0, epochs=60, eta0=1.0, etaD=10.0)
    m = est.fit(e)
    auc = BinaryClassificationEvaluator().evaluate(m.transform(e))
    tuned = est.copy({est.C: 1.0})              # U5: copy with a param map
    return m.transform(e).select("vec_id", "prediction").withColumn("train_auc", F.lit(auc)) \
        .withColumn("copied_C", F.lit(tuned.getOrDefault(tuned.C)))


# ---------------------------------------------------------------- U1, U3-U6
@query("u1_custom_transformer", f"""WITH {S.LP_CTE}
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, {S.rnd('l_quantity / l_extendedprice * 1000.0', 9)} AS per_kprice,
       {S.rnd('CASE WHEN p_size = 0 THEN NULL ELSE p_retailprice / p_size END', 9)} AS price_per_size FROM lp""")
def u1_custom_transformer(spark, sf):
    """A user's transformer as a pipeline stage, saved and loaded."""
    from pyspark.ml import PipelineModel

    from quarry.operators.columns import RatioFeatures
    from quarry.session import scratch_path
    lp = lp_view(spark, sf)
    stage = RatioFeatures(ratios=[["per_price", "l_quantity", "l_extendedprice"]], addOptional=True,
                          optional=["price_per_size", "p_retailprice", "p_size"])
    path = scratch_path(spark, "u1")
    Pipeline(stages=[stage]).fit(lp).write().save(path)
    d = PipelineModel.load(path).transform(lp)
    return d.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", rnd(F.col("per_price") * 1000.0, 9).alias("per_kprice"),
                    rnd("price_per_size", 9).alias("price_per_size"))


@query("u3_row_lambda", """
SELECT c_custkey, split_part(c_name, '#', 1) || '/' || lower(substr(c_mktsegment, 1, 3)) AS tag FROM customer""")
def u3_row_lambda(spark, sf):
    """A function of a row's own values, in Arrow batches."""
    from quarry.operators.custom import apply_rows
    from quarry.sources.tables import table
    tag = apply_rows(lambda name, segment: f"{name.split('#')[0]}/{segment[:3].lower()}", "string")
    return table(spark, sf, "customer").select("c_custkey", tag("c_name", "c_mktsegment").alias("tag"))


@query("u4_apply_along_axis", f"""WITH {S.EMB_CTE}
SELECT vec_id, {S.rnd('list_max(emb) - list_min(emb)', 9)} AS spread, (list_position(emb, list_max(emb)) - 1)::BIGINT AS top FROM emb""")
def u4_apply_along_axis(spark, sf):
    """Functions of whole arrays, one numpy call per batch."""
    from quarry.operators.custom import apply_arrays
    e = emb_view(spark, sf)
    spread = apply_arrays(lambda x: x.max(axis=1) - x.min(axis=1), "double")
    top = apply_arrays(lambda x: x.argmax(axis=1), "long")
    return e.select("vec_id", rnd(spread("emb"), 9).alias("spread"), top("emb").alias("top"))


@query("u5_clone_set_params", f"""WITH {S.LP_CTE}
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, {S.rnd('l_tax / l_quantity', 9)} AS first_ratio,
       {S.rnd('p_retailprice / l_quantity', 9)} AS second_ratio FROM lp""")
def u5_clone_set_params(spark, sf):
    """A pipeline cloned with another parameter of a named stage; the original keeps its own."""
    from quarry.operators.columns import RatioFeatures
    from quarry.operators.custom import clone
    lp = lp_view(spark, sf)
    first = Pipeline(stages=[RatioFeatures(ratios=["ratio,l_tax,l_quantity"], addOptional=False)])
    second = clone(first, {"0__ratios": ["ratio,p_retailprice,l_quantity"]})
    keys = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_tax", "l_quantity", "p_retailprice"]
    one = first.fit(lp).transform(lp.select(*keys)).withColumnRenamed("ratio", "first_ratio")
    both = second.fit(one).transform(one)
    return both.select(*keys[:4], rnd("first_ratio", 9).alias("first_ratio"), rnd("ratio", 9).alias("second_ratio"))


@query("u6_custom_aggregate", f"""WITH {S.EMB_CTE},
x AS (SELECT label, i, v FROM (SELECT label, unnest(emb) AS v, generate_subscripts(emb, 1) AS i FROM emb)),
m AS (SELECT label, i, avg(v) AS m, var_samp(v) AS s FROM x GROUP BY label, i)
SELECT label::BIGINT AS label, (SELECT count(*) FROM emb e WHERE e.label = m.label) AS n,
       {S.rnd('sum(m * i)', 9)} AS mean_sum, {S.rnd('sum(s)', 9)} AS total_variance FROM m GROUP BY label""")
def u6_custom_aggregate(spark, sf):
    """A mergeable aggregate of one's own: moments per label, added up in parts."""
    from quarry.operators.custom import merge_aggregate
    e = emb_view(spark, sf).withColumn("label", F.col("label").cast("long"))
    half = merge_aggregate([gram(e.where(F.col("vec_id") % 2 == r), "emb", group="label") for r in (0, 1)])
    rows = [(int(k), int(m.n), round(float(m.mean @ np.arange(1, len(m.mean) + 1)), 9) + 0.0,
             round(float(np.trace(m.cov(ddof=1))), 9) + 0.0) for k, m in sorted(half.items())]
    return spark.createDataFrame(rows, "label long, n long, mean_sum double, total_variance double")
