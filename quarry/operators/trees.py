"""Trees and ensembles.

Single models are MLlib estimators.  Ensembles the reference builds by hand
(bagging with out-of-bag votes, small-tree forests, AdaBoost, residual
boosting, voting, stacking) are loops of MLlib fits on weighted or filtered
views of ONE cached DataFrame; per-replica membership is a hash-derived
weight column, so no replica is materialised.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.ml.classification import (DecisionTreeClassifier, GBTClassifier,
                                       MultilayerPerceptronClassifier,
                                       RandomForestClassifier)
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressor, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.operators.histtrees import feature_array, keyed_trees, small_tree_votes
from quarry.operators.split import poisson_weight, shuffle_split
from quarry.session import cut_lineage


def decision_tree(kind: str = "classifier", **kw):
    """L17 (min_samples_leaf -> minInstancesPerNode)."""
    if "min_samples_leaf" in kw:
        kw["minInstancesPerNode"] = kw.pop("min_samples_leaf")
    return DecisionTreeClassifier(**kw) if kind == "classifier" else DecisionTreeRegressor(**kw)


def random_forest(kind: str = "classifier", max_features=None, **kw):
    """L18 (max_features=k -> featureSubsetStrategy='k')."""
    if max_features is not None:
        kw["featureSubsetStrategy"] = str(max_features)
    return RandomForestClassifier(**kw) if kind == "classifier" else RandomForestRegressor(**kw)


def named_importances(model, names: Sequence[str]) -> list[tuple[str, float]]:
    """Feature importances paired with names, descending."""
    imp = model.featureImportances.toArray()
    return sorted(zip(names, imp.tolist()), key=lambda t: -t[1])


def _proba_col(pred: DataFrame, k: int):
    return vector_to_array("probability")


# ---------------------------------------------------------------- L20
def bagging(df: DataFrame, id_col: str, n_estimators: int = 10, max_samples: float | int = 1.0,
            features: str = "features", label: str = "label", seed: int = 42,
            **tree_kw) -> dict:
    """Bagged decision trees with an out-of-bag score.

    Replica r's sample is a Poisson weight per row (T9), computed from the
    hash of (seed, r, id) on the one cached table; ``max_samples`` is a share
    (float) or an expected number of rows (int).  Rows of weight 0 are out of
    bag for r.  ``oob`` has the mean class probabilities of the replicas that
    did not see the row, its class and its label.
    """
    data = df.select(id_col, features, label).cache()
    rate = max_samples / max(data.count(), 1) if isinstance(max_samples, int) else max_samples
    weight = [poisson_weight(F.lit(r), [id_col], rate, seed) for r in range(n_estimators)]
    models = [DecisionTreeClassifier(featuresCol=features, labelCol=label, weightCol="_w",
                                     seed=seed + r, **tree_kw)
              .fit(data.withColumn("_w", weight[r].cast("double")).filter("_w > 0"))
              for r in range(n_estimators)]
    k = max(m.numClasses for m in models)
    # plain columns first: the trees' own columns do not fit into one expression
    out, seen = data, []
    for r, m in enumerate(models):
        out = _with_proba(m, out, features, f"_q{r}", k)
        seen.append(F.when(weight[r] == 0, F.col(f"_q{r}")))
    members = F.filter(F.array(*seen), lambda q: q.isNotNull())
    mean = F.transform(F.aggregate(members, F.array_repeat(F.lit(0.0), k),
                                   lambda a, q: F.zip_with(a, q, lambda x, y: x + y)),
                       lambda x: x / F.size(members))
    oob = out.filter(F.size(members) > 0).select(id_col, label, mean.alias("oob_proba"))
    oob = oob.withColumn("oob_pred", (F.array_position("oob_proba", F.array_max("oob_proba")) - 1).cast("double"))
    score = oob.agg(F.avg((F.col("oob_pred") == F.col(label)).cast("double"))).first()[0]
    return {"models": models, "oob_score": score, "oob": oob, "oob_votes": oob.select(id_col, "oob_pred"),
            "n_classes": k}


def _with_proba(model, df: DataFrame, features: str, out: str, k: int) -> DataFrame:
    """Class probabilities of one fitted classifier as an array of length k."""
    names = {"prediction": "_tp", "rawPrediction": "_tr", "probability": "_tq"}
    m = model.copy()
    m = m.setFeaturesCol(features).setPredictionCol(names["prediction"]) \
        .setRawPredictionCol(names["rawPrediction"]).setProbabilityCol(names["probability"])
    q = vector_to_array("_tq")
    q = F.concat(q, F.array_repeat(F.lit(0.0), k - model.numClasses)) if k > model.numClasses else q
    return m.transform(df).withColumn(out, q).drop(*names.values())


def bagging_predict(ens: dict, df: DataFrame, features: str = "features") -> DataFrame:
    """Mean class probabilities over the bagged trees, and the likeliest class."""
    out, k = df, ens["n_classes"]
    for r, m in enumerate(ens["models"]):
        out = _with_proba(m, out, features, f"_q{r}", k)
    total = F.aggregate(F.array(*(F.col(f"_q{r}") for r in range(len(ens["models"])))),
                        F.array_repeat(F.lit(0.0), k),
                        lambda a, q: F.zip_with(a, q, lambda x, y: x + y))
    out = out.withColumn("proba", F.transform(total, lambda x: x / len(ens["models"])))
    return out.withColumn("prediction", (F.array_position("proba", F.array_max("proba")) - 1).cast("double")) \
        .drop(*(f"_q{r}" for r in range(len(ens["models"]))))


def vote(preds: DataFrame, id_col: str, member_col: str = "member",
         pred_col: str = "prediction", proba_col: str | None = None,
         drop: Sequence[str] = ()) -> DataFrame:
    """Hard vote (mode, ties -> smallest class) or soft vote (mean of
    probability arrays, then argmax) over a long (id, member, ...) table."""
    p = preds.filter(~F.col(member_col).isin(list(drop))) if drop else preds
    if proba_col is None:
        from quarry.operators.aggregate import mode
        return mode(p, [id_col], pred_col, "vote").select(id_col, "vote")
    n = F.count(F.lit(1))
    k = F.size(F.first(proba_col))
    summed = p.groupBy(id_col).agg(
        F.aggregate(F.collect_list(proba_col), F.array_repeat(F.lit(0.0), k),
                    lambda acc, a: F.zip_with(acc, a, lambda x, y: x + y)).alias("_s"),
        n.alias("_n"))
    mean = F.transform("_s", lambda x: x / F.col("_n"))
    return summed.select(id_col, mean.alias("mean_proba"),
                         (F.array_position(mean, F.array_max(mean)) - 1).cast("double")
                         .alias("vote"))


def members_long(models: dict, df: DataFrame, id_col: str, with_proba: bool = False) -> DataFrame:
    """Predictions of named fitted models in long form (id, member, ...)."""
    out = None
    for name, m in models.items():
        t = m.transform(df).select(id_col, F.lit(name).alias("member"), "prediction",
                                   *([vector_to_array("probability").alias("proba")]
                                     if with_proba else []))
        out = t if out is None else out.unionByName(t)
    return out


# ---------------------------------------------------------------- L20 / L22: many small trees
def bagging_small(df: DataFrame, id_col: str, n_estimators: int, max_samples: int,
                  features: str = "features", label: str = "label", seed: int = 42, **tree_kw) -> dict:
    """L20 with samples of about ``max_samples`` rows each: all trees are fitted
    in one job, a group of rows per tree, and the out-of-bag rows are scored in
    one pass.  Results as of ``bagging``."""
    data = whole_keyed(df, id_col, features, label)
    n, top = data.agg(F.count("*"), F.max("y")).first()
    k = int(top) + 1
    weights = F.transform(F.sequence(F.lit(0), F.lit(n_estimators - 1)),
                          lambda r: poisson_weight(r, ["id"], max_samples / max(n, 1), seed))
    data = data.withColumn("weights", weights)
    rows = data.select("x", "y", F.posexplode("weights").alias("replica", "w")).where("w > 0")
    models = keyed_trees(rows, "replica", "x", "y", k, "w", **tree_kw)
    own = dict(models)

    @F.pandas_udf("array<double>")
    def out_of_bag(x: pd.Series, w: pd.Series) -> pd.Series:
        rows_, seen = np.stack(x.to_list()), np.stack(w.to_list())
        total = np.zeros((len(rows_), k))
        for r, m in own.items():
            out = np.flatnonzero(seen[:, r] == 0)
            total[out] += m.predict_rows(rows_[out])
        size = total.sum(1)
        return pd.Series([t / s if s else None for t, s in zip(total, size)], dtype=object)

    oob = data.select(F.col("id").alias(id_col), F.col("y").alias(label), out_of_bag("x", "weights").alias("oob_proba")) \
        .where("oob_proba IS NOT NULL") \
        .withColumn("oob_pred", (F.array_position("oob_proba", F.array_max("oob_proba")) - 1).cast("double"))
    score = oob.agg(F.avg((F.col("oob_pred") == F.col(label)).cast("double"))).first()[0]
    return {"models": models, "oob_score": score, "oob": oob, "oob_votes": oob.select(id_col, "oob_pred"), "n_classes": k}


def whole_keyed(df: DataFrame, id_col: str, features: str, label: str) -> DataFrame:
    """id, x, y of the rows without a null or NaN."""
    return df.select(F.col(id_col).alias("id"), feature_array(df, features).alias("x"), F.col(label).cast("double").alias("y")) \
        .where("x IS NOT NULL AND y IS NOT NULL AND NOT isnan(y)").where(F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v)))


def small_tree_forest(df: DataFrame, test: DataFrame, id_col: str, n_sets: int = 1000,
                      size: int = 100, features: str = "features", label: str = "label",
                      seed: int = 42, **tree_kw) -> dict:
    """Many trees on small random subsets, fitted in one job (a group per
    subset), and their majority vote on ``test`` (ties: the smallest class)."""
    data = whole_keyed(df, id_col, features, label)
    k = int(data.agg(F.max("y")).first()[0]) + 1
    sets = shuffle_split(data, n_sets, size, ["id"], seed)
    models = keyed_trees(sets, "set_id", "x", "y", k, **tree_kw)
    votes = small_tree_votes(test, models, features, k).where("votes IS NOT NULL")
    own = sum((F.when(F.col(label) == F.lit(float(c)), F.col("votes")[c]).otherwise(0.0) for c in range(k)), F.lit(0.0))
    share = own / F.lit(len(models))
    top = F.array_position("votes", F.array_max("votes")) - 1
    mean, vote_ = votes.agg(F.avg(share), F.avg((top == F.col(label)).cast("double"))).first()
    return {"mean_tree_accuracy": float(mean), "vote_accuracy": float(vote_), "models": models}


# ---------------------------------------------------------------- L23
SMALLEST = 1e-15


def adaboost(df: DataFrame, n_estimators: int = 10, learning_rate: float = 0.5,
             features: str = "features", label: str = "label", max_depth: int = 1,
             checkpoint_every: int = 5, seed: int = 42, algorithm: str = "SAMME") -> dict:
    """Multi-class AdaBoost over depth-limited trees.  SAMME weighs a
    stage by its error; SAMME.R uses the stage's class probabilities.  Row
    weights are a column updated by one expression a round; the lineage is cut
    with a reliable checkpoint every few rounds."""
    k = int(df.agg(F.max(label)).first()[0]) + 1
    d = cut_lineage(df.select(features, label).withColumn("w", F.lit(1.0)))
    stages, alphas = [], []
    for r in range(n_estimators):
        m = DecisionTreeClassifier(featuresCol=features, labelCol=label, weightCol="w",
                                   maxDepth=max_depth, seed=seed + r).fit(d)
        p = _with_proba(m, d, features, "_q", k)
        if algorithm == "SAMME.R":
            logs = F.transform("_q", lambda x: F.log(F.greatest(x, F.lit(SMALLEST))))
            own = F.get(logs, F.col(label).cast("int"))
            rest = F.aggregate(logs, F.lit(0.0), lambda a, x: a + x) - own
            coded = own - rest / (k - 1)          # labels coded 1 and -1 / (k - 1)
            alpha, w = 1.0, F.col("w") * F.exp(-learning_rate * (k - 1) / k * coded)
        else:
            miss = (F.array_position("_q", F.array_max("_q")) - 1 != F.col(label)).cast("double")
            err = p.agg(F.sum(F.col("w") * miss) / F.sum("w")).first()[0]
            err = min(max(err, 1e-10), 1 - 1e-10)
            alpha = learning_rate * (math.log((1 - err) / err) + math.log(k - 1))
            w = F.col("w") * F.exp(F.lit(alpha) * miss)
        stages.append(m)
        alphas.append(alpha)
        d = p.withColumn("w", w).select(features, label, "w")
        total = d.agg(F.sum("w")).first()[0]
        d = d.withColumn("w", F.col("w") / F.lit(total))
        if (r + 1) % checkpoint_every == 0:
            d = cut_lineage(d)
    return {"models": stages, "alphas": alphas, "n_classes": k, "algorithm": algorithm}


def reweighted_sequence(df: DataFrame, fit, n_rounds: int, learning_rate: float = 1.0,
                        features: str = "features", label: str = "label") -> list:
    """L23 by hand: ``fit(data)`` (a classifier with weightCol ``w``) again and
    again, each time with the rows it got wrong weighing 1 + learning_rate
    times as much.  Returns the models of all rounds."""
    d, models = df.withColumn("w", F.lit(1.0)), []
    for r in range(n_rounds):
        m = fit(d)
        models.append(m)
        p = m.transform(d)
        factor = F.when(F.col("prediction") != F.col(label), 1.0 + learning_rate).otherwise(1.0)
        d = cut_lineage(p.withColumn("w", F.col("w") * factor).select(*d.columns))
    return models


def adaboost_predict(ens: dict, df: DataFrame, features: str = "features") -> DataFrame:
    """Class scores summed over the stages, and the class with the highest."""
    k, out = ens["n_classes"], df
    score = F.array_repeat(F.lit(0.0), k)
    for i, (m, a) in enumerate(zip(ens["models"], ens["alphas"])):
        out = _with_proba(m, out, features, f"_q{i}", k)
        q = F.col(f"_q{i}")
        if ens.get("algorithm") == "SAMME.R":
            logs = F.transform(q, lambda x: F.log(F.greatest(x, F.lit(SMALLEST))))
            mean = F.aggregate(logs, F.lit(0.0), lambda s, x: s + x) / k
            part = F.zip_with(logs, F.array_repeat(mean, k), lambda x, y: (k - 1) * (x - y))
        else:
            best = F.array_position(q, F.array_max(q)) - 1
            part = F.transform(F.sequence(F.lit(0), F.lit(k - 1)), _vote_of(best, a))
        out = out.withColumn(f"_s{i}", part)
        score = F.zip_with(score, F.col(f"_s{i}"), lambda x, y: x + y)
    out = out.withColumn("ada_score", score)
    out = out.withColumn("prediction", (F.array_position("ada_score", F.array_max("ada_score")) - 1).cast("double"))
    return out.drop(*(f"{c}{i}" for i in range(len(ens["models"])) for c in ("_q", "_s")))


def _vote_of(best, alpha: float):
    return lambda j: F.when(best == j, F.lit(float(alpha))).otherwise(F.lit(0.0))


# ---------------------------------------------------------------- L24 / L25
def residual_boosting(df: DataFrame, n_estimators: int = 3, features: str = "features",
                      label: str = "label", max_depth: int = 2, learning_rate: float = 1.0,
                      seed: int = 42) -> list:
    """L24 (by hand): each tree fits the residual of the previous ones."""
    d = df.select(features, label).withColumn("_res", F.col(label).cast("double"))
    models = []
    for i in range(n_estimators):
        m = DecisionTreeRegressor(featuresCol=features, labelCol="_res", maxDepth=max_depth,
                                  seed=seed + i).fit(d)
        models.append(m)
        d = m.transform(d).withColumn("_res", F.col("_res") - learning_rate * F.col("prediction")) \
            .drop("prediction")
        if (i + 1) % 5 == 0:
            d = cut_lineage(d)
    return models


def residual_predict(models: list, df: DataFrame, features: str = "features",
                     learning_rate: float = 1.0) -> DataFrame:
    out = df.withColumn("prediction_sum", F.lit(0.0))
    for i, m in enumerate(models):
        out = m.setPredictionCol("_p").transform(out).withColumn(
            "prediction_sum", F.col("prediction_sum") + learning_rate * F.col("_p")).drop("_p")
    return out


def gbt_regressor(max_iter: int = 20, step_size: float = 0.1, max_depth: int = 2,
                  validation_col: str | None = None, validation_tol: float = 0.01, **kw):
    """MLlib GBT with optional validation-based early stopping."""
    if validation_col:
        kw.update(validationIndicatorCol=validation_col, validationTol=validation_tol)
    return GBTRegressor(maxIter=max_iter, stepSize=step_size, maxDepth=max_depth, **kw)


def staged_errors(model, df: DataFrame, loss: str = "squared") -> list[float]:
    """Error after each boosting stage (evaluateEachIteration)."""
    return list(model.evaluateEachIteration(df, loss))


def best_n_estimators(errors: Sequence[float]) -> int:
    return int(np.argmin(errors)) + 1


# ---------------------------------------------------------------- L26 / L27 / L28
def mlp(layers: Sequence[int], max_iter: int = 100, seed: int = 42, **kw):
    """L26."""
    return MultilayerPerceptronClassifier(layers=list(layers), maxIter=max_iter, seed=seed, **kw)


def stacking(members: dict, blender_train: DataFrame, id_col: str, label: str = "label",
             seed: int = 42, **rf_kw):
    """Member predictions on a hold-out set become the blender's features."""
    preds = blender_train.select(id_col, label)
    for name, m in members.items():
        p = m.transform(blender_train).select(id_col, F.col("prediction").alias(f"m_{name}"))
        preds = preds.join(p, id_col)
    va = VectorAssembler(inputCols=[f"m_{n}" for n in members], outputCol="blend_features")
    data = va.transform(preds)
    blender = RandomForestClassifier(featuresCol="blend_features", labelCol=label, seed=seed,
                                     **rf_kw).fit(data)
    return blender, va


def stacking_predict(members: dict, blender, va, df: DataFrame, id_col: str) -> DataFrame:
    preds = df.select(id_col)
    for name, m in members.items():
        p = m.transform(df).select(id_col, F.col("prediction").alias(f"m_{name}"))
        preds = preds.join(p, id_col)
    return blender.transform(va.transform(preds))


def constant_baseline(df: DataFrame, label: str, value=None) -> DataFrame:
    """Predict a constant (given) or the majority class; probabilities
    are the class shares (one small aggregate)."""
    shares = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    top = shares.orderBy(F.col("n").desc(), F.col(label)).first()
    v = top[label] if value is None else value
    return df.withColumn("prediction", F.lit(v))
