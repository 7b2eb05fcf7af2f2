"""Flagship job (SURVEY minimum slice) and its registered pieces.

LP view -> injected nulls -> stratified split (T4) -> median impute (X1) ->
ratio feature (F7) -> population scaling (X7) -> one-hot (X5) -> linear
regression by one Gram pass (L1) -> test RMSE with a t interval (E1, P13).
"""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.operators import columns as C
from quarry.operators import features as X
from quarry.operators import linear as L
from quarry.operators import profile as P
from quarry.operators import split as T
from quarry.plans.registry import query
from quarry.sources.tables import LP_NUMERIC, lp_view

LP_IDS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
          "l_extendedprice", "l_discount", "l_returnflag", "l_linestatus"]
QTY_EDGES = [0.0, 10.0, 20.0, 30.0, 40.0, float("inf")]


def prepared_split(spark: SparkSession, sf_dir: str, test_size: float = 0.2):
    lp = lp_view(spark, sf_dir, nulls=True).withColumn(
        "qty_cat", C.bucket("l_quantity", QTY_EDGES, [1, 2, 3, 4, 5]))
    s = T.split_stratified(lp, ["qty_cat"], test_size, LP_IDS, seed=42, portable=False,
                           n_strata=len(QTY_EDGES))
    # train and test both come from ONE evaluation of the split (the exact
    # cut scans its input three times); MEMORY_AND_DISK, recomputable on loss
    s = s.persist()
    return s.filter(~F.col("in_test")).drop("in_test"), s.filter("in_test").drop("in_test")


def preparation(num=LP_NUMERIC, cat=("l_returnflag",)) -> Pipeline:
    return X.column_transformer(list(num), list(cat),
                                ratios=["tax_per_qty,l_tax__imp,l_quantity__imp"])


def regression_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, test = prepared_split(spark, sf_dir)
    prep = preparation().fit(train)
    tr = prep.transform(train)
    fit = L.fit_linear(tr, "features", "y_rule")
    scored = prep.transform(test).withColumn("pred", fit.predict_expr("features"))
    se = scored.select(F.pow(F.col("y_rule") - F.col("pred"), 2).alias("se"))
    m = se.count()
    q = P.t_ppf(0.975, m - 1)
    out = P.interval_frame(se, "se", q).withColumn("n_features", F.lit(len(fit.coef)))
    return out


@query("l1_regression_report")
def l1_regression_report(spark, sf):
    return regression_report(spark, sf)
