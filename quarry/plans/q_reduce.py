"""Registered dimensionality-reduction queries."""

from __future__ import annotations

import numpy as np
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from quarry.functions.hashing import rnd
from quarry.operators import reduce as R
from quarry.operators import split as T
from quarry.operators.joins import knn_join
from quarry.operators.selection import stored
from quarry.plans import sqlfrag as S
from quarry.plans.registry import query
from quarry.sources.tables import emb_view


def _sub(spark, sf):
    return emb_view(spark, sf, subspace=True)


@query("r1_pca")
def r1_pca(spark, sf):
    e = _sub(spark, sf)
    p = R.pca(e, "emb", 4)
    return R.pca_transform(e, "emb", p).select("vec_id", "pc")


@query("r2_pca_variance_target")
def r2_pca_variance_target(spark, sf):
    p = R.pca(_sub(spark, sf), "emb", variance=0.95)
    return R.explained_variance_table(p, spark).withColumn("n_components",
                                                          F.lit(len(p.explained_variance)))


@query("w2_cumulative_variance")
def w2_cumulative_variance(spark, sf):
    from quarry.operators.window import first_index_reaching
    p = R.pca(_sub(spark, sf), "emb")
    t = R.explained_variance_table(p, spark).select("axis", "ratio")
    return first_index_reaching(t, "axis", "ratio", 0.95)


@query("e13_explained_variance_ratio")
def e13_explained_variance_ratio(spark, sf):
    return R.explained_variance_table(R.pca(_sub(spark, sf), "emb", 8), spark)


@query("r3_incremental_pca")
def r3_incremental_pca(spark, sf):
    e = _sub(spark, sf).withColumn("batch", F.pmod(F.xxhash64("vec_id"), F.lit(5)))
    inc = R.incremental_pca(e, "emb", "batch", 4)
    full = R.pca(e, "emb", 4)
    rows = [(i + 1, float(abs(np.dot(a, b))), float(x), float(y)) for i, (a, b, x, y) in
            enumerate(zip(inc.components, full.components, inc.explained_variance,
                          full.explained_variance))]
    return spark.createDataFrame(rows, "axis int, abs_cosine double, var_incremental double, "
                                       "var_full double")


@query("r4_randomized_pca")
def r4_randomized_pca(spark, sf):
    e = _sub(spark, sf)
    rp = R.randomized_pca(e, "emb", 4)
    full = R.pca(e, "emb", 4)
    rows = [(i + 1, float(abs(np.dot(a, b))), float(x), float(y)) for i, (a, b, x, y) in
            enumerate(zip(rp.components, full.components, rp.explained_variance,
                          full.explained_variance))]
    return spark.createDataFrame(rows, "axis int, abs_cosine double, var_randomized double, "
                                       "var_exact double")


@query("r5_kernel_pca")
def r5_kernel_pca(spark, sf):
    e = emb_view(spark, sf, planted=True)
    m = R.kernel_pca(e, "emb", "vec_id", 3, "rbf", gamma=0.1, n_landmarks=60)
    z = e.withColumn("z", m.features_udf("emb"))
    back = z.withColumn("x_back", m.preimage_udf("z"))
    from quarry.operators.metrics import reconstruction_error
    return back.select("vec_id", "z", reconstruction_error("emb", "x_back").alias("preimage_mse"))


@query("r6_kernel_parameter_search")
def r6_kernel_parameter_search(spark, sf):
    e = emb_view(spark, sf, planted=True)
    e = T.split_three_way(e, [0.7, 0.3], ["vec_id"], out="part").select("vec_id", "emb", "group", "part")
    e = stored(e, "r6-rows")
    tr, va = e.filter("part = 0"), e.filter("part = 1")
    ev = MulticlassClassificationEvaluator(metricName="accuracy", labelCol="group")
    rows = []
    for kernel, gamma in (("rbf", 0.03), ("rbf", 0.1), ("sigmoid", 0.05)):
        m = R.kernel_pca(tr, "emb", "vec_id", 3, kernel, gamma=gamma, n_landmarks=60,
                         fit_inverse=False)
        f = lambda d: d.withColumn("f", array_to_vector(m.features_udf("emb")))
        lr = LogisticRegression(featuresCol="f", labelCol="group", maxIter=50).fit(f(tr))
        rows.append((kernel, gamma, float(ev.evaluate(lr.transform(f(va))))))
    return spark.createDataFrame(rows, "kernel string, gamma double, accuracy double")


@query("r7_pca_then_classify")
def r7_pca_then_classify(spark, sf):
    e = emb_view(spark, sf)
    e = T.split_three_way(e, [0.8, 0.2], ["vec_id"], out="part").withColumn(
        "label", F.col("c_rule").cast("double"))
    p = R.pca(e.filter("part = 0"), "emb", variance=0.95)
    e = R.pca_transform(e, "emb", p).withColumn("raw", array_to_vector("emb")) \
        .withColumn("red", array_to_vector("pc")).cache()
    ev = MulticlassClassificationEvaluator(metricName="accuracy")
    rows = []
    for name, col in (("raw", "raw"), ("pca", "red")):
        m = RandomForestClassifier(featuresCol=col, numTrees=20, seed=42).fit(e.filter("part = 0"))
        rows.append((name, len(p.explained_variance) if name == "pca" else 64,
                     float(ev.evaluate(m.transform(e.filter("part = 1"))))))
    e.unpersist()
    return spark.createDataFrame(rows, "variant string, n_features int, accuracy double")


@query("r8_reconstruction_anomaly")
def r8_reconstruction_anomaly(spark, sf):
    from quarry.operators.profile import exact_quantiles
    e = _sub(spark, sf)
    p = R.pca(e, "emb", 4)
    r = R.reconstruction_errors(e, "emb", p).select("vec_id", "rec_error").cache()
    cut = exact_quantiles(r, "rec_error", [0.98], names=["cut"]).first()["cut"]
    return r.withColumn("anomaly", F.col("rec_error") > F.lit(cut))


@query("e14_reconstruction_error")
def e14_reconstruction_error(spark, sf):
    e = _sub(spark, sf)
    rows = []
    for k in (2, 4, 16, 64):
        p = R.pca(e, "emb", k)
        err = R.reconstruction_errors(e, "emb", p).agg(F.avg("rec_error")).first()[0]
        rows.append((k, float(err)))
    return spark.createDataFrame(rows, "k int, mean_rec_error double")


@query("r9_knn_graph", f"""WITH {S.EMB_CTE}
SELECT a.vec_id AS qid, b.vec_id AS nid, {S.rnd('list_distance(a.emb, b.emb)', 9)} AS dist,
       row_number() OVER (PARTITION BY a.vec_id ORDER BY list_distance(a.emb, b.emb), b.vec_id) AS rank
FROM emb a, emb b WHERE a.vec_id <> b.vec_id QUALIFY rank <= 3""")
def r9_knn_graph(spark, sf):
    e = emb_view(spark, sf)
    k = knn_join(e, e, 3, "vec_id", "emb", exclude_self=True, block_rows=256)
    return k.select("qid", "nid", rnd("dist", 9).alias("dist"), F.col("rank").cast("long"))


@query("l29_lda")
def l29_lda(spark, sf):
    e = emb_view(spark, sf, planted=True)
    r = R.lda(e, "emb", "group", 2)
    return e.select("vec_id", "group", R.project("emb", np.zeros(64), r["axes"]).alias("ld"))
