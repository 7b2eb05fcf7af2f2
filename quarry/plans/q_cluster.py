"""Registered clustering / mixture queries."""

from __future__ import annotations

import numpy as np
from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from quarry.functions import mathfn as M
from quarry.functions.hashing import rnd
from quarry.operators import cluster as C
from quarry.operators import density as D
from quarry.operators import linkage as LK
from quarry.operators import linear as L
from quarry.operators import reduce as R
from quarry.operators import spectral as SP
from quarry.operators.joins import nearest_centroid
from quarry.plans import sqlfrag as S
from quarry.plans.common import CENT_SQL, collect_centroids, label_centroids
from quarry.plans.registry import query
from quarry.sources.tables import emb_vectors, emb_view, plane_view


def _planted(spark, sf):
    return emb_view(spark, sf, planted=True)


def _planted_pcs(spark, sf, k=5):
    e = _planted(spark, sf)
    p = R.pca(e, "emb", k)
    return R.pca_transform(e, "emb", p, "pc")


_ASSIGN2_SQL = f"""WITH {CENT_SQL},
a1 AS (SELECT vec_id, emb, c.label AS cluster FROM emb e, cent c
       QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY list_distance(emb, centroid), c.label) = 1),
c1 AS (SELECT cluster, list(m ORDER BY i) AS centroid FROM (
         SELECT cluster, i, avg(x) AS m FROM (
           SELECT cluster, unnest(emb) AS x, generate_subscripts(emb, 1) AS i FROM a1)
         GROUP BY cluster, i) GROUP BY cluster)"""


@query("c2_lloyd_given_init", f"""{_ASSIGN2_SQL}
SELECT vec_id, c1.cluster AS cluster, {S.rnd('list_distance(emb, centroid)', 9)} AS dist
FROM a1, c1
QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY list_distance(emb, centroid), c1.cluster) = 1""")
def c2_lloyd_given_init(spark, sf):
    e = emb_view(spark, sf)
    labels, cents = collect_centroids(label_centroids(e))
    r = C.lloyd(e, "emb", cents, max_iter=1)
    a = nearest_centroid(e, "emb", r["centroids"])
    lab = F.element_at(F.array(*[F.lit(x) for x in labels]), F.col("cluster") + 1)
    return a.select("vec_id", lab.alias("cluster"), rnd("dist", 9).alias("dist"))


@query("c5_representatives", f"""WITH {CENT_SQL},
a AS (SELECT vec_id, c.label AS cluster, round(list_distance(emb, centroid), 9) + 0.0 AS dist FROM emb e, cent c
      QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY list_distance(emb, centroid), c.label) = 1)
SELECT cluster, arg_min(vec_id, (dist, vec_id)) AS vec_id, min(dist) AS dist FROM a GROUP BY cluster""")
def c5_representatives(spark, sf):
    e = emb_view(spark, sf)
    labels, cents = collect_centroids(label_centroids(e))
    a = nearest_centroid(e, "emb", cents).withColumn("dist", rnd("dist", 9))
    rep = a.groupBy("cluster").agg(F.min_by(F.col("vec_id"), F.struct("dist", "vec_id"))
                                   .alias("vec_id"), F.min("dist").alias("dist"))
    lab = F.element_at(F.array(*[F.lit(x) for x in labels]), F.col("cluster") + 1)
    return rep.select(lab.alias("cluster"), "vec_id", "dist")


@query("c6_label_propagation", f"""WITH {CENT_SQL},
a AS (SELECT vec_id, e.label AS true_label, c.label AS cluster,
             round(list_distance(emb, centroid), 9) + 0.0 AS dist FROM emb e, cent c
      QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY list_distance(emb, centroid), c.label) = 1),
rep AS (SELECT cluster, arg_min(true_label, (dist, vec_id)) AS rep_label FROM a GROUP BY cluster),
q AS (SELECT cluster, quantile_cont(dist, 0.2) AS cut FROM a GROUP BY cluster)
SELECT vec_id, rep_label FROM a JOIN rep USING (cluster) JOIN q USING (cluster) WHERE dist <= cut""")
def c6_label_propagation(spark, sf):
    e = emb_view(spark, sf)
    _, cents = collect_centroids(label_centroids(e))
    a = nearest_centroid(e, "emb", cents).withColumn("dist", rnd("dist", 9))
    rep = a.groupBy("cluster").agg(F.min_by(F.col("label"), F.struct("dist", "vec_id"))
                                   .alias("rep_label"))
    p = C.propagate_labels(a, rep, percentile=0.2)
    return p.select("vec_id", "rep_label")


@query("c1_kmeans")
def c1_kmeans(spark, sf):
    e = _planted(spark, sf)
    m = C.kmeans(e, "emb", 5)
    return m.transform(e.withColumn("_v", array_to_vector("emb"))).select("vec_id", "group",
                                                                          "cluster")


@query("c3_kmeans_pp_best_of_n")
def c3_kmeans_pp_best_of_n(spark, sf):
    e = _planted(spark, sf)
    r = C.best_of_n_init(e, "emb", "vec_id", 5, n_init=3, max_iter=20)
    return spark.createDataFrame([(i, [float(x) for x in c], float(r["inertia"]), r["seed"])
                                  for i, c in enumerate(r["centroids"])],
                                 "cluster int, centroid array<double>, inertia double, seed int")


@query("c4_choose_k")
def c4_choose_k(spark, sf):
    rows = C.choose_k(_planted(spark, sf), "emb", [3, 5, 8])
    return spark.createDataFrame(rows, "k int, inertia double, silhouette double")


@query("c7_active_learning")
def c7_active_learning(spark, sf):
    e = emb_vectors(_planted(spark, sf)).withColumn("label", F.col("label").cast("double"))
    m = L.logistic(C=1.0, n=e.count(), multinomial=True, max_iter=30).fit(e)
    p = m.transform(e).withColumn("prob", vector_to_array("probability"))
    km = C.kmeans(p, "emb", 5)
    p = km.transform(p.withColumn("_v", array_to_vector("emb")))
    return C.least_certain(p, "prob", "cluster", 2, "vec_id").select(
        "vec_id", "cluster", "uncertainty")


@query("c8_dbscan", f"""WITH RECURSIVE {S.PLANE_CTE},
pair AS (SELECT a.id AS a, b.id AS b FROM plane a JOIN plane b
         ON b.x BETWEEN a.x - 0.301 AND a.x + 0.301 AND b.y BETWEEN a.y - 0.301 AND a.y + 0.301
         WHERE sqrt(power(a.x - b.x, 2) + power(a.y - b.y, 2)) <= 0.3),
core AS (SELECT a AS id FROM pair GROUP BY a HAVING count(*) >= 3),
link AS (SELECT a, b FROM pair WHERE a IN (SELECT id FROM core) AND b IN (SELECT id FROM core)),
reach(id, root) AS (SELECT id, id FROM core UNION SELECT l.b, r.root FROM reach r JOIN link l ON l.a = r.id),
comp AS (SELECT id, min(root) AS comp FROM reach GROUP BY id),
border AS (SELECT p.a AS id, min(c.comp) AS comp FROM pair p JOIN comp c ON c.id = p.b
           WHERE p.a NOT IN (SELECT id FROM core) GROUP BY p.a),
found AS (SELECT id, comp, TRUE AS is_core FROM comp UNION ALL SELECT id, comp, FALSE FROM border),
ranked AS (SELECT comp, row_number() OVER (ORDER BY comp) - 1 AS label FROM (SELECT DISTINCT comp FROM comp))
SELECT p.id, coalesce(r.label, -1) AS label, coalesce(f.is_core, FALSE) AS is_core
FROM plane p LEFT JOIN found f ON f.id = p.id LEFT JOIN ranked r ON r.comp = f.comp""")
def c8_dbscan(spark, sf):
    return C.dbscan(plane_view(spark, sf), "id", 0.3, 3, xy=("x", "y"))


@query("c9_dbscan_predict")
def c9_dbscan_predict(spark, sf):
    e = _planted(spark, sf)
    lab = C.dbscan(e, "vec_id", 1.5, 5, vec="emb")
    core = e.drop("label").join(lab.filter("is_core"), "vec_id")
    return C.dbscan_predict(core, e, "vec_id", "emb", 1.5)


@query("c10_spectral")
def c10_spectral(spark, sf):
    return C.spectral(_planted(spark, sf), "vec_id", "emb", 5, n_neighbors=10, gamma=0.5)


@query("c10b_laplacian_clusters")
def c10b_laplacian_clusters(spark, sf):
    e = _planted(spark, sf)
    return SP.spectral_clusters(e, "vec_id", "emb", 5, n_neighbors=10, gamma=0.5).join(e.select("vec_id", "group"), "vec_id")


@query("c11_hierarchical")
def c11_hierarchical(spark, sf):
    e = _planted(spark, sf)
    m = C.hierarchical(e, "emb", 5)
    return m.transform(e.withColumn("_v", array_to_vector("emb"))).select("vec_id", "group",
                                                                          "cluster")


@query("c11b_single_linkage")
def c11b_single_linkage(spark, sf):
    return LK.dendrogram(LK.spanning_tree(_planted(spark, sf), "vec_id", "emb"))


@query("c11c_single_linkage_cut", """
SELECT vec_id, min(vec_id) OVER (PARTITION BY vec_id % 5) AS cluster, (vec_id % 5)::INTEGER AS "group"
FROM embeddings""")
def c11c_single_linkage_cut(spark, sf):
    e = _planted(spark, sf)
    return LK.cut_tree(e, "vec_id", LK.spanning_tree(e, "vec_id", "emb"), k=5).join(e.select("vec_id", "group"), "vec_id")


@query("c11d_single_linkage_height", f"""WITH RECURSIVE {S.EMB_CTE},
link AS (SELECT a.vec_id AS a, b.vec_id AS b FROM emb a JOIN emb b ON list_distance(a.emb, b.emb) <= 1.2),
reach(id, root) AS (SELECT vec_id, vec_id FROM emb UNION SELECT l.b, r.root FROM reach r JOIN link l ON l.a = r.id)
SELECT id AS vec_id, min(root) AS cluster FROM reach GROUP BY id""")
def c11d_single_linkage_height(spark, sf):
    e = emb_view(spark, sf)
    return LK.cut_tree(e, "vec_id", LK.spanning_tree(e, "vec_id", "emb"), height=1.2)


@query("c12_gmm")
def c12_gmm(spark, sf):
    pcs = _planted_pcs(spark, sf)
    m, d = D.mllib_gmm(pcs, "pc", 5, n_init=2)
    return m.transform(d).select("vec_id", "group", "cluster",
                                 F.array_max(vector_to_array("proba")).alias("p_max"))


@query("c13_gmm_covariance_types")
def c13_gmm_covariance_types(spark, sf):
    pcs = _planted_pcs(spark, sf)
    rows = []
    for ct in ("full", "tied", "diag", "spherical"):
        m = D.em(pcs, "pc", 5, ct, max_iter=20, id_col="vec_id")
        rows.append((ct, m.log_likelihood, m.bic(), m.aic(), m.n_iter))
    return spark.createDataFrame(rows, "cov_type string, log_likelihood double, bic double, "
                                       "aic double, n_iter int")


@query("c14_variational_gmm")
def c14_variational_gmm(spark, sf):
    pcs = _planted_pcs(spark, sf)
    m = D.vb_gmm(pcs, "pc", 8, "vec_id", max_iter=30, weight_prior=0.01)
    return spark.createDataFrame([(i, float(w)) for i, w in enumerate(m.weights)],
                                 "component int, weight double")


@query("c14b_sparse_prior_gmm")
def c14_sparse_prior_gmm(spark, sf):
    pcs = _planted_pcs(spark, sf)
    m = D.em(pcs, "pc", 8, "full", max_iter=30, prior=0.01, id_col="vec_id")
    return spark.createDataFrame([(i, float(w)) for i, w in enumerate(m.weights)],
                                 "component int, weight double")


@query("c14c_stick_breaking")
def c14c_stick_breaking(spark, sf):
    m = D.vb_gmm(_planted_pcs(spark, sf), "pc", 8, "vec_id", max_iter=40, weight_prior=0.01, prior="stick_breaking")
    return spark.createDataFrame([(i, float(w)) for i, w in enumerate(m.weights)], "component int, weight double")


def _fitted(spark, sf):
    pcs = _planted_pcs(spark, sf)
    return pcs, D.em(pcs, "pc", 5, "full", max_iter=20, id_col="vec_id")


@query("c15_density_anomalies")
def c15_density_anomalies(spark, sf):
    pcs, m = _fitted(spark, sf)
    return D.anomalies(pcs, "pc", m, 0.04).select("vec_id", "log_density")


@query("m6_log_density")
def m6_log_density(spark, sf):
    pcs, m = _fitted(spark, sf)
    return pcs.select("vec_id", D.score_samples("pc", m).alias("log_density"),
                      D.predict_proba("pc", m).alias("proba"))


@query("c16_gmm_sample")
def c16_gmm_sample(spark, sf):
    pcs, m = _fitted(spark, sf)
    return D.sample(spark, m, pcs.count())          # as many new rows as the input has


@query("c17_bic_aic")
def c17_bic_aic(spark, sf):
    pcs = _planted_pcs(spark, sf, 3)
    rows = D.bic_table(pcs, "pc", [3, 5], ["full", "diag"], id_col="vec_id", max_iter=15, n_init=2)
    return spark.createDataFrame(rows, "k int, cov_type string, log_likelihood double, "
                                       "bic double, aic double")


@query("m7_grid_scoring")
def m7_grid_scoring(spark, sf):
    pcs = _planted_pcs(spark, sf, 2)
    d = pcs.withColumn("f", array_to_vector("pc")).withColumn("label", F.col("group")
                                                               .cast("double"))
    m = DecisionTreeClassifier(featuresCol="f", maxDepth=4, seed=42).fit(d)
    lo, hi = pcs.agg(F.min(F.col("pc")[0]), F.max(F.col("pc")[0])).first()
    lo2, hi2 = pcs.agg(F.min(F.col("pc")[1]), F.max(F.col("pc")[1])).first()
    g = M.grid(spark, (lo, hi), (lo2, hi2), 50, 50)
    g = g.withColumn("f", array_to_vector(F.array("x", "y")))
    return m.transform(g).select("cell", "x", "y", "prediction")


@query("e12_bic_aic")
def e12_bic_aic(spark, sf):
    _, m = _fitted(spark, sf)
    return spark.createDataFrame([(m.cov_type, m.k, m.n_parameters(), m.log_likelihood,
                                   m.bic(), m.aic())],
                                 "cov_type string, k int, n_parameters int, "
                                 "log_likelihood double, bic double, aic double")
