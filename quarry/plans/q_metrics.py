"""Registered metric queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.functions.hashing import rnd
from quarry.operators import joins as J
from quarry.operators import metrics as E
from quarry.plans import sqlfrag as S
from quarry.plans.common import CENT_SQL, collect_centroids, label_centroids
from quarry.plans.q_columns import DL_SQL_CTE
from quarry.plans.registry import query
from quarry.sources.tables import dl_view, emb_view, lp_view

_PRED = "3.0 * l_quantity + 200.0 * l_discount + 0.05 * p_retailprice"


@query("e1_regression_metrics", f"""WITH {S.LP_CTE}
SELECT count(*) AS n, {S.rnd(f'avg(power(y_rule - ({_PRED}), 2))', 9)} AS mse,
       {S.rnd(f'sqrt(avg(power(y_rule - ({_PRED}), 2)))', 9)} AS rmse,
       {S.rnd(f'avg(abs(y_rule - ({_PRED})))', 9)} AS mae FROM lp""")
def e1_regression_metrics(spark, sf):
    lp = lp_view(spark, sf).withColumn("pred", F.expr(_PRED))
    m = E.regression_metrics(lp, "y_rule", "pred")
    return m.select("n", *[rnd(c, 9).alias(c) for c in ("mse", "rmse", "mae")])


# predicted class: the label whose centroid (mean of whole vectors) is nearest
PRED_SQL = f"""{CENT_SQL},
pred AS (
  SELECT vec_id, e.label AS label, c.label AS pred FROM emb e, cent c
  QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY list_distance(emb, centroid), c.label) = 1)"""


def _emb_pred(spark, sf):
    e = emb_view(spark, sf)
    labels, cents = collect_centroids(label_centroids(e))
    lab = F.element_at(F.array(*[F.lit(x) for x in labels]), F.col("cluster") + 1)
    return J.nearest_centroid(e, "emb", cents).withColumn("pred", lab)


@query("e2_accuracy", f"""WITH {PRED_SQL}
SELECT {S.rnd('avg(CASE WHEN label = pred THEN 1.0 ELSE 0.0 END)', 12)} AS accuracy FROM pred""")
def e2_accuracy(spark, sf):
    return E.accuracy(_emb_pred(spark, sf), "label", "pred").withColumn(
        "accuracy", rnd("accuracy", 12))


@query("e3_confusion_matrix", f"""WITH {PRED_SQL},
c AS (SELECT label AS y, pred AS p, count(*) AS count FROM pred GROUP BY 1, 2),
k AS (SELECT DISTINCT label AS k FROM embeddings),
g AS (SELECT a.k AS y, b.k AS p, coalesce(c.count, 0)::BIGINT AS count
      FROM k a CROSS JOIN k b LEFT JOIN c ON c.y = a.k AND c.p = b.k)
SELECT y, p, count, {S.rnd('CASE WHEN y = p THEN 0.0 ELSE count::DOUBLE / sum(count) OVER (PARTITION BY y) END', 12)} AS row_share
FROM g""")
def e3_confusion_matrix(spark, sf):
    d = _emb_pred(spark, sf)
    classes = sorted(r[0] for r in d.select("label").distinct().collect())
    cm = E.confusion_matrix(d, "label", "pred", classes)
    return cm.select(F.col("y").cast("int"), F.col("p").cast("int"), "count",
                     rnd("row_share", 12).alias("row_share"))


@query("l30_error_rows", f"""WITH {PRED_SQL}
SELECT vec_id FROM pred WHERE label = 3 AND pred = 5""")
def l30_error_rows(spark, sf):
    return E.error_rows(_emb_pred(spark, sf), "label", "pred", 3, 5).select("vec_id")


@query("e4_precision_recall_f1", f"""WITH {DL_SQL_CTE},
c AS (SELECT sum(CASE WHEN quality = 1 AND distinct_share >= 0.5 THEN 1 ELSE 0 END)::BIGINT AS tp,
             sum(CASE WHEN quality = 0 AND distinct_share >= 0.5 THEN 1 ELSE 0 END)::BIGINT AS fp,
             sum(CASE WHEN quality = 1 AND distinct_share < 0.5 THEN 1 ELSE 0 END)::BIGINT AS fn FROM dl)
SELECT tp, fp, fn, {S.rnd('tp / (tp + fp)', 12)} AS precision, {S.rnd('tp / (tp + fn)', 12)} AS recall,
       {S.rnd('2.0 * (tp / (tp + fp)) * (tp / (tp + fn)) / ((tp / (tp + fp)) + (tp / (tp + fn)))', 12)} AS f1
FROM c""")
def e4_precision_recall_f1(spark, sf):
    d = dl_view(spark, sf).withColumn("pred", (F.col("distinct_share") >= 0.5).cast("int"))
    m = E.binary_prf(d, "quality", "pred")
    return m.select("tp", "fp", "fn", *[rnd(c, 12).alias(c) for c in ("precision", "recall", "f1")])


@query("e5_macro_f1", f"""WITH {S.EMB_CTE},
l AS (SELECT 0 AS k, CAST(label >= 5 AS INTEGER) AS y, CAST(emb[1] > 0 AS INTEGER) AS p FROM emb
      UNION ALL SELECT 1, CAST(label % 2 = 1 AS INTEGER), CAST(emb[2] > 0 AS INTEGER) FROM emb),
c AS (SELECT k, sum(y * p) AS tp, sum((1 - y) * p) AS fp, sum(y * (1 - p)) AS fn FROM l GROUP BY k),
f AS (SELECT k, coalesce(tp / nullif(tp + fp, 0), 0.0) AS pr, coalesce(tp / nullif(tp + fn, 0), 0.0) AS rc FROM c)
SELECT {S.rnd('avg(coalesce(2.0 * pr * rc / nullif(pr + rc, 0), 0.0))', 12)} AS macro_f1 FROM f""")
def e5_macro_f1(spark, sf):
    e = emb_view(spark, sf).withColumns({
        "y0": F.col("label") >= 5, "y1": F.pmod("label", F.lit(2)) == 1,
        "p0": F.col("emb")[0] > 0, "p1": F.col("emb")[1] > 0})
    return E.macro_f1(e, ["y0", "y1"], ["p0", "p1"]).withColumn("macro_f1", rnd("macro_f1", 12))


_CURVE_SQL = f"""WITH {DL_SQL_CTE},
g AS (SELECT distinct_share AS threshold, sum(quality)::BIGINT AS pos_at,
             sum(1 - quality)::BIGINT AS neg_at FROM dl GROUP BY 1),
c AS (SELECT threshold, pos_at, neg_at,
             sum(pos_at) OVER (ORDER BY threshold DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS tp,
             sum(neg_at) OVER (ORDER BY threshold DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS fp,
             sum(pos_at) OVER () AS P, sum(neg_at) OVER () AS N FROM g)"""


@query("e6_pr_curve", f"""{_CURVE_SQL}
SELECT threshold, {S.rnd('tp / (tp + fp)', 12)} AS precision, {S.rnd('tp / P', 12)} AS recall FROM c
UNION ALL SELECT NULL, 1.0, 0.0""")
def e6_pr_curve(spark, sf):
    pr = E.precision_recall_curve(dl_view(spark, sf), "distinct_share", "quality")
    return pr.select("threshold", rnd("precision", 12).alias("precision"),
                     rnd("recall", 12).alias("recall"))


@query("e7_threshold_for_precision", f"""{_CURVE_SQL}
SELECT threshold, {S.rnd('tp / (tp + fp)', 12)} AS precision, {S.rnd('tp / P', 12)} AS recall FROM c
WHERE tp / (tp + fp) >= 0.9 ORDER BY threshold LIMIT 1""")
def e7_threshold_for_precision(spark, sf):
    t = E.threshold_for_precision(dl_view(spark, sf), "distinct_share", "quality", 0.9)
    return t.select("threshold", rnd("precision", 12).alias("precision"),
                    rnd("recall", 12).alias("recall"))


@query("e8_roc_curve", f"""{_CURVE_SQL}
SELECT threshold, {S.rnd('fp / N', 12)} AS fpr, {S.rnd('tp / P', 12)} AS tpr FROM c
UNION ALL SELECT NULL, 0.0, 0.0""")
def e8_roc_curve(spark, sf):
    r = E.roc_curve(dl_view(spark, sf), "distinct_share", "quality")
    return r.select("threshold", rnd("fpr", 12).alias("fpr"), rnd("tpr", 12).alias("tpr"))


@query("e9_roc_auc", f"""{_CURVE_SQL}
SELECT {S.rnd('sum((neg_at / N) * ((tp + (tp - pos_at)) / (2.0 * P)))', 12)} AS auc FROM c""")
def e9_roc_auc(spark, sf):
    return E.roc_auc(dl_view(spark, sf), "distinct_share", "quality").withColumn(
        "auc", rnd("auc", 12))


@query("e10_inertia", f"""WITH {CENT_SQL},
a AS (SELECT vec_id, min(list_distance(emb, centroid)) AS d FROM emb, cent GROUP BY vec_id)
SELECT {S.rnd('sum(d * d)', 9)} AS inertia, {S.rnd('-sum(d * d)', 9)} AS score FROM a""")
def e10_inertia(spark, sf):
    e = emb_view(spark, sf)
    _, cents = collect_centroids(label_centroids(e))
    a = J.nearest_centroid(e, "emb", cents)
    return E.inertia(a, "dist").select(rnd("inertia", 9).alias("inertia"),
                                       rnd("score", 9).alias("score"))


@query("e11_silhouette", f"""WITH {S.EMB_CTE},
p AS (SELECT a.vec_id, a.label AS c, b.label AS oc, sum(list_distance(a.emb, b.emb)) AS s,
             count(*) AS n
      FROM emb a, emb b GROUP BY 1, 2, 3),
r AS (SELECT vec_id, c, max(CASE WHEN oc = c THEN s / nullif(n - 1, 0) END) AS a,
             min(CASE WHEN oc <> c THEN s / n END) AS b,
             max(CASE WHEN oc = c THEN n END) AS n_own FROM p GROUP BY 1, 2)
SELECT vec_id, c::INTEGER AS label,
       {S.rnd('CASE WHEN n_own <= 1 OR b IS NULL THEN 0.0 ELSE (b - a) / greatest(a, b) END', 9)} AS silhouette
FROM r""")
def e11_silhouette(spark, sf):
    e = emb_view(spark, sf)
    s = E.silhouette(e, "vec_id", "emb", "label", block_rows=256)
    return s.select("vec_id", F.col("label").cast("int"), rnd("silhouette", 9).alias("silhouette"))


@query("e15_majority_agreement", f"""WITH {S.EMB_CTE},
m AS (SELECT c_rule, label AS mapped FROM (SELECT c_rule, label, count(*) AS n FROM emb GROUP BY 1, 2)
      QUALIFY row_number() OVER (PARTITION BY c_rule ORDER BY n DESC, label) = 1)
SELECT {S.rnd('avg(CASE WHEN label = mapped THEN 1.0 ELSE 0.0 END)', 12)} AS agreement
FROM emb JOIN m USING (c_rule)""")
def e15_majority_agreement(spark, sf):
    e = emb_view(spark, sf)
    return E.majority_mapping_agreement(e, "c_rule", "label").withColumn(
        "agreement", rnd("agreement", 12))
