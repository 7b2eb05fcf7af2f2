"""Registered math queries (M1-M5, M7)."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.functions import mathfn as M
from quarry.functions.arrays import argmax
from quarry.functions.hashing import rnd
from quarry.operators.joins import centroid_distances
from quarry.plans import sqlfrag as S
from quarry.plans.common import CENT_SQL, collect_centroids, label_centroids
from quarry.plans.registry import query
from quarry.sources.tables import emb_view, table

KEYS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]
_M1 = {"sqrt_q": ("sqrt(l_quantity)", lambda: F.sqrt("l_quantity")),
       "exp_d": ("exp(l_discount)", lambda: F.exp("l_discount")),
       "log_p": ("ln(l_extendedprice)", lambda: F.log("l_extendedprice")),
       "abs_d": ("abs(l_discount - 0.05)", lambda: F.abs(F.col("l_discount") - 0.05)),
       "sign_d": ("sign(l_discount - 0.05)::DOUBLE",
                  lambda: F.signum(F.col("l_discount") - 0.05)),
       "sq_t": ("l_tax * l_tax", lambda: F.col("l_tax") * F.col("l_tax")),
       "sin_q": ("sin(l_quantity)", lambda: F.sin("l_quantity")),
       "cos_q": ("cos(l_quantity)", lambda: F.cos("l_quantity"))}


@query("m1_math", "SELECT " + ", ".join(KEYS) + ", " + ", ".join(
    f"{S.rnd(sql, 9)} AS {k}" for k, (sql, _) in _M1.items()) + " FROM lineitem")
def m1_math(spark, sf):
    li = table(spark, sf, "lineitem")
    return li.select(*KEYS, *[rnd(c(), 9).alias(k) for k, (_, c) in _M1.items()])


@query("m2_sigmoid", f"""
SELECT {', '.join(KEYS)}, {S.rnd('1.0 / (1.0 + exp(-((l_quantity - 25.0) / 10.0)))', 12)} AS p
FROM lineitem""")
def m2_sigmoid(spark, sf):
    li = table(spark, sf, "lineitem")
    return li.select(*KEYS, rnd(M.sigmoid((F.col("l_quantity") - 25.0) / 10.0), 12).alias("p"))


_SOFTMAX_SQL = """list_transform(l, lambda x: exp(x - list_max(l))
                  / list_sum(list_transform(l, lambda y: exp(y - list_max(l)))))"""


@query("m3_softmax", f"""WITH {S.EMB_CTE}
SELECT vec_id, {S.rnd('list_max(p)', 12)} AS p_max, (list_position(p, list_max(p)) - 1)::INTEGER AS arg,
       {S.rnd('list_sum(p)', 12)} AS total
FROM (SELECT vec_id, {_SOFTMAX_SQL} AS p FROM (SELECT vec_id, emb AS l FROM emb))""")
def m3_softmax(spark, sf):
    e = emb_view(spark, sf).withColumn("p", M.softmax("emb"))
    return e.select("vec_id", rnd(F.array_max("p"), 12).alias("p_max"), argmax("p").alias("arg"),
                    rnd(F.aggregate("p", F.lit(0.0), lambda a, x: a + x), 12).alias("total"))


@query("m4_hinge", f"""WITH {S.EMB_CTE}
SELECT vec_id, {S.rnd('greatest(0.0, 1.0 - (CASE WHEN label >= 5 THEN 1.0 ELSE -1.0 END) * emb[1] * 10.0)', 12)} AS hinge
FROM emb""")
def m4_hinge(spark, sf):
    e = emb_view(spark, sf)
    t = F.when(F.col("label") >= 5, 1.0).otherwise(-1.0)
    return e.select("vec_id", rnd(M.hinge(t * F.col("emb")[0] * 10.0), 12).alias("hinge"))


@query("m5_cross_entropy", f"""WITH {CENT_SQL},
s AS (SELECT vec_id, any_value(e.label) AS label,
             list(-10.0 * list_distance(emb, centroid) ORDER BY c.label) AS l
      FROM emb e, cent c GROUP BY vec_id),
p AS (SELECT label, {_SOFTMAX_SQL} AS p FROM s)
SELECT {S.rnd('-avg(ln(p[label + 1] + 1e-7))', 9)} AS cross_entropy FROM p""")
def m5_cross_entropy(spark, sf):
    """Class scores: how near each label's centroid is (whole vectors)."""
    e = emb_view(spark, sf)
    _, cents = collect_centroids(label_centroids(e))
    near = F.transform(centroid_distances("emb", cents), lambda d: d * -10.0)
    p = e.select("label", M.softmax(near).alias("p"))
    return p.agg(rnd(M.cross_entropy(F.element_at("p", F.col("label") + 1)), 9)
                 .alias("cross_entropy"))
