"""Registered feature-preparation queries."""

from __future__ import annotations

import math

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from quarry.functions.hashing import rnd
from quarry.operators import features as X
from quarry.plans import sqlfrag as S
from quarry.plans.common import CENT_SQL, collect_centroids, label_centroids
from quarry.plans.registry import query
from quarry.sources.tables import emb_view, lp_view, plane_view, table

KEYS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]
KEYS_SQL = ", ".join(KEYS)


@query("x1_impute_stats", f"""WITH {S.LPN_CTE}
SELECT 'l_tax' AS "column", 'mean' AS strategy, {S.rnd('avg(l_tax)', 12)} AS value FROM lpn
UNION ALL SELECT 'l_tax', 'median', {S.rnd('quantile_cont(l_tax, 0.5)', 12)} FROM lpn
UNION ALL SELECT 'l_discount', 'mean', {S.rnd('avg(l_discount)', 12)} FROM lpn
UNION ALL SELECT 'l_discount', 'median', {S.rnd('quantile_cont(l_discount, 0.5)', 12)} FROM lpn""")
def x1_impute_stats(spark, sf):
    lp = lp_view(spark, sf, nulls=True)
    rows = []
    for how in ("mean", "median"):
        m = X.Imputer(inputCols=["l_tax", "l_discount"], strategy=how).fit(lp)
        for c, v in m.statistics().items():
            rows.append((c, how, v))
    # the statistics table is 4 rows; the fit jobs above ran on the executors
    return spark.createDataFrame(rows, "column string, strategy string, value double") \
        .withColumn("value", rnd("value", 12))


@query("x2_fill_median", f"""WITH {S.LPN_CTE}
SELECT {KEYS_SQL}, {S.rnd('coalesce(l_tax, (SELECT quantile_cont(l_tax, 0.5) FROM lpn))', 12)} AS l_tax_filled
FROM lpn""")
def x2_fill_median(spark, sf):
    lp = lp_view(spark, sf, nulls=True).select(*KEYS, "l_tax")
    f = X.fill_median(lp, "l_tax", "l_tax_filled")
    return f.select(*KEYS, rnd("l_tax_filled", 12).alias("l_tax_filled"))


@query("x3_most_frequent", f"""WITH {S.LPN_CTE},
m AS (SELECT p_brand AS m FROM lpn WHERE p_brand IS NOT NULL GROUP BY p_brand
      ORDER BY count(*) DESC, p_brand LIMIT 1)
SELECT {KEYS_SQL}, coalesce(p_brand, (SELECT m FROM m)) AS p_brand_filled FROM lpn""")
def x3_most_frequent(spark, sf):
    lp = lp_view(spark, sf, nulls=True).select(*KEYS, "p_brand")
    m = X.Imputer(inputCols=["p_brand"], outputCols=["p_brand_filled"],
                  strategy="most_frequent").fit(lp)
    return m.transform(lp).select(*KEYS, "p_brand_filled")


@query("x4_ordinal_encode", """
SELECT p_partkey, (dense_rank() OVER (ORDER BY p_type) - 1)::DOUBLE AS p_type_idx FROM part""")
def x4_ordinal_encode(spark, sf):
    p = table(spark, sf, "part").select("p_partkey", "p_type")
    return X.ordinal_encoder("p_type", "p_type_idx").fit(p).transform(p) \
        .select("p_partkey", "p_type_idx")


@query("x5_one_hot", """
SELECT p_partkey, (dense_rank() OVER (ORDER BY p_brand) - 1)::INTEGER AS slot,
       (SELECT count(DISTINCT p_brand) FROM part)::INTEGER AS size, 1.0 AS value
FROM part""")
def x5_one_hot(spark, sf):
    p = table(spark, sf, "part").select("p_partkey", "p_brand")
    o = X.one_hot_encoder("p_brand", "oh").fit(p).transform(p)
    arr = o.select("p_partkey", vector_to_array("oh").alias("a"))
    return arr.select("p_partkey", F.size("a").alias("size"),
                      F.posexplode("a").alias("slot", "value")).filter("value != 0") \
        .select("p_partkey", F.col("slot").cast("int"), "size", "value")


@query("x6_to_one_hot", """
SELECT vec_id, label AS hot_pos, 1 AS total FROM embeddings""")
def x6_to_one_hot(spark, sf):
    e = table(spark, sf, "embeddings").select("vec_id", "label")
    o = e.withColumn("oh", X.to_one_hot("label", 10))
    return o.select("vec_id", F.array_position("oh", 1).cast("int").alias("p"),
                    F.aggregate("oh", F.lit(0), lambda a, x: a + x).alias("total")) \
        .select("vec_id", (F.col("p") - 1).alias("hot_pos"), "total")


@query("x7_standard_scale", f"""
WITH s AS (SELECT avg(l_quantity) AS mq, stddev_pop(l_quantity) AS sq,
                  avg(l_extendedprice) AS mp, stddev_pop(l_extendedprice) AS sp FROM lineitem)
SELECT {KEYS_SQL}, {S.rnd('(l_quantity - mq) / sq', 9)} AS q_std,
       {S.rnd('(l_extendedprice - mp) / sp', 9)} AS p_std FROM lineitem, s""")
def x7_standard_scale(spark, sf):
    li = table(spark, sf, "lineitem").select(*KEYS, "l_quantity", "l_extendedprice")
    m = X.StandardScaler(inputCols=["l_quantity", "l_extendedprice"],
                         outputCols=["q_std", "p_std"]).fit(li)
    return m.transform(li).select(*KEYS, rnd("q_std", 9).alias("q_std"),
                                  rnd("p_std", 9).alias("p_std"))


@query("x8_inverse_scale", f"""
SELECT {KEYS_SQL}, {S.rnd('l_quantity', 6)} AS q_back, {S.rnd('l_extendedprice', 6)} AS p_back
FROM lineitem""")
def x8_inverse_scale(spark, sf):
    li = table(spark, sf, "lineitem").select(*KEYS, "l_quantity", "l_extendedprice")
    m = X.StandardScaler(inputCols=["l_quantity", "l_extendedprice"],
                         outputCols=["q_std", "p_std"]).fit(li)
    back = m.inverse(m.transform(li), ["q_std", "p_std"], ["q_back", "p_back"])
    return back.select(*KEYS, rnd("q_back", 6).alias("q_back"), rnd("p_back", 6).alias("p_back"))


@query("x9_min_max", f"""
WITH s AS (SELECT min(l_extendedprice) AS lo, max(l_extendedprice) AS hi FROM lineitem)
SELECT {KEYS_SQL}, {S.rnd('(l_extendedprice - lo) / (hi - lo)', 12)} AS p_mm,
       0.0 AS const_mm FROM lineitem, s""")
def x9_min_max(spark, sf):
    li = table(spark, sf, "lineitem").select(*KEYS, "l_extendedprice").withColumn(
        "const", F.lit(1.0))
    m = X.min_max_scale(li, ["l_extendedprice", "const"])
    return m.select(*KEYS, rnd("l_extendedprice_mm", 12).alias("p_mm"),
                    F.col("const_mm").cast("double").alias("const_mm"))


_POLY_NAMES = {"1": "t_1", "x": "t_x", "y": "t_y", "x^2": "t_xx", "x y": "t_xy", "y^2": "t_yy"}


@query("x10_polynomial", f"""
SELECT {KEYS_SQL}, 1.0 AS t_1, {S.rnd('x', 12)} AS t_x, {S.rnd('y', 12)} AS t_y,
       {S.rnd('x * x', 12)} AS t_xx, {S.rnd('x * y', 12)} AS t_xy, {S.rnd('y * y', 12)} AS t_yy
FROM (SELECT {KEYS_SQL}, l_quantity / 50.0 AS x, l_discount + 0.0 AS y FROM lineitem)""")
def x10_polynomial(spark, sf):
    li = table(spark, sf, "lineitem").select(
        *KEYS, (F.col("l_quantity") / 50.0).alias("x"), (F.col("l_discount") + 0.0).alias("y"))
    p = X.polynomial_features(li, ["x", "y"], 2, bias=True)
    return p.select(*KEYS, *[(rnd(F.col(f"`{k}`"), 12) if k != "1" else F.col("`1`"))
                             .alias(v) for k, v in _POLY_NAMES.items()])


@query("x11_add_bias", "SELECT o_orderkey, 1.0 AS bias FROM orders")
def x11_add_bias(spark, sf):
    return X.add_bias(table(spark, sf, "orders").select("o_orderkey"))


@query("x12_rbf_landmarks", f"""WITH {CENT_SQL}
SELECT vec_id,
  {S.rnd('exp(-0.5 * power(list_distance(emb, (SELECT centroid FROM cent WHERE label = 0)), 2))', 9)} AS rbf0,
  {S.rnd('exp(-0.5 * power(list_distance(emb, (SELECT centroid FROM cent WHERE label = 1)), 2))', 9)} AS rbf1
FROM emb""")
def x12_rbf_landmarks(spark, sf):
    e = emb_view(spark, sf)
    _, cents = collect_centroids(label_centroids(e))
    r = e.withColumn("rbf", X.rbf_landmarks("emb", cents[:2], 0.5))
    return r.select("vec_id", rnd(F.col("rbf")[0], 9).alias("rbf0"),
                    rnd(F.col("rbf")[1], 9).alias("rbf1"))


@query("x13_column_transformer")
def x13_column_transformer(spark, sf):
    lp = lp_view(spark, sf, nulls=True)
    pipe = X.column_transformer(["l_quantity", "l_discount", "l_tax", "p_size", "p_retailprice"],
                                ["l_returnflag", "p_type"],
                                ratios=["tax_per_qty,l_tax__imp,l_quantity__imp"])
    out = pipe.fit(lp).transform(lp)
    return out.select(*KEYS, vector_to_array("features").alias("features"))


@query("x14_top_feature_selector")
def x14_top_feature_selector(spark, sf):
    from pyspark.ml.classification import RandomForestClassifier
    from quarry.sources.tables import emb_vectors
    e = emb_vectors(emb_view(spark, sf))
    rf = RandomForestClassifier(labelCol="c_rule", numTrees=10, maxDepth=5, seed=42).fit(e)
    sel = X.top_feature_selector(rf.featureImportances.toArray().tolist(), 5)
    return sel.transform(e).select("vec_id", vector_to_array("selected").alias("selected"))


@query("x15_feature_names", """
SELECT (row_number() OVER (ORDER BY part, name) - 1)::INTEGER AS idx, name FROM (
  SELECT 0 AS part, 'l_quantity__imp__std' AS name UNION ALL SELECT 1, 'l_discount__imp__std'
  UNION ALL SELECT 2, 'l_tax__imp__std'
  UNION ALL SELECT DISTINCT 3, 'l_returnflag__oh_' || l_returnflag FROM lineitem JOIN part ON l_partkey = p_partkey)""")
def x15_feature_names(spark, sf):
    lp = lp_view(spark, sf, nulls=True)
    pipe = X.column_transformer(["l_quantity", "l_discount", "l_tax"], ["l_returnflag"])
    out = pipe.fit(lp).transform(lp)
    names = X.feature_names(out)
    return spark.createDataFrame(list(enumerate(names)), "idx int, name string")


@query("x16_cluster_distances", f"""WITH {CENT_SQL}
SELECT vec_id, c.label AS cluster, {S.rnd('list_distance(emb, centroid)', 9)} AS dist
FROM emb e, cent c""")
def x16_cluster_distances(spark, sf):
    e = emb_view(spark, sf)
    labels, cents = collect_centroids(label_centroids(e))
    d = X.cluster_distance_features(e, "emb", cents, keep=False)
    return d.select("vec_id", F.posexplode("cdist").alias("pos", "dist")).select(
        "vec_id", F.element_at(F.array(*[F.lit(x) for x in labels]), F.col("pos") + 1)
        .alias("cluster"), rnd("dist", 9).alias("dist"))


@query("x17_vector_quantize")
def x17_vector_quantize(spark, sf):
    e = emb_view(spark, sf)
    return X.vector_quantize(e, "emb", 8).select("vec_id", "quantized")


_TH = math.pi / 6
_R = X.rotation(_TH)


@query("x18_rotate", f"""WITH {S.PLANE_CTE}
SELECT id, {S.rnd(f'x * {_R[0][0]!r} + y * {_R[1][0]!r}', 9)} AS u,
       {S.rnd(f'x * {_R[0][1]!r} + y * {_R[1][1]!r}', 9)} AS v FROM plane""")
def x18_rotate(spark, sf):
    p = plane_view(spark, sf)
    r = p.withColumns(X.linear_map(["x", "y"], _R, ["u", "v"]))
    return r.select("id", rnd("u", 9).alias("u"), rnd("v", 9).alias("v"))
