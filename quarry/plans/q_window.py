"""Registered window / sort / top-k queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.functions.arrays import euclidean
from quarry.functions.hashing import rnd
from quarry.operators import joins as J
from quarry.operators import window as W
from quarry.plans import sqlfrag as S
from quarry.plans.common import CENT_SQL, label_centroids
from quarry.plans.registry import query
from quarry.sources.tables import emb_view, plane_view, table


@query("w1_running_mean", f"""
SELECT event_id, user_id, {S.rnd('avg(value) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)', 9)} AS running_mean
FROM events""")
def w1_running_mean(spark, sf):
    ev = table(spark, sf, "events").select("event_id", "user_id", "ts", "value")
    r = W.running_mean(ev, "user_id", ["ts", "event_id"], "value")
    return r.select("event_id", "user_id", rnd("running_mean", 9).alias("running_mean"))


@query("w3_sort_positions", """
SELECT o_orderkey, row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) AS pos FROM orders""")
def w3_sort_positions(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return W.sort_positions(o, "o_totalprice", ["o_orderkey"], descending=True) \
        .select("o_orderkey", "pos")


@query("w4_top_k", """
SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10""")
def w4_top_k(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return W.top_k(o, 10, "o_totalprice", ["o_orderkey"])


@query("w4b_top_k_per_group", """
SELECT o_custkey, o_orderkey, o_totalprice,
       row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rank
FROM orders QUALIFY rank <= 3""")
def w4b_top_k_per_group(spark, sf):
    o = table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    return W.top_k_per_group(o, 3, ["o_custkey"], "o_totalprice", [F.col("o_orderkey")]) \
        .withColumn("rank", F.col("rank").cast("long"))


@query("w5_top_k_indices", """
SELECT vec_id, (i - 1)::INTEGER AS idx FROM (
  SELECT vec_id, unnest(embedding)::DOUBLE AS v, generate_subscripts(embedding, 1) AS i
  FROM embeddings)
QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY v DESC, i) <= 3""")
def w5_top_k_indices(spark, sf):
    e = emb_view(spark, sf)
    t = W.top_k_indices(e, "emb", 3)
    return t.select("vec_id", F.explode("top_idx").alias("idx"))


_DIST_SQL = f"""WITH {CENT_SQL},
d AS (SELECT vec_id, e.label, round(list_distance(emb, centroid), 9) + 0.0 AS dist
      FROM emb e JOIN cent c ON e.label = c.label)"""


def _dist_df(spark, sf):
    e = emb_view(spark, sf)
    j = J.lookup(e, label_centroids(e), ["label"], "inner")
    return j.select("vec_id", "label", rnd(euclidean("emb", "centroid"), 9).alias("dist"))


@query("w6_best_per_group", f"""{_DIST_SQL}
SELECT label, arg_min(vec_id, (dist, vec_id)) AS best_vec_id, min(dist) AS best_dist
FROM d GROUP BY label""")
def w6_best_per_group(spark, sf):
    return W.best_per_group(_dist_df(spark, sf), "label", "dist", "vec_id")


@query("w7_percentile_cut", f"""{_DIST_SQL},
q AS (SELECT label, quantile_cont(dist, 0.2) AS cut FROM d GROUP BY label)
SELECT vec_id, d.label FROM d JOIN q USING (label) WHERE dist <= cut""")
def w7_percentile_cut(spark, sf):
    return W.percentile_cut(_dist_df(spark, sf), "label", "dist", 0.2).select("vec_id", "label")


@query("w8_ordered_by_group", f"""{_DIST_SQL}
SELECT vec_id, label, row_number() OVER (PARTITION BY label ORDER BY dist, vec_id) AS pos FROM d""")
def w8_ordered_by_group(spark, sf):
    return W.ordered_by_group(_dist_df(spark, sf), "label", "dist", ["vec_id"]) \
        .select("vec_id", "label", "pos")


@query("w9_grid_thin", f"""WITH {S.PLANE_CTE}
SELECT floor(x / 1.0)::BIGINT AS cx, floor(y / 1.0)::BIGINT AS cy, min(id) AS id,
       {S.rnd('arg_min(x, id)', 9)} AS x, {S.rnd('arg_min(y, id)', 9)} AS y
FROM plane GROUP BY 1, 2""")
def w9_grid_thin(spark, sf):
    t = W.grid_thin(plane_view(spark, sf), "x", "y", 1.0, "id")
    return t.select("cx", "cy", "id", rnd("x", 9).alias("x"), rnd("y", 9).alias("y"))
