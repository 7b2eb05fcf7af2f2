"""Registered aggregate queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.functions.arrays import flip_image
from quarry.functions.hashing import rnd
from quarry.operators import aggregate as A
from quarry.plans import sqlfrag as S
from quarry.plans.registry import query
from quarry.sources.tables import emb_view, table


@query("a1_group_mean", f"""
SELECT l_returnflag, l_linestatus, {S.rnd('avg(l_extendedprice)', 6)} AS mean
FROM lineitem WHERE l_returnflag IS NOT NULL AND l_linestatus IS NOT NULL GROUP BY 1, 2""")
def a1_group_mean(spark, sf):
    g = A.group_mean(table(spark, sf, "lineitem"), ["l_returnflag", "l_linestatus"],
                     "l_extendedprice")
    return g.withColumn("mean", rnd("mean", 6))


@query("a2_scalar_aggregates", f"""
SELECT {S.rnd('sum(o_totalprice)', 2)} AS sum, {S.rnd('avg(o_totalprice)', 6)} AS mean,
       {S.rnd('stddev_samp(o_totalprice)', 6)} AS std, min(o_totalprice) AS min,
       max(o_totalprice) AS max,
       (SELECT o_orderkey FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 1) AS argmax,
       (SELECT o_orderkey FROM orders ORDER BY o_totalprice, o_orderkey LIMIT 1) AS argmin
FROM orders""")
def a2_scalar_aggregates(spark, sf):
    a = A.scalar_aggregates(table(spark, sf, "orders"), "o_totalprice", "o_orderkey")
    return a.select(rnd("sum", 2).alias("sum"), rnd("mean", 6).alias("mean"),
                    rnd("std", 6).alias("std"), "min", "max", "argmax", "argmin")


@query("a3_distinct", "SELECT DISTINCT label FROM embeddings")
def a3_distinct(spark, sf):
    return A.distinct_values(table(spark, sf, "embeddings"), ["label"])


@query("a4_mode", """
SELECT l_suppkey, l_returnflag AS mode, c AS mode_count FROM (
  SELECT l_suppkey, l_returnflag, count(*) AS c FROM lineitem
  WHERE l_returnflag IS NOT NULL GROUP BY 1, 2)
QUALIFY row_number() OVER (PARTITION BY l_suppkey ORDER BY c DESC, l_returnflag) = 1""")
def a4_mode(spark, sf):
    return A.mode(table(spark, sf, "lineitem"), ["l_suppkey"], "l_returnflag")


@query("a6_row_union", f"""WITH {S.EMB_CTE}
SELECT vec_id, 'orig' AS variant, {S.rnd('emb[1] + 2 * emb[8]', 9)} AS probe FROM emb
UNION ALL
SELECT vec_id, 'flip', {S.rnd('emb[8] + 2 * emb[1]', 9)} FROM emb""")
def a6_row_union(spark, sf):
    e = emb_view(spark, sf)
    a = e.select("vec_id", F.lit("orig").alias("variant"), F.col("emb").alias("img"))
    b = e.select("vec_id", F.lit("flip").alias("variant"), flip_image("emb").alias("img"))
    u = A.row_union([a, b])
    return u.select("vec_id", "variant", rnd(F.col("img")[0] + 2 * F.col("img")[7], 9)
                    .alias("probe"))


_G_COLS = {"q": "l_quantity / 50.0", "p": "l_extendedprice / 100000.0",
           "d": "l_discount", "t": "l_tax"}


def _gram_sql():
    ks = list(_G_COLS)
    parts = [f"SELECT '{a}' AS col_a, '{b}' AS col_b, {S.rnd(f'avg(({_G_COLS[a]}) * ({_G_COLS[b]}))', 12)} AS value FROM lineitem"
             for a in ks for b in ks]
    return "\nUNION ALL\n".join(parts)


@query("a7_gram", _gram_sql())
def a7_gram(spark, sf):
    li = table(spark, sf, "lineitem").select(*[F.expr(v).alias(k) for k, v in _G_COLS.items()])
    return A.gram_sql(li, list(_G_COLS)).withColumn("value", rnd("value", 12))


@query("a8_agreement", f"""WITH {S.EMB_CTE}
SELECT {S.rnd('avg(CASE WHEN c_rule = label % 3 THEN 1 ELSE 0 END)', 12)} AS share FROM emb""")
def a8_agreement(spark, sf):
    e = emb_view(spark, sf)
    return e.agg(rnd(A.agreement("c_rule", F.pmod("label", F.lit(3))), 12).alias("share"))
