"""Registered column / predicate queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.functions.hashing import rnd
from quarry.operators import columns as C
from quarry.plans import sqlfrag as S
from quarry.plans.registry import query
from quarry.sources.tables import dl_view, emb_view, lp_view, table

PRICE_EDGES = [0.0, 100000.0, 200000.0, 300000.0, 400000.0, float("inf")]
PRICE_SQL = """CASE WHEN o_totalprice > 0.0 AND o_totalprice <= 100000.0 THEN 1
     WHEN o_totalprice > 100000.0 AND o_totalprice <= 200000.0 THEN 2
     WHEN o_totalprice > 200000.0 AND o_totalprice <= 300000.0 THEN 3
     WHEN o_totalprice > 300000.0 AND o_totalprice <= 400000.0 THEN 4
     WHEN o_totalprice > 400000.0 THEN 5 END"""


def price_cat():
    return C.bucket("o_totalprice", PRICE_EDGES, [1, 2, 3, 4, 5])


@query("f1_select", "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem")
def f1_select(spark, sf):
    return C.select_columns(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber",
                                                          "l_quantity"])


@query("f2_drop", "SELECT o_orderkey, o_custkey, o_totalprice, o_orderpriority FROM orders")
def f2_drop(spark, sf):
    return C.drop_columns(table(spark, sf, "orders"), ["o_orderdate", "o_orderstatus"])


@query("f3_select_numeric", "SELECT c_custkey, c_nationkey, c_acctbal FROM customer")
def f3_select_numeric(spark, sf):
    return C.select_numeric(table(spark, sf, "customer"))


_NULL_COLS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_tax", "p_brand"]


@query("f4_rows_with_any_null", f"""WITH {S.LPN_CTE}
SELECT {', '.join(_NULL_COLS)} FROM lpn WHERE l_tax IS NULL OR p_brand IS NULL""")
def f4_rows_with_any_null(spark, sf):
    d = lp_view(spark, sf, nulls=True).select(*_NULL_COLS)
    return C.rows_with_any_null(d, ["l_tax", "p_brand"])


@query("f5_dropna", f"""WITH {S.LPN_CTE}
SELECT l_returnflag, count(*) AS n, {S.rnd('sum(l_tax)', 6)} AS sum_tax
FROM lpn WHERE l_tax IS NOT NULL AND p_brand IS NOT NULL GROUP BY l_returnflag""")
def f5_dropna(spark, sf):
    d = C.dropna(lp_view(spark, sf, nulls=True), ["l_tax", "p_brand"])
    return d.groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n"),
                                         rnd(F.sum("l_tax"), 6).alias("sum_tax"))


@query("f6_mask_filter", f"""WITH {S.EMB_CTE}
SELECT vec_id, label FROM emb WHERE emb[1] > 0 AND label IN (1, 3, 5) AND NOT (emb[2] < -0.1)""")
def f6_mask_filter(spark, sf):
    e = emb_view(spark, sf)
    cond = (F.col("emb")[0] > 0) & F.col("label").isin(1, 3, 5) & ~(F.col("emb")[1] < -0.1)
    return C.mask_filter(e, cond).select("vec_id", "label")


@query("f7_ratio_features", f"""WITH {S.LP_CTE}
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
  {S.rnd('l_quantity / l_extendedprice * 1000.0', 9)} AS qty_per_kprice,
  {S.rnd('CASE WHEN l_discount = 0 THEN NULL ELSE l_tax / l_discount END', 9)} AS tax_per_discount,
  {S.rnd('CASE WHEN p_size = 0 THEN NULL ELSE p_retailprice / p_size END', 9)} AS price_per_size
FROM lp""")
def f7_ratio_features(spark, sf):
    lp = lp_view(spark, sf)
    rf = C.RatioFeatures(ratios=[["qty_per_price", "l_quantity", "l_extendedprice"],
                                 ["tax_per_discount", "l_tax", "l_discount"]],
                         addOptional=True, optional=["price_per_size", "p_retailprice", "p_size"])
    d = rf.transform(lp)
    return d.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                    rnd(F.col("qty_per_price") * 1000.0, 9).alias("qty_per_kprice"),
                    rnd("tax_per_discount", 9).alias("tax_per_discount"),
                    rnd("price_per_size", 9).alias("price_per_size"))


@query("f8_derived_key", f"""
SELECT c_custkey, {S.rnd('c_nationkey * 1000.0 + c_acctbal', 6)} AS geo_key FROM customer""")
def f8_derived_key(spark, sf):
    c = table(spark, sf, "customer")
    return c.select("c_custkey", rnd(C.derived_key("c_nationkey", "c_acctbal"), 6).alias("geo_key"))


@query("f9_class_targets", """
SELECT vec_id, label = 5 AS is_5, label >= 5 AS ge_5, label % 2 = 1 AS is_odd FROM embeddings""")
def f9_class_targets(spark, sf):
    e = table(spark, sf, "embeddings")
    return e.select("vec_id", *[c.alias(n) for n, c in C.class_targets("label", 5).items()])


@query("f10_cast", """
SELECT o_orderkey, CAST(o_totalprice AS FLOAT) AS price_f32,
       CAST(trunc(o_totalprice) AS BIGINT) AS price_int FROM orders""")
def f10_cast(spark, sf):
    o = table(spark, sf, "orders")
    return o.select("o_orderkey", F.col("o_totalprice").cast("float").alias("price_f32"),
                    F.col("o_totalprice").cast("bigint").alias("price_int"))


@query("f11_bucket", f"SELECT o_orderkey, {PRICE_SQL} AS price_cat FROM orders")
def f11_bucket(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", price_cat().alias("price_cat"))


@query("f12_floor_bucket", """
SELECT c_custkey, floor(c_acctbal / 1000.0) * 1000.0 AS acct_bucket FROM customer""")
def f12_floor_bucket(spark, sf):
    c = table(spark, sf, "customer")
    return c.select("c_custkey", C.floor_bucket("c_acctbal", 1000.0).cast("double")
                    .alias("acct_bucket"))


@query("f13_row_sum", f"""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
       {S.rnd('l_tax + l_discount + l_quantity', 9)} AS row_total FROM lineitem""")
def f13_row_sum(spark, sf):
    li = table(spark, sf, "lineitem")
    return li.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                     rnd(C.row_sum(["l_tax", "l_discount", "l_quantity"]), 9).alias("row_total"))


@query("f14_remap", "SELECT vec_id, label, 9 - label AS mapped FROM embeddings")
def f14_remap(spark, sf):
    e = table(spark, sf, "embeddings")
    return e.select("vec_id", "label", C.remap("label", {i: 9 - i for i in range(10)})
                    .alias("mapped"))


DL_SQL_CTE = """dl AS (
  SELECT d.doc_id, quality, toxic, n_chars,
         len(w)::BIGINT AS n_words, len(list_distinct(w))::BIGINT AS n_distinct,
         CASE WHEN len(w) = 0 THEN NULL ELSE len(list_distinct(w))::DOUBLE / len(w) END
           AS distinct_share
  FROM (SELECT doc_id, n_chars,
               list_filter(string_split_regex(lower(text), '\\s+'), lambda x: x <> '') AS w
        FROM documents) d JOIN labels l ON d.doc_id = l.doc_id)"""


@query("f15_threshold", f"""WITH {DL_SQL_CTE}
SELECT doc_id, distinct_share >= 0.5 AS decision, quality FROM dl""")
def f15_threshold(spark, sf):
    d = dl_view(spark, sf)
    return d.select("doc_id", C.threshold("distinct_share", 0.5).alias("decision"), "quality")
