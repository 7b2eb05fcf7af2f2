"""Registered split / sampling queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.functions.hashing import crc32_le
from quarry.operators import split as T
from quarry.plans import sqlfrag as S
from quarry.plans.q_columns import PRICE_SQL, price_cat
from quarry.plans.registry import query
from quarry.sources.tables import table

LI_ALL = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
          "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]


@query("t1_split_random", """
SELECT 'test' AS part, ceil(count(*) * 0.2)::BIGINT AS n FROM lineitem
UNION ALL SELECT 'train', count(*) - ceil(count(*) * 0.2)::BIGINT FROM lineitem""")
def t1_split_random(spark, sf):
    li = table(spark, sf, "lineitem")
    train, test = T.split_random(li, 0.2, LI_ALL, seed=42)
    return (train.select(F.lit("train").alias("part"))
            .unionByName(test.select(F.lit("test").alias("part")))
            .groupBy("part").agg(F.count(F.lit(1)).alias("n")))


@query("t2_split_crc32")
def t2_split_crc32(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey")
    return T.split_by_hash(o, "o_orderkey", 0.2, "crc32").withColumn(
        "crc", crc32_le("o_orderkey"))


@query("t3_split_md5", f"""
SELECT o_orderkey,
  ('0x' || substr(md5(from_hex({S.le_hex64('o_orderkey')})), 31, 2))::INTEGER < 51.2 AS in_test
FROM orders""")
def t3_split_md5(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey")
    return T.split_by_hash(o, "o_orderkey", 0.2, "md5")


@query("t4_split_stratified", f"""
SELECT o_orderkey, price_cat, rk <= floor(ns * 0.2 + 0.5) AS in_test FROM (
  SELECT o_orderkey, price_cat,
         row_number() OVER (PARTITION BY price_cat ORDER BY {S.md5_order(42, 'o_orderkey')}, o_orderkey) AS rk,
         count(*) OVER (PARTITION BY price_cat) AS ns
  FROM (SELECT o_orderkey, {PRICE_SQL} AS price_cat FROM orders))""")
def t4_split_stratified(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", price_cat().alias("price_cat"))
    return T.split_stratified(o, ["price_cat"], 0.2, ["o_orderkey"], seed=42)


@query("t5_split_ordered", """
SELECT vec_id, row_number() OVER (ORDER BY vec_id) <= 400 AS in_train FROM embeddings""")
def t5_split_ordered(spark, sf):
    e = table(spark, sf, "embeddings").select("vec_id")
    return T.split_ordered(e, "vec_id", 400)


@query("t6_split_three_way", """
WITH n AS (SELECT count(*) AS n FROM embeddings)
SELECT 0 AS part, floor(n * 0.6 + 1e-9)::BIGINT AS n FROM n
UNION ALL SELECT 1, (floor(n * 0.8 + 1e-9) - floor(n * 0.6 + 1e-9))::BIGINT FROM n
UNION ALL SELECT 2, (n - floor(n * 0.8 + 1e-9))::BIGINT FROM n""")
def t6_split_three_way(spark, sf):
    e = table(spark, sf, "embeddings").select("vec_id")
    p = T.split_three_way(e, [0.6, 0.2, 0.2], ["vec_id"])
    return p.groupBy("part").agg(F.count(F.lit(1)).alias("n"))


@query("t7_kfold", f"""
SELECT vec_id, label, ((row_number() OVER (PARTITION BY label
          ORDER BY {S.md5_order(42, 'vec_id')}, vec_id) - 1) % 5)::INTEGER AS fold
FROM embeddings""")
def t7_kfold(spark, sf):
    e = table(spark, sf, "embeddings").select("vec_id", "label")
    return T.kfold(e, 5, ["vec_id"], stratify="label")


@query("t8_shuffle_split")
def t8_shuffle_split(spark, sf):
    e = table(spark, sf, "embeddings").select("vec_id", "label")
    return T.shuffle_split(e, n_sets=20, size=50, ids=["vec_id"])


def _boot_sql():
    thr = T.poisson_thresholds(1.0)
    u = S.md5_uniform("42", "replica", "vec_id")
    w = " + ".join(f"CASE WHEN u >= {t!r} THEN 1 ELSE 0 END" for t in thr)
    return f"""
SELECT vec_id, replica, ({w})::INTEGER AS weight FROM (
  SELECT vec_id, replica, {u} AS u
  FROM embeddings, (SELECT range::INTEGER AS replica FROM range(3)))"""


@query("t9_bootstrap", _boot_sql())
def t9_bootstrap(spark, sf):
    e = table(spark, sf, "embeddings").select("vec_id")
    return T.bootstrap(e, 3, ["vec_id"], 1.0)


@query("t10_sample", f"""
SELECT vec_id FROM embeddings
QUALIFY row_number() OVER (ORDER BY {S.md5_order(42, 'vec_id')}, vec_id) <= 100""")
def t10_sample(spark, sf):
    e = table(spark, sf, "embeddings").select("vec_id")
    return T.sample_without_replacement(e, 100, ["vec_id"])


@query("t11_shuffle", f"""
SELECT vec_id, row_number() OVER (ORDER BY {S.md5_order(42, 'vec_id')}, vec_id) AS pos
FROM embeddings""")
def t11_shuffle(spark, sf):
    e = table(spark, sf, "embeddings").select("vec_id")
    return T.shuffle(e, ["vec_id"])


@query("t12_every_nth", "SELECT vec_id, label FROM embeddings WHERE vec_id % 7 = 0")
def t12_every_nth(spark, sf):
    e = table(spark, sf, "embeddings").select("vec_id", "label")
    return T.every_nth(e, "vec_id", 7)
