"""Registered profiling queries (P1-P14) with their DuckDB twins."""

from __future__ import annotations

from statistics import NormalDist

from pyspark.sql import functions as F

from quarry.functions.hashing import rnd
from quarry.operators import profile as P
from quarry.operators import split as T
from quarry.plans import sqlfrag as S
from quarry.plans.registry import query
from quarry.sources.tables import lp_view, table

LI_NUM = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query("p1_head", """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority
FROM orders ORDER BY o_orderkey LIMIT 10""")
def p1_head(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus",
                                          "o_totalprice", "o_orderpriority")
    return P.head(o, 10, ["o_orderkey"])


LPN_COLS = [("l_orderkey", "bigint"), ("l_partkey", "bigint"), ("l_suppkey", "bigint"),
            ("l_linenumber", "int"), ("l_quantity", "double"), ("l_extendedprice", "double"),
            ("l_discount", "double"), ("l_tax", "double"), ("l_returnflag", "string"),
            ("l_linestatus", "string"), ("p_brand", "string"), ("p_type", "string"),
            ("p_size", "int"), ("p_retailprice", "double"), ("y_rule", "double")]


def _info_sql():
    parts = [f"""SELECT {i} AS position, '{c}' AS "column", '{t}' AS dtype,
       count({c}) AS non_null, count(*) - count({c}) AS null_count,
       {S.rnd(f"(count(*) - count({c}))::DOUBLE / count(*)", 12)} AS null_frac FROM lpn"""
             for i, (c, t) in enumerate(LPN_COLS)]
    return f"WITH {S.LPN_CTE}\n" + "\nUNION ALL\n".join(parts)


@query("p2_info", _info_sql())
def p2_info(spark, sf):
    df = lp_view(spark, sf, nulls=True).select(*[c for c, _ in LPN_COLS])
    return P.info(df).withColumn("null_frac", rnd("null_frac", 12))


@query("p3_value_counts", f"""
SELECT event_type, count(*) AS count,
       {S.rnd("count(*)::DOUBLE / sum(count(*)) OVER ()", 12)} AS share
FROM events WHERE event_type IS NOT NULL GROUP BY event_type""")
def p3_value_counts(spark, sf):
    return P.value_counts(table(spark, sf, "events"), "event_type") \
        .withColumn("share", rnd("share", 12))


@query("p4_proportions", f"""
SELECT p_brand, count(*) AS count,
       {S.rnd("count(*)::DOUBLE / sum(count(*)) OVER ()", 12)} AS share
FROM part WHERE p_brand IS NOT NULL GROUP BY p_brand""")
def p4_proportions(spark, sf):
    return P.value_counts(table(spark, sf, "part"), "p_brand").withColumn("share", rnd("share", 12))


_P5_SQL = f"""
WITH o AS (SELECT o_orderkey, o_orderpriority FROM orders),
h AS (SELECT * FROM o WHERE ('0x' || substr(md5(from_hex({S.le_hex64('o_orderkey')})), 31, 2))::INTEGER < 51.2),
s AS (SELECT * FROM (
  SELECT *, row_number() OVER (PARTITION BY o_orderpriority
             ORDER BY {S.md5_order(42, 'o_orderkey')}, o_orderkey) AS rk,
         count(*) OVER (PARTITION BY o_orderpriority) AS ns FROM o)
  WHERE rk <= floor(ns * 0.2 + 0.5)),
fo AS (SELECT o_orderpriority, count(*)::DOUBLE / sum(count(*)) OVER () AS overall FROM o GROUP BY 1),
fh AS (SELECT o_orderpriority, count(*)::DOUBLE / sum(count(*)) OVER () AS hash_split FROM h GROUP BY 1),
fs AS (SELECT o_orderpriority, count(*)::DOUBLE / sum(count(*)) OVER () AS stratified FROM s GROUP BY 1)
SELECT coalesce(fo.o_orderpriority, fh.o_orderpriority, fs.o_orderpriority) AS o_orderpriority,
       {S.rnd('overall', 9)} AS overall, {S.rnd('hash_split', 9)} AS hash_split,
       {S.rnd('stratified', 9)} AS stratified,
       {S.rnd('100.0 * hash_split / overall - 100.0', 6)} AS hash_split_err_pct,
       {S.rnd('100.0 * stratified / overall - 100.0', 6)} AS stratified_err_pct
FROM fo FULL OUTER JOIN fh USING (o_orderpriority) FULL OUTER JOIN fs USING (o_orderpriority)"""


@query("p5_compare_proportions", _P5_SQL)
def p5_compare_proportions(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    h = T.split_by_hash(o, "o_orderkey", 0.2, "md5").filter("in_test")
    s = T.split_stratified(o, ["o_orderpriority"], 0.2, ["o_orderkey"]).filter("in_test")
    out = P.compare_proportions(o, {"hash_split": h, "stratified": s}, "o_orderpriority")
    return out.select("o_orderpriority", *[rnd(c, 9).alias(c) for c in
                                           ("overall", "hash_split", "stratified")],
                      *[rnd(c, 6).alias(c) for c in ("hash_split_err_pct", "stratified_err_pct")])


def _describe_sql():
    parts = [f"""SELECT '{c}' AS "column", count({c}) AS count, {S.rnd(f'avg({c})', 6)} AS mean,
  {S.rnd(f'stddev_samp({c})', 6)} AS std, {S.rnd(f'min({c})', 6)} AS min, {S.rnd(f'max({c})', 6)} AS max,
  {S.rnd(f'quantile_cont({c}, 0.25)', 6)} AS p25, {S.rnd(f'quantile_cont({c}, 0.5)', 6)} AS p50,
  {S.rnd(f'quantile_cont({c}, 0.75)', 6)} AS p75 FROM lineitem""" for c in LI_NUM]
    return "\nUNION ALL\n".join(parts)


@query("p6_describe", _describe_sql())
def p6_describe(spark, sf):
    d = P.describe(table(spark, sf, "lineitem"), LI_NUM)
    return d.select("column", "count", *[rnd(c, 6).alias(c) for c in
                                         ("mean", "std", "min", "max", "p25", "p50", "p75")])


@query("p7_histogram", f"""
WITH mm AS (SELECT min(l_extendedprice) AS lo, max(l_extendedprice) AS hi FROM lineitem),
b AS (SELECT least(floor((l_extendedprice - lo) / ((hi - lo) / 10)), 9)::INTEGER AS bin, lo, hi
      FROM lineitem, mm WHERE l_extendedprice IS NOT NULL)
SELECT bin, {S.rnd('any_value(lo) + bin * ((any_value(hi) - any_value(lo)) / 10)', 6)} AS lo,
       {S.rnd('any_value(lo) + (bin + 1) * ((any_value(hi) - any_value(lo)) / 10)', 6)} AS hi,
       count(*) AS count
FROM b GROUP BY bin""")
def p7_histogram(spark, sf):
    h = P.histogram(table(spark, sf, "lineitem"), "l_extendedprice", 10)
    return h.select("bin", rnd("lo", 6).alias("lo"), rnd("hi", 6).alias("hi"), "count")


@query("p8_boxplot", f"""
WITH q AS (SELECT l_returnflag, quantile_cont(l_extendedprice, 0.25) AS q1,
                  quantile_cont(l_extendedprice, 0.5) AS median,
                  quantile_cont(l_extendedprice, 0.75) AS q3 FROM lineitem GROUP BY 1),
j AS (SELECT l.l_returnflag, l_extendedprice AS x, q1, median, q3, q3 - q1 AS iqr,
             l_extendedprice BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) AS inside
      FROM lineitem l JOIN q USING (l_returnflag))
SELECT l_returnflag, {S.rnd('any_value(q1)', 6)} AS q1, {S.rnd('any_value(median)', 6)} AS median,
       {S.rnd('any_value(q3)', 6)} AS q3, {S.rnd('any_value(iqr)', 6)} AS iqr,
       {S.rnd('min(CASE WHEN inside THEN x END)', 6)} AS whisker_lo,
       {S.rnd('max(CASE WHEN inside THEN x END)', 6)} AS whisker_hi,
       sum(CASE WHEN inside THEN 0 ELSE 1 END)::BIGINT AS n_fliers
FROM j GROUP BY l_returnflag""")
def p8_boxplot(spark, sf):
    b = P.boxplot_stats(table(spark, sf, "lineitem"), "l_extendedprice", "l_returnflag")
    return b.select("l_returnflag", *[rnd(c, 6).alias(c) for c in
                                      ("q1", "median", "q3", "iqr", "whisker_lo", "whisker_hi")],
                    "n_fliers")


def _corr_sql():
    parts = []
    for i, a in enumerate(LI_NUM):
        for b in LI_NUM:
            parts.append(f"SELECT '{a}' AS col_a, '{b}' AS col_b, {S.rnd(f'corr({a}, {b})', 9)} AS corr FROM lineitem")
    return "\nUNION ALL\n".join(parts)


@query("p9_corr_matrix", _corr_sql())
def p9_corr_matrix(spark, sf):
    return P.corr_matrix(table(spark, sf, "lineitem"), LI_NUM).withColumn("corr", rnd("corr", 9))


@query("p10_corr_with", "\nUNION ALL\n".join(
    f"SELECT '{c}' AS \"column\", {S.rnd(f'corr({c}, l_extendedprice)', 9)} AS corr FROM lineitem"
    for c in ["l_quantity", "l_discount", "l_tax", "l_linenumber"]))
def p10_corr_with(spark, sf):
    return P.corr_with(table(spark, sf, "lineitem"),
                       ["l_quantity", "l_discount", "l_tax", "l_linenumber"],
                       "l_extendedprice").withColumn("corr", rnd("corr", 9))


@query("p11_scatter_bins", """
SELECT floor(l_quantity / 5.0)::BIGINT AS bx, floor(l_extendedprice / 10000.0)::BIGINT AS by,
       count(*) AS count
FROM lineitem WHERE l_quantity IS NOT NULL AND l_extendedprice IS NOT NULL GROUP BY 1, 2""")
def p11_scatter_bins(spark, sf):
    return P.scatter_bins(table(spark, sf, "lineitem"), "l_quantity", "l_extendedprice",
                          5.0, 10000.0)


@query("p12_percentiles", f"""
SELECT l_returnflag, {S.rnd('quantile_cont(l_extendedprice, 0.1)', 6)} AS p10,
       {S.rnd('quantile_cont(l_extendedprice, 0.5)', 6)} AS p50,
       {S.rnd('quantile_cont(l_extendedprice, 0.9)', 6)} AS p90
FROM lineitem GROUP BY l_returnflag""")
def p12_percentiles(spark, sf):
    q = P.exact_quantiles(table(spark, sf, "lineitem"), "l_extendedprice", [0.1, 0.5, 0.9],
                          ["l_returnflag"])
    return q.select("l_returnflag", *[rnd(c, 6).alias(c) for c in ("p10", "p50", "p90")])


Z95 = NormalDist().inv_cdf(0.975)
_PRED = "3.0 * l_quantity + 200.0 * l_discount + 0.05 * p_retailprice"


@query("p13_conf_interval", f"""
WITH {S.LP_CTE},
e AS (SELECT power(y_rule - ({_PRED}), 2) AS se FROM lp),
a AS (SELECT count(se) AS m, avg(se) AS mse, stddev_samp(se) AS sd FROM e)
SELECT m, {S.rnd('sqrt(mse)', 9)} AS rmse,
       {S.rnd(f'sqrt(greatest(mse - {Z95!r} * sd / sqrt(m::DOUBLE), 0.0))', 9)} AS lo,
       {S.rnd(f'sqrt(mse + {Z95!r} * sd / sqrt(m::DOUBLE))', 9)} AS hi FROM a""")
def p13_conf_interval(spark, sf):
    lp = lp_view(spark, sf)
    e = lp.select(F.pow(F.col("y_rule") - F.expr(_PRED), 2).alias("se"))
    out = P.interval_frame(e, "se", Z95)
    return out.select("m", *[rnd(c, 9).alias(c) for c in ("rmse", "lo", "hi")])


@query("p14_score_summary", f"""
WITH f AS (SELECT o_totalprice,
             (row_number() OVER (ORDER BY {S.md5_order(7, 'o_orderkey')}, o_orderkey) - 1) % 5 AS fold
           FROM orders),
s AS (SELECT fold, avg(o_totalprice) / 1000.0 AS score FROM f GROUP BY fold)
SELECT count(score) AS n, {S.rnd('avg(score)', 9)} AS mean, {S.rnd('stddev_pop(score)', 9)} AS std FROM s""")
def p14_score_summary(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    f = T.kfold(o, 5, ["o_orderkey"], seed=7)
    scores = f.groupBy("fold").agg((F.avg("o_totalprice") / 1000.0).alias("score"))
    s = P.score_summary(scores, "score")
    return s.select("n", rnd("mean", 9).alias("mean"), rnd("std", 9).alias("std"))


@query("p12b_percentiles_approx")
def p12b_percentiles_approx(spark, sf):
    """Opt-in approximate twin of p12 (not compared exactly)."""
    return P.approx_quantiles(table(spark, sf, "lineitem"), "l_extendedprice", [0.1, 0.5, 0.9],
                              ["l_returnflag"])
