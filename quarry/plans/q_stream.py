"""Registered streaming / source / sink queries."""

from __future__ import annotations

import numpy as np
from pyspark.ml import Pipeline
from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from quarry.functions.hashing import rnd
from quarry.operators.joins import nearest_centroid
from quarry.plans import sqlfrag as S
from quarry.plans.common import CENT_SQL, collect_centroids, label_centroids
from quarry.plans.registry import query
from quarry.session import scratch_path
from quarry.sources import files as FS
from quarry.sources.tables import emb_vectors, emb_view, lp_view, read_table, table
from quarry.streaming import incremental as D

CUSTOMER_SCHEMA = ("c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, "
                   "c_mktsegment STRING")


@query("s1_read_table", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def s1_read_table(spark, sf):
    return read_table(spark, f"{sf}/customer.parquet", "parquet", CUSTOMER_SCHEMA)


@query("s1b_csv_roundtrip", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def s1b_csv_roundtrip(spark, sf):
    path = scratch_path(spark, "customer-csv")
    table(spark, sf, "customer").write.option("header", True).csv(path)
    return read_table(spark, path, "csv", CUSTOMER_SCHEMA)


@query("s2_read_documents", """
SELECT lang AS label, 'document-' || lpad(doc_id::VARCHAR, 12, '0') AS name, strlen(text) + 1 AS length FROM documents""")
def s2_read_documents(spark, sf):
    root = scratch_path(spark, "docs")
    d = table(spark, sf, "documents")
    # one text file per document under <root>/<k>/lang=<lang>/ (label from the folder)
    d = d.select(F.col("lang"), F.col("text"),
                 F.concat(F.lit("document-"), F.lpad(F.col("doc_id").cast("string"), 12, "0"))
                 .alias("fname"))
    FS.write_documents(d, root, "lang", "fname", "text")
    docs = FS.read_documents(spark, root, min_name_len=5, label_from_dir=False)
    return docs.select(F.regexp_extract("path", r"lang=([a-z]+)", 1).alias("label"),
                       F.regexp_extract("path", r"fname=([\w-]+)", 1).alias("name"), "length")


@query("s3_batches")
def s3_batches(spark, sf):
    e = table(spark, sf, "embeddings")
    return FS.with_batches(e, 5, ["vec_id"]).groupBy("batch").agg(F.count(F.lit(1)).alias("n"))


@query("s4_matrix_roundtrip", f"""
SELECT vec_id, {S.rnd('list_sum(list_transform(embedding, lambda x, i: x::DOUBLE * i))', 9)} AS checksum
FROM embeddings""")
def s4_matrix_roundtrip(spark, sf):
    path = scratch_path(spark, "matrix")
    FS.save_matrix(emb_view(spark, sf), path, "vec_id", "emb")
    m = FS.load_matrix(spark, path)
    return m.select("vec_id", rnd(F.aggregate(F.transform("emb", lambda x, i: x * (i + 1)),
                                              F.lit(0.0), lambda a, x: a + x), 9).alias("checksum"))


@query("s5_model_roundtrip")
def s5_model_roundtrip(spark, sf):
    e = emb_vectors(emb_view(spark, sf)).withColumn("label", F.col("c_rule").cast("double"))
    pipe = Pipeline(stages=[DecisionTreeClassifier(maxDepth=4, seed=42)]).fit(e)
    path = scratch_path(spark, "model")
    FS.save_model(pipe, path)
    back = FS.load_model(path)
    a = pipe.transform(e).select("vec_id", F.col("prediction").alias("before"))
    b = back.transform(e).select("vec_id", F.col("prediction").alias("after"))
    return a.join(b, "vec_id")


@query("s6_write_predictions", f"""WITH {CENT_SQL}
SELECT vec_id, e.label AS label, c.label AS prediction, len(emb) AS n_values FROM emb e, cent c
QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY list_distance(emb, centroid), c.label) = 1""")
def s6_write_predictions(spark, sf):
    """Scored rows (nearest label centroid) with their whole vectors, through CSV."""
    e = emb_view(spark, sf)
    labels, cents = collect_centroids(label_centroids(e))
    lab = F.element_at(F.array(*[F.lit(x) for x in labels]), F.col("cluster") + 1)
    scored = nearest_centroid(e, "emb", cents).select("vec_id", "label", lab.alias("prediction"),
                                                      F.col("emb").alias("values"))
    path = scratch_path(spark, "pred-csv")
    FS.write_predictions(scored, path)
    back = spark.read.option("header", True).csv(path)
    return back.select(F.col("vec_id").cast("long"), F.col("label").cast("int"),
                       F.col("prediction").cast("int"),
                       F.size(F.split("values", ";")).cast("long").alias("n_values"))


@query("s7_model_nodes")
def s7_model_nodes(spark, sf):
    e = emb_vectors(emb_view(spark, sf)).withColumn("label", F.col("c_rule").cast("double"))
    m = DecisionTreeClassifier(maxDepth=3, seed=42).fit(e)
    return FS.model_nodes(spark, m, scratch_path(spark, "tree"))


def _stream_input(spark, df, ids, n=4):
    path = scratch_path(spark, "stream-in")
    FS.write_batches(df, path, n, ids)
    back = spark.read.parquet(path)
    # n triggers, however many tasks have written files
    return D.file_stream(spark, path, back.schema, max(1, -(-len(back.inputFiles()) // n)))


@query("d1_online_linear")
def d1_online_linear(spark, sf):
    lp = lp_view(spark, sf).withColumn("is_a", (F.col("l_returnflag") == "A").cast("double"))
    lp = lp.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "y_rule",
                   (F.col("l_quantity") / 50.0).alias("q"), "l_discount",
                   (F.col("p_retailprice") / 1000.0).alias("p"), "is_a")
    stream = _stream_input(spark, lp, ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"])
    stream = VectorAssembler(inputCols=["q", "l_discount", "p", "is_a"],
                             outputCol="features").transform(stream)
    store = D.StateStore(spark, scratch_path(spark, "d1-state"))
    D.online_linear(stream, "features", "y_rule", store, scratch_path(spark, "d1-ckpt"),
                    eta=0.5, steps_per_batch=200)
    return store.history()


@query("d2_minibatch_kmeans")
def d2_minibatch_kmeans(spark, sf):
    from quarry.operators.cluster import kmeans_pp_init
    e = emb_view(spark, sf, planted=True)
    inits = [kmeans_pp_init(e, "emb", "vec_id", 5, seed) for seed in (1, 2, 3)]
    stream = _stream_input(spark, e.select("vec_id", "emb"), ["vec_id"])
    store = D.StateStore(spark, scratch_path(spark, "d2-state"))
    D.minibatch_kmeans(stream, "emb", inits, store, scratch_path(spark, "d2-ckpt"))
    return store.history()


@query("d3_incremental_pca_stream")
def d3_incremental_pca_stream(spark, sf):
    e = emb_view(spark, sf, subspace=True)
    stream = _stream_input(spark, e.select("vec_id", "emb"), ["vec_id"])
    store = D.StateStore(spark, scratch_path(spark, "d3-state"))
    D.incremental_pca_stream(stream, "emb", store, scratch_path(spark, "d3-ckpt"))
    p = D.pca_from_state(store.latest(), 4)
    return spark.createDataFrame([(i + 1, float(v)) for i, v in enumerate(p.explained_variance)],
                                 "axis int, variance double")


@query("d4_running_mean_stream", f"""
SELECT user_id, count(*) AS n, {S.rnd('avg(value)', 9)} AS mean FROM events GROUP BY user_id""")
def d4_running_mean_stream(spark, sf):
    ev = table(spark, sf, "events")
    stream = _stream_input(spark, ev.select("event_id", "user_id", "value"), ["event_id"])
    out = D.running_mean_stream(stream, "user_id", "value", scratch_path(spark, "d4-sink"),
                                scratch_path(spark, "d4-ckpt"))
    return out.select("user_id", "n", rnd("mean", 9).alias("mean"))
