"""Table scans and the stand-in views the operators are tested on.

Every view is a lazy DataFrame over a Parquet scan, so Catalyst prunes
columns and pushes filters into the reader.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from quarry.functions.hashing import TWO32, key_text, md5_u32

TABLES = ("region", "nation", "customer", "supplier", "part", "orders",
          "lineitem", "events", "documents", "embeddings", "pages",
          "benchmark", "labels", "conversations")


def read_table(spark: SparkSession, path: str, fmt: str = "parquet",
               schema: StructType | str | None = None, header: bool = True) -> DataFrame:
    """CSV / Parquet / JSON scan with an optional declared schema."""
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    if fmt == "csv":
        reader = reader.option("header", header)
        if schema is None:
            reader = reader.option("inferSchema", True)
        return reader.csv(path)
    return reader.format(fmt).load(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# ---------------------------------------------------------------- LP view
LP_NUMERIC = ("l_quantity", "l_discount", "l_tax", "p_size", "p_retailprice")
LP_CATEGORICAL = ("l_returnflag", "p_brand", "p_type")


def lp_noise(spark_cols=("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")):
    """Uniform noise in [-1, 1) from md5 of the integer columns joined by '|'."""
    return md5_u32(key_text(*spark_cols)) / F.lit(TWO32) * 2.0 - 1.0


def lp_view(spark: SparkSession, sf_dir: str, nulls: bool = False,
            target: bool = True) -> DataFrame:
    """lineitem ⋈ part on partkey (the regression stand-in).

    part is the dimension side; Spark broadcasts it by its own size estimate
    (autoBroadcastJoinThreshold) and falls back to a sort-merge join when it
    grows, so no hint is forced here.
    """
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus")
    pa = table(spark, sf_dir, "part").select(
        "p_partkey", "p_brand", "p_type", "p_size", "p_retailprice")
    df = li.join(pa, li.l_partkey == pa.p_partkey, "inner").drop("p_partkey")
    df = df.withColumn("l_discount", F.col("l_discount") + F.lit(0.0))
    if target:
        df = df.withColumn(
            "y_rule",
            3.0 * F.col("l_quantity") + 200.0 * F.col("l_discount")
            + 0.05 * F.col("p_retailprice")
            + 5.0 * (F.col("l_returnflag") == "A").cast("double") + lp_noise())
    if nulls:
        df = (df.withColumn("l_tax", F.when(F.col("l_orderkey") % 50 == 0, F.lit(None)
                                            .cast("double")).otherwise(F.col("l_tax")))
                .withColumn("p_brand", F.when(F.col("l_partkey") % 40 == 0, F.lit(None)
                                              .cast("string")).otherwise(F.col("p_brand"))))
    return df


# ---------------------------------------------------------------- Emb view
def emb_view(spark: SparkSession, sf_dir: str, planted: bool = False,
             subspace: bool = False) -> DataFrame:
    """embeddings with the vector as array<double> plus the planted targets.

    c_rule   index of the largest of the first three elements (first wins a tie)
    group    vec_id % 5 (planted cluster id, used when planted=True)
    """
    e = table(spark, sf_dir, "embeddings")
    v = F.transform("embedding", lambda x: x.cast("double"))
    df = e.select("vec_id", v.alias("emb"), "label")
    if planted:
        df = df.withColumn("group", F.pmod("vec_id", F.lit(5)).cast("int")).withColumn(
            "emb", F.transform("emb", lambda x, i: x + F.when(i == F.col("group"), 3.0)
                               .otherwise(0.0)))
    if subspace:
        df = df.withColumn("emb", F.transform("emb", lambda x, i: F.when(i < 4, x * 10.0)
                                              .otherwise(x)))
    a0, a1, a2 = (F.col("emb")[i] for i in range(3))
    c_rule = (F.when((a0 >= a1) & (a0 >= a2), 0).when(a1 >= a2, 1).otherwise(2))
    return df.withColumn("c_rule", c_rule.cast("int"))


def emb_vectors(df: DataFrame, col: str = "emb", out: str = "features") -> DataFrame:
    from pyspark.ml.functions import array_to_vector
    return df.withColumn(out, array_to_vector(F.col(col)))


# ---------------------------------------------------------------- DL view
def dl_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents ⋈ labels on doc_id with the word-diversity features."""
    d = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "n_chars")
    lab = table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic")
    words = F.filter(F.split(F.lower(F.col("text")), r"\s+"), lambda w: w != "")
    return (d.join(lab, "doc_id")
             .withColumn("n_words", F.size(words).cast("long"))
             .withColumn("n_distinct", F.size(F.array_distinct(words)).cast("long"))
             .withColumn("distinct_share",
                         F.try_divide(F.col("n_distinct").cast("double"), F.col("n_words")))
             .drop("text"))


# ---------------------------------------------------------------- 2-D plane
def plane_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keyed 2-D points: orders (id=o_orderkey, x=o_totalprice/10000, y=o_custkey/30)."""
    o = table(spark, sf_dir, "orders")
    return o.select(F.col("o_orderkey").alias("id"),
                    (F.col("o_totalprice") / 10000.0).alias("x"),
                    (F.col("o_custkey") / 30.0).alias("y"))
