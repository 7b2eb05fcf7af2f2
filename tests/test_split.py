import hashlib
import struct
import zlib

from pyspark.sql import functions as F

from quarry.functions.hashing import crc32_le, md5_last_byte_le
from quarry.operators import split as T
from quarry.operators.window import hash_rank, md5_order


def test_crc32_and_md5_match_python(spark):
    ids = [0, 1, 2, 255, 256, 123456789, 2 ** 40 + 7]
    df = spark.createDataFrame([(i,) for i in ids], "id long")
    rows = df.select("id", crc32_le("id").alias("c"), md5_last_byte_le("id").alias("m")).collect()
    for r in rows:
        b = struct.pack("<q", r["id"])
        assert r["c"] == zlib.crc32(b)
        assert r["m"] == hashlib.md5(b).digest()[-1]


def test_split_random_exact_sizes_disjoint(spark):
    df = spark.range(1003).withColumn("v", F.col("id") * 2)
    train, test = T.split_random(df, 0.2, ["id"])
    a = {r[0] for r in train.select("id").collect()}
    b = {r[0] for r in test.select("id").collect()}
    assert len(b) == 201 and len(a) == 802 and not (a & b) and len(a | b) == 1003


def test_rank_is_partition_invariant(spark):
    base = spark.range(500).withColumn("g", F.col("id") % 3)
    r1 = {tuple(r) for r in hash_rank(base.repartition(1), md5_order(1, "id"), ["id"], ["g"])
          .select("id", "_rank").collect()}
    r17 = {tuple(r) for r in hash_rank(base.repartition(17), md5_order(1, "id"), ["id"], ["g"])
           .select("id", "_rank").collect()}
    assert r1 == r17
    ranks = sorted(r[1] for r in r1)
    assert ranks[0] == 1


def test_stratified_exact_quota(spark):
    df = spark.range(1000).withColumn("s", (F.col("id") % 7).cast("int"))
    out = T.split_stratified(df, ["s"], 0.25, ["id"]).filter("in_test")
    got = dict(out.groupBy("s").count().collect())
    n = dict(df.groupBy("s").count().collect())
    assert got == {k: int(v * 0.25 + 0.5) for k, v in n.items()}


def test_kfold_balanced(spark):
    df = spark.range(100).withColumn("y", (F.col("id") % 2).cast("int"))
    f = T.kfold(df, 5, ["id"], stratify="y")
    counts = sorted(r[1] for r in f.groupBy("fold").count().collect())
    assert counts == [20] * 5


def test_shuffle_split_sizes(spark):
    df = spark.range(300)
    s = T.shuffle_split(df, 4, 50, ["id"])
    assert sorted(r[1] for r in s.groupBy("set_id").count().collect()) == [50] * 4


def test_bootstrap_mean_weight(spark):
    df = spark.range(5000)
    w = T.bootstrap(df, 1, ["id"], 1.0)
    m = w.agg(F.avg("weight")).first()[0]
    assert abs(m - 1.0) < 0.05


def test_empty_and_single_row(spark):
    e = spark.range(0)
    train, test = T.split_random(e, 0.2, ["id"])
    assert train.count() == 0 and test.count() == 0
    one = spark.range(1)
    train, test = T.split_random(one, 0.2, ["id"])
    assert test.count() == 1 and train.count() == 0
