"""Findings of round 3: steps that computed their input again, or grew with it."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from quarry.operators import metrics as E
from quarry.operators import selection as G


def counted(spark, df):
    """``df`` and an accumulator of the rows that were computed for it."""
    seen = spark.sparkContext.accumulator(0)

    def run(frames):
        for part in frames:
            seen.add(len(part))
            yield part
    return df.mapInPandas(run, df.schema), seen


def test_search_computes_its_input_once(spark):
    df, seen = counted(spark, spark.range(300, numPartitions=12).select(
        F.col("id").cast("double").alias("x"), (F.col("id") * 3.0 + F.pmod("id", F.lit(7))).alias("y"),
        F.pmod("id", F.lit(3)).cast("int").alias("fold")))
    df = VectorAssembler(inputCols=["x"], outputCol="features").transform(df)
    lr = LinearRegression(labelCol="y")
    ev = RegressionEvaluator(labelCol="y", metricName="rmse")
    maps = G.grid(lr, {"regParam": [0.0, 5.0]})
    model, res = G.grid_search(lr, maps, ev, df, collect_sub_models=True)
    assert seen.value == 300
    want = np.array([G.cross_val_score(lr.copy(m), df, ev, "fold", 3) for m in maps])
    rows = sorted(res.collect(), key=lambda r: r["map_id"])
    assert [r["mean_score"] for r in rows] == pytest.approx(want.mean(axis=1))
    assert [r["std_score"] for r in rows] == pytest.approx(want.std(axis=1))
    assert [r["rank"] for r in rows] == [1, 2] and len(model.subModels) == 3
    with pytest.raises(ValueError):
        G.grid_search(lr, maps, ev, df.withColumn("fold", F.when(F.col("x") > 5, F.col("fold"))))


def test_small_tables_take_few_tasks(spark):
    assert G.stored(spark.range(100, numPartitions=40), "few").rdd.getNumPartitions() == 1


def test_silhouette_of_several_lots(spark, monkeypatch):
    monkeypatch.setattr(E, "LOT_ROWS", 40)
    rng = np.random.default_rng(5)
    x, c = rng.normal(size=(150, 3)), rng.integers(0, 4, 150)
    c[0] = 9                                                              # a cluster of one row
    df = spark.createDataFrame([(i, x[i].tolist(), int(c[i])) for i in range(150)], "id long, v array<double>, g long")
    found = {r["id"]: r["silhouette"] for r in E.silhouette(df, "id", "v", "g", block_rows=16).collect()}
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))
    for i in range(150):
        own = (c == c[i]).sum()
        a = d[i, c == c[i]].sum() / max(own - 1, 1)
        b = min(d[i, c == o].mean() for o in set(c) - {c[i]})
        assert found[i] == pytest.approx(0.0 if own == 1 else (b - a) / max(a, b), abs=1e-9)


def test_silhouette_copies_a_row_once_per_lot(spark):
    """2,000 rows are one lot: before, blocks of 64 rows made 32 copies of each."""
    df = spark.range(2000).select("id", F.array(F.rand(1), F.rand(2)).alias("v"), F.pmod("id", F.lit(3)).alias("g"))
    assert E.silhouette(df, "id", "v", "g", block_rows=64).count() == 2000
    assert E.LOT_ROWS >= 2048


def test_words_between_spaces(spark):
    from quarry.functions import text as TF
    from quarry.operators import text as TX
    texts = ["See HTTP://a.b/c?d, www.x.y\n\tnow 3.5e7!", " a b c--d ", "", None, "Runs running www. http://"]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, t string")
    old = F.lower("t")
    for step in (TF.replace_urls, TF.replace_numbers, TF.strip_punctuation):
        old = step(old)
    want = df.select("id", F.explode(TF.tokens(old)).alias("word")).groupBy("id", "word").count()
    got = TX.word_counts(df, "id", "t")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    assert {r["word"]: r["count"] for r in TX.word_counts(df.where("id = 4"), "id", "t", stemming=True).collect()} \
        == {"run": 2, "www": 1, "http": 1}


def test_stems_and_vocabulary_count_words_once(spark):
    from quarry.operators import text as TX
    counts, seen = counted(spark, spark.createDataFrame([(1, "runs", 2), (1, "run", 1), (2, "dogs", 4)], "id long, word string, count long"))
    assert sorted(map(tuple, TX.stem_counts(counts, "id").collect())) == [(1, "run", 3), (2, "dog", 4)]
    assert seen.value == 3


def test_stream_takes_its_batches_in_n_triggers(spark, tmp_path):
    from quarry.plans.q_stream import _stream_input
    stream = _stream_input(spark, spark.range(400, numPartitions=6), ["id"], n=4)
    sizes = []
    stream.writeStream.foreachBatch(lambda d, _: sizes.append(d.count())).option("checkpointLocation", str(tmp_path)) \
        .trigger(availableNow=True).start().awaitTermination()
    assert len(sizes) == 4 and sum(sizes) == 400
