"""Findings of round 3 that were open: what a task reads, holds and computes again."""

from __future__ import annotations

import glob
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.operators import histtrees as H
from quarry.operators import reduce as R
from quarry.operators import selection as G
from quarry.session import checkpoint_dir


def vectors(spark, n=400):
    x = np.random.default_rng(7).normal(size=(n, 3))
    rows = [(i, [float(v) for v in a], float(a[0] + a[1] > 0)) for i, a in enumerate(x)]
    return spark.createDataFrame(rows, "id long, features array<double>, label double").repartition(3), x


def test_f19_kernel_is_mapped_where_it_is_summed(spark):
    df, x = vectors(spark, 2500)
    widest = []

    def fn(m):
        widest.append(len(m))
        return np.exp(-(m @ m[:0].T).sum(1, keepdims=True) - m * m)
    expand = R.in_slices(fn)
    assert np.allclose(expand(x), np.exp(-x * x)) and max(widest) <= R.KERNEL_ROWS
    got = R.pca(df, "features", 2, expand=R.in_slices(lambda m: np.exp(-m * m)))
    want = np.sort(np.linalg.eigvalsh(np.cov(np.exp(-x * x).T)))[::-1][:2]
    assert np.allclose(got.explained_variance, want)


def test_f24_tree_computes_its_input_once(spark):
    df, _ = vectors(spark)
    seen = spark.sparkContext.accumulator(0)

    def run(frames):
        for part in frames:
            seen.add(len(part))
            yield part
    H.best_first_tree(df.mapInPandas(run, df.schema), max_leaf_nodes=4)
    assert seen.value == 400


def test_f25_votes_are_counted_in_the_task(spark):
    df, _ = vectors(spark)
    sets = df.withColumn("s", F.pmod("id", F.lit(5)))
    models = H.keyed_trees(sets, "s", "features", "label", 2, max_leaf_nodes=4)
    odd = df.unionByName(spark.createDataFrame([(900, None, 1.0), (901, [float("nan"), 0.0, 1.0], 0.0)], df.schema))
    each = {r["id"]: r["votes"] for r in H.small_tree_votes(odd, models).collect()}
    counts = {r["id"]: r["votes"] for r in H.small_tree_votes(odd, models, classes=2).collect()}
    assert each[900] is None and counts[900] is None and each[901] is None and counts[901] is None
    for i in range(400):
        assert counts[i] == [each[i].count(0.0), each[i].count(1.0)]


def test_f22_f28_a_plain_copy_takes_full_width(spark):
    df = spark.range(50_000, numPartitions=1).select(F.lit(1.5).alias("a"), F.lit(2.5).alias("b"))
    before = set(glob.glob(checkpoint_dir(spark).removeprefix("file:") + "/scratch/plain-*"))
    back = G.stored(df, "plain", plain=True)
    path, = set(glob.glob(checkpoint_dir(spark).removeprefix("file:") + "/scratch/plain-*")) - before
    assert sum(os.path.getsize(f) for f in glob.glob(path + "/*.parquet")) >= 50_000 * 2 * 8
    assert back.agg(F.sum("a"), F.sum("b")).first() == pytest.approx((75_000.0, 125_000.0))
