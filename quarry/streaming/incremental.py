"""Incremental models over a stream of micro-batches.

Each ``foreachBatch`` handler computes mergeable statistics of its batch on
the executors (Gram sums, per-cluster sums), updates a small parameter
state on the driver and writes that state to ``<state>/batch_id=<id>`` with
overwrite, so a replayed batch (after a failure) rewrites the same folder:
the sink is idempotent.  The state folder lives under the shared
checkpoint location.
"""

from __future__ import annotations

import json

import numpy as np
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions.arrays import lit_matrix  # noqa: F401
from quarry.operators.aggregate import gram
from quarry.operators.joins import nearest_centroid


class StateStore:
    """Per-batch JSON state rows in Parquet (batch_id partition)."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def save(self, batch_id: int, state: dict) -> None:
        row = [(int(batch_id), json.dumps(state))]
        (self.spark.createDataFrame(row, "batch_id long, state string").coalesce(1)
         .write.mode("overwrite").parquet(f"{self.path}/batch_id={int(batch_id)}"))

    def latest(self, before: int | None = None) -> dict | None:
        try:
            df = self.spark.read.parquet(self.path)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise                    # a state that cannot be read is not "no state"
            return None
        if before is not None:
            df = df.filter(F.col("batch_id") < before)
        r = df.orderBy(F.col("batch_id").desc()).select("state").first()
        return json.loads(r[0]) if r else None

    def history(self) -> DataFrame:
        return self.spark.read.parquet(self.path)


def file_stream(spark: SparkSession, path: str, schema, max_files: int = 1) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).parquet(path)


def _run(stream: DataFrame, handler, checkpoint: str) -> None:
    q = (stream.writeStream.foreachBatch(handler).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()


# ---------------------------------------------------------------- D1
def online_linear(stream: DataFrame, vec: str, label: str, store: StateStore, checkpoint: str,
                  eta: float = 0.1, steps_per_batch: int = 50) -> None:
    """Warm-started linear regression; each batch takes gradient steps on
    its own Gram statistics starting from the previous batch's parameters."""
    def handle(batch: DataFrame, batch_id: int):
        m = gram(batch, vec, label)
        if m is None:
            return
        prev = store.latest(before=batch_id)
        p = len(m.sx)
        th = np.array(prev["theta"]) if prev else np.zeros(p + 1)
        A = np.zeros((p + 1, p + 1))
        A[0, 0], A[0, 1:], A[1:, 0], A[1:, 1:] = m.n, m.sx, m.sx, m.xtx
        b = np.concatenate([[m.sy], m.xty])
        for _ in range(steps_per_batch):
            th = th - eta * 2.0 / m.n * (A @ th - b)
        seen = (prev["n_seen"] if prev else 0) + int(m.n)
        store.save(batch_id, {"theta": th.tolist(), "n_seen": seen})
    _run(stream, handle, checkpoint)


# ---------------------------------------------------------------- D2
def minibatch_kmeans(stream: DataFrame, vec: str, init_centroids, store: StateStore,
                     checkpoint: str) -> None:
    """Mini-batch k-means; a centroid moves toward its batch mean with
    step count_batch / count_total (per-centre learning rate 1 / n_k).

    ``init_centroids`` is one k x d list, or a list of several (n_init runs
    updated side by side on the same batches); the state keeps each run's
    inertia on the latest batch and ``best`` names the lowest."""
    inits = init_centroids if np.asarray(init_centroids, dtype=float).ndim == 3 \
        else [init_centroids]

    def handle(batch: DataFrame, batch_id: int):
        prev = store.latest(before=batch_id)
        runs = prev["runs"] if prev else [{"centroids": c, "counts": [0.0] * len(c)}
                                         for c in inits]
        batch = batch.select(vec).cache()
        out = []
        for run in runs:
            cents = np.array(run["centroids"], dtype=float)
            counts = np.array(run["counts"], dtype=float)
            a = nearest_centroid(batch, vec, cents.tolist())
            dim = cents.shape[1]
            rows = a.groupBy("cluster").agg(
                F.count(F.lit(1)).alias("n"), F.sum(F.col("dist") * F.col("dist")).alias("sse"),
                F.array(*[F.sum(F.col(vec)[i]) for i in range(dim)]).alias("s")).collect()
            inertia = 0.0
            for r in rows:
                j, n = r["cluster"], r["n"]
                counts[j] += n
                cents[j] += (np.array(r["s"]) - n * cents[j]) / counts[j]
                inertia += r["sse"]
            out.append({"centroids": cents.tolist(), "counts": counts.tolist(),
                        "batch_inertia": inertia})
        batch.unpersist()
        best = int(np.argmin([r["batch_inertia"] for r in out]))
        store.save(batch_id, {"runs": out, "best": best, "centroids": out[best]["centroids"],
                              "batch_inertia": out[best]["batch_inertia"]})
    _run(stream, handle, checkpoint)


# ---------------------------------------------------------------- D3
def incremental_pca_stream(stream: DataFrame, vec: str, store: StateStore,
                           checkpoint: str) -> None:
    """D3: merge each batch's Gram statistics into the running total; the
    PCA of the total after the last batch equals the batch PCA exactly.  The
    state holds products about the mean, so values far from zero keep their digits."""
    def handle(batch: DataFrame, batch_id: int):
        m = gram(batch, vec)
        if m is None:
            return
        prev = store.latest(before=batch_id)
        if prev:
            m = _moments(prev).merge(m)
        store.save(batch_id, {"n": float(m.n), "sx": m.sx.tolist(), "cxx": m.cxx.tolist()})
    _run(stream, handle, checkpoint)


def _moments(state: dict):
    from quarry.operators.aggregate import Moments
    sx, cxx = np.array(state["sx"]), np.array(state["cxx"])
    return Moments(state["n"], sx, cxx + np.outer(sx, sx) / state["n"], cxx=cxx)


def pca_from_state(state: dict, k: int):
    from quarry.operators.reduce import pca_from_moments
    return pca_from_moments(_moments(state), k)


# ---------------------------------------------------------------- D4
def running_mean_stream(stream: DataFrame, key: str, value: str, path: str,
                        checkpoint: str) -> DataFrame:
    """Streaming per-key running mean.  Each trigger writes only the keys it
    changed, to its own folder of the sink (a replayed trigger overwrites it);
    the current value of a key is the one of its latest trigger."""
    path = path.rstrip("/")
    agg = stream.groupBy(key).agg(F.count(value).alias("_n"), F.sum(value).alias("_sum"),
                                  F.count(F.lit(1)).alias("n"))

    def handle(batch: DataFrame, batch_id: int):
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={int(batch_id)}")
    q = (agg.writeStream.outputMode("update").foreachBatch(handle)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    latest = stream.sparkSession.read.parquet(path).groupBy(key).agg(
        F.max_by(F.struct("n", "_n", "_sum"), "batch_id").alias("s"))
    return latest.select(key, "s.n", F.try_divide("s._sum", "s._n").alias("mean"))
