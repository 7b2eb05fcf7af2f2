"""Evaluation metrics.

Curves (PR / ROC) aggregate per distinct score first, then take running
sums with ``cumulative`` (value buckets + per-bucket windows): no global
sort, no single-partition window, exact ties.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.operators.window import cumulative, value_bucket
from quarry.session import cut_lineage


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


# ---------------------------------------------------------------- E1 / E2
def regression_metrics(df: DataFrame, y: str, p: str) -> DataFrame:
    err = _c(y) - _c(p)
    return df.agg(F.count(err).alias("n"), F.avg(err * err).alias("mse"),
                  F.sqrt(F.avg(err * err)).alias("rmse"), F.avg(F.abs(err)).alias("mae"))


def accuracy(df: DataFrame, y: str, p: str) -> DataFrame:
    return df.agg(F.avg((_c(y) == _c(p)).cast("double")).alias("accuracy"))


# ---------------------------------------------------------------- E3 / L30
def confusion_matrix(df: DataFrame, y: str, p: str, classes: Sequence[int]) -> DataFrame:
    """Counts for every (true, predicted) pair including zeros, plus the
    row-normalised share with a zeroed diagonal.  The K x K pair grid comes
    from a literal (K is the class count, a parameter), not a join of data."""
    counts = df.groupBy(_c(y).alias("y"), _c(p).alias("p")).agg(
        F.count(F.lit(1)).alias("count"))
    spark = df.sparkSession
    pairs = spark.range(1).select(F.explode(F.array(*[
        F.struct(F.lit(a).alias("y"), F.lit(b).alias("p")) for a in classes for b in classes]))
        .alias("s")).select("s.*")
    full = pairs.join(counts, ["y", "p"], "left").fillna(0, ["count"])
    rowtot = F.sum("count").over(Window.partitionBy("y"))
    return full.withColumn("row_share", F.when(F.col("y") == F.col("p"), F.lit(0.0))
                           .otherwise(F.try_divide(F.col("count").cast("double"), rowtot)))


def error_rows(df: DataFrame, y: str, p: str, true_class, pred_class) -> DataFrame:
    """The rows of one (true, predicted) cell."""
    return df.filter((_c(y) == true_class) & (_c(p) == pred_class))


# ---------------------------------------------------------------- E4 / E5
def binary_prf(df: DataFrame, y, p, group: Sequence[str] = ()) -> DataFrame:
    """Precision, recall, F1 of a binary prediction (0/0 -> 0)."""
    yv, pv = _c(y).cast("int"), _c(p).cast("int")
    tp = F.sum(yv * pv)
    fp = F.sum((1 - yv) * pv)
    fn = F.sum(yv * (1 - pv))
    a = df.groupBy(*group).agg(tp.alias("tp"), fp.alias("fp"), fn.alias("fn"))
    prec = F.coalesce(F.try_divide(F.col("tp").cast("double"), F.col("tp") + F.col("fp")),
                      F.lit(0.0))
    rec = F.coalesce(F.try_divide(F.col("tp").cast("double"), F.col("tp") + F.col("fn")),
                     F.lit(0.0))
    a = a.withColumn("precision", prec).withColumn("recall", rec)
    f1 = F.coalesce(F.try_divide(2 * F.col("precision") * F.col("recall"),
                                 F.col("precision") + F.col("recall")), F.lit(0.0))
    return a.withColumn("f1", f1)


def macro_f1(df: DataFrame, ys: Sequence[str], ps: Sequence[str]) -> DataFrame:
    """E5: average of per-label F1 (labels as columns -> long form)."""
    long = df.select(F.explode(F.array(*[
        F.struct(F.lit(i).alias("k"), _c(y).cast("int").alias("y"), _c(p).cast("int").alias("p"))
        for i, (y, p) in enumerate(zip(ys, ps))])).alias("r")).select("r.*")
    per = binary_prf(long, "y", "p", ["k"])
    return per.agg(F.avg("f1").alias("macro_f1"))


# ---------------------------------------------------------------- E6 / E8
def score_curve(df: DataFrame, score: str, label: str, n_buckets: int = 1024) -> DataFrame:
    """Per distinct score (descending): counts at the score and cumulative
    tp / fp for 'predict positive when score >= threshold'."""
    g = df.groupBy(F.col(score).alias("threshold")).agg(
        F.sum(_c(label).cast("long")).alias("pos_at"),
        F.sum((1 - _c(label).cast("long"))).alias("neg_at"))
    # the buckets look at the scores several times: make them once
    g = cut_lineage(g)
    g = value_bucket(g, "threshold", n_buckets, descending=True)
    c = cumulative(g, "_vb", [F.col("threshold").desc()],
                   {"tp": F.col("pos_at"), "fp": F.col("neg_at")}, totals=True,
                   max_buckets=n_buckets)
    return c.withColumnRenamed("tp_total", "P").withColumnRenamed("fp_total", "N").drop("_vb")


def precision_recall_curve(df: DataFrame, score: str, label: str) -> DataFrame:
    """(threshold, precision, recall) per distinct score + the (1, 0) end
    point with a NULL threshold."""
    c = score_curve(df, score, label)
    pr = c.select("threshold", (F.col("tp") / (F.col("tp") + F.col("fp"))).alias("precision"),
                  F.try_divide(F.col("tp").cast("double"), F.col("P")).alias("recall"))
    end = df.sparkSession.range(1).select(F.lit(None).cast("double").alias("threshold"),
                                          F.lit(1.0).alias("precision"),
                                          F.lit(0.0).alias("recall"))
    return pr.unionByName(end)


def threshold_for_precision(df: DataFrame, score: str, label: str, target: float) -> DataFrame:
    """Lowest threshold whose precision reaches ``target``."""
    pr = precision_recall_curve(df, score, label).filter(F.col("threshold").isNotNull())
    return pr.filter(F.col("precision") >= target).agg(
        F.min_by(F.struct("threshold", "precision", "recall"), F.col("threshold")).alias("b")
    ).select("b.threshold", "b.precision", "b.recall")


def roc_curve(df: DataFrame, score: str, label: str) -> DataFrame:
    """(threshold, fpr, tpr) per distinct score + the (0, 0) start point."""
    c = score_curve(df, score, label)
    roc = c.select("threshold", F.try_divide(F.col("fp").cast("double"), F.col("N")).alias("fpr"),
                   F.try_divide(F.col("tp").cast("double"), F.col("P")).alias("tpr"))
    start = df.sparkSession.range(1).select(F.lit(None).cast("double").alias("threshold"),
                                            F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"))
    return roc.unionByName(start)


def roc_auc(df: DataFrame, score: str, label: str) -> DataFrame:
    """Trapezoid area; each distinct score is one segment, so tied
    scores are averaged.  The previous point is (tp - pos_at, fp - neg_at):
    no lag, no ordering needed for the sum."""
    c = score_curve(df, score, label)
    seg = ((F.col("fp") - (F.col("fp") - F.col("neg_at"))) / F.col("N")) * \
        ((F.col("tp") + (F.col("tp") - F.col("pos_at"))) / (2.0 * F.col("P")))
    return c.agg(F.sum(seg).alias("auc"))


# ---------------------------------------------------------------- E10
def inertia(df: DataFrame, dist: str) -> DataFrame:
    """Sum of squared distances to the assigned centroid; score = -inertia."""
    return df.agg(F.sum(_c(dist) * _c(dist)).alias("inertia")).withColumn(
        "score", -F.col("inertia"))


# ---------------------------------------------------------------- E11
#: Rows that meet as many others in one group of the silhouette.
LOT_ROWS = 1 << 14


def silhouette(df: DataFrame, id_col: str, vec: str, cluster: str,
               block_rows: int = 2048) -> DataFrame:
    """Euclidean silhouette per row.

    Every pair is measured, once: the rows lie in lots, a group holds two lots
    (or one twice) and takes the distances of ``block_rows`` rows at a time (2
    million distances at most) into sums per (row, cluster) of both sides, so
    the n^2 pairs never leave a group and a row is copied once per lot.
    """
    lots = max(1, math.ceil(df.count() / LOT_ROWS))
    base = df.select(F.col(id_col).cast("long").alias("rid"), F.col(vec).alias("v"),
                     F.col(cluster).cast("long").alias("c"))
    met = base.withColumn("lot", F.pmod(F.xxhash64("rid"), F.lit(lots)).cast("int")) \
        .withColumn("o", F.explode(F.sequence(F.lit(0), F.lit(lots - 1)))) \
        .withColumn("p", F.least("lot", "o")).withColumn("q", F.greatest("lot", "o"))

    def lot(group: pa.Table, number: int):
        """(ids, vectors, clusters, first row of each cluster) by cluster."""
        own = group.filter(pc.equal(group.column("lot"), number)).sort_by("c")
        if own.column("v").null_count or own.column("c").null_count:
            raise ValueError("NULL vector or cluster in a silhouette")
        x = own.column("v").combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.float64)
        c = own.column("c").to_numpy()
        return own.column("rid"), x.reshape(len(own), -1), *np.unique(c, return_index=True)

    def sums(rid, totals, clusters, first, rows):
        n = np.diff(np.append(first, rows))
        out = pa.table({"rid": pa.concat_arrays(rid.chunks * len(clusters)) if len(rid) else pa.array([], pa.int64()),
                        "oc": np.repeat(clusters, len(rid)), "s": totals.T.ravel(), "n": np.repeat(n, len(rid))})
        return out.filter(pc.is_valid(out.column("rid")))

    def pairs(group: pa.Table) -> pa.Table:
        p, q = group.column("p")[0].as_py(), group.column("q")[0].as_py()
        rid_a, A, clusters_a, first_a = lot(group, p)
        rid_b, B, clusters_b, first_b = (rid_a, A, clusters_a, first_a) if p == q else lot(group, q)
        if len(A) == 0 or len(B) == 0:
            return pa.schema([("rid", pa.int64()), ("oc", pa.int64()), ("s", pa.float64()), ("n", pa.int64())]).empty_table()
        ids_a, ids_b = (pc.fill_null(r, -2 ** 63).to_numpy() for r in (rid_a, rid_b))     # sums of a NULL id are dropped
        aa, bb = (A * A).sum(1), (B * B).sum(1)
        of_a, of_b = np.zeros((len(A), len(clusters_b))), np.zeros((len(clusters_a), len(B)))
        step = max(1, min(block_rows, 2_000_000 // len(B)))
        place = np.searchsorted(first_a, np.arange(len(A)), "right") - 1       # cluster of each row
        for at in range(0, len(A), step):
            D = A[at:at + step] @ B.T
            D *= -2.0
            D += aa[at:at + step, None]
            D += bb
            np.sqrt(np.maximum(D, 0.0, out=D), out=D)
            if p == q:
                D[ids_a[at:at + step, None] == ids_b] = 0.0
            of_a[at:at + step] = np.add.reduceat(D, first_b, axis=1)
            if p != q:
                there, start = np.unique(place[at:at + step], return_index=True)
                of_b[there] += np.add.reduceat(D, start, axis=0)
        found = sums(rid_a, of_a, clusters_b, first_b, len(B))
        return found if p == q else pa.concat_tables([found, sums(rid_b, of_b.T, clusters_a, first_a, len(A))])

    part = met.select("p", "q", "lot", "rid", "v", "c").groupBy("p", "q").applyInArrow(
        pairs, "rid long, oc long, s double, n long")
    per = part.groupBy("rid", "oc").agg(F.sum("s").alias("s"), F.sum("n").alias("n"))
    j = per.join(base.select("rid", "c"), "rid")
    own = F.when(F.col("oc") == F.col("c"), F.try_divide(F.col("s"), F.col("n") - 1))
    other = F.when(F.col("oc") != F.col("c"), F.col("s") / F.col("n"))
    r = j.groupBy("rid", "c").agg(F.max(own).alias("a"), F.min(other).alias("b"),
                                  F.max(F.when(F.col("oc") == F.col("c"), F.col("n")))
                                  .alias("n_own"))
    s = F.when((F.col("n_own") <= 1) | F.col("b").isNull(), F.lit(0.0)).otherwise(
        (F.col("b") - F.col("a")) / F.greatest(F.col("a"), F.col("b")))
    return r.select(F.col("rid").alias(id_col), F.col("c").alias(cluster), s.alias("silhouette"))


# ---------------------------------------------------------------- E14 / E15
def reconstruction_error(x, x_hat) -> Column:
    """Mean squared error per row between two arrays."""
    d = F.zip_with(_c(x), _c(x_hat), lambda a, b: (a - b) * (a - b))
    return F.aggregate(d, F.lit(0.0), lambda acc, v: acc + v) / F.size(_c(x))


def majority_mapping_agreement(df: DataFrame, cluster: str, label: str) -> DataFrame:
    """Map each cluster to its most common label (ties: smallest), then
    the share of rows whose label equals their cluster's label."""
    from quarry.operators.aggregate import mode
    m = mode(df, [cluster], label, "mapped")
    j = df.join(m.select(cluster, "mapped"), cluster)
    return j.agg(F.avg((F.col(label) == F.col("mapped")).cast("double")).alias("agreement"))
