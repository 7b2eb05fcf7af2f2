"""k-nearest-neighbour models (L15, L16) on top of the exact blocked kNN join."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.operators.joins import knn_join


def knn_classify(train: DataFrame, query: DataFrame, k: int, id_col: str, vec: str,
                 label: str, weights: str = "uniform", classes: Sequence[int] | None = None,
                 block_rows: int = 2048, exclude_self: bool = False) -> DataFrame:
    """Majority (or 1/d-weighted) vote of the k nearest training rows.

    An exact match (d = 0) takes all the weight, as the reference's library
    does.  Ties go to the smallest class.  Returns (qid, prediction, proba
    array over ``classes`` when given).
    """
    nn = knn_join(query, train, k, id_col, vec, exclude_self=exclude_self,
                  block_rows=block_rows)
    lab = train.select(F.col(id_col).cast("long").alias("nid"), F.col(label).alias("_y"))
    j = nn.join(lab, "nid")
    if weights == "distance":
        has_zero = F.max((F.col("dist") == 0).cast("int")).over(Window.partitionBy("qid"))
        w = F.when(has_zero == 1, F.when(F.col("dist") == 0, 1.0).otherwise(0.0)) \
             .otherwise(1.0 / F.col("dist"))
    else:
        w = F.lit(1.0)
    votes = j.withColumn("_w", w).groupBy("qid", "_y").agg(F.sum("_w").alias("_v"))
    tot = votes.groupBy("qid").agg(
        F.min_by(F.col("_y"), F.struct(-F.col("_v"), F.col("_y"))).alias("prediction"),
        F.sum("_v").alias("_tot"),
        F.map_from_entries(F.collect_list(F.struct("_y", "_v"))).alias("_m"))
    if classes is not None:
        tot = tot.withColumn("probability", F.array(*[
            F.coalesce(F.element_at("_m", F.lit(c)), F.lit(0.0)) / F.col("_tot")
            for c in classes]))
    return tot.drop("_m", "_tot")


def knn_multilabel(train: DataFrame, query: DataFrame, k: int, id_col: str, vec: str,
                   targets: str, block_rows: int = 2048, exclude_self: bool = False) -> DataFrame:
    """Multi-label / multi-output kNN: for each target position the most
    common value among the k neighbours (ties: smallest).  ``targets`` is an
    array column (labels or pixel values)."""
    nn = knn_join(query, train, k, id_col, vec, exclude_self=exclude_self, block_rows=block_rows)
    t = train.select(F.col(id_col).cast("long").alias("nid"), F.posexplode(targets)
                     .alias("pos", "val"))
    j = nn.join(t, "nid")
    c = j.groupBy("qid", "pos", "val").agg(F.count(F.lit(1)).alias("_c"))
    best = c.groupBy("qid", "pos").agg(
        F.min_by(F.col("val"), F.struct(-F.col("_c"), F.col("val"))).alias("val"))
    return best.groupBy("qid").agg(F.transform(
        F.array_sort(F.collect_list(F.struct("pos", "val"))), lambda s: s["val"]).alias("prediction"))
