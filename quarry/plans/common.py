"""Shared query building blocks (Spark side and SQL twins)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.plans import sqlfrag as S

DIM = 64


def label_centroids(emb: DataFrame, key: str = "label", vec: str = "emb",
                    dim: int = DIM) -> DataFrame:
    """Mean vector per key in ONE agg (dim avg columns, partial aggregation)."""
    return emb.groupBy(key).agg(
        F.array(*[F.avg(F.col(vec)[i]) for i in range(dim)]).alias("centroid"))


def collect_centroids(cent: DataFrame, key: str = "label") -> tuple[list, list]:
    """k x d centroids to the driver (bounded by k, a parameter)."""
    rows = sorted(cent.collect(), key=lambda r: r[key])
    return [r[key] for r in rows], [list(r["centroid"]) for r in rows]


CENT_SQL = f"""{S.EMB_CTE},
cent AS (
  SELECT label, list(m ORDER BY i) AS centroid FROM (
    SELECT label, i, avg(x) AS m FROM (
      SELECT label, unnest(emb) AS x, generate_subscripts(emb, 1) AS i FROM emb)
    GROUP BY label, i)
  GROUP BY label)"""
