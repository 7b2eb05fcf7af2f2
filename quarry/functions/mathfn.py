"""Math column functions (M1-M5, M7)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def sigmoid(x) -> Column:
    """M2: 1 / (1 + exp(-x))."""
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-_c(x)))


def softmax(a) -> Column:
    """M3: softmax of an array, shifted by its max for stability."""
    arr = _c(a)
    mx = F.array_max(arr)
    ex = F.transform(arr, lambda x: F.exp(x - mx))
    tot = F.aggregate(ex, F.lit(0.0), lambda acc, x: acc + x)
    return F.transform(ex, lambda x: x / tot)


def hinge(t) -> Column:
    """M4: max(0, 1 - t)."""
    return F.greatest(F.lit(0.0), F.lit(1.0) - _c(t))


def cross_entropy(prob_of_true, eps: float = 1e-7) -> Column:
    """M5: -mean(log(p_true + eps)) as an aggregate expression."""
    return -F.avg(F.log(_c(prob_of_true) + F.lit(eps)))


def l2_penalty(coef, alpha: float) -> float:
    """M5 (optional L2 term, driver side on a small coefficient vector)."""
    return 0.5 * alpha * sum(float(c) ** 2 for c in coef)


def grid(spark: SparkSession, x_range, y_range, nx: int, ny: int,
         names=("x", "y")) -> DataFrame:
    """M7: nx x ny Cartesian grid to score a model on (spark.range + index
    arithmetic, no cross join)."""
    (x0, x1), (y0, y1) = x_range, y_range
    dx = (x1 - x0) / max(nx - 1, 1)
    dy = (y1 - y0) / max(ny - 1, 1)
    r = spark.range(nx * ny)
    return r.select(F.col("id").alias("cell"),
                    (F.lit(x0) + (F.col("id") % nx) * dx).alias(names[0]),
                    (F.lit(y0) + F.floor(F.col("id") / nx) * dy).alias(names[1]))
