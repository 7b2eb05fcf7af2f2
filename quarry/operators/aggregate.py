"""Aggregation, distinct and set operations.

Every aggregate here is decomposable (partial on each task, merged after
the shuffle), including mode (count per (key, value) first) and the Gram
statistics (per-batch partial matrices summed per element).
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def group_mean(df: DataFrame, keys: Sequence[str], target: str, out: str = "mean") -> DataFrame:
    """A1: mean per group; null keys are dropped (pandas groupby default)."""
    d = df.dropna(subset=list(keys))
    return d.groupBy(*keys).agg(F.avg(target).alias(out))


def scalar_aggregates(df: DataFrame, col: str, id_col: str) -> DataFrame:
    """A2: sum, mean, std, min, max and the ids of the first max / min."""
    x = F.col(col)
    return df.agg(F.sum(x).alias("sum"), F.avg(x).alias("mean"), F.stddev_samp(x).alias("std"),
                  F.min(x).alias("min"), F.max(x).alias("max"),
                  F.max_by(F.col(id_col), F.struct(x, -F.col(id_col))).alias("argmax"),
                  F.min_by(F.col(id_col), F.struct(x, F.col(id_col))).alias("argmin"))


def distinct_values(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """A3."""
    return df.select(*cols).distinct()


def mode(df: DataFrame, keys: Sequence[str], value: str, out: str = "mode") -> DataFrame:
    """A4: most frequent value per key, smallest value wins a tie.  Counting
    (key, value) first makes the hot-key case a partial aggregate."""
    c = df.filter(F.col(value).isNotNull()).groupBy(*keys, value).agg(
        F.count(F.lit(1)).alias("_c"))
    return c.groupBy(*keys).agg(
        F.min_by(F.col(value), F.struct(-F.col("_c"), F.col(value))).alias(out),
        F.max("_c").alias(f"{out}_count"))


def capped_sum(df: DataFrame, keys: Sequence[str], count_col: str, cap: int,
               out: str = "total") -> DataFrame:
    """A5: sum(min(count, cap)) per key."""
    return df.groupBy(*keys).agg(F.sum(F.least(F.col(count_col), F.lit(cap))).alias(out))


def row_union(dfs: Sequence[DataFrame]) -> DataFrame:
    """Row concatenation by column name."""
    return reduce(lambda a, b: a.unionByName(b), dfs)


def agreement(a, b) -> Column:
    """Share of rows where a == b (nulls count as disagreement)."""
    ca = F.col(a) if isinstance(a, str) else a
    cb = F.col(b) if isinstance(b, str) else b
    return F.avg(F.coalesce((ca == cb).cast("int"), F.lit(0)))


# ---------------------------------------------------------------- A7
def gram_sql(df: DataFrame, cols: Sequence[str], mean: bool = True) -> DataFrame:
    """A7 (few columns): all sum(x_i * x_j) in ONE agg, long form."""
    cols = list(cols)
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i:]]
    f = F.avg if mean else F.sum
    one = df.agg(*[f(F.col(a) * F.col(b)).alias(f"g{k}") for k, (a, b) in enumerate(pairs)])
    s = []
    for k, (a, b) in enumerate(pairs):
        s.append(F.struct(F.lit(a).alias("col_a"), F.lit(b).alias("col_b"),
                          F.col(f"g{k}").alias("value")))
        if a != b:
            s.append(F.struct(F.lit(b).alias("col_a"), F.lit(a).alias("col_b"),
                              F.col(f"g{k}").alias("value")))
    return one.select(F.explode(F.array(*s)).alias("r")).select("r.*")


class Moments:
    """Mergeable sufficient statistics of [X | y] (weights optional).  ``cxx``
    holds the sums of products about the mean, merged pairwise, so covariances
    do not cancel when values are far from zero."""

    def __init__(self, n, sx, xtx, sy=0.0, syy=0.0, xty=None, cxx=None):
        self.n, self.sx, self.xtx = n, sx, xtx
        self.sy, self.syy = sy, syy
        self.xty = xty if xty is not None else np.zeros_like(sx)
        self.cxx = cxx if cxx is not None else xtx - np.outer(sx, sx) / n

    @property
    def mean(self):
        return self.sx / self.n

    def cov(self, ddof: int = 1):
        return self.cxx / (self.n - ddof)

    def merge(self, o: "Moments") -> "Moments":
        gap = self.mean - o.mean
        cxx = self.cxx + o.cxx + np.outer(gap, gap) * (self.n * o.n / (self.n + o.n))
        return Moments(self.n + o.n, self.sx + o.sx, self.xtx + o.xtx, self.sy + o.sy,
                       self.syy + o.syy, self.xty + o.xty, cxx)


def _as_dense(v) -> np.ndarray:
    if hasattr(v, "toArray"):
        return v.toArray()
    if isinstance(v, dict):      # VectorUDT as it arrives through Arrow
        if v.get("type") == 1:
            return np.asarray(v["values"], dtype=np.float64)
        out = np.zeros(int(v["size"]))
        out[np.asarray(v["indices"], dtype=np.int64)] = np.asarray(v["values"], dtype=np.float64)
        return out
    return np.asarray(v, dtype=np.float64)


def _vec_matrix(s: pd.Series) -> np.ndarray:
    if len(s) == 0:
        return np.zeros((0, 0))
    return np.stack([_as_dense(v) for v in s])


def vector_width(df: DataFrame, vec: str) -> int:
    """Length of a vector / array column (ML metadata, else the first row)."""
    from pyspark.ml.functions import vector_to_array
    from pyspark.ml.linalg import VectorUDT
    meta = df.schema[vec].metadata.get("ml_attr", {})
    if "num_attrs" in meta:
        return int(meta["num_attrs"])
    c = vector_to_array(F.col(vec)) if isinstance(df.schema[vec].dataType, VectorUDT) else F.col(vec)
    r = df.select(F.size(c)).first()
    return int(r[0]) if r else 0


def expand_vector(df: DataFrame, vec: str, prefix: str = "_x") -> tuple[DataFrame, list[str]]:
    """Vector / array column -> one double column per slot, so Arrow ships a
    plain columnar batch and numpy gets it without per-row conversion."""
    from pyspark.ml.functions import vector_to_array
    from pyspark.ml.linalg import VectorUDT
    d = vector_width(df, vec)
    c = vector_to_array(F.col(vec)) if isinstance(df.schema[vec].dataType, VectorUDT) else F.col(vec)
    names = [f"{prefix}{i}" for i in range(d)]
    return df.select("*", *[c[i].cast("double").alias(n) for i, n in enumerate(names)]), names


def complete_rows(df: DataFrame, vec: str, *cols: str) -> DataFrame:
    """Rows whose vector and other columns hold no NULL and no NaN."""
    from pyspark.ml.functions import vector_to_array
    from pyspark.ml.linalg import VectorUDT
    x = F.col(vec)
    if isinstance(df.schema[vec].dataType, VectorUDT):
        x = vector_to_array(x)
    good = F.col(vec).isNotNull() & F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v.cast("double")))
    for c in cols:
        good = good & F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double"))
    return df.where(F.coalesce(good, F.lit(False)))


def gram(df: DataFrame, vec: str, label: str | None = None, weight: str | None = None,
         group: str | None = None, expand=None) -> dict:
    """A7 (vectors): X'X, X'y, sums and counts in one distributed pass.

    A row with a NULL or NaN in its vector, label or weight (or a NULL group)
    takes no part in any statistic.  Sums are taken about one row of the table,
    so covariances keep their digits.  Each task emits its partial statistics
    in long form (entry index, value); a groupBy-sum merges them on the
    executors and only the d x d result reaches the driver.  With ``group``
    (whole numbers) returns {group: Moments}.  ``expand`` maps a matrix of array
    rows to the features whose statistics are wanted, in the worker of the pass.
    """
    from pyspark.ml.linalg import VectorUDT
    base = complete_rows(df.select(vec, *[c for c in (label, weight, group) if c]), vec,
                         *[c for c in (label, weight) if c])
    if group:
        if df.schema[group].dataType.typeName() not in ("byte", "short", "integer", "long", "boolean"):
            raise ValueError(f"group column {group} must hold whole numbers")
        base = base.where(F.col(group).isNotNull()).withColumn(group, F.col(group).cast("long"))
    head = base.select(vec).first()
    if head is None:
        return {} if group else None
    pivot = _as_dense(head[0])
    expand = expand or (lambda X: X)
    pivot = expand(pivot[None])[0]
    if isinstance(df.schema[vec].dataType, VectorUDT):
        # ML vectors arrive through Arrow as structs (one dict per row):
        # expand to one column per slot instead
        wide, xs = expand_vector(base, vec)
        d_ = wide.select(*xs, *[c for c in (label, weight, group) if c])
    else:                       # array<double>: numpy arrays per row, stacked
        xs, d_ = None, base

    def part(it):
        acc = {}
        for pdf in it:
            if len(pdf) == 0:
                continue
            keys = pdf[group].to_numpy() if group else np.zeros(len(pdf), dtype=np.int64)
            X_all = expand(pdf[xs].to_numpy(dtype=np.float64) if xs else _vec_matrix(pdf[vec])) - pivot
            y_all = pdf[label].to_numpy(dtype=np.float64) if label else np.zeros(len(pdf))
            w_all = pdf[weight].to_numpy(dtype=np.float64) if weight else np.ones(len(pdf))
            for g in np.unique(keys):
                m = keys == g
                X, y, w = X_all[m], y_all[m], w_all[m]
                Xw = X * w[:, None]
                stats = np.concatenate([[w.sum(), (w * y).sum(), (w * y * y).sum()],
                                        Xw.sum(0), (Xw.T @ X).ravel(), Xw.T @ y])
                acc[g] = acc.get(g, 0) + stats
        for g, stats in acc.items():
            yield pd.DataFrame({"g": np.full(len(stats), g, dtype=np.int64),
                                "i": np.arange(len(stats), dtype=np.int32), "v": stats})

    long = d_.mapInPandas(part, schema="g long, i int, v double")
    merged = long.groupBy("g", "i").agg(F.sum("v").alias("v"), F.count("v").alias("c"),
                                        F.count("*").alias("rows")).toPandas()
    if (merged["c"] != merged["rows"]).any() or merged["v"].isna().any():
        raise ValueError("a partial statistic is not a number")
    out, p = {}, len(pivot)
    for g, sub in merged.groupby("g"):
        v = sub.sort_values("i")["v"].to_numpy()
        n, sy, syy = v[0], v[1], v[2]
        dx, dxx, dxy = v[3:3 + p], v[3 + p:3 + p + p * p].reshape(p, p), v[3 + p + p * p:]
        cxx = dxx - np.outer(dx, dx) / n if n else dxx
        cross = np.outer(dx, pivot)
        out[int(g)] = Moments(n, dx + n * pivot, dxx + cross + cross.T + n * np.outer(pivot, pivot),
                              sy, syy, dxy + pivot * sy, cxx)
    return out if group else out.get(0)
