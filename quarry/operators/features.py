"""Feature preparation (X1-X18) as Spark ML Estimators / Transformers.

Statistics are fitted with one aggregation job each (exact medians via
bucketed ranks), stored as Params, and applied as plain column
expressions, so fitted pipelines stay inside whole-stage codegen.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Sequence

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Pipeline, Transformer
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import (OneHotEncoder, StringIndexer, VectorAssembler,
                                VectorSlicer)
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param.shared import (HasInputCols, HasOutputCols, Param, Params,
                                     TypeConverters)
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.functions.arrays import lit_matrix, lit_vector, sq_dist
from quarry.operators.aggregate import mode
from quarry.operators.profile import exact_quantiles


# ---------------------------------------------------------------- X1 / X2 / X3
class _HasStats(Params):
    stats = Param(Params._dummy(), "stats", "fitted statistic per column",
                  typeConverter=TypeConverters.toListString)


class Imputer(Estimator, HasInputCols, HasOutputCols, DefaultParamsReadable,
              DefaultParamsWritable):
    """Fill nulls with the exact mean / median / most frequent value.
    (MLlib's Imputer uses approximate quantiles, so it is not used.)"""

    strategy = Param(Params._dummy(), "strategy",
                     "mean | median | most_frequent | median_approx (opt-in, one pass)",
                     typeConverter=TypeConverters.toString)

    @keyword_only
    def __init__(self, inputCols=None, outputCols=None, strategy="median"):
        super().__init__()
        self._setDefault(strategy="median")
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> "ImputerModel":
        cols = self.getInputCols()
        how = self.getOrDefault(self.strategy)
        if how == "mean":
            row = df.agg(*[F.avg(c).alias(c) for c in cols]).first()
            vals = [row[c] for c in cols]
        elif how == "median":
            long = df.select(F.explode(F.array(*[
                F.struct(F.lit(c).alias("c"), F.col(c).cast("double").alias("v"))
                for c in cols])).alias("r")).select("r.*")
            q = {r["c"]: r["m"] for r in
                 exact_quantiles(long, "v", [0.5], ["c"], ["m"], n_groups=len(cols)).collect()}
            vals = [q.get(c) for c in cols]
        elif how == "median_approx":
            row = df.agg(*[F.percentile_approx(F.col(c).cast("double"), 0.5, 10000).alias(c)
                           for c in cols]).first()
            vals = [row[c] for c in cols]
        elif how == "most_frequent":
            vals = []
            for c in cols:
                r = mode(df.withColumn("_k", F.lit(0)), ["_k"], c).first()
                vals.append(r["mode"] if r else None)
        else:
            raise ValueError(how)
        outs = self.getOutputCols() if self.isSet(self.outputCols) else cols
        return ImputerModel(inputCols=cols, outputCols=outs,
                            stats=[repr(v) if not isinstance(v, str) else "s:" + v
                                   for v in vals])


class ImputerModel(Model, HasInputCols, HasOutputCols, _HasStats, DefaultParamsReadable,
                   DefaultParamsWritable):
    @keyword_only
    def __init__(self, inputCols=None, outputCols=None, stats=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def statistics(self) -> dict:
        out = {}
        for c, s in zip(self.getInputCols(), self.getOrDefault(self.stats)):
            out[c] = s[2:] if s.startswith("s:") else (None if s == "None" else float(s))
        return out

    def _transform(self, df: DataFrame) -> DataFrame:
        st = self.statistics()
        return df.withColumns({o: F.coalesce(F.col(c), F.lit(st[c]))
                               for c, o in zip(self.getInputCols(), self.getOutputCols())})


def fill_median(df: DataFrame, col: str, out: str | None = None) -> DataFrame:
    """fillna(median) on one column."""
    m = Imputer(inputCols=[col], outputCols=[out or col], strategy="median").fit(df)
    return m.transform(df)


# ---------------------------------------------------------------- X4 / X5 / X6
def ordinal_encoder(col: str, out: str) -> StringIndexer:
    """Categories sorted alphabetically -> 0..K-1."""
    return StringIndexer(inputCol=col, outputCol=out, stringOrderType="alphabetAsc",
                         handleInvalid="error")


def one_hot_encoder(col: str, out: str) -> Pipeline:
    """All categories kept (dropLast=False), sorted, unknown -> error."""
    return Pipeline(stages=[
        ordinal_encoder(col, f"{out}_idx"),
        OneHotEncoder(inputCols=[f"{out}_idx"], outputCols=[out], dropLast=False,
                      handleInvalid="error")])


def to_one_hot(label: str, k: int) -> Column:
    """Integer class -> one-hot array<int>."""
    return F.transform(F.sequence(F.lit(0), F.lit(k - 1)),
                       lambda i: (i == F.col(label)).cast("int"))


# ---------------------------------------------------------------- X7 / X8 / X9
class StandardScaler(Estimator, HasInputCols, HasOutputCols, DefaultParamsReadable,
                     DefaultParamsWritable):
    """(x - mean) / population std over named columns, one agg to fit.
    (MLlib's StandardScaler divides by the sample std.)  A zero std leaves
    the centred value unscaled, as the reference's scaler does."""

    withMean = Param(Params._dummy(), "withMean", "centre", typeConverter=TypeConverters.toBoolean)

    @keyword_only
    def __init__(self, inputCols=None, outputCols=None, withMean=True):
        super().__init__()
        self._setDefault(withMean=True)
        self._set(**self._input_kwargs)

    def _fit(self, df):
        cols = self.getInputCols()
        row = df.agg(*[F.avg(c).alias(f"m{i}") for i, c in enumerate(cols)],
                     *[F.stddev_pop(c).alias(f"s{i}") for i, c in enumerate(cols)]).first()
        means = [row[f"m{i}"] for i in range(len(cols))]
        sds = [row[f"s{i}"] for i in range(len(cols))]
        outs = self.getOutputCols() if self.isSet(self.outputCols) else cols
        return StandardScalerModel(inputCols=cols, outputCols=outs,
                                   means=[float(m) for m in means],
                                   scales=[float(s) if s else 1.0 for s in sds],
                                   withMean=self.getOrDefault(self.withMean))


class StandardScalerModel(Model, HasInputCols, HasOutputCols, DefaultParamsReadable,
                          DefaultParamsWritable):
    means = Param(Params._dummy(), "means", "column means", typeConverter=TypeConverters.toListFloat)
    scales = Param(Params._dummy(), "scales", "population std", typeConverter=TypeConverters.toListFloat)
    withMean = Param(Params._dummy(), "withMean", "centre", typeConverter=TypeConverters.toBoolean)

    @keyword_only
    def __init__(self, inputCols=None, outputCols=None, means=None, scales=None, withMean=True):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, df):
        ms, ss = self.getOrDefault(self.means), self.getOrDefault(self.scales)
        wm = self.getOrDefault(self.withMean)
        return df.withColumns({
            o: ((F.col(c) - F.lit(m)) if wm else F.col(c)) / F.lit(s)
            for c, o, m, s in zip(self.getInputCols(), self.getOutputCols(), ms, ss)})

    def inverse(self, df, cols: Sequence[str], outs: Sequence[str]):
        """X * s + m for scaled columns."""
        ms, ss = self.getOrDefault(self.means), self.getOrDefault(self.scales)
        return df.withColumns({o: F.col(c) * F.lit(s) + F.lit(m)
                               for c, o, m, s in zip(cols, outs, ms, ss)})

    def unscale_coefficients(self, coef: Sequence[float], intercept: float):
        """Coefficients of a model fitted on scaled inputs, in raw units."""
        ms, ss = self.getOrDefault(self.means), self.getOrDefault(self.scales)
        w = [c / s for c, s in zip(coef, ss)]
        b = intercept - sum(wi * m for wi, m in zip(w, ms))
        return w, b


def min_max_scale(df: DataFrame, cols: Sequence[str], suffix: str = "_mm") -> DataFrame:
    """(x - min) / (max - min); a constant column maps to 0."""
    row = df.agg(*[F.min(c).alias(f"lo{i}") for i, c in enumerate(cols)],
                 *[F.max(c).alias(f"hi{i}") for i, c in enumerate(cols)]).first()
    out = {}
    for i, c in enumerate(cols):
        lo, hi = row[f"lo{i}"], row[f"hi{i}"]
        rng = (hi - lo) if hi is not None and hi != lo else None
        out[c + suffix] = ((F.col(c) - F.lit(lo)) / F.lit(rng)) if rng else F.lit(0.0)
    return df.withColumns(out)


# ---------------------------------------------------------------- X10 / X11
def polynomial_terms(cols: Sequence[str], degree: int, bias: bool = True):
    """Terms in the reference's order: 1, x, y, x^2, xy, y^2, ..."""
    terms = [((), "1")] if bias else []
    for d in range(1, degree + 1):
        for combo in itertools.combinations_with_replacement(range(len(cols)), d):
            name = " ".join(_pow_name(cols, combo))
            terms.append((combo, name))
    return terms


def _pow_name(cols, combo):
    out = []
    for i in sorted(set(combo)):
        p = combo.count(i)
        out.append(cols[i] if p == 1 else f"{cols[i]}^{p}")
    return out


def polynomial_features(df: DataFrame, cols: Sequence[str], degree: int,
                        bias: bool = True) -> DataFrame:
    """X10 on named columns (product expressions, names like 'x y', 'x^2')."""
    exprs = {}
    for combo, name in polynomial_terms(cols, degree, bias):
        e = F.lit(1.0)
        for i in combo:
            e = e * F.col(cols[i])
        exprs[name] = e
    return df.withColumns(exprs)


def add_bias(df: DataFrame, out: str = "bias") -> DataFrame:
    """X11."""
    return df.withColumn(out, F.lit(1.0))


# ---------------------------------------------------------------- X12
def rbf_landmarks(vec: str, landmarks: Sequence[Sequence[float]], gamma: float) -> Column:
    """[exp(-gamma * ||x - l||^2) for l in landmarks] (literal landmarks)."""
    return F.transform(lit_matrix(landmarks),
                       lambda l: F.exp(-F.lit(gamma) * sq_dist(F.col(vec), l)))


# ---------------------------------------------------------------- X13 / X15
def column_transformer(num_cols: Sequence[str], cat_cols: Sequence[str],
                       ratios: Sequence[str] | None = None, out: str = "features",
                       impute: str = "median") -> Pipeline:
    """Numeric branch (impute -> ratios -> scale) + one-hot branch,
    assembled into one vector with per-slot names in ML attributes."""
    from quarry.operators.columns import RatioFeatures
    stages = []
    num = list(num_cols)
    imp = [f"{c}__imp" for c in num]
    stages.append(Imputer(inputCols=num, outputCols=imp, strategy=impute))
    scaled_in = list(imp)
    if ratios:
        stages.append(RatioFeatures(ratios=list(ratios), addOptional=False))
        scaled_in += [r.split(",")[0] for r in ratios]
    sc = [f"{c}__std" for c in scaled_in]
    stages.append(StandardScaler(inputCols=scaled_in, outputCols=sc))
    oh = []
    for c in cat_cols:
        stages.append(one_hot_encoder(c, f"{c}__oh"))
        oh.append(f"{c}__oh")
    stages.append(VectorAssembler(inputCols=sc + oh, outputCol=out, handleInvalid="keep"))
    return Pipeline(stages=stages)


def feature_names(df: DataFrame, col: str = "features") -> list[str]:
    """Slot names from the assembled vector's ML attribute metadata."""
    meta = df.schema[col].metadata.get("ml_attr", {})
    attrs = meta.get("attrs", {})
    slots = [a for group in attrs.values() for a in group]
    slots.sort(key=lambda a: a["idx"])
    return [a["name"] for a in slots]


# ---------------------------------------------------------------- X14
def top_feature_selector(importances: Sequence[float], k: int, in_col: str = "features",
                         out: str = "selected") -> VectorSlicer:
    """Keep the k most important slots (indices sorted ascending)."""
    idx = sorted(sorted(range(len(importances)), key=lambda i: (-importances[i], i))[:k])
    return VectorSlicer(inputCol=in_col, outputCol=out, indices=idx)


# ---------------------------------------------------------------- X16 / X17
def cluster_distance_features(df: DataFrame, vec: str, centroids, out: str = "cdist",
                              keep: bool = True) -> DataFrame:
    """Distances to the k centroids as an array (replace or extend)."""
    from quarry.operators.joins import centroid_distances
    d = df.withColumn(out, centroid_distances(vec, centroids))
    if keep:
        return d.withColumn(f"{vec}_ext", F.concat(F.col(vec), F.col(out)))
    return d


def vector_quantize(df: DataFrame, vec: str, k: int, seed: int = 42,
                    out: str = "quantized") -> DataFrame:
    """Replace each row by its KMeans centroid (colour quantisation)."""
    from pyspark.ml.functions import array_to_vector
    d = df.withColumn("_v", array_to_vector(F.col(vec)))
    m = KMeans(k=k, seed=seed, featuresCol="_v", predictionCol="_c").fit(d)
    cents = [list(map(float, c)) for c in m.clusterCenters()]
    pred = m.transform(d)
    return pred.withColumn(out, F.element_at(lit_matrix(cents), F.col("_c") + 1)) \
               .drop("_v", "_c")


# ---------------------------------------------------------------- X18
def linear_map(cols: Sequence[str], matrix: Sequence[Sequence[float]],
               names: Sequence[str]) -> dict:
    """[x1..xn] @ R as column expressions (R is n x m, literal)."""
    out = {}
    for j, nm in enumerate(names):
        e = F.lit(0.0)
        for i, c in enumerate(cols):
            e = e + F.col(c) * F.lit(float(matrix[i][j]))
        out[nm] = e
    return out


def rotation(theta: float):
    return [[math.cos(theta), math.sin(theta)], [-math.sin(theta), math.cos(theta)]]
