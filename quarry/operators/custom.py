"""Custom estimator / predictor surface (U1-U6) on pyspark.ml base
classes, so user stages compose with Pipeline, CrossValidator and
save / load like built-in stages."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector
from pyspark.ml.param.shared import (HasFeaturesCol, HasLabelCol, HasPredictionCol,
                                     HasRawPredictionCol, Param, Params, TypeConverters)
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class _SVMParams(HasFeaturesCol, HasLabelCol, HasPredictionCol, HasRawPredictionCol):
    C = Param(Params._dummy(), "C", "inverse regularisation", typeConverter=TypeConverters.toFloat)
    epochs = Param(Params._dummy(), "epochs", "gradient epochs", typeConverter=TypeConverters.toInt)
    eta0 = Param(Params._dummy(), "eta0", "step numerator", typeConverter=TypeConverters.toFloat)
    etaD = Param(Params._dummy(), "etaD", "step denominator offset",
                 typeConverter=TypeConverters.toFloat)


class LinearSVMClassifier(Estimator, _SVMParams, DefaultParamsReadable, DefaultParamsWritable):
    """The reference's hand-written linear SVM as an Estimator (binary
    0/1 label); fit = batch sub-gradient descent, one pass per epoch."""

    @keyword_only
    def __init__(self, featuresCol="features", labelCol="label", predictionCol="prediction",
                 rawPredictionCol="rawPrediction", C=1.0, epochs=50, eta0=1.0, etaD=1000.0):
        super().__init__()
        self._setDefault(C=1.0, epochs=50, eta0=1.0, etaD=1000.0)
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> "LinearSVMModel":
        from quarry.operators.linear import svm_bgd
        fit = svm_bgd(df, self.getFeaturesCol(), self.getLabelCol(), C=self.getOrDefault(self.C),
                      eta0=self.getOrDefault(self.eta0), eta_d=self.getOrDefault(self.etaD),
                      n_epochs=self.getOrDefault(self.epochs))
        m = LinearSVMModel(coef=[float(c) for c in fit.coef], intercept=float(fit.intercept))
        return self._copyValues(m)


class LinearSVMModel(Model, _SVMParams, DefaultParamsReadable, DefaultParamsWritable):
    coef = Param(Params._dummy(), "coef", "weights", typeConverter=TypeConverters.toListFloat)
    intercept = Param(Params._dummy(), "intercept", "bias", typeConverter=TypeConverters.toFloat)

    @keyword_only
    def __init__(self, coef=None, intercept=0.0):
        super().__init__()
        self._set(**self._input_kwargs)

    def decision_function(self, df: DataFrame):
        from quarry.operators.linear import LinearFit
        import numpy as np
        fit = LinearFit(np.array(self.getOrDefault(self.coef)), self.getOrDefault(self.intercept))
        return fit.predict_expr(self.getFeaturesCol())

    def _transform(self, df: DataFrame) -> DataFrame:
        score = self.decision_function(df)

        out = df.withColumn("_s", score)
        return (out.withColumn(self.getRawPredictionCol(), array_to_vector(F.array(-F.col("_s"), F.col("_s"))))
                   .withColumn(self.getPredictionCol(), (F.col("_s") >= 0).cast("double"))
                   .drop("_s"))


class ConstantClassifier(Model, HasPredictionCol, DefaultParamsReadable, DefaultParamsWritable):
    """Predicts one constant class (the reference's "never" baseline)."""
    value = Param(Params._dummy(), "value", "constant prediction",
                  typeConverter=TypeConverters.toFloat)

    @keyword_only
    def __init__(self, value=0.0, predictionCol="prediction"):
        super().__init__()
        self._setDefault(value=0.0)
        self._set(**self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        return df.withColumn(self.getPredictionCol(), F.lit(self.getOrDefault(self.value)))


# ---------------------------------------------------------------- U3 / U4
def apply_rows(fn, returns: str):
    """``fn`` of the values of a row's columns as a column, in Arrow batches;
    null where one of them is."""
    @F.pandas_udf(returns)
    def run(*columns: pd.Series) -> pd.Series:
        return pd.Series([None if any(v is None or v is pd.NA for v in row) else fn(*row) for row in zip(*columns)], dtype=object)
    return run


def apply_arrays(fn, returns: str):
    """U4: ``fn`` of a matrix of rows (one value or array per row) as a column of an
    array column; null arrays, and those of another length than the batch's first,
    are taken apart from the rest."""
    @F.pandas_udf(returns)
    def run(x: pd.Series) -> pd.Series:
        out: list = [None] * len(x)
        sizes: dict[int, list[int]] = {}
        for i, v in enumerate(x):
            if v is not None:
                sizes.setdefault(len(v), []).append(i)
        for at in sizes.values():
            for i, v in zip(at, fn(np.stack([np.asarray(x.iloc[i], float) for i in at]))):
                out[i] = v
        return pd.Series(out, dtype=object)
    return run


# ---------------------------------------------------------------- U5 / U6
def clone(stage, changes: dict | None = None):
    """A copy of an estimator or pipeline; ``changes`` sets parameters by name,
    those of a pipeline's stage as ``<place>__<name>``, nested to any depth."""
    out = stage.copy()
    if hasattr(out, "getStages"):
        out.setStages([s.copy() for s in out.getStages()])
    for name, value in (changes or {}).items():
        owner, path = out, name.split("__")
        for step in path[:-1]:
            owner = owner.getStages()[int(step)]
        owner._set(**{path[-1]: value})
    return out


def merge_aggregate(parts: list[dict]) -> dict:
    """Mergeable states per key ({key: state with ``merge``}) added up."""
    out: dict = {}
    for part in parts:
        for key, state in part.items():
            out[key] = out[key].merge(state) if key in out else state
    return out
