"""Kernel machines by random features.

A kernel is replaced by the inner product of random features, so the linear
solvers train it in passes over the rows, without a kernel matrix: random
Fourier features for exp(-gamma |x - y|^2), tensor sketches (products of count
sketches, by FFT) for (coef0 + gamma x.y)^degree.  The draws depend on the seed
alone.  With D features the error of a kernel value is of the order of
1 / sqrt(D) (times the largest kernel value, for the polynomial).
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.classification import LinearSVC
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.operators.histtrees import feature_array


@dataclass
class FourierFeatures:
    weights: np.ndarray        # inputs x features
    phase: np.ndarray

    @classmethod
    def draw(cls, inputs: int, features: int, gamma: float, seed: int = 42) -> FourierFeatures:
        rng = np.random.default_rng(seed)
        return cls(rng.normal(size=(inputs, features)) * np.sqrt(2 * gamma), rng.random(features) * 2 * np.pi)

    def rows(self, x: np.ndarray) -> np.ndarray:
        return np.sqrt(2 / len(self.phase)) * np.cos(x @ self.weights + self.phase)


@dataclass
class TensorSketch:
    buckets: np.ndarray        # degree x (inputs + 1)
    signs: np.ndarray
    features: int
    gamma: float
    coef0: float

    @classmethod
    def draw(cls, inputs: int, features: int, degree: int, gamma: float = 1.0, coef0: float = 1.0,
             seed: int = 42) -> TensorSketch:
        rng = np.random.default_rng(seed)
        shape = (degree, inputs + 1)
        return cls(rng.integers(0, features, shape), rng.choice([-1.0, 1.0], shape), features, gamma, coef0)

    def rows(self, x: np.ndarray) -> np.ndarray:
        x = np.concatenate((np.sqrt(self.gamma) * x, np.full((len(x), 1), np.sqrt(self.coef0))), axis=1)
        product = np.ones((len(x), self.features // 2 + 1), complex)
        for bucket, sign in zip(self.buckets, self.signs):
            spread = np.zeros((x.shape[1], self.features))
            spread[np.arange(x.shape[1]), bucket] = sign
            product *= np.fft.rfft(x @ spread, axis=1)
        return np.fft.irfft(product, self.features, axis=1)


def with_features(df: DataFrame, vec: str, drawn: FourierFeatures | TensorSketch, out: str) -> DataFrame:
    """Adds the random features of ``vec`` as a vector; null where an entry is."""
    @F.pandas_udf("array<double>")
    def run(x: pd.Series) -> pd.Series:
        good = [i for i, v in enumerate(x) if v is not None and not np.isnan(np.asarray(v, float)).any()]
        made: list = [None] * len(x)
        if good:
            for i, z in zip(good, drawn.rows(np.stack([np.asarray(x.iloc[i], float) for i in good]))):
                made[i] = z
        return pd.Series(made, index=x.index, dtype=object)
    d = df.withColumn(out, run(feature_array(df, vec)))
    return d.withColumn(out, F.when(F.col(out).isNotNull(), array_to_vector(out)))


def kernel_svc(df: DataFrame, vec: str, label: str, drawn, C: float = 1.0, max_iter: int = 100):
    """Linear SVM on random features (standardised, as the solver settles
    badly on small ones).  Returns (model, drawn); score with
    ``with_features(df, vec, drawn, "z")`` and the model."""
    d = with_features(df, vec, drawn, "z").where(F.col("z").isNotNull() & F.col(label).isNotNull()).cache()
    model = LinearSVC(featuresCol="z", labelCol=label, regParam=1.0 / (C * max(d.count(), 1)), maxIter=max_iter).fit(d)
    d.unpersist()
    return model, drawn


def kernel_svr(df: DataFrame, vec: str, label: str, drawn, epsilon: float = 0.1, C: float = 1.0, **how):
    """Epsilon-insensitive regression on random features; returns the linear fit."""
    from quarry.operators.linear import linear_svr
    d = with_features(df, vec, drawn, "z").where(F.col("z").isNotNull() & F.col(label).isNotNull())
    return linear_svr(d, "z", label, epsilon=epsilon, C=C, **how)
