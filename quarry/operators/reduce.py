"""Dimensionality reduction.

Covariances come from ONE Gram pass (mergeable, so batch-wise / streaming
fits are exact); eigen-decompositions are p x p on the driver; projections
run on the executors as Arrow-batched pandas UDFs (matrix products per
batch).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

from quarry.operators.aggregate import Moments, _vec_matrix, complete_rows, gram


@dataclass
class PCAModel:
    mean: np.ndarray
    components: np.ndarray          # k x d, rows are axes
    explained_variance: np.ndarray  # k
    total_variance: float

    @property
    def explained_variance_ratio(self):
        return self.explained_variance / self.total_variance


def _sign_fix(vecs: np.ndarray) -> np.ndarray:
    """Largest-magnitude entry of every axis made positive (stable signs)."""
    idx = np.argmax(np.abs(vecs), axis=1)
    s = np.sign(vecs[np.arange(len(vecs)), idx])
    s[s == 0] = 1
    return vecs * s[:, None]


def pca_from_moments(m: Moments, k: int | None = None, variance: float | None = None) -> PCAModel:
    cov = m.cov(ddof=1)
    vals, vecs = np.linalg.eigh(cov)
    order = np.argsort(vals)[::-1]
    vals, vecs = np.maximum(vals[order], 0.0), vecs[:, order].T
    total = float(vals.sum())
    if variance is not None:
        k = n_components_for(vals / total, variance)
    k = k or len(vals)
    return PCAModel(m.mean, _sign_fix(vecs[:k]), vals[:k], total)


def n_components_for(ratios: Sequence[float], target: float) -> int:
    """Smallest d with cumulative explained variance >= target."""
    cum = np.cumsum(ratios)
    return int(np.searchsorted(cum, target - 1e-12) + 1)


def pca(df: DataFrame, vec: str, k: int | None = None, variance: float | None = None, expand=None) -> PCAModel:
    """Centred PCA (MLlib's PCA.transform does not centre), of the vectors
    or of what ``expand`` makes of a matrix of them."""
    return pca_from_moments(gram(df, vec, expand=expand), k, variance)


def incremental_pca(df: DataFrame, vec: str, batch_col: str, k: int) -> PCAModel:
    """Statistics per batch merged in batch order; exact, equal to R1."""
    per = gram(df, vec, group=batch_col)
    tot = None
    for b in sorted(per):
        tot = per[b] if tot is None else tot.merge(per[b])
    return pca_from_moments(tot, k)


#: Rows that a kernel is evaluated for at once.
KERNEL_ROWS = 1024


def in_slices(fn):
    """``fn`` on ``KERNEL_ROWS`` rows at a time, so that its intermediate matrices
    do not grow with the batch."""
    return lambda X: np.concatenate([fn(X[at:at + KERNEL_ROWS]) for at in range(0, len(X), KERNEL_ROWS)])


def _array_udf(fn):
    @F.pandas_udf(ArrayType(DoubleType()))
    def u(s: pd.Series) -> pd.Series:
        if len(s) == 0:
            return pd.Series([], dtype=object)
        X = np.stack([np.asarray(v, dtype=np.float64) for v in s])
        Y = fn(X)
        return pd.Series(list(Y))
    return u


def project(vec, mean: np.ndarray, components: np.ndarray) -> Column:
    """(x - mean) @ components.T, per Arrow batch."""
    m, W = np.asarray(mean), np.asarray(components)
    c = F.col(vec) if isinstance(vec, str) else vec
    return _array_udf(lambda X: (X - m) @ W.T)(c)


def inverse_project(z, mean: np.ndarray, components: np.ndarray) -> Column:
    m, W = np.asarray(mean), np.asarray(components)
    c = F.col(z) if isinstance(z, str) else z
    return _array_udf(lambda Z: Z @ W + m)(c)


def pca_transform(df: DataFrame, vec: str, model: PCAModel, out: str = "pc") -> DataFrame:
    return df.withColumn(out, project(vec, model.mean, model.components))


def explained_variance_table(model: PCAModel, spark) -> DataFrame:
    """Per axis variance, ratio and cumulative ratio."""
    r = model.explained_variance_ratio
    rows = [(i + 1, float(v), float(x), float(c)) for i, (v, x, c) in
            enumerate(zip(model.explained_variance, r, np.cumsum(r)))]
    return spark.createDataFrame(rows, "axis int, variance double, ratio double, cum_ratio double")


# ---------------------------------------------------------------- R4
def tall_qr(df: DataFrame, vec: str, project_rows, width: int, groups: int = 32) -> np.ndarray:
    """R of the QR factorisation of ``project_rows(X)`` (n x width) over all rows:
    Householder QR in each task, the triangles stacked and factorised again in
    ``groups`` groups, and those once more.  The condition of the matrix is never
    squared."""
    import pyarrow as pa

    def triangle(parts: list[np.ndarray]) -> np.ndarray:
        return np.linalg.qr(np.concatenate([np.zeros((width, width)), *parts]), mode="r")

    def part(frames):
        r = None
        for f in frames:
            if len(f):
                r = triangle([*([] if r is None else [r]), project_rows(_vec_matrix(f["x"]))])
        if r is not None:
            yield pd.DataFrame({"r": [r.ravel().tolist()], "task": [TaskContext.get().partitionId()]})

    def merge(group: pa.Table) -> pa.Table:
        rs = [np.array(x.as_py()).reshape(width, width) for x in group.column("r")]
        return pa.table({"r": pa.array([triangle(rs).ravel().tolist()], pa.list_(pa.float64()))})
    rows = complete_rows(df.select(F.col(vec).alias("x")), "x")
    parts = rows.mapInPandas(part, "r array<double>, task int").groupBy(F.pmod("task", F.lit(groups)).alias("g")) \
        .applyInArrow(merge, "r array<double>").collect()
    return triangle([np.array(p["r"]).reshape(width, width) for p in parts])


def randomized_pca(df: DataFrame, vec: str, k: int, oversample: int = 10, seed: int = 42) -> PCAModel:
    """Randomised range finder after the mean: Z = (X - mu) Omega, its R by a
    tall-skinny QR, then B = (Z R^-1)' X = Q' X in one more pass; the SVD of B
    gives the axes."""
    from quarry.operators.linear import sum_pass
    m = gram(df, vec)
    mu = m.mean
    d = len(mu)
    l = min(d, k + oversample)
    omega = np.random.default_rng(seed).standard_normal((d, l))
    R = tall_qr(df, vec, lambda X: (X - mu) @ omega, l)
    # columns that the rows do not span (R's small diagonal) stay out
    u, size, vt = np.linalg.svd(R)
    keep = size > 1e-14 * size[0] if size[0] > 0 else np.zeros(l, bool)
    inverse = (vt[keep].T / size[keep])               # Q = Z V S^-1, orthonormal as Z R^-1 is

    def fn(X, pdf):
        Xc = X - mu
        return ((Xc @ omega @ inverse).T @ Xc).ravel()
    B = sum_pass(df.select(F.col(vec).alias("x")), fn, int(keep.sum()) * d).reshape(-1, d)
    _, sv, axes = np.linalg.svd(B, full_matrices=False)
    var = np.zeros(k)
    var[:min(k, len(sv))] = sv[:k] ** 2 / (m.n - 1)
    total = float(np.trace(m.cov(ddof=1)))
    return PCAModel(mu, _sign_fix(axes[:k]), var[:len(axes[:k])], total)


# ---------------------------------------------------------------- R5 / R6
def rbf_kernel(A: np.ndarray, B: np.ndarray, gamma: float) -> np.ndarray:
    d2 = (A * A).sum(1)[:, None] + (B * B).sum(1)[None, :] - 2 * A @ B.T
    return np.exp(-gamma * np.maximum(d2, 0.0))


def kernel_map(kind: str, A: np.ndarray, B: np.ndarray, gamma: float, coef0: float = 1.0):
    if kind == "linear":
        return A @ B.T
    if kind == "rbf":
        return rbf_kernel(A, B, gamma)
    if kind == "sigmoid":
        return np.tanh(gamma * A @ B.T + coef0)
    raise ValueError(kind)


@dataclass
class KernelPCAModel:
    landmarks: np.ndarray
    whiten: np.ndarray
    pca: PCAModel
    kernel: str
    gamma: float
    preimage: np.ndarray | None = None   # (k + 1) x d ridge map back to inputs

    def features_udf(self, vec):
        L, Wm, kind, g = self.landmarks, self.whiten, self.kernel, self.gamma
        P = self.pca
        return _array_udf(in_slices(lambda X: (kernel_map(kind, X, L, g) @ Wm - P.mean) @ P.components.T))(
            F.col(vec) if isinstance(vec, str) else vec)

    def preimage_udf(self, z):
        W = self.preimage
        return _array_udf(lambda Z: np.hstack([np.ones((len(Z), 1)), Z]) @ W)(
            F.col(z) if isinstance(z, str) else z)


def kernel_pca(df: DataFrame, vec: str, id_col: str, k: int, kernel: str = "rbf",
               gamma: float = 0.05, n_landmarks: int = 100, fit_inverse: bool = True,
               alpha: float = 1e-3, seed: int = 42) -> KernelPCAModel:
    """R5 (re-aimed): Nystroem features from ``n_landmarks`` hash-sampled rows
    (m x m kernel on the driver), then centred PCA on those features (one
    Gram pass); the pre-image is a ridge map from projections to inputs."""
    from quarry.operators.split import sample_without_replacement
    from quarry.sources.tables import emb_vectors  # noqa: F401
    lm = np.stack([np.asarray(r[0], dtype=float) for r in
                   sample_without_replacement(df, n_landmarks, [id_col], seed, portable=False)
                   .select(vec).collect()])
    Kmm = kernel_map(kernel, lm, lm, gamma)
    vals, vecs = np.linalg.eigh(Kmm)
    vals = np.maximum(vals, 1e-12)
    whiten = vecs @ np.diag(vals ** -0.5) @ vecs.T
    phi = in_slices(lambda X: kernel_map(kernel, X, lm, gamma) @ whiten)
    p = pca(df, vec, k, expand=phi)
    model = KernelPCAModel(lm, whiten, p, kernel, gamma)
    if fit_inverse:
        from quarry.operators.linear import sum_pass
        d = len(lm[0])

        def fn(X, pdf):
            Za = np.hstack([np.ones((len(X), 1)), (phi(X) - p.mean) @ p.components.T])
            return np.concatenate([(Za.T @ Za).ravel(), (Za.T @ X).ravel()])
        s = sum_pass(df.select(F.col(vec).alias("x")), fn, (k + 1) ** 2 + (k + 1) * d)
        A = s[:(k + 1) ** 2].reshape(k + 1, k + 1) + alpha * np.eye(k + 1)
        model.preimage = np.linalg.solve(A, s[(k + 1) ** 2:].reshape(k + 1, d))
    return model


# ---------------------------------------------------------------- R8 / E14
def reconstruction_errors(df: DataFrame, vec: str, model: PCAModel, out: str = "rec_error"):
    """Mean squared reconstruction error per row."""
    from quarry.operators.metrics import reconstruction_error
    z = project(vec, model.mean, model.components)
    xr = inverse_project(z, model.mean, model.components)
    return df.withColumn("_xr", xr).withColumn(out, reconstruction_error(vec, "_xr")).drop("_xr")


# ---------------------------------------------------------------- L29
def lda(df: DataFrame, vec: str, label: str, k: int | None = None, ridge: float = 1e-6):
    """Fisher discriminant axes from per-class Gram statistics (one
    grouped pass); generalised eigenproblem S_B v = lambda S_W v on the driver."""
    per = gram(df, vec, group=label)
    tot = None
    for m in per.values():
        tot = m if tot is None else tot.merge(m)
    mu = tot.mean
    d = len(mu)
    Sw = np.zeros((d, d))
    Sb = np.zeros((d, d))
    for m in per.values():
        mk = m.mean
        Sw += m.cxx
        Sb += m.n * np.outer(mk - mu, mk - mu)
    vals, vecs = np.linalg.eig(np.linalg.solve(Sw + ridge * np.eye(d), Sb))
    order = np.argsort(-vals.real)
    k = k or (len(per) - 1)
    axes = _sign_fix(vecs.real[:, order[:k]].T)
    return {"mean": mu, "axes": axes, "eigenvalues": vals.real[order[:k]]}
