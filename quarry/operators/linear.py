"""Linear models (L1-L14) and learning curves.

Least-squares work is reduced to ONE distributed pass that builds the
mergeable Gram statistics (``aggregate.gram``); gradient descent variants
then iterate on the d x d statistics on the driver (the reference recomputes
X'X theta every step).  Models without a closed form use MLlib estimators
(treeAggregate per iteration) or one aggregate job per step.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
from pyspark.ml.classification import LinearSVC, LogisticRegression, OneVsRest
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions.hashing import xx_u32
from quarry.operators.aggregate import Moments, gram


@dataclass
class LinearFit:
    coef: np.ndarray
    intercept: float
    path: list = field(default_factory=list)

    def predict_expr(self, vec_col: str):
        from pyspark.ml.functions import vector_to_array
        arr = vector_to_array(F.col(vec_col))
        e = F.lit(float(self.intercept))
        for i, w in enumerate(self.coef):
            e = e + arr[i] * F.lit(float(w))
        return e


def _augment(m: Moments, fit_intercept: bool):
    if not fit_intercept:
        return m.xtx, m.xty
    p = len(m.sx)
    A = np.zeros((p + 1, p + 1))
    A[0, 0], A[0, 1:], A[1:, 0], A[1:, 1:] = m.n, m.sx, m.sx, m.xtx
    b = np.concatenate([[m.sy], m.xty])
    return A, b


def solve_normal(m: Moments, alpha: float = 0.0, fit_intercept: bool = True,
                 method: str = "lstsq") -> LinearFit:
    """L1 (and ridge): (X'X + alpha*I') theta = X'y; the intercept is not
    penalised.  ``method``: 'solve' (normal equation), 'lstsq', 'pinv'."""
    A, b = _augment(m, fit_intercept)
    if alpha:
        pen = np.eye(A.shape[0]) * alpha
        if fit_intercept:
            pen[0, 0] = 0.0
        A = A + pen
    if method == "solve":
        theta = np.linalg.solve(A, b)
    elif method == "pinv":
        theta = np.linalg.pinv(A) @ b
    else:
        theta = np.linalg.lstsq(A, b, rcond=None)[0]
    return LinearFit(theta[1:], float(theta[0])) if fit_intercept else LinearFit(theta, 0.0)


def fit_linear(df: DataFrame, vec: str, label: str, alpha: float = 0.0,
               method: str = "lstsq") -> LinearFit:
    """L1 / L4 ridge: one Gram pass, then a p x p solve on the driver."""
    return solve_normal(gram(df, vec, label), alpha, True, method)


def simple_regression(df: DataFrame, x: str, y: str) -> DataFrame:
    """L1 with one feature: slope / intercept as SQL aggregates."""
    return df.agg(F.regr_slope(F.col(y), F.col(x)).alias("slope"),
                  F.regr_intercept(F.col(y), F.col(x)).alias("intercept"),
                  F.regr_r2(F.col(y), F.col(x)).alias("r2"))


def mse_from_moments(m: Moments, fit: LinearFit) -> float:
    """Mean squared error of a linear model from the Gram statistics only."""
    th = np.concatenate([[fit.intercept], fit.coef])
    A, b = _augment(m, True)
    sse = th @ A @ th - 2 * th @ b + m.syy
    return float(max(sse, 0.0) / m.n)


# ---------------------------------------------------------------- L2
def batch_gd(m: Moments, eta: float = 0.1, n_iter: int = 1000, theta0=None,
             keep_path: bool = False) -> LinearFit:
    """L2: theta <- theta - eta * 2/m (A theta - b) on the cached statistics."""
    A, b = _augment(m, True)
    th = np.zeros(A.shape[0]) if theta0 is None else np.asarray(theta0, float)
    path = []
    for _ in range(n_iter):
        th = th - eta * 2.0 / m.n * (A @ th - b)
        if keep_path:
            path.append(th.copy())
    return LinearFit(th[1:], float(th[0]), path)


# ---------------------------------------------------------------- L3 / L6
def batch_moments(df: DataFrame, vec: str, label: str, n_batches: int, ids: Sequence[str],
                  seed: int = 42) -> dict:
    """Per hash batch Gram statistics in one pass ({batch: Moments})."""
    d = df.withColumn("_batch", F.pmod(xx_u32(*ids, seed=seed), F.lit(n_batches)))
    return gram(d, vec, label, group="_batch")


def learning_schedule(t: int, t0: float = 5.0, t1: float = 50.0) -> float:
    return t0 / (t + t1)


def minibatch_gd(batches: dict, n_epochs: int = 50, t0: float = 5.0, t1: float = 50.0,
                 seed: int = 42, keep_path: bool = False, theta0=None) -> LinearFit:
    """L3: mini-batch / stochastic GD with eta = t0 / (t + t1).  Each step
    uses one batch's statistics: grad = 2/m_b (A_b theta - b_b)."""
    rng = np.random.default_rng(seed)
    keys = sorted(batches)
    A_b = {k: _augment(batches[k], True) for k in keys}
    p = A_b[keys[0]][0].shape[0]
    th = np.zeros(p) if theta0 is None else np.asarray(theta0, float)
    path, t = [], 0
    for _ in range(n_epochs):
        for k in rng.permutation(keys):
            A, b = A_b[k]
            t += 1
            th = th - learning_schedule(t, t0, t1) * 2.0 / batches[k].n * (A @ th - b)
            if keep_path:
                path.append(th.copy())
    return LinearFit(th[1:], float(th[0]), path)


def early_stopping(train_batches: dict, val: Moments, n_epochs: int = 500, eta: float = 0.05,
                   patience: int = 20) -> tuple[LinearFit, int, list]:
    """Epochs of GD on the training statistics, over standardised features;
    keep the epoch with the lowest validation MSE (from the validation Gram, no
    data pass) and stop after ``patience`` epochs without a lower one."""
    tot = None
    for mm in train_batches.values():
        tot = mm if tot is None else tot.merge(mm)
    scale = np.sqrt(np.maximum(np.diag(tot.cxx) / tot.n, 0))
    scale[scale == 0] = 1.0
    mean_y = tot.sy / tot.n
    corr = tot.cxx / tot.n / np.outer(scale, scale)
    pull = (tot.xty / tot.n - tot.mean * mean_y) / scale
    w, bias = np.zeros(len(scale)), 0.0
    best, best_ep, errs = None, -1, []
    for ep in range(n_epochs):
        w = w - eta * 2.0 * (corr @ w - pull)
        bias = bias - eta * 2.0 * (bias - mean_y)
        coef = w / scale
        fit = LinearFit(coef, float(bias - coef @ tot.mean))
        errs.append(mse_from_moments(val, fit))
        if best is None or errs[-1] < errs[best_ep]:
            best, best_ep = fit, ep
        elif ep - best_ep >= patience:
            break
    return best, best_ep, errs


# ---------------------------------------------------------------- L4
def ridge_reg_param(alpha: float, n: int, sd_y: float) -> float:
    """Ridge penalty alpha (sum of squares + alpha |w|^2) -> MLlib regParam
    (standardization=False)."""
    return alpha / n * sd_y


def regularized(kind: str, alpha: float, n: int, sd_y: float, l1_ratio: float = 0.5,
                features: str = "features", label: str = "label") -> LinearRegression:
    """L4: ridge / lasso / elastic net with the parameter mapping of SURVEY."""
    if kind == "ridge":
        reg, en, solver = ridge_reg_param(alpha, n, sd_y), 0.0, "normal"
    elif kind == "lasso":
        reg, en, solver = alpha, 1.0, "auto"
    elif kind == "elastic":
        a, b = alpha * l1_ratio, alpha * (1 - l1_ratio) * sd_y
        reg, en, solver = a + b, a / (a + b), "auto"
    else:
        raise ValueError(kind)
    return LinearRegression(featuresCol=features, labelCol=label, regParam=reg,
                            elasticNetParam=en, standardization=False, solver=solver)


# ---------------------------------------------------------------- L7 / L8 / L9 / L10
def logistic(C: float, n: int, features="features", label="label",
             multinomial: bool = False, max_iter: int = 100) -> LogisticRegression:
    """Inverse regularisation C -> regParam = 1 / (C n)."""
    return LogisticRegression(featuresCol=features, labelCol=label, regParam=1.0 / (C * n),
                              standardization=False, maxIter=max_iter,
                              family="multinomial" if multinomial else "auto")


def linear_svc(C: float, n: int, features="features", label="label",
               max_iter: int = 100) -> LinearSVC:
    """L10."""
    return LinearSVC(featuresCol=features, labelCol=label, regParam=1.0 / (C * n),
                     standardization=False, maxIter=max_iter)


def one_vs_rest(binary, features="features", label="label") -> OneVsRest:
    """L9."""
    return OneVsRest(classifier=binary, featuresCol=features, labelCol=label)


def softmax_bgd(df: DataFrame, vec: str, label: str, k: int, eta: float = 1.0,
                n_iter: int = 300, alpha: float = 0.0, val: DataFrame | None = None,
                momentum: float = 0.9, patience: int = 3) -> dict:
    """L8 own form: batch GD (with momentum) for softmax regression with L2,
    bias unpenalised.  One distributed pass per step gives the gradient over
    the training rows and the log loss over the validation rows; it stops when
    the penalised validation loss has not fallen for ``patience`` steps.  Rows
    with a NULL in vector or label take no part."""
    from quarry.operators.aggregate import complete_rows
    own = complete_rows(df, vec, label).select(_as_array(df, vec).alias("x"), F.col(label).cast("int").alias("y"),
                                               F.lit(1.0).alias("train"))
    if val is not None:
        own = own.unionByName(complete_rows(val, vec, label).select(
            _as_array(val, vec).alias("x"), F.col(label).cast("int").alias("y"), F.lit(0.0).alias("train")))
    own = own.cache()
    watched = 1.0 if val is None else 0.0
    dim = len(own.first()["x"])
    theta = np.zeros((dim + 1, k))
    speed, best, best_loss, history, since = np.zeros_like(theta), theta, np.inf, [], 0
    for _ in range(n_iter):
        def fn(X, pdf, theta=theta):
            Xb = np.hstack([np.ones((len(X), 1)), X])
            z = Xb @ theta
            z -= z.max(1, keepdims=True)
            p = np.exp(z)
            p /= p.sum(1, keepdims=True)
            y, train = pdf["y"].to_numpy(), pdf["train"].to_numpy()
            miss = p.copy()
            miss[np.arange(len(y)), y] -= 1
            loss = -np.log(p[np.arange(len(y)), y] + 1e-12)
            seen = train == watched
            return np.concatenate([(Xb.T @ (miss * train[:, None])).ravel(),
                                   [train.sum(), loss[seen].sum(), seen.sum()]])
        s = sum_pass(own, fn, theta.size + 3)
        penalty = np.vstack([np.zeros((1, k)), theta[1:]])
        loss = s[-2] / max(s[-1], 1) + alpha / 2 * float((penalty ** 2).sum())
        history.append(loss)
        if loss < best_loss:
            best, best_loss, since = theta, loss, 0
        else:
            since += 1
            if since >= patience:
                break
        speed = momentum * speed - eta * (s[:-3].reshape(theta.shape) / max(s[-3], 1) + alpha * penalty)
        theta = theta + speed
    own.unpersist()
    return {"theta": best, "loss": best_loss, "history": history}


# ---------------------------------------------------------------- L11 / L12 / L14
def sum_pass(df: DataFrame, fn, size: int) -> np.ndarray:
    """One distributed pass: ``fn(X, pdf) -> partial sums`` per Arrow batch,
    merged per entry on the executors.  Parameters travel in the closure, so
    no per-step literal expressions (and no codegen recompilation).  Callers
    drop incomplete rows first; a partial sum that is no number raises."""
    import pandas as pd
    from quarry.operators.aggregate import _vec_matrix

    def part(it):
        acc = np.zeros(size)
        for pdf in it:
            if len(pdf):
                acc += fn(_vec_matrix(pdf["x"]), pdf)
        if np.isnan(acc).any():
            raise ValueError("NULL or NaN in the rows of a statistics pass")
        yield pd.DataFrame({"i": np.arange(size, dtype=np.int32), "v": acc})
    out = df.mapInPandas(part, "i int, v double").groupBy("i").agg(F.sum("v").alias("v"))
    sums, found = np.zeros(size), out.toPandas()       # no partitions: all zeros
    sums[found["i"].to_numpy(dtype=np.int64)] = found["v"].to_numpy(dtype=float)
    return sums


def _as_array(df: DataFrame, col: str):
    from pyspark.ml.functions import vector_to_array
    from pyspark.ml.linalg import VectorUDT
    c = F.col(col)
    return vector_to_array(c) if isinstance(df.schema[col].dataType, VectorUDT) else c


def svm_bgd(df: DataFrame, vec: str, label01: str, C: float = 1.0, eta0: float = 1.0,
            eta_d: float = 1000.0, n_epochs: int = 50) -> LinearFit:
    """Linear SVM by batch (sub)gradient descent on the hinge loss.
    Each epoch is one pass summing t*x over the rows with margin < 1 (the
    support vectors); the regulariser uses the parameter C (not a global)."""
    from quarry.operators.aggregate import complete_rows
    d = complete_rows(df, vec, label01).select(_as_array(df, vec).alias("x"),
                                               (F.col(label01) * 2 - 1).cast("double").alias("t")).cache()
    dim = len(d.first()["x"])
    w, b = np.zeros(dim), 0.0
    for epoch in range(n_epochs):
        eta = eta0 / (epoch + eta_d)

        def fn(X, pdf, w=w, b=b):
            t = pdf["t"].to_numpy()
            sv = t * (X @ w + b) < 1
            return np.concatenate([(t[sv, None] * X[sv]).sum(0), [t[sv].sum()]])
        s = sum_pass(d, fn, dim + 1)
        w, b = w - eta * (w - C * s[:dim]), b - eta * (-C * s[dim])
    d.unpersist()
    return LinearFit(w, float(b))


def support_vectors(df: DataFrame, vec: str, label01: str, fit: LinearFit) -> DataFrame:
    """Rows with t (w.x + b) < 1."""
    t = (F.col(label01) * 2 - 1).cast("double")
    return df.filter(t * fit.predict_expr(vec) < 1)


def sgd_classifier(df: DataFrame, vec: str, label01: str, loss: str = "hinge",
                   alpha: float = 1e-4, n_epochs: int = 15, n_batches: int = 4,
                   ids: Sequence[str] = ("id",), seed: int = 42, eta0: float = 1.0) -> LinearFit:
    """Mini-batch SGD with hinge or log loss; each step is one pass over
    one hash batch, its rate falls as eta0 / sqrt(step), and the fit is the mean
    of the second half of the steps.  Rows with a NULL take no part."""
    from quarry.operators.aggregate import complete_rows
    d = complete_rows(df, vec, label01).select(
        _as_array(df, vec).alias("x"), (F.col(label01) * 2 - 1).cast("double").alias("t"),
        F.pmod(xx_u32(*ids, seed=seed), F.lit(n_batches)).alias("_b")).cache()
    dim = len(d.first()["x"])
    theta, steps, mean, count = np.zeros(dim + 1), n_epochs * n_batches, np.zeros(dim + 1), 0
    for t in range(steps):
        w, b = theta[:dim], theta[dim]

        def fn(X, pdf, w=w, b=b):
            tt = pdf["t"].to_numpy()
            z = X @ w + b
            c = np.where(tt * z < 1, tt, 0.0) if loss == "hinge" else tt / (1 + np.exp(np.clip(tt * z, -500, 500)))
            return np.concatenate([(c[:, None] * X).sum(0), [c.sum(), len(tt)]])
        s = sum_pass(d.filter(F.col("_b") == t % n_batches), fn, dim + 2)
        eta = eta0 / np.sqrt(t + 1)
        theta = theta + eta * (s[:-1] / max(s[-1], 1.0) - alpha * np.append(w, 0.0))
        if t >= steps // 2:
            mean, count = mean + theta, count + 1
    d.unpersist()
    return LinearFit(mean[:dim] / count, float(mean[dim] / count))


def linear_svr(df: DataFrame, vec: str, label: str, epsilon: float = 0.5, C: float = 1.0,
               eta0: float = 0.05, n_epochs: int = 60, patience: int = 8) -> LinearFit:
    """Epsilon-insensitive linear SVR by subgradient descent over
    standardised features, from the least-squares fit; each epoch sums over the
    off-margin rows |y - f(x)| > epsilon.  Keeps the epoch with the lowest
    objective and stops after ``patience`` epochs without a lower one.  Rows
    with a NULL take no part."""
    from quarry.operators.aggregate import complete_rows
    d = complete_rows(df, vec, label).select(_as_array(df, vec).alias("x"),
                                             F.col(label).cast("double").alias("y")).cache()
    m = gram(d, "x", "y")
    n, dim = m.n, len(m.sx)
    scale = np.sqrt(np.maximum(np.diag(m.cxx) / n, 0))
    scale[scale == 0] = 1.0
    mean_y = m.sy / n
    w = np.linalg.lstsq(m.cxx / n / np.outer(scale, scale),
                        (m.xty / n - m.mean * mean_y) / scale, rcond=None)[0]
    b, best, best_loss, since = mean_y, None, np.inf, 0
    for epoch in range(n_epochs):
        def fn(X, pdf, w=w, b=b):
            Z = (X - m.mean) / scale
            r = pdf["y"].to_numpy() - (Z @ w + b)
            sg = np.where(r > epsilon, 1.0, np.where(r < -epsilon, -1.0, 0.0))
            return np.concatenate([(sg[:, None] * Z).sum(0),
                                   [sg.sum(), np.maximum(np.abs(r) - epsilon, 0).sum()]])
        s = sum_pass(d, fn, dim + 2) / n
        loss = s[-1] + w @ w / (2 * C * n)
        if loss < best_loss - 1e-9:
            best, best_loss, since = (w, b), loss, 0
        else:
            since += 1
            if since >= patience:
                break
        eta = eta0 / np.sqrt(epoch + 1)
        w, b = w - eta * (w / (C * n) - s[:dim]), b + eta * s[dim]
    d.unpersist()
    coef = best[0] / scale
    return LinearFit(coef, float(best[1] - coef @ m.mean))


def off_margin(df: DataFrame, vec: str, label: str, fit: LinearFit, epsilon: float) -> DataFrame:
    return df.filter(F.abs(F.col(label) - fit.predict_expr(vec)) > epsilon)


# ---------------------------------------------------------------- T13
def learning_curve(df: DataFrame, vec: str, label: str, ids: Sequence[str],
                   n_steps: int = 10, val_frac: float = 0.2, seed: int = 42):
    """T13 for least squares: ONE pass of per-bucket Gram statistics; the
    training prefix of step s is buckets < s, so each fit is a running sum
    of bucket statistics.  Returns [(n_train, train_rmse, val_rmse)]."""
    u = F.pmod(xx_u32(*ids, seed=seed), F.lit(10_000)) / 10_000.0
    nb = n_steps
    g = F.when(u < val_frac, F.lit(-1)).otherwise(
        F.floor((u - val_frac) / (1 - val_frac) * nb).cast("int"))
    stats = gram(df.withColumn("_g", g), vec, label, group="_g")
    val = stats.pop(-1)
    out, acc = [], None
    for s in sorted(stats):
        acc = stats[s] if acc is None else acc.merge(stats[s])
        fit = solve_normal(acc)
        out.append((int(acc.n), float(np.sqrt(mse_from_moments(acc, fit))),
                    float(np.sqrt(mse_from_moments(val, fit)))))
    return out
