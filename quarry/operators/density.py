"""Gaussian mixtures and densities.

MLlib's GaussianMixture covers full covariances; tied / diagonal /
spherical covariances and the sparse-prior variant use our EM, where each
iteration is ONE distributed pass: every Arrow batch computes
responsibilities with numpy and returns partial sufficient statistics
(N_k, sum r x, sum r x x', log-likelihood), merged per entry.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.clustering import GaussianMixture
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

from quarry.functions.hashing import md5_uniform
from quarry.operators.linear import sum_pass

COV_FLOOR = 1e-6


@dataclass
class Mixture:
    weights: np.ndarray   # k
    means: np.ndarray     # k x d
    covs: np.ndarray      # k x d x d (expanded for every covariance type)
    cov_type: str
    log_likelihood: float = float("nan")
    n: int = 0
    n_iter: int = 0

    @property
    def k(self):
        return len(self.weights)

    @property
    def d(self):
        return self.means.shape[1]

    def n_parameters(self) -> int:
        k, d = self.k, self.d
        cov = {"full": k * d * (d + 1) / 2, "tied": d * (d + 1) / 2, "diag": k * d,
               "spherical": k}[self.cov_type]
        return int(cov + k * d + k - 1)

    def bic(self) -> float:
        """E12."""
        return -2 * self.log_likelihood + self.n_parameters() * math.log(self.n)

    def aic(self) -> float:
        return -2 * self.log_likelihood + 2 * self.n_parameters()


def component_log_density(X: np.ndarray, mix: Mixture) -> np.ndarray:
    """M6: log N(x | mu_k, Sigma_k) + log w_k for every row and component,
    via the Cholesky factor of each covariance."""
    n, d = X.shape
    out = np.empty((n, mix.k))
    for j in range(mix.k):
        L = np.linalg.cholesky(mix.covs[j])
        z = np.linalg.solve(L, (X - mix.means[j]).T)
        logdet = 2 * np.log(np.diag(L)).sum()
        out[:, j] = -0.5 * ((z * z).sum(0) + d * math.log(2 * math.pi) + logdet) + \
            math.log(max(mix.weights[j], 1e-300))
    return out


def _logsumexp(a: np.ndarray) -> np.ndarray:
    m = a.max(1, keepdims=True)
    return (m + np.log(np.exp(a - m).sum(1, keepdims=True)))[:, 0]


def _m_step(stats: np.ndarray, k: int, d: int, cov_type: str, prior: float | None):
    Nk = stats[:k]
    Sx = stats[k:k + k * d].reshape(k, d)
    Sxx = stats[k + k * d:k + k * d + k * d * d].reshape(k, d, d)
    n = Nk.sum()
    if prior is None:
        w = Nk / n
    else:   # MAP with a sparse Dirichlet prior: components can die out
        w = np.maximum(Nk + prior - 1.0, 0.0)
        w = w / w.sum()
    mu = Sx / np.maximum(Nk, 1e-12)[:, None]
    covs = np.empty((k, d, d))
    for j in range(k):
        covs[j] = Sxx[j] / max(Nk[j], 1e-12) - np.outer(mu[j], mu[j])
    if cov_type == "tied":
        t = sum(Nk[j] * covs[j] for j in range(k)) / n
        covs = np.repeat(t[None], k, 0)
    elif cov_type == "diag":
        covs = np.stack([np.diag(np.diag(c)) for c in covs])
    elif cov_type == "spherical":
        covs = np.stack([np.eye(d) * np.trace(c) / d for c in covs])
    covs = covs + COV_FLOOR * np.eye(d)[None]
    return w, mu, covs


def em(df: DataFrame, vec: str, k: int, cov_type: str = "full", max_iter: int = 100,
       tol: float = 1e-3, init_means=None, seed: int = 42, prior: float | None = None,
       id_col: str | None = None, n_init: int = 1) -> Mixture:
    """C13 (and C14 with ``prior``): EM for Gaussian mixtures, the likeliest of
    ``n_init`` starts.  Starts are drawn by hash of ``id_col``, so they do not
    depend on partitions.  Rows with a NULL or NaN take no part."""
    from quarry.operators.aggregate import complete_rows
    if init_means is None and id_col is None:
        raise ValueError("id_col is needed to draw the first means")
    d_ = complete_rows(df, vec).select(F.col(vec).alias("x"), *([F.col(id_col).alias("_id")] if id_col else [])).cache()
    starts = [init_means]
    if init_means is None:
        from quarry.operators.cluster import kmeans_pp_init
        starts = [kmeans_pp_init(d_, "x", "_id", k, seed + s) for s in range(n_init)]
    best = None
    for means in starts:
        mix = _em_from(d_.select("x"), np.asarray(means, dtype=float), cov_type, max_iter, tol, prior)
        if best is None or mix.log_likelihood > best.log_likelihood:
            best = mix
    d_.unpersist()
    return best


def _em_from(d_: DataFrame, means: np.ndarray, cov_type: str, max_iter: int, tol: float,
             prior: float | None) -> Mixture:
    """EM from given means.  Sums are taken about the mean of the first means,
    so covariances keep their digits."""
    k, dim = means.shape
    middle = means.mean(0)
    n = d_.count()
    mix = Mixture(np.full(k, 1.0 / k), means - middle, np.repeat(np.eye(dim)[None], k, 0), cov_type, n=n)
    prev, size = -np.inf, k + k * dim + k * dim * dim + 1
    for it in range(max_iter):
        cur = mix

        def fn(X, pdf, cur=cur):
            X = X - middle
            lp = component_log_density(X, cur)
            ll = _logsumexp(lp)
            r = np.exp(lp - ll[:, None])
            Sxx = np.einsum("nk,ni,nj->kij", r, X, X)
            return np.concatenate([r.sum(0), (r.T @ X).ravel(), Sxx.ravel(), [ll.sum()]])
        s = sum_pass(d_, fn, size)
        ll = s[-1]
        w, mu, covs = _m_step(s[:-1], k, dim, cov_type, prior)
        mix = Mixture(w, mu, covs, cov_type, ll, n, it + 1)
        if abs(ll - prev) <= tol * n:
            break
        prev = ll
    mix.means = mix.means + middle
    # the log-likelihood under the returned parameters
    mix.log_likelihood = float(sum_pass(
        d_, lambda X, p: np.array([_logsumexp(component_log_density(X, mix)).sum()]), 1)[0])
    return mix


def mllib_gmm(df: DataFrame, vec: str, k: int, n_init: int = 3, seed: int = 42,
              max_iter: int = 100):
    """MLlib GaussianMixture (full covariances), best of ``n_init``
    seeds by log-likelihood."""
    d = df.withColumn("_v", array_to_vector(F.col(vec))).cache()
    best = None
    for s in range(n_init):
        m = GaussianMixture(k=k, seed=seed + s, maxIter=max_iter, featuresCol="_v",
                            predictionCol="cluster", probabilityCol="proba").fit(d)
        if best is None or m.summary.logLikelihood > best.summary.logLikelihood:
            best = m
    return best, d


def score_samples(vec, mix: Mixture):
    """Log density per row (pandas UDF, Arrow batches)."""
    @F.pandas_udf(DoubleType())
    def u(s: pd.Series) -> pd.Series:
        if len(s) == 0:
            return pd.Series([], dtype=float)
        X = np.stack([np.asarray(v, dtype=float) for v in s])
        return pd.Series(_logsumexp(component_log_density(X, mix)))
    return u(F.col(vec) if isinstance(vec, str) else vec)


def predict_proba(vec, mix: Mixture):
    """Soft assignment (responsibilities) per row."""
    @F.pandas_udf(ArrayType(DoubleType()))
    def u(s: pd.Series) -> pd.Series:
        if len(s) == 0:
            return pd.Series([], dtype=object)
        X = np.stack([np.asarray(v, dtype=float) for v in s])
        lp = component_log_density(X, mix)
        return pd.Series(list(np.exp(lp - _logsumexp(lp)[:, None])))
    return u(F.col(vec) if isinstance(vec, str) else vec)


def anomalies(df: DataFrame, vec: str, mix: Mixture, pct: float = 0.04) -> DataFrame:
    """Rows whose density is below the ``pct`` quantile (exact)."""
    from quarry.operators.profile import exact_quantiles
    s = df.withColumn("log_density", score_samples(vec, mix))
    cut = exact_quantiles(s, "log_density", [pct], names=["cut"]).first()["cut"]
    return s.filter(F.col("log_density") < F.lit(cut))


def sample(spark: SparkSession, mix: Mixture, n: int, seed: int = 42) -> DataFrame:
    """N new rows.  Component by a hash uniform against the cumulative
    weights; normals by Box-Muller from hash uniforms; x = mu + L z."""
    cw = np.cumsum(mix.weights)
    r = spark.range(n)
    u = md5_uniform(F.lit(seed), F.lit(-1), F.col("id"))
    comp = F.lit(mix.k - 1)
    for j in reversed(range(mix.k - 1)):
        comp = F.when(u < F.lit(float(cw[j])), F.lit(j)).otherwise(comp)
    r = r.withColumn("component", comp)
    d = mix.d

    def normal(i):
        u1 = md5_uniform(F.lit(seed), F.lit(2 * i), F.col("id")) + F.lit(1e-12)
        u2 = md5_uniform(F.lit(seed), F.lit(2 * i + 1), F.col("id"))
        return F.sqrt(-2 * F.log(u1)) * F.cos(2 * math.pi * u2)
    r = r.withColumn("z", F.array(*[normal(i) for i in range(d)]))
    Ls = [np.linalg.cholesky(c) for c in mix.covs]
    xs = []
    for a in range(d):
        e = None
        for j in range(mix.k):
            val = F.lit(float(mix.means[j][a]))
            for b in range(a + 1):
                val = val + F.lit(float(Ls[j][a, b])) * F.col("z")[b]
            e = F.when(F.col("component") == j, val) if e is None else e.when(
                F.col("component") == j, val)
        xs.append(e)
    return r.select("id", "component", F.array(*xs).alias("x"))


def bic_table(df: DataFrame, vec: str, ks, cov_types, id_col: str, max_iter: int = 30,
              seed: int = 42, n_init: int = 1):
    """C17: BIC / AIC for every (k, covariance type)."""
    out = []
    for k in ks:
        for ct in cov_types:
            m = em(df, vec, k, ct, max_iter=max_iter, seed=seed, id_col=id_col, n_init=n_init)
            out.append((k, ct, m.log_likelihood, m.bic(), m.aic()))
    return out


# ---------------------------------------------------------------- C14
def _digamma(x: float) -> float:
    """psi(x) by recurrence up to x >= 6, then the asymptotic series."""
    r = 0.0
    while x < 6.0:
        r -= 1.0 / x
        x += 1.0
    f = 1.0 / (x * x)
    return r + math.log(x) - 0.5 / x - f * (1 / 12 - f * (1 / 120 - f * (1 / 252 - f * (
        1 / 240 - f / 132))))


def _beta_gap(a: float, b: float, concentration: float) -> float:
    """Divergence of Beta(a, b) from Beta(1, concentration)."""
    ln_beta = lambda x, y: math.lgamma(x) + math.lgamma(y) - math.lgamma(x + y)
    both = _digamma(a + b)
    return ln_beta(1.0, concentration) - ln_beta(a, b) + (a - 1.0) * (_digamma(a) - both) \
        + (b - concentration) * (_digamma(b) - both)


def _normal_wishart_gap(dm, beta, W, nu, e_ln_lam, b0, W0inv, nu0) -> float:
    """Divergence of a component's Normal-Wishart from the prior; ``dm`` is the
    distance of the means."""
    d = len(dm)

    def ln_b(logdet, n):
        return -0.5 * n * logdet - (0.5 * n * d * math.log(2) + 0.25 * d * (d - 1) * math.log(math.pi)
                                    + sum(math.lgamma(0.5 * (n + 1 - i)) for i in range(1, d + 1)))
    means = 0.5 * (d * b0 / beta - d - d * math.log(b0 / beta) + b0 * nu * dm @ W @ dm)
    shapes = 0.5 * (nu - nu0) * e_ln_lam - 0.5 * nu * d + 0.5 * nu * np.trace(W0inv @ W) \
        + ln_b(np.linalg.slogdet(W)[1], nu) - ln_b(-np.linalg.slogdet(W0inv)[1], nu0)
    return float(means + shapes)


def vb_gmm(df: DataFrame, vec: str, k: int, id_col: str, max_iter: int = 100,
           tol: float = 1e-3, weight_prior: float | None = None, seed: int = 42,
           prior: str = "dirichlet") -> Mixture:
    """C14: variational Bayesian Gaussian mixture (a finite Dirichlet prior on
    the weights, or with ``prior="stick_breaking"`` the Dirichlet process: each
    weight is a Beta(1, weight_prior) share of what the earlier ones leave;
    Normal-Wishart on means / precisions).  Each iteration is one pass: batches
    compute responsibilities from the current variational parameters and return
    N_k, sum r x, sum r x x'; the weight and Wishart updates run on the driver.
    Unneeded components get weights near 0.  ``lower_bounds`` of the result has
    the evidence bound of each pass (stick-breaking), which never falls."""
    sticks = prior == "stick_breaking"
    if not sticks and prior != "dirichlet":
        raise ValueError(f"unknown prior {prior}")
    from quarry.operators.aggregate import gram
    from quarry.operators.cluster import kmeans_pp_init
    d_ = df.select(F.col(vec).alias("x")).cache()
    m0s = gram(df, vec)
    D_ = len(m0s.sx)
    m0 = m0s.mean
    W0inv = m0s.cov(ddof=1) + COV_FLOOR * np.eye(D_)
    a0 = weight_prior if weight_prior is not None else 1.0 / k
    b0, nu0 = 1.0, float(D_)
    centers = np.asarray(kmeans_pp_init(df, vec, id_col, k, seed), dtype=float)
    k = len(centers)
    size = k + k * D_ + k * D_ * D_ + 1

    def stats_from(resp_fn):
        def fn(X, pdf):
            r, evidence = resp_fn(X)
            Sxx = np.einsum("nk,ni,nj->kij", r, X, X)
            return np.concatenate([r.sum(0), (r.T @ X).ravel(), Sxx.ravel(), [evidence]])
        s = sum_pass(d_, fn, size)
        return s[:k], s[k:k + k * D_].reshape(k, D_), s[k + k * D_:-1].reshape(k, D_, D_), s[-1]

    def hard(X, c=centers):
        a = np.argmin(((X[:, None, :] - c[None]) ** 2).sum(-1), 1)
        return np.eye(k)[a], 0.0

    Nk, Sx, Sxx, _ = stats_from(hard)
    prev, bounds = None, []
    W0inv_ = W0inv + COV_FLOOR * np.eye(D_)
    for it in range(max_iter):
        Nk_ = np.maximum(Nk, 1e-10)
        xbar = Sx / Nk_[:, None]
        alpha = a0 + Nk
        beta = b0 + Nk
        nu = nu0 + Nk
        m = (b0 * m0 + Nk[:, None] * xbar) / beta[:, None]
        W = np.empty((k, D_, D_))
        for j in range(k):
            S = Sxx[j] / Nk_[j] - np.outer(xbar[j], xbar[j])
            dx = xbar[j] - m0
            Winv = W0inv + Nk[j] * S + (b0 * Nk[j] / (b0 + Nk[j])) * np.outer(dx, dx)
            W[j] = np.linalg.inv(Winv + COV_FLOOR * np.eye(D_))
        if sticks:
            rest = np.cumsum(Nk[::-1])[::-1] - Nk
            va, vb = 1.0 + Nk, a0 + rest
            both = np.array([_digamma(x) for x in va + vb])
            left = np.array([_digamma(x) for x in vb]) - both
            e_ln_pi = np.array([_digamma(x) for x in va]) - both + np.cumsum(left) - left
        else:
            e_ln_pi = np.array([_digamma(a) for a in alpha]) - _digamma(alpha.sum())
        e_ln_lam = np.array([sum(_digamma((nu[j] + 1 - i) / 2) for i in range(1, D_ + 1))
                             + D_ * math.log(2) + np.linalg.slogdet(W[j])[1] for j in range(k)])
        if prev is not None and np.abs(Nk - prev).max() <= tol * Nk.sum():
            break
        prev = Nk.copy()

        def resp(X, m=m, W=W, nu=nu, beta=beta, e_ln_pi=e_ln_pi, e_ln_lam=e_ln_lam):
            lr = np.empty((len(X), k))
            for j in range(k):
                dx = X - m[j]
                quad = np.einsum("ni,ij,nj->n", dx, W[j], dx)
                lr[:, j] = e_ln_pi[j] + 0.5 * e_ln_lam[j] - 0.5 * D_ * math.log(2 * math.pi) \
                    - 0.5 * (D_ / beta[j] + nu[j] * quad)
            total = _logsumexp(lr)
            return np.exp(lr - total[:, None]), total.sum()
        Nk, Sx, Sxx, evidence = stats_from(resp)
        if sticks:
            bounds.append(evidence - sum(_beta_gap(a, b, a0) for a, b in zip(va, vb)) - sum(
                _normal_wishart_gap(m[j] - m0, beta[j], W[j], nu[j], e_ln_lam[j], b0, W0inv_, nu0) for j in range(k)))
    d_.unpersist()
    covs = np.stack([np.linalg.inv(W[j]) / nu[j] for j in range(k)])
    weights = alpha / alpha.sum()
    if sticks:
        share = va / (va + vb)
        weights = share * np.concatenate(([1.0], np.cumprod(1 - share)[:-1]))
        weights = weights / weights.sum()
    mix = Mixture(weights, m, covs + COV_FLOOR * np.eye(D_)[None], "full",
                  n=int(round(Nk.sum())), n_iter=it + 1)
    mix.lower_bounds = bounds
    mix.log_likelihood = float(sum_pass(
        df.select(F.col(vec).alias("x")),
        lambda X, p: np.array([_logsumexp(component_log_density(X, mix)).sum()]), 1)[0])
    return mix
