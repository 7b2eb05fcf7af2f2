"""Reproducible splits, sampling and folds.

Randomness is a hash of (seed, id) so membership never depends on the
partitioning.  Exact sizes come from ``hash_rank`` (bucket prefix sums), so
there is no global sort and no single-partition window.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from quarry.functions.hashing import crc32_le, md5_last_byte_le, md5_uniform, xx_u32
from quarry.operators.window import (fast_order, hash_cut, hash_rank, md5_order, null_safe_join,
                                     sort_positions)


def _order(seed: int, ids: Sequence[str], portable: bool) -> Column:
    return md5_order(seed, *ids) if portable else fast_order(seed, *ids)


def split_random(df: DataFrame, test_ratio: float, ids: Sequence[str], seed: int = 42,
                 rounding: str = "ceil", portable: bool = False):
    """Permutation split with exact sizes.

    n_test = ceil(n * r) (library rule) or int(n * r) (``rounding='floor'``).
    Returns (train, test).
    """
    ids = list(ids)

    def quota(n):
        return [F.ceil(n * test_ratio) if rounding == "ceil" else F.floor(n * test_ratio)]
    r = hash_cut(df, _order(seed, ids, portable), ids, quota, out="_part")
    test = r.filter(F.col("_part") == 0).drop("_part")
    train = r.filter(F.col("_part") == 1).drop("_part")
    return train, test


def split_by_hash(df: DataFrame, id_col: str, test_ratio: float,
                  method: str = "crc32", out: str = "in_test") -> DataFrame:
    """Stable membership from a hash of the little-endian int64 id.

    crc32: crc32(bytes) < ratio * 2^32;  md5: last digest byte < 256 * ratio.
    """
    if method == "crc32":
        cond = crc32_le(id_col) < F.lit(test_ratio * 2 ** 32)
    elif method == "md5":
        cond = md5_last_byte_le(id_col) < F.lit(256 * test_ratio)
    else:
        raise ValueError(method)
    return df.withColumn(out, cond)


def stratum_quota(n: Column, size) -> Column:
    """round-half-up(n * ratio) or an absolute size for one stratum."""
    return F.floor(n * F.lit(float(size)) + 0.5) if isinstance(size, float) else F.lit(size)


def split_stratified(df: DataFrame, strata: Sequence[str], test_size: float,
                     ids: Sequence[str], seed: int = 42, portable: bool = True,
                     out: str = "in_test", n_strata: int | None = None) -> DataFrame:
    """T4: exact per-stratum test counts round(n_s * r), members by hash order.
    ``n_strata`` (an upper bound, e.g. bins + 1 for a NULL bin) skips the
    distinct-count job."""
    ids = list(ids)
    r = hash_cut(df, _order(seed, ids, portable), ids,
                 lambda n: [stratum_quota(n, test_size)], strata=strata, out="_part",
                 n_strata=n_strata)
    return r.withColumn(out, F.col("_part") == 0).drop("_part")


def split_stratified_sizes(df: DataFrame, strata: Sequence[str], test_total: int,
                           ids: Sequence[str], seed: int = 42, portable: bool = True,
                           out: str = "in_test") -> DataFrame:
    """T4 with an absolute test size: largest-remainder allocation over strata.
    The per-stratum allocation table has one row per stratum (small)."""
    sizes = df.groupBy(*strata).count().toPandas()
    n = sizes["count"].sum()
    exact = sizes["count"] * test_total / max(n, 1)
    base = exact.astype(int)
    # largest remainders first; equal ones go by stratum, a NULL stratum last
    sizes["_rem"] = -(exact - base)
    order = sizes.sort_values(["_rem", *strata], kind="mergesort").index[:test_total - base.sum()]
    base.loc[order] += 1
    rows = [(*(None if pd.isna(v) else v for v in key), int(q)) for key, q in
            zip(sizes[list(strata)].itertuples(index=False, name=None), base)]
    schema = StructType([*(df.schema[c] for c in strata), StructField("_q", LongType())])
    quota = df.sparkSession.createDataFrame(rows, schema)
    r = hash_rank(df, _order(seed, ids, portable), list(ids), strata=strata, with_size=False)
    return (null_safe_join(r, quota, list(strata))
             .withColumn(out, F.col("_rank") <= F.col("_q")).drop("_rank", "_q"))


def split_ordered(df: DataFrame, key: str, n_train: int, out: str = "in_train") -> DataFrame:
    """T5: first N rows in key order are train (exact even with gaps in keys)."""
    r = sort_positions(df, key, [key], out="_pos")
    return r.withColumn(out, F.col("_pos") <= n_train).drop("_pos")


def split_three_way(df: DataFrame, fractions: Sequence[float], ids: Sequence[str],
                    seed: int = 42, portable: bool = False, out: str = "part") -> DataFrame:
    """train/valid/test (any number of parts) with exact cut points."""
    ids = list(ids)
    cum, acc = [], 0.0
    for f in fractions[:-1]:
        acc += f
        cum.append(acc)
    return hash_cut(df, _order(seed, ids, portable), ids,
                    lambda n: [F.floor(n * c + 1e-9) for c in cum], out=out)


def kfold(df: DataFrame, k: int, ids: Sequence[str], stratify: str | None = None,
          seed: int = 42, portable: bool = True, out: str = "fold") -> DataFrame:
    """(stratified) fold id = (rank inside stratum - 1) mod k."""
    strata = [stratify] if stratify else []
    r = hash_rank(df, _order(seed, list(ids), portable), list(ids), strata=strata,
                  with_size=False)
    return r.withColumn(out, F.pmod(F.col("_rank") - 1, F.lit(k)).cast("int")).drop("_rank")


def shuffle_split(df: DataFrame, n_sets: int, size: int, ids: Sequence[str],
                  seed: int = 42, out: str = "set_id") -> DataFrame:
    """``n_sets`` random subsets of exactly ``size`` rows each.

    Rows are first thinned per set by a hash threshold (expected 2x size plus
    slack) so the replicated product stays ~ n_sets * size rows, then ranked
    exactly inside each set; sets short of rows after thinning fall back to
    the unthinned ranking for that set only.
    """
    ids = list(ids)
    n = df.count()
    keep = min(1.0, (2.0 * size + 64.0 * math.sqrt(size + 1)) / max(n, 1))
    sets = F.explode(F.sequence(F.lit(0), F.lit(n_sets - 1)))
    rep = df.withColumn(out, sets)
    u = md5_uniform(F.lit(seed), F.col(out), *ids)
    thin = rep.filter(u < F.lit(keep))
    if keep < 1.0:
        sets_left = df.sparkSession.range(n_sets).select(F.col("id").cast("int").alias(out))
        short = sets_left.join(thin.groupBy(out).count(), out, "left") \
            .where(F.coalesce("count", F.lit(0)) < size).select(out)
        refill = [r[0] for r in short.collect()]          # at most n_sets, a parameter
        if refill:
            thin = rep.filter((u < F.lit(keep)) | F.col(out).isin(refill))
    cut = hash_cut(thin, xx_u32(F.col(out), *ids, seed=seed), ids, lambda _: [F.lit(size)],
                   strata=[out], out="_part", n_strata=n_sets)
    return cut.filter(F.col("_part") == 0).drop("_part")


def poisson_thresholds(lam: float, tol: float = 1e-12) -> list[float]:
    """CDF values P(X <= j) of Poisson(lam) for j = 0, 1, ... until the rest
    beyond the mean is below ``tol`` (terms in log space, so any rate works)."""
    out, c, j = [], 0.0, 0
    while True:
        c += math.exp(j * math.log(lam) - lam - math.lgamma(j + 1)) if lam > 0 else float(j == 0)
        out.append(min(c, 1.0))
        if j >= lam and 1.0 - c < tol:
            return out
        if j > lam + 40 * math.sqrt(lam + 1) + 40:        # rounding keeps c off 1
            return out
        j += 1


def poisson_weight(replica: Column, ids: Sequence[str], rate: float, seed: int = 42) -> Column:
    """Poisson(rate) multiplicity of a row in a replica: how many CDF
    values the hash uniform of (seed, replica, ids) has reached."""
    thr = poisson_thresholds(rate)
    u = md5_uniform(F.lit(seed), replica, *ids)
    if len(thr) <= 64:
        return sum((F.when(u >= F.lit(t), 1).otherwise(0) for t in thr), F.lit(0)).cast("int")
    # many thresholds: one array, not one branch each
    return F.aggregate(F.array(*(F.lit(t) for t in thr)), F.struct(u.alias("u"), F.lit(0).alias("n")),
                       lambda a, t: F.struct(a["u"].alias("u"), (a["n"] + (t <= a["u"]).cast("int")).alias("n")),
                       lambda a: a["n"])


def bootstrap(df: DataFrame, n_replicas: int, ids: Sequence[str], max_samples: float = 1.0,
              seed: int = 42, out: str = "weight") -> DataFrame:
    """Sampling with replacement as a Poisson(max_samples) multiplicity per
    (row, replica), in long form."""
    rep = df.withColumn("replica", F.explode(F.sequence(F.lit(0), F.lit(n_replicas - 1))))
    return rep.withColumn(out, poisson_weight(F.col("replica"), ids, max_samples, seed))


def sample_without_replacement(df: DataFrame, n: int, ids: Sequence[str], seed: int = 42,
                               portable: bool = True) -> DataFrame:
    """Exactly n rows, chosen by hash order."""
    r = hash_cut(df, _order(seed, list(ids), portable), list(ids), lambda _: [F.lit(n)],
                 out="_part")
    return r.filter(F.col("_part") == 0).drop("_part")


def shuffle(df: DataFrame, ids: Sequence[str], seed: int = 42, portable: bool = True,
            out: str = "pos") -> DataFrame:
    """A random permutation as an explicit position column (no sort)."""
    return hash_rank(df, _order(seed, list(ids), portable), list(ids), name=out,
                     with_size=False)


def every_nth(df: DataFrame, id_col: str, n: int, offset: int = 0) -> DataFrame:
    """Stride sample."""
    return df.filter(F.pmod(F.col(id_col) - offset, F.lit(n)) == 0)
