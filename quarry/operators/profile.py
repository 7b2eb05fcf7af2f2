"""Profiling and descriptive statistics.

Many statistics are computed in one ``agg`` (one scan, partial aggregation
on every task); exact quantiles use bucketed ranks (``cumulative``) instead
of the ``percentile`` aggregate, whose value map would grow with the data.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from statistics import NormalDist

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from quarry.operators.window import cumulative, value_bucket


# ---------------------------------------------------------------- P1
def head(df: DataFrame, n: int, order: Sequence[str]) -> DataFrame:
    """First n rows in key order (TakeOrderedAndProject, no full sort)."""
    return df.orderBy(*order).limit(n)


# ---------------------------------------------------------------- P2
def info(df: DataFrame) -> DataFrame:
    """Per column type, non-null count and null share, from ONE scan."""
    fields = df.schema.fields
    aggs = [F.count(F.lit(1)).alias("_rows")] + [
        F.count(F.col(f"`{f.name}`")).alias(f"_nn{i}") for i, f in enumerate(fields)]
    one = df.agg(*aggs)
    rows = F.explode(F.array(*[
        F.struct(F.lit(i).alias("position"), F.lit(f.name).alias("column"),
                 F.lit(f.dataType.simpleString()).alias("dtype"),
                 F.col(f"_nn{i}").alias("non_null"))
        for i, f in enumerate(fields)]))
    return (one.select(F.col("_rows"), rows.alias("r"))
               .select("r.position", "r.column", "r.dtype", "r.non_null",
                       (F.col("_rows") - F.col("r.non_null")).alias("null_count"),
                       F.try_divide(F.col("_rows") - F.col("r.non_null"),
                                    F.col("_rows").cast("double")).alias("null_frac")))


# ---------------------------------------------------------------- P3 / P4
def value_counts(df: DataFrame, col: str, normalize: bool = True) -> DataFrame:
    """Counts per value (nulls dropped), optional share of the total.
    The total is one scalar aggregate, not a window over all categories
    (which would put a high-cardinality column in one task)."""
    d = df.filter(F.col(col).isNotNull())
    g = d.groupBy(col).agg(F.count(F.lit(1)).alias("count"))
    if normalize:
        total = d.count()
        g = g.withColumn("share", F.col("count") / F.lit(float(total) if total else None))
    return g


def compare_proportions(full: DataFrame, parts: dict, col: str) -> DataFrame:
    """P5: category shares in the full table and in each named subset, with
    the % error of each subset against the full table."""
    out = value_counts(full, col).select(col, F.col("share").alias("overall"))
    for name, d in parts.items():
        s = value_counts(d, col).select(col, F.col("share").alias(name))
        out = out.join(s, col, "full_outer")
    for name in parts:
        out = out.withColumn(f"{name}_err_pct",
                             100.0 * F.col(name) / F.col("overall") - 100.0)
    return out


# ---------------------------------------------------------------- exact quantiles
def exact_quantiles(df: DataFrame, col: str, probs: Sequence[float],
                    group: Sequence[str] = (), names: Sequence[str] | None = None,
                    n_buckets: int = 1024, n_groups: int | None = None) -> DataFrame:
    """Exact quantiles with linear interpolation (numpy 'linear' rule).

    1. approximate-quantile value buckets (only bucket edges reach the driver),
    2. per (group, bucket) counts and their prefix sums (a small table),
    3. the <= 2 buckets per probability and group that hold the two order
       statistics straddling position (n - 1) p are selected from that table,
    4. only rows of those buckets are ranked (window over a tiny subset) and
       the straddling pair is interpolated.
    The bulk of the data is scanned, never shuffled, and no task holds a
    whole group.
    """
    from quarry.operators.window import TOTALS_BROADCAST_ROWS, null_safe_join, value_bucket
    group = list(group)
    names = list(names or [f"p{int(round(p * 100))}" for p in probs])
    d = df.select(*group, F.col(col).cast("double").alias("_x")).filter(F.col("_x").isNotNull())
    d = value_bucket(d, "_x", n_buckets)
    tot = d.groupBy(*group, "_vb").agg(F.count(F.lit(1)).alias("_c"), F.min("_x").alias("_mn"),
                                       F.max("_x").alias("_mx"))
    wb = Window.partitionBy(*group).orderBy("_vb").rowsBetween(Window.unboundedPreceding, -1)
    tot = tot.select(*group, "_vb", "_c", "_mn", "_mx",
                     F.coalesce(F.sum("_c").over(wb), F.lit(0)).alias("_before"),
                     F.sum("_c").over(Window.partitionBy(*group)).alias("_n"))
    targets = []
    for p in probs:
        h = (F.col("_n") - 1) * float(p)
        lo = F.floor(h) + 1
        targets += [lo, F.least(lo + 1, F.col("_n"))]
    holds = [(F.col("_before") < r) & (r <= F.col("_before") + F.col("_c")) for r in targets]
    need = tot.filter(_any(holds))
    if group and n_groups is None:
        n_groups = df.select(*group).distinct().count()
    small = (n_groups or 1) * len(probs) * 2 <= TOTALS_BROADCAST_ROWS
    # a single-valued bucket (e.g. a hot value) answers its ranks without
    # touching its rows; only buckets with several values are ranked
    const = need.filter(F.col("_mn") == F.col("_mx")).select(
        *group, F.explode(F.array(*[F.when(h_, r) for h_, r in zip(holds, targets)])).alias("_r"),
        F.col("_mn").alias("_x"), "_n").filter(F.col("_r").isNotNull())
    mixed = need.filter(F.col("_mn") < F.col("_mx")).drop("_mn", "_mx")
    sub = null_safe_join(d, mixed, [*group, "_vb"], broadcast=small)
    w = Window.partitionBy(*group, "_vb").orderBy("_x")
    r = sub.withColumn("_r", F.col("_before") + F.row_number().over(w)).select(
        *group, "_r", "_x", "_n").unionByName(const)
    aggs = []
    for p, nm in zip(probs, names):
        h = (F.col("_n") - 1) * float(p)
        lo = F.floor(h) + 1
        hi = F.least(lo + 1, F.col("_n"))
        vlo = F.max(F.when(F.col("_r") == lo, F.col("_x")))
        vhi = F.max(F.when(F.col("_r") == hi, F.col("_x")))
        fr = F.max(h - F.floor(h))
        aggs.append((vlo + (vhi - vlo) * fr).alias(nm))
    return r.groupBy(*group).agg(*aggs)


def approx_quantiles(df: DataFrame, col: str, probs: Sequence[float],
                     group: Sequence[str] = (), names: Sequence[str] | None = None,
                     accuracy: int = 10000) -> DataFrame:
    """P12 opt-in: one-pass approximate quantiles (GK sketches merged per
    group, rank error <= n / accuracy)."""
    names = list(names or [f"p{int(round(p * 100))}" for p in probs])
    q = F.percentile_approx(F.col(col).cast("double"), list(probs), accuracy)
    out = df.groupBy(*group).agg(q.alias("_q"))
    return out.select(*group, *[F.col("_q")[i].alias(n) for i, n in enumerate(names)])


def _any(conds):
    out = conds[0]
    for c in conds[1:]:
        out = out | c
    return out


# ---------------------------------------------------------------- P6
def describe(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Count, mean, std (ddof 1), min, exact quartiles, max per column,
    long form.  Moments come from one agg; quartiles from exact_quantiles."""
    cols = list(cols or [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)])
    aggs = []
    for i, c in enumerate(cols):
        x = F.col(c).cast("double")
        aggs += [F.count(x).alias(f"n{i}"), F.avg(x).alias(f"m{i}"),
                 F.stddev_samp(x).alias(f"s{i}"), F.min(x).alias(f"lo{i}"),
                 F.max(x).alias(f"hi{i}")]
    mom = df.agg(*aggs)
    long = mom.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(f"n{i}").alias("count"),
                 F.col(f"m{i}").alias("mean"), F.col(f"s{i}").alias("std"),
                 F.col(f"lo{i}").alias("min"), F.col(f"hi{i}").alias("max"))
        for i, c in enumerate(cols)])).alias("r")).select("r.*")
    # quartiles for every column in one ranked pass over a long projection
    melted = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("v"))
        for c in cols])).alias("r")).select("r.*")
    q = exact_quantiles(melted, "v", [0.25, 0.5, 0.75], ["column"], ["p25", "p50", "p75"],
                        n_groups=len(cols))
    return long.join(q, "column", "left")


# ---------------------------------------------------------------- P7
def histogram(df: DataFrame, col: str, bins: int) -> DataFrame:
    """Equal-width bins over [min, max], last bin closed on the right.
    min/max are one small aggregate; the bin edges become literals."""
    lo, hi = df.agg(F.min(col), F.max(col)).first()
    if lo is None:
        return df.sparkSession.createDataFrame([], "bin int, lo double, hi double, count long")
    w = (hi - lo) / bins if hi > lo else 1.0
    b = F.least(F.floor((F.col(col) - F.lit(lo)) / F.lit(w)), F.lit(bins - 1)).cast("int")
    return (df.filter(F.col(col).isNotNull()).groupBy(b.alias("bin"))
              .agg(F.count(F.lit(1)).alias("count"))
              .select("bin", (F.lit(lo) + F.col("bin") * F.lit(w)).alias("lo"),
                      (F.lit(lo) + (F.col("bin") + 1) * F.lit(w)).alias("hi"), "count"))


# ---------------------------------------------------------------- P8
def boxplot_stats(df: DataFrame, col: str, group: str, whisker: float = 1.5) -> DataFrame:
    """Per group quartiles, IQR, whisker ends and flier count."""
    q = exact_quantiles(df, col, [0.25, 0.5, 0.75], [group], ["q1", "median", "q3"])
    q = q.withColumn("iqr", F.col("q3") - F.col("q1"))
    j = df.select(group, col).join(q, group)
    lo_lim = F.col("q1") - whisker * F.col("iqr")
    hi_lim = F.col("q3") + whisker * F.col("iqr")
    inside = (F.col(col) >= lo_lim) & (F.col(col) <= hi_lim)
    return j.groupBy(group).agg(
        F.first("q1").alias("q1"), F.first("median").alias("median"),
        F.first("q3").alias("q3"), F.first("iqr").alias("iqr"),
        F.min(F.when(inside, F.col(col))).alias("whisker_lo"),
        F.max(F.when(inside, F.col(col))).alias("whisker_hi"),
        F.sum(F.when(~inside, 1).otherwise(0)).cast("long").alias("n_fliers"))


# ---------------------------------------------------------------- P9 / P10
def safe_corr(a: str, b: str):
    """Pearson over rows where both are non-null; NULL (not an ANSI
    division error) for a constant column."""
    both = F.col(a).isNotNull() & F.col(b).isNotNull()
    x = F.when(both, F.col(a).cast("double"))
    y = F.when(both, F.col(b).cast("double"))
    return F.try_divide(F.covar_samp(x, y), F.stddev_samp(x) * F.stddev_samp(y))


def corr_matrix(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Pairwise-complete Pearson correlations, all pairs in ONE agg."""
    cols = list(cols)
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i:]]
    one = df.agg(*[safe_corr(a, b).alias(f"c{k}") for k, (a, b) in enumerate(pairs)])
    structs = []
    for k, (a, b) in enumerate(pairs):
        structs.append(F.struct(F.lit(a).alias("col_a"), F.lit(b).alias("col_b"),
                                F.col(f"c{k}").alias("corr")))
        if a != b:
            structs.append(F.struct(F.lit(b).alias("col_a"), F.lit(a).alias("col_b"),
                                    F.col(f"c{k}").alias("corr")))
    return one.select(F.explode(F.array(*structs)).alias("r")).select("r.*")


def corr_with(df: DataFrame, cols: Sequence[str], target: str) -> DataFrame:
    """P10: correlation of each column with the target, sorted descending."""
    one = df.agg(*[safe_corr(c, target).alias(c) for c in cols])
    return (one.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).alias("corr")) for c in cols])).alias("r"))
        .select("r.*").orderBy(F.col("corr").desc()))


# ---------------------------------------------------------------- P11
def scatter_bins(df: DataFrame, x: str, y: str, wx: float, wy: float) -> DataFrame:
    """2-D bin counts (the data behind scatter / density plots)."""
    return (df.filter(F.col(x).isNotNull() & F.col(y).isNotNull())
              .groupBy(F.floor(F.col(x) / wx).alias("bx"), F.floor(F.col(y) / wy).alias("by"))
              .agg(F.count(F.lit(1)).alias("count")))


# ---------------------------------------------------------------- P13
def t_ppf(q: float, df_: float) -> float:
    """Student-t quantile by bisection on the CDF (regularised incomplete beta)."""
    def cdf(t):
        x = df_ / (df_ + t * t)
        ib = _betainc(df_ / 2.0, 0.5, x)
        return 1.0 - 0.5 * ib if t >= 0 else 0.5 * ib
    lo, hi = -1e3, 1e3
    for _ in range(200):
        mid = (lo + hi) / 2
        if cdf(mid) < q:
            lo = mid
        else:
            hi = mid
    return (lo + hi) / 2


def _betainc(a: float, b: float, x: float) -> float:
    if x <= 0.0:
        return 0.0
    if x >= 1.0:
        return 1.0
    lbeta = math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b)
    front = math.exp(math.log(x) * a + math.log(1 - x) * b + lbeta)
    if x < (a + 1) / (a + b + 2):
        return front * _betacf(a, b, x) / a
    return 1.0 - front * _betacf(b, a, 1 - x) / b


def _betacf(a, b, x, it=300, eps=1e-15):
    qab, qap, qam = a + b, a + 1, a - 1
    c, d = 1.0, 1 - qab * x / qap
    d = 1 / (d if abs(d) > 1e-300 else 1e-300)
    h = d
    for m in range(1, it):
        m2 = 2 * m
        aa = m * (b - m) * x / ((qam + m2) * (a + m2))
        d = 1 + aa * d
        d = 1 / (d if abs(d) > 1e-300 else 1e-300)
        c = 1 + aa / c if abs(1 + aa / c) > 1e-300 else 1e-300
        h *= d * c
        aa = -(a + m) * (qab + m) * x / ((a + m2) * (qap + m2))
        d = 1 + aa * d
        d = 1 / (d if abs(d) > 1e-300 else 1e-300)
        c = 1 + aa / c if abs(1 + aa / c) > 1e-300 else 1e-300
        de = d * c
        h *= de
        if abs(de - 1) < eps:
            break
    return h


def conf_interval(df: DataFrame, sq_err: str, level: float = 0.95,
                  dist: str = "t") -> DataFrame:
    """Interval for RMSE: mean(e^2) +- q * s / sqrt(m), then sqrt.
    One agg on the executors; the quantile is a driver scalar."""
    m, mean, sd = df.agg(F.count(sq_err), F.avg(sq_err), F.stddev_samp(sq_err)).first()
    q = (NormalDist().inv_cdf((1 + level) / 2) if dist == "normal"
         else t_ppf((1 + level) / 2, m - 1))
    return interval_frame(df, sq_err, q)


def interval_frame(df: DataFrame, sq_err: str, q: float) -> DataFrame:
    a = df.agg(F.count(sq_err).alias("m"), F.avg(sq_err).alias("mse"),
               F.stddev_samp(sq_err).alias("sd"))
    half = F.lit(q) * F.col("sd") / F.sqrt(F.col("m").cast("double"))
    return a.select("m", F.sqrt("mse").alias("rmse"),
                    F.sqrt(F.greatest(F.col("mse") - half, F.lit(0.0))).alias("lo"),
                    F.sqrt(F.col("mse") + half).alias("hi"))


# ---------------------------------------------------------------- P14
def score_summary(df: DataFrame, score: str, group: Sequence[str] = ()) -> DataFrame:
    """Mean and population std of a score table (e.g. per-fold RMSE)."""
    return df.groupBy(*group).agg(F.count(score).alias("n"), F.avg(score).alias("mean"),
                                  F.stddev_pop(score).alias("std"))
