"""Ordered computations without a single-partition window.

``cumulative`` is the core: running sums in a global (or per-stratum) order,
computed as
  1. a monotone bucket per row (hash prefix or value quantile),
  2. per-bucket totals (map-side partial aggregation, tiny result),
  3. prefix sums over the bucket totals (bounded: strata x buckets rows),
  4. a window partitioned by (strata, bucket) for the rank inside a bucket.
No task ever sees more than one bucket of one stratum, so a hot stratum is
spread over all of its buckets.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.functions.hashing import md5_u32, key_text, xx_u32

HASH_BITS = 16


def _cols(xs):
    return [F.col(x) if isinstance(x, str) else x for x in xs]


TOTALS_BROADCAST_ROWS = 2_000_000


def null_safe_join(d: DataFrame, small: DataFrame, keys: Sequence[str],
                   broadcast: bool = False) -> DataFrame:
    """Inner equi-join on ``keys`` with <=> so a NULL stratum is a group of
    its own instead of being dropped."""
    ren = {k: f"_jk_{k}" for k in keys}
    t = small
    for k, v in ren.items():
        t = t.withColumnRenamed(k, v)
    if broadcast:
        t = F.broadcast(t)
    cond = [F.col(k).eqNullSafe(F.col(v)) for k, v in ren.items()]
    return d.join(t, cond).drop(*ren.values())


def cumulative(df: DataFrame, bucket: Column, order: Sequence, sums: dict,
               strata: Sequence[str] = (), totals: bool = False,
               max_buckets: int = 2 ** 16, n_strata: int | None = None) -> DataFrame:
    """Add inclusive running sums ``sums`` (name -> Column) in ``order``.

    ``bucket`` must be monotone in ``order`` (a < b in order => bucket(a) <=
    bucket(b)); ``order`` must be a total order inside a stratum.  With
    ``totals`` also adds ``<name>_total`` (the stratum total).
    """
    strata = list(strata)
    names = list(sums)
    d = df.withColumn("_bkt", F.col(bucket) if isinstance(bucket, str) else bucket)
    for n in names:
        d = d.withColumn(f"_v_{n}", sums[n])
    tot = d.groupBy(*strata, "_bkt").agg(*[F.sum(f"_v_{n}").alias(f"_t_{n}") for n in names])
    wb = Window.partitionBy(*strata).orderBy("_bkt").rowsBetween(Window.unboundedPreceding, -1)
    wt = Window.partitionBy(*strata)
    tot = tot.select(*strata, "_bkt", *[
        F.coalesce(F.sum(f"_t_{n}").over(wb), F.lit(0)).alias(f"_b_{n}") for n in names],
        *([F.sum(f"_t_{n}").over(wt).alias(f"{n}_total") for n in names] if totals else []))
    # the totals table has at most n_strata x max_buckets rows: broadcast it
    # when that bound is small, otherwise join it by a shuffle
    if strata and n_strata is None:
        n_strata = df.select(*strata).distinct().count()
    small = (n_strata or 1) * max_buckets <= TOTALS_BROADCAST_ROWS
    d = null_safe_join(d, tot, [*strata, "_bkt"], broadcast=small)
    wr = (Window.partitionBy(*strata, "_bkt").orderBy(*_cols(order))
          .rowsBetween(Window.unboundedPreceding, 0))
    for n in names:
        d = d.withColumn(n, F.col(f"_b_{n}") + F.sum(f"_v_{n}").over(wr))
    return d.drop("_bkt", *[f"_v_{n}" for n in names], *[f"_b_{n}" for n in names])


def hash_cut(df: DataFrame, order_u32: Column, tiebreak: Sequence, cuts,
             strata: Sequence[str] = (), out: str = "part", bits: int | None = None,
             n_strata: int | None = None) -> DataFrame:
    """Exact "which of the quota intervals does the row's rank fall in",
    without ranking every row.

    ``cuts(n)`` maps the stratum size (Column) to non-decreasing quotas
    q_1..q_m; ``out`` = #{i : rank > q_i}.  Bucket totals + prefix sums
    (strata x 2^bits rows, broadcast) settle every bucket that lies fully on
    one side of every quota; only rows of the (at most m per stratum)
    boundary buckets are ranked, by a window over those rows alone.  The
    bulk of the data is never shuffled.
    """
    import math
    strata = list(strata)
    if n_strata is None:
        n_strata = df.select(*strata).distinct().count() if strata else 1
    if bits is None:
        bits = int(max(4, min(HASH_BITS, math.floor(math.log2(
            TOTALS_BROADCAST_ROWS / max(n_strata, 1))))))
    d = df.withColumn("_h", order_u32).withColumn("_bkt", F.shiftright(F.col("_h"), 32 - bits))
    tot = d.groupBy(*strata, "_bkt").agg(F.count(F.lit(1)).alias("_c"))
    wb = Window.partitionBy(*strata).orderBy("_bkt").rowsBetween(Window.unboundedPreceding, -1)
    tot = tot.select(*strata, "_bkt", "_c",
                     F.coalesce(F.sum("_c").over(wb), F.lit(0)).alias("_before"),
                     F.sum("_c").over(Window.partitionBy(*strata)).alias("_n"))
    qs = cuts(F.col("_n"))
    lo = sum((F.when(F.col("_before") >= q, 1).otherwise(0) for q in qs), F.lit(0))
    hi = sum((F.when(F.col("_before") + F.col("_c") > q, 1).otherwise(0) for q in qs), F.lit(0))
    tot = tot.withColumn("_lo", lo).withColumn("_hi", hi)
    small = n_strata * (2 ** bits) <= TOTALS_BROADCAST_ROWS
    j = null_safe_join(d, tot, [*strata, "_bkt"], broadcast=small)
    sure = j.filter(F.col("_lo") == F.col("_hi")).withColumn(out, F.col("_lo"))
    w = Window.partitionBy(*strata, "_bkt").orderBy(F.col("_h"), *_cols(tiebreak))
    unsure = j.filter(F.col("_lo") < F.col("_hi")).withColumn(
        "_rank", F.col("_before") + F.row_number().over(w))
    unsure = unsure.withColumn(out, sum((F.when(F.col("_rank") > q, 1).otherwise(0)
                                         for q in cuts(F.col("_n"))), F.lit(0))).drop("_rank")
    helpers = ["_h", "_bkt", "_c", "_before", "_n", "_lo", "_hi"]
    return sure.unionByName(unsure).withColumn(out, F.col(out).cast("int")).drop(*helpers)


def stratum_sizes(df: DataFrame, strata: Sequence[str], name: str = "_n") -> DataFrame:
    return df.groupBy(*strata).agg(F.count(F.lit(1)).alias(name))


def hash_rank(df: DataFrame, order_u32: Column, tiebreak: Sequence,
              strata: Sequence[str] = (), name: str = "_rank",
              bits: int = HASH_BITS, with_size: bool = True) -> DataFrame:
    """Exact 1-based rank inside each stratum by (order_u32, *tiebreak).

    ``order_u32`` is a uniform hash in [0, 2^32); its top ``bits`` bits are
    the bucket.  Adds ``_n`` (stratum size) when ``with_size``.
    """
    d = df.withColumn("_h", order_u32)
    out = cumulative(d, F.shiftright(F.col("_h"), 32 - bits), ["_h", *tiebreak],
                     {name: F.lit(1).cast("long")}, strata, totals=with_size,
                     max_buckets=2 ** bits)
    if with_size:
        out = out.withColumnRenamed(f"{name}_total", "_n")
    return out.drop("_h")


def md5_order(seed: int, *id_cols) -> Column:
    """SQL-portable order key: md5('seed|id...') prefix (DuckDB twin exists)."""
    return md5_u32(key_text(F.lit(seed), *id_cols))


def fast_order(seed: int, *id_cols) -> Column:
    return xx_u32(*id_cols, seed=seed)


#: Rows that one value bucket may hold (one window task ranks one bucket).
MAX_BUCKET_ROWS = 4_000_000


def bucket_plan(n_rows: int, n_buckets: int = 1024, rel_err: float = 1e-3,
                max_rows: int = MAX_BUCKET_ROWS) -> tuple[int, float]:
    """(buckets, rank error) so that a bucket between two approximate
    quantiles, n / buckets + 2 * error * n rows at most, holds ``max_rows``."""
    if n_rows * (1.0 / n_buckets + 2 * rel_err) <= max_rows:
        return n_buckets, rel_err
    need = -(-4 * n_rows // max_rows)
    return max(n_buckets, need), min(rel_err, max_rows / (4.0 * n_rows))


def value_bucket(df: DataFrame, col: str, n_buckets: int = 1024, out: str = "_vb",
                 rel_err: float = 1e-3, descending: bool = False, return_hot: bool = False,
                 max_rows: int = MAX_BUCKET_ROWS):
    """Add a monotone bucket of a numeric column from approximate quantiles.

    The number of buckets and the precision of the quantiles follow the row
    count, so that no bucket of several values holds more than ``max_rows``
    rows at any size.  Only the boundary values reach the driver; MLlib's
    Bucketizer does the binary search on the executors.  A value that fills several
    quantile slots (a hot value) gets a bucket of its own, [v, next double),
    so it never shares a bucket with other values.  Nulls get their own
    bucket.
    """
    import math
    n_buckets, rel_err = bucket_plan(df.count(), n_buckets, rel_err, max_rows)
    probs = [i / n_buckets for i in range(1, n_buckets)]
    qs = [float(q) for q in df.approxQuantile(col, probs, rel_err)] if n_buckets > 1 else []
    hot = {q for q in qs if qs.count(q) > 1}
    edges = set(qs) | {math.nextafter(v, math.inf) for v in hot}
    splits = [float("-inf"), *sorted(e for e in edges if math.isfinite(e)), float("inf")]
    tmp = f"{out}_x"
    d = df.withColumn(tmp, F.col(col).cast("double"))
    d = Bucketizer(splits=splits, inputCol=tmp, outputCol=out,
                   handleInvalid="keep").transform(d).drop(tmp)
    b = F.col(out).cast("int")
    d = d.withColumn(out, -b if descending else b)
    return (d, sorted(hot)) if return_hot else d


# ---------------------------------------------------------------- W1
def running_mean(df: DataFrame, key: str, order: Sequence[str], value: str,
                 out: str = "running_mean") -> DataFrame:
    """Cumulative mean per series (running sum / running count).

    Rows are bucketed by approximate quantiles of the first order column, so
    a series holding a third of all rows is spread over the buckets instead
    of one window task; ``order`` must be a total order inside a series."""
    first = order[0]
    d = df.withColumn("_o", F.col(first).cast("double") if dict(df.dtypes)[first] not in
                      ("timestamp", "timestamp_ntz", "date") else F.unix_micros(
                          F.col(first).cast("timestamp")).cast("double"))
    d = value_bucket(d, "_o", 1024)
    c = cumulative(d, "_vb", [F.col(o) for o in order],
                   {"_rs": F.col(value).cast("double"),
                    "_rc": F.when(F.col(value).isNotNull(), 1).otherwise(0).cast("long")},
                   [key], max_buckets=1024)
    return c.withColumn(out, F.try_divide(F.col("_rs"), F.col("_rc"))).drop("_o", "_vb", "_rs",
                                                                            "_rc")


# ---------------------------------------------------------------- W2
def first_index_reaching(df: DataFrame, order: str, value: str, target: float) -> DataFrame:
    """Running share of ``value`` and the first ``order`` index where it
    reaches ``target`` (input is the small k-row eigenvalue table)."""
    w = Window.orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    d = df.withColumn("cum_share", F.sum(value).over(w) / F.sum(value).over(Window.partitionBy()))
    return d.withColumn("reached", F.col("cum_share") >= F.lit(target))


# ---------------------------------------------------------------- W3
def order_bucket(df: DataFrame, col: str, tiebreak: Sequence[str], n_buckets: int = 1024,
                 descending: bool = False):
    """Monotone bucket for the order (col, *tiebreak): value buckets, and
    for a hot value (one that fills several quantile slots) sub-buckets by
    quantiles of the first numeric tie-break column, so ties of a value held
    by a third of the rows are ranked by many tasks.  Returns (df with
    ``_ob``, bucket bound)."""
    d, hot = value_bucket(df, col, n_buckets, descending=descending, return_hot=True)
    t0 = tiebreak[0] if tiebreak else None
    numeric = t0 is not None and dict(df.dtypes).get(t0, "") in (
        "int", "bigint", "smallint", "tinyint", "double", "float")
    if not (hot and numeric):
        return d.withColumn("_ob", F.col("_vb").cast("long")).drop("_vb"), n_buckets
    is_hot = F.col(col).cast("double").isin([float(h) for h in hot])
    probs = [i / n_buckets for i in range(1, n_buckets)]
    tq = sorted(set(float(q) for q in df.filter(is_hot).approxQuantile(t0, probs, 1e-3)))
    width = len(tq) + 2
    d = Bucketizer(splits=[float("-inf"), *tq, float("inf")], inputCol="_tb", outputCol="_sb",
                   handleInvalid="keep").transform(d.withColumn("_tb", F.col(t0).cast("double")))
    sub = F.when(is_hot, F.col("_sb").cast("long")).otherwise(F.lit(0))
    d = d.withColumn("_ob", F.col("_vb").cast("long") * width + sub).drop("_vb", "_tb", "_sb")
    return d, n_buckets + len(hot) * width


def sort_positions(df: DataFrame, col: str, tiebreak: Sequence[str], out: str = "pos",
                   descending: bool = False, n_buckets: int = 1024) -> DataFrame:
    """Exact 1-based position in a global sort by (col, *tiebreak),
    without a one-partition sort (see ``order_bucket`` for hot values)."""
    d, max_b = order_bucket(df, col, tiebreak, n_buckets, descending)
    key = F.col(col).desc() if descending else F.col(col).asc()
    return cumulative(d, "_ob", [key, *tiebreak], {out: F.lit(1).cast("long")},
                      max_buckets=max_b).drop("_ob")


# ---------------------------------------------------------------- W4
def top_k(df: DataFrame, k: int, by: str, tiebreak: Sequence[str] = (),
          descending: bool = True) -> DataFrame:
    """K rows with the largest (smallest) ``by``; ties by ``tiebreak``.
    orderBy+limit plans as TakeOrderedAndProject: k rows per task, no sort."""
    key = F.col(by).desc() if descending else F.col(by).asc()
    return df.orderBy(key, *[F.col(t).asc() for t in tiebreak]).limit(k)


def top_k_per_group(df: DataFrame, k: int, group: Sequence[str], by: str,
                    tiebreak: Sequence[str] = (), descending: bool = True,
                    out: str = "rank") -> DataFrame:
    key = F.col(by).desc() if descending else F.col(by).asc()
    w = Window.partitionBy(*group).orderBy(key, *tiebreak)
    # Catalyst turns rank-filter into a WindowGroupLimit (partial top-k per task)
    return df.withColumn(out, F.row_number().over(w)).filter(F.col(out) <= k)


# ---------------------------------------------------------------- W5
def top_k_indices(df: DataFrame, array_col: str, k: int, out: str = "top_idx") -> DataFrame:
    """Indices of the k largest array elements, returned in ascending index order."""
    pairs = F.transform(array_col, lambda x, i: F.struct((-x).alias("nv"), i.alias("i")))
    best = F.slice(F.array_sort(pairs), 1, k)
    return df.withColumn(out, F.array_sort(F.transform(best, lambda s: s["i"])))


# ---------------------------------------------------------------- W6
def best_per_group(df: DataFrame, group: str, by: str, id_col: str,
                   out_prefix: str = "best") -> DataFrame:
    """Row with the smallest ``by`` per group (ties: smallest id).
    min_by is a partial aggregate: map-side combine before the shuffle."""
    return df.groupBy(group).agg(
        F.min_by(F.col(id_col), F.struct(F.col(by), F.col(id_col))).alias(f"{out_prefix}_{id_col}"),
        F.min(by).alias(f"{out_prefix}_{by}"))


# ---------------------------------------------------------------- W7
def percentile_cut(df: DataFrame, group: str, by: str, p: float) -> DataFrame:
    """Keep rows whose ``by`` is at most the per-group p-th percentile."""
    from quarry.operators.profile import exact_quantiles
    cuts = exact_quantiles(df, by, [p], [group], ["_cut"])
    return df.join(cuts, group).filter(F.col(by) <= F.col("_cut")).drop("_cut")


# ---------------------------------------------------------------- W8
def ordered_by_group(df: DataFrame, group: str, by: str, tiebreak: Sequence[str] = (),
                     out: str = "pos") -> DataFrame:
    """Position of each row inside its group in ``by`` order (silhouette
    diagram layout).  A hot group is spread over global value buckets."""
    d, max_b = order_bucket(df, by, tiebreak)
    return cumulative(d, "_ob", [by, *tiebreak], {out: F.lit(1).cast("long")}, [group],
                      max_buckets=max_b).drop("_ob")


# ---------------------------------------------------------------- W9
def grid_thin(df: DataFrame, x: str, y: str, d: float, id_col: str) -> DataFrame:
    """Keep one point per d x d grid cell (the smallest id).  Replaces the
    sequential greedy thinning; result has no two points in one cell."""
    cell = df.withColumn("cx", F.floor(F.col(x) / d)).withColumn("cy", F.floor(F.col(y) / d))
    return cell.groupBy("cx", "cy").agg(
        F.min_by(F.struct(id_col, x, y), F.col(id_col)).alias("_p")).select(
        "cx", "cy", F.col(f"_p.{id_col}").alias(id_col), F.col(f"_p.{x}").alias(x),
        F.col(f"_p.{y}").alias(y))
