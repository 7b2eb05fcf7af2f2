"""Clustering.

Centroids (k x d, k a parameter) travel as literals inside the plan, so the
assignment step is a projection, not a join; each Lloyd / seeding step is
one partial aggregation.  DBSCAN uses the graph of cells (2-D, cells.py) or
blocks of rows (high-d, pivots.py), and connected components by star contraction, checkpointed
each round.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.ml.clustering import BisectingKMeans, KMeans, PowerIterationClustering
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions.arrays import lit_vector, sq_dist
from quarry.functions.hashing import md5_uniform
from quarry.operators.cells import cell_dbscan
from quarry.operators.graph import FEW, star_components
from quarry.operators.joins import knn_join, nearest_centroid
from quarry.operators.pivots import TABLE_QUERIES, TABLE_ROWS, Blocks, Products, exact, matrix, narrow, send
from quarry.operators.window import sort_positions, top_k_per_group
from quarry.session import cut_lineage, scratch_path


# ---------------------------------------------------------------- C1
def kmeans(df: DataFrame, vec: str, k: int, seed: int = 42, init: str = "k-means||",
           max_iter: int = 20):
    """MLlib k-means (k-means|| or random init) on an array column."""
    d = df.withColumn("_v", array_to_vector(F.col(vec)))
    return KMeans(k=k, seed=seed, initMode=init, maxIter=max_iter, featuresCol="_v",
                  predictionCol="cluster").fit(d)


# ---------------------------------------------------------------- C2
def lloyd(df: DataFrame, vec: str, centroids: Sequence[Sequence[float]], max_iter: int = 10,
          tol: float = 1e-4) -> dict:
    """K-means from GIVEN initial centroids with an iteration cap.
    Returns centroids per iteration, n_iter and the inertia of the rows about
    the returned centroids.  An empty cluster keeps its previous centroid."""
    from quarry.operators.aggregate import complete_rows
    from quarry.operators.linear import sum_pass
    cents = [list(map(float, c)) for c in centroids]
    k, dim, history, n_iter = len(cents), len(cents[0]), [cents], 0
    data = complete_rows(df.select(F.col(vec).alias("x")), "x").persist()

    def sums(centres: np.ndarray):
        """Rows, sums and squared distances per cluster, in one pass whose plan is
        the same each time: the centroids travel with the function."""
        def fn(X, pdf):
            near = np.empty((len(X), k))
            for j, c in enumerate(centres):
                diff = X - c
                near[:, j] = (diff * diff).sum(1)
            own = near.argmin(1)
            at = np.eye(k)[own]
            return np.concatenate([at.sum(0), (at.T @ X).ravel(), [near[np.arange(len(X)), own].sum()]])
        s = sum_pass(data, fn, k + k * dim + 1)
        return s[:k], s[k:-1].reshape(k, dim), s[-1]

    try:
        for n_iter in range(1, max_iter + 1):
            n, total, _ = sums(np.array(cents))
            new = [(total[j] / n[j]).tolist() if n[j] else list(cents[j]) for j in range(k)]
            shift = max(float(np.linalg.norm(np.subtract(a, c))) for a, c in zip(new, cents))
            cents = new
            history.append(cents)
            if shift <= tol:
                break
        inertia = sums(np.array(cents))[2]
    finally:
        data.unpersist()
    return {"centroids": cents, "history": history, "inertia": float(inertia or 0.0), "n_iter": n_iter}


def assign(df: DataFrame, vec: str, centroids) -> DataFrame:
    return nearest_centroid(df, vec, centroids)


# ---------------------------------------------------------------- C3
def kmeans_pp_init(df: DataFrame, vec: str, id_col: str, k: int, seed: int = 42) -> list:
    """K-means++ seeding (D^2 sampling).  Each draw is ONE aggregate:
    weighted sampling by the largest log(u)/w key (Efraimidis-Spirakis) with
    u a hash uniform of (seed, draw, id) and w the squared distance to the
    nearest chosen centre."""
    u0 = md5_uniform(F.lit(seed), F.lit(0), F.col(id_col))
    first = df.agg(F.min_by(F.col(vec), u0)).first()[0]
    cents = [list(first)]
    for j in range(1, k):
        d2 = F.array_min(F.array(*[sq_dist(F.col(vec), lit_vector(c)) for c in cents]))
        u = md5_uniform(F.lit(seed), F.lit(j), F.col(id_col))
        key = F.log(u + F.lit(1e-300)) / d2
        row = df.filter(d2 > 0).agg(F.max_by(F.col(vec), key)).first()[0]
        if row is None:
            break
        cents.append(list(row))
    return cents


def best_of_n_init(df: DataFrame, vec: str, id_col: str, k: int, n_init: int = 3,
                   max_iter: int = 10, seed: int = 42) -> dict:
    """Run seeding + Lloyd from ``n_init`` seeds and keep the lowest inertia."""
    best = None
    for s in range(n_init):
        r = lloyd(df, vec, kmeans_pp_init(df, vec, id_col, k, seed + s), max_iter)
        r["seed"] = seed + s
        if best is None or r["inertia"] < best["inertia"]:
            best = r
    return best


# ---------------------------------------------------------------- C4
def choose_k(df: DataFrame, vec: str, ks: Sequence[int], seed: int = 42) -> list:
    """C4: inertia and (squared-Euclidean, linear-cost) silhouette per k."""
    d = df.withColumn("_v", array_to_vector(F.col(vec))).cache()
    ev = ClusteringEvaluator(featuresCol="_v", predictionCol="cluster")
    out = []
    for k in ks:
        m = KMeans(k=k, seed=seed, featuresCol="_v", predictionCol="cluster").fit(d)
        out.append((k, float(m.summary.trainingCost), float(ev.evaluate(m.transform(d)))))
    d.unpersist()
    return out


# ---------------------------------------------------------------- C5 / C6 / C7
def representatives(df: DataFrame, vec: str, id_col: str, centroids) -> DataFrame:
    """The row closest to each centroid."""
    a = nearest_centroid(df, vec, centroids)
    return a.groupBy("cluster").agg(
        F.min_by(F.col(id_col), F.struct("dist", id_col)).alias(id_col),
        F.min("dist").alias("dist"))


def propagate_labels(assigned: DataFrame, rep_labels: DataFrame, cluster: str = "cluster",
                     dist: str = "dist", percentile: float | None = None) -> DataFrame:
    """Every row takes its cluster representative's label; with
    ``percentile`` only rows within that per-cluster distance percentile."""
    from quarry.operators.window import percentile_cut
    d = assigned.join(rep_labels, cluster)
    return percentile_cut(d, cluster, dist, percentile) if percentile is not None else d


def least_certain(pred: DataFrame, prob: str, cluster: str, n_per_cluster: int,
                  id_col: str) -> DataFrame:
    """Rows with the lowest top probability, spread over clusters."""
    d = pred.withColumn("uncertainty", 1.0 - F.array_max(F.col(prob)))
    return top_k_per_group(d, n_per_cluster, [cluster], "uncertainty", [F.col(id_col)])


# ---------------------------------------------------------------- C8
def connected_components(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """Component id = smallest node id; nodes without edges are their own."""
    found = star_components(edges)
    return nodes.join(found, "id", "left").select("id", F.coalesce("comp", "id").alias("comp"))


def _tables(q: np.ndarray, b: np.ndarray, eps: float, needed=None):
    """(slice of the queries, slice of the base rows, which are within eps of each), a
    few at a time; distances that rounding could place on either side are taken
    from differences.  Tables that are not ``needed`` are left out."""
    near, limit = Products(b), eps * eps
    for at in range(0, len(q), TABLE_QUERIES):
        one = slice(at, min(at + TABLE_QUERIES, len(q)))
        a, cut, parts = near.ready(q[one])
        most, sure = cut(limit * (1 + 1e-12)), cut(limit * (1 - 1e-12), sure=True)
        for j, part in enumerate(parts):
            two = slice(j * TABLE_ROWS, min((j + 1) * TABLE_ROWS, len(b)))
            if needed is not None and not needed(one, two):
                continue
            table = a @ part
            close = table <= sure
            r, c = np.nonzero(~close & (table <= most))
            if len(r):
                close[r, c] = exact(q[one], b[two], r, c) <= eps
            yield one, two, close


def _count_near(eps: float):
    """Of each query its number of neighbours of other ids in a block."""
    def count(qp: pd.DataFrame, bp: pd.DataFrame) -> pd.DataFrame:
        qi, bi = qp["qid"].to_numpy(), bp["nid"].to_numpy()
        n = np.zeros(len(qp), np.int64)
        if len(qi) and len(bi):
            here = np.isin(qi, bi)
            for one, two, near in _tables(matrix(qp["qv"]), matrix(bp["bv"]), eps):
                own = np.flatnonzero(here[one])
                near[own] &= qi[one][own][:, None] != bi[None, two]
                n[one] += near.sum(1)
        return pd.DataFrame({"id": qi.astype(np.int64), "n": n})
    return count


def _joined(root: np.ndarray, u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Of each class (a number) the least one of its set, after u and v are joined."""
    while True:
        u, v = root[u], root[v]
        open_ = u != v
        if not open_.any():
            return root
        u, v = u[open_], v[open_]
        np.minimum.at(root, np.maximum(u, v), np.minimum(u, v))
        while (root[root] != root).any():
            root = root[root]


def _link_classes(eps: float):
    """The classes (qc, bc) joined by rows within eps, as stars (u, v).  Rows go by
    class; a table whose classes are joined already is left out."""
    def link(qp: pd.DataFrame, bp: pd.DataFrame) -> pd.DataFrame:
        none = pd.DataFrame({"u": np.zeros(0, np.int64), "v": np.zeros(0, np.int64)})
        if not len(qp) or not len(bp):
            return none
        qp, bp = qp.iloc[np.argsort(qp["qc"].to_numpy(), kind="stable")], bp.iloc[np.argsort(bp["bc"].to_numpy(), kind="stable")]
        names, kind = np.unique(np.r_[qp["qc"].to_numpy(np.int64), bp["bc"].to_numpy(np.int64)], return_inverse=True)
        qk, bk = kind[:len(qp)], kind[len(qp):]
        root = np.arange(len(names))

        def apart(one, two):
            x, y = root[qk[one]], root[bk[two]]
            return x.min() != x.max() or y.min() != y.max() or x[0] != y[0]

        for one, two, near in _tables(matrix(qp["qv"]), matrix(bp["bv"]), eps, apart):
            x, y = qk[one], bk[two]
            i, j = np.flatnonzero(np.r_[True, x[1:] != x[:-1]]), np.flatnonzero(np.r_[True, y[1:] != y[:-1]])
            touch = np.logical_or.reduceat(near, j, axis=1) if len(j) < len(y) else near
            touch = np.logical_or.reduceat(touch, i, axis=0) if len(i) < len(x) else touch
            r, c = np.nonzero(touch)
            root = _joined(root, x[i[r]], y[j[c]])
        moved = np.flatnonzero(root != np.arange(len(root)))
        return pd.DataFrame({"u": names[moved], "v": names[root[moved]]})
    return link


def _least_class(eps: float):
    """Of each query the least class of the base rows within eps."""
    def least(qp: pd.DataFrame, bp: pd.DataFrame) -> pd.DataFrame:
        bp = bp.iloc[np.argsort(bp["bc"].to_numpy(), kind="stable")]
        qi, bc = qp["qid"].to_numpy(), bp["bc"].to_numpy()
        at = np.full(len(qi), -1, np.int64)
        if len(qi) and len(bc):
            for one, two, near in _tables(matrix(qp["qv"]), matrix(bp["bv"]), eps, lambda one, two: (at[one] < 0).any()):
                fresh = np.flatnonzero((at[one] < 0) & near.any(1))
                at[one.start + fresh] = two.start + near[fresh].argmax(1)
        some = np.flatnonzero(at >= 0)
        return pd.DataFrame({"id": qi[some].astype(np.int64), "comp": bc[at[some]].astype(np.int64)})
    return least


def _vector_dbscan(df: DataFrame, id_col: str, eps: float, min_samples: int, vec: str,
                   block_rows: int = 2048) -> DataFrame:
    """(id, comp, is_core).  Neighbours are tested block against block and only
    counted, in a row's own block first: a row that is core by that is not asked
    again.  No pair is written.  Core rows are joined to clusters inside their
    own blocks first; then blocks report which clusters of theirs touch."""
    spark = df.sparkSession
    rows = narrow(df.select(F.col(id_col).cast("long").alias("nid"), F.col(vec).alias("bv")), "bv")
    path = scratch_path(spark, "dbscan_rows")
    rows.write.parquet(path)
    rows = spark.read.parquet(path)
    asks = lambda d: d.withColumnRenamed("nid", "qid").withColumnRenamed("bv", "qv").withColumn("tau", F.lit(float(eps)))

    def meet(blocks, asked, fn, schema, **more):
        asked, held, *rest = send(asked, blocks, block_rows, **more)
        return asked.groupBy("block", "share").cogroup(held.groupBy("block", "share")).applyInPandas(fn, schema=schema), rest[2]

    blocks = Blocks(rows, block_rows)
    if blocks.rows is None:
        return rows.select(F.col("nid").alias("id"), F.lit(False).alias("is_core"), F.lit(None).cast("long").alias("comp"))
    count, counts = _count_near(eps), "id long, n long"
    home = cut_lineage(blocks.rows.select("nid", "bv", "block").groupBy("block").applyInPandas(
        lambda part: count(part.rename(columns={"nid": "qid", "bv": "qv"}), part), counts).groupBy("id").agg(F.sum("n").alias("n")))
    open_ = home.where(F.col("n") + 1 < min_samples).select(F.col("id").alias("nid"))
    asked = asks(blocks.rows.select("nid", "bv", F.col("block").alias("home")).join(open_, "nid"))
    found, apart = meet(blocks, asked, count, counts)
    if not apart:           # the row's own block is among those of the lot
        home = home.where(F.col("n") + 1 >= min_samples)
    deg = home.unionByName(found).groupBy("id").agg((F.sum("n") + 1).alias("deg"))
    nodes = cut_lineage(rows.select(F.col("nid").alias("id")).join(deg, "id", "left").fillna(1, ["deg"])
                        .withColumn("is_core", F.col("deg") >= min_samples))
    core = nodes.filter("is_core").select("id")
    blocks = Blocks(rows.join(core.withColumnRenamed("id", "nid"), "nid", "left_semi"), block_rows)
    if blocks.rows is None:
        return nodes.select("id", "is_core", F.lit(None).cast("long").alias("comp"))
    link, pairs = _link_classes(eps), "u long, v long"

    def inside(part: pd.DataFrame) -> pd.DataFrame:
        return link(part.rename(columns={"nid": "qid", "bv": "qv"}).assign(qc=part["nid"]), part.assign(bc=part["nid"]))

    def named(edges: DataFrame) -> DataFrame:
        return star_components(edges.select(F.col("u").alias("a"), F.col("v").alias("b")), small=FEW)

    found = named(blocks.rows.select("nid", "bv", "block").groupBy("block").applyInPandas(inside, pairs))
    ids = core.distinct()
    comp = cut_lineage(ids.join(found, "id", "left").select("id", F.coalesce("comp", "id").alias("comp")))
    path = scratch_path(spark, "dbscan_core")
    blocks.rows.join(comp.select(F.col("id").alias("nid"), F.col("comp").alias("bc")), "nid") \
        .select("nid", "bv", "block", "bc").write.parquet(path)
    own = spark.read.parquet(path)
    # one row per block: bounded
    kinds = {r["block"]: (r["lo"], r["hi"]) for r in own.groupBy("block").agg(
        F.min("bc").alias("lo"), F.max("bc").alias("hi")).collect()}
    single = np.array([kinds[b][0] if kinds[b][0] == kinds[b][1] else -2**63 for b in blocks.names.tolist()])
    touch = named(meet(blocks, asks(own.withColumnRenamed("bc", "qc")), link, pairs, single=single, keep=("qc",), base=own)[0])
    to = cut_lineage(comp.join(touch.select(F.col("id").alias("comp"), F.col("comp").alias("to")), "comp", "left")
                     .select("id", F.coalesce("to", "comp").alias("comp")))
    final = own.drop("bc").join(to.select(F.col("id").alias("nid"), F.col("comp").alias("bc")), "nid")
    rest = rows.join(core.withColumnRenamed("id", "nid"), "nid", "left_anti")
    border = meet(blocks, asks(rest), _least_class(eps), "id long, comp long", base=final)[0] \
        .groupBy("id").agg(F.min("comp").alias("bcomp"))
    comp = core.join(to, "id")
    return nodes.join(comp, "id", "left").join(border, "id", "left").select(
        "id", "is_core", F.when(F.col("is_core"), F.col("comp"))
        .otherwise(F.col("bcomp")).alias("comp"))


def dbscan(df: DataFrame, id_col: str, eps: float, min_samples: int,
           xy: tuple[str, str] | None = None, vec: str | None = None,
           relabel: bool = True) -> DataFrame:
    """(id, label, is_core); label -1 is noise.  Border rows join the
    smallest adjacent cluster; labels are ranked by the smallest id.  A plane
    (``xy``) goes by the graph of cells, vectors by blocks (``pivots.py``)."""
    lab = cell_dbscan(df, id_col, *xy, eps, min_samples) if xy \
        else _vector_dbscan(df, id_col, eps, min_samples, vec)
    if relabel:
        lab = cut_lineage(lab)
        comps = lab.filter(F.col("comp").isNotNull()).select("comp").distinct()
        if comps.isEmpty():
            return lab.select(F.col("id").alias(id_col), F.lit(-1).cast("long").alias("label"), "is_core")
        ranked = sort_positions(comps, "comp", ["comp"], out="rk")
        lab = lab.join(ranked, "comp", "left").withColumn(
            "label", F.coalesce(F.col("rk") - 1, F.lit(-1)).cast("long")).drop("rk")
    else:
        lab = lab.withColumn("label", F.coalesce(F.col("comp"), F.lit(-1)))
    return lab.select(F.col("id").alias(id_col), "label", "is_core")


# ---------------------------------------------------------------- C9
def dbscan_predict(core: DataFrame, query: DataFrame, id_col: str, vec: str, eps: float,
                   k: int = 1) -> DataFrame:
    """Label of the nearest core row, -1 when it is farther than eps."""
    nn = knn_join(query, core, k, id_col, vec)
    lab = core.select(F.col(id_col).cast("long").alias("nid"), "label")
    j = nn.filter(F.col("rank") == 1).join(lab, "nid")
    return j.select(F.col("qid").alias(id_col), F.when(F.col("dist") <= eps, F.col("label"))
                    .otherwise(F.lit(-1)).alias("label"), "dist")


# ---------------------------------------------------------------- C10 / C11
def spectral(df: DataFrame, id_col: str, vec: str, k: int, n_neighbors: int = 10,
             gamma: float = 1.0, max_iter: int = 20, seed: int = 42) -> DataFrame:
    """C10 (re-aimed): sparse RBF affinity on the kNN graph, then power
    iteration clustering (no dense n x n affinity)."""
    nn = knn_join(df, df, n_neighbors, id_col, vec, exclude_self=True)
    edges = nn.select(F.col("qid").alias("src"), F.col("nid").alias("dst"),
                      F.exp(-F.lit(gamma) * F.col("dist") * F.col("dist")).alias("weight"))
    pic = PowerIterationClustering(k=k, maxIter=max_iter, weightCol="weight")
    return pic.assignClusters(edges).withColumnRenamed("id", id_col)


def hierarchical(df: DataFrame, vec: str, k: int, seed: int = 42):
    """C11 (re-aimed): top-down bisecting k-means."""
    d = df.withColumn("_v", array_to_vector(F.col(vec)))
    return BisectingKMeans(k=k, seed=seed, featuresCol="_v", predictionCol="cluster").fit(d)
