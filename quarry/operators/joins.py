"""Joins implied by the reference (J1-J9) and similarity joins.

No side is forced to be broadcast: Spark decides by its own byte estimates.
Exact kNN and high-dimensional radius joins co-group each block of base rows
with the queries that can have a neighbour there (``pivots.py``): a task holds
about ``block_rows`` rows per side; only top-k candidates are shuffled on.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.functions.arrays import lit_matrix, sq_dist
from quarry.operators.pivots import LOT_BYTES, LOT_ROWS, LOTS, Blocks, Products, exact, matrix, narrow, nearest_rows, pairs_near, send
from quarry.session import scratch_path

# ---------------------------------------------------------------- J1
def zip_columns(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Same rows, more columns (equi-join on the row id)."""
    return left.join(right, list(on), "inner")


# ---------------------------------------------------------------- J2
def lookup(df: DataFrame, table: DataFrame, on: Sequence[str], how: str = "left") -> DataFrame:
    """Lookup by key (centroid / label per cluster id)."""
    return df.join(table, list(on), how)


# ---------------------------------------------------------------- J3
def vocabulary_lookup(counts: DataFrame, vocab: DataFrame, word: str = "word",
                      idx: str = "idx") -> DataFrame:
    """Word -> index; unknown words -> 0."""
    return (counts.join(vocab.select(word, idx), word, "left")
                  .withColumn(idx, F.coalesce(F.col(idx), F.lit(0))))


# ---------------------------------------------------------------- J4
def centroid_distances(vec: str, centroids: Sequence[Sequence[float]]) -> Column:
    """Array of Euclidean distances from ``vec`` to each literal centroid."""
    cs = lit_matrix(centroids)
    return F.transform(cs, lambda c: F.sqrt(sq_dist(F.col(vec), c)))


def nearest_centroid(df: DataFrame, vec: str, centroids: Sequence[Sequence[float]],
                     out: str = "cluster", dist: str = "dist") -> DataFrame:
    """Argmin over k literal centroids (k x d values ride in the plan, no
    join); ties go to the smaller cluster index."""
    ds = centroid_distances(vec, centroids)
    best = F.array_min(F.transform(ds, lambda d, i: F.struct(d.alias("d"), i.alias("i"))))
    return df.withColumn("_best", best).withColumn(out, F.col("_best.i").cast("int")) \
             .withColumn(dist, F.col("_best.d")).drop("_best")


# ---------------------------------------------------------------- J5
def _shares(n: int, rows: int) -> int:
    return max(1, math.ceil(n / rows))


def _nothing(**kinds) -> pd.DataFrame:
    return pd.DataFrame({n: np.zeros(0, k) for n, k in kinds.items()})


def _nearest(k: int, exclude_self: bool):
    """The k nearest base rows of each query inside a block, ties by id; none
    beyond ``tau`` where queries have it."""
    def block_topk(qp: pd.DataFrame, bp: pd.DataFrame) -> pd.DataFrame:
        if len(qp) == 0 or len(bp) == 0:
            return _nothing(qid=np.int64, nid=np.int64, dist=float, block=np.int32)
        qi, bi = qp["qid"].to_numpy(), bp["nid"].to_numpy()
        r, c, far = nearest_rows(matrix(qp["qv"]), qi, matrix(bp["bv"]), bi, k,
                                 qp["tau"].to_numpy(float) if "tau" in qp else None, exclude_self)
        return pd.DataFrame({"qid": qi[r], "nid": bi[c], "dist": far, "block": np.full(len(r), bp["block"].iloc[0], np.int32)})
    return block_topk


def _pairs_within(q: np.ndarray, qi: np.ndarray, near: Products, b: np.ndarray, bi: np.ndarray, eps: float, include_self: bool):
    """(id_a, id_b, dist) of the pairs within eps, some at a time."""
    for r, c in pairs_near(q, near, eps * eps * (1 + 1e-9) + 1e-12):
        d = exact(q, b, r, c)
        keep = d <= eps
        if not include_self:
            keep &= qi[r] != bi[c]
        yield qi[r[keep]].astype(np.int64), bi[c[keep]].astype(np.int64), d[keep]


def _within(eps: float, include_self: bool):
    """All base rows within eps of each query inside a block."""
    def block_pairs(qp: pd.DataFrame, bp: pd.DataFrame) -> pd.DataFrame:
        if len(qp) == 0 or len(bp) == 0:
            return _nothing(id_a=np.int64, id_b=np.int64, dist=float)
        Q, B = matrix(qp["qv"]), matrix(bp["bv"])
        found = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
        found += _pairs_within(Q, qp["qid"].to_numpy(), Products(B), B, bp["nid"].to_numpy(), eps, include_self)
        id_a, id_b, dist = (np.concatenate(x) for x in zip(*found))
        return pd.DataFrame({"id_a": id_a, "id_b": id_b, "dist": dist})
    return block_pairs


def _vectors(column: pa.Array) -> np.ndarray:
    size = column.value_lengths()
    if size.null_count or len(size.unique()) > 1:
        raise ValueError("vectors must not be null and must have one length")
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def _stream_within(eps: float, include_self: bool):
    """Of rows sorted by (block, share, side) the pairs within eps of every (block,
    share): its base rows (side 0) are held, the queries pass by."""
    def stream(batches):
        at, held, near = None, [], None
        for batch in batches:
            keys = np.stack([batch.column(c).to_numpy() for c in ("block", "share", "side")], axis=1)
            ends = np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1
            for first, end in zip(np.r_[0, ends], np.r_[ends, len(keys)]):
                if first == end:
                    continue
                tile, side = tuple(keys[first, :2]), keys[first, 2]
                if tile != at:
                    at, held, near = tile, [], None
                part = batch.slice(first, end - first)
                ids, v = part.column("id").to_numpy(), _vectors(part.column("v"))
                if side == 0:
                    held.append((ids, v))
                    continue
                if not held:
                    continue
                if near is None:
                    bi, b = (np.concatenate(x) for x in zip(*held))
                    held, near = [(bi, b)], Products(b)
                for id_a, id_b, dist in _pairs_within(v, ids, near, b, bi, eps, include_self):
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in (id_a, id_b, dist)], ["id_a", "id_b", "dist"])
    return stream


def _one_block(q: DataFrame, b: DataFrame, n_queries: int, query_rows: int):
    """All queries against a base of one block."""
    shares = _shares(n_queries, query_rows)
    return (q.withColumn("block", F.lit(0)).withColumn("share", F.pmod(F.xxhash64("qid"), F.lit(shares)).cast("int")),
            b.withColumn("block", F.lit(0)).withColumn("share", F.explode(F.sequence(F.lit(0), F.lit(shares - 1)))))


def _cogroup(asked: DataFrame, held: DataFrame, fn, schema: str) -> DataFrame:
    return asked.groupBy("block", "share").cogroup(held.groupBy("block", "share")).applyInPandas(fn, schema=schema)


def knn_join(query: DataFrame, base: DataFrame, k: int, q_id: str, q_vec: str,
             b_id: str | None = None, b_vec: str | None = None,
             block_rows: int = 2048, exclude_self: bool = False, sent: dict | None = None) -> DataFrame:
    """Exact k nearest neighbours (Euclidean) of every query row.

    Returns (qid, nid, dist, rank) with ties broken by neighbour id.  A base of
    more than one block goes by pivots (``pivots.py``): each query is searched
    in its home block first and then only in the blocks that its k-th distance
    there can reach.  ``sent`` takes the numbers of query and base rows shuffled.
    """
    b_id, b_vec = b_id or q_id, b_vec or q_vec
    q = query.select(F.col(q_id).cast("long").alias("qid"), F.col(q_vec).alias("qv"))
    b = base.select(F.col(b_id).cast("long").alias("nid"), F.col(b_vec).alias("bv"))
    nq, nb = query.count(), base.count()
    schema, best = "qid long, nid long, dist double, block int", _nearest(k, exclude_self)
    if nb <= block_rows:
        found = _cogroup(*_one_block(q, b, nq, block_rows), best, schema)
    else:
        q, b = narrow(q, "qv"), narrow(b, "bv")
        blocks = Blocks(b, block_rows)
        asked, held, n1, m1, *_ = send(blocks.homes(q), blocks, block_rows)
        path = scratch_path(q.sparkSession, "knn_home")
        _cogroup(asked, held, best, schema).write.parquet(path)
        home = q.sparkSession.read.parquet(path)
        bound = home.groupBy("qid").agg(F.count("*").alias("n"), F.max("dist").alias("dist"), F.min("block").alias("home")) \
            .select("qid", "home", F.when(F.col("n") >= k, F.col("dist")).otherwise(F.lit(float("inf"))).alias("tau"))
        rest = q.join(bound, "qid", "left").fillna({"home": -1, "tau": float("inf")})
        asked, held, n2, m2, apart, _ = send(rest, blocks, block_rows, keep=("tau",))
        found = _cogroup(asked, held, best, schema)
        found = home.unionByName(found) if apart else found
        if sent is not None:
            sent.update(queries=n1 + n2, base=m1 + m2, blocks=len(blocks.names))
    w = Window.partitionBy("qid").orderBy("dist", "nid")
    # each query has at most k candidates per block it was sent to
    return found.drop("block").withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


# ---------------------------------------------------------------- J6
def radius_join_grid(df: DataFrame, id_col: str, x: str, y: str, eps: float,
                     other: DataFrame | None = None, include_self: bool = False) -> DataFrame:
    """J6 (low-d): all pairs within eps via a grid-cell equi-join.

    The probe side is replicated into its 3x3 neighbour cells; the join key is
    the cell, so no pair farther than one cell apart is ever generated.
    Returns (id_a, id_b, dist).
    """
    other = df if other is None else other
    a = df.select(F.col(id_col).alias("id_a"), F.col(x).alias("xa"), F.col(y).alias("ya")) \
        .withColumn("cx", F.floor(F.col("xa") / eps)).withColumn("cy", F.floor(F.col("ya") / eps))
    offs = F.array(*[F.struct(F.lit(i).alias("ox"), F.lit(j).alias("oy"))
                     for i in (-1, 0, 1) for j in (-1, 0, 1)])
    b = other.select(F.col(id_col).alias("id_b"), F.col(x).alias("xb"), F.col(y).alias("yb")) \
        .withColumn("o", F.explode(offs)) \
        .withColumn("cx", F.floor(F.col("xb") / eps) + F.col("o.ox")) \
        .withColumn("cy", F.floor(F.col("yb") / eps) + F.col("o.oy")).drop("o")
    j = a.join(b, ["cx", "cy"])
    dist = F.sqrt((F.col("xa") - F.col("xb")) ** 2 + (F.col("ya") - F.col("yb")) ** 2)
    j = j.withColumn("dist", dist).filter(F.col("dist") <= eps)
    if not include_self:
        j = j.filter(F.col("id_a") != F.col("id_b"))
    return j.select("id_a", "id_b", "dist")


def radius_join_blocked(df: DataFrame, id_col: str, vec: str, eps: float,
                        block_rows: int = 2048, include_self: bool = False, sent: dict | None = None) -> DataFrame:
    """J6 (high-d): exact pairs within eps; a row meets only the blocks that its
    pivot distances allow (vectorised distances per block, only pairs within eps
    leave the task)."""
    q = df.select(F.col(id_col).cast("long").alias("qid"), F.col(vec).alias("qv"))
    b = df.select(F.col(id_col).cast("long").alias("nid"), F.col(vec).alias("bv"))
    n, schema = df.count(), "id_a long, id_b long, dist double"
    if n <= block_rows:
        asked, held = _one_block(q, b, n, block_rows)
        return _cogroup(asked, held, _within(eps, include_self), schema)
    q, b = narrow(q, "qv"), narrow(b, "bv")
    blocks = Blocks(b, block_rows)
    asked, held, n1, m1, _, tiles = send(q.withColumn("tau", F.lit(float(eps))), blocks, block_rows)
    if sent is not None:
        sent.update(queries=n1, base=m1, blocks=len(blocks.names))
    key = ["block", "share", "side"]
    both = held.select(*key[:2], F.lit(0).alias("side"), F.col("nid").alias("id"), F.col("bv").alias("v")).unionByName(
        asked.select(*key[:2], F.lit(1).alias("side"), F.col("qid").alias("id"), F.col("qv").alias("v")))
    return both.repartition(max(1, min(tiles, 4096)), "block", "share").sortWithinPartitions(*key) \
        .mapInArrow(_stream_within(eps, include_self), schema)


# ---------------------------------------------------------------- J7 / J8
def complement(df: DataFrame, subset: DataFrame, on: Sequence[str]) -> DataFrame:
    """All rows not in ``subset`` (left anti join)."""
    return df.join(subset.select(*on), list(on), "left_anti")


def restrict(df: DataFrame, members: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows whose key is in ``members`` (left semi join)."""
    return df.join(members.select(*on), list(on), "left_semi")


# ---------------------------------------------------------------- J5 / J6 approximate
def _lsh(bucket_length: float, n_tables: int, seed: int):
    from pyspark.ml.feature import BucketedRandomProjectionLSH
    return BucketedRandomProjectionLSH(inputCol="_v", outputCol="_hashes",
                                       bucketLength=bucket_length, numHashTables=n_tables,
                                       seed=seed)


def _hashed(model, df: DataFrame, id_col: str, vec: str, name: str, n_tables: int) -> DataFrame:
    """(id, vector, h): the row's bucket in every hash table; equal rows once, as
    MLlib's join gives equal pairs once."""
    from pyspark.ml.functions import array_to_vector, vector_to_array
    d = model.transform(df.select(F.col(id_col).cast("long").alias(f"{name}id"), F.col(vec).cast("array<double>").alias(f"{name}v"))
                        .distinct().withColumn("_v", array_to_vector(F.col(f"{name}v"))))
    return d.select(f"{name}id", f"{name}v", F.array(*(vector_to_array(F.col("_hashes")[t])[0] for t in range(n_tables))).alias("h"))


#: Pairs that a tile of a radius join may be expected to give.
TILE_PAIRS = 6_000_000


def _tile_rows(rows: DataFrame, n: int, radius: float, k: int | None) -> int:
    """Rows per side of a tile: what a worker holds, and without ``k`` no more than
    give about TILE_PAIRS by the share of pairs within the radius among 1,024 rows.
    It steers memory only."""
    some = matrix(rows.orderBy(F.xxhash64("qid"), "qid").select("qv").limit(1024).toPandas()["qv"])
    most = min(LOT_ROWS, LOT_BYTES // (8 * max(some.shape[1], 1)), max(4096, math.ceil(n / LOTS)))
    if k is None and len(some):
        share = sum(len(r) for r, _ in pairs_near(some, Products(some), radius * radius)) / len(some) ** 2
        most = min(most, int(math.sqrt(TILE_PAIRS / 2 / share)) if share else most)
    return max(most, 4096)


def _dealt(q: DataFrame, b: DataFrame | None, n_tables: int, rows: int | None, radius: float, k: int | None) -> tuple[DataFrame, DataFrame]:
    """Both sides once per hash table, at tiles of about ``rows`` rows each: a large
    bucket has several tiles per side, small ones share a tile.  Where the buckets
    of all tables hold more pairs than the rows have, rows are dealt once, as one
    bucket of a table of their own (number ``n_tables``).  Without ``b`` the base
    is ``q`` itself, and two tiles meet once."""
    path, same = scratch_path(q.sparkSession, "lsh"), b is None
    tables = F.array(*(F.struct(F.lit(t).alias("t"), F.col("h")[t].alias("bucket")) for t in range(n_tables)))
    read = []
    for name, d in (("q", q), ("b", b)):
        if d is not None:
            narrow(d, f"{name}v").write.parquet(f"{path}/{name}")
            read.append(q.sparkSession.read.parquet(f"{path}/{name}"))
        else:
            read.append(q.sparkSession.read.parquet(f"{path}/q").withColumnsRenamed({"qid": "bid", "qv": "bv"}))
    nq, nb = (d.count() for d in read)
    rows = rows or _tile_rows(read[0], max(nq, nb), radius, k)
    put = lambda d: d.withColumn("_t", F.explode(tables)).select("*", "_t.*").drop("_t")
    sides = [put(d) for d in read]
    n = lambda d, c: d.groupBy("t", "bucket").agg(F.count("*").alias(c))
    size = n(sides[0], "nq").join(n(sides[1], "nb"), ["t", "bucket"])
    held = size.agg(F.sum("nq"), F.sum("nb"), F.sum(F.col("nq").cast("double") * F.col("nb"))).first()
    if (held[2] or 0) >= nq * nb > 0 and max(nq, nb) > rows // 4:
        sides = [d.select("*", F.lit(n_tables).alias("t"), F.lit(0.0).alias("bucket")) for d in read]
        size = q.sparkSession.createDataFrame([(n_tables, 0.0, nq, nb)], "t int, bucket double, nq long, nb long")
    bins = math.ceil(max(held[i] or 0 for i in (0, 1)) / (n_tables * rows)) or 1
    large = (F.col("nq") > rows // 4) | (F.col("nb") > rows // 4)
    shares = lambda c: F.when(large, F.ceil(F.col(c) / rows)).otherwise(1).cast("int")
    path = f"{path}/buckets"
    size.select("t", "bucket", large.alias("large"), shares("nq").alias("qs"), shares("nb").alias("bs"),
                F.when(large, F.col("bucket").cast("long")).otherwise(F.pmod(F.xxhash64("bucket"), F.lit(bins))).alias("slot")) \
        .write.parquet(path)
    size = [q.sparkSession.read.parquet(path) for _ in range(2)]
    own = lambda c, s: F.pmod(F.xxhash64(c), F.col(s)).cast("int")
    each = lambda first, last: F.explode(F.sequence(first, last))
    key = ["t", "large", "slot", "i", "j"]
    asked = sides[0].join(size[0], ["t", "bucket"]).withColumn("i", own("qid", "qs")) \
        .withColumn("j", each(F.col("i") if same else F.lit(0), F.col("bs") - 1))
    held = sides[1].join(size[1], ["t", "bucket"]).withColumn("j", own("bid", "bs")) \
        .withColumn("i", each(F.lit(0), F.col("j") if same else F.col("qs") - 1))
    return asked.select(*key, "bucket", "h", "qid", "qv"), held.select(*key, "bucket", "h", "bid", "bv")


def _met(radius: float, k: int | None, exclude_self: bool, n_tables: int, same: bool):
    """Pairs of a tile nearer than ``radius`` whose first common bucket it is (in the
    table of all rows: that have a common one); with ``k`` the nearest of each
    query, ties by id.  With ``same`` a tile stands for its mirror too."""
    def pairs(qp: pd.DataFrame, bp: pd.DataFrame) -> pd.DataFrame:
        found = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
        if len(qp) and len(bp):
            t, twice = int(qp["t"].iloc[0]), same and qp["i"].iloc[0] != qp["j"].iloc[0]
            inner = dict(list(bp.groupby("bucket")))
            for bucket, part in qp.groupby("bucket"):
                if bucket in inner:
                    one, two = ((matrix(p[v]), matrix(p["h"]), p[i].to_numpy()) for p, v, i in (
                        (part, "qv", "qid"), (inner[bucket], "bv", "bid")))
                    found += bucket_pairs(one, two, t, twice)
        qid, nid, dist = (np.concatenate(x) for x in zip(*found))
        return pd.DataFrame({"qid": qid, "nid": nid, "dist": dist})

    def bucket_pairs(one, two, t: int, twice: bool) -> list:
        if k is not None:
            return [nearest(*x, t) for x in ((one, two), (two, one))[:1 + twice]]
        (Q, hq, qi), (B, hb, bi) = one, two
        out = []
        for r, c in pairs_near(Q, Products(B), radius * radius * (1 + 1e-9)):
            good = common(hq, hb, t, r, c)
            if exclude_self:
                good &= qi[r] != bi[c]
            r, c = r[good], c[good]
            far = in_order(Q, B, r, c)
            r, c, far = r[far < radius], c[far < radius], far[far < radius]
            out += [(qi[r], bi[c], far), (bi[c], qi[r], far)][:1 + twice]
        return out

    def nearest(one, two, t: int):
        (Q, hq, qi), (B, hb, bi) = one, two
        r, c, far = nearest_rows(Q, qi, B, bi, k, np.full(len(Q), radius), exclude_self,
                                 lambda r, c: common(hq, hb, t, r, c), in_order, radius)
        return qi[r], bi[c], far

    def common(hq, hb, t: int, r, c) -> np.ndarray:
        """Whether table t is the first one with a common bucket; for all rows, whether there is one."""
        some = np.zeros(len(r), bool)
        for s in range(t):
            some |= hq[r, s] == hb[c, s]
        return some if t == n_tables else ~some

    def in_order(q, b, r, c):
        """Distances summed from the first component on, as MLlib's are."""
        out, some = np.empty(len(r)), max(1, 2_000_000 // max(q.shape[1], 1))
        for at in range(0, len(r), some):
            diff = q[r[at:at + some]] - b[c[at:at + some]]
            out[at:at + some] = np.sqrt(np.cumsum(diff * diff, axis=1)[:, -1])
        return out
    return pairs


def _lsh_pairs(query: DataFrame, base: DataFrame, id_col: str, vec: str, radius: float, bucket_length: float,
               n_tables: int, seed: int, k: int | None, exclude_self: bool, tile_rows: int | None = None) -> DataFrame:
    """(qid, nid, dist) of the rows that share a bucket of MLlib's random projections
    in some table and are nearer than ``radius``.  The rows of a bucket meet in
    tiles, and a pair is given once, so candidates are
    never written; with ``k`` a tile gives the k nearest of each query."""
    from pyspark.ml.functions import array_to_vector
    model = _lsh(bucket_length, n_tables, seed).fit(base.select(array_to_vector(F.col(vec)).alias("_v")))
    same = query is base
    asked, held = _dealt(_hashed(model, query, id_col, vec, "q", n_tables),
                         None if same else _hashed(model, base, id_col, vec, "b", n_tables), n_tables, tile_rows, radius, k)
    key = ["t", "large", "slot", "i", "j"]
    return asked.groupBy(*key).cogroup(held.groupBy(*key)).applyInPandas(
        _met(radius, k, exclude_self, n_tables, same), schema="qid long, nid long, dist double")


def radius_join_lsh(df: DataFrame, id_col: str, vec: str, eps: float,
                    bucket_length: float | None = None, n_tables: int = 4,
                    seed: int = 42) -> DataFrame:
    """J6 (approximate, high-d): random-projection LSH similarity join (MLlib's
    hashes); candidate pairs share a hash bucket.
    Pairs can be missed (recall < 1), never invented (distances are exact)."""
    j = _lsh_pairs(df, df, id_col, vec, eps, bucket_length or 2.0 * eps, n_tables, seed, None, True)
    return j.select(F.col("qid").alias("id_a"), F.col("nid").alias("id_b"), "dist")


def knn_join_lsh(query: DataFrame, base: DataFrame, k: int, id_col: str, vec: str,
                 radius: float, bucket_length: float | None = None, n_tables: int = 4,
                 exclude_self: bool = False, seed: int = 42) -> DataFrame:
    """J5 (approximate): LSH candidates within ``radius``, then the k nearest
    per query.  Rows with fewer than k candidates get fewer neighbours."""
    j = _lsh_pairs(query, base, id_col, vec, radius, bucket_length or radius, n_tables, seed, k, exclude_self)
    w = Window.partitionBy("qid").orderBy("dist", "nid")
    return j.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
