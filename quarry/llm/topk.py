"""Exact top-k by integer inner product, exhaustively, term at a time.

Queries and rows are dealt to blocks, and each pair of blocks is one group of
bounded size.  A group holds a posting list per component (rows in which it is
not zero, with their weights); the components of each query row scatter their
weighted postings into a dense score array, the best k are selected by
partition, and the bests of all row blocks are merged per query.

Defined results: vectors that are null or hold a null or non-finite component
take no part, nor do rows without an id; vectors of unequal length count as
zero-filled; a query has no candidate of its own id; equal query rows are
searched once; repeated candidate rows each take a rank; sums beyond a long
are compared exactly and returned as the nearest long; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

LOWEST, HIGHEST = -(2**63), 2**63 - 1


def dense(vectors: pa.ListArray, scale: float) -> np.ndarray:
    """floor(scale * x) of every component, shorter vectors filled with zeros:
    32 or 64 bits wide as far as they go, else Python integers."""
    offsets = np.asarray(vectors.offsets, np.int64)
    values = np.asarray(vectors.values.cast(pa.float64()))[offsets[0]:offsets[-1]]
    sizes = np.diff(offsets)
    out = np.zeros((len(sizes), int(sizes.max(initial=0))))
    if out.size:
        row = np.repeat(np.arange(len(sizes)), sizes)
        out[row, np.arange(len(values)) - np.repeat(offsets[:-1] - offsets[0], sizes)] = values
    with np.errstate(over="ignore"):
        scaled = np.floor(scale * out)
    if not np.isfinite(scaled).all():           # beyond doubles: whole numbers take over
        import math
        return np.array([[math.floor(int(scale) * int(x)) if abs(x) > 2**60 else math.floor(scale * x)
                          for x in r] for r in out.tolist()], dtype=object).reshape(out.shape)
    return scaled


def exact_type(a: np.ndarray, b: np.ndarray, rows: int):
    """Narrowest integers in which every partial sum, times ``rows``, is exact."""
    if a.dtype == object or b.dtype == object:
        return object
    most = lambda x: int(np.abs(x).max(initial=0))
    bound = most(a) * most(b) * max(a.shape[1], 1)
    return np.int32 if bound < 2**31 else np.int64 if bound * rows < 2**62 else object


def search_block(query_ids, queries: np.ndarray, ids: np.ndarray, rows: np.ndarray, k: int,
                 chunk: int = 1 << 22):
    """(query position, id, exact score) of the k best rows of a block per query."""
    order = np.argsort(ids, kind="stable")
    ids, rows = ids[order], rows[order]
    width = min(queries.shape[1], rows.shape[1])
    kind = exact_type(queries, rows, len(ids))
    whole = np.array([[int(x) for x in r] for r in queries], object).reshape(queries.shape) \
        if kind is object else queries.astype(kind)
    rows = np.array([[int(x) for x in r] for r in rows], object).reshape(rows.shape) \
        if kind is object else rows.astype(kind)
    postings = []
    for t in range(width):
        at = np.flatnonzero(rows[:, t])
        postings.append((slice(None) if len(at) == len(ids) else at, np.ascontiguousarray(rows[at, t])))
    n, step, out = len(ids), max(1, chunk // max(len(ids), 1)), []
    for lo in range(0, len(whole), step):
        part = whole[lo:lo + step]
        scores = np.zeros((len(part), n), kind)
        for t, (at, weights) in enumerate(postings):
            active = np.flatnonzero(part[:, t])
            if not len(active) or not len(weights):
                continue
            gain = part[active, t][:, None] * weights[None, :]
            if len(active) == len(part):
                scores[:, at] += gain
            elif isinstance(at, slice):
                scores[active] += gain
            else:
                scores[np.ix_(active, at)] += gain
        own_lo = np.searchsorted(ids, query_ids[lo:lo + step], "left")
        own_hi = np.searchsorted(ids, query_ids[lo:lo + step], "right")
        # ids ascend, so score * n + (n - 1 - place) orders by score, then smaller id
        key = scores.astype(object if kind is object else np.int64) * n + np.arange(n - 1, -1, -1)
        floor = int(key.min()) - 1 if kind is object and key.size else LOWEST
        for i in np.flatnonzero(own_hi > own_lo):
            key[i, own_lo[i]:own_hi[i]] = floor
        take = min(k, n)
        best = np.argpartition(key, n - take, axis=1)[:, n - take:] if kind is not object \
            else np.argsort(key, axis=1)[:, n - take:]
        rows_, cols = np.repeat(np.arange(len(part)), take), best.ravel()
        real = key[rows_, cols] > floor
        for q, c in zip(rows_[real], cols[real]):
            out.append((lo + int(q), int(ids[c]), int(scores[q, c])))
    return out


def beyond(score: int) -> bytes:
    """Empty for a score that fits a long; else bytes that sort like it."""
    if LOWEST <= score <= HIGHEST:
        return b""
    size = abs(score).bit_length() // 8 + 1
    digits = abs(score).to_bytes(size, "big")
    if score > 0:
        return size.to_bytes(4, "big") + digits
    return (2**32 - 1 - size).to_bytes(4, "big") + bytes(255 - d for d in digits)


def exact_top_k(vectors: DataFrame, k: int = 5, scale: float = 256.0, every: int = 50,
                id_col: str = "vec_id", vec_col: str = "embedding",
                query_block: int = 65_536, row_block: int = 8192) -> DataFrame:
    """query_id, rank, vec_id, score: the k best rows of every row whose id is
    divisible by ``every``."""
    spark = vectors.sparkSession
    vec = F.col(vec_col).cast("array<double>")
    good = F.col(id_col).isNotNull() & F.col(vec_col).isNotNull() & F.forall(
        vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), vec.alias("v"), good.alias("good")) \
        .where("coalesce(good, false)").drop("good")
    is_query = F.col("id") % every == 0
    total, asked = rows.agg(F.count("*"), F.count(F.when(is_query, 1))).first()
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    row_blocks = max(-(-total // row_block), min(total // 512, tasks), 1)
    query_blocks = max(-(-asked // query_block), 1)
    place = F.xxhash64("id", F.col("v").cast("string"))
    group = F.col("qb") * F.lit(row_blocks) + F.col("rb")

    def all_blocks(n):
        return F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))

    base = rows.withColumn("rb", F.pmod(place, F.lit(row_blocks))) \
        .withColumn("qb", all_blocks(query_blocks)).withColumn("g", group).select("g", "id", "v")
    queries = rows.where(is_query).withColumn("variant", place).dropDuplicates(["id", "variant"]) \
        .withColumn("qb", F.pmod("variant", F.lit(query_blocks))) \
        .withColumn("rb", all_blocks(row_blocks)).withColumn("g", group).select("g", "id", "variant", "v")

    def search(asked: pa.Table, block: pa.Table) -> pa.Table:
        if not asked.num_rows or not block.num_rows:
            return pa.table({n: pa.array([], pa.binary() if n == "beyond" else pa.int64())
                             for n in ("query_id", "variant", "vec_id", "score", "beyond")})
        whole = lambda t: dense(t.column("v").combine_chunks(), scale)
        qid, variant = (np.asarray(asked.column(c)) for c in ("id", "variant"))
        found = search_block(qid, whole(asked), np.asarray(block.column("id")), whole(block), k)
        at = np.array([f[0] for f in found], np.int64)
        return pa.table({"query_id": pa.array(qid[at]), "variant": pa.array(variant[at]),
                         "vec_id": pa.array([f[1] for f in found], pa.int64()),
                         "score": pa.array([min(max(f[2], LOWEST), HIGHEST) for f in found], pa.int64()),
                         "beyond": pa.array([beyond(f[2]) for f in found], pa.binary())})

    partial = queries.groupBy("g").cogroup(base.groupBy("g")).applyInArrow(
        search, "query_id long, variant long, vec_id long, score long, beyond binary")
    best = Window.partitionBy("query_id", "variant").orderBy(
        F.col("score").desc(), F.col("beyond").desc(), "vec_id")
    return partial.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k) \
        .select("query_id", "rank", "vec_id", "score")


SQL = """
WITH e AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::DOUBLE) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
         list_dot_product(q.v, c.v)::BIGINT AS score
  FROM e q JOIN e c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM p)
WHERE rank <= 5"""
