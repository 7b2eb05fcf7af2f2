"""Spectral clustering by eigenvectors of the graph Laplacian.

The affinity is a sparse table of edges (k nearest neighbours, made symmetric),
normalised by the square roots of both degrees.  Its largest eigenvectors are
the smallest of the normalised Laplacian.  They are found by restarted block
Krylov iteration: a block of vectors is multiplied by Chebyshev polynomials of
the matrix (bounded on its spectrum, so a round can go deep and needs far fewer
products than short ones), one pass takes the inner products of all these
blocks, and the small Ritz problem is solved on the driver, which never sees a
row.

Nodes are dealt to blocks by a hash, and the columns of a block are packed once
and stay in their partition.  A product brings a block's vectors to its columns
and sends on one row of sums per node met there, packed: what moves is at most
the vectors times the lesser of the blocks and a node's edges; no edge moves
again.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.functions.hashing import md5_uniform
from quarry.operators.joins import knn_join
from quarry.session import cut_lineage

#: Nodes of a block, and the blocks of a smaller graph.
BLOCK_ROWS, LEAST_BLOCKS = 1 << 18, 4
#: Nodes whose vectors of a whole round meet at once.
CHUNK_ROWS = 1 << 13
PACKED = "block int, at int, x binary"


def knn_affinity(df: DataFrame, id_col: str, vec: str, n_neighbors: int = 10, gamma: float | None = None) -> DataFrame:
    """(i, j, w): exp(-gamma d^2), or 1 without a gamma, between a row and its
    nearest neighbours, half from each side."""
    near = knn_join(df, df, n_neighbors, id_col, vec, exclude_self=True)
    w = F.lit(1.0) if gamma is None else F.exp(-F.lit(float(gamma)) * F.col("dist") * F.col("dist"))
    w = w / 2
    # both directions of a row at once: a union would search the neighbours twice
    both = F.explode(F.array(F.struct(F.col("qid").alias("i"), F.col("nid").alias("j"), w.alias("w")),
                             F.struct(F.col("nid").alias("i"), F.col("qid").alias("j"), w.alias("w"))))
    return near.select(both.alias("e")).select("e.*").groupBy("i", "j").agg(F.sum("w").alias("w"))


@dataclass
class Embedding:
    eigenvalues: np.ndarray         # of the normalised Laplacian, ascending
    rows: DataFrame                 # id, x: the eigenvectors' entries, over the root of the degree
    rounds: int


def _numbers(value, width: int) -> np.ndarray:
    """The vectors of a block, one per line."""
    return np.frombuffer(value.as_py(), float).reshape(width, -1)


def _packed_columns(group: pa.Table) -> pa.Table:
    """The edges from one block (columns) to another (rows), in the order of the rows."""
    i, j, w = (group.column(c).to_numpy() for c in ("place_i", "place_j", "w"))
    order = np.lexsort((j, i))
    rows, first = np.unique(i[order], return_index=True)
    out = {"rows": rows.astype(np.int32), "first": first.astype(np.int64), "cols": j[order].astype(np.int32), "w": w[order]}
    return pa.table({"block": group.column("block_j")[:1], "to": group.column("block_i")[:1],
                     **{c: pa.array([v.tobytes()], pa.binary()) for c, v in out.items()}})


def laplacian_embedding(edges: DataFrame, k: int, extra: int = 4, powers: int = 18, tol: float = 1e-8,
                        max_rounds: int = 60, seed: int = 42) -> Embedding:
    """The k smallest eigenvalues of I - D^-1/2 W D^-1/2 and their vectors, for
    symmetric edges (i, j, w); every node has an edge."""
    edges = cut_lineage(edges)
    degree = edges.groupBy("i").agg(F.sum("w").alias("degree"))
    degree = cut_lineage(degree.select(F.col("i").alias("id"), F.sqrt("degree").alias("root")))
    n = degree.count()
    b = min(k + extra, n)
    blocks = max(LEAST_BLOCKS, math.ceil(n / BLOCK_ROWS))
    nodes = cut_lineage(degree.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int")).withColumn(
        "place", F.row_number().over(Window.partitionBy("block").orderBy("id")) - 1))
    side = lambda c: nodes.select(F.col("id").alias(c), *(F.col(x).alias(f"{x}_{c}") for x in ("root", "block", "place")))
    table = edges.join(side("i"), "i").join(side("j"), "j").select(
        "block_i", "place_i", "block_j", "place_j", (F.col("w") / (F.col("root_i") * F.col("root_j"))).alias("w"))
    columns = table.groupBy("block_j", "block_i").applyInArrow(
        _packed_columns, "block int, to int, rows binary, first binary, cols binary, w binary")
    columns = columns.repartition(blocks, "block").cache()       # a checkpoint would forget where the blocks lie

    def start(group: pa.Table) -> pa.Table:
        group = group.sort_by("place")
        x = np.asarray(group.column("x").combine_chunks().flatten()).reshape(-1, b)
        return pa.table({"block": group.column("block")[:1], "x": pa.array([x.T.tobytes()], pa.binary())})

    def send(x: pa.Table, own: pa.Table) -> pa.Table:
        x, sums = _numbers(x.column("x")[0], b), []
        for r in range(own.num_rows):
            first, cols, w = (np.frombuffer(own.column(c)[r].as_py(), t) for c, t in
                              (("first", np.int64), ("cols", np.int32), ("w", float)))
            sums.append(np.stack([np.add.reduceat(w * v[cols], first) for v in x]).tobytes())
        return own.select(["block", "to", "rows"]).append_column("x", pa.array(sums, pa.binary()))

    def add(group: pa.Table) -> pa.Table:
        group, before = group.sort_by("block"), None
        # every node has an edge: the last one of the block is among the rows
        out = np.zeros((b, 1 + max(int(np.frombuffer(r.as_py(), np.int32)[-1]) for r in group.column("rows") if r.is_valid)))
        for to, r, x in zip(*(group.column(c) for c in ("block", "rows", "x"))):
            if to.as_py() < 0:
                before = _numbers(x, b)
                continue
            out[:, np.frombuffer(r.as_py(), np.int32)] += _numbers(x, b)
        out = out if before is None else 2 * out - before
        return pa.table({"block": group.column("to")[:1], "x": pa.array([out.tobytes()], pa.binary())})

    def times(x: DataFrame, before: DataFrame | None) -> DataFrame:
        """M x, or 2 M x less the vectors before."""
        sums = x.groupBy("block").cogroup(columns.groupBy("block")).applyInArrow(
            send, "block int, to int, rows binary, x binary")
        if before is not None:
            sums = sums.unionByName(before.select(F.lit(-1).alias("block"), F.col("block").alias("to"),
                                                  F.lit(None).cast("binary").alias("rows"), "x"))
        return cut_lineage(sums.groupBy("to").applyInArrow(add, "block int, x binary"))

    def chunks(batches):
        """The vectors of some nodes at a time."""
        for batch in batches:
            for block, p, x in zip(*(batch.column(c) for c in ("block", "p", "x"))):
                x = _numbers(x, b)
                for at in range(0, x.shape[1], CHUNK_ROWS):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([block.as_py()], pa.int32()), pa.array([at], pa.int32()), pa.array([p.as_py()], pa.int32()),
                         pa.array([x[:, at:at + CHUNK_ROWS].tobytes()], pa.binary())], names=["block", "at", "p", "x"])

    def stack(group: pa.Table) -> pa.Table:
        group = group.sort_by("p")
        return group.select(["block", "at"]).slice(0, 1).append_column(
            "x", pa.array([b"".join(x.as_py() for x in group.column("x"))], pa.binary()))

    def whole_block(group: pa.Table) -> pa.Table:
        group = group.sort_by("at")
        x = np.hstack([_numbers(x, b) for x in group.column("x")])
        return pa.table({"block": group.column("block")[:1], "x": pa.array([x.tobytes()], pa.binary())})

    rows = nodes.select("block", "place", F.array(*(
        md5_uniform(F.lit(seed), F.lit(t), F.col("id")) - 0.5 for t in range(b))).alias("x"))
    rows = cut_lineage(rows.groupBy("block").applyInArrow(start, "block int, x binary"))
    q = max(1, min(powers, n // b))
    m = b * q
    # M times the first q blocks, in terms of all: T1, and (T(p+1) + T(p-1)) / 2
    next_ = np.zeros((m + b, m))
    for p in range(q):
        for to in (p - 1, p + 1) if p else (1,):
            next_[to * b:(to + 1) * b, p * b:(p + 1) * b] = np.eye(b) / (2 if p else 1)

    def products(batches):
        total = np.zeros((m + b, m + b))
        for batch in batches:
            for x in batch.column("x"):
                x = _numbers(x, m + b)
                total += x @ x.T
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(total.size, dtype=np.int32)), pa.array(total.ravel())], names=["i", "v"])

    for r in range(1, max_rounds + 1):
        power = [rows]
        for p in range(q):
            power.append(times(power[-1], power[-2] if p else None))
        every = reduce(DataFrame.unionByName, (x.withColumn("p", F.lit(p)) for p, x in enumerate(power)))
        krylov = cut_lineage(every.mapInArrow(chunks, "block int, at int, p int, x binary").groupBy("block", "at").applyInArrow(stack, PACKED))
        found = krylov.mapInArrow(products, "i int, v double").groupBy("i").agg(F.sum("v").alias("v")).toPandas()
        g = np.zeros((m + b) ** 2)
        g[found["i"].to_numpy()] = found["v"].to_numpy(dtype=float)
        if np.isnan(g).any():
            raise ValueError("NULL or NaN in the weights of the edges")
        g = g.reshape(m + b, m + b)
        gram, moved = g[:m, :m], g[:m] @ next_
        moved = (moved + moved.T) / 2
        scale = 1 / np.sqrt(np.maximum(np.diag(gram), 1e-300))
        lam, u = np.linalg.eigh(gram * scale[:, None] * scale)
        ok = lam > 1e-13 * lam[-1]
        white = (scale[:, None] * u[:, ok]) / np.sqrt(lam[ok])
        theta, v = np.linalg.eigh(white.T @ moved @ white)
        take = np.argsort(-theta)[:b]
        theta, c = theta[take], white @ v[:, take]
        # residuals of the wanted vectors: |M x|^2 - theta^2
        size = np.einsum("ij,ij->j", next_ @ c, g @ (next_ @ c))
        off = np.sqrt(np.maximum(size - theta ** 2, 0))[:k]
        whole = np.zeros((b, m))
        whole[:c.shape[1]] = c.T

        def combine(batches, whole=whole):
            for batch in batches:
                yield pa.RecordBatch.from_arrays([batch.column("block"), batch.column("at"), pa.array(
                    [(whole @ _numbers(x, m + b)[:m]).tobytes() for x in batch.column("x")], pa.binary())], names=["block", "at", "x"])
        rows = cut_lineage(krylov.mapInArrow(combine, PACKED).groupBy("block").applyInArrow(whole_block, "block int, x binary"))
        # M's eigenvalues are good to the square of the residual
        if off.max() ** 2 <= tol or ok.sum() >= n:
            def entries(batches):
                for batch in batches:
                    for block, x in zip(batch.column("block"), batch.column("x")):
                        x = _numbers(x, b)[:k].T
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.full(len(x), block.as_py(), np.int32)), pa.array(np.arange(len(x), dtype=np.int32)),
                             pa.ListArray.from_arrays(np.arange(len(x) + 1, dtype=np.int32) * x.shape[1], x.ravel())],
                            names=["block", "place", "x"])
            columns.unpersist()
            out = rows.mapInArrow(entries, "block int, place int, x array<double>").join(nodes, ["block", "place"]) \
                .select("id", F.transform("x", lambda a: a / F.col("root")).alias("x"))
            return Embedding(1 - theta[:k], out, r)
    columns.unpersist()
    raise RuntimeError(f"the eigenvectors did not settle in {max_rounds} rounds (residual {off.max():.1e})")


def spectral_clusters(df: DataFrame, id_col: str, vec: str, k: int, n_neighbors: int = 10, gamma: float | None = 1.0,
                      n_init: int = 5, seed: int = 42) -> DataFrame:
    """(id, cluster) by k-means on the rows of the Laplacian's k smallest
    eigenvectors."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector
    found = laplacian_embedding(knn_affinity(df, id_col, vec, n_neighbors, gamma), k, seed=seed)
    d = cut_lineage(found.rows.withColumn("f", array_to_vector("x")))
    models = [KMeans(k=k, featuresCol="f", predictionCol="cluster", seed=seed + s, maxIter=50).fit(d) for s in range(n_init)]
    best = min(models, key=lambda m: m.summary.trainingCost)
    return best.transform(d).select(F.col("id").alias(id_col), "cluster")
