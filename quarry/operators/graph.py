"""Connected components of an edge list by alternating star contraction."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.session import cut_lineage

#: Edges that a task holds before it contracts them.
HELD = 1_000_000
#: Edges that one task may finish.
FEW = 250_000


def stars(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, least node of its component) for the nodes of the edges (a, b) that
    are not the least themselves."""
    ids, flat = np.unique(np.concatenate([a, b]), return_inverse=True)
    root, u, v = np.arange(len(ids)), flat[:len(a)], flat[len(a):]
    while True:
        u, v = root[u], root[v]
        open_ = u != v
        u, v = u[open_], v[open_]
        if not len(u):
            break
        np.minimum.at(root, np.maximum(u, v), np.minimum(u, v))
        while (root[root] != root).any():
            root = root[root]
    moved = root != np.arange(len(ids))
    return ids[moved], ids[root[moved]]


def _contract(frames):
    """The edges (u, v) of a partition as stars."""
    held = [np.zeros((2, 0), np.int64)]
    for part in frames:
        held.append(np.stack([part["u"].to_numpy(np.int64), part["v"].to_numpy(np.int64)]))
        if sum(h.shape[1] for h in held) > max(HELD, 2 * held[0].shape[1]):
            held = [np.stack(stars(*np.concatenate(held, axis=1)))]
    u, v = stars(*np.concatenate(held, axis=1))
    for at in range(0, len(u), 100_000):
        yield pd.DataFrame({"u": u[at:at + 100_000], "v": v[at:at + 100_000]})


def star_components(edges: DataFrame, max_rounds: int = 200, small: int = 0) -> DataFrame:
    """(id, comp) for every node that has an edge (a, b) to another node; comp is
    the smallest id of its component (any orderable type).

    Each round links every node's larger neighbours to its smallest one (large
    star) and then its smaller neighbours (small star).  The number of rounds
    grows with the logarithm of the longest chain.  Neighbours are never
    gathered: a round is minima (combined before the shuffle) and joins on the
    node, whose skew Spark can split.  Every round is checkpointed, and a run
    that has not settled after ``max_rounds`` raises instead of stopping short.

    With ``small`` (long ids), every partition first replaces its edges by stars
    of its own components; if no more than ``small`` edges are left then or after
    a round, one task finishes them.
    """
    e = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")) \
        .where(F.col("u") != F.col("v"))
    e, seen = cut_lineage(e.mapInPandas(_contract, "u long, v long") if small else e.distinct()), None
    for _ in range(max_rounds):
        if small and (e.count() if seen is None else seen[0]) <= small:
            e = cut_lineage(e.coalesce(1).mapInPandas(_contract, "u long, v long"))
            break
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")) \
            .where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("v"))
        less = large.join(low.withColumnRenamed("v", "m"), "u") \
            .select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        e = cut_lineage(less.unionByName(low).distinct())
        mark = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark == seen:
            break
        seen = mark
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return e.select(F.col("u").alias("id"), F.col("v").alias("comp")).unionByName(
        e.select(F.col("v").alias("id"), F.col("v").alias("comp")).distinct())
