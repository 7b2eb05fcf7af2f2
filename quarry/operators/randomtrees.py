"""Extra-trees (L19): thresholds drawn at random, all trees grown level by level.

Which features a node tries, and where in their range the thresholds lie, are
drawn from a hash of (seed, tree, node), so a run repeats under any
partitioning.  A level takes two aggregates for all open nodes of all trees:
the range of each tried feature inside its node, then the class weights on
either side of each drawn threshold.  The driver sees one row per open node and
tried feature; rows are routed through the trees as they stand, never copied.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.operators.histtrees import Rule, Split, Tree, pack, predicted, unpack, whole_rows


@dataclass
class ExtraTrees:
    trees: list[Tree]
    cuts: list[list[float]]
    shares: list[np.ndarray]         # class shares of each node
    n_features: int

    def proba(self, x: np.ndarray) -> np.ndarray:
        return sum(s[t.route(x, c)] for t, c, s in zip(self.trees, self.cuts, self.shares)) / len(self.trees)

    def transform(self, df: DataFrame, features: str = "features") -> DataFrame:
        """Adds probability (mean class shares of the trees' leaves) and prediction."""
        d = df.withColumn("probability", predicted(df, features, self.proba))
        return d.withColumn("prediction", (F.array_position("probability", F.array_max("probability")) - 1).cast("double"))

    def importances(self) -> np.ndarray:
        """Mean share of each feature in the impurity that a tree's splits take away."""
        out = np.zeros(self.n_features)
        for t in self.trees:
            own = np.zeros(self.n_features)
            for f, g in zip(t.feature, t.gain):
                if f >= 0:
                    own[f] += g
            out += own / own.sum() if own.sum() else own
        return out / out.sum() if out.sum() else out


def draws(seed: int, tree: int, node: int, n_features: int, tries: int) -> tuple[np.ndarray, np.ndarray]:
    """(features to try, where in their ranges the thresholds lie)."""
    rng = np.random.default_rng([seed, tree, node])
    return rng.choice(n_features, tries, replace=False), rng.random(tries)


def extra_trees(df: DataFrame, features: str = "features", label: str = "label", weight: str | None = None,
                n_estimators: int = 100, max_features: int | None = None, max_depth: int = 10,
                min_samples_split: int = 2, criterion: str = "gini", seed: int = 42) -> ExtraTrees:
    """A forest of extremely random trees on all rows (no bootstrap); of
    ``max_features`` random splits (square root of all by default) a node takes
    the best."""
    rows = whole_rows(df, features, label, weight)
    n, top, d = rows.agg(F.count("*"), F.max("y"), F.max(F.size("x"))).first()
    if not n:
        raise ValueError("no complete rows to grow trees from")
    classes, tries = int(top) + 1, min(max_features or max(1, int(np.sqrt(d))), d)
    blocks = pack(rows, None, "extra_rows")
    rule = Rule(criterion)
    trees, cuts = [Tree() for _ in range(n_estimators)], [[0.0] for _ in range(n_estimators)]
    open_ = [(t, 0) for t in range(n_estimators)]

    def places(x: np.ndarray):
        """(rows, their open node's place) for each tree."""
        for t, tree in enumerate(trees):
            if t in of_tree:
                at = of_tree[t][tree.route(x, cuts[t])]
                own = np.flatnonzero(at >= 0)
                yield own, at[own]

    def ranges(batches):
        low, high = np.full(tried.shape, np.inf), np.full(tried.shape, -np.inf)
        for batch in batches:
            for x, _, w, _ in unpack(batch, float):
                for own, at in places(x):
                    for k in range(tries):
                        v = x[own, tried[at, k]]
                        np.minimum.at(low[:, k], at, v)
                        np.maximum.at(high[:, k], at, v)
        i, k = np.nonzero(np.isfinite(low))
        yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(k), pa.array(low[i, k]), pa.array(high[i, k])],
                                         names=["i", "k", "low", "high"])

    def sides(batches):
        out = np.zeros((*tried.shape, 2, classes + 1))
        for batch in batches:
            for x, y, w, _ in unpack(batch, float):
                y = y.astype(np.int64)
                for own, at in places(x):
                    for k in range(tries):
                        side = (x[own, tried[at, k]] > cut[at, k]).astype(np.int64)
                        cell = at * 2 + side
                        out[:, k, :, 0] += np.bincount(cell, minlength=2 * len(tried)).reshape(-1, 2)
                        out[:, k, :, 1:] += np.bincount(cell * classes + y[own], w[own], 2 * len(tried) * classes) \
                            .reshape(-1, 2, classes)
        i, k = np.nonzero(out[..., 0].sum(-1))
        yield pa.RecordBatch.from_arrays(
            [pa.array(i), pa.array(k), *(pa.array(out[i, k, s, c]) for s in range(2) for c in range(classes + 1))],
            names=["i", "k", *names])

    names = [f"s{s}_{c}" for s in range(2) for c in range(classes + 1)]
    while open_:
        of_tree = {}
        for i, (t, node) in enumerate(open_):
            of_tree.setdefault(t, np.full(len(trees[t].feature), -1))[node] = i
        drawn = [draws(seed, t, node, d, tries) for t, node in open_]
        tried = np.stack([x[0] for x in drawn])
        cut = np.full(tried.shape, np.nan)
        low, high = np.zeros(tried.shape), np.zeros(tried.shape)
        for r in blocks.mapInArrow(ranges, "i long, k long, low double, high double").groupBy("i", "k") \
                .agg(F.min("low").alias("low"), F.max("high").alias("high")).collect():
            low[r["i"], r["k"]], high[r["i"], r["k"]] = r["low"], r["high"]
        share = np.stack([x[1] for x in drawn])
        cut = np.minimum(low + share * (high - low), np.nextafter(high, -np.inf))
        cut = np.maximum(cut, low)
        stats = np.zeros((*tried.shape, 2, classes + 1))
        for r in blocks.mapInArrow(sides, "i long, k long, " + ", ".join(f"{c} double" for c in names)) \
                .groupBy("i", "k").agg(*(F.sum(c).alias(c) for c in names)).collect():
            stats[r["i"], r["k"]] = np.array([r[c] for c in names]).reshape(2, -1)
        fresh = []
        for i, (t, node) in enumerate(open_):
            total = stats[i, 0].sum(0)
            tree = trees[t]
            if tree.stats[node] is None:
                tree.stats[node] = total
            gains = rule.impurity(total) - rule.impurity(stats[i]).sum(-1)
            gains[(stats[i, :, :, 0] == 0).any(-1)] = -1.0
            k = int(gains.argmax())
            if total[0] < min_samples_split or rule.impurity(total) <= 1e-12 * total[0] or gains[k] < 0:
                continue
            for kid in tree.split(node, Split(int(tried[i, k]), 0, max(float(gains[k]), 0.0), stats[i, k, 0], stats[i, k, 1])):
                cuts[t].append(0.0)
                if tree.depth[kid] < max_depth and tree.stats[kid][0] >= min_samples_split:
                    fresh.append((t, kid))
            cuts[t][node] = float(cut[i, k])
        open_ = fresh
    return ExtraTrees(trees, cuts, [np.stack([rule.value(s) for s in t.stats]) for t in trees], d)
