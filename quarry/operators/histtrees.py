"""Trees grown from histograms that the executors add up.

Rows are coded once: each feature by the number of its edges below the value
(all midpoints of the distinct values up to ``max_bins``, else of quantiles),
and packed into blocks that a pass reads as numpy arrays.  One pass routes all
rows through the tree as it stands and adds up, per open node and feature, the
statistics of each code; the parts of all tasks meet by (node, feature), where
the best split is found, so the driver sees one row per node and feature.

Growth is best first: the leaf with the largest gain is split next.  A pass
looks at the open leaves and, ahead, at the children they would have, so the
number of passes goes with the depth, not with the leaves.

Rows with a null or NaN in their features, label or weight take no part.
"""

from __future__ import annotations

import heapq
import pickle
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.session import scratch_path


@dataclass(frozen=True)
class Rule:
    """What a split is worth.  Statistics of a row: its count of one, then class
    weights (gini, entropy), w, w y, w y^2 (variance) or gradient and hessian (newton)."""
    kind: str
    min_leaf: int = 1
    penalty: float = 1.0          # newton: lambda
    cost: float = 0.0             # newton: gamma, the least gain of a split
    min_hessian: float = 0.0

    def impurity(self, s: np.ndarray) -> np.ndarray:
        """Weighted impurity of statistics along the last axis."""
        v = s[..., 1:]
        with np.errstate(all="ignore"):
            if self.kind == "newton":
                out = -0.5 * v[..., 0] ** 2 / (v[..., 1] + self.penalty)
            elif self.kind == "variance":
                out = np.maximum(v[..., 2] - v[..., 1] ** 2 / v[..., 0], 0)
            else:
                total = v.sum(-1)
                p = v / total[..., None]
                out = total * (1 - (p ** 2).sum(-1) if self.kind == "gini"
                               else -np.where(p > 0, p * np.log2(np.maximum(p, 1e-300)), 0).sum(-1))
        return np.where(s[..., 0] > 0, np.nan_to_num(out), 0.0)

    def value(self, s: np.ndarray) -> np.ndarray:
        """What a leaf of these statistics predicts."""
        if self.kind == "newton":
            return np.array([-s[1] / (s[2] + self.penalty)])
        if self.kind == "variance":
            return np.array([s[2] / s[1]])
        return s[1:] / s[1:].sum()

    def best(self, hist: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(edge, gain, statistics on the left) of the best split of ... x codes x
        statistics: the largest gain, then the lowest edge; edge -1 is none."""
        left = np.cumsum(hist, axis=-2)[..., :-1, :]
        total = hist.sum(axis=-2)
        if not left.shape[-2]:
            return np.full(total.shape[:-1], -1), np.zeros(total.shape[:-1]), np.zeros(total.shape)
        right = total[..., None, :] - left
        ok = (left[..., 0] >= self.min_leaf) & (right[..., 0] >= self.min_leaf)
        if self.kind == "newton":
            ok &= (left[..., 2] >= self.min_hessian) & (right[..., 2] >= self.min_hessian)
        whole = self.impurity(total)
        gain = whole[..., None] - self.impurity(left) - self.impurity(right) - self.cost
        gain = np.where(ok, gain, -np.inf)
        top = gain.max(-1)
        some = top > 1e-12 * np.maximum(1.0, np.abs(whole))
        at = (gain >= (top - 1e-9 * np.abs(np.where(some, top, 0)))[..., None]).argmax(-1)
        take = np.take_along_axis(left, at[..., None, None], axis=-2)[..., 0, :]
        return np.where(some, at, -1), np.where(some, top, 0.0), take


def best_feature(gains: np.ndarray) -> int | None:
    """The first feature whose gain is the largest (but for rounding)."""
    top = gains.max(initial=0.0)
    return int(np.argmax(gains >= top * (1 - 1e-9))) if top > 0 else None


@dataclass
class Split:
    feature: int
    edge: int
    gain: float
    left: np.ndarray
    right: np.ndarray


@dataclass
class Tree:
    """Nodes in order of their making; feature -1 is a leaf."""
    feature: list[int] = field(default_factory=lambda: [-1])
    edge: list[int] = field(default_factory=lambda: [0])
    left: list[int] = field(default_factory=lambda: [0])
    right: list[int] = field(default_factory=lambda: [0])
    stats: list[np.ndarray | None] = field(default_factory=lambda: [None])
    depth: list[int] = field(default_factory=lambda: [0])
    gain: list[float] = field(default_factory=lambda: [0.0])

    def split(self, node: int, s: Split) -> tuple[int, int]:
        a = len(self.feature)
        for stats in (s.left, s.right):
            self.feature.append(-1)
            self.edge.append(0)
            self.left.append(0)
            self.right.append(0)
            self.stats.append(stats)
            self.depth.append(self.depth[node] + 1)
            self.gain.append(0.0)
        self.feature[node], self.edge[node], self.gain[node] = s.feature, s.edge, s.gain
        self.left[node], self.right[node] = a, a + 1
        return a, a + 1

    def leaves(self) -> int:
        return sum(f < 0 for f in self.feature)

    def route(self, rows: np.ndarray, cuts: Sequence | None = None) -> np.ndarray:
        """Node of each row; ``rows`` are codes, or values where ``cuts`` gives
        each node's threshold."""
        f, left, right = np.array(self.feature), np.array(self.left), np.array(self.right)
        edge = np.array(self.edge if cuts is None else cuts)
        node = np.zeros(len(rows), np.int64)
        for _ in range(max(self.depth, default=0)):
            inner = np.flatnonzero(f[node] >= 0)
            if not len(inner):
                break
            at = node[inner]
            node[inner] = np.where(rows[inner, f[at]] <= edge[at], left[at], right[at])
        return node


Evaluate = Callable[[Tree, list[int]], dict[int, tuple[np.ndarray, Split | None]]]


def grow(evaluate: Evaluate, max_leaf_nodes: int | None = None, max_depth: int | None = None,
         min_samples_split: int = 2) -> Tree:
    """Best-first growth.  ``evaluate(tree, nodes)`` gives (statistics, best
    split) of nodes of a tree; children that a leaf would have are tried in a
    draft of the tree before the leaf is split in earnest."""
    draft, known, name = Tree(), {}, {0: 0}       # draft node -> its split; tree node -> draft node
    draft.stats[0] = None
    tree, heap, made = Tree(), [], {}
    most = max_leaf_nodes or 1 << 60

    def may(node: int, s: Split | None) -> bool:
        return s is not None and (max_depth is None or draft.depth[node] < max_depth)

    def look(nodes: list[int]) -> None:
        nodes = [n for n in nodes if n not in known]
        # what need not be looked at: too deep or too few rows
        for n in list(nodes):
            if draft.stats[n] is not None and (
                    max_depth is not None and draft.depth[n] >= max_depth or draft.stats[n][0] < min_samples_split):
                known[n] = None
                nodes.remove(n)
        if nodes:
            for n, (stats, s) in evaluate(draft, nodes).items():
                draft.stats[n] = stats if draft.stats[n] is None else draft.stats[n]
                known[n] = s if may(n, s) and stats[0] >= min_samples_split else None
            for n in nodes:
                known.setdefault(n, None)

    def children(n: int) -> tuple[int, int]:
        if n not in made:
            made[n] = draft.split(n, known[n])
        return made[n]

    look([0])
    tree.stats[0] = draft.stats[0]
    if known[0]:
        heap.append((-known[0].gain, 0))
    while heap and tree.leaves() < most:
        _, node = heap[0]
        kids = children(name[node])
        if not all(k in known for k in kids):
            # look ahead: the children of all leaves that may still be split
            ahead = [name[n] for _, n in heapq.nsmallest(most - tree.leaves() if max_leaf_nodes else len(heap), heap)]
            look([k for n in ahead for k in children(n)])
        heapq.heappop(heap)
        for mine, theirs in zip(tree.split(node, known[name[node]]), kids):
            name[mine] = theirs
            if known[theirs]:
                heapq.heappush(heap, (-known[theirs].gain, mine))
    return tree


def histograms(codes: np.ndarray, index: np.ndarray, stats: np.ndarray, nodes: int, bins: int) -> np.ndarray:
    """nodes x features x codes x statistics; rows of index -1 are left out."""
    own = index >= 0
    codes, index, stats = codes[own], index[own], stats[own]
    out = np.empty((nodes, codes.shape[1], bins, stats.shape[1]))
    for j in range(codes.shape[1]):
        at = index * bins + codes[:, j]
        for s in range(stats.shape[1]):
            out[:, j, :, s] = np.bincount(at, stats[:, s], nodes * bins).reshape(nodes, bins)
    return out


def in_memory(codes: np.ndarray, stats: np.ndarray, bins: int, rule: Rule) -> Evaluate:
    """Evaluation of a bounded number of rows inside a task."""
    def evaluate(tree: Tree, nodes: list[int]):
        place = np.full(len(tree.feature), -1)
        place[nodes] = np.arange(len(nodes))
        hist = histograms(codes, place[tree.route(codes)], stats, len(nodes), bins)
        edge, gain, left = rule.best(hist)
        out = {}
        for i, n in enumerate(nodes):
            total, j = hist[i, 0].sum(axis=0), best_feature(gain[i])
            out[n] = total, None if j is None else Split(
                j, int(edge[i, j]), float(gain[i, j]), left[i, j], total - left[i, j])
        return out
    return evaluate


# ------------------------------------------------------------------ rows
def feature_array(df: DataFrame, features: str):
    is_vector = isinstance(df.schema[features].dataType, VectorUDT)
    return vector_to_array(features) if is_vector else F.col(features).cast("array<double>")


def whole_rows(df: DataFrame, features: str, label: str, weight: str | None) -> DataFrame:
    d = df.select(feature_array(df, features).alias("x"), F.col(label).cast("double").alias("y"),
                  (F.col(weight).cast("double") if weight else F.lit(1.0)).alias("w"))
    return d.where("x IS NOT NULL AND y IS NOT NULL AND w IS NOT NULL AND NOT isnan(y) AND NOT isnan(w)") \
        .where(F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v)))


def stored_rows(rows: DataFrame, name: str) -> DataFrame:
    """The rows written once: the passes before the packing read them back."""
    path = scratch_path(rows.sparkSession, name)
    rows.write.parquet(path)
    return rows.sparkSession.read.parquet(path)


def edges_of(values: np.ndarray) -> np.ndarray:
    values = np.unique(values)
    middle = values[:-1] + (values[1:] - values[:-1]) / 2
    return np.where(middle >= values[1:], values[:-1], middle)


def find_edges(rows: DataFrame, max_bins: int) -> list[np.ndarray]:
    """The edges of each feature: one aggregate for the numbers of values, one
    for the values themselves (few) or their quantiles."""
    d = rows.agg(F.max(F.size("x"))).first()[0] or 0
    if not d:
        return []
    long = rows.select(F.posexplode("x").alias("j", "v"))
    few = [r["j"] for r in long.groupBy("j").agg(F.approx_count_distinct("v", 0.01).alias("n")).collect() if r["n"] <= max_bins]
    found = {r["j"]: r["v"] for r in long.where(F.col("j").isin(few)).groupBy("j").agg(F.collect_set("v").alias("v")).collect()}
    if len(few) < d:
        steps = [i / max_bins for i in range(max_bins + 1)]
        found |= {r["j"]: r["v"] for r in long.where(~F.col("j").isin(few)).groupBy("j")
                  .agg(F.percentile_approx("v", steps, 100 * max_bins).alias("v")).collect()}
    return [edges_of(np.array(found[j], float)) for j in range(d)]


def code(x: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    return np.stack([np.searchsorted(e, x[:, j], "left") for j, e in enumerate(edges)], axis=1).astype(np.uint16)


def list_matrix(column) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.asarray(column.flatten()).reshape(len(column), -1)


def pack(rows: DataFrame, edges: list[np.ndarray] | None, name: str, block_rows: int = 1 << 14, **start) -> DataFrame:
    """Blocks of rows (n, x, y, w, m) written once: codes of the features (or the
    values where ``edges`` is None), labels, weights and a margin ``start``."""
    margin = float(start.get("margin", 0.0))

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, block_rows):
                part = batch.slice(at, block_rows)
                x = list_matrix(part.column("x"))
                x = x if edges is None else code(x, edges)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part.num_rows]), pa.array([np.ascontiguousarray(x).tobytes()], pa.binary()),
                     *(pa.array([np.asarray(part.column(c), float).tobytes()], pa.binary()) for c in ("y", "w")),
                     pa.array([np.full(part.num_rows, margin).tobytes()], pa.binary())], names=["n", "x", "y", "w", "m"])
    path = scratch_path(rows.sparkSession, name)
    rows.mapInArrow(run, BLOCK).write.parquet(path)
    return rows.sparkSession.read.parquet(path)


#: (codes, y, w, margin) of no rows.
EMPTY = (np.zeros((0, 1), np.uint16), np.zeros(0), np.zeros(0), np.zeros(0))
BLOCK = "n long, x binary, y binary, w binary, m binary"


def unpack(batch: pa.RecordBatch, kind=np.uint16):
    """(x, y, w, margin) of each block of a batch."""
    for i in range(batch.num_rows):
        n = batch.column("n")[i].as_py()
        x = np.frombuffer(batch.column("x")[i].as_py(), kind).reshape(n, -1)
        yield x, *(np.frombuffer(batch.column(c)[i].as_py(), float) for c in ("y", "w", "m"))


def on_executors(blocks: DataFrame, stats_of: Callable, bins: int, rule: Rule, most_cells: int = 1 << 23) -> Evaluate:
    """Evaluation over packed blocks; ``stats_of(codes, y, w, margin)`` gives the
    statistics of rows.  Nodes are taken in groups whose histograms stay small."""
    def some(tree: Tree, nodes: list[int]):
        place = np.full(len(tree.feature), -1)
        place[nodes] = np.arange(len(nodes))

        def part(batches):
            total = None
            for batch in batches:
                for x, y, w, m in unpack(batch):
                    h = histograms(x, place[tree.route(x)], stats_of(x, y, w, m), len(nodes), bins)
                    total = h if total is None else total + h
            if total is not None:
                a, d = total.shape[:2]
                step = max(1, 4096 // (bins * total.shape[3]))       # features that travel together
                first = np.arange(0, d, step)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(np.arange(a), len(first))), pa.array(np.tile(first, a)),
                     pa.array([total[i, j:j + step].tobytes() for i in range(a) for j in first], pa.binary())],
                    names=["node", "feature", "hist"])

        def merge(group: pa.Table) -> pa.Table:
            total = np.frombuffer(group.column("hist")[0].as_py(), float).copy()
            for h in group.column("hist")[1:]:
                total += np.frombuffer(h.as_py(), float)
            hist = total.reshape(-1, bins, width)
            edge, gain, left = rule.best(hist)
            n = len(hist)
            return pa.table({"node": pa.array([group.column("node")[0].as_py()] * n),
                             "feature": pa.array(group.column("feature")[0].as_py() + np.arange(n)),
                             "edge": pa.array(edge), "gain": pa.array(gain),
                             "left": pa.array(left.tolist(), pa.list_(pa.float64())),
                             "total": pa.array(hist.sum(axis=1).tolist(), pa.list_(pa.float64()))})
        width = stats_of(*EMPTY).shape[1]
        found = blocks.mapInArrow(part, "node long, feature long, hist binary").groupBy("node", "feature").applyInArrow(
            merge, "node long, feature long, edge long, gain double, left array<double>, total array<double>")
        per_node: dict = {}
        for r in sorted(found.collect(), key=lambda r: (r["node"], r["feature"])):   # nodes x features rows
            per_node.setdefault(nodes[r["node"]], []).append(r)
        out = {}
        for n, own in per_node.items():
            total, j = np.array(own[0]["total"]), best_feature(np.array([r["gain"] for r in own]))
            out[n] = total, None if j is None else Split(own[j]["feature"], own[j]["edge"], own[j]["gain"],
                                                         np.array(own[j]["left"]), total - np.array(own[j]["left"]))
        return out

    def evaluate(tree: Tree, nodes: list[int]):
        step, out = max(1, most_cells // (bins * 256)), {}
        for at in range(0, len(nodes), step):
            out |= some(tree, nodes[at:at + step])
        return out
    return evaluate


# ------------------------------------------------------------------ models
@dataclass
class TreeModel:
    """A grown tree with thresholds in the features' own values."""
    tree: Tree
    cuts: list[float]
    values: np.ndarray
    kind: str
    n_features: int

    @classmethod
    def of(cls, tree: Tree, edges: list[np.ndarray], rule: Rule) -> TreeModel:
        cuts = [float(edges[f][e]) if f >= 0 else 0.0 for f, e in zip(tree.feature, tree.edge)]
        return cls(tree, cuts, np.stack([rule.value(s) for s in tree.stats]), rule.kind, len(edges))

    @property
    def n_leaves(self) -> int:
        return self.tree.leaves()

    def importances(self) -> np.ndarray:
        out = np.zeros(self.n_features)
        np.add.at(out, [f for f in self.tree.feature if f >= 0], [g for f, g in zip(self.tree.feature, self.tree.gain) if f >= 0])
        return out / out.sum() if out.sum() else out

    def predict_rows(self, x: np.ndarray) -> np.ndarray:
        return self.values[self.tree.route(x, self.cuts)]

    def transform(self, df: DataFrame, features: str = "features") -> DataFrame:
        """Adds prediction, and probability for classes; null where a feature is."""
        values = predicted(df, features, self.predict_rows)
        if self.kind in ("gini", "entropy"):
            d = df.withColumn("probability", values)
            return d.withColumn("prediction", (F.array_position("probability", F.array_max("probability")) - 1).cast("double"))
        return df.withColumn("prediction", values[0])


def predicted(df: DataFrame, features: str, rows_to_values: Callable):
    """A column of value arrays, in Arrow batches; null where a feature is."""
    @F.arrow_udf("array<double>")
    def run(x: pa.Array) -> pa.Array:
        good = np.asarray(x.is_valid())
        rows = list_matrix(x.drop_null()).astype(float) if good.any() else np.zeros((0, 0))
        whole = ~np.isnan(rows).any(axis=1)
        good[good] = whole
        if not good.any():
            return pa.nulls(len(x), pa.list_(pa.float64()))
        found = np.ascontiguousarray(rows_to_values(rows[whole]), float)
        ends = np.concatenate([[0], np.cumsum(good * found.shape[1])]).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(found.ravel()), mask=pa.array(~good))
    return run(feature_array(df, features))


def class_stats(classes: int) -> Callable:
    def stats(x, y, w, m):
        out = np.zeros((len(y), classes + 1))
        out[:, 0] = 1
        out[np.arange(len(y)), y.astype(np.int64) + 1] = w
        return out
    return stats


def value_stats(centre: float) -> Callable:
    return lambda x, y, w, m: np.stack([np.ones(len(y)), w, w * (y - centre), w * (y - centre) ** 2], axis=1)


def best_first_tree(df: DataFrame, features: str = "features", label: str = "label", weight: str | None = None,
                    criterion: str = "gini", max_leaf_nodes: int | None = None, max_depth: int | None = None,
                    min_samples_split: int = 2, min_samples_leaf: int = 1, max_bins: int = 256) -> TreeModel:
    """A tree of at most ``max_leaf_nodes`` leaves, split where the weighted
    impurity falls most (``gini``, ``entropy``, or ``variance`` for a number)."""
    rows = stored_rows(whole_rows(df, features, label, weight), "tree_input")
    edges = find_edges(rows, max_bins)
    n, top, mean = rows.agg(F.count("*"), F.max("y"), F.avg("y")).first()
    if not n:
        raise ValueError("no complete rows to grow a tree from")
    rule = Rule(criterion, min_samples_leaf)
    stats = value_stats(mean) if criterion == "variance" else class_stats(int(top) + 1)
    blocks = pack(rows, edges, "tree_rows")
    bins = max((len(e) for e in edges), default=0) + 1
    tree = grow(on_executors(blocks, stats, bins, rule), max_leaf_nodes, max_depth, min_samples_split)
    model = TreeModel.of(tree, edges, rule)
    if criterion == "variance":
        model.values = model.values + mean
    return model


# ------------------------------------------------------------------ L25
@dataclass
class Boosted:
    trees: list[TreeModel]
    base: float
    rate: float
    logistic: bool
    eval_losses: list[float]
    best_iteration: int

    def margin(self, x: np.ndarray) -> np.ndarray:
        out = np.full((len(x), 1), self.base)
        for t in self.trees:
            out += self.rate * t.predict_rows(x)
        return out

    def transform(self, df: DataFrame, features: str = "features") -> DataFrame:
        m = predicted(df, features, self.margin)[0]
        if self.logistic:
            d = df.withColumn("probability", 1 / (1 + F.exp(-m)))
            return d.withColumn("prediction", (F.col("probability") > 0.5).cast("double"))
        return df.withColumn("prediction", m)


def boosted_trees(df: DataFrame, features: str = "features", label: str = "label", weight: str | None = None,
                  eval_set: DataFrame | None = None, objective: str = "squared", n_estimators: int = 100,
                  learning_rate: float = 0.3, max_depth: int = 6, reg_lambda: float = 1.0, gamma: float = 0.0,
                  min_child_weight: float = 1.0, early_stopping_rounds: int | None = None,
                  max_bins: int = 256, refresh: int = 10) -> Boosted:
    """Second-order boosting.  Each tree fits gradients and hessians of the
    loss (``squared`` or ``logistic``) with leaf weight -G / (H + lambda); the
    staged loss on ``eval_set`` ends the training once it has not improved for
    ``early_stopping_rounds`` trees, and the best number of trees is kept.

    Margins are stored with the blocks and renewed every ``refresh`` trees, and
    the stages since then are judged in one pass."""
    logistic = objective == "logistic"
    rows = stored_rows(whole_rows(df, features, label, weight), "boost_input")
    edges = find_edges(rows, max_bins)
    n, mean = rows.agg(F.count("*"), F.sum(F.col("w") * F.col("y")) / F.sum("w")).first()
    if not n:
        raise ValueError("no complete rows to boost on")
    mean_ = min(max(mean, 1e-6), 1 - 1e-6) if logistic else mean
    base = float(np.log(mean_ / (1 - mean_))) if logistic else float(mean_)
    rule = Rule("newton", 1, reg_lambda, gamma, min_child_weight)
    bins = max((len(e) for e in edges), default=0) + 1
    blocks = pack(rows, edges, "boost_rows", margin=base)
    held = None if eval_set is None else pack(whole_rows(eval_set, features, label, weight), edges, "boost_eval", margin=base)
    trees: list[Tree] = []
    losses: list[float] = []
    best = 0

    def leaf_values(t: Tree) -> np.ndarray:
        return np.array([learning_rate * rule.value(s)[0] for s in t.stats])

    def stats_with(recent: list[tuple[Tree, np.ndarray]]) -> Callable:
        def stats(x, y, w, m):
            for t, v in recent:
                m = m + v[t.route(x)]
            if logistic:
                p = 1 / (1 + np.exp(-m))
                return np.stack([np.ones(len(y)), w * (p - y), w * p * (1 - p)], axis=1)
            return np.stack([np.ones(len(y)), w * (m - y), w], axis=1)
        return stats

    def renewed(table: DataFrame, recent, name: str) -> DataFrame:
        def run(batches):
            for batch in batches:
                new = []
                for x, _, _, m in unpack(batch):
                    for t, v in recent:
                        m = m + v[t.route(x)]
                    new.append(m.tobytes())
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("n", "x", "y", "w")), pa.array(new, pa.binary())],
                                                 names=["n", "x", "y", "w", "m"])
        path = scratch_path(table.sparkSession, name)
        table.mapInArrow(run, BLOCK).write.parquet(path)
        return table.sparkSession.read.parquet(path)

    def staged(table: DataFrame, recent) -> list[float]:
        """Mean loss after each of the recent trees."""
        def run(batches):
            total = np.zeros((len(recent), 2))
            for batch in batches:
                for x, y, w, m in unpack(batch):
                    for k, (t, v) in enumerate(recent):
                        m = m + v[t.route(x)]
                        each = np.logaddexp(0, m) - y * m if logistic else (y - m) ** 2
                        total[k] += (w * each).sum(), w.sum()
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(recent))), *(pa.array(c) for c in total.T)],
                                             names=["k", "loss", "w"])
        got = table.mapInArrow(run, "k long, loss double, w double").groupBy("k").agg(F.sum("loss").alias("l"), F.sum("w").alias("w")).collect()
        return [r["l"] / r["w"] if r["w"] else float("nan") for r in sorted(got, key=lambda r: r["k"])]

    recent: list[tuple[Tree, np.ndarray]] = []
    stop = False
    while len(trees) < n_estimators and not stop:
        t = grow(on_executors(blocks, stats_with(recent), bins, rule), None, max_depth)
        trees.append(t)
        recent.append((t, leaf_values(t)))
        if len(recent) == refresh or len(trees) == n_estimators:
            if held is not None:
                for loss in staged(held, recent):
                    losses.append(loss)
                    if loss < losses[best]:
                        best = len(losses) - 1
                    elif early_stopping_rounds and len(losses) - 1 - best >= early_stopping_rounds:
                        stop = True
                        break
            if not stop and len(trees) < n_estimators:
                blocks = renewed(blocks, recent, "boost_rows")
                held = None if held is None else renewed(held, recent, "boost_eval")
                recent = []
    if held is not None and losses:
        trees = trees[:best + 1] if early_stopping_rounds else trees
    return Boosted([TreeModel.of(t, edges, rule) for t in trees], base, learning_rate, logistic, losses,
                   best if losses else len(trees) - 1)


# ------------------------------------------------------------------ L20 / L22
def fit_small(x: np.ndarray, y: np.ndarray, w: np.ndarray, classes: int, max_leaf_nodes=None, max_depth=None,
              min_samples_split: int = 2, min_samples_leaf: int = 1) -> TreeModel:
    """A classifier on the rows of one group."""
    edges = [edges_of(x[:, j]) for j in range(x.shape[1])]
    rule = Rule("gini", min_samples_leaf)
    bins = max(len(e) for e in edges) + 1
    tree = grow(in_memory(code(x, edges), class_stats(classes)(x, y, w, None), bins, rule),
                max_leaf_nodes, max_depth, min_samples_split)
    return TreeModel.of(tree, edges, rule)


def keyed_trees(rows: DataFrame, key: str, features: str, label: str, classes: int, weight: str | None = None,
                **tree_kw) -> list[tuple[int, TreeModel]]:
    """One tree per key in one job: each group (of bounded size) is fitted where
    it lies, and only the grown trees come back."""
    columns = [F.col(key).cast("long").alias("k"), feature_array(rows, features).alias("x"),
               F.col(label).cast("double").alias("y"), (F.col(weight).cast("double") if weight else F.lit(1.0)).alias("w")]

    def fit(group: pa.Table) -> pa.Table:
        model = fit_small(list_matrix(group.column("x")), np.asarray(group.column("y")), np.asarray(group.column("w")),
                          classes, **tree_kw)
        return pa.table({"k": group.column("k")[:1], "model": pa.array([pickle.dumps(model)], pa.binary())})
    found = rows.select(*columns).groupBy("k").applyInArrow(fit, "k long, model binary").collect()
    return sorted(((r["k"], pickle.loads(bytes(r["model"]))) for r in found), key=lambda t: t[0])


def small_tree_votes(df: DataFrame, models: list[tuple[int, TreeModel]], features: str = "features",
                     classes: int | None = None) -> DataFrame:
    """Adds ``votes``: the class each tree predicts, in the order of the trees; or,
    given the number of ``classes``, the number of trees for each of them, which
    is all that a task then holds per row."""
    own = [m for _, m in models]
    if classes is not None:
        def count(x: np.ndarray) -> np.ndarray:
            votes, at = np.zeros((len(x), classes)), np.arange(len(x))
            for m in own:
                votes[at, m.predict_rows(x).argmax(1)] += 1
            return votes
        return df.withColumn("votes", predicted(df, features, count))
    return df.withColumn("votes", predicted(df, features, lambda x: np.stack(
        [m.predict_rows(x).argmax(1) for m in own], axis=1).astype(float)))
