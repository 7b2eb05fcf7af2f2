"""Trees from histograms against brute force, and planted functions."""
import numpy as np
import pytest

from quarry.operators import histtrees as H


def frame(spark, x, y, **more):
    rows = [(int(i), [float(v) for v in a], float(b), *(float(c[i]) for c in more.values())) for i, (a, b) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, "id long, features array<double>, label double" + "".join(f", {n} double" for n in more)).repartition(3)


def impurity(y, kind, classes):
    if kind == "variance":
        return ((y - y.mean()) ** 2).sum()
    p = np.bincount(y.astype(int), minlength=classes) / len(y)
    return len(y) * (1 - (p ** 2).sum() if kind == "gini" else -(p[p > 0] * np.log2(p[p > 0])).sum())


def brute(x, y, kind, max_leaf, min_split, min_leaf, max_depth=None):
    """Leaves (sets of rows) of the best-first tree, by trying every split of every leaf."""
    classes = int(y.max()) + 1
    leaves = [(np.arange(len(y)), 0)]

    def best(rows, depth):
        out = None
        if len(rows) < min_split or max_depth is not None and depth >= max_depth:
            return None
        for j in range(x.shape[1]):
            values = np.unique(x[rows, j])
            for a, b in zip(values, values[1:]):
                left, right = rows[x[rows, j] <= a], rows[x[rows, j] > a]
                if min(len(left), len(right)) >= min_leaf:
                    gain = impurity(y[rows], kind, classes) - impurity(y[left], kind, classes) - impurity(y[right], kind, classes)
                    if gain > 1e-9 and (out is None or gain > out[0] * (1 + 1e-9)):
                        out = gain, left, right
        return out
    while max_leaf is None or len(leaves) < max_leaf:
        found = [(b[0], i, b) for i, (rows, depth) in enumerate(leaves) if (b := best(rows, depth))]
        if not found:
            break
        _, i, (_, left, right) = max(found, key=lambda f: f[0])
        depth = leaves.pop(i)[1] + 1
        leaves += [(left, depth), (right, depth)]
    return sorted(tuple(rows.tolist()) for rows, _ in leaves)


def leaves_of(model, x):
    node = model.tree.route(x, model.cuts)
    return sorted(tuple(np.flatnonzero(node == n).tolist()) for n in np.unique(node))


@pytest.mark.parametrize("kind,max_leaf,min_split,min_leaf,max_depth", [
    ("gini", 9, 2, 1, None), ("gini", None, 40, 1, None), ("entropy", 6, 2, 15, None), ("variance", 12, 2, 1, None),
    ("variance", None, 2, 1, 3)])
def test_best_first_equals_brute_force(spark, kind, max_leaf, min_split, min_leaf, max_depth):
    rng = np.random.default_rng(3)
    x = np.round(rng.normal(size=(500, 4)), 1)
    y = (x[:, 0] * 2 + np.abs(x[:, 1]) > 1).astype(int) + (x[:, 2] > 0.4 + 0.3 * rng.normal(size=500))
    y = y.astype(float) if kind != "variance" else y + 0.5 * x[:, 3] + 0.01 * rng.normal(size=500)
    model = H.best_first_tree(frame(spark, x, y), criterion=kind, max_leaf_nodes=max_leaf, min_samples_split=min_split,
                              min_samples_leaf=min_leaf, max_depth=max_depth, max_bins=512)
    assert leaves_of(model, x) == brute(x, y, kind, max_leaf, min_split, min_leaf, max_depth)
    if max_leaf:
        assert model.n_leaves == max_leaf
    assert abs(model.importances().sum() - 1) < 1e-9
    got = {r["id"]: r for r in model.transform(frame(spark, x, y)).collect()}
    for rows in leaves_of(model, x):
        if kind == "variance":
            assert abs(got[rows[0]]["prediction"] - y[list(rows)].mean()) < 1e-9
        else:
            share = np.bincount(y[list(rows)].astype(int), minlength=3) / len(rows)
            assert np.allclose(got[rows[0]]["probability"], share) and got[rows[0]]["prediction"] == share.argmax()


def test_small_trees_in_one_job(spark):
    rng = np.random.default_rng(4)
    x, y = np.round(rng.normal(size=(400, 3)), 2), None
    y = (x[:, 0] + x[:, 1] > 0).astype(float)
    sets = [(s, int(i)) for s in range(60) for i in rng.choice(400, 100, replace=False)]
    rows = spark.createDataFrame([(s, x[i].tolist(), float(y[i])) for s, i in sets], "s long, features array<double>, label double")
    jobs = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("small trees", "")
    models = H.keyed_trees(rows, "s", "features", "label", 2, max_leaf_nodes=6)
    assert len(jobs.getJobIdsForGroup("small trees")) <= 2
    spark.sparkContext.setJobGroup("other", "")
    assert len(models) == 60
    for s in (0, 17):
        own = [i for t, i in sets if t == s]
        assert leaves_of(models[s][1], x[own]) == brute(x[own], y[own], "gini", 6, 2, 1)
    votes = H.small_tree_votes(frame(spark, x, y), models).collect()
    assert np.mean([(np.mean(r["votes"]) > 0.5) == r["label"] for r in votes]) > 0.9


def test_weights_nulls_and_few_bins(spark):
    rng = np.random.default_rng(5)
    x, y = rng.normal(size=(300, 2)), (rng.random(300) > 0.5).astype(float)
    w = np.where(x[:, 0] > 0, y * 9 + 1, (1 - y) * 9 + 1)
    df = frame(spark, x, y, w=w)
    odd = spark.createDataFrame([(900, None, 1.0, 1.0), (901, [None, 1.0], 1.0, 1.0), (902, [float("nan"), 1.0], 0.0, 1.0),
                                 (903, [1.0, 1.0], None, 1.0)], df.schema)
    model = H.best_first_tree(df.unionByName(odd), weight="w", max_leaf_nodes=2, max_bins=32)
    assert model.tree.feature[0] == 0 and abs(model.cuts[0]) < 0.25
    assert {r["prediction"] for r in model.transform(odd.where("id < 903")).collect()} == {None}
    with pytest.raises(ValueError):
        H.best_first_tree(df.limit(0))


def one_split(x, g, h, lam, least):
    best = None
    order = np.argsort(x)
    for k in range(1, len(x)):
        if x[order[k]] > x[order[k - 1]]:
            left, right = order[:k], order[k:]
            if min(h[left].sum(), h[right].sum()) >= least:
                score = lambda r: g[r].sum() ** 2 / (h[r].sum() + lam)
                gain = 0.5 * (score(left) + score(right) - score(order))
                if best is None or gain > best[0]:
                    best = gain, left, right
    return best


@pytest.mark.parametrize("objective", ["squared", "logistic"])
def test_one_boosted_split_by_hand(spark, objective):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(80, 1))
    y = (np.sin(2 * x[:, 0]) + x[:, 0] if objective == "squared" else (x[:, 0] + 0.5 * rng.normal(size=80) > 0.3)).astype(float)
    m = H.boosted_trees(frame(spark, x, y), objective=objective, n_estimators=1, max_depth=1, learning_rate=0.5, reg_lambda=2.0)
    base = np.log(y.mean() / (1 - y.mean())) if objective == "logistic" else y.mean()
    p = 1 / (1 + np.exp(-base)) if objective == "logistic" else base
    g, h = p - y, np.full(80, p * (1 - p) if objective == "logistic" else 1.0)
    gain, left, right = one_split(x[:, 0], g, h, 2.0, 1.0)
    assert abs(m.trees[0].tree.gain[0] - gain) < 1e-9
    want = np.full(80, base)
    for rows in (left, right):
        want[rows] -= 0.5 * g[rows].sum() / (h[rows].sum() + 2.0)
    assert np.allclose(m.margin(x)[:, 0], want)


def test_eval_set_stops_and_beats_first_order(spark):
    rng = np.random.default_rng(7)
    x = rng.random((3000, 5))
    y = 10 * np.sin(np.pi * x[:, 0] * x[:, 1]) + 20 * (x[:, 2] - 0.5) ** 2 + 10 * x[:, 3] + 5 * x[:, 4] + rng.normal(size=3000)
    train, held = frame(spark, x[:2000], y[:2000]), frame(spark, x[2000:], y[2000:])
    m = H.boosted_trees(train, eval_set=held, n_estimators=60, max_depth=3, learning_rate=0.9, early_stopping_rounds=4, max_bins=32)
    assert len(m.trees) == m.best_iteration + 1 == int(np.argmin(m.eval_losses)) + 1 < 60
    assert len(m.eval_losses) == m.best_iteration + 5
    own = ((m.margin(x[2000:])[:, 0] - y[2000:]) ** 2).mean()
    assert abs(own - m.eval_losses[m.best_iteration]) < 1e-6
    from pyspark.ml.functions import array_to_vector

    from quarry.operators import trees as TR
    vec = lambda d: d.withColumn("features", array_to_vector("features"))
    first = TR.gbt_regressor(max_iter=20, step_size=0.3, max_depth=3, labelCol="label", seed=1).fit(vec(train))
    err = np.mean([(r["prediction"] - r["label"]) ** 2 for r in first.transform(vec(held)).collect()])
    second = H.boosted_trees(train, n_estimators=20, max_depth=3, learning_rate=0.3, max_bins=256)
    assert ((second.margin(x[2000:])[:, 0] - y[2000:]) ** 2).mean() < err * 1.02


def test_extra_trees_draw_thresholds_and_learn(spark):
    from quarry.operators import randomtrees as R
    rng = np.random.default_rng(8)
    x = rng.normal(size=(600, 6))
    y = ((x[:, 0] > 0.2) * 1 + (x[:, 1] * x[:, 0] > 0.3)).astype(float)
    df = frame(spark, x, y)
    m = R.extra_trees(df, n_estimators=25, max_depth=7, seed=3)
    assert [t.feature for t in m.trees] == [t.feature for t in R.extra_trees(df.repartition(7), n_estimators=25, max_depth=7, seed=3).trees]
    assert len({c[0] for c in m.cuts}) == 25                    # each tree has thresholds of its own
    # the tree by hand: same draws, same rows
    for t in (0, 11):
        tree, rows = m.trees[t], {0: np.arange(600)}
        for node, f in enumerate(tree.feature):
            own = rows[node]
            share = np.bincount(y[own].astype(int), minlength=3) / len(own)
            assert np.allclose(m.shares[t][node], share)
            if f >= 0:
                tried, u = R.draws(3, t, node, 6, 2)
                low, high = x[own][:, tried].min(0), x[own][:, tried].max(0)
                cut = low + u * (high - low)
                k = tried.tolist().index(f)
                assert np.isclose(m.cuts[t][node], cut[k])
                gain = [impurity(y[own], "gini", 3) - sum(impurity(y[part], "gini", 3) for part in (
                    own[x[own, a] <= c], own[x[own, a] > c]) if len(part)) for a, c in zip(tried, cut)]
                assert gain[k] >= max(gain) - 1e-9
                rows[tree.left[node]], rows[tree.right[node]] = own[x[own, f] <= m.cuts[t][node]], own[x[own, f] > m.cuts[t][node]]
    imp = m.importances()
    assert abs(imp.sum() - 1) < 1e-9 and imp[:2].sum() > 0.5 and imp[:2].min() > imp[2:].max()
    got = m.transform(df).collect()
    assert np.mean([r["prediction"] == r["label"] for r in got]) > 0.85
    assert all(abs(sum(r["probability"]) - 1) < 1e-9 for r in got)
