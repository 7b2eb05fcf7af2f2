"""Hard negatives against brute force and DuckDB."""
import math

import duckdb
import numpy as np
import pytest
from llm_rows import SF

from quarry.llm import hard_negatives as H
from quarry.llm import queries
from quarry.llm.topk import beyond


def brute(rows, positives=5, negatives=10, scale=256, every=100):
    own = []
    for i, v, label in rows:
        if None not in (i, v, label) and all(x is not None and math.isfinite(x) for x in v):
            label = int(math.fmod(label + 1, 10)) if i % 7 == 0 else label
            own.append((i, label, tuple(math.floor(int(scale) * int(x)) if abs(x) > 2**60
                                        else math.floor(scale * x) for x in v)))
    short = lambda s: min(max(s, -2**63), 2**63 - 1)
    out = []
    for i, label, a in sorted(set(own)):
        if i % every:
            continue
        ranked = sorted((-sum(x * y for x, y in zip(a, b)), j, other) for j, other, b in own if j != i)
        for s, j, other in [r for r in ranked if r[2] == label][:positives]:
            fits = [(-t, k) for t, k, other in ranked if other != label and 30 * -s <= 100 * -t <= 90 * -s][:negatives]
            out += [(i, j, r + 1, k, short(-s), short(t)) for r, (t, k) in enumerate(fits)]
    return sorted(out)


def run(spark, rows, **how):
    df = spark.createDataFrame([(i, v, c, "x") for i, v, c in rows],
                               "vec_id long, embedding array<double>, label int, score string").repartition(5)
    return sorted(tuple(r) for r in H.mine_negatives(df, **how).collect())


@pytest.mark.parametrize("spread,dim,n", [(1.0, 6, 900), (3e4, 5, 400), (1e9, 3, 300), (1e30, 2, 250), (1e200, 2, 200)])
def test_equal_to_brute_force(spark, spread, dim, n):
    rng = np.random.default_rng(5)
    rows = [(int(i), (rng.normal(size=dim) * spread * (rng.random(dim) < 0.7)).tolist(), int(rng.integers(0, 4)))
            for i in range(-n // 4, n)]
    rows += [(300, None, 1), (None, [1.0] * dim, 1), (400, [None] * dim, 1), (500, [float("nan")] * dim, 1),
             (1000, [float("inf")] * dim, 1), (1001, [], 2), (1100, [spread], None), (1200, [spread], 2),
             (7, rows[8][1], 3), (100, rows[150][1], 1), (100, rows[150][1], 1), (1300, [0.0] * dim, 0)]
    assert run(spark, rows, row_block=70, anchor_block=2, window=16) == brute(rows)


def test_clustered_rows_with_ties_and_copies(spark):
    rng = np.random.default_rng(6)
    centres = rng.normal(size=(12, 8))
    rows = [(int(i), np.round(centres[i % 12] + 0.05 * rng.normal(size=8), 2).tolist(), int(i % 3)) for i in range(1500)]
    rows += [(2000 + i, centres[0].tolist(), 1) for i in range(400)]        # one large group of copies
    assert run(spark, rows, row_block=500) == brute(rows)


def test_small_tables(spark):
    assert run(spark, []) == []
    assert run(spark, [(0, [1.0], 1)]) == []
    assert run(spark, [(100, [1.0], 1), (1, [1.0], 1), (2, [0.5], 2)]) == [(100, 1, 1, 2, 65536, 32768)]
    assert run(spark, [(100, [1.0], 1), (1, [-1.0], 1), (2, [-0.5], 2)]) == []      # a negative score has no range
    assert run(spark, [(100, [1.0], 1), (1, [0.0], 1), (2, [0.0], 2)]) == [(100, 1, 1, 2, 0, 0)]


def test_query_equals_sql(spark):
    views = f"create view embeddings as select * from '{SF}/embeddings.parquet'"
    con = duckdb.connect()
    con.execute(views)
    want = sorted(con.execute(f"select anchor_id, positive_id, rank, negative_id, positive_score, negative_score "
                              f"from ({H.SQL})").fetchall())
    got = sorted(tuple(r) for r in queries.op11_hard_negatives(spark, SF).collect())
    assert got == want and got


def test_bounds_hold_every_score_and_skip_some():
    rng = np.random.default_rng(7)
    rows = np.floor(256 * np.concatenate([rng.normal(size=(300, 4)), rng.normal(size=(300, 4)) * 0.01 + 3]))
    refs = H.choose_directions(rows[::7], 6)
    norms, angles = H.norms_and_angles(rows, refs)
    block = H.Block(np.arange(600), np.arange(600) % 2, rows, norms, angles, 16)
    low, high = block.bounds(norms, angles)
    scores = rows @ block.rows.T
    for w, (a, b) in enumerate(zip(block.starts, block.ends)):
        assert (scores[:, a:b].min(axis=1) >= low[:, w]).all() and (scores[:, a:b].max(axis=1) <= high[:, w]).all()
    assert (high < 0).mean() > 0.02 and (np.abs(refs @ refs.T - np.eye(len(refs))) < 1).all()


def test_wide_scores_keep_their_value():
    for s in (0, 5, -5, 2**63 - 1, -2**63, 2**63, -2**63 - 1, 10**40, -10**40):
        assert H.whole_score(min(max(s, -2**63), 2**63 - 1), beyond(s)) == s
