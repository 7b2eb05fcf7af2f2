"""Pruned neighbour joins against brute force."""
import numpy as np
import pytest

from quarry.operators import joins as J


def frame(spark, rows):
    return spark.createDataFrame([(int(i), [float(x) for x in v]) for i, v in rows], "id long, v array<double>").repartition(4)


def brute(queries, base, k, exclude_self=False):
    out = []
    for i, a in queries:
        d = sorted((float(np.sqrt(((a - b) ** 2).sum())), j) for j, b in base if not (exclude_self and i == j))
        out += [(i, j, r + 1, round(x, 9)) for r, (x, j) in enumerate(d[:k])]
    return sorted(out)


def planted(n, dim, groups, seed=1):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(groups, dim)) * 10
    return [(i, centres[i % groups] + rng.normal(size=dim)) for i in range(n)]


@pytest.mark.parametrize("kind", ["planted", "uniform", "ties", "copies"])
def test_knn_equals_brute_force(spark, kind):
    rng = np.random.default_rng(2)
    if kind == "planted":
        rows = planted(900, 5, 8)
    elif kind == "uniform":
        rows = [(i, rng.random(6)) for i in range(500)]
    elif kind == "ties":
        rows = [(i, rng.integers(0, 4, 3).astype(float)) for i in range(500)]
    else:
        rows = [(i, np.ones(3)) for i in range(400)] + [(400 + i, rng.random(3)) for i in range(100)]
    got = J.knn_join(frame(spark, rows[::3]), frame(spark, rows), 4, "id", "v", block_rows=32, exclude_self=True).collect()
    assert sorted((r["qid"], r["nid"], r["rank"], round(r["dist"], 9)) for r in got) == brute(rows[::3], rows, 4, True)


def test_blocks_smaller_than_k_and_empty(spark):
    rows = planted(60, 3, 30)
    got = J.knn_join(frame(spark, rows), frame(spark, rows), 20, "id", "v", block_rows=5).collect()
    assert sorted((r["qid"], r["nid"], r["rank"], round(r["dist"], 9)) for r in got) == brute(rows, rows, 20)
    none = spark.createDataFrame([], "id long, v array<double>")
    assert J.knn_join(none, frame(spark, rows), 3, "id", "v", block_rows=5).collect() == []
    assert J.knn_join(frame(spark, rows), none, 3, "id", "v").collect() == []


@pytest.mark.parametrize("eps", [0.5, 2.0, 50.0])
def test_radius_equals_brute_force(spark, eps):
    rows = planted(400, 4, 6) + [(400 + i, np.zeros(4)) for i in range(60)]
    want = {(i, j) for i, a in rows for j, b in rows if i != j and np.sqrt(((a - b) ** 2).sum()) <= eps}
    got = [(r["id_a"], r["id_b"]) for r in J.radius_join_blocked(frame(spark, rows), "id", "v", eps, block_rows=32).collect()]
    assert len(got) == len(set(got)) and set(got) == want


def test_grouped_rows_are_sent_to_few_blocks(spark):
    """Fewer rows travel than with all pairs of blocks (each side copied once per block of the other)."""
    n, size = 6000, 100
    df = frame(spark, planted(n, 8, 40))
    for sent, out in (({}, lambda s: J.knn_join(df, df, 5, "id", "v", block_rows=size, sent=s)),
                      ({}, lambda s: J.radius_join_blocked(df, "id", "v", 2.0, block_rows=size, sent=s))):
        out(sent).count()
        every = 2 * n * (n // size)
        assert sent["queries"] + sent["base"] < every / 4, sent
