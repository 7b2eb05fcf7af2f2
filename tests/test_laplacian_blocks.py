"""the matrix of c10b is packed in blocks once, its neighbours are searched once."""
import numpy as np

from quarry.operators import spectral as SP


def test_no_row_per_edge_moves_after_packing(spark, monkeypatch):
    rng = np.random.default_rng(4)
    n, counts, cut = 600, [], SP.cut_lineage

    def counted(df):
        out = cut(df)
        counts.append(out.count())
        return out
    monkeypatch.setattr(SP, "cut_lineage", counted)
    monkeypatch.setattr(SP, "BLOCK_ROWS", 100, raising=False)
    monkeypatch.setattr(SP, "CHUNK_ROWS", 37, raising=False)
    w = np.zeros((n, n))
    for i in range(n):
        for j in (i + 1, i + 7):
            w[i, j % n] = w[j % n, i] = rng.random() + 0.1
    edges = spark.createDataFrame([(int(i) * 3, int(j) * 3, float(w[i, j])) for i, j in zip(*np.nonzero(w))], "i long, j long, w double")
    root = np.sqrt(w.sum(1))
    values = np.linalg.eigvalsh(np.eye(n) - w / root[:, None] / root)
    got = SP.laplacian_embedding(edges.repartition(3), 4)
    assert np.allclose(got.eigenvalues, values[:4], atol=1e-7)
    assert counts[0] == 4 * n and max(counts[1:]) <= n          # a row per edge was joined in every product
    mine = {r["id"]: r["x"] for r in got.rows.collect()}
    x = np.stack([mine[3 * i] for i in range(n)]) * root[:, None]
    assert np.abs(x - w / root[:, None] / root @ x - x * got.eigenvalues).max() < 1e-3


def test_neighbours_are_searched_once(spark):
    rows = spark.createDataFrame([(i, [float(i), 0.0]) for i in range(20)], "id long, v array<double>")
    edges = SP.knn_affinity(rows, "id", "v", 3)
    assert edges._jdf.queryExecution().optimizedPlan().toString().count("FlatMapCoGroupsInPandas") == 1
    w = {(r["i"], r["j"]): r["w"] for r in edges.collect()}
    assert all(w[j, i] == x for (i, j), x in w.items())
