"""Neighbour searches hold bounded tables and send bounded copies."""
import tracemalloc

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.feature import BucketedRandomProjectionLSH
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from quarry.operators import cluster as C
from quarry.operators import joins as J
from quarry.operators import linkage as LK
from quarry.operators.graph import star_components, stars


def frame(spark, ids, x):
    return spark.createDataFrame([(int(i), [float(v) for v in a]) for i, a in zip(ids, x)], "id long, v array<double>").repartition(4)


def unit(n, dim, seed=5):
    x = np.random.default_rng(seed).normal(size=(n, dim))
    return x / np.sqrt((x * x).sum(1))[:, None]


def peak(fn, *args):
    tracemalloc.start()
    out = fn(*args)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    return out, most


@pytest.mark.parametrize("kind", ["nearest", "shortest"])
def test_copies_take_bounded_memory(kind):
    """All distances tie, so every pair is looked at; a task keeps some at a time."""
    n = 1200
    v = list(np.ones((n, 64)))
    q, b = pd.DataFrame({"qid": np.arange(n), "qv": v, "qc": np.arange(n)}), pd.DataFrame({"nid": np.arange(n), "bv": v, "bc": np.arange(n), "block": 0})
    out, most = peak(J._nearest(3, True) if kind == "nearest" else LK.shortest_edges, q, b)
    assert most < 500e6, most
    if kind == "nearest":
        assert len(out) == 3 * n and set(out["dist"]) == {0.0} and out[out.qid == 0]["nid"].tolist() == [1, 2, 3]
    else:
        assert len(out) == n and set(out["a"]) == {0}


def test_wide_radius_takes_bounded_memory():
    n = 1200
    x = list(unit(n, 64))
    q, b = pd.DataFrame({"qid": np.arange(n), "qv": x}), pd.DataFrame({"nid": np.arange(n), "bv": x})
    out, most = peak(J._within(2.1, False), q, b)
    assert len(out) == n * (n - 1) and most < 500e6, most


def test_blocks_that_skip_nothing_go_as_lots(spark):
    n, size, x = 2000, 25, unit(2000, 24)
    df, sent = frame(spark, range(n), x), {}
    got = {(r["qid"], r["rank"]): r["nid"] for r in J.knn_join(df, df, 4, "id", "v", block_rows=size, exclude_self=True, sent=sent).collect()}
    d = ((x[:, None] - x[None]) ** 2).sum(2)
    np.fill_diagonal(d, np.inf)
    want = np.argsort(d, axis=1)[:, :4]
    assert got == {(i, r + 1): int(want[i, r]) for i in range(n) for r in range(4)}
    assert sent["queries"] < 12 * n and sent["base"] < 12 * n, sent
    pairs = J.radius_join_blocked(df, "id", "v", 0.9, block_rows=size).collect()
    assert {(r["id_a"], r["id_b"]) for r in pairs} == {(int(i), int(j)) for i, j in zip(*np.nonzero(np.sqrt(d) <= 0.9))}


@pytest.mark.parametrize("eps,least,block_rows", [(0.35, 4, 32), (0.6, 6, 64), (9.0, 3, 32), (0.001, 2, 500)])
def test_dbscan_of_vectors_equals_brute_force(spark, monkeypatch, eps, least, block_rows):
    """No pair is written: the radius join is not asked."""
    from test_cells import brute
    monkeypatch.setattr(J, "radius_join_blocked", None)
    monkeypatch.setattr(C, "radius_join_blocked", None, raising=False)
    rng = np.random.default_rng(7)
    n = 400
    x, y, ids = rng.normal(size=n) + 3 * rng.integers(0, 3, n), rng.normal(size=n), rng.permutation(400) + 9
    got = C._vector_dbscan(frame(spark, ids, np.c_[x, y]), "id", eps, least, "v", block_rows)
    rows = {r["id"]: (r["comp"], r["is_core"]) for r in got.collect()}
    rank = {c: k for k, c in enumerate(sorted({c for c, _ in rows.values() if c is not None}))}
    assert {i: (rank.get(c, -1), core) for i, (c, core) in rows.items()} == brute(ids, x, y, eps, least)


@pytest.mark.parametrize("small", [1, 50, 10_000])
def test_components_finished_by_one_task(spark, small):
    rng = np.random.default_rng(8)
    a, b = rng.integers(0, 900, 700), rng.integers(0, 900, 700)
    node, least = stars(a, b)
    df = spark.createDataFrame(list(zip(a.tolist(), b.tolist())), "a long, b long").repartition(5)
    got = {r["id"]: r["comp"] for r in star_components(df, small=small).collect()}
    assert got == {r["id"]: r["comp"] for r in star_components(df).collect()}
    assert {i: c for i, c in got.items() if i != c} == dict(zip(node.tolist(), least.tolist()))


@pytest.mark.parametrize("length,tile", [(0.6, 4096), (0.6, 64), (0.05, 64)])
def test_lsh_pairs_equal_mllib(spark, length, tile):
    df = frame(spark, range(300), unit(300, 6))
    v = df.select("id", array_to_vector("v").alias("_v"))
    m = BucketedRandomProjectionLSH(inputCol="_v", outputCol="h", bucketLength=length, numHashTables=3, seed=42).fit(v)
    want = {(r["a"], r["b"]): r["dist"] for r in m.approxSimilarityJoin(v, v, 0.8, "dist").select(
        F.col("datasetA.id").alias("a"), F.col("datasetB.id").alias("b"), "dist").where("a <> b").collect()}
    pairs = J._lsh_pairs(df, df, "id", "v", 0.8, length, 3, 42, None, True, tile)
    rows = pairs.collect()
    assert len(rows) == len(want) and {(r["qid"], r["nid"]): r["dist"] for r in rows} == want
    assert "CoGroups" in pairs._jdf.queryExecution().toString()       # buckets meet in tiles, pairs are never joined
    near = J.knn_join_lsh(df, df, 2, "id", "v", 0.8, length, 3, exclude_self=True).collect()
    first = {}
    for (a, b), d in sorted(want.items(), key=lambda x: (x[0][0], x[1], x[0][1])):
        first.setdefault(a, []).append(b)
    assert {(r["qid"], r["rank"]): r["nid"] for r in near} == {(a, i + 1): b for a, bs in first.items() for i, b in enumerate(bs[:2])}


def test_documents_written_by_tasks(spark, tmp_path):
    """A file per document and no folder per document."""
    from quarry.sources.files import read_documents, write_documents
    rows = [(f"document-{i:05d}", ["en", "zh-tw", None, ""][i % 4], [None, "", "a\nb", "héllo"][i // 3 % 4]) for i in range(40)]
    df = spark.createDataFrame(rows, "fname string, lang string, text string").repartition(2)
    assert write_documents(df, f"file:{tmp_path}/docs", "lang", "fname", "text") == 40
    got = read_documents(spark, f"{tmp_path}/docs", min_name_len=5, label_from_dir=False).select(
        F.regexp_extract("path", r"lang=([a-z]+)", 1).alias("l"), F.regexp_extract("path", r"fname=([\w-]+)", 1).alias("n"),
        F.col("content").cast("string").alias("t"), "length").collect()
    want = [((lang or "").split("-")[0], n, (t or "") + "\n", len((t or "").encode()) + 1) for n, lang, t in rows]
    assert sorted(tuple(r) for r in got) == sorted(want)
    assert len(list((tmp_path / "docs").glob("*/*"))) <= 6
    assert write_documents(df.limit(0), f"file:{tmp_path}/none", "lang", "fname", "text") == 0
    assert read_documents(spark, f"{tmp_path}/none").collect() == []


def test_lsh_gives_equal_rows_once(spark):
    x = unit(60, 4)
    df = frame(spark, range(60), x)
    once, twice = (sorted(map(tuple, J._lsh_pairs(d, d, "id", "v", 0.9, 0.6, 3, 42, None, True).collect())) for d in (df, df.unionByName(df)))
    assert once == twice and once


def test_f11_documents_are_listed_by_tasks(spark, tmp_path):
    """No scan of one split per few files; hidden files are passed over; texts are read where they are asked for."""
    from quarry.sources.files import read_documents, write_documents
    df = spark.createDataFrame([(f"document-{i:03d}", "en", "x" * i) for i in range(30)], "fname string, lang string, text string").repartition(3)
    write_documents(df, f"{tmp_path}/docs", "lang", "fname", "text")
    for hidden in ("_index-of-all-documents", ".some-hidden-document"):
        (tmp_path / "docs" / hidden).write_text("no")
    docs = read_documents(spark, f"{tmp_path}/docs", min_name_len=5)
    plan = docs.select("path", "length")._jdf.queryExecution().executedPlan().toString()
    assert "FileScan" not in plan and "EvalPython" not in plan
    want = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(f"{tmp_path}/docs")
    assert sorted(map(tuple, docs.select("path", "length", "content").collect())) == sorted(
        map(tuple, want.select("path", "length", "content").collect())) and docs.count() == 30


def test_f10_f4_f2_radius_and_lsh_joins_send_rows_to_few_tiles(spark, monkeypatch):
    """Buckets that hold more pairs than the table are not dealt once per hash table, and
    a tile stands for its mirror: fewer copies of a row, the same pairs."""
    x = unit(600, 6)
    df = frame(spark, range(600), x)
    model = J._lsh(1.0, 6, 42).fit(df.select(array_to_vector("v").alias("_v")))
    asked, held = J._dealt(J._hashed(model, df, "id", "v", "q", 6), None, 6, 100, 0.8, None)
    assert asked.count() + held.count() <= 600 * 7                  # 6 tiles a side: 6 copies and the tile itself
    assert {r["t"] for r in asked.select("t").distinct().collect()} == {6}
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(2))
    h = np.stack([r["h"] for r in sorted(J._hashed(model, df, "id", "v", "q", 6).collect(), key=lambda r: r["qid"])])
    want = {(i, j) for i, j in zip(*np.nonzero((h[:, None] == h[None]).any(2) & (d < 0.8))) if i != j}
    got = [(r["qid"], r["nid"]) for r in J._lsh_pairs(df, df, "id", "v", 0.8, 1.0, 6, 42, None, True, 100).collect()]
    assert len(got) == len(set(got)) and set(got) == want
    plan = J.radius_join_blocked(df, "id", "v", 0.8, block_rows=32)
    assert "CoGroups" not in plan._jdf.queryExecution().toString()      # pairs leave as they are found


@pytest.mark.parametrize("scale,shift", [(1.0, 0.0), (1.0, 1e5), (1e-14, 0.0), (1e16, 0.0), (1e200, 0.0)])
def test_products_miss_no_pair(scale, shift):
    """Tables in single precision are only a sieve: neighbours equal brute force far from zero and at any size."""
    from quarry.operators.pivots import Products, nearest_rows, pairs_near
    x = unit(300, 5) * scale + shift
    with np.errstate(over="ignore"):
        d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(2))
    if not np.isfinite(d).all():
        return
    eps = 0.7 * scale
    got = {(i, j) for r, c in pairs_near(x, Products(x), eps * eps) for i, j in zip(r, c) if d[i, j] <= eps}
    assert got == {(i, j) for i, j in zip(*np.nonzero(d <= eps))}
    ids = np.arange(300)
    r, c, far = nearest_rows(x, ids, x, ids, 3, exclude_self=True)
    e = d + np.where(np.eye(300) > 0, np.inf, 0)
    assert c.reshape(300, 3).tolist() == np.argsort(e, axis=1, kind="stable")[:, :3].tolist()


def test_f9_rows_that_are_core_at_home_are_not_asked_again(spark, monkeypatch):
    asked, send = [], C.send
    monkeypatch.setattr(C, "send", lambda q, *a, **k: asked.append(q.count()) or send(q, *a, **k))
    x = np.repeat(np.array([[0.0, 0], [9, 9]]), 300, axis=0) + 0.01 * unit(600, 2)
    got = C._vector_dbscan(frame(spark, range(600), x), "id", 1.0, 5, "v", 64).collect()
    assert {(r["id"] // 300, r["comp"], r["is_core"]) for r in got} == {(0, 0, True), (1, 300, True)}
    assert asked[0] == 0, asked                                     # before: all 600


def test_f3_f6_f7_all_pairs_meet_once(spark, monkeypatch):
    """Later rounds take their edges from the lists; a search asks for few rows."""
    asked, send = [], LK.send
    monkeypatch.setattr(LK, "send", lambda q, *a, **k: asked.append(q.count()) or send(q, *a, **k))
    rng = np.random.default_rng(3)
    n = 400
    tree = LK.spanning_tree(frame(spark, range(n), rng.normal(size=(n, 6))), "id", "v", 32).collect()
    assert len(tree) == n - 1 and sum(asked) < n, asked             # before: every row twice a round
