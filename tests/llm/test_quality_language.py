"""Quality trees and the language chain."""
import itertools
import zlib

import numpy as np
import pyarrow as pa
import pytest
from llm_rows import ODD, SF

from quarry.llm import queries
from quarry.llm.language import Field, fit_language, predict_language, train
from quarry.llm.quality import (Trees, fit_quality, grow_trees, keep_quality, score_quality, statistics)

MID = "/root/testdata/sf0.01"


def crc(i):
    return zlib.crc32(str(i).encode())


# ------------------------------------------------------------------ quality
def walk(trees, x):
    """One row through one tree after the other."""
    raw = trees.prior
    for f, t, v in zip(trees.feature, trees.threshold, trees.value):
        node = 0
        while node < len(f):
            node = 2 * node + 1 + int(x[f[node]] > t[node])
        raw += v[node - len(f)]
    return 1 / (1 + np.exp(-raw))


def test_trees_learn_and_walk_alike():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(600, 5))
    y = ((x[:, 1] > 0.3) ^ (x[:, 3] > 0)).astype(float)
    trees = grow_trees(x, y, rounds=25, depth=3)
    got = trees.scores(x)
    assert np.allclose(got, [walk(trees, r) for r in x])
    assert ((got > 0.5) == y).mean() > 0.95
    assert len(trees.scores(x[:0])) == 0


@pytest.mark.parametrize("y", [[], [1, 1, 1], [0, 0]])
def test_trees_without_two_classes(y):
    trees = grow_trees(np.zeros((len(y), 2)), np.array(y, float))
    score = trees.scores(np.zeros((1, 2)))[0]
    assert score == 0.5 if not y else (score > 0.5) == bool(y[0])


def test_statistics_by_hand():
    x = statistics(pa.array(["a a a b\na a", "", "ÄB!!"]))
    again = statistics(pa.array(["zz", "a a a b\na a", "", "ÄB!!"]).slice(1))
    assert np.allclose(x, again) and np.isfinite(x).all() and not x[1][:24].any()
    assert x[0][1] == pytest.approx(np.log1p(6))           # words
    assert x[0][11] == pytest.approx(2 / 6)                # distinct words
    assert x[0][12] == pytest.approx(5 / 6)                # most frequent word
    assert x[0][14] == pytest.approx(3 / 6)                # equal to the word before
    assert x[2][10] == pytest.approx(1 / 4)                # doubled mark


def test_quality_query_held_out(spark):
    import duckdb
    label = dict(duckdb.sql(f"select doc_id, quality from '{MID}/labels.parquet' where quality is not null").fetchall())
    rows = queries.op1_quality(spark, MID).collect()
    assert len(rows) == duckdb.sql(f"select count(*) from '{MID}/documents.parquet'").fetchall()[0][0]
    for r in rows:
        assert r["held_out"] == (crc(r["doc_id"]) % 5 == 0) and 0 <= r["score"] <= 1
        assert r["predicted"] == int(r["score"] >= 0.3)
    held = [(r["predicted"], label[r["doc_id"]]) for r in rows if r["held_out"] and r["doc_id"] in label]
    assert len(held) > 30 and np.mean([p == q for p, q in held]) > 0.95


def test_quality_odd_rows(spark, odd, frame):
    labels = spark.createDataFrame(
        [(1, 1), (1, 0), (7, 1), (8, 0), (9, 0), (None, 1), (3, None), (3, 0), (6, 1), (6, 1)],
        "doc_id long, quality int")
    trees = fit_quality(odd, labels)
    got = score_quality(odd, trees).collect()
    assert len(got) == len(ODD) and all(0 <= r["score"] <= 1 for r in got)
    assert len({r["score"] for r in got if r["doc_id"] in (2, 3)}) == 1      # null and empty alike
    one = {r["doc_id"]: r["score"] for r in got}
    kept = keep_quality(odd, trees, 0.5)
    assert kept.columns == odd.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(
        str(r["doc_id"]) for r in got if r["score"] >= 0.5)
    assert one[6] == one[1]                                                    # equal texts
    assert [r["score"] for r in score_quality(odd, fit_quality(odd, labels.limit(0))).collect()] == [0.5] * len(ODD)
    assert score_quality(frame([]), trees).collect() == [] == keep_quality(frame([]), trees).collect()


def test_held_out_rows_teach_nothing(spark, odd, frame):
    docs = frame([(i, f"text {i} " + ("!! " if i % 2 else "of words ") * 20) for i in range(200)])
    flip = spark.createDataFrame([(i, i % 2 if crc(i) % 5 else 1 - i % 2) for i in range(200)], "doc_id long, quality int")
    same = spark.createDataFrame([(i, i % 2) for i in range(200)], "doc_id long, quality int")
    a, b = fit_quality(docs, flip), fit_quality(docs, same)
    assert np.array_equal(a.feature, b.feature) and np.array_equal(a.value, b.value)


# ----------------------------------------------------------------- language
def brute_marginals(field, evidence, first):
    """Sums over all label sequences, text by text."""
    k, out = evidence.shape[1], np.zeros_like(evidence)
    starts = [*np.flatnonzero(first), len(first)]
    for a, b in itertools.pairwise(starts):
        total = 0
        part = np.zeros((b - a, k))
        for seq in itertools.product(range(k), repeat=b - a):
            s = field.start[seq[0]] + sum(evidence[a + i, y] for i, y in enumerate(seq))
            s += sum(field.moves[x, y] for x, y in itertools.pairwise(seq))
            w = np.exp(s)
            total += w
            for i, y in enumerate(seq):
                part[i, y] += w
        out[a:b] = part / total
    return out


@pytest.mark.parametrize("block", [1, 2, 3, 5, 64])
def test_forward_backward(block):
    rng = np.random.default_rng(5)
    field = Field(["a", "b", "c"], None, None, None, np.log([0.2, 0.5, 0.3]),
                  np.log(rng.dirichlet(np.ones(3), 3)))
    evidence = rng.normal(size=(13, 3))
    first = np.zeros(13, bool)
    first[[0, 1, 6]] = True
    got, ahead = field.marginals(evidence, first, block)
    assert np.allclose(got, brute_marginals(field, evidence, first))
    inner = np.flatnonzero(~first)           # chances given the word before agree with the chances
    both = np.exp(field.moves)[None] * ahead[inner][:, None, :]
    both *= got[inner - 1][:, :, None] / both.sum(2, keepdims=True)
    assert np.allclose(both.sum(1), got[inner])


def test_switching_text():
    texts = ["the and of to in that it is was for on are with as his they be at one have this"] * 30 + \
            ["der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als"] * 30
    field = train(texts, ["en"] * 30 + ["de"] * 30, epochs=8)
    lang, score = field.predict(pa.array(["the and of der die und von zu das mit nicht", "und", "", "12 !", None, "the"]))
    assert lang == ["de", "de", "und", "und", "und", "en"]
    assert score[2] == score[3] == score[4] == 0 and 0.5 < score[0] < 0.95 < score[5] <= 1


def test_language_query_held_out(spark):
    import duckdb
    lang = dict(duckdb.sql(f"select doc_id, lang from '{MID}/documents.parquet'").fetchall())
    rows = queries.op10_language(spark, MID).collect()
    assert len(rows) == len(lang)
    assert all(r["held_out"] == (crc(r["doc_id"]) % 4 == 2) and 0 <= r["score"] <= 1 for r in rows)
    assert np.mean([r["lang_pred"] == lang[r["doc_id"]] for r in rows if r["held_out"]]) > 0.97


def test_language_odd_rows(spark, odd, frame):
    field = fit_language(odd)
    got = predict_language(odd, field).collect()
    assert len(got) == len(ODD)
    for r in got:
        assert (r["lang_pred"] == "und") == (r["doc_id"] in (2, 3, 4, 5)) and 0 <= r["score"] <= 1
    none = fit_language(frame([]))
    assert {r["lang_pred"] for r in predict_language(odd, none).collect()} == {"und"}
    assert predict_language(frame([]), field).collect() == []


def test_trees_type():
    assert Trees(0.0, np.zeros((0, 3), int), np.zeros((0, 3)), np.zeros((0, 4))).scores(np.zeros((2, 1))).tolist() == [0.5] * 2


def test_small_query_runs(spark):
    assert queries.op1_quality(spark, SF).count() == queries.op10_language(spark, SF).count() >= 200


def test_every_language_is_learnt(spark):
    rng = np.random.default_rng(4)
    names = [f"l{i:04d}" for i in range(520)]
    rows = []
    for i, name in enumerate(names):
        letters = [chr(0x4e00 + 7 * i + j) for j in range(7)]
        for _ in range(3 if i % 50 else 20):
            rows.append((len(rows), " ".join("".join(rng.choice(letters, 3)) for _ in range(6)), name))
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)
    field = fit_language(df, max_train_rows=300)
    assert field.languages == sorted({n for i, _, n in rows if zlib.crc32(str(i).encode()) % 4 != 2})
    assert len(field.languages) > 512 and field.weights.size <= 1 << 25
    pred = {r["doc_id"]: r["lang_pred"] for r in predict_language(df.limit(400), field).collect()}
    assert np.mean([pred[i] == n for i, _, n in rows if i in pred]) > 0.9


def test_texts_side_by_side_equal_blocks():
    rng = np.random.default_rng(5)
    k = 5
    moves = np.log(rng.dirichlet(np.ones(k), k))
    field = Field([f"l{i}" for i in range(k)], np.zeros((16, k)), np.zeros(0, np.uint64), np.zeros((0, k)),
                  np.log(rng.dirichlet(np.ones(k))), moves)
    first = rng.random(300) < 0.1
    first[0] = True
    evidence = rng.normal(size=(300, k))
    a, b = field.marginals(evidence, first), field.by_texts(evidence, first)
    assert np.allclose(a[0], b[0], atol=1e-9)
    for x, y in ((a[1], b[1]),):
        assert np.allclose(x / x.sum(1, keepdims=True), y / y.sum(1, keepdims=True), atol=1e-9)
