"""Substring dedup against brute force."""
import hashlib
import random
import re

import duckdb
import numpy as np
import pytest
from llm_rows import LONG, ODD, SF

from quarry.llm import queries
from quarry.llm.substrings import drop_repeated
from quarry.llm.word_spans import BLANK, Hasher, cuts, flags, window_hashes

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, size=13):
    """(id, words, removed words, kept words) of each row."""
    after = 2**63
    words = [WORD.findall(t or "") for _, t in rows]
    ids = [after if i is None else i for i, _ in rows]
    least = {}
    for i, own in zip(ids, words):
        for k in range(len(own) - size + 1):
            w = tuple(own[k:k + size])
            least[w] = min(least.get(w, after), i)
    out = []
    for (i, _), at, own in zip(rows, ids, words):
        gone = {x for k in range(len(own) - size + 1) if least[tuple(own[k:k + size])] < at
                for x in range(k, k + size)}
        out.append((i, len(own), len(gone), " ".join(w for x, w in enumerate(own) if x not in gone)))
    return sorted(out, key=order)


def order(row):
    return row[0] is None, row[0] or 0, row[1:]


def found(df, **how):
    return sorted((tuple(r) for r in drop_repeated(df, **how)
                   .select("doc_id", "n_words", "n_removed", "text").collect()), key=order)


def test_given_table(spark):
    rows = duckdb.sql(f"select doc_id, text from '{SF}/documents.parquet'").fetchall()
    want = brute(rows)
    got = sorted((tuple(r) for r in queries.op13_substring_dedup(spark, SF).collect()), key=order)
    assert got == [(i, n, r, hashlib.sha256(t.encode()).hexdigest()) for i, n, r, t in want]
    assert sum(r for _, _, r, _ in want) > 500


@pytest.mark.parametrize("size,slice_bytes,range_bytes", [(1, 200, 150), (3, 1 << 10, 1 << 9), (13, 1 << 20, 1 << 20)])
def test_made_up_passages(spark, size, slice_bytes, range_bytes):
    rng = random.Random(size)
    parts = [" ".join(rng.choice("abcdé日") * rng.randint(1, 2) for _ in range(rng.randint(1, 30))) for _ in range(12)]
    rows = [(rng.choice([None, *range(-9, 60)]), rng.choice([" ", "\n", "\t \r"]).join(rng.choices(parts, k=rng.randint(0, 5))))
            for _ in range(150)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    assert found(df, size=size, slice_bytes=slice_bytes, range_bytes=range_bytes) == brute(rows, size)


def test_odd_rows(odd, spark):
    rows = ODD + [(11, LONG), (12, "x" * 5_000_000 + " " + LONG), (12, LONG + " end")]
    extra = spark.createDataFrame(rows[len(ODD):], "doc_id long, text string")
    df = odd.unionByName(extra, allowMissingColumns=True).withColumn("n_words", odd["score"])
    out = drop_repeated(df)
    assert set(out.columns) == {*df.columns, "n_removed", "removed"}
    assert found(df, slice_bytes=1 << 19) == brute(rows)
    by = {(r["doc_id"], r["n_words"]): r["removed"] for r in out.collect()}
    n = len(LONG.split())
    assert by[(11, n)] == f"0:{n}" and by[(12, n + 1)] == f"0:{n}"
    assert drop_repeated(df.limit(0)).collect() == []
    with pytest.raises(TypeError):
        drop_repeated(spark.createDataFrame([("a", "b")], "doc_id string, text string"))


def test_hot_passage_and_copies(spark):
    passage = " ".join(f"w{i}" for i in range(40))
    rows = [(i, f"own{i} " + passage + f" tail{i}") for i in range(600)] + [(i, passage) for i in range(600, 1200)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(9)
    assert found(df, slice_bytes=4000) == brute(rows)


def test_words_and_hashes_do_not_depend_on_chunks():
    rng = random.Random(1)
    texts = ["".join(rng.choice("ab \n") for _ in range(rng.randint(0, 60))) for _ in range(50)] + ["c" * 300]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    offsets = np.cumsum([0, *map(len, texts)])
    whole = Hasher().words(data, offsets)
    small = Hasher(chunk=7).words(data, offsets)
    assert all((a == b).all() for a, b in zip(whole, small))
    assert list(cuts(data, offsets, flags(BLANK), 7))[-1][1] == len(data)
    words = [w for t in texts for w in WORD.findall(t)]
    assert [bytes(data[a:b]).decode() for a, b in zip(*whole[:2])] == words
    same = {}
    for w, h in zip(words, whole[2].tolist()):
        assert same.setdefault(w, h) == h
    assert len(set(same.values())) == len(same)
    one = window_hashes(whole[2], 3)
    windows = {}
    for k, h in enumerate(one.tolist()):
        assert windows.setdefault(tuple(words[k:k + 3]), h) == h
    assert len(set(windows.values())) == len(windows)
