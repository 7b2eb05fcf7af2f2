"""Phrase collocations against brute force."""
import random
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from llm_rows import ODD, SF

from quarry.llm import collocations as C
from quarry.llm import queries

UPPER = {c: c + 32 for c in range(65, 91)}


def brute(rows, least=100, top=2000, absorb=100):
    words, f = Counter(), defaultdict(Counter)
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(UPPER)):
            own = re.findall(r"[^\x20\x09]+", piece)
            words[lang] += len(own)
            for k in range(1, 6):
                f[lang].update(tuple(own[i:i + k]) for i in range(len(own) - k + 1))
    out = []
    for lang, count in f.items():
        n, found = words[lang], []
        frequent = {p: a for p, a in count.items() if len(p) > 1 and a >= least}
        gone = {p[i:j] for p, a in frequent.items() for i in range(len(p)) for j in range(i + 2, len(p) + 1)
                if j - i < len(p) and 100 * a >= absorb * frequent[p[i:j]]}
        for p, a in frequent.items():
            if p not in gone:
                s, k = min((1000 * a * n // (count[p[:k]] * count[p[k:]]), k) for k in range(1, len(p)))
                found.append((-s, -a, " ".join(p).encode(), a, count[p[:k]], count[p[k:]]))
        out += [(lang, i + 1, p.decode(), a, x, y, n, -s) for i, (s, _, p, a, x, y) in enumerate(sorted(found)[:top])]
    return sorted(out)


def run(spark, rows, parts=5, **how):
    df = spark.createDataFrame([(*r, "x") for r in rows], "lang string, text string, score string").repartition(parts)
    return sorted(tuple(r) for r in C.collocations(df, **how).collect())


@pytest.mark.parametrize("least,top,absorb,slice_bytes,range_words", [
    (3, 2000, 100, 1 << 10, 500), (2, 40, 60, 1 << 9, 90), (5, 7, 100, 1 << 20, 10**6), (1, 10**6, 100, 1 << 12, 300)])
def test_made_up_texts(spark, least, top, absorb, slice_bytes, range_words):
    rng = random.Random(least)
    vocabulary = [rng.choice("abcdefgABé日\x01") * rng.randint(1, 3) + rng.choice(["", "x", "\x01"]) for _ in range(25)]
    fixed = [" ".join(rng.choices(vocabulary, k=7)) for _ in range(4)]

    def text():
        parts = [rng.choice(fixed) if rng.random() < 0.3 else rng.choice(vocabulary) for _ in range(rng.randint(0, 60))]
        return "".join(p + rng.choice([" ", "  ", "\t", " ", " ", ". ", "\n", ",", "\x0b"]) for p in parts)
    rows = [(rng.choice([None, "en", "en", "en", "de", "EN", ""]), text()) for _ in range(120)]
    rows += [("en", fixed[0])] * 60 + [("en", None), (None, None), ("fr", "")]      # one hot pair of words
    assert run(spark, rows, least=least, top=top, absorb=absorb, slice_bytes=slice_bytes,
               range_words=range_words) == brute(rows, least, top, absorb)


def test_given_table(spark):
    rows = duckdb.sql(f"select lang, text from '{SF}/documents.parquet'").fetchall()
    assert sorted(tuple(r) for r in queries.op12_collocations(spark, SF).collect()) == brute(rows)
    assert run(spark, rows, least=10, range_words=2000) == brute(rows, 10)


def test_odd_rows_and_empty(spark):
    rows = [(None if (i or 0) % 2 else "en", t) for i, t in ODD]
    got = run(spark, rows, least=1, top=10**6)
    assert got == brute(rows, 1, 10**6)
    assert run(spark, [], parts=1) == [] and run(spark, [("en", "one word")]) == []


def test_codes_do_not_depend_on_chunks():
    rng = random.Random(2)
    texts = ["".join(rng.choice("abC .,\n\t") for _ in range(rng.randint(0, 30))) for _ in range(60)] + ["d" * 99]
    whole = C.word_codes(pa.array(texts, pa.large_string()))
    small = C.word_codes(pa.array(texts, pa.large_string()), chunk=5)
    name = lambda w, c: [w[int(x) - 1].as_py() if x else None for x in c]
    want = []
    for t in texts:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", t.translate(UPPER)):
            own = re.findall(r"[^\x20\x09]+", piece)
            want += ([None] if want and own else []) + own
    assert name(whole[0], whole[2]) == name(small[0], small[2]) == want


def test_codes_never_fall_and_products_are_exact():
    rng = np.random.default_rng(1)
    count = rng.integers(1, 1000, 40)
    before = np.cumsum(count) - count
    whole = lambda x: np.concatenate(([0.0], x / count.sum()))
    inner = lambda x: np.concatenate(([0.0], 0.1 + 0.9 * (x / count.sum())))
    upto = inner(before + count)
    upto[0] = 0.1
    columns, _ = C.records(rng.integers(0, 41, 20000))
    x = C.code_points(columns, whole(before), whole(before + count), inner(before), upto)
    assert (np.diff(x) >= 0).all() and 0 <= x.min() and x.max() <= 1
    big = 10**15
    assert C.scores([big], [10**18], [[big + 1, 0, 0, 0]], [[big + 3, 0, 0, 0]]) == (
        [1000 * big * 10**18 // ((big + 1) * (big + 3))], [big + 1], [big + 3])
