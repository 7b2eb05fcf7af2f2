"""Top-k, secrets and decontamination against brute force."""
import base64
import bz2
import gzip
import hashlib
import random
import re
import urllib.parse
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest
from llm_rows import ODD, SF

from quarry.llm import queries, secrets
from quarry.llm.decontaminate import (Matcher, char_masks, distance, drop_contaminated, find_passages, normal)
from quarry.llm.topk import exact_top_k


# -------------------------------------------------------------------- top-k
def brute_top(rows, k, scale=256):
    import math
    own = []
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            own.append((i, tuple(math.floor(scale * x) for x in v)))
    out = []
    for i, q in sorted(set(own)):
        if i % 50 == 0:
            best = sorted((-sum(a * b for a, b in zip(q, c)), j) for j, c in own if j != i)[:k]
            out += [(i, r + 1, j, min(max(-s, -2**63), 2**63 - 1)) for r, (s, j) in enumerate(best)]
    return sorted(out)


@pytest.mark.parametrize("spread,dim", [(1.0, 6), (3e4, 5), (1e9, 3), (1e30, 2)])
def test_top_k_is_exact(spark, spread, dim):
    rng = np.random.default_rng(3)
    rows = [(int(i), (rng.normal(size=dim) * spread * (rng.random(dim) < 0.6)).tolist()) for i in range(-50, 260)]
    rows += [(300, None), (None, [1.0] * dim), (350, [None] * dim), (400, [float("nan")] * dim),
             (401, [float("inf")] * dim), (450, []), (451, [2.0]), (7, rows[8][1]), (100, rows[150][1])]
    df = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<double>, score string")
    got = sorted(tuple(r) for r in exact_top_k(df, query_block=3, row_block=40).collect())
    assert got == brute_top(rows, 5)


def test_top_k_ties_and_small(spark):
    schema = "vec_id long, embedding array<float>"
    df = spark.createDataFrame([(i, [1.0, 0.5]) for i in range(60)], schema)
    got = exact_top_k(df).collect()
    assert [r["vec_id"] for r in sorted(got, key=lambda r: (r["query_id"], r["rank"]))] == [1, 2, 3, 4, 5, 0, 1, 2, 3, 4]
    assert exact_top_k(spark.createDataFrame([], schema)).collect() == []
    assert exact_top_k(spark.createDataFrame([(0, [1.0])], schema)).collect() == []
    assert len(exact_top_k(spark.createDataFrame([(0, [1.0]), (1, [-1.0])], schema)).collect()) == 1


# ------------------------------------------------------------------ secrets
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def naive(t):
    out = [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(t) if len(m[2]) >= 6]
    out += [(m.start(), m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 20]
    out += [(m.start(), m.end(), "hex") for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 24]
    return sorted(out, key=secrets.order)


def spans(text):
    base = sorted(secrets.base_spans(text), key=secrets.order)
    return [f"{k}:{s}:{e}" for s, e, k in secrets.all_spans(text, base, 1 << 20)]


def test_base_spans():
    rng = random.Random(3)
    bits = ["AKIA", "AKIA", "a", "f0", "0123456789abcdef", "token", "=", ":", " ", '"', "ABCDEFGHIJKLMNOP", "Token",
            "é", "api_key", "zz99zz9", "ſecret", "toKen"]
    for _ in range(20_000):
        t = "".join(rng.choices(bits, k=rng.randint(1, 12)))
        assert naive(t) == sorted(secrets.base_spans(t), key=secrets.order)
        if naive(t):
            assert pc.match_substring_regex(pa.array([t]), secrets.MAY_HOLD)[0].as_py()


PLAIN = "password=hunter22xyz"


def b64(x):
    return base64.b64encode(x if isinstance(x, bytes) else x.encode()).decode()


@pytest.mark.parametrize("hidden", [
    b64(PLAIN), b64(b64(PLAIN)), b64(gzip.compress(PLAIN.encode())), b64(zlib.compress(PLAIN.encode())),
    b64(bz2.compress(PLAIN.encode())), b64(gzip.compress(b64(PLAIN).encode())),
    "".join(f"%{c:02x}" for c in PLAIN.encode()), urllib.parse.quote(urllib.parse.quote(b64(PLAIN + "é"))),
    "".join(f"\\u{ord(c):04x}" for c in PLAIN), "pass\\x77ord\\u{3d}hunter22xyz", "password%3Dhunter22xyz",
    b64("".join(f"%{c:02x}" for c in PLAIN.encode())), base64.urlsafe_b64encode(b"\xc3\xbf>? " + PLAIN.encode()).decode()])
def test_layers_map_to_the_original(hidden):
    text = "é some words " + hidden + " and more"
    assert f"assign:13:{13 + len(hidden)}" in spans(text)
    assert spans("no secrets here, only words and numbers 123456") == []


def test_cycles_and_bombs_end():
    assert spans("%25" * 50 + "41") == []
    bomb = b64(gzip.compress(b"0" * 5_000_000))
    assert secrets.all_spans(bomb, [], 1 << 20) == [(0, len(bomb), "hex")]
    assert spans("password=abcdef12 " + b64("x")) == ["assign:0:17"]
    secrets.all_spans("\\ud83d\\ude00 \\ud83d %ff%fe " * 20, [], 1 << 20)


def test_secret_query(spark, odd, frame, sample):
    rows = {r["doc_id"]: r for r in queries.op4_secrets(spark, SF).collect()}
    assert len(rows) == len(sample)
    for i, t, _ in sample:
        base = naive(t)
        assert [rows[i][f"n_{k}"] for k in secrets.KINDS] == [sum(s[2] == k for s in base) for k in secrets.KINDS]
        assert rows[i]["base_sha256"] == hashlib.sha256(secrets.joined(base).encode()).hexdigest()
        assert set(secrets.joined(base).split(",")) <= set(rows[i]["spans"].split(","))
    got = secrets.scan_secrets(odd).collect()
    assert len(got) == len(ODD) and {r["spans"] for r in got} == {""}
    assert secrets.scan_secrets(frame([])).collect() == []


# ----------------------------------------------------------- decontamination
def edit(p, t):
    prev = [0] * (len(t) + 1)
    for i, c in enumerate(p, 1):
        cur = [i]
        for j, d in enumerate(t, 1):
            cur.append(min(prev[j] + 1, cur[-1] + 1, prev[j - 1] + (c != d)))
        prev = cur
    return min(prev)


def test_distance():
    rng = random.Random(1)
    for _ in range(600):
        p, t = ("".join(rng.choices("abc", k=rng.randint(lo, 12))) for lo in (1, 0))
        want = edit(p, t)
        assert distance(char_masks(p), len(p), t, len(p))[0] == want
        assert (distance(char_masks(p), len(p), t, 2)[0] <= 2) == (want <= 2)


@pytest.mark.parametrize("seed", range(6))
def test_passages_are_all_found(seed):
    rng = random.Random(seed)
    for _ in range(120):
        item = " ".join("".join(rng.choices("abc", k=rng.randint(1, 4))) for _ in range(rng.randint(5, 12)))
        s = list(item)
        for _ in range(rng.randint(0, 5)):
            p = rng.randrange(len(s))
            s[p:p + rng.randint(0, 1)] = rng.choice(["", "a", "c", " "])
        side = lambda: " ".join(rng.choices(["ab", "c", "ba", "aab"], k=rng.randint(0, 8)))  # noqa: B023, E731
        text = normal(side() + " " + "".join(s) + " " + side())
        want, k = edit(item, text), int(0.12 * len(item))
        got = Matcher([(1, item)], 0.12, 5).passages(text)
        assert bool(got) == (want <= k)
        if got:
            assert got[0][0] == want and edit(item, text[got[0][1]:got[0][2]]) <= want


def test_documents_and_blocks(spark, odd, frame):
    items = spark.createDataFrame([(1, "The quick brown fox jumps over the lazy dog again"), (2, None), (3, "too short"),
                                   (4, "the quick brown fox jumps over the lazy dog again"), (5, "")], "item_id long, text string")
    docs = frame([*ODD, (20, "xx: THE quick, brown fox -- jumps over the lazy dog, again!"), (21, "the quick brown cat"),
                  (22, "a the quick brown fxo jumps over the lazy dog again b")])
    for block in (1 << 20, 30):
        got = sorted((r["doc_id"], r["item_id"], r["distance"], r["start"], r["end"])
                     for r in find_passages(docs, items, block_bytes=block).collect())
        assert got == [(20, 1, 0, 4, 58), (20, 4, 0, 4, 58), (22, 1, 2, 2, 51), (22, 4, 2, 2, 51)]
        left = drop_contaminated(docs, items, block_bytes=block)
        assert left.columns == docs.columns and left.count() == len(ODD) + 1
    assert find_passages(frame([]), items).collect() == []
    assert find_passages(docs, items.limit(0)).collect() == [] and drop_contaminated(docs, items.limit(0)).count() == len(ODD) + 3


def test_decontamination_query(spark, sample):
    import duckdb
    items = duckdb.sql(f"select item_id, text from '{SF}/benchmark.parquet'").fetchall()
    got = {(r["doc_id"], r["item_id"]) for r in queries.op2_decontamination(spark, SF).collect()}
    exact = {(d, i) for d, t, _ in sample for i, x in items if normal(x) in normal(t)}
    assert exact <= got
    texts, words = {d: normal(t) for d, t, _ in sample}, dict(items)
    for d, i in got - exact:
        item = normal(words[i])
        assert edit(item, texts[d]) <= int(0.1 * len(item))


def test_short_items_stand_between_word_edges(frame, spark):
    rows = [(1, "say yes now"), (2, "yesterday and eyes"), (3, "YES!"), (4, "第一章 介绍了机器学习的基本概念"), (5, "机器 学习"),
            (6, "an item of few words"), (7, "an item of few wards"), (8, "ab"), (9, None)]
    items = spark.createDataFrame([(1, "Yes"), (2, "机器学习"), (3, "of few words"), (4, "!!"), (5, None), (6, "a")],
                                  "item_id long, text string")
    got = sorted((r["doc_id"], r["item_id"], r["distance"]) for r in find_passages(frame(rows), items).collect())
    assert got == [(1, 1, 0), (3, 1, 0), (4, 2, 0), (6, 3, 0)]
    assert sorted(r["doc_id"] for r in drop_contaminated(frame(rows), items).collect()) == [2, 5, 7, 8, 9]


def test_long_items_without_spaces_are_met_with_edits(frame, spark):
    rng = random.Random(9)
    item = "".join(chr(rng.randint(0x4e00, 0x9f00)) for _ in range(60))
    near = item[:20] + "一" + item[21:40] + item[41:]
    items = spark.createDataFrame([(1, item)], "item_id long, text string")
    got = find_passages(frame([(1, "前" + near + "后"), (2, item[:30])]), items).collect()
    assert [(r["doc_id"], r["distance"]) for r in got] == [(1, 2)]


def test_many_items_equal_brute_force():
    rng = random.Random(10)
    words = ["".join(rng.choices("abc", k=rng.randint(1, 4))) for _ in range(30)]
    texts = [" ".join(rng.choices(words, k=rng.randint(0, 60))) for _ in range(25)]
    items = []
    for i in range(60):
        own = rng.choice([t for t in texts if t]).split()
        at = rng.randint(0, len(own) - 1)
        item = list(" ".join(own[at:at + rng.randint(1, 25)]))
        for _ in range(rng.randint(0, len(item) // 8)):
            item[rng.randrange(len(item))] = rng.choice("abc ")
        items.append((i, "".join(item)))
    matcher = Matcher(items, 0.1, 5)
    for text in texts:
        want = set()
        for i, item in items:
            item = normal(item)
            n = len(item)
            if n < 25 and item.count(" ") < 4:
                if n and f" {item} " in f" {text} ":
                    want.add(i)
            elif n and distance(char_masks(item), n, text, min(int(0.1 * n), n - 1))[0] <= min(int(0.1 * n), n - 1):
                want.add(i)
        assert {matcher.ids[j] for j in matcher.passages(normal(text))} == want
