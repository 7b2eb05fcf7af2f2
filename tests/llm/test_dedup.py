"""Line dedup, SimHash and the pipeline against brute force."""
import random

import numpy as np
import pytest
from llm_rows import ODD, SF

from quarry.llm import line_dedup, queries, simhash


# ---------------------------------------------------------------- line dedup
def brute_lines(rows, **shape):
    """Texts after removing every counting chunk that stood at an earlier place."""
    key = lambda r: (r[0] is None, r[0] or 0, *marks(r[1]))
    first, out = {}, {}
    for r in sorted(set(rows), key=key):
        lines = (r[1] or "").split("\n")
        kept = []
        for p, (a, b, counts) in enumerate(line_dedup.chunks(r[1], **shape) if r[1] else []):
            text = "\n".join(lines[a:b])
            if not counts or first.setdefault(text, (r, p)) == (r, p):
                kept += lines[a:b]
        out[r] = "\n".join(kept) if r[1] else r[1]
    return [out[r] for r in rows]


def marks(text):
    """The order of texts with equal ids, as the operator's hashes give it."""
    from xxhash import xxh64_intdigest
    s = lambda t: int(np.uint64(xxh64_intdigest(t.encode(), 42)).view(np.int64))
    return (s(text), s("#" + text)) if text is not None else (42, 42)


def passage(rng, lines, words):
    return ["".join(rng.choices("abcdefgh", k=5)) + " " + " ".join(
        "".join(rng.choices("abcdefgh", k=4)) for _ in range(words - 1)) for _ in range(lines)]


def test_cuts_do_not_shift():
    rng = random.Random(1)
    body = passage(rng, 40, 8)
    whole = {tuple(body[a:b]) for a, b, _ in line_dedup.chunks("\n".join(body))}
    for before in (1, 2, 7):
        lines = passage(rng, before, 8) + body
        found = {tuple(lines[a:b]) for a, b, _ in line_dedup.chunks("\n".join(lines))}
        assert len(whole & found) >= len(whole) - 2
    line = passage(rng, 1, 60)[0]
    assert (1, 2, True) in line_dedup.chunks("\n".join([body[0], line, body[1]]))
    text = "\n".join(body)
    cut = line_dedup.chunks(text)
    assert [a for a, _, _ in cut] == [0, *(b for _, b, _ in cut[:-1])] and cut[-1][1] == 40


def test_line_dedup_is_exact(frame):
    rng = random.Random(2)
    shared = [passage(rng, n, w) for n, w in ((1, 60), (6, 12), (9, 3), (1, 51), (12, 20))]
    rows = []
    for i in range(120):
        lines = passage(rng, rng.randint(0, 4), 9)
        for _ in range(rng.randint(0, 3)):
            lines += rng.choice(shared) + passage(rng, rng.randint(0, 2), 9)
        rows.append((i if i % 17 else None, "\n".join(lines)))
    rows += [rows[5], rows[6], (rows[7][0], rows[8][1]), *((i, t) for i, t in ODD if "\x00" not in (t or ""))]
    docs = frame(rows)
    out = line_dedup.dedup_lines(docs)
    assert out.columns == docs.columns and out.schema == docs.schema
    got = sorted((str(r["doc_id"]), r["text"] or "", -1 if r["n_chars"] is None else r["n_chars"]) for r in out.collect())
    want = sorted((str(i), t or "", -1 if t is None else len(t)) for (i, _), t in zip(rows, brute_lines(rows)))
    assert got == want
    long = shared[0][0]
    assert len({r["doc_id"] for r in out.where(out.text.contains(long)).collect()}) == 1
    assert line_dedup.dedup_lines(frame([])).collect() == []


def test_line_query(spark, sample):
    from test_passages import brute_passages
    rows = [(i, t) for i, t, _ in sample]
    want = dict(zip((i for i, _ in rows), brute_passages(rows)))
    got = queries.op3_line_dedup(spark, SF).collect()
    assert len(got) == len(rows) and all(r["text"] == want[r["doc_id"]] for r in got)
    assert any(r["n_removed"] for r in got)
    for r in got:
        assert r["n_removed"] == len([x for x in r["removed"].split(",") if x])


def test_first_place_keeps_the_chunk(frame):
    a, b = ("x " * 60).strip(), ("y " * 60).strip()
    docs = frame([(1, a), (2, b), (3, a)], parts=1)
    assert sorted(r["text"] for r in line_dedup.dedup_lines(docs).collect()) == ["", a, b]


# ------------------------------------------------------------------- simhash
def brute_fingerprint(text, size=4):
    import re
    from xxhash import xxh64_intdigest
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    runs = [words[i:i + size] for i in range(len(words) - size + 1)] or ([words] if words else [])
    h = [xxh64_intdigest(" ".join(r).encode(), 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(fps, most=4):
    names = sorted(set(fps))
    label = {f: f for f in names}
    for i, f in enumerate(names):
        for g in names[:i]:
            if (f ^ g).bit_count() <= most and label[f] != label[g]:
                old, new = max(label[f], label[g]), min(label[f], label[g])
                label = {k: new if v == old else v for k, v in label.items()}
    return [label[f] for f in fps]


def test_forest_and_gray_rank():
    x = np.arange(64, dtype=np.uint64)
    assert (np.argsort(simhash.gray_rank(x ^ (x >> np.uint64(1)))) == np.arange(64)).all()
    rng = np.random.default_rng(1)
    for trial in range(12):
        base = rng.integers(0, 2**63, 8, dtype=np.uint64)
        f = base[rng.integers(0, 8, rng.integers(1, 300))]
        for _ in range(3):
            f = f ^ (np.uint64(1) << rng.integers(0, 64, len(f)).astype(np.uint64))
        f = np.unique(f)
        bucket = np.zeros(len(f), int) if trial % 2 else rng.integers(0, 3, len(f))
        child, root = simhash.forest(bucket, f, 4)
        assert len(child) == len(set(child.tolist())) < len(f) + 1
        for b in set(bucket.tolist()):
            own = [int(v) for v in f[bucket == b]]
            up = {int(c): int(r) for c, r in zip(child, root) if int(c) in own}
            assert len(set(zip([up.get(v, v) for v in own], brute_components(own)))) == len(set(brute_components(own)))


@pytest.mark.parametrize("chunk", [4096, 5])
def test_buckets_lose_no_link(spark, chunk):
    rng = np.random.default_rng(9)
    base = rng.integers(-2**63, 2**63 - 1, 6)
    fps = {0, -1, *(int(b) for b in base)}
    for b in base:
        at = int(b)
        for _ in range(12):                     # chains: neighbours link, ends need not
            for bit in rng.choice(64, rng.integers(1, 6), replace=False):
                at ^= 1 << int(bit)
                at = (at + 2**63) % 2**64 - 2**63
            fps.add(at)
    fps = sorted(fps)
    edges = simhash.near_edges(spark.createDataFrame([(f,) for f in fps], "fp long"), 4, chunk)
    label = dict(zip(fps, fps))
    for r in edges.collect():
        old, new = max(label[r["a"]], label[r["b"]]), min(label[r["a"]], label[r["b"]])
        label = {k: new if v == old else v for k, v in label.items()}
    want = brute_components([f % 2**64 for f in fps])
    assert len(set(zip(label.values(), want))) == len(set(want)) == len(set(label.values()))


def expected_groups(rows):
    fps = [brute_fingerprint(t) for _, t in rows]
    comp = brute_components(fps)
    least = {}
    for (i, _), c in zip(rows, comp):
        if i is not None:
            least[c] = min(least.get(c, i), i)
    return fps, comp, [least.get(c) for c in comp]


def test_simhash_odd_rows(spark, frame):
    base = "many different words make up this text and it goes on for quite a while so that one word " \
           "changes little of all the shingles that it is made of in the end of things " * 6
    rows = [r for r in ODD if r[0] != 7] + [(30 + i, base + "end" * (i % 3)) for i in range(9)] + [(None, base)]
    fps, _, least = expected_groups(rows)
    docs = frame(rows)
    got = sorted((str(r["doc_id"]), r["fingerprint"], r["component_id"] or -1) for r in simhash.near_duplicates(docs).collect())
    assert got == sorted((str(i), f"{f:016x}", c or -1) for (i, _), f, c in zip(rows, fps, least))
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    comps = expected_groups(rows)[1]
    assert kept.count() == len(set(comps))
    assert sorted(r["doc_id"] for r in kept.collect() if r["doc_id"] is not None) == sorted(
        {c for c in least if c is not None})
    assert simhash.near_duplicates(frame([])).collect() == [] == simhash.keep_one(frame([])).collect()


def test_simhash_query(spark, sample):
    rows = [(i, t) for i, t, _ in sample]
    fps, _, least = expected_groups(rows)
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in queries.op5_simhash(spark, SF).collect()}
    assert got == {i: (f"{f:016x}", c) for (i, _), f, c in zip(rows, fps, least)}


# ------------------------------------------------------------------ pipeline
def test_pipeline_stage_by_stage(spark, tmp_path):
    """Each stage against brute force over what the stage before it kept."""
    import corpus_pipeline as cp
    import duckdb
    import pyarrow as pa
    from test_passages import brute_passages
    from test_search import edit
    from test_tokens import BYTE, check_pieces, library

    from quarry.llm.decontaminate import normal
    from quarry.llm.quality import fit_quality, statistics
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names, at = docs.columns, {}
    rows = {r["doc_id"]: r["text"] for r in docs.collect()}
    for k, (name, stage) in enumerate(cp.STAGES):
        out = stage(spark, docs, SF)
        out.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        at[name] = docs
        if k < 4:
            assert docs.columns == names
            kept = {r["doc_id"]: r["text"] for r in docs.collect()}
            if name == "quality":
                trees = fit_quality(spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet"))
                want = {i: t for i, t in rows.items() if trees.scores(statistics(pa.array([t])))[0] >= 0.3}
            elif name == "line_dedup":
                order = sorted(rows.items())
                want = dict(zip((i for i, _ in order), brute_passages(order)))
            elif name == "near_dedup":
                order = sorted(rows.items())
                want = {i: t for (i, t), c in zip(order, expected_groups(order)[2]) if i == c}
            else:
                items = [normal(t) for t, in duckdb.sql(f"select text from '{SF}/benchmark.parquet'").fetchall()]
                want = {}
                for i, t in rows.items():
                    text = normal(t)
                    if not any(x in text or len(text) < 900 and edit(x, text) <= int(0.1 * len(x)) for x in items):
                        want[i] = t
                    elif i in kept:
                        raise AssertionError(f"{i} holds a passage")
                assert all(i in kept for i, t in want.items() if len(normal(t)) < 900)
                want = {i: t for i, t in want.items() if i in kept}
            assert kept == want and 0 < len(kept) <= len(rows)
            rows = kept
        else:
            check_pieces(docs.collect(), sorted(rows.items()), 0, library(BYTE))


def test_pipeline_odd_rows(spark, frame, tmp_path):
    import corpus_pipeline as cp
    for name, rows in (("odd", ODD), ("none", [])):
        sf = str(tmp_path / name)
        frame(rows).write.parquet(f"{sf}/documents.parquet")
        spark.createDataFrame([(1, 1, 0), (None, None, None)], "doc_id long, quality int, toxic int").write.parquet(f"{sf}/labels.parquet")
        spark.createDataFrame([(1, None), (None, "no such passage stands in any of these")], "item_id long, text string").write.parquet(f"{sf}/benchmark.parquet")
        out = cp.run(spark, sf).collect()
        assert bool(out) == bool(rows)
