"""Line dedup of whole passages against brute force over all line ranges."""
import random
import time

from llm_rows import SF
from test_dedup import marks, passage

from quarry.llm import line_dedup, queries


def brute_passages(rows, least=50):
    """Texts without the counting chunks, and without all runs of several lines
    and ``least`` words between lines with words, that stand at an earlier place they do not overlap."""
    key = lambda r: (r[0] is None, r[0] or 0, *marks(r[1]))
    first, out = {}, {}
    own = sorted(set(rows), key=key)
    for r in own:
        lines = (r[1] or "").split("\n")
        words = [len(x.split()) for x in lines]
        runs = {(a, b) for a in range(len(lines)) for b in range(a + 2, len(lines) + 1)
                if words[a] and words[b - 1] and sum(words[a:b]) >= least} if r[1] else set()
        runs |= {(a, b) for a, b, counts in line_dedup.chunks(r[1]) if counts} if r[1] else set()
        gone = set()
        for a, b in sorted(runs):
            where = first.setdefault("\n".join(lines[a:b]), (r, a))
            if where[0] != r or a >= where[1] + b - a:
                gone.update(range(a, b))
        out[r] = "\n".join(x for i, x in enumerate(lines) if i not in gone) if r[1] else r[1]
    return [out[r] for r in rows]


def test_passages_of_short_lines_go(frame):
    rng = random.Random(4)
    shared = [passage(rng, n, w) for n, w in ((2, 26), (3, 20), (4, 13), (6, 9), (5, 10), (3, 16), (4, 3))]
    shared += [passage(rng, 1, 55) + ["", "  "] + passage(rng, 1, 70) + [""] + passage(rng, 3, 9)]
    rows = []
    for i in range(80):
        lines = passage(rng, rng.randint(0, 3), 9)
        for _ in range(rng.randint(0, 3)):
            lines += rng.choice(shared) + passage(rng, rng.randint(0, 2), 9)
        rows.append((i if i % 17 else None, "\n".join(lines)))
    rows += [rows[3], (90, "\n".join(["na na"] * 90)), (91, None), (92, "")]
    got = line_dedup.dedup_lines(frame(rows), passages=True).collect()
    want = brute_passages(rows)
    assert sorted((str(r["doc_id"]), r["text"] or "") for r in got) == sorted((str(i), t or "") for (i, _), t in zip(rows, want))
    for body in shared[:5] + shared[7:]:           # of each passage of 50 words one place is left, whatever stands around it
        assert len({r["doc_id"] for r in got if "\n".join(body) in (r["text"] or "")}) == 1
        assert len({r["doc_id"] for r in got if body[-1] in (r["text"] or "")}) == 1


def test_windows_cover_a_passage():
    rng = random.Random(5)
    for _ in range(300):
        words = [rng.choice((0, 3, 20, 49, 60)) for _ in range(rng.randint(1, 9))]
        side = lambda: [rng.choice((0, 3, 20, 49, 60)) for _ in range(rng.randint(0, 4))]
        before = side()
        inside = {(a + len(before), b + len(before)) for a, b in line_dedup.windows(words, 50)}
        assert inside <= line_dedup.windows(before + words + side(), 50)
        if len(words) > 1 and sum(words) >= 50:
            covered = {i for a, b in line_dedup.windows(words, 50) for i in range(a, b)}
            own = [i for i, n in enumerate(words) if n]
            if len(own) > 1:
                covered |= {i for i, n in enumerate(words) if n >= 50}
                assert covered == set(range(own[0], own[-1] + 1))


def test_blank_lines_cost_nothing(frame):
    text = "\n" * 200_000 + " ".join(f"w{i}" for i in range(30)) + "\n" * 100_000 + "\n".join(f"v{i}" for i in range(30))
    start = time.perf_counter()
    found = line_dedup.pieces(text, True, (2, 2, 50, 10))
    assert time.perf_counter() - start < 2 and len(found) < 60
    rows = [(1, text), (2, "a line\n" + text), (3, text[190_000:] + "\nmore")]
    got = {r["doc_id"]: r["text"] for r in line_dedup.dedup_lines(frame(rows), passages=True).collect()}
    assert got[1] == text and "w0" not in got[2] + got[3] and "a line" in got[2] and "more" in got[3]


def test_line_query_leaves_no_passage(spark, sample):
    rows = [(i, t) for i, t, _ in sample]
    want = dict(zip((i for i, _ in rows), brute_passages(rows)))
    got = queries.op3_line_dedup(spark, SF).collect()
    assert len(got) == len(rows) and all(r["text"] == want[r["doc_id"]] for r in got)


def test_pipeline_stage_leaves_no_passage(spark, sample):
    import corpus_pipeline as cp
    rows = [(i, t) for i, t, _ in sample]
    want = dict(zip((i for i, _ in rows), brute_passages(rows)))
    got = cp.line_dedup(spark, spark.read.parquet(f"{SF}/documents.parquet"), SF).collect()
    assert {r["doc_id"]: r["text"] for r in got} == want
