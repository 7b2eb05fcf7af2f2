"""Token ids, packing, token files and counts against the tokenizer libraries."""
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from llm_rows import LONG, ODD, SF

from quarry.llm import queries
from quarry.llm.packing import by_powers, pack_documents, pack_pool, step_groups
from quarry.llm.token_counts import WordCounts, count_tokens
from quarry.llm.token_files import (DirectCodes, encode_levels, read_token_files, write_token_files)
from quarry.llm.tokens import WordIds

P = pytest.importorskip("public_tokenizers")
BYTE, WORD, PIECE = (P.path(n) for n in ("byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model"))
ALPHABET = [*" \n\t\r  ab'sSté.,;<|>12²½İßΣσς́  \x1c\x1f\x0b日本한🙂À▁", "<|endoftext|>",
            "<|startoftext|>", "<s>", " the", " 's", "'ll", "  ", "\n\n", "haha", "        "]


def fuzz(n, seed=1):
    rng = random.Random(seed)
    return ["".join(rng.choices(ALPHABET, k=rng.randint(0, 30))) for _ in range(n)]


def library(path):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(path)
    return lambda t: tok.encode(t or "", add_special_tokens=False).ids


@pytest.mark.parametrize("path", [BYTE, WORD])
def test_ids_are_the_librarys(path, sample):
    texts = fuzz(4000) + [t for _, t, _ in sample][:60] + ["", LONG]
    words, want = WordIds(path), library(path)
    for _ in range(2):                       # the second time from remembered words
        ids, ends = words.encode(pa.array(texts))
        for i, t in enumerate(texts):
            assert ids[ends[i]:ends[i + 1]].tolist() == want(t), t[:50]
    small = WordIds(path, max_words=50)      # forgets again and again
    for at in range(0, 500, 50):
        ids, ends = small.encode(pa.array(texts[at:at + 50]))
        assert ids.tolist() == [x for t in texts[at:at + 50] for x in want(t)]


def test_counts_are_the_librarys():
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=PIECE)
    texts = fuzz(4000, 2) + ["a" * 3000, "ab" * 900, "ha" * 501, " " * 300 + "x", "abc" * 300, "", LONG]
    got = WordCounts(PIECE).texts(pa.array(texts))
    assert got.tolist() == [len(x) for x in sp.encode(texts, num_threads=1)]


def test_count_query_and_odd_rows(spark, odd, frame, sample):
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=PIECE)
    rows = {r["doc_id"]: r for r in queries.op9_token_counts(spark, SF).collect()}
    assert len(rows) == len(sample)
    for i, t, _ in sample:
        n = len(sp.encode(t))
        assert (rows[i]["n_bytes"], rows[i]["n_tokens"], rows[i]["over_limit"]) == (len(t.encode()), n, n > 4096)
    got = sorted((r["doc_id"] is None, r["doc_id"] or 0, r["n_bytes"], r["n_tokens"])
                 for r in count_tokens(odd, PIECE).collect())
    want = sorted((i is None, i or 0, len((t or "").encode()), len(sp.encode(t or ""))) for i, t in ODD)
    assert got == want
    assert count_tokens(frame([]), PIECE).collect() == []


def check_pieces(pieces, texts, end_id, ids_of):
    """Every id of every row in exactly one piece, sequences gapless and unpadded."""
    by_seq, by_doc = {}, {}
    for r in pieces:
        by_seq.setdefault(r["sequence_id"], []).append(r)
        by_doc.setdefault(r["doc_id"], []).append(r)
        assert len(r["ids"]) == 4 * r["length"]
    for rows in by_seq.values():
        rows.sort(key=lambda r: r["offset"])
        at = 0
        for r in rows:
            assert r["offset"] == at and r["length"] > 0
            at += r["length"]
        assert at <= 1024 and at & (at - 1) == 0 and {r["tier"] for r in rows} == {at}
        assert len({r["step_group"] for r in rows}) == 1
    want = {}
    for i, t in texts:
        want.setdefault(i, []).append([*ids_of(t), end_id])
    assert set(by_doc) == set(want)
    for i, docs in want.items():
        if len(docs) > 1:                    # repeated rows: as many ids in all
            assert sum(r["length"] for r in by_doc[i]) == sum(map(len, docs))
            continue
        rows = sorted(by_doc[i], key=lambda r: r["start"])
        got, at = [], 0
        for r in rows:
            assert r["start"] == at and r["doc_tokens"] == len(docs[0])
            got += np.frombuffer(r["ids"], "<u4").tolist()
            at += r["length"]
        assert got == docs[0]


def test_packing_odd_rows_and_query(spark, odd, frame, sample):
    check_pieces(pack_documents(odd, BYTE, pool_tokens=5000).collect(), ODD, 0, library(BYTE))
    assert pack_documents(frame([]), BYTE).collect() == []
    rows = queries.op7_packing(spark, SF).collect()
    ids_of, want = library(BYTE), {}
    for i, t, _ in sample:
        want[i] = np.array([*ids_of(t), 0], "<u4")
    assert sum(r["length"] for r in rows) == sum(map(len, want.values()))
    for r in rows:
        part = want[r["doc_id"]][r["start"]:r["start"] + r["length"]]
        assert zlib.crc32(part.tobytes()) == r["ids_crc32"] and r["doc_tokens"] == len(want[r["doc_id"]])
    again = queries.op7_packing(spark, SF).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, again))


@pytest.mark.parametrize("lengths", [[], [1], [1024], [3, 5000, 7], [600] * 50, [513, 511, 1, 1, 129] * 40,
                                     list(range(1, 700, 7))])
def test_pool_is_whole_and_unpadded(lengths):
    out = pack_pool(lengths)
    seen = sorted((d, s, n) for w in out for d, s, n in w)
    at = {}
    for d, s, n in seen:
        assert s == at.get(d, 0)
        at[d] = s + n
    assert [at.get(d, 0) for d in range(len(lengths))] == lengths
    sizes = [sum(p[2] for p in w) for w in out]
    assert all(x & (x - 1) == 0 and x <= 1024 for x in sizes)
    groups = step_groups(out, 4096)
    loads = [sum(s for s, g in zip(sizes, groups) if g == j) for j in range(max(groups, default=0) + 1)]
    assert max(loads, default=0) - min(loads, default=0) <= 1024


def test_by_powers():
    assert [sum(p[2] for p in w) for w in by_powers([(0, 0, 5), (1, 2, 6)])] == [8, 2, 1]


@pytest.mark.parametrize("top", [3, 300, 70_000, 2**32 - 1])
def test_direct_codes_random_access(top):
    rng = np.random.default_rng(4)
    ids = rng.integers(0, top, 5000, endpoint=True).astype(np.uint32)
    ids[:700] = 1
    codes = DirectCodes(encode_levels(ids))
    assert (codes.access(0, 5000) == ids).all()
    for _ in range(300):
        a, b = sorted(rng.integers(0, 5001, 2))
        assert (codes.access(a, b) == ids[a:b]).all()
    assert len(DirectCodes(encode_levels(ids[:0])).access(0, 0)) == 0


def test_token_files(spark, odd, frame, sample, tmp_path):
    ids_of = library(WORD)
    rows = sorted(queries.op8_token_files(spark, SF).collect(), key=lambda r: r["doc_id"])
    at = 0
    for r, (i, t, _) in zip(rows, sample, strict=True):
        ids = np.array([*ids_of(t), 1], "<u4")
        assert (r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) == (i, at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)
    path = str(tmp_path / "files")
    write_token_files(odd, path, WORD, segment_tokens=50)
    got = sorted(read_token_files(spark, path).collect(), key=lambda r: r["start"])
    assert [r["doc_id"] for r in got] == sorted((i for i, _ in ODD), key=lambda i: (i is not None, i))
    at, texts = 0, {}
    for i, t in ODD:
        texts.setdefault(i, t)
    for r in got:
        assert r["start"] == at and np.frombuffer(r["ids"], "<u4").tolist() == [*ids_of(texts[r["doc_id"]]), 1]
        at += r["n_tokens"]
    empty = str(tmp_path / "none")
    write_token_files(frame([]), empty, WORD)
    assert read_token_files(spark, empty).collect() == []
