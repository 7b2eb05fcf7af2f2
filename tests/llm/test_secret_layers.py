"""Encoded layers of the secret scan that are not clean UTF-8 or not one run."""
import base64
import bz2
import gzip
import lzma
import random
import zlib

import pyarrow as pa
import pyarrow.compute as pc
import pytest
from test_search import PLAIN, b64, spans

from quarry.llm import secrets

LONG = " ".join(f"word{i}" for i in range(30)) + " " + PLAIN + " " + " ".join(f"end{i}" for i in range(30))


def pack_zstd(data):
    import zstandard
    return zstandard.ZstdCompressor().compress(data)


@pytest.mark.parametrize("data", [
    "\ufeff" + PLAIN, "a\u00a0b " + PLAIN, "\u200d\u00ad " + PLAIN, "\x1b[31m" + PLAIN, "\x00" + PLAIN,
    b"\xff\xfe\x80 " + PLAIN.encode() + b" \xc3", PLAIN.encode("utf-16"), PLAIN.encode("utf-16-le"),
    PLAIN.encode("utf-16-be"), "日本 ".encode("utf-16-be") + PLAIN.encode("utf-16-be"),
    gzip.compress(PLAIN.encode("utf-16")), "\x1b[0m " + b64("\ufeff" + PLAIN)])
def test_layers_that_are_not_clean_text(data):
    hidden = b64(data)
    assert f"assign:11:{11 + len(hidden)}" in spans("some words " + hidden + " and more")


@pytest.mark.parametrize("end", ["\n", "\r\n", "\n    "])
@pytest.mark.parametrize("width", [8, 63, 64, 76])
@pytest.mark.parametrize("pack", [bytes, gzip.compress, zlib.compress, bz2.compress, lzma.compress, pack_zstd])
def test_wrapped_base64_is_joined(pack, width, end):
    noise = "".join(random.Random(6).choices("abcdefgh ", k=400))
    run = b64(pack((LONG + noise).encode()))
    hidden = end.join(run[i:i + width] for i in range(0, len(run), width))
    text = "some words: " + hidden + " and more"
    assert f"assign:12:{12 + len(hidden)}" in spans(text)
    assert pc.match_substring_regex(pa.array([text]), secrets.MAY_HOLD)[0].as_py()


@pytest.mark.parametrize("glue", ["/", "v1/", "/a/", "ab_", "x-", "key-id_", "abcd/", "q", "qq", "qqq"])
@pytest.mark.parametrize("pack", [bytes, gzip.compress, zlib.compress, bz2.compress, lzma.compress, pack_zstd])
def test_glued_base64_is_found(pack, glue):
    hidden = glue + base64.urlsafe_b64encode(pack(("é " + PLAIN).encode())).decode()
    assert f"assign:11:{11 + len(hidden)}" in spans("some words " + hidden + " and more")


def test_lines_that_part_a_character():
    run = b64("é" * 28 + PLAIN)
    hidden = "\n".join(run[i:i + 38] for i in range(0, len(run), 38))
    assert f"assign:0:{len(hidden)}" in spans(hidden)


@pytest.mark.parametrize("pack", [gzip.compress, zlib.compress, bz2.compress, lzma.compress, pack_zstd])
@pytest.mark.parametrize("where", ["first", "far", "at a block's end"])
def test_large_payloads_are_scanned_whole(pack, where):
    at = {"first": 0, "far": 5 << 20, "at a block's end": (1 << 20) - 14}[where]
    hidden = b64(pack(b" " * at + PLAIN.encode() + b" " * (6 << 20)))
    assert f"assign:11:{11 + len(hidden)}" in spans("some words " + hidden + " and more")


@pytest.mark.parametrize("pack", [gzip.compress, zlib.compress, bz2.compress, lzma.compress, pack_zstd])
def test_what_inflates_before_an_error_is_kept(pack):
    noise = bytes(random.Random(7).choices(range(256), k=2_000_000)) if pack in (bz2.compress, pack_zstd) else b""     # several blocks
    data = bytearray(pack(LONG.encode() + noise))
    if pack in (gzip.compress, zlib.compress):
        data[-1] ^= 255                         # a wrong check sum
    else:
        data = data[:-4]                        # cut off
    hidden = b64(bytes(data))
    assert f"assign:11:{11 + len(hidden)}" in spans("some words " + hidden + " and more")


def test_compressed_payloads_written_as_escapes():
    import urllib.parse
    noise = "".join(random.Random(8).choices("abcdefgh ", k=300))
    for pack in (gzip.compress, zlib.compress, bz2.compress, lzma.compress, pack_zstd):
        data = pack((LONG + noise).encode())
        forms = [urllib.parse.quote(data, safe=""), urllib.parse.quote(data), "".join(f"%{b:02x}" for b in data),
                 "".join(f"\\x{b:02x}" for b in data), "".join(f"\\u00{b:02X}" for b in data), repr(data)[2:-1]]
        for hidden in forms:
            text = "some words " + hidden + " and more"
            assert any(s.startswith("assign:") for s in spans(text)), (pack, hidden[:40])
            assert any(s.startswith("assign:") for s in spans("x " + b64(text) + " y"))
            assert pc.match_substring_regex(pa.array([text]), secrets.MAY_HOLD)[0].as_py()


def test_streams_that_inflate_to_themselves_end(monkeypatch):
    data = gzip.compress(b"a") + b"\x00" * 20
    monkeypatch.setattr(secrets, "inflated", lambda x: iter([bytes(x)]))
    assert list(secrets.opened(data, 1 << 20)) == []
    turn = [data, data[:-1]]
    monkeypatch.setattr(secrets, "inflated", lambda x: iter([turn[bytes(x) == data]]))
    assert list(secrets.opened(data, 1 << 20)) == [data[:-1]]


def test_blocks_overlap():
    pieces = [bytes([i % 251]) * (i % 7) for i in range(300)]
    whole = b"".join(pieces)
    got = list(secrets.blocks(iter(pieces), 100, 30))
    assert got[0] == whole[:100] and all(len(x) <= 100 for x in got)
    assert b"".join([got[0], *(x[30:] for x in got[1:])]) == whole
    assert list(secrets.blocks(iter([b"a" * 100]), 100, 30)) == [b"a" * 100]
