"""Secret scan with a recursive decoding worklist.

Each text is scanned as it stands; then URL escapes, Unicode escapes, base64
runs and compressed payloads are unwrapped layer by layer.  A layer knows for
each of its characters which range of the original text it came from, so a
find in any depth is reported as a range of the original.  A layer already
seen in the same text is not opened again; the worklist ends when no layer
gives a new one.  A find in base64 has the range of the whole run; where runs
go on over line ends, each line is tried by itself and all of them joined.

Defined results: a null or empty text has no spans; a null id stays null;
repeated rows are scanned each on their own; extra columns are ignored.  What
a payload holds is scanned up to its first error, in blocks of ``block_bytes``
that overlap by 64 KB, however much it inflates to; a payload within a payload
that crosses the end of such a block is opened up to there.
"""

from __future__ import annotations

import binascii
import bz2
import hashlib
import lzma
import re
import zlib
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from quarry.llm.ragged import nothing_kept, text_slices, texts_of

KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
                    r"([A-Za-z0-9+/_.=-]+)", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
URL = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
ESCAPE = re.compile(r"\\(?:u\{([0-9A-Fa-f]{1,6})\}|u([0-9A-Fa-f]{4})|U([0-9A-Fa-f]{8})|x([0-9A-Fa-f]{2}))")
BASE64 = re.compile(r"[A-Za-z0-9+/_-]{16,}={0,2}")
#: Such characters that go on over line ends; counted without them, there must be 16 as well.
WRAPPED = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]++(?:[ \t]*+(?:\r\n?|\n)[ \t]*+[A-Za-z0-9+/_-]++)++={0,2}")
MAGIC = re.compile(rb"\x1f\x8b\x08|BZh[1-9]|\xfd7zXZ\x00|\x28\xb5\x2f\xfd|\x78[\x01\x5e\x9c\xda]")
#: What any base match or any layer must hold: decides on whole columns, in native code, which texts need a look.
MAY_HOLD = (r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]|AKIA[A-Z0-9]{16}|[0-9a-f]{24}"""
            r"|%[0-9A-Fa-f]{2}|\\[uUx][0-9A-Fa-f{]|[A-Za-z0-9+/_-]{16}"
            r"|[A-Za-z0-9+/_-][ \t]*[\r\n][ \t\n]*[A-Za-z0-9+/_-]")


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) as each kind's pattern finds them from the left."""
    out = [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    out += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text)]
    out += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    return out


class Layer:
    """A text and, per character, the range of the original it stands for
    (None: the original itself)."""

    def __init__(self, text: str, starts: np.ndarray | None = None, ends: np.ndarray | None = None):
        self.text, self.starts, self.ends = text, starts, ends

    def origin(self, start: int, end: int) -> tuple[int, int]:
        if self.starts is None:
            return start, end
        return int(self.starts[start:end].min()), int(self.ends[start:end].max())

    def replaced(self, found: list[tuple[int, int, str]]) -> Layer:
        """The layer with each (start, end) replaced by its decoded string."""
        n = len(self.text)
        starts = np.arange(n) if self.starts is None else self.starts
        ends = np.arange(1, n + 1) if self.ends is None else self.ends
        texts, lows, highs, at = [], [], [], 0
        for start, end, new in found:
            lo, hi = self.origin(start, end)
            texts += [self.text[at:start], new]
            lows += [starts[at:start], np.full(len(new), lo)]
            highs += [ends[at:start], np.full(len(new), hi)]
            at = end
        return Layer("".join(texts) + self.text[at:], np.concatenate([*lows, starts[at:]]),
                     np.concatenate([*highs, ends[at:]]))

    def child(self, start: int, end: int, text: str) -> Layer:
        lo, hi = self.origin(start, end)
        return Layer(text, np.full(len(text), lo), np.full(len(text), hi))


def url_layer(layer: Layer) -> Layer | None:
    found = [(m.start(), m.end(), binascii.unhexlify(m[0].replace("%", "")).decode("utf-8", "replace"))
             for m in URL.finditer(layer.text)]
    return layer.replaced(found) if found else None


def escape_layer(layer: Layer) -> Layer | None:
    found = []
    for m in ESCAPE.finditer(layer.text):
        code = int(next(g for g in m.groups() if g), 16)
        if code < 0x110000:
            if found and found[-1][1] == m.start() and 0xDC00 <= code < 0xE000 \
                    and "\ud800" <= found[-1][2] < "\udc00":          # second half of a pair
                first = ord(found[-1][2])
                found[-1] = (found[-1][0], m.end(), chr(0x10000 + ((first - 0xD800) << 10) + code - 0xDC00))
            else:
                found.append((m.start(), m.end(), chr(code)))
    found = [(s, e, "�" if "\ud800" <= c <= "\udfff" else c) for s, e, c in found]
    return layer.replaced(found) if found else None


STEP, PIECE = 4096, 1 << 20


class Inflater:
    """One stream of a known kind, fed in steps, giving bounded pieces."""

    def __init__(self, data):
        head = bytes(data[:6])
        self.zlib = head[:2] == b"\x1f\x8b" or head[:1] == b"\x78"
        if self.zlib:
            self.tool = zlib.decompressobj(47)
        elif head[:3] == b"BZh":
            self.tool = bz2.BZ2Decompressor()
        else:
            self.tool = lzma.LZMADecompressor()

    def feed(self, part) -> Iterator[bytes]:
        if self.zlib:
            while len(part) and not self.tool.eof:
                yield self.tool.decompress(part, PIECE)
                part = self.tool.unconsumed_tail
        elif not self.tool.eof:
            yield self.tool.decompress(part, PIECE)
            while not self.tool.eof and not self.tool.needs_input:
                yield self.tool.decompress(b"", PIECE)


FAULTS = (zlib.error, OSError, lzma.LZMAError, EOFError)


def inflated(data) -> Iterator[bytes]:
    """Pieces of what a compressed stream holds, up to its end or first error:
    the step in which the error comes is read again byte by byte."""
    if data[:4] == b"\x28\xb5\x2f\xfd":
        import zstandard
        try:
            with zstandard.ZstdDecompressor().stream_reader(bytes(data)) as reader:
                while piece := reader.read(STEP):
                    yield piece
        except (zstandard.ZstdError, MemoryError):
            pass
        return
    tool = Inflater(data)
    for at in range(0, len(data), STEP):
        given = 0
        try:
            for piece in tool.feed(data[at:at + STEP]):
                given += len(piece)
                yield piece
        except FAULTS:
            again = Inflater(data)
            for lo in range(0, at, STEP):
                for _ in again.feed(data[lo:lo + STEP]):
                    pass
            try:
                for i in range(at, min(at + STEP, len(data))):
                    for piece in again.feed(data[i:i + 1]):
                        yield piece[given:]
                        given = max(0, given - len(piece))
            except FAULTS:
                pass
            return
        if tool.tool.eof:
            return
    if tool.zlib:
        yield tool.tool.flush()


def blocks(pieces: Iterator[bytes], most: int, overlap: int) -> Iterator[bytes]:
    """The pieces as blocks of at most ``most`` bytes, each beginning with the
    last ``overlap`` bytes of the one before."""
    held, size, fresh = [], 0, False
    for piece in pieces:
        while piece:
            part, piece = piece[:most - size], piece[most - size:]
            held.append(part)
            size, fresh = size + len(part), True
            if size == most:
                block = b"".join(held)
                yield block
                held = [block[len(block) - overlap:]] if overlap else []
                size, fresh = overlap, False
    if fresh:
        yield b"".join(held)


def opened(data: bytes, most: int) -> Iterator[bytes]:
    """The blocks of all compressed streams that begin anywhere in the bytes,
    and in those blocks, and so on; a block that was there before is not opened
    again, so a stream that inflates to itself ends."""
    seen, work = {hashlib.sha256(data).digest()}, [data]
    while work:
        view = work.pop()
        for m in MAGIC.finditer(view):
            for block in blocks(inflated(memoryview(view)[m.start():]), most, min(most // 4, 1 << 16)):
                mark = hashlib.sha256(block).digest()
                if mark not in seen:
                    seen.add(mark)
                    yield block
                    if MAGIC.search(block):
                        work.append(block)


NULS = re.compile(rb"(?:[\t\n\r -~]\x00){4}|(?:\x00[\t\n\r -~]){4}")
LOOK = re.compile(MAY_HOLD)


def readings(data: bytes) -> list[str]:
    """The bytes as text, with replacements for what is none: as UTF-8 and, where
    NULs stand between ASCII characters, as UTF-16 of both kinds from both first
    bytes.  Left out is only what no pattern and no layer can find a thing in."""
    texts = [data.decode("utf-8", "replace")]
    if NULS.search(data):
        texts += [data[first:].decode(kind, "replace") for kind in ("utf-16-le", "utf-16-be") for first in (0, 1)]
    return [text for text in texts if LOOK.search(text)]


def base64_runs(text: str) -> list[tuple[int, int, str]]:
    """(start, end, characters) of each run by itself and, where runs go on over
    line ends, of all of them joined."""
    out = [(m.start(), m.end(), m[0].rstrip("=")) for m in BASE64.finditer(text)]
    for m in WRAPPED.finditer(text):
        run = "".join(m[0].rstrip("=").split())
        if len(run) >= 16:
            out.append((m.start(), m.end(), run))
    return out


def base64_layers(layer: Layer, most: int) -> list[Layer]:
    """What each run decodes to from each of its first four characters on: one of
    them is in step with base64 that begins anywhere in the run.  Compressed
    payloads are opened wherever in the decoded bytes they begin."""
    out = []
    for start, end, run in base64_runs(layer.text):
        run = run.translate(STANDARD)
        for first in range(4):
            part = run[first:len(run) - ((len(run) - first) % 4 == 1)]
            data = binascii.a2b_base64(part + "=" * (-len(part) % 4))
            out += [layer.child(start, end, text) for x in (data, *opened(data, most)) for text in readings(x)]
    return out


def byte_layers(layer: Layer, most: int) -> list[Layer]:
    """Compressed payloads written as URL or backslash escapes, plain characters
    between them included."""
    out = []
    for runs, one, decode in ((URL_BYTES, URL, url_bytes), (ESCAPED_BYTES, BYTE_ESCAPE, escaped_bytes)):
        if one.search(layer.text):
            for m in runs.finditer(layer.text):
                if one.search(m[0]):
                    out += [layer.child(m.start(), m.end(), text) for x in opened(decode(m[0]), most)
                            for text in readings(x)]
    return out


def url_bytes(run: str) -> bytes:
    return URL.sub(lambda m: binascii.unhexlify(m[0].replace("%", "")).decode("latin-1"), run).encode("latin-1")


def escaped_bytes(run: str) -> bytes:
    return BYTE_ESCAPE.sub(lambda m: chr(int(m[1] or m[2], 16)) if m[1] or m[2] else SHORT[m[3]], run).encode("latin-1")


URL_BYTES = re.compile(r"(?:%[0-9A-Fa-f]{2}|[!-$&-~])+")
ESCAPED_BYTES = re.compile(r"(?:\\(?:x[0-9A-Fa-f]{2}|u00[0-9A-Fa-f]{2}|[abfnrtv0'\"\\])|[ -\[\]-~])+")
BYTE_ESCAPE = re.compile(r"\\(?:x([0-9A-Fa-f]{2})|u00([0-9A-Fa-f]{2})|([abfnrtv0'\"\\]))")
SHORT = dict(zip("abfnrtv0'\"\\", "\a\b\f\n\r\t\v\0'\"\\"))
STANDARD = str.maketrans("-_", "+/")


def all_spans(text: str, base: list[tuple[int, int, str]], block_bytes: int) -> list[tuple[int, int, str]]:
    """Base spans and those of every layer, each once, by start, kind, end."""
    spans, seen, work = set(base), {text}, deque([Layer(text)])
    while work:
        layer = work.popleft()
        if layer.starts is not None:
            spans.update((*layer.origin(s, e), kind) for s, e, kind in base_spans(layer.text))
        below = base64_layers(layer, block_bytes) + byte_layers(layer, block_bytes)
        below += [x for x in (url_layer(layer), escape_layer(layer)) if x]
        for new in below:
            mark = new.text if new.starts is None else (new.text, *new.origin(0, len(new.text)))
            if new.text and mark not in seen:
                seen.add(mark)
                work.append(new)
    return sorted(spans, key=order)


def order(span: tuple[int, int, str]):
    return span[0], KINDS.index(span[2]), span[1]


def joined(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


def scan_secrets(docs: DataFrame, block_bytes: int = 16 << 20, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """id, n_assign, n_access, n_hex, base_spans and spans (kind:start:end,
    comma-joined) of every row."""
    counts = [f"n_{k}" for k in KINDS]
    schema = StructType([docs.schema[id_col], *(StructField(c, LongType()) for c in counts),
                         StructField("base_spans", StringType()), StructField("spans", StringType())])

    def run(batches):
        nothing_kept()
        for batch in batches:
            for part in text_slices(batch, text_col):
                texts = texts_of(part, text_col)
                n = len(texts)
                cols = [np.zeros(n, np.int64) for _ in KINDS]
                base, every = [""] * n, [""] * n
                for i in np.flatnonzero(pc.match_substring_regex(texts, MAY_HOLD)):
                    text = texts[int(i)].as_py()
                    own = sorted(base_spans(text), key=order)
                    found = all_spans(text, own, block_bytes)
                    for c, kind in zip(cols, KINDS):
                        c[i] = sum(s[2] == kind for s in own)
                    base[i], every[i] = joined(own), joined(found)
                yield pa.RecordBatch.from_arrays(
                    [part.column(id_col), *(pa.array(c) for c in cols), pa.array(base, pa.string()),
                     pa.array(every, pa.string())], names=schema.names)
    return docs.select(F.col(id_col), F.col(text_col).cast("string").alias(text_col)) \
        .mapInArrow(run, schema)


def digest(spans: str) -> str:
    return hashlib.sha256(spans.encode()).hexdigest()
