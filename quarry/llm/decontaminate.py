"""Benchmark passages in documents, by pigeonhole edit matching.

Texts and items are compared as lower-case words between single spaces.  An
item of n characters may be met with up to ``rate`` * n edits (k).  Cut into
k + 1 pieces, one piece at least must stand unchanged in any such passage, so
an Aho-Corasick automaton over all pieces finds every candidate.  A hit is
verified upwards: the piece with its neighbour, then four pieces, and so on to
the whole item, each by Myers' bit-parallel distance with the budget that the
pigeonhole principle leaves to that part (pieces - 1).  Before each step a part
of what joins must stand unchanged beside the hit, by the same principle.  A
false hit ends at the first steps; no true passage is lost.

Items travel to the tasks in blocks of bounded size; documents are scanned once
per block and never move.

Defined results: items that are null or hold no letter or digit are not
searched; an item of fewer than ``least_words`` words and 25 characters is met
only as it stands, between word edges (scripts without spaces have them
everywhere); null and empty texts hold nothing; null ids stay null;
repeated rows are searched each on their own; equal items each give a row.
"""

from __future__ import annotations

import re
from bisect import bisect_right

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from quarry.llm.ragged import kept, text_slices, texts_of

WORD = re.compile(r"[^\W_]+")


def normal(text: str) -> str:
    return " ".join(WORD.findall(text.lower()))


def distance(masks: dict[str, int], size: int, text: str, most: int) -> tuple[int, int]:
    """Least edit distance of a pattern to any part of the text, if at most
    ``most`` (else most + 1), and where that part ends first."""
    full, top = (1 << size) - 1, 1 << (size - 1)
    plus, minus, score = full, 0, size
    best, end = (size, 0) if size <= most else (most + 1, 0)
    for j, c in enumerate(text):
        eq = masks.get(c, 0)
        x = eq | minus
        h = (((eq & plus) + plus) ^ plus) | eq
        up = minus | (full & ~(h | plus))
        down = plus & h
        if up & top:
            score += 1
        elif down & top:
            score -= 1
            if score < best:
                best, end = score, j + 1
                if not best:
                    break
        up = (up << 1) & full
        down = (down << 1) & full
        plus = down | (full & ~(x | up))
        minus = up & x
    return best, end


def char_masks(pattern: str) -> dict[str, int]:
    out: dict[str, int] = {}
    for i, c in enumerate(pattern):
        out[c] = out.get(c, 0) | 1 << i
    return out


class Item:
    """One benchmark passage cut into pieces, with the tree of joined pieces."""

    def __init__(self, text: str, rate: float):
        self.text, self.budget = text, min(int(rate * len(text)), len(text) - 1)
        pieces = self.budget + 1
        self.cuts = [len(text) * i // pieces for i in range(pieces + 1)]
        self.masks: dict[tuple[int, int], dict[str, int]] = {}
        self.siblings: dict[tuple[int, int, int], list[tuple[int, str]]] = {}

    def pieces(self):
        return ((i, self.text[a:b]) for i, (a, b) in enumerate(zip(self.cuts, self.cuts[1:])))

    def path(self, piece: int) -> list[tuple[int, int]]:
        """Ranges of pieces around one, from the smallest joined range to all."""
        lo, hi, out = 0, self.budget + 1, []
        while hi - lo > 1:
            out.append((lo, hi))
            mid = (lo + hi) // 2
            lo, hi = (lo, mid) if piece < mid else (mid, hi)
        return out[::-1]

    def beside(self, text: str, lo: int, hi: int, side: int, start: int) -> bool:
        """Whether the rest of a joined range may stand beside the half that holds
        the hit (``side`` is where the halves meet, negative for the right one).
        The range may hold hi - lo - 1 edits, so of as many parts of the rest and
        one more, one stands unchanged, at most so many places off."""
        parts = self.siblings.get((lo, hi, side))
        if parts is None:
            a, b = (self.cuts[side], self.cuts[hi]) if side > 0 else (self.cuts[lo], self.cuts[-side])
            ends = [a + (b - a) * i // (hi - lo) for i in range(hi - lo + 1)]
            parts = self.siblings[lo, hi, side] = [(x, self.text[x:y]) for x, y in zip(ends, ends[1:])]
        off = hi - lo - 1
        for x, part in parts:
            at = start + x
            if text.find(part, max(0, at - off), max(0, at + len(part) + off)) >= 0:
                return True
        return False

    def verify(self, text: str, piece: int, at: int, seen: dict) -> tuple[int, int, int] | None:
        """(distance, start, end) of the passage around a piece found at ``at``;
        ``seen`` keeps what the text's other hits on the same diagonal gave."""
        start = at - self.cuts[piece]
        for lo, hi in self.path(piece):
            mid = (lo + hi) // 2
            side = mid if piece < mid else -mid
            key = (lo, hi, start)
            if key in seen:
                continue
            # with two pieces that is all; a hit in the other half may see another rest
            if (lo, hi, start, side) in seen or not (self.beside(text, lo, hi, side, start) and (
                    hi - lo == 2 or self.nearest(text, lo, hi, start)[0] < hi - lo)):
                seen[lo, hi, start, side] = False
                return None
            seen[key] = True
        n, k = len(self.text), self.budget
        if not k:
            return 0, start, start + n
        found, end = self.nearest(text, 0, k + 1, start)
        if found > k:
            return None
        window = text[max(0, end - n - found):end][::-1]
        _, back = distance(char_masks(self.text[::-1]), n, window, found)
        return found, end - back, end

    def nearest(self, text: str, lo: int, hi: int, start: int) -> tuple[int, int]:
        """(distance, end) of the joined pieces around where the item may start;
        a distance of hi - lo: more than the pieces may hold."""
        a, b, most = self.cuts[lo], self.cuts[hi], hi - lo - 1
        masks = self.masks.get((lo, hi))
        if masks is None:
            masks = self.masks[lo, hi] = char_masks(self.text[a:b])
        begin = max(0, start + a - most)
        found, end = distance(masks, b - a, text[begin:start + b + most], most)
        return found, begin + end


#: Scripts that set no spaces between words: a word may begin and end anywhere in them.
UNSPACED = re.compile("[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u9fff\uf900-\ufaff"
                      "\U00020000-\U0003ffff]")


def word_edge(text: str, at: int) -> bool:
    """Whether a word may begin or end before character ``at`` of a normal text."""
    return at in (0, len(text)) or " " in text[at - 1:at + 1] or bool(UNSPACED.search(text[at - 1:at + 1]))


class Matcher:
    """All pieces of a block of items in one automaton.  Items of fewer than
    ``least_words`` words and ``least_chars`` characters are one piece without
    an error budget, and stand between word edges."""

    def __init__(self, items: list[tuple[int, str]], rate: float, least_words: int, least_chars: int = 25):
        import ahocorasick
        self.ids, self.items, where = [], [], {}
        for key, text in items:
            text = normal(text or "")
            if text:
                short = text.count(" ") + 1 < least_words and len(text) < least_chars
                item = Item(text, 0.0 if short else rate)
                item.short = short
                for i, piece in item.pieces():
                    where.setdefault(piece, []).append((len(self.items), i))
                self.ids.append(key)
                self.items.append(item)
        self.machine = ahocorasick.Automaton()
        for piece, places in where.items():
            self.machine.add_word(piece, (len(piece), places))
        if where:
            self.machine.make_automaton()

    def passages(self, text: str) -> dict[int, tuple[int, int, int]]:
        """item -> (distance, start, end) of its best passage in a normal text
        (least distance, then first)."""
        out: dict[int, tuple[int, int, int]] = {}
        seen: dict[int, dict] = {}
        if not self.items:
            return out
        for last, (size, places) in self.machine.iter(text):
            at = last - size + 1
            for i, piece in places:
                known = out.get(i)
                item = self.items[i]
                if known and (known[0] == 0 or known[1] <= at - item.cuts[piece] + item.budget
                              and at + size <= known[2]):
                    continue                  # inside the passage already found
                if item.short and not (word_edge(text, at) and word_edge(text, at + size)):
                    continue
                found = item.verify(text, piece, at, seen.setdefault(i, {}))
                if found and (known is None or found < known):
                    out[i] = found
        return out

    def search(self, text: str) -> list[tuple[int, int, int, int]]:
        """(item id, distance, start, end) with places in the text as given."""
        found = self.passages(normal(text))
        if not found:
            return []
        words = [(m.start(), m.end(), len(normal(m[0]))) for m in WORD.finditer(text) if normal(m[0])]
        starts = np.cumsum([0, *(w[2] + 1 for w in words)]).tolist()
        out = []
        for i, (d, a, b) in found.items():
            first, last = bisect_right(starts, a) - 1, bisect_right(starts, max(b - 1, a)) - 1
            out.append((self.ids[i], d, words[min(first, len(words) - 1)][0], words[min(last, len(words) - 1)][1]))
        return sorted(out, key=lambda x: (x[2], x[1], x[3]))


def item_blocks(items: DataFrame, block_bytes: int, id_col: str, text_col: str):
    """Items in blocks of about ``block_bytes`` of text, one block at a time on
    the driver, for tasks to hold."""
    own = items.select(F.col(id_col).alias("k"), F.col(text_col).cast("string").alias("t")).where("t IS NOT NULL")
    total = own.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    blocks = -(-total // block_bytes)
    for b in range(blocks):
        part = own if blocks == 1 else own.where(F.pmod(F.xxhash64("k", "t"), F.lit(blocks)) == b)
        yield [(r["k"], r["t"]) for r in part.orderBy("k", "t").collect()]


def find_passages(docs: DataFrame, items: DataFrame, rate: float = 0.1, least_words: int = 5,
                  block_bytes: int = 16 << 20, id_col: str = "doc_id", text_col: str = "text",
                  item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """id, item id, distance, start, end (code points of the text): the best
    passage of each item in each row that holds one.  Where both ids have one
    name, the item's is given as ``item_<name>``."""
    import uuid
    if item_id == id_col:
        items, item_id = items.withColumnRenamed(item_id, f"item_{item_id}"), f"item_{item_id}"
    own = docs.select(F.col(id_col), F.col(text_col).cast("string").alias(text_col))
    schema = StructType([docs.schema[id_col], items.schema[item_id],
                         *(StructField(n, LongType()) for n in ("distance", "start", "end"))])
    out = docs.sparkSession.createDataFrame([], schema)
    for block in item_blocks(items, block_bytes, item_id, item_text):
        shared, token = docs.sparkSession.sparkContext.broadcast(block), uuid.uuid4().hex

        def run(batches, shared=shared, token=token):
            matcher = kept(("items", token), lambda: Matcher(shared.value, rate, least_words))
            for batch in batches:
                for part in text_slices(batch, text_col):
                    rows, found = [], []
                    for i, text in enumerate(texts_of(part, text_col).to_pylist()):
                        hits = matcher.search(text)
                        rows += [i] * len(hits)
                        found += hits
                    yield pa.RecordBatch.from_arrays(
                        [part.column(id_col).take(pa.array(rows, pa.int64())),
                         *(pa.array([f[c] for f in found], pa.int64()) for c in range(4))], names=schema.names)
        out = out.unionAll(own.mapInArrow(run, schema))
    return out


def drop_contaminated(docs: DataFrame, items: DataFrame, rate: float = 0.1, least_words: int = 5,
                      block_bytes: int = 16 << 20, text_col: str = "text",
                      item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """The rows that hold no passage of any item, with all their columns."""
    import uuid
    for block in item_blocks(items, block_bytes, item_id, item_text):
        shared, token = docs.sparkSession.sparkContext.broadcast(block), uuid.uuid4().hex

        def run(batches, shared=shared, token=token):
            matcher = kept(("items", token), lambda: Matcher(shared.value, rate, least_words))
            for batch in batches:
                for part in text_slices(batch, text_col):
                    clean = [not matcher.passages(normal(t)) for t in texts_of(part, text_col).to_pylist()]
                    yield part.filter(pa.array(clean, pa.bool_()))
        docs = docs.mapInArrow(run, docs.schema)
    return docs
