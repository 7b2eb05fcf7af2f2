"""Hierarchical multi-length packing of whole documents.

Each task streams its documents in pools of bounded size.  Within a pool a
document first gives its full longest windows; its rest is routed to the tier
(context size) that just holds it.  Tiers are packed from the longest to the
shortest: a window opens with the longest rest of its tier and its gap is
filled from shorter tiers, best fit first, at last by cutting a rest.  What a
pool cannot fill ends in windows of descending powers of two, so no window has
padding when the tiers are powers of two.  Sequences of a pool are then dealt
to step groups of equal tokens with balanced attention cost.

No shuffle: sequence and group numbers carry the task's partition number, so a
task that runs again gives the same rows as long as its input has a fixed
order (a table scan, as here).

Defined results: a null or empty text is the closing id alone; null ids stay
null; repeated rows are packed each on their own; extra columns are ignored.
"""

from __future__ import annotations

import heapq
from collections import deque

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (BinaryType, IntegerType, LongType, StructField, StructType)

from quarry.llm.ragged import text_slices, texts_of
from quarry.llm.tokens import word_ids

TIERS = (1024, 512, 256, 128)


class Rests:
    """Open pieces by length, first come first served; a bit mask of the
    lengths present finds the longest that fits at once."""

    def __init__(self):
        self.by_length: dict[int, deque] = {}
        self.mask = 0

    def add(self, doc: int, start: int, length: int) -> None:
        if length:
            self.by_length.setdefault(length, deque()).append((doc, start))
            self.mask |= 1 << length

    def longest(self, most: int) -> int:
        """Longest length present up to ``most``; 0 if there is none."""
        return max((self.mask & ((1 << (most + 1)) - 1)).bit_length() - 1, 0)

    def take(self, length: int) -> tuple[int, int]:
        queue = self.by_length[length]
        out = queue.popleft()
        if not queue:
            self.mask &= ~(1 << length)
        return out


def pack_pool(lengths: list[int], tiers: tuple[int, ...] = TIERS) -> list[list[tuple[int, int, int]]]:
    """Sequences of (document, start, length) over documents of these lengths."""
    tiers = tuple(sorted(tiers, reverse=True))
    top, rests, out = tiers[0], Rests(), []
    for doc, n in enumerate(lengths):
        full = n - n % top
        out += [[(doc, at, top)] for at in range(0, full, top)]
        rests.add(doc, full, n - full)
    for tier, shorter in zip(tiers, (*tiers[1:], 0)):
        while (length := rests.longest(tier)) > shorter:
            window, gap = [(*rests.take(length), length)], tier - length
            while gap and rests.mask:
                if length := rests.longest(gap):
                    window.append((*rests.take(length), length))
                    gap -= length
                else:                      # only longer rests are left: cut the shortest
                    length = (rests.mask & -rests.mask).bit_length() - 1
                    doc, start = rests.take(length)
                    window.append((doc, start, gap))
                    rests.add(doc, start + gap, length - gap)
                    gap = 0
            out += [window] if not gap else by_powers(window)
    return out


def by_powers(window: list[tuple[int, int, int]]) -> list[list[tuple[int, int, int]]]:
    """The same pieces in windows of descending powers of two."""
    total, out, pieces = sum(p[2] for p in window), [], deque(window)
    while total:
        size = room = 1 << (total.bit_length() - 1)
        part = []
        while room:
            doc, start, length = pieces.popleft()
            use = min(room, length)
            part.append((doc, start, use))
            if use < length:
                pieces.appendleft((doc, start + use, length - use))
            room -= use
        out.append(part)
        total -= size
    return out


def step_groups(sequences: list[list[tuple[int, int, int]]], step_tokens: int) -> list[int]:
    """A group for each sequence: costliest first (squares of piece lengths),
    each to the group with the fewest tokens, then the least cost."""
    size = [sum(p[2] for p in s) for s in sequences]
    cost = [sum(p[2] ** 2 for p in s) for s in sequences]
    groups = [(0, 0, g) for g in range(max(1, -(-sum(size) // step_tokens)))]
    out = [0] * len(sequences)
    for i in sorted(range(len(sequences)), key=lambda i: (-size[i], -cost[i], i)):
        tokens, spent, g = groups[0]
        heapq.heapreplace(groups, (tokens + size[i], spent + cost[i], g))
        out[i] = g
    return out


def pack_documents(docs: DataFrame, tokenizer_path: str, end_id: int = 0,
                   tiers: tuple[int, ...] = TIERS, pool_tokens: int = 2_000_000,
                   step_tokens: int = 65_536, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """One row per piece: id, start, length, ids (little-endian unsigned 32-bit),
    doc_tokens, sequence_id, offset, tier (the window's size), step_group."""
    if any(t & (t - 1) for t in tiers):
        raise ValueError("tiers must be powers of two")
    long_ = ("start", "length", "ids", "doc_tokens", "sequence_id", "offset")
    schema = StructType(
        [docs.schema[id_col], *(StructField(n, BinaryType() if n == "ids" else LongType())
                                for n in long_),
         StructField("tier", IntegerType()), StructField("step_group", LongType())])

    def run(batches):
        base = TaskContext.get().partitionId() << 32
        words, count, groups = word_ids(tokenizer_path), 0, 0
        keys, arrays, held, id_type = [], [], 0, None

        def flush():
            nonlocal count, groups
            rows = {n: [] for n in schema.names}
            sequences = pack_pool([len(a) for a in arrays], tiers)
            dealt = step_groups(sequences, step_tokens)
            for s, (sequence, group) in enumerate(zip(sequences, dealt)):
                offset, size = 0, sum(p[2] for p in sequence)
                for doc, start, length in sequence:
                    rows[id_col].append(keys[doc])
                    rows["start"].append(start)
                    rows["length"].append(length)
                    rows["ids"].append(arrays[doc][start:start + length].tobytes())
                    rows["doc_tokens"].append(len(arrays[doc]))
                    rows["sequence_id"].append(base + count + s)
                    rows["offset"].append(offset)
                    rows["tier"].append(size)
                    rows["step_group"].append(base + groups + group)
                    offset += length
            count += len(sequences)
            groups += max(dealt, default=-1) + 1
            kinds = {id_col: id_type, "ids": pa.binary(), "tier": pa.int32()}
            return pa.RecordBatch.from_arrays(
                [pa.array(rows[n], kinds.get(n, pa.int64())) for n in schema.names],
                names=schema.names)

        for batch in batches:
            for part in text_slices(batch, text_col, 4 << 20):
                ids, ends = words.encode(texts_of(part, text_col))
                id_type = part.schema.field(id_col).type
                for i, key in enumerate(part.column(id_col).to_pylist()):
                    own = ids[ends[i]:ends[i + 1]]
                    keys.append(key)
                    arrays.append(np.append(own, np.uint32(end_id)).astype("<u4"))
                    held += len(arrays[-1])
                if held >= pool_tokens:
                    yield flush()
                    keys, arrays, held = [], [], 0
        if keys:
            yield flush()

    return docs.select(F.col(id_col), F.col(text_col).cast("string").alias(text_col)) \
        .mapInArrow(run, schema)
