"""Removal of passages that stand in an earlier document: exact windows of
``size`` words.

Every window of every text gets a Rabin-Karp hash.  Map tasks pack documents
into slices (written once, compressed) and ask for each distinct hash of a
slice with the smallest id that holds it there; Spark shuffles these requests
by hash range and counts: a hash that another slice holds under a smaller id is
answered with a set bit.  Each slice takes its bits back, adds what its own
documents settle among themselves, merges the repeated windows to maximal
intervals and drops their words.

A hash travels once per slice, however often it occurs, so a passage that a
third of all documents share is no hot key; all windows of one range of hashes
meet in one task, and the number of ranges grows with the corpus.  Windows are
told apart by 64 bits and ``check_bytes`` bytes of a second hash: with two
bytes 40 false pairs are to be expected among 10**13 windows, with four 0.001.

Defined results: words stand between blanks (space, tab to carriage return); a
null text has no words and becomes empty; documents of fewer than ``size``
words stay; kept words are joined by one space; a null id counts as greater
than every other, and rows of equal id (or of null id) never remove each
other's words, but repeated rows all lose what an earlier document holds; an empty table gives no
rows; all other columns are kept, but those named like a result are replaced.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from quarry.llm.ragged import concat_ranges, kept, text_slices, texts_of
from quarry.llm.stored import bucketed, packed, unpacked
from quarry.llm.word_spans import Hasher, buffer_of, mixed, window_hashes

LAST = np.iinfo(np.int64).max


def to_blob(batch: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as w:
        w.write_batch(batch)
    return sink.getvalue().to_pybytes()


def from_blob(blob: bytes) -> pa.RecordBatch:
    with pa.ipc.open_stream(blob) as r:
        return r.read_all().combine_chunks().to_batches()[0]


class Windows:
    """The windows of one slice, in the order of their hashes."""

    def __init__(self, batch: pa.RecordBatch, id_col: str, text_col: str, size: int):
        hasher = kept(("words", "substrings"), Hasher)
        ids = pc.fill_null(batch.column(id_col).cast(pa.int64()), int(LAST)).to_numpy(zero_copy_only=False)
        texts, hashes, words, base = [], [], [], 0
        for piece in text_slices(batch, text_col, 4 << 20):
            data, offsets = buffer_of(texts_of(piece, text_col))
            _, _, h, text = hasher.words(data, offsets)
            hashes.append(h)
            texts.append(text + base)
            base += piece.num_rows
        h, self.text = np.concatenate(hashes), np.concatenate(texts)
        self.n_words = np.bincount(self.text, minlength=batch.num_rows)
        one = window_hashes(h, size)
        whole = self.text[:len(one)] == self.text[size - 1:size - 1 + len(one)]
        self.at = np.flatnonzero(whole)                     # first word of each window
        one = mixed(one[self.at])
        two = mixed(window_hashes(mixed(h + np.uint64(1)), size)[self.at])
        owner = ids[self.text[self.at]]
        order = np.argsort(one, kind="stable")
        same = one[order][1:] == one[order][:-1]
        if (same & (two[order][1:] != two[order][:-1])).any():
            order = np.lexsort((two, one))
        one, two = one[order], two[order]
        first = np.ones(len(one), bool)
        first[1:] = (one[1:] != one[:-1]) | (two[1:] != two[:-1])
        starts = np.flatnonzero(first)
        self.hash, self.check = one[starts], two[starts]
        owner = owner[order]
        self.least = np.minimum.reduceat(owner, starts) if len(starts) else np.zeros(0, np.int64)
        self.group = np.cumsum(first) - 1                    # distinct window of each place
        self.own = owner > self.least[self.group] if len(starts) else np.zeros(0, bool)
        self.order = order

    def repeated(self, settled: np.ndarray) -> np.ndarray:
        """First words of the windows to remove; ``settled`` has a bit per distinct window."""
        gone = self.own | settled[self.group]
        return self.at[self.order[gone]]


def covered(first_words: np.ndarray, n: int, size: int) -> np.ndarray:
    """True for each of n words that lies in one of the windows."""
    step = np.zeros(n + 1, np.int64)
    np.add.at(step, first_words, 1)
    np.add.at(step, np.minimum(first_words + size, n), -1)
    return np.cumsum(step[:n]) > 0


def intervals(gone: np.ndarray, text: np.ndarray, base: np.ndarray) -> list[str]:
    """Maximal ranges first:end of removed words, per text, comma-joined."""
    out = [[] for _ in range(len(base))]
    if len(gone):
        edge = np.ones(len(gone), bool)
        edge[1:] = (gone[1:] != gone[:-1]) | (text[1:] != text[:-1])
        starts = np.flatnonzero(edge)
        ends = np.append(starts[1:], len(gone))
        take = gone[starts]
        for a, b in zip(starts[take].tolist(), ends[take].tolist()):
            t = int(text[a])
            out[t].append(f"{a - base[t]}:{b - base[t]}")
    return [",".join(x) for x in out]


def drop_repeated(docs: DataFrame, size: int = 13, id_col: str = "doc_id", text_col: str = "text",
                  slice_bytes: int = 8 << 20, range_bytes: int = 16 << 20, check_bytes: int = 2) -> DataFrame:
    """The rows with every word removed that a window of ``size`` words covers
    which an earlier document holds, too.  Adds n_words, n_removed and removed
    (word ranges first:end, comma-joined)."""
    spark = docs.sparkSession
    added = [StructField("n_words", LongType()), StructField("n_removed", LongType()),
             StructField("removed", StringType())]
    docs = docs.drop(*(f.name for f in added))
    docs = docs.withColumn(text_col, F.col(text_col).cast("string"))
    if docs.schema[id_col].dataType.typeName() not in ("byte", "short", "integer", "long"):
        raise TypeError(f"{id_col} must be a whole number")

    def slices(batches):
        part, at, held, n = TaskContext.get().partitionId(), 0, [], 0

        def row(held, n, at):
            whole = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            return pa.RecordBatch.from_arrays(
                [pa.array([(part << 32) + at]), pa.array([n]), pa.array([to_blob(whole)], pa.binary())],
                names=["slice", "n_bytes", "rows"])
        for batch in batches:
            for piece in text_slices(batch, text_col, slice_bytes // 4):
                size_ = pc.sum(pc.binary_length(piece.column(text_col))).as_py() or 0
                if held and n + size_ > slice_bytes:
                    yield row(held, n, at)
                    held, n, at = [], 0, at + 1
                held.append(piece)
                n += size_
        if held:
            yield row(held, n, at)

    stored = bucketed(docs.mapInArrow(slices, "slice long, n_bytes long, rows binary"), "slice", "substring_slices")
    total = stored.agg(F.sum("n_bytes")).first()[0] or 0
    ranges = max(-(-total // range_bytes), 1)

    def bounds(hashes):
        """Places of the hash ranges in sorted hashes: range r holds those whose top part is r."""
        top = (np.arange(1, ranges, dtype=object) * 2**64 // ranges).astype(np.uint64)
        return np.concatenate(([0], np.searchsorted(hashes, top), [len(hashes)]))

    def requests(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                own = Windows(from_blob(batch.column("rows")[i].as_py()), id_col, text_col, size)
                edges = bounds(own.hash)
                rows = {k: [] for k in ("r", "n", "hashes", "checks", "ids")}
                for r in np.flatnonzero(np.diff(edges)).tolist():
                    a, b = int(edges[r]), int(edges[r + 1])
                    rows["r"].append(r)
                    rows["n"].append(b - a)
                    rows["hashes"].append(packed(np.diff(own.hash[a:b], prepend=np.uint64(0))))
                    rows["checks"].append(np.ascontiguousarray(
                        own.check[a:b].view(np.uint8).reshape(-1, 8)[:, :check_bytes]).tobytes())
                    rows["ids"].append(packed(own.least[a:b]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([batch.column("slice")[i].as_py()] * len(rows["r"]), pa.int64()),
                     pa.array(rows["r"], pa.int64()), pa.array(rows["n"], pa.int64()),
                     *(pa.array(rows[k], pa.binary()) for k in ("hashes", "checks", "ids"))],
                    names=["slice", "r", "n", "hashes", "checks", "ids"])

    def count(group: pa.Table) -> pa.Table:
        sizes = group.column("n").to_pylist()
        edges = np.concatenate(([0], np.cumsum(sizes, dtype=np.int64)))
        hashes = np.concatenate([np.cumsum(unpacked(x.as_py(), n, np.uint64), dtype=np.uint64)
                                 for x, n in zip(group.column("hashes"), sizes)])
        raw = np.zeros((len(hashes), 8), np.uint8)
        raw[:, :check_bytes] = np.frombuffer(
            b"".join(x.as_py() for x in group.column("checks")), np.uint8).reshape(-1, check_bytes)
        checks = raw.reshape(-1).view(np.uint64)
        ids = np.concatenate([unpacked(x.as_py(), n, np.int64) for x, n in zip(group.column("ids"), sizes)])
        order = np.argsort(hashes, kind="stable")
        sorted_ = hashes[order]
        near = sorted_[1:] == sorted_[:-1]
        # only hashes that several slices hold go on
        several = np.zeros(len(order), bool)
        several[1:] |= near
        several[:-1] |= near
        order = order[several]
        order = order[np.lexsort((checks[order], hashes[order]))]
        first = np.ones(len(order), bool)
        first[1:] = (hashes[order][1:] != hashes[order][:-1]) | (checks[order][1:] != checks[order][:-1])
        bits = np.zeros(len(hashes), bool)
        if len(order):
            least = np.minimum.reduceat(ids[order], np.flatnonzero(first))
            bits[order] = ids[order] > least[np.cumsum(first) - 1]
        answers = [pa.compress(np.packbits(bits[a:b]).tobytes(), "zstd", asbytes=True)
                   for a, b in zip(edges[:-1], edges[1:])]
        return pa.table({"slice": group.column("slice"), "r": group.column("r"), "n": group.column("n"),
                         "bits": pa.array(answers, pa.binary())})

    asked = stored.select("slice", "rows").mapInArrow(
        requests, "slice long, r long, n long, hashes binary, checks binary, ids binary")
    answers = asked.groupBy("r").applyInArrow(count, "slice long, r long, n long, bits binary") \
        .groupBy("slice").agg(F.sort_array(F.collect_list(F.struct("r", "n", "bits"))).alias("answers"))
    joined = stored.select("slice", "rows").join(answers, "slice", "left").select("rows", "answers")
    schema, names = StructType([*docs.schema.fields, *added]), docs.columns

    def cleaned(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                rows = from_blob(batch.column("rows")[i].as_py())
                own = Windows(rows, id_col, text_col, size)
                bits = [np.unpackbits(np.frombuffer(
                    pa.decompress(a["bits"], -(-a["n"] // 8), "zstd", asbytes=True), np.uint8))[:a["n"]]
                    for a in batch.column("answers")[i].as_py() or ()]
                settled = np.concatenate(bits).astype(bool) if bits else np.zeros(0, bool)
                gone = covered(own.repeated(settled), len(own.text), size)
                base = np.cumsum(own.n_words) - own.n_words
                removed = np.bincount(own.text[gone], minlength=rows.num_rows)
                texts = rebuilt(rows, text_col, gone)
                columns = [texts if c == text_col else rows.column(c) for c in names]
                done = pa.RecordBatch.from_arrays(
                    [*columns, pa.array(own.n_words, pa.int64()), pa.array(removed, pa.int64()),
                     pa.array(intervals(gone, own.text, base), pa.string())], names=schema.names)
                for at in range(0, done.num_rows, 2000):
                    yield done.slice(at, 2000)
    return joined.mapInArrow(cleaned, schema)


def rebuilt(rows: pa.RecordBatch, text_col: str, gone: np.ndarray) -> pa.Array:
    """The texts of kept words, one space between."""
    hasher, out, at = kept(("words", "substrings"), Hasher), [], 0
    for piece in text_slices(rows, text_col, 2 << 20):
        data, offsets = buffer_of(texts_of(piece, text_col))
        s, e, _, text = hasher.words(data, offsets)
        keep = ~gone[at:at + len(s)]
        at += len(s)
        s, e, text = s[keep], e[keep], text[keep]
        sizes = e - s + 1
        ends = np.cumsum(sizes)
        data = np.append(data, np.uint8(32))
        bytes_ = data[concat_ranges(s, sizes)]
        bytes_[ends - 1] = 32
        last = np.ones(len(text), bool)
        last[:-1] = text[1:] != text[:-1]
        stays = np.ones(len(bytes_), bool)
        stays[ends[last] - 1] = False
        length = np.bincount(text, weights=sizes, minlength=piece.num_rows).astype(np.int64)
        length -= length > 0
        starts = np.concatenate(([0], np.cumsum(length)))
        out.append(pa.LargeStringArray.from_buffers(
            piece.num_rows, pa.py_buffer(starts.tobytes()), pa.py_buffer(bytes_[stays].tobytes())))
    return pa.concat_arrays(out).cast(pa.string()) if out else pa.array([], pa.string())
