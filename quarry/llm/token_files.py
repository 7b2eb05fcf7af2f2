"""Token-id files of directly addressable codes.

Every id is split into chunks of fixed width.  A level holds one chunk of each
id that reaches it, a bitmap of the ids that go on, and a rank directory (ids
that go on before each block of 512), so any position is read without decoding
what lies before it.  A file row is a segment: whole documents in ascending id
order, with their positions, so a document is read by its own range.

Rows are dealt by range of (id, hash of the text): one id that holds many rows
spreads over many tasks, and its rows keep a fixed order.  Positions over all
documents come from the tokens of each range, one number per task.

Defined results: a null or empty text is the closing id alone; null ids come
first; repeated rows are written each on their own (equal ids by hash of the
text, then text); extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

from quarry.llm.ragged import text_slices, texts_of
from quarry.llm.tokens import word_ids

WIDTHS = (8, 8, 16)
BLOCK = 512
CHUNK = {8: np.dtype("u1"), 16: np.dtype("<u2")}
PARTS = ("data", "more", "ranks")


def encode_levels(ids: np.ndarray, widths: tuple[int, ...] = WIDTHS) -> list[tuple[bytes, bytes, bytes]]:
    """(chunks, continuation bitmap, rank directory) of each level; the last
    level takes what is left and has no bitmap."""
    out, rest = [], ids.astype(np.uint32)
    for k, width in enumerate(widths):
        data = (rest & np.uint32((1 << width) - 1)).astype(CHUNK[width]).tobytes()
        if k == len(widths) - 1:
            if len(rest) and int(rest.max()) >> width:
                raise ValueError("an id is wider than all levels together")
            out.append((data, b"", b""))
            break
        high = rest >> np.uint32(width)
        more = high > 0
        count = np.add.reduceat(more.astype(np.int64), np.arange(0, len(more), BLOCK)) \
            if len(more) else np.zeros(0, np.int64)
        ranks = (np.cumsum(count) - count).astype("<u4")
        out.append((data, np.packbits(more, bitorder="little").tobytes(), ranks.tobytes()))
        rest = high[more]
    return out


class DirectCodes:
    """Random access to the ids of one segment."""

    def __init__(self, levels: list[tuple[bytes, bytes, bytes]], widths: tuple[int, ...] = WIDTHS):
        self.widths = widths
        self.levels = [(np.frombuffer(d, CHUNK[w]), np.frombuffer(m, np.uint8), np.frombuffer(r, "<u4"))
                       for (d, m, r), w in zip(levels, widths)]

    def access(self, start: int, stop: int, level: int = 0) -> np.ndarray:
        """Ids at positions start..stop-1."""
        data, bits, ranks = self.levels[level]
        out = data[start:stop].astype(np.uint32)
        if level == len(self.levels) - 1 or start == stop:
            return out
        block = start // BLOCK
        flags = np.unpackbits(bits[block * BLOCK // 8:(stop + 7) // 8], bitorder="little")
        skip = start - block * BLOCK
        more = flags[skip:skip + stop - start].astype(bool)
        n = int(np.count_nonzero(more))
        if n:
            at = int(ranks[block]) + int(flags[:skip].sum())
            out[more] |= self.access(at, at + n, level + 1) << np.uint32(self.widths[level])
        return out


def write_token_files(docs: DataFrame, path: str, tokenizer_path: str, end_id: int = 1,
                      widths: tuple[int, ...] = WIDTHS, segment_tokens: int = 1 << 20,
                      id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encode every text, close it with ``end_id`` and write segments to ``path``."""
    names = [f"{p}{k}" for k in range(len(widths)) for p in PARTS]
    id_kind = docs.schema[id_col].dataType
    schema = f"part long, base long, n_ids long, doc_ids array<{id_kind.simpleString()}>, " \
             "doc_starts array<bigint>, " + ", ".join(f"{n} binary" for n in names)

    def run(batches):
        part = TaskContext.get().partitionId()
        words, base, total, keys, sizes, held = word_ids(tokenizer_path), 0, 0, [], [], []

        def segment():
            ids, ends = np.concatenate(held), np.cumsum(np.concatenate(([0], *sizes)))
            levels = encode_levels(ids, widths)
            own = pa.concat_arrays(keys)
            return pa.RecordBatch.from_arrays(
                [pa.array([part]), pa.array([base]), pa.array([len(ids)]),
                 pa.ListArray.from_arrays(pa.array([0, len(own)], pa.int32()), own),
                 pa.ListArray.from_arrays(pa.array([0, len(own)], pa.int32()), pa.array(ends[:-1])),
                 *(pa.array([x], pa.binary()) for level in levels for x in level)],
                names=["part", "base", "n_ids", "doc_ids", "doc_starts", *names])

        for batch in batches:
            for piece in text_slices(batch, text_col, 4 << 20):
                ids, ends = words.encode(texts_of(piece, text_col))
                closed = np.full(len(ids) + piece.num_rows, end_id, np.uint32)
                own = np.ones(len(closed), bool)
                own[ends[1:] + np.arange(piece.num_rows)] = False
                closed[own] = ids
                held.append(closed)
                keys.append(piece.column(id_col))
                sizes.append(np.diff(ends) + 1)
                total += len(closed)
                if total >= segment_tokens:
                    yield segment()
                    base += total
                    total, keys, sizes, held = 0, [], [], []
        if keys:
            yield segment()

    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    own = docs.select(F.col(id_col), F.col(text_col).cast("string").alias(text_col))
    tie = F.xxhash64(text_col)
    (own.repartitionByRange(n, F.col(id_col), tie)
        .sortWithinPartitions(F.col(id_col), tie, F.col(text_col))
        .mapInArrow(run, schema)
        .write.mode("error").option("compression", "lz4").parquet(path))


def read_token_files(spark: SparkSession, path: str, widths: tuple[int, ...] = WIDTHS,
                     id_name: str = "doc_id") -> DataFrame:
    """id, start (ids of all documents before it), n_tokens, ids (little-endian
    unsigned 32-bit) of every document, each read by its own range."""
    files = spark.read.parquet(path)
    # one number per writing task: bounded by the shuffle partitions, not by the rows
    sums = sorted((r["part"], r["n"]) for r in
                  files.groupBy("part").agg(F.sum("n_ids").alias("n")).collect())
    before, run_sum = {}, 0
    for part, n in sums:
        before[part] = run_sum
        run_sum += n
    schema = StructType([StructField(id_name, files.schema["doc_ids"].dataType.elementType),
                         StructField("start", LongType()), StructField("n_tokens", LongType()),
                         StructField("ids", BinaryType())])
    names = [f"{p}{k}" for k in range(len(widths)) for p in PARTS]

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                row = {n: batch.column(n)[i].as_py() for n in ("part", "base", "n_ids", "doc_starts")}
                blobs = [batch.column(n)[i].as_py() for n in names]
                codes = DirectCodes([tuple(blobs[3 * k:3 * k + 3]) for k in range(len(widths))], widths)
                ends = np.array([*row["doc_starts"], row["n_ids"]], np.int64)
                base = before[row["part"]] + row["base"]
                ids = [codes.access(int(a), int(b)).astype("<u4").tobytes()
                       for a, b in zip(ends[:-1], ends[1:])]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_ids")[i].values, pa.array(ends[:-1] + base),
                     pa.array(np.diff(ends)), pa.array(ids, pa.binary())], names=schema.names)
    return files.mapInArrow(run, schema)
