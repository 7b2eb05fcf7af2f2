"""Near-duplicates by SimHash and a Gray-order hierarchical index.

Fingerprints: one 64-bit majority vote per text over the XXH64 hashes of its
word shingles.  Rows with equal fingerprints are one node.

Links: two fingerprints that differ in at most k bits agree on one of k+1 bit
blocks, so a node is sent to k+1 buckets (block, value).  Inside a bucket the
fingerprints are sorted by Gray rank, which puts small differences side by
side; runs of neighbours form groups, groups of groups upper nodes, each with
the mask of the bits all its members share and their common pattern.  Pairs of
nodes descend together: a step adds the differences in bits that both newly
share, and a pair of groups is dropped as soon as the sum exceeds k.

A bucket of more than ``chunk`` nodes is dealt into chunks, and every pair of
chunks is a bucket of its own, so no task holds more than two chunks of one
bucket.  A bucket reports a spanning forest of its links, never all pairs.
Components come from star contraction on those forests.

Defined results: a null or empty text has fingerprint zero, linked like any
other; rows with a null id take part, and a component without any id has a null
component_id; repeated rows share their fingerprint; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from quarry.llm.ragged import concat_ranges, nothing_kept, shielded, text_slices, texts_of
from quarry.operators.graph import star_components
from quarry.session import scratch_path

FANOUT = 8
TO_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def shingle_hashes(text: str, size: int) -> np.ndarray:
    """XXH64 (seed 42) of every run of ``size`` words, joined by spaces."""
    from xxhash import xxh64_intdigest
    words = text.encode("utf-8", "surrogatepass").translate(TO_LOWER).split()
    if not words:
        return np.zeros(0, np.uint64)
    line = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = max(len(words) - size + 1, 1)
    last = ends[min(size, len(words)) - 1:]
    return np.array([xxh64_intdigest(line[a:b], 42) for a, b in
                     zip(starts[:n].tolist(), last[:n].tolist())], np.uint64)


def fingerprint(text: str, size: int, step: int = 65_536) -> int:
    """Majority of the bits of all shingle hashes (a tie gives 0)."""
    h = shingle_hashes(text, size)
    votes = np.zeros(64, np.int64)
    for at in range(0, len(h), step):
        bits = np.unpackbits(h[at:at + step].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1,
                             bitorder="little")
        votes += bits.sum(0, dtype=np.int64)
    out = np.packbits(2 * votes > len(h), bitorder="little").view("<u8")[0]
    return int(np.int64(np.uint64(out).view(np.int64)))


def fingerprints(docs: DataFrame, size: int = 4, keep: tuple[str, ...] = ("doc_id",),
                 text_col: str = "text") -> DataFrame:
    """The ``keep`` columns and fp (the 64 bits as a signed long) of every row."""
    own = docs.select(*keep, F.col(text_col).cast("string").alias("__text"))
    schema = StructType([*(own.schema[c] for c in keep), StructField("fp", LongType())])

    def run(batches):
        nothing_kept()
        for batch in batches:
            for part in text_slices(batch, "__text"):
                fp = [fingerprint(t, size) for t in texts_of(part, "__text").to_pylist()]
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in keep),
                                                  pa.array(fp, pa.int64())], names=schema.names)
    return own.mapInArrow(run, schema)


def gray_rank(x: np.ndarray) -> np.ndarray:
    """Position of each code word in the binary-reflected Gray order."""
    out = x.copy()
    for s in (1, 2, 4, 8, 16, 32):
        out ^= out >> np.uint64(s)
    return out


class GrayIndex:
    """Hierarchy over fingerprints sorted by (bucket, Gray rank).  Level 0 is
    the fingerprints; a node of level l covers nodes first..first+count of
    level l-1, all of one bucket; the top level has one node per bucket."""

    def __init__(self, bucket: np.ndarray, fps: np.ndarray):
        order = np.lexsort((gray_rank(fps), bucket))
        self.order, self.fps = order, fps[order]
        owner = bucket[order]
        every = np.full(len(fps), ~np.uint64(0))
        self.levels = [(self.fps, every, None, None)]       # pattern, shared bits, first, count
        low = high = self.fps
        while len(owner) and (owner[1:] == owner[:-1]).any() or len(self.levels) == 1:
            start = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1])))
            place = np.arange(len(owner)) - np.repeat(start, np.diff(np.append(start, len(owner))))
            first = np.flatnonzero(place % FANOUT == 0)
            low, high = np.bitwise_and.reduceat(low, first), np.bitwise_or.reduceat(high, first)
            owner = owner[first]
            count = np.diff(np.append(first, len(place)))
            self.levels.append((low, ~(low ^ high), first, count))

    def links(self, most: int, slab: int = 16_384):
        """(i, j) index arrays of pairs that differ in at most ``most`` bits,
        slab by slab."""
        top = np.arange(len(self.levels[-1][0]))
        work = [(len(self.levels) - 1, top, top, np.zeros(len(top), np.int64),
                 np.zeros(len(top), np.uint64))]
        while work:
            level, a, b, acc, seen = work.pop()
            if len(a) > slab:
                work += [(level, *(x[at:at + slab] for x in (a, b, acc, seen)))
                         for at in range(0, len(a), slab)]
                continue
            _, _, first, count = self.levels[level]
            na, nb = count[a], count[b]
            pair = np.repeat(np.arange(len(a)), na * nb)
            place = concat_ranges(np.zeros(len(a), np.int64), na * nb)
            ca, cb = first[a][pair] + place // nb[pair], first[b][pair] + place % nb[pair]
            ok = ca <= cb if level > 1 else ca < cb
            pair, ca, cb = pair[ok], ca[ok], cb[ok]
            pattern, shared, _, _ = self.levels[level - 1]
            both = shared[ca] & shared[cb]
            fresh = both & ~seen[pair]
            total = acc[pair] + np.bitwise_count((pattern[ca] ^ pattern[cb]) & fresh)
            ok = total <= most
            if level > 1:
                work.append((level - 1, ca[ok], cb[ok], total[ok], both[ok]))
            elif ok.any():
                yield ca[ok], cb[ok]


def forest(bucket: np.ndarray, fps: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges (node, root) that connect, bucket by bucket, what the links connect."""
    index = GrayIndex(bucket, fps)
    parent = np.arange(len(fps))
    for i, j in index.links(most):
        while len(i):
            x, y = parent[i], parent[j]
            apart = x != y
            i, j, x, y = i[apart], j[apart], x[apart], y[apart]
            np.minimum.at(parent, np.maximum(x, y), np.minimum(x, y))
            while (parent != (up := parent[parent])).any():
                parent = up
    child = np.flatnonzero(parent != np.arange(len(parent)))
    return index.fps[child], index.fps[parent[child]]


def bucket_key(fp: Column, blocks: int) -> Column:
    """All (block, value) buckets of a fingerprint."""
    cuts = [64 * i // blocks for i in range(blocks + 1)]
    return F.array(*(F.struct(F.lit(i).alias("block"), F.shiftrightunsigned(fp, lo).bitwiseAND(
        F.lit((1 << (hi - lo)) - 1).cast("long")).alias("value"))
        for i, (lo, hi) in enumerate(zip(cuts, cuts[1:]))))


def near_edges(nodes: DataFrame, most: int = 4, chunk: int = 4096) -> DataFrame:
    """Spanning edges (a, b) of all pairs of distinct ``fp`` within ``most`` bits."""
    sent = nodes.select("fp", F.explode(bucket_key(F.col("fp"), most + 1)).alias("k")) \
        .select("fp", "k.block", "k.value")
    # at most rows / chunk buckets are this large
    large = sent.groupBy("block", "value").count().where(F.col("count") > chunk) \
        .select("block", "value", F.ceil(F.col("count") / chunk).cast("long").alias("chunks"))
    sent = sent.join(large, ["block", "value"], "left").withColumn("chunks", F.coalesce("chunks", F.lit(1)))
    own = F.pmod(F.xxhash64("fp"), F.col("chunks"))
    sent = sent.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"),
                                                                                F.col("chunks") - 1)))
    key = ["block", "value", "i", "j"]
    sent = sent.select("block", "value", F.least("own", "other").alias("i"),
                       F.greatest("own", "other").alias("j"), "fp")

    def run(batches):
        held: list[pa.RecordBatch] = []
        rows = 0

        def solved(table: pa.Table):
            cols = [np.asarray(table.column(c)) for c in key]
            change = np.zeros(table.num_rows, bool)
            for c in cols:
                change[1:] |= c[1:] != c[:-1]
            a, b = forest(np.cumsum(change), np.asarray(table.column("fp")).view(np.uint64), most)
            return pa.RecordBatch.from_arrays([pa.array(x.view(np.int64)) for x in (a, b)], names=["a", "b"])

        for batch in batches:
            held.append(batch)
            rows += batch.num_rows
            if rows < 32_768:
                continue
            table = pa.Table.from_batches(held)
            change = np.zeros(rows, bool)
            for c in key:
                x = np.asarray(table.column(c))
                change[1:] |= x[1:] != x[:-1]
            last = int(np.flatnonzero(change)[-1]) if change.any() else 0   # the last bucket may go on
            if last:
                yield solved(table.slice(0, last))
                held, rows = table.slice(last).to_batches(), rows - last
        if rows:
            yield solved(pa.Table.from_batches(held))

    return sent.repartition(*key).sortWithinPartitions(*key, "fp").mapInArrow(run, "a long, b long")


def grouped(found: DataFrame, id_col: Column, most: int = 4) -> DataFrame:
    """fp and component_id (least ``id_col`` of all rows in the component) of
    every distinct fingerprint of ``found``."""
    nodes = found.groupBy("fp").agg(F.min(id_col).alias("least"))
    # a node is named by its least id first (null last), so the smallest name of a
    # component holds its result and no join by component is needed
    name = F.struct(F.col("least").isNull().alias("none"), F.col("least").alias("id"), F.col("fp").alias("fp"))
    edges = near_edges(nodes, most)
    for c in ("a", "b"):
        edges = edges.join(nodes.select(F.col("fp").alias(c), name.alias(f"{c}_name")), c)
    near = star_components(edges.select(F.col("a_name").alias("a"), F.col("b_name").alias("b"))) \
        .select(F.col("id.fp").alias("fp"), F.col("comp.id").alias("near"), F.lit(True).alias("linked"))
    return nodes.join(near, "fp", "left").select(
        "fp", F.when(F.col("linked"), F.col("near")).otherwise(F.col("least")).alias("component_id"))


def near_duplicates(docs: DataFrame, size: int = 4, most: int = 4, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """id, fingerprint (16 hex digits), component_id of every row."""
    return shielded(docs.select(id_col, text_col), lambda d, i, t: _near_duplicates(d, size, most, i, t), id_col, text_col)


def _near_duplicates(docs: DataFrame, size: int, most: int, id_col: str, text_col: str) -> DataFrame:
    spark = docs.sparkSession
    path = scratch_path(spark, "simhash")
    fingerprints(docs, size, (id_col,), text_col).write.parquet(path)
    found = spark.read.parquet(path)
    return found.join(grouped(found, F.col(id_col), most), "fp").select(
        id_col, F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, size: int = 4, most: int = 4, id_col: str = "doc_id",
             text_col: str = "text") -> DataFrame:
    """The row of each component with the smallest id (rows without an id come
    last; equal ids by hash of the row), with all its columns."""
    return shielded(docs, lambda d, i, t: _keep_one(d, size, most, i, t), id_col, text_col)


def _keep_one(docs: DataFrame, size: int, most: int, id_col: str, text_col: str) -> DataFrame:
    spark = docs.sparkSession
    mark = F.xxhash64(*(F.col(f"`{c}`") for c in docs.columns))
    rank = F.struct(F.col(id_col).isNull().alias("none"), F.col(id_col).alias("id"),
                    F.col("__mark").alias("mark"))
    path = scratch_path(spark, "simhash")
    fingerprints(docs.withColumn("__mark", mark), size, (id_col, "__mark"), text_col).write.parquet(path)
    found = spark.read.parquet(path)
    first = grouped(found, rank, most).groupBy("component_id").agg(F.count("*").alias("n")) \
        .select(F.col("component_id.id").alias("__id"), F.col("component_id.mark").alias("__first"))
    kept = docs.withColumn("__mark", mark).join(
        first, F.col(id_col).eqNullSafe(F.col("__id")) & (F.col("__mark") == F.col("__first")), "left_semi")
    if found.groupBy(id_col, "__mark").count().where("count > 1").isEmpty():
        return kept.drop("__mark")
    return kept.dropDuplicates([id_col, "__mark"]).drop("__mark")
