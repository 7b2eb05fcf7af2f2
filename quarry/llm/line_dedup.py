"""Removal of globally repeated chunks of lines.

A chunk ends where a rolling hash over the hashes of the last lines says so,
and before and after every line of ``long_words`` words or more.  Both depend
on the lines near the cut only, so a passage is cut alike wherever it stands
and however much comes before it.  A chunk counts if it has several lines and
``least_words`` words, or if it has ``long_words`` words.

With ``passages``, every passage of several lines that holds ``long_words``
words, begins and ends on a line with words and stands at an earlier place goes
too, wherever its edges are: of each line with words the fewest lines from it on, and the fewest lines up to it, that hold so
many words are pieces as well.  They depend on nothing outside the passage, so
those of all its lines are found again and cover it from edge to edge.  Pieces
overlap; the first place of every line's text is never in a removed one.

Chunks and pieces meet by a 128-bit hash; counts are combined before the shuffle.  Of
each repeated hash all texts are then compared byte for byte (equal smallest
and largest, also combined first); a hash whose texts differ removes nothing.
The first place of a chunk (smallest id, then place in the text) keeps it, and
so does a place that overlaps the first one in the same text.

Blank lines at the edge of a removed passage stay; those inside it go.

Defined results: null and empty texts stay as they are; rows without an id come
after all others; rows equal in id and text stand for one place and keep or
lose the same chunks; line ends of kept lines are unchanged; all other columns
are kept, and ``n_chars``, where there is one, is the new length.
"""

from __future__ import annotations

import zlib

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from quarry.llm.ragged import nothing_kept, shielded
from quarry.session import scratch_path

MIX = 0x9E3779B97F4A7C15
MASK = 2**64 - 1


def chunks(text: str, window: int = 2, modulus: int = 2, long_words: int = 50,
           least_words: int = 10) -> list[tuple[int, int, bool]]:
    """(first line, line after the last, counts) of each chunk of the text."""
    from xxhash import xxh64_intdigest
    lines = text.split("\n")
    words = [len(line.split()) for line in lines]
    hashes = [xxh64_intdigest(line.encode("utf-8", "surrogatepass")) for line in lines]
    drop = pow(MIX, window, 2**64)
    out, start, rolling, total = [], 0, 0, 0
    for i, n in enumerate(words):
        rolling = (rolling * MIX + hashes[i]) & MASK
        if i >= window:
            rolling = (rolling - hashes[i - window] * drop) & MASK
        total += n
        last = i + 1 == len(words)
        mixed = (rolling ^ (rolling >> 32)) * MIX & MASK
        if (last or n >= long_words or words[i + 1] >= long_words
                or i + 1 >= window and (mixed >> 40) % modulus == 0):
            out.append((start, i + 1, total >= long_words or i > start and total >= least_words))
            start, total = i + 1, 0
    return out


def windows(words: list[int], least: int) -> set[tuple[int, int]]:
    """(first line, line after the last) of the fewest lines from each line on,
    and up to each line, that hold ``least`` words.  They begin and end on lines
    with words, so blank lines cost nothing; single lines are left out."""
    own = [i for i, n in enumerate(words) if n]
    out, n = set(), len(own)
    end = total = 0
    for start in range(n):
        while end < n and total < least:
            total += words[own[end]]
            end += 1
        if total < least:
            break
        out.add((own[start], own[end - 1] + 1))
        total -= words[own[start]]
    start, total = n, 0
    for end in range(n, 0, -1):
        while start and total < least:
            start -= 1
            total += words[own[start]]
        if total < least:
            break
        out.add((own[start], own[end - 1] + 1))
        total -= words[own[end - 1]]
    # two lines that each hold enough, with blank ones between
    out |= {(a, b + 1) for a, b in zip(own, own[1:]) if b - a > 1 and min(words[a], words[b]) >= least}
    return {(a, b) for a, b in out if b - a > 1}


def pieces(text: str, passages: bool, shape: tuple[int, int, int, int]) -> list[tuple[int, int]]:
    """The counting chunks and, with ``passages``, the windows, each once."""
    found = {(a, b) for a, b, counts in chunks(text, *shape) if counts}
    if passages:
        found |= windows([len(line.split()) for line in text.split("\n")], shape[2])
    return sorted(found)


def ranges(gone: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Sorted line ranges with those that overlap made one."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(gone):
        if out and a < out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def chunk_text(lines: list[str], first: int, end: int) -> str:
    return "\n".join(lines[first:end])


def chunk_hash(text: str) -> tuple[int, int]:
    from xxhash import xxh3_128_digest
    digest = xxh3_128_digest(text.encode("utf-8", "surrogatepass"))
    return (int.from_bytes(digest[:8], "little", signed=True),
            int.from_bytes(digest[8:], "little", signed=True))


def _marked(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The rows with a mark that, beside the id, tells texts apart."""
    text = F.col(text_col).cast("string")
    return docs.withColumn("__m1", F.xxhash64(text)) \
        .withColumn("__m2", F.xxhash64(F.concat(F.lit("#"), text)))


ROW = ("__id", "__m1", "__m2")


def dedup_lines(docs: DataFrame, window: int = 2, modulus: int = 2, long_words: int = 50,
                least_words: int = 10, id_col: str = "doc_id", text_col: str = "text",
                detail: bool = False, passages: bool = False) -> DataFrame:
    """The rows with repeated chunks, and with ``passages`` all repeated
    passages, removed from their text.  ``detail`` adds n_chunks, n_removed and
    removed (line ranges first:end, comma-joined)."""
    return shielded(docs, lambda d, i, t: _dedup_lines(d, (window, modulus, long_words, least_words), i, t, detail, passages),
                    id_col, text_col)


def _dedup_lines(docs: DataFrame, shape: tuple[int, int, int, int], id_col: str, text_col: str,
                 detail: bool, passages: bool) -> DataFrame:
    spark, names = docs.sparkSession, docs.columns
    id_kind = docs.schema[id_col].dataType.simpleString()
    own = _marked(docs, id_col, text_col)

    def places(batches):
        nothing_kept()
        for batch in batches:
            rows, at, to, h1, h2 = [], [], [], [], []
            for i, text in enumerate(batch.column("__text").to_pylist()):
                if text:
                    lines = text.split("\n")
                    for a, b in pieces(text, passages, shape):
                        x, y = chunk_hash(chunk_text(lines, a, b))
                        rows.append(i)
                        at.append(a)
                        to.append(b)
                        h1.append(x)
                        h2.append(y)
            took = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c).take(took) for c in ROW), pa.array(at, pa.int32()),
                 pa.array(to, pa.int32()), pa.array(h1, pa.int64()), pa.array(h2, pa.int64())],
                names=[*ROW, "at", "to", "h1", "h2"])

    narrow = own.select(F.col(id_col).alias("__id"), "__m1", "__m2",
                        F.col(text_col).cast("string").alias("__text"))
    found = narrow.mapInArrow(
        places, f"__id {id_kind}, __m1 long, __m2 long, at int, to int, h1 long, h2 long")
    at_path = scratch_path(spark, "line_places")
    found.write.option("compression", "zstd").parquet(at_path)
    found = spark.read.parquet(at_path)

    def place(at):
        return F.struct(F.col("__id").isNull().alias("none"), F.col("__id").alias("id"),
                        F.col("__m1").alias("m1"), F.col("__m2").alias("m2"), at.alias("at"))
    # rows equal in id and text count too: they share the first place and lose nothing
    twice = found.groupBy("h1", "h2").agg(F.min(place(F.col("at"))).alias("first"), F.count("*").alias("n")) \
        .where("n > 1").select("h1", "h2", "first")
    # the first place, or one that begins before the first one ends in the same text
    keeps = (place(F.col("first.at")) == F.col("first")) & (F.col("at") - F.col("first.at") < F.col("to") - F.col("at"))
    marks = found.join(twice, ["h1", "h2"]).select(
        *ROW, F.struct("at", "to", "h1", "h2", keeps.alias("keeps")).alias("mark"))
    # a row's own chunks: bounded by its text; rows equal in id and text have the same ones
    marks = marks.groupBy(*ROW).agg(F.collect_set("mark").alias("__marks"))
    wide = own.join(marks, F.col(id_col).eqNullSafe(F.col("__id")) & own["__m1"].eqNullSafe(marks["__m1"])
                    & own["__m2"].eqNullSafe(marks["__m2"]), "left") \
        .select(*(F.col(f"`{c}`") for c in names), "__marks")
    path = scratch_path(spark, "line_marks")
    wide.write.option("compression", "zstd").parquet(path)
    wide = spark.read.parquet(path)

    def texts(batches):
        for batch in batches:
            h1, h2, out = [], [], []
            for text, marks_ in zip(batch.column("__text").to_pylist(), batch.column("__marks").to_pylist()):
                lines = text.split("\n")
                for m in marks_:
                    h1.append(m["h1"])
                    h2.append(m["h2"])
                    # deflated alike, so equal bytes are equal texts
                    out.append(zlib.compress(chunk_text(lines, m["at"], m["to"]).encode("utf-8", "surrogatepass"), 6, -15))
            yield pa.RecordBatch.from_arrays([pa.array(h1, pa.int64()), pa.array(h2, pa.int64()),
                                              pa.array(out, pa.binary())], names=["h1", "h2", "text"])

    compared = wide.where("__marks IS NOT NULL") \
        .select(F.col(text_col).cast("string").alias("__text"), "__marks") \
        .mapInArrow(texts, "h1 long, h2 long, text binary") \
        .groupBy("h1", "h2").agg(F.min("text").alias("a"), F.max("text").alias("b")).where("a <> b")
    # different texts of one 128-bit hash: none are to be expected, so the bound only guards
    differ = {(r["h1"], r["h2"]) for r in compared.select("h1", "h2").limit(100_001).collect()}
    if len(differ) > 100_000:
        raise RuntimeError("too many chunk hashes with different texts")
    extra = [StructField("n_chunks", LongType()), StructField("n_removed", LongType()),
             StructField("removed", StringType())] if detail else []
    schema = StructType([*docs.schema.fields, *extra])

    def rebuilt(batches):
        for batch in batches:
            texts_, counts = [], {f.name: [] for f in extra}
            for text, marks_ in zip(batch.column(text_col).to_pylist(), batch.column("__marks").to_pylist()):
                gone = ranges([(m["at"], m["to"]) for m in marks_ or ()
                               if not m["keeps"] and (m["h1"], m["h2"]) not in differ])
                if detail:
                    counts["n_chunks"].append(len(chunks(text, *shape)) if text else 0)
                    counts["n_removed"].append(len(gone))
                    counts["removed"].append(",".join(f"{a}:{b}" for a, b in gone))
                if gone:
                    lines = text.split("\n")
                    edges = [0, *(x for r in gone for x in r), len(lines)]
                    text = "\n".join(line for a, b in zip(edges[::2], edges[1::2]) for line in lines[a:b])
                texts_.append(text)
            cols = []
            for name in names:
                col = batch.column(name)
                if name == text_col:
                    col = pa.array(texts_, col.type)
                elif name == "n_chars":
                    size = [None if t is None else len(t) for t in texts_]
                    same = [b if a == t else s for a, t, s, b in
                            zip(batch.column(text_col).to_pylist(), texts_, size, col.to_pylist())]
                    col = pa.array(same, col.type)
                cols.append(col)
            cols += [pa.array(v, pa.string() if k == "removed" else pa.int64()) for k, v in counts.items()]
            yield pa.RecordBatch.from_arrays(cols, names=schema.names)
    return wide.mapInArrow(rebuilt, schema)
