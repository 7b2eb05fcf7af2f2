"""Collocations of two to five words from ordered count streams.

Documents are packed into slices of one language (written once: distinct words
and the codes of all places).  Words are counted by Spark; those frequent
enough get ids in the order of (language, word), and every slice gets the ids
of its words back by a join.  An infrequent word ends a piece, since no
candidate holds it.

A slice then writes one record for each place: the word there and the four
that follow in the piece, filled up with 0.  Records are sorted and counted
within the slice and dealt to ranges of the record order.  In a range all
records of a prefix stand together, so one sorted pass counts the phrases of
every length; a prefix that runs over the edge of a range gives a part count
to each side.  The order is cut by arithmetic coding over the word counts, so
a frequent first word or pair is spread over several ranges.

The frequent phrases form one count stream, sorted twice: by their words
(prefix order), where the counts of all first parts come just before a phrase
and its extensions to the right just after it, and by their words backwards
(suffix order), for last parts and extensions to the left.  One lockstep pass
over each order finds them by comparing neighbours only; what lies before the
first row of a task is carried over by a small table (four rows a task).

Counts and products are whole numbers of any size.

Defined results: a null text holds nothing; a null language is ``und``; a
language is compared as it is written; empty tables give no rows; repeated rows
count each; ids and other columns are ignored; texts of any length are cut into
pieces like others.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.ragged import nothing_kept, text_slices
from quarry.llm.stored import bucketed, packed, unpacked
from quarry.llm.word_spans import buffer_of, cuts, flags, spans
from quarry.session import scratch_path

MOST = 5
WORDS = [f"w{k + 1}" for k in range(MOST)]
#: Up to so many languages a row for each is broadcast; beyond, none holds much and they are joined.
MOST_LANGUAGES = 100_000
#: Share of the code interval for the end of a piece.
END_SHARE = 0.1
PIECE = np.zeros(256, bool)
PIECE[[*b".,;:!?", 10, 11, 12, 13]] = True
WORD = flags(bytes([9, 10, 11, 12, 13, 32, *b".,;:!?"]))
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def word_codes(texts: pa.Array, chunk: int = 4 << 20) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """(distinct words, their counts, codes): the words of all texts in order
    as 1 + their place among the distinct ones, with 0 between pieces."""
    data, offsets = buffer_of(texts)
    held, marks, before = [], [], 0
    for lo, hi in cuts(data, offsets, WORD, chunk):
        k, m = np.searchsorted(offsets, lo, "right") - 1, np.searchsorted(offsets, hi, "left")
        part = data[lo:hi]
        own = np.clip(offsets[k:m + 1], lo, hi) - lo
        s, e = spans(part, own, WORD)
        ends = PIECE[part].astype(np.int64)
        at = own[1:-1]
        np.add.at(ends, at[at < len(part)], 1)          # a text begins a piece
        run = np.cumsum(ends)
        begins = int(lo > 0 and offsets[k] == lo)
        marks.append(run[s] + before + begins)
        before += int(run[-1]) + begins if len(run) else 0
        sizes = np.concatenate(([0], np.cumsum(e - s)))
        held.append(pa.LargeStringArray.from_buffers(
            len(s), pa.py_buffer(sizes.astype(np.int64).tobytes()),
            pa.py_buffer(LOWER[part][WORD[part]].tobytes())))
    if not held or not sum(map(len, held)):
        return pa.array([], pa.string()), np.zeros(0, np.int64), np.zeros(0, np.int64)
    coded = pa.concat_arrays(held).dictionary_encode()
    codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    piece = np.concatenate(marks)
    place = np.zeros(len(piece), np.int64)
    place[1:] = piece[1:] != piece[:-1]
    place = np.arange(len(piece)) + np.cumsum(place)
    out = np.zeros(int(place[-1]) + 1, np.int64)
    out[place] = codes + 1
    return coded.dictionary.cast(pa.string()), np.bincount(codes, minlength=len(coded.dictionary)), out


def sort_order(columns: list[np.ndarray]) -> np.ndarray:
    """Order of rows by whole numbers, the first column first: as many columns
    as fit are put into one 64-bit key."""
    bits = max(max((int(c.max()) for c in columns if len(c)), default=1).bit_length(), 1)
    per, keys = max(63 // bits, 1), []
    for at in range(0, len(columns), per):
        key = columns[at].astype(np.int64)
        for c in columns[at + 1:at + per]:
            key = (key << bits) | c
        keys.append(key)
    return np.argsort(keys[0], kind="stable") if len(keys) == 1 else np.lexsort(keys[::-1])


def changes(columns: list[np.ndarray]) -> np.ndarray:
    """True where a row differs from the one before it."""
    out = np.ones(len(columns[0]), bool)
    out[1:] = False
    for c in columns:
        out[1:] |= c[1:] != c[:-1]
    return out


def records(codes: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """The sorted distinct records of several words, and their counts: a place
    and what follows it up to the next 0."""
    filled = np.concatenate((codes, np.zeros(MOST, codes.dtype)))
    at = np.flatnonzero((filled[:-1] > 0) & (filled[1:] > 0))
    columns = [filled[at]]
    for k in range(1, MOST):
        columns.append(np.where(columns[-1] > 0, filled[at + k], 0))
    order = sort_order(columns)
    columns = [c[order] for c in columns]
    starts = np.flatnonzero(changes(columns))
    return [c[starts] for c in columns], np.diff(np.append(starts, len(order)))


def code_points(columns: list[np.ndarray], first, first_next, inner, inner_next) -> np.ndarray:
    """Arithmetic code of each record in [0, 1]: never falls in record order."""
    t = np.zeros(len(columns[0]))
    for c in columns[:0:-1]:
        t = np.minimum(inner[c] + (inner_next[c] - inner[c]) * t, inner_next[c])
    c = columns[0]
    return np.minimum(first[c] + (first_next[c] - first[c]) * t, first_next[c])


def phrase_counts(columns: list[np.ndarray], counts: np.ndarray, least: int):
    """(rows, length, count) of the phrases of a range: those frequent enough,
    and all that reach its first or last record."""
    differs = np.zeros(len(counts), bool)
    differs[0] = True
    for k in range(MOST):
        differs[1:] |= columns[k][1:] != columns[k][:-1]
        if k:
            starts = np.flatnonzero(differs)
            sums = np.add.reduceat(counts, starts)
            edge = np.zeros(len(starts), bool)
            edge[[0, -1]] = True
            take = (columns[k][starts] > 0) & ((sums >= least) | edge)
            yield starts[take], k + 1, sums[take]


class Lockstep:
    """One pass over rows in order: the counts of their proper prefixes, and
    the greatest count of their one-word extensions.  ``chain`` holds the rows
    that begin the last row of the batch before."""

    def __init__(self):
        self.chain: tuple[np.ndarray, np.ndarray] | None = None

    def batch(self, rows: np.ndarray, f: np.ndarray):
        """(prefix counts with 0 where unknown, greatest extension, tuples that
        stand earlier with their extensions in this batch)."""
        n_before = 0
        if self.chain is not None:
            n_before = len(self.chain[0])
            rows, f = np.concatenate((self.chain[0], rows)), np.concatenate((self.chain[1], f))
        n, length = len(rows), (rows > 0).sum(axis=1)
        index, ext = np.arange(n), np.zeros(n, np.int64)
        parts = np.zeros((n, MOST - 1), np.int64)
        earlier = []
        for k in range(1, MOST):
            at = np.maximum.accumulate(np.where(length == k, index, -1))
            same = (at >= 0) & (length > k)
            same[same] &= (rows[at[same], :k] == rows[same, :k]).all(axis=1)
            parts[same, k - 1] = f[at[same]]
            longer = length == k + 1
            np.maximum.at(ext, at[longer & same], f[longer & same])
            lost = np.flatnonzero(longer & ~same)
            if len(lost):                      # all extend a prefix of the task's first row
                prefix = np.zeros(MOST, np.int64)
                prefix[:k] = rows[lost[0], :k]
                earlier.append((prefix, int(f[lost].max())))
        earlier += [(rows[i].copy(), int(ext[i])) for i in range(n_before) if ext[i]]
        # what begins the last row: of each length the last row, if it is a prefix
        tail = sorted(int(x[-1]) for x in (np.flatnonzero(length == k) for k in range(1, MOST + 1)) if len(x))
        tail = [i for i in tail if (rows[-1, :length[i]] == rows[i, :length[i]]).all()]
        self.chain = rows[tail], f[tail]
        return parts[n_before:], ext[n_before:], earlier


def ordered_pass(table: DataFrame, order: list[str], name: str) -> DataFrame:
    """The rows (lang, w1..w5, f and more) with the counts of the prefixes in
    the given order (``name``1..4; 0 where there is none) and the greatest count of their
    one-word extensions (``name``_ext)."""
    spark = table.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    parts, ext = [f"{name}{k}" for k in range(1, MOST)], f"{name}_ext"
    others = [c for c in table.columns if c not in order]
    fresh = [*parts, ext, "task", "first"]

    def run(batches):
        nothing_kept()
        state, task, first = Lockstep(), TaskContext.get().partitionId(), True
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = np.stack([np.asarray(batch.column(c)) for c in order], axis=1)
            counts, longest, earlier = state.batch(rows, np.asarray(batch.column("f")))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in (*order, *others)), *(pa.array(c) for c in counts.T), pa.array(longest),
                 pa.array(np.full(len(rows), task)), pa.array(np.zeros(len(rows), np.int64))],
                names=[*order, *others, *fresh])
            # rows of their own: extensions of earlier tuples, and the prefixes of the task's first row
            own = [(t, x, 0) for t, x in earlier]
            if first:
                for k in range(1, int((rows[0] > 0).sum())):
                    own.append((np.where(np.arange(MOST) < k, rows[0], 0), 0, k))
            first = False
            if own:
                t = np.stack([x[0] for x in own])
                none = [pa.nulls(len(own), batch.schema.field(c).type) for c in others]
                yield pa.RecordBatch.from_arrays(
                    [*(pa.array(c) for c in t.T), *none, *(pa.nulls(len(own), pa.int64()) for _ in parts),
                     pa.array([x[1] for x in own], pa.int64()), pa.array(np.full(len(own), task)),
                     pa.array([x[2] for x in own], pa.int64())], names=[*order, *others, *fresh])

    kinds = {f.name: f.dataType.simpleString() for f in table.schema.fields}
    schema = ", ".join([f"{c} {kinds[c]}" for c in (*order, *others)] + [f"{c} long" for c in fresh])
    path = scratch_path(spark, f"collocations_{name}")
    table.select(*order, *others).repartitionByRange(partitions, *order).sortWithinPartitions(*order) \
        .mapInArrow(run, schema).write.parquet(path)
    found = spark.read.parquet(path)
    whole = found.where("first = 0").groupBy(*order).agg(
        *(F.max(c).alias(c) for c in (*others, *parts, ext)),
        F.max(F.when(F.col("f").isNotNull(), F.col("task"))).alias("task"))
    # what stands before the first row of a task: four rows a task at most
    edge = found.where("first > 0").select("task", "first", *order).join(
        table.select(*order, "f"), order).groupBy("task").agg(
        *(F.max(F.when(F.col("first") == k, F.col("f"))).alias(f"edge{k}") for k in range(1, MOST)))
    size = sum((F.col(c) > 0).cast("int") for c in order)
    whole = whole.join(F.broadcast(edge), "task", "left")
    return whole.select(*order, *others, ext, *(
        F.when(size > k, F.when(F.col(f"{name}{k}") > 0, F.col(f"{name}{k}")).otherwise(F.col(f"edge{k}")))
        .otherwise(0).alias(f"{name}{k}") for k in range(1, MOST)))


def scores(a, n, left, right) -> tuple[list[int], list[int], list[int]]:
    """(score, left count, right count) of each phrase by its lowest cut;
    ``left`` and ``right`` hold the counts of the cuts, 0 beyond the last."""
    out = [], [], []
    for a_, n_, ls, rs in zip(a, n, left, right):
        best = min((1000 * a_ * n_ // (x * y), k) for k, (x, y) in enumerate(zip(ls, rs)) if x)
        out[0].append(best[0])
        out[1].append(ls[best[1]])
        out[2].append(rs[best[1]])
    return out


def collocations(docs: DataFrame, least: int = 100, top: int = 2000, absorb: int = 100,
                 slice_bytes: int = 8 << 20, range_words: int = 2_000_000,
                 lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's ``top`` phrases of
    ``least`` occurrences or more.  A phrase goes if a longer one that holds it
    has ``absorb`` percent of its count."""
    spark = docs.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    docs = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))

    def slices(batches):
        nothing_kept()
        part, at, held, sizes = TaskContext.get().partitionId(), 0, {}, {}

        def row(lang):
            nonlocal at
            sizes.pop(lang)
            words, counts, codes = word_codes(pa.concat_arrays(held.pop(lang)))
            at += 1
            return pa.RecordBatch.from_arrays(
                [pa.array([(part << 32) + at]), pa.array([lang]), pa.array([int(counts.sum())]),
                 pa.array([words.to_pylist()], pa.list_(pa.string())), pa.array([counts.tolist()], pa.list_(pa.int64())),
                 pa.array([len(codes)]), pa.array([packed(codes.astype(np.uint32))], pa.binary())],
                names=["slice", "lang", "n", "words", "counts", "n_codes", "codes"])

        for batch in batches:
            for piece in text_slices(batch, "text", slice_bytes // 4):
                coded = piece.column("lang").dictionary_encode()
                for i, lang in enumerate(coded.dictionary.to_pylist()):
                    texts = piece.column("text").filter(pc.equal(coded.indices, i)).cast(pa.large_string())
                    held.setdefault(lang, []).append(texts)
                    sizes[lang] = sizes.get(lang, 0) + (pc.sum(pc.binary_length(texts)).as_py() or 0) + 256
                    if sizes[lang] >= slice_bytes:
                        yield row(lang)
                while sum(sizes.values()) >= 4 * slice_bytes:    # many languages: the largest goes first
                    yield row(max(sizes, key=sizes.get))
        for lang in sorted(held):
            yield row(lang)

    stored = bucketed(docs.mapInArrow(
        slices, "slice long, lang string, n long, words array<string>, counts array<long>, n_codes long, codes binary"),
        "slice", "collocation_slices")

    # ----------------------------------------------------------- vocabulary
    n_of = stored.groupBy("lang").agg(F.sum("n").alias("n"))
    # tables of a row per language: a language with most of the rows must not be a join key
    few = n_of.count() <= MOST_LANGUAGES
    per_language = F.broadcast if few else lambda table: table
    counted = stored.select("lang", F.explode(F.arrays_zip("words", "counts")).alias("x")) \
        .groupBy("lang", F.col("x.words").alias("word")).agg(F.sum("x.counts").alias("c")) \
        .where(F.col("c") >= least)

    def number(batches):
        task, at, run = TaskContext.get().partitionId(), 0, 0
        for batch in batches:
            c = np.asarray(batch.column("c"))
            before = run + np.cumsum(c) - c
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(np.full(len(c), task, np.int64)), pa.array(at + np.arange(len(c))),
                 pa.array(before)], names=["lang", "word", "c", "task", "at", "before"])
            at, run = at + len(c), run + int(c.sum())

    path = scratch_path(spark, "collocation_words")
    counted.repartitionByRange(partitions, "lang", "word").sortWithinPartitions("lang", "word") \
        .mapInArrow(number, "lang string, word string, c long, task long, at long, before long") \
        .write.parquet(path)
    numbered = spark.read.parquet(path)
    # one row per writing task: bounded by the shuffle partitions, not by the words
    tasks = sorted(tuple(r) for r in numbered.groupBy("task").agg(
        F.count("*").alias("k"), F.sum("c").alias("c")).collect())
    offsets, rows_before, sum_before = [], 0, 0
    for task, k, c in tasks:
        offsets.append((task, rows_before + 1, sum_before))
        rows_before, sum_before = rows_before + k, sum_before + c
    all_words = max(sum_before, 1)
    vocabulary = numbered.join(F.broadcast(spark.createDataFrame(
        offsets, "task long, id0 long, sum0 long")), "task") \
        .select("lang", "word", "c", (F.col("at") + F.col("id0")).alias("id"),
                (F.col("before") + F.col("sum0")).alias("before"))
    own_range = vocabulary.groupBy("lang").agg(F.min("before").alias("lo"), F.sum("c").alias("size"))
    total = stored.agg(F.sum("n")).first()[0] or 0
    ranges = max(-(-total // range_words), 1)

    # ------------------------------------------------------ records, phrases
    # every word of every slice gets an answer; those without an id are not collected
    answer = F.when(F.col("id").isNotNull(), F.struct("pos", "id", "c", "before"))
    replies = stored.select("slice", "lang", F.posexplode("words").alias("pos", "word")) \
        .join(vocabulary, ["lang", "word"], "left") \
        .groupBy("slice").agg(F.collect_list(answer).alias("known"))
    asked = stored.select("slice", "lang", "n_codes", "codes").join(replies, "slice") \
        .join(per_language(own_range), "lang") \
        .select("lang", "n_codes", "codes", "known", "lo", "size")

    def grams(batches):
        nothing_kept()
        for batch in batches:
            for i in range(batch.num_rows):
                lang, n, lo, size = (batch.column(c)[i].as_py() for c in ("lang", "n_codes", "lo", "size"))
                codes = unpacked(batch.column("codes")[i].as_py(), n, np.uint32)
                known = batch.column("known")[i].values
                pos, ids, c, before = (np.asarray(known.field(x)) for x in ("pos", "id", "c", "before"))
                order = np.argsort(ids)
                local = np.zeros(int(codes.max(initial=0)) + 1, np.int64)
                local[pos[order] + 1] = np.arange(1, len(ids) + 1)
                columns, counts = records(local[codes])
                if not len(counts):
                    continue
                ids, c, before = ids[order], c[order], before[order]
                whole = lambda x: np.concatenate(([0.0], x / all_words))
                inner = lambda x: np.concatenate(([0.0], END_SHARE + (1 - END_SHARE) * ((x - lo) / size)))
                upto = inner(before + c)
                upto[0] = END_SHARE
                x = code_points(columns, whole(before), whole(before + c), inner(before), upto)
                part = np.minimum((x * ranges).astype(np.int64), ranges - 1)
                name = np.concatenate(([0], ids))
                edges = np.flatnonzero(np.diff(part, prepend=-1))
                to = np.append(edges[1:], len(part))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(part[edges]), pa.array([lang] * len(edges)), pa.array(to - edges),
                     *(pa.array([packed(np.ascontiguousarray(name[c_[a:b]])) for a, b in zip(edges, to)], pa.binary())
                       for c_ in columns),
                     pa.array([packed(np.ascontiguousarray(counts[a:b])) for a, b in zip(edges, to)], pa.binary())],
                    names=["part", "lang", "n", *WORDS, "counts"])

    def count(group: pa.Table) -> pa.Table:
        sizes = group.column("n").to_pylist()
        read = lambda c: np.concatenate([unpacked(x.as_py(), n, np.int64)
                                         for x, n in zip(group.column(c), sizes)])
        columns, counts = [read(c) for c in WORDS], read("counts")
        lang = np.repeat(np.arange(len(sizes)), sizes)
        order = sort_order(columns)
        columns, counts, lang = [c[order] for c in columns], counts[order], lang[order]
        out = []
        for at, length, f in phrase_counts(columns, counts, least):
            out.append(pa.table([group.column("lang").take(pa.array(lang[at])),
                                 *(pa.array(c[at] if k < length else np.zeros(len(at), np.int64))
                                   for k, c in enumerate(columns)), pa.array(f)], names=["lang", *WORDS, "f"]))
        return pa.concat_tables(out)

    phrases = asked.mapInArrow(grams, "part long, lang string, n long, " + ", ".join(
        f"{c} binary" for c in (*WORDS, "counts"))) \
        .groupBy("part").applyInArrow(count, "lang string, " + ", ".join(f"{c} long" for c in (*WORDS, "f"))) \
        .groupBy("lang", *WORDS).agg(F.sum("f").alias("f")).where(F.col("f") >= least)
    single = vocabulary.select("lang", F.col("id").alias("w1"), *(F.lit(0).cast("long").alias(c) for c in WORDS[1:]),
                               F.col("c").alias("f"))
    path = scratch_path(spark, "collocation_phrases")
    phrases.unionByName(single).write.parquet(path)
    stream = spark.read.parquet(path)

    # -------------------------------------------- prefix and suffix order
    forward = ordered_pass(stream, WORDS, "left")
    backward = [f"b{k + 1}" for k in range(MOST)]
    filled = F.filter(F.array(*WORDS), lambda x: x > 0)
    turned = F.concat(F.reverse(filled), F.array_repeat(F.lit(0).cast("long"), F.lit(MOST) - F.size(filled)))
    both = ordered_pass(forward.withColumn("turned", turned).select(
        *(F.col("turned")[k].alias(c) for k, c in enumerate(backward)),
        *(c for c in forward.columns)), backward, "right")
    size = sum((F.col(c) > 0).cast("int") for c in WORDS)
    longer = F.greatest("left_ext", "right_ext")
    kept_ = both.where((F.col("w2") > 0) & (longer * 100 < F.col("f") * absorb)) \
        .join(per_language(n_of), "lang") \
        .select("lang", *WORDS, F.col("f").alias("a"), "n", size.alias("size"),
                *(f"left{k}" for k in range(1, MOST)), *(f"right{k}" for k in range(1, MOST)))

    def score(batches):
        for batch in batches:
            length = np.asarray(batch.column("size"))
            left = np.stack([np.asarray(batch.column(f"left{k}")) for k in range(1, MOST)], axis=1)
            right = np.stack([np.asarray(batch.column(f"right{k}")) for k in range(1, MOST)], axis=1)
            # the cut after k words leaves size - k on the right
            back = np.clip(length[:, None] - np.arange(2, MOST + 1), 0, MOST - 2)
            right = np.where(left > 0, np.take_along_axis(right, back, axis=1), 0)
            best, l_, r_ = scores(batch.column("a").to_pylist(), batch.column("n").to_pylist(),
                                  left.tolist(), right.tolist())
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("lang", *WORDS, "a", "n")), pa.array(l_, pa.int64()),
                 pa.array(r_, pa.int64()), pa.array(best, pa.int64())],
                names=["lang", *WORDS, "a", "n", "l", "r", "score"])

    scored = kept_.mapInArrow(score, "lang string, " + ", ".join(
        f"{c} long" for c in (*WORDS, "a", "n", "l", "r", "score")))
    # ranked twice, ties kept: a language's phrases never meet in one task
    by = [F.col("score").desc(), F.col("a").desc()]
    for keys in (["lang", F.pmod(F.xxhash64(*WORDS), F.lit(64))], ["lang"]):
        scored = scored.withColumn("place", F.rank().over(Window.partitionBy(*keys).orderBy(*by))) \
            .where(F.col("place") <= top)
    path = scratch_path(spark, "collocation_best")
    scored.drop("place").write.parquet(path)
    best = spark.read.parquet(path)
    named = best.select(*WORDS, F.posexplode(F.filter(F.array(*WORDS), lambda x: x > 0)).alias("pos", "id")) \
        .join(vocabulary.select("id", "word"), "id").groupBy(*WORDS) \
        .agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("pos", "word"))),
                                      lambda x: x["word"]), " ").alias("phrase"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*by, "phrase"))
    return best.join(named, WORDS).withColumn("rank", rank).where(F.col("rank") <= top) \
        .select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
