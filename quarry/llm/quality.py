"""Document quality by histogram gradient-boosted trees over text statistics.

The statistics of a batch come from its bytes and its word and line codes, all
in numpy.  The trees are grown on a bounded sample of labelled documents
(``max_train_rows``, chosen by hash of the id) from per-node histograms of
binned features, flattened into arrays of a complete binary tree each, and all
trees walk all rows of a batch together.

Defined results: a null or empty text counts as one empty line and is scored
like any other; a null id stays null and is never learnt from; labels that are
null, or that contradict each other for one document, teach nothing; without
usable labels every score is 0.5, with one class only it is that class's
smoothed share; repeated rows are scored each on their own.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from quarry.llm.ragged import nothing_kept, segment_sums, split_codes, text_slices, texts_of

LOWER, UPPER, DIGIT, BLANK, STOP, QUOTE, SYMBOL, WIDE, TAIL = range(9)


def byte_classes() -> np.ndarray:
    """Class of each UTF-8 byte."""
    out = np.full(256, SYMBOL, np.uint8)
    for kind, members in ((LOWER, b"abcdefghijklmnopqrstuvwxyz"), (UPPER, b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
                          (DIGIT, b"0123456789"), (BLANK, b" \t\r\n"), (STOP, b".,;:?!"),
                          (QUOTE, b"'\"()-")):
        out[list(members)] = kind
    out[128:192], out[192:] = TAIL, WIDE
    return out


CLASSES = byte_classes()


def repetition(codes: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """Per text: parts, distinct parts, count of the most frequent one,
    entropy of the parts, parts equal to the one before."""
    n = np.diff(offsets)
    doc = np.repeat(np.arange(len(n)), n)
    span = int(codes.max(initial=0)) + 1
    key = np.sort(doc * span + codes)
    first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))) if len(key) else np.zeros(0, int)
    count = np.diff(np.append(first, len(key)))
    owner = key[first] // span
    distinct = np.bincount(owner, minlength=len(n))
    top = np.zeros(len(n), np.int64)
    np.maximum.at(top, owner, count)
    spread = np.bincount(owner, count * np.log(count), len(n))
    with np.errstate(divide="ignore", invalid="ignore"):
        entropy = np.where(n > 0, np.log(np.maximum(n, 1)) - spread / np.maximum(n, 1), 0)
    same = np.zeros(len(codes), np.int64)
    same[1:] = (codes[1:] == codes[:-1]) & (doc[1:] == doc[:-1])
    return n, distinct, top, entropy, segment_sums(same, offsets)


def statistics(texts: pa.Array) -> np.ndarray:
    """One row of document statistics per text."""
    rows = len(texts)
    blob = pa.chunked_array([texts]).combine_chunks() if texts.offset else texts
    ends = np.frombuffer(blob.buffers()[1], np.int32, rows + 1 + blob.offset)[blob.offset:].astype(np.int64)
    data = np.frombuffer(blob.buffers()[2] or b"", np.uint8)[ends[0]:ends[-1]]
    at = ends - ends[0]
    kinds = CLASSES[data]
    owner = np.repeat(np.arange(rows) * 16, np.diff(at))
    counts = np.bincount(owner + kinds, minlength=rows * 16).reshape(rows, 16).astype(float)
    marks = (data[1:] == data[:-1]) & ((kinds[1:] == SYMBOL) | (kinds[1:] == STOP))
    double = np.bincount(owner[1:][marks] >> 4, minlength=rows)
    chars = np.maximum(counts.sum(1) - counts[:, TAIL], 1)

    codes, offsets, words = split_codes(pc.replace_substring(texts, "\n", " "))
    real = np.fromiter(map(bool, words), bool, len(words))[codes]
    offsets = np.concatenate(([0], np.cumsum(real)))[offsets]
    codes = codes[real]
    n, distinct, top, entropy, same = repetition(codes, offsets)
    n1 = np.maximum(n, 1)
    size = np.fromiter(map(len, words), np.int64, len(words))
    flags = np.array([(w.isupper() and len(w) > 1, not any(map(str.isalpha, w)), w[:1].isupper(),
                       w[-1:].isalnum()) for w in words], bool).reshape(len(words), 4)
    per_word = [segment_sums(x[codes], offsets) / n1 for x in
                (size, size ** 2, size > 12, *(flags[:, i] for i in range(4)))]
    pair = np.zeros(len(codes), np.int64)
    pair[1:] = codes[:-1] * (len(words) + 1) + codes[1:]
    pairs = repetition(pa.array(pair).dictionary_encode().indices.to_numpy().astype(np.int64), offsets)

    lcodes, loffsets, _ = split_codes(texts, "\n")
    lines, ldistinct, ltop, _, _ = repetition(lcodes, loffsets)
    columns = [np.log1p(chars * (counts.sum(1) > 0)), np.log1p(n), *(counts[:, :8] / chars[:, None]).T,
               double / chars, distinct / n1, top / n1, entropy / np.log(np.maximum(n, 2)), same / n1,
               pairs[1] / n1, pairs[2] / n1, *per_word, np.log1p(lines), ldistinct / np.maximum(lines, 1),
               ltop / np.maximum(lines, 1), chars / np.maximum(lines, 1)]
    return np.stack(columns, axis=1) if rows else np.zeros((0, len(columns)))


@dataclass
class Trees:
    """Flattened boosted trees: node j of a tree has children 2j+1 and 2j+2; a
    row goes right where its feature is over the threshold."""
    prior: float
    feature: np.ndarray      # trees x inner nodes
    threshold: np.ndarray    # trees x inner nodes
    value: np.ndarray        # trees x leaves

    def scores(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.prior)
        if len(self.feature):
            row, tree = np.arange(len(x))[:, None], np.arange(len(self.feature))[None, :]
            node = np.zeros((len(x), len(self.feature)), np.int64)
            inner = self.feature.shape[1]
            while node.size and node[0, 0] < inner:
                right = x[row, self.feature[tree, node]] > self.threshold[tree, node]
                node = 2 * node + 1 + right
            if node.size:
                out = out + self.value[tree, node - inner].sum(1)
        return 1 / (1 + np.exp(-out))


def grow_trees(x: np.ndarray, y: np.ndarray, rounds: int = 80, depth: int = 4, bins: int = 64,
               rate: float = 0.15, ridge: float = 1.0, least: float = 5.0) -> Trees:
    """Histogram gradient boosting of the logistic loss."""
    inner = (1 << depth) - 1
    n = len(y)
    share = (y.sum() + 0.5) / (n + 1)
    prior = float(np.log(share / (1 - share)))
    none = Trees(prior, np.zeros((0, inner), np.int64), np.zeros((0, inner)), np.zeros((0, inner + 1)))
    if n == 0 or y.min() == y.max():
        return none
    edges = [np.unique(np.quantile(c, np.linspace(0, 1, bins + 1)[1:-1])) for c in x.T]
    binned = np.stack([np.searchsorted(e, c, "left") for e, c in zip(edges, x.T)])   # feature x row
    limits = np.full((x.shape[1], bins), np.inf)
    for f, e in enumerate(edges):
        limits[f, :len(e)] = e
    raw, out = np.full(n, prior), []
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-raw))
        grad, hess = p - y, p * (1 - p)
        feature, threshold = np.zeros(inner, np.int64), np.full(inner, np.inf)
        node = np.zeros(n, np.int64)
        for level in range(depth):
            width = 1 << level
            best = np.full(width, 1e-9)
            choice = np.zeros((width, 2), np.int64) - 1
            for f in range(x.shape[1]):
                key = node * bins + binned[f]
                g = np.bincount(key, grad, width * bins).reshape(width, bins)
                h = np.bincount(key, hess, width * bins).reshape(width, bins)
                gl, hl = g.cumsum(1), h.cumsum(1)
                ga, ha = gl[:, -1:], hl[:, -1:]
                gain = gl ** 2 / (hl + ridge) + (ga - gl) ** 2 / (ha - hl + ridge) - ga ** 2 / (ha + ridge)
                gain[(hl < least / 4) | (ha - hl < least / 4) | ~np.isfinite(limits[f])] = 0
                at = gain.argmax(1)
                top = gain[np.arange(width), at]
                better = top > best
                best[better] = top[better]
                choice[better, 0], choice[better, 1] = f, at[better]
            right = np.zeros(n, bool)
            for j in np.flatnonzero(choice[:, 0] >= 0):
                f, b = choice[j]
                feature[width - 1 + j], threshold[width - 1 + j] = f, limits[f, b]
                right |= (node == j) & (binned[f] > b)
            node = 2 * node + right
        value = -rate * np.bincount(node, grad, inner + 1) / (np.bincount(node, hess, inner + 1) + ridge)
        raw = raw + value[node]
        out.append((feature, threshold, value))
    return Trees(prior, *(np.stack(part) for part in zip(*out)))


def remainder(id_col: Column | str, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``."""
    return F.crc32(F.col(id_col).cast("string") if isinstance(id_col, str) else id_col) % folds


def fit_quality(docs: DataFrame, labels: DataFrame, max_train_rows: int = 20_000, folds: int = 5,
                held_fold: int = 0, id_col: str = "doc_id", text_col: str = "text",
                label_col: str = "quality") -> Trees:
    """Trees grown on at most ``max_train_rows`` labelled documents whose id is
    not in the held-out fold.  Only their ids, labels and statistics meet on
    the driver (both bounded by that number)."""
    own = labels.select(F.col(id_col).alias("k"), F.col(label_col).cast("double").alias("y")) \
        .where("k IS NOT NULL AND y IS NOT NULL").where(remainder("k", folds) != held_fold)
    sample = own.groupBy("k").agg(F.min("y").alias("y"), F.max("y").alias("high")) \
        .where("y = high").drop("high").orderBy(F.xxhash64("k"), "k").limit(max_train_rows)
    schema = "y double, h long, x array<double>"

    def run(batches):
        nothing_kept()
        for batch in batches:
            for part in text_slices(batch, "text"):
                x = statistics(texts_of(part, "text"))
                yield pa.RecordBatch.from_arrays(
                    [part.column("y"), part.column("h"), pa.array(list(x), pa.list_(pa.float64()))],
                    names=["y", "h", "x"])

    # the sample has at most max_train_rows rows of an id and a number
    learnt = docs.select(F.col(id_col).alias("k"), F.col(text_col).cast("string").alias("text")) \
        .join(F.broadcast(sample), "k").select("y", F.xxhash64("k", "text").alias("h"), "text") \
        .mapInArrow(run, schema).orderBy("h", "y").limit(max_train_rows).toPandas()
    if not len(learnt):
        return grow_trees(np.zeros((0, 1)), np.zeros(0))
    return grow_trees(np.stack(learnt["x"]), (learnt["y"].to_numpy() >= 0.5).astype(float))


def score_quality(docs: DataFrame, trees: Trees, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """id and score of every row."""
    schema = StructType([docs.schema[id_col], StructField("score", DoubleType())])

    def run(batches):
        nothing_kept()
        for batch in batches:
            for part in text_slices(batch, text_col, 8 << 20):
                score = trees.scores(statistics(texts_of(part, text_col)))
                yield pa.RecordBatch.from_arrays([part.column(id_col), pa.array(score)],
                                                 names=schema.names)
    return docs.select(F.col(id_col), F.col(text_col).cast("string").alias(text_col)) \
        .mapInArrow(run, schema)


def keep_quality(docs: DataFrame, trees: Trees, least: float = 0.3, text_col: str = "text") -> DataFrame:
    """The rows scored ``least`` or more, with all their columns."""

    def run(batches):
        nothing_kept()
        for batch in batches:
            for part in text_slices(batch, text_col, 8 << 20):
                keep = trees.scores(statistics(texts_of(part, text_col))) >= least
                yield part.filter(pa.array(keep))
    return docs.mapInArrow(run, docs.schema)
