"""Hard negatives of labelled vectors by angular triangle filtering.

Every row stores its norm and its angles to a few reference directions.  Inside
a block, rows are sorted by label, nearest direction and angle and cut into
windows; a window keeps the range of its norms and of its angles to every
direction.  For an anchor at angle a and a window at angles lo..hi to the same
direction the triangle inequality bounds the angle between them to
max(a - hi, lo - a, 0) .. min(a + hi, 2 pi - a - lo, pi); the best bounds over
all directions give an interval of cosines, and with the norms an interval of
scores, widened beyond every rounding error.  Only windows whose interval meets
what the anchor still asks for are scored, in whole numbers.

Two passes over a grid of anchor blocks and row blocks (dealt by hash, so no
label is a hot key): the best same-label rows of each anchor, then for each of
these positives the best rows of other labels within its score range.  The
bests of all row blocks are merged per anchor and positive.

The reference directions come from the 256 rows with the smallest hash of their
id (farthest first); they steer only how much is skipped, never the result.

Defined results: rows with a null id, label or vector, or a null or non-finite
component, take no part; vectors of unequal length count as zero-filled; zero
vectors score zero; rows of the anchor's own id are neither its positives nor
its negatives; equal anchor rows are searched once; repeated rows each take a
rank, as positive (then with negatives each) and as negative; a positive with a
negative score has an empty range; sums beyond a long are compared exactly and
returned as the nearest long; extra columns are ignored; an empty table gives
no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.topk import HIGHEST, LOWEST, beyond, dense, exact_type
from quarry.session import scratch_path

#: Below the score of any two vectors of doubles.
NONE = -(10**700)
#: Far above the rounding of a dot product, a norm and an arc cosine in doubles.
SLACK = 1e-6


def whole_score(score: int, bytes_: bytes) -> int:
    """The score that ``beyond`` put into bytes, or the long itself."""
    if not bytes_:
        return score
    size = int.from_bytes(bytes_[:4], "big")
    if score > 0:
        return int.from_bytes(bytes_[4:], "big")
    return -int.from_bytes(bytes(255 - b for b in bytes_[4:]), "big") if size else 0


def norms_and_angles(vectors: np.ndarray, directions: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Norm of each row and its angle to each direction; zero rows are at 0."""
    v = vectors.astype(float) if vectors.dtype != object else np.array(
        [[float(x) if abs(x) < 1 << 1000 else np.inf for x in r] for r in vectors]).reshape(vectors.shape)
    width = max(v.shape[1], directions.shape[1])
    v = np.pad(v, ((0, 0), (0, width - v.shape[1])))
    d = np.pad(directions, ((0, 0), (0, width - directions.shape[1])))
    top = np.abs(v).max(axis=1, initial=0.0)
    with np.errstate(all="ignore"):
        unit = v / np.where(top > 0, top, 1)[:, None]
        size = np.sqrt((unit * unit).sum(axis=1))
        cosine = unit @ d.T / np.where(size > 0, size, 1)[:, None]
        angles = np.where(top[:, None] > 0, np.arccos(np.clip(cosine, -1, 1)), 0.0)
        return size * top, angles


def choose_directions(sample: np.ndarray, most: int) -> np.ndarray:
    """Unit vectors among the sample, each as far from the earlier ones as can be."""
    if sample.dtype == object:
        sample = np.zeros((0, sample.shape[1]))
    size = np.sqrt((sample * sample).sum(axis=1))
    unit = sample[(size > 0) & np.isfinite(size)]
    unit = unit / np.sqrt((unit * unit).sum(axis=1))[:, None]
    picked: list[int] = []
    nearest = np.full(len(unit), -np.inf)
    while len(picked) < min(most, len(unit)):
        k = int(np.argmin(nearest)) if picked else 0
        if picked and nearest[k] > 1 - 1e-9:
            break
        picked.append(k)
        nearest = np.maximum(nearest, unit @ unit[k])
    return unit[picked]


class Block:
    """Rows in windows of one label each, with what their angles and norms allow."""

    def __init__(self, ids, labels, rows, norms, angles, size: int):
        near = angles.argmin(axis=1) if angles.shape[1] else np.zeros(len(ids), np.int64)
        at = angles[np.arange(len(ids)), near] if angles.shape[1] else norms
        order = np.lexsort((ids, at, near, labels))
        self.ids, self.labels, self.rows = ids[order], labels[order], rows[order]
        norms, angles, near = norms[order], angles[order], near[order]
        n = len(ids)
        new = np.ones(n, bool)
        new[1:] = (self.labels[1:] != self.labels[:-1]) | (near[1:] != near[:-1])
        group = np.flatnonzero(new)
        place = np.arange(n) - np.repeat(group, np.diff(np.append(group, n)))
        self.starts = np.flatnonzero(place % size == 0)
        self.ends = np.append(self.starts[1:], n)
        self.label = self.labels[self.starts]
        fold = lambda f, x: f.reduceat(x, self.starts, axis=0)
        self.low, self.high = fold(np.minimum, angles), fold(np.maximum, angles)
        self.least, self.most = fold(np.minimum, norms), fold(np.maximum, norms)
        rank = np.empty(n, np.int64)                 # equal ids keep their order in the block
        rank[np.argsort(self.ids, kind="stable")] = np.arange(n)
        self.tie = n - 1 - rank
        self.sorted_ids = np.argsort(self.ids, kind="stable")

    def bounds(self, norms: np.ndarray, angles: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(least, greatest) score of each anchor with any row of each window."""
        near = np.zeros((len(norms), len(self.starts)))
        far = np.full(near.shape, np.pi)
        for k in range(angles.shape[1]):
            a, lo, hi = angles[:, k, None], self.low[None, :, k], self.high[None, :, k]
            np.maximum(near, np.maximum(a - hi, lo - a), out=near)
            np.minimum(far, np.minimum(a + hi, 2 * np.pi - a - lo), out=far)
        low, high = np.cos(np.minimum(far, np.pi)), np.cos(np.minimum(near, np.pi))
        with np.errstate(all="ignore"):
            most, least = norms[:, None] * self.most, norms[:, None] * self.least
            low = np.where(low < 0, low * most, low * least)
            high = np.where(high < 0, high * least, high * most)
            room = most * SLACK + 1
            low, high = low - room, high + room
        return np.where(np.isnan(low), -np.inf, low), np.where(np.isnan(high), np.inf, high)

    def keys(self, ids, rows: np.ndarray, window: int, kind) -> np.ndarray:
        """score * n + tie of every (anchor, row of the window); an anchor's own id is lowest."""
        a, b = self.starts[window], self.ends[window]
        n = len(self.ids)
        if kind is np.float64:                       # every partial sum is a whole number below 2**53
            scores = np.rint(rows @ self.rows[a:b].T).astype(np.int64)
        else:
            scores = rows.dot(self.rows[a:b].T)
        keys = scores * n + self.tie[a:b]
        keys[ids[:, None] == self.ids[a:b]] = none_of(keys)
        return keys


def as_kind(block: Block, rows: np.ndarray):
    """(type in which all scores are exact, the anchors' rows in it); the block's rows change to it."""
    width = max(rows.shape[1], block.rows.shape[1])
    kind = exact_type(rows, block.rows, len(block.ids))

    def whole(x):
        x = np.concatenate((x, np.zeros((len(x), width - x.shape[1]), x.dtype)), axis=1)
        if kind is object:
            return np.array([[int(c) for c in r] for r in x], object).reshape(x.shape)
        return x.astype(np.float64 if kind is not np.int64 else kind)
    block.rows = whole(block.rows)
    return (np.float64 if kind is np.int32 else kind), whole(rows)


def best_of(keys: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of the k greatest keys of each row, without the lowest ones."""
    take = min(k, keys.shape[1])
    if keys.dtype == object:
        cols = np.argsort(keys, axis=1)[:, keys.shape[1] - take:]
    else:
        cols = np.argpartition(keys, keys.shape[1] - take, axis=1)[:, keys.shape[1] - take:]
    rows = np.repeat(np.arange(len(keys)), take)
    cols = cols.ravel()
    real = np.array(keys[rows, cols] > none_of(keys), bool)
    return rows[real], cols[real]


def none_of(keys: np.ndarray) -> int:
    """The key that stands for no row."""
    return NONE if keys.dtype == object else LOWEST


def lowest(n: int, m: int, kind) -> np.ndarray:
    return np.full((n, m), NONE, object) if kind is object else np.full((n, m), LOWEST, np.int64)


def below(x: int) -> float:
    """A double that is certainly not above x."""
    x = float(min(x, 10**300)) if x > -10**300 else -np.inf
    return x - abs(x) * 1e-12 - 1 if x > -np.inf else x


def best_positives(block: Block, ids, labels, rows, norms, angles, k: int, chunk: int):
    """(anchor, row, key) of the k best rows of the anchor's label."""
    kind, rows = as_kind(block, rows)
    n, step = len(block.ids), max(1, chunk // max(len(block.ids), 1))
    for lo in range(0, len(ids), step):
        part = slice(lo, lo + step)
        own = rows[part]
        _, high = block.bounds(norms[part], angles[part])
        keys = lowest(len(own), n, kind)
        best = lowest(len(own), k, kind)
        kth = np.full(len(own), -np.inf)
        for w in np.argsort(-high.max(axis=0), kind="stable"):
            ask = np.flatnonzero((labels[part] == block.label[w]) & (high[:, w] >= kth))
            if len(ask):
                found = block.keys(ids[part][ask], own[ask], w, kind)
                keys[ask, block.starts[w]:block.ends[w]] = found
                both = np.sort(np.concatenate((best[ask], found), axis=1), axis=1)[:, -k:]
                best[ask] = both
                kth[ask] = [below(int(x) // n) if x > none_of(both) else -np.inf for x in both[:, 0]]
        at, cols = best_of(keys, k)
        yield at + lo, cols, keys[at, cols]


def best_negatives(block: Block, ids, labels, rows, norms, angles, ranges, k: int, chunk: int):
    """(anchor, slot, row, key) of the k best rows of other labels in each of
    the anchor's score ranges (lo, hi)."""
    kind, rows = as_kind(block, rows)
    n, step = len(block.ids), max(1, chunk // max(len(block.ids), 1))
    slots = max((len(r) for r in ranges), default=0)
    limit = 10**690 if kind is object else 2**62 // max(n, 1)
    clip = lambda x: min(max(x, -limit), limit)
    los = np.array([[clip(r[p][0]) if p < len(r) else 1 for p in range(slots)] for r in ranges], object)
    his = np.array([[clip(r[p][1]) if p < len(r) else 0 for p in range(slots)] for r in ranges], object)
    los, his = los.reshape(len(ranges), slots), his.reshape(len(ranges), slots)
    if kind is not object:
        los, his = los.astype(np.int64), his.astype(np.int64)
    least = np.array([[below(x) for x in r] for r in los.tolist()]).reshape(los.shape)
    most = np.array([[-below(-x) for x in r] for r in his.tolist()]).reshape(his.shape)
    some = np.array(los <= his, bool)
    for lo in range(0, len(ids), step):
        part = slice(lo, lo + step)
        own = rows[part]
        low, high = block.bounds(norms[part], angles[part])
        keys = lowest(len(own), n, kind)
        for w in range(len(block.starts)):
            meets = (some[part] & (high[:, w, None] >= least[part]) & (low[:, w, None] <= most[part])).any(axis=1)
            ask = np.flatnonzero(meets & (labels[part] != block.label[w]))
            if len(ask):
                keys[ask, block.starts[w]:block.ends[w]] = block.keys(ids[part][ask], own[ask], w, kind)
        for p in range(slots):
            first, last = los[part, p] * n, his[part, p] * n + (n - 1)
            inside = np.array((keys >= first[:, None]) & (keys <= last[:, None]) & (keys > none_of(keys)), bool)
            at, cols = best_of(np.where(inside, keys, none_of(keys)), k)
            yield at + lo, np.full(len(at), p), cols, keys[at, cols]


SCORE = "score long, beyond binary"


def score_columns(keys, n: int) -> list[pa.Array]:
    scores = [int(x) // n for x in keys]
    return [pa.array([min(max(s, LOWEST), HIGHEST) for s in scores], pa.int64()),
            pa.array([beyond(s) for s in scores], pa.binary())]


def mine_negatives(vectors: DataFrame, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90,
                   scale: float = 256.0, every: int = 100, relabel_every: int = 7, classes: int = 10,
                   directions: int = 8, window: int = 64, anchor_block: int = 32768, row_block: int = 32768,
                   id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score:
    for each anchor (id divisible by ``every``) and each of its best
    ``positives``, the best ``negatives`` whose score lies between ``low`` and
    ``high`` percent of the positive's.  ``relabel_every`` 0 keeps all labels."""
    spark, chunk = vectors.sparkSession, 1 << 22
    own, vec, label = F.col(id_col).cast("long"), F.col(vec_col).cast("array<double>"), F.col(label_col).cast("long")
    good = own.isNotNull() & label.isNotNull() & vec.isNotNull() & F.forall(
        vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    if relabel_every:
        label = F.when(own % relabel_every == 0, (label + 1) % classes).otherwise(label)
    rows = vectors.where(F.coalesce(good, F.lit(False))).select(
        own.alias("id"), label.alias("label"), vec.alias("v"))
    sample = rows.select("id", "v").withColumn("h", F.xxhash64("id")).orderBy("h", "id").limit(256).toArrow()
    refs = choose_directions(dense(sample.column("v").combine_chunks(), scale)
                             if sample.num_rows else np.zeros((0, 1)), directions)

    def angles_of(batches):
        for batch in batches:
            if batch.num_rows:
                norms, angles = norms_and_angles(dense(batch.column("v"), scale), refs)
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(norms), pa.array([a.tobytes() for a in angles], pa.binary())],
                    names=["id", "label", "v", "norm", "angles"])

    path_of_rows = scratch_path(spark, "vector_angles")
    rows.mapInArrow(angles_of, "id long, label long, v array<double>, norm double, angles binary") \
        .withColumn("variant", F.xxhash64("id", "label", F.col("v").cast("string"))).write.parquet(path_of_rows)
    rows = spark.read.parquet(path_of_rows)
    is_anchor = F.col("id") % every == 0
    total, asked = rows.agg(F.count("*"), F.count(F.when(is_anchor, 1))).first()
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    row_blocks = max(-(-total // row_block), min(total // 2048, tasks), 1)
    anchor_blocks = max(-(-asked // anchor_block), 1)
    group = (F.col("ab") * F.lit(row_blocks) + F.col("rb")).alias("g")
    place = F.xxhash64("variant", F.lit(1))

    def all_blocks(n):
        return F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))

    def base_groups():
        return spark.read.parquet(path_of_rows).withColumn("rb", F.pmod(place, F.lit(row_blocks))) \
            .withColumn("ab", all_blocks(anchor_blocks)) \
            .select(group, "id", "label", "v", "norm", "angles").groupBy("g")

    anchors = rows.where(is_anchor).dropDuplicates(["id", "variant"])

    def dealt(table: DataFrame, *more: str) -> DataFrame:
        return table.withColumn("ab", F.pmod(place, F.lit(anchor_blocks))).withColumn("rb", all_blocks(row_blocks)) \
            .select(group, "id", "variant", "label", "v", "norm", "angles", *more)

    def read(t: pa.Table):
        angles = np.frombuffer(b"".join(x.as_py() for x in t.column("angles")), float)
        return (np.asarray(t.column("id")), np.asarray(t.column("label")),
                dense(t.column("v").combine_chunks(), scale), np.asarray(t.column("norm")),
                angles.reshape(t.num_rows, -1))

    def search(found, variant, ids, block, extra=()):
        """The best rows that ``found`` yields, as a table."""
        parts = []
        for *at, cols, keys in found:
            parts.append(pa.table(
                [pa.array(ids[at[0]]), pa.array(variant[at[0]]), *(pa.array(x, pa.int64()) for x in at[1:]),
                 pa.array(block.ids[cols]), *score_columns(keys, len(block.ids))],
                names=["anchor_id", "variant", *extra, "other", "score", "beyond"]))
        return parts

    def nothing(extra=()):
        return pa.table({n: pa.array([], pa.binary() if n == "beyond" else pa.int64())
                         for n in ("anchor_id", "variant", *extra, "other", "score", "beyond")})

    def find_positives(asked_: pa.Table, held: pa.Table) -> pa.Table:
        if not asked_.num_rows or not held.num_rows:
            return nothing()
        block, ask = Block(*read(held), window), read(asked_)
        return pa.concat_tables([nothing(), *search(best_positives(block, *ask, positives, chunk),
                                                    np.asarray(asked_.column("variant")), ask[0], block)])

    def find_negatives(asked_: pa.Table, held: pa.Table) -> pa.Table:
        if not asked_.num_rows or not held.num_rows:
            return nothing(["slot"])
        block, ask, ranges = Block(*read(held), window), read(asked_), []
        for found in asked_.column("found").to_pylist():
            own_ = [whole_score(p["score"], p["beyond"]) for p in found]
            ranges.append([(-(-low * s // 100), high * s // 100) for s in own_])
        return pa.concat_tables([nothing(["slot"]), *search(
            best_negatives(block, *ask, ranges, negatives, chunk),
            np.asarray(asked_.column("variant")), ask[0], block, ["slot"])])

    one = dealt(anchors).groupBy("g").cogroup(base_groups()).applyInArrow(
        find_positives, f"anchor_id long, variant long, other long, {SCORE}")
    best = [F.col("score").desc(), F.col("beyond").desc(), F.col("other")]
    place_of = F.row_number().over(Window.partitionBy("anchor_id", "variant").orderBy(*best))
    one = one.withColumn("slot", (place_of - 1).cast("long")).where(F.col("slot") < positives)
    path = scratch_path(spark, "vector_positives")
    one.write.parquet(path)
    one = spark.read.parquet(path)
    lists = one.groupBy("anchor_id", "variant").agg(
        F.sort_array(F.collect_list(F.struct("slot", "score", "beyond"))).alias("found")) \
        .withColumnRenamed("anchor_id", "id")
    two = dealt(anchors.join(lists, ["id", "variant"]), "found").groupBy("g").cogroup(base_groups()).applyInArrow(
        find_negatives, f"anchor_id long, variant long, slot long, other long, {SCORE}")
    two = two.withColumn("rank", F.row_number().over(
        Window.partitionBy("anchor_id", "variant", "slot").orderBy(*best))).where(F.col("rank") <= negatives)
    named = one.select("anchor_id", "variant", "slot", F.col("other").alias("positive_id"),
                       F.col("score").alias("positive_score"))
    return two.join(named, ["anchor_id", "variant", "slot"]).select(
        "anchor_id", "positive_id", "rank", F.col("other").alias("negative_id"), "positive_score",
        F.col("score").alias("negative_score"))


SQL = """
WITH e AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::DOUBLE) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, c.vec_id AS other, a.label = c.label AS same,
         list_dot_product(a.v, c.v)::BIGINT AS score
  FROM e a JOIN e c ON a.vec_id % 100 = 0 AND a.vec_id <> c.vec_id),
p AS (
  SELECT anchor_id, other AS positive_id, score AS positive_score FROM (
    SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) AS place FROM s WHERE same)
  WHERE place <= 5)
SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score FROM (
  SELECT p.anchor_id, positive_id, other AS negative_id, positive_score, score AS negative_score,
         row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, other) AS rank
  FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT same
    AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score)
WHERE rank <= 10"""
