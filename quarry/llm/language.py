"""Language of whole texts by a linear-chain conditional random field.

Words are labelled in order, so a text that switches languages keeps its runs.
A word's evidence is a sum of learned weights of its character n-grams with
word edges (which hold its affixes), of the whole word, and of lexicons of
frequent words; learned transitions tie neighbours together.  Forward-backward
gives each word's chances; a text takes the language with the largest sum.

Training chains are built from a bounded sample of documents: runs of words of
several documents follow each other, so that the transitions learn to switch.

Defined results: a text that is null or has no letter is ``und`` with score 0;
a null id stays null; rows without a language teach nothing; with no teaching
rows every text is ``und``; languages that tie go by name; repeated rows are
predicted each on their own; extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from quarry.llm.ragged import concat_ranges, nothing_kept, segment_sums, split_codes, text_slices, texts_of

GRAMS = (1, 2, 3, 4)
BITS = 18
#: Weights in all: many languages share fewer slots each.
MOST_WEIGHTS = 1 << 25


#: Languages from which on texts go side by side.
WIDE = 32


def slots(languages: int) -> int:
    """Hashed feature slots, a power of two: 2**BITS up to 128 languages."""
    return 1 << max(4, min(BITS, (MOST_WEIGHTS // max(languages, 1)).bit_length() - 1))


def letter_words(words: list[str]) -> np.ndarray:
    return np.fromiter((any(map(str.isalpha, w)) for w in words), bool, len(words))


def word_features(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hashes, offsets, whole): hashed n-grams of each word between edge marks,
    and a hash of the whole word; case is ignored."""
    marked = ["\x02" + w.lower() + "\x03" for w in words]
    sizes = np.fromiter(map(len, marked), np.int64, len(marked))
    points = np.frombuffer("".join(marked).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    starts = np.cumsum(sizes) - sizes
    mult = np.uint64(0x9E3779B97F4A7C15)
    parts = []
    left = sizes.repeat(sizes) - (np.arange(len(points)) - starts.repeat(sizes))   # characters to the word's end
    roll = np.zeros(len(points), np.uint64)
    for n in GRAMS:
        shifted = np.zeros(len(points), np.uint64)
        shifted[:len(points) - n + 1] = points[n - 1:]
        roll = (roll ^ (shifted + np.uint64(n))) * mult
        roll ^= roll >> np.uint64(29)
        parts.append(roll[left >= n] >> np.uint64(64 - BITS))
    # n-grams of a word side by side: those of each length, one length after the other
    count = np.stack([np.maximum(sizes - n + 1, 0) for n in GRAMS], axis=1)
    ends = np.cumsum(count.sum(1))
    offsets = np.concatenate(([0], ends))
    before = (np.cumsum(count, axis=1) - count) + offsets[:-1, None]
    hashes = np.empty(int(ends[-1]) if len(ends) else 0, np.int64)
    for part, c, at in zip(parts, count.T, before.T):
        hashes[concat_ranges(at, c)] = part
    weight = (points + np.uint64(1)) * (mult ** (left.astype(np.uint64) % np.uint64(1 << 16)) | np.uint64(1))
    whole = np.add.reduceat(weight, starts) if len(words) else np.zeros(0, np.uint64)
    return hashes, offsets, whole


@dataclass
class Field:
    """A trained chain: weights of hashed features, lexicons, transitions."""
    languages: list[str]
    weights: np.ndarray        # slots x languages
    lexicon: np.ndarray        # sorted hashes of frequent words
    lexicon_weights: np.ndarray  # lexicon x languages
    start: np.ndarray
    moves: np.ndarray          # log transition scores, from x to

    def evidence(self, words: list[str]) -> np.ndarray:
        """Summed weights of each distinct word, mean over its n-grams."""
        k = len(self.languages)
        out = np.zeros((len(words), k))
        if not words:
            return out
        hashes, offsets, whole = word_features(words)
        hashes &= len(self.weights) - 1
        out += np.add.reduceat(self.weights[hashes], offsets[:-1], dtype=float)
        if len(self.lexicon):
            at = np.minimum(np.searchsorted(self.lexicon, whole), len(self.lexicon) - 1)
            hit = self.lexicon[at] == whole
            out[hit] += self.lexicon_weights[at[hit]]
        return out

    def marginals(self, evidence: np.ndarray, first: np.ndarray,
                  block: int = 256) -> tuple[np.ndarray, np.ndarray]:
        """Chances of each language at each word, and the weight of the word
        and all that follows it given its language; ``first`` marks the words
        that begin a text.  All texts form one chain that starts anew at these
        words; it is cut into blocks whose products are taken together, so the
        length of a text costs no extra rounds."""
        n, k = evidence.shape
        if not n:
            return evidence, evidence
        if k > WIDE:
            return self.by_texts(evidence, first)
        block = max(1, min(block, n))
        rows = -(-n // block)
        e = np.ones((rows * block, k))
        e[:n] = np.exp(evidence - evidence.max(1, keepdims=True)) + 1e-12
        new = np.ones(rows * block, bool)
        new[:n] = first
        # places first: each round works on one contiguous slab of all blocks
        e = np.ascontiguousarray(e.reshape(rows, block, k).transpose(1, 0, 2))
        new = [np.flatnonzero(x) for x in new.reshape(rows, block).T]
        move, start = np.exp(self.moves), np.exp(self.start)
        # products of blocks, then the vector that enters each block
        prod = np.broadcast_to(np.eye(k), (rows, k, k)).copy()
        for t in range(block):
            sums = prod[new[t]].sum(2, keepdims=True)
            prod = (prod.reshape(-1, k) @ move).reshape(rows, k, k)
            prod[new[t]] = sums * start
            prod *= e[t][:, None, :]
            if t % 4 == 3:
                prod /= prod.max((1, 2), keepdims=True)
        prod /= prod.max((1, 2), keepdims=True)
        now = np.empty((rows, k))
        vector = np.full(k, 1 / k)
        for r in range(rows):
            now[r] = vector
            vector = vector @ prod[r]
            vector = vector / vector.sum()
        chance = np.empty((block, rows, k))
        for t in range(block):
            sums = now[new[t]].sum(1, keepdims=True)
            now = now @ move
            now[new[t]] = sums * start
            now *= e[t]
            now /= now.sum(1, keepdims=True)
            chance[t] = now
        # the vector that leaves each block backwards, then every place
        after = np.empty((rows, k))
        vector = np.full(k, 1 / k)
        for r in range(rows - 1, -1, -1):
            after[r] = vector
            vector = prod[r] @ vector
            vector = vector / vector.sum()
        for t in range(block - 1, -1, -1):
            chance[t] *= after
            e[t] *= after                     # the word and all that follows
            after = e[t] @ move.T
            after[new[t]] = (e[t][new[t]] @ start)[:, None]
            after /= after.sum(1, keepdims=True)
        chance /= chance.sum(2, keepdims=True)
        return (chance.transpose(1, 0, 2).reshape(-1, k)[:n], e.transpose(1, 0, 2).reshape(-1, k)[:n])

    def by_texts(self, evidence: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The same for many languages, where products of blocks cost too much:
        all texts step by step side by side, the longest first."""
        n, k = evidence.shape
        starts = np.flatnonzero(first)
        sizes = np.diff(np.append(starts, n))
        order = np.argsort(-sizes, kind="stable")
        starts, sizes = starts[order], sizes[order]
        e = np.exp(evidence - evidence.max(1, keepdims=True)) + 1e-12
        move, chance = np.exp(self.moves), np.empty((n, k))
        now = np.broadcast_to(np.exp(self.start), (len(starts), k))
        for t in range(int(sizes[0])):
            at = starts[:np.searchsorted(-sizes, -t, "left")] + t
            now = (now[:len(at)] if t == 0 else now[:len(at)] @ move) * e[at]
            now /= now.sum(1, keepdims=True)
            chance[at] = now
        after = np.zeros((0, k))
        for t in range(int(sizes[0]) - 1, -1, -1):
            at = starts[:np.searchsorted(-sizes, -t, "left")] + t
            after = np.concatenate((after, np.ones((len(at) - len(after), k))))
            chance[at] *= after
            e[at] *= after
            after = e[at] @ move.T
            after /= after.sum(1, keepdims=True)
        chance /= chance.sum(1, keepdims=True)
        return chance, e

    def predict(self, texts: pa.Array) -> tuple[list[str], np.ndarray]:
        """(language, score) of each text; the score is the mean chance of that
        language over the text's words."""
        n, k = len(texts), len(self.languages)
        codes, offsets, words = text_words(texts)
        if not k or not len(codes):
            return ["und"] * n, np.zeros(n)
        evidence = self.evidence(words)[codes]
        first = np.zeros(len(codes), bool)
        first[offsets[:-1][np.diff(offsets) > 0]] = True
        chance = self.marginals(evidence, first)[0]
        sums = np.stack([segment_sums(chance[:, j], offsets) for j in range(k)], axis=1)
        count = np.diff(offsets)
        best = sums.argmax(1)
        score = np.clip(sums[np.arange(n), best] / np.maximum(count, 1), 0, 1)
        return [self.languages[b] if c else "und" for b, c in zip(best, count)], np.where(count > 0, score, 0)


def text_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """Codes of the words that hold a letter, their offsets, distinct words."""
    codes, offsets, words = split_codes(pc.replace_substring(texts, "\n", " "))
    keep = letter_words(words)[codes]
    return codes[keep], np.concatenate(([0], np.cumsum(keep)))[offsets], words


def train(texts: list[str], langs: list[str], run_words: int = 24, runs_per_chain: int = 4,
          words_per_text: int = 120, epochs: int = 6, rate: float = 0.25, lexicon_words: int = 300,
          chains_per_step: int = 64, seed: int = 7) -> Field:
    """Fit the chain by stochastic gradient (Adagrad) of its log-likelihood."""
    rng = np.random.default_rng(seed)
    languages = sorted(set(langs))
    k = len(languages)
    codes, offsets, words = text_words(pa.array(texts, pa.string()))
    label = np.searchsorted(languages, langs)
    hashes, hoffsets, whole = word_features(words) if words else (np.zeros(0, np.int64), np.zeros(1, np.int64), np.zeros(0, np.uint64))
    hashes &= slots(k) - 1
    field = Field(languages, np.zeros((slots(k), k)), np.zeros(0, np.uint64), np.zeros((0, k)),
                  np.full(k, -np.log(max(k, 1))), np.full((k, k), -np.log(max(k, 1))))
    if k == 0 or not len(codes):
        return Field([], field.weights[:, :0], field.lexicon, field.lexicon_weights, field.start, field.moves)
    # one stretch of words per text, at a random place, cut into runs
    runs, of = [], []
    for i in range(len(texts)):
        lo, hi = offsets[i], offsets[i + 1]
        take = min(hi - lo, words_per_text)
        if take:
            at = lo + rng.integers(0, hi - lo - take + 1)
            for a in range(at, at + take, run_words):
                runs.append((a, min(a + run_words, at + take)))
                of.append(label[i])
    of = np.array(of)
    own = np.concatenate([codes[a:b] for a, b in runs])
    tags = np.repeat(of, [b - a for a, b in runs])
    frequent = [np.argsort(-np.bincount(own[tags == j], minlength=len(words)), kind="stable")[:lexicon_words]
                for j in range(k)]
    field.lexicon, rep = np.unique(whole[np.unique(np.concatenate(frequent))], return_index=True)
    field.lexicon_weights = np.zeros((len(field.lexicon), k))
    in_lexicon = np.minimum(np.searchsorted(field.lexicon, whole), len(field.lexicon) - 1)
    is_lexicon = field.lexicon[in_lexicon] == whole
    squares = [np.full(a.shape, 1e-6) for a in (field.weights, field.lexicon_weights, field.moves, field.start)]
    step = runs_per_chain * chains_per_step
    for _ in range(epochs):
        order = rng.permutation(len(runs))
        for at in range(0, len(order), step):
            part = [runs[i] for i in order[at:at + step]]
            size = np.array([b - a for a, b in part])
            places = concat_ranges(np.array([a for a, _ in part]), size)
            word, tag = codes[places], np.repeat(of[order[at:at + step]], size)
            heads = np.cumsum(size) - size
            first = np.zeros(len(word), bool)
            first[heads[::runs_per_chain]] = True
            uniq, back = np.unique(word, return_inverse=True)
            n_h = hoffsets[uniq + 1] - hoffsets[uniq]
            h = hashes[concat_ranges(hoffsets[uniq], n_h)]
            ev = np.add.reduceat(field.weights[h], np.cumsum(n_h) - n_h)
            lex = is_lexicon[uniq]
            ev[lex] += field.lexicon_weights[in_lexicon[uniq[lex]]]
            chance, ahead = field.marginals(ev[back], first, block=32)
            wrong = chance.copy()
            wrong[np.arange(len(tag)), tag] -= 1
            g_word = np.stack([np.bincount(back, wrong[:, j], len(uniq)) for j in range(k)], axis=1)
            # expected moves less observed ones
            inner = np.flatnonzero(~first)
            g_move = np.zeros((k, k))
            for lo in range(0, len(inner), max(1, (1 << 24) // k ** 2)):
                some = inner[lo:lo + max(1, (1 << 24) // k ** 2)]
                both = np.exp(field.moves)[None] * ahead[some][:, None, :]
                both *= chance[some - 1][:, :, None] / both.sum(2, keepdims=True)
                g_move += both.sum(0)
            np.subtract.at(g_move, (tag[inner - 1], tag[inner]), 1)
            g_start = wrong[first].sum(0)
            scale = 1 / len(word)
            hu, hb = np.unique(h, return_inverse=True)
            owner = np.repeat(np.arange(len(uniq)), n_h)
            g_hash = np.stack([np.bincount(hb, g_word[owner, j], len(hu)) for j in range(k)], axis=1) * scale
            squares[0][hu] += g_hash ** 2
            field.weights[hu] -= rate * g_hash / np.sqrt(squares[0][hu])
            g_lex = np.zeros_like(field.lexicon_weights)
            np.add.at(g_lex, in_lexicon[uniq[lex]], g_word[lex] * scale)
            for target, square, g in ((field.lexicon_weights, squares[1], g_lex),
                                      (field.moves, squares[2], g_move * scale),
                                      (field.start, squares[3], g_start * scale)):
                square += g ** 2
                target -= rate * g / np.sqrt(square)
            field.moves -= np.log(np.exp(field.moves).sum(1, keepdims=True))
            field.start -= np.log(np.exp(field.start).sum())
    field.weights = field.weights.astype(np.float32)
    return field


def fit_language(docs: DataFrame, max_train_rows: int = 4000, folds: int = 4, held_fold: int = 2,
                 id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                 max_train_chars: int = 4000) -> Field:
    """A chain trained on about ``max_train_rows`` documents outside the
    held-out fold, chosen by hash of the id, evenly over all languages, each of
    which gives one at least.  Of each document at most ``max_train_chars``
    characters around the middle are drawn, and a stretch of ``words_per_text``
    (see ``train``) is learnt from; the bound is on the sample only."""
    from quarry.llm.quality import remainder
    rows = docs.select(F.col(id_col).alias("k"), F.col(text_col).cast("string").alias("text"),
                       F.col(lang_col).cast("string").alias("lang")) \
        .where("k IS NOT NULL AND text IS NOT NULL AND lang IS NOT NULL") \
        .where(remainder("k", folds) != held_fold)
    counts = rows.groupBy("lang").agg(F.count("*").alias("n"))
    languages = counts.count()           # the model holds a column for each
    if not languages:
        return train([], [])
    each = max(1, max_train_rows // languages)
    # so many more than needed that no language is left without a row
    share = (F.lit(1.2 * each + 20) / F.col("n") + 1e-9) * 1_000_000
    middle = F.greatest(F.lit(1), ((F.length("text") - max_train_chars) / 2).cast("int"))
    # a row per language, as the model itself has a column for each: far smaller than the model
    drawn = rows.join(F.broadcast(counts), "lang").withColumn("h", F.xxhash64("k")) \
        .where(F.pmod("h", F.lit(1_000_000)) < share) \
        .select("h", "lang", F.substring("text", middle, F.lit(max_train_chars)).alias("text")) \
        .orderBy("h", "text", "lang").limit(2 * (max_train_rows + 22 * languages) + 1000)
    learnt = drawn.toPandas().groupby("lang", sort=True).head(each)
    return train(learnt["text"].tolist(), learnt["lang"].tolist())


def predict_language(docs: DataFrame, field: Field, id_col: str = "doc_id",
                     text_col: str = "text") -> DataFrame:
    """id, lang_pred and score of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(field)   # fixed size: 2**BITS weights per language
    schema = StructType([docs.schema[id_col], StructField("lang_pred", StringType()),
                         StructField("score", DoubleType())])

    def run(batches):
        nothing_kept()
        size = max(1 << 16, (8 << 20) * 16 // max(16, len(shared.value.languages)))
        for batch in batches:
            for part in text_slices(batch, text_col, size):
                lang, score = shared.value.predict(texts_of(part, text_col))
                yield pa.RecordBatch.from_arrays(
                    [part.column(id_col), pa.array(lang, pa.string()), pa.array(score)], names=schema.names)
    return docs.select(F.col(id_col), F.col(text_col).cast("string").alias(text_col)) \
        .mapInArrow(run, schema)
