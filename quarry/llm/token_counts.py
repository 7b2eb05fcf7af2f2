"""Token counts of whole texts under a sentencepiece BPE file.

Distinct words of a batch are laid end to end in numpy arrays, one symbol per
character.  In each round every word that can still merge finds its pair of
lowest rank, and all words apply theirs together; what survives is counted, so
no token strings are ever built.  Counts of words are remembered per worker.

Defined results: a null or empty text has 0 bytes and 0 tokens; a null id stays
null; repeated rows are counted each on their own; extra columns are ignored.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, LongType, StructField, StructType

from quarry.llm.ragged import kept, segment_sums, split_codes, text_slices, texts_of

SPACE = "▁"
CUT = re.compile("(?<=[^▁])(?=▁)")
NEVER = np.int32(2**31 - 1)


class MergeTable:
    """Pairs of a sentencepiece BPE model with their ranks (best score first)."""

    def __init__(self, path: str):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2 as pb
        proto = pb.ModelProto()
        proto.ParseFromString(
            sentencepiece.SentencePieceProcessor(model_file=path).serialized_model_proto())
        norm, kind = proto.normalizer_spec, pb.ModelProto.SentencePiece
        self.check(proto, norm, path)
        pieces = {p.piece: (i, p.score) for i, p in enumerate(proto.pieces)
                  if p.type == kind.NORMAL}
        scores = sorted({s for _, s in pieces.values()}, reverse=True)
        rank = {s: r for r, s in enumerate(scores)}
        self.size = len(proto.pieces) + 1          # the last id is any unknown character
        self.of_char = np.full(0x110000, self.size - 1, np.int32)
        for p, (i, _) in pieces.items():
            if len(p) == 1:
                self.of_char[ord(p)] = i
        keys, into, ranks = [], [], []
        for p, (i, s) in pieces.items():
            if len(p) > 1 and any(self.of_char[ord(c)] == self.size - 1 for c in p):
                raise ValueError(f"{path}: a character of {p!r} is no piece")
            for cut in range(1, len(p)):
                a, b = pieces.get(p[:cut]), pieces.get(p[cut:])
                if a and b:
                    keys.append(a[0] * self.size + b[0])
                    into.append(i)
                    ranks.append(rank[s])
        order = np.argsort(np.array(keys, np.int64))
        self.keys = np.array(keys, np.int64)[order]
        self.into = np.array(into, np.int32)[order]
        self.ranks = np.array(ranks, np.int32)[order]

    @staticmethod
    def check(proto, norm, path) -> None:
        """This counting holds for plain BPE files: text as it is, a space in
        front, bytes for unknown characters, no piece that spans two words."""
        kind = type(proto.pieces[0])
        spans = any(re.search(f"[^{SPACE}]{SPACE}", p.piece) for p in proto.pieces
                    if p.type == kind.NORMAL)
        if (proto.trainer_spec.model_type != 2 or not proto.trainer_spec.byte_fallback
                or norm.precompiled_charsmap or not norm.add_dummy_prefix
                or norm.remove_extra_whitespaces or not norm.escape_whitespaces or spans
                or any(p.type in (kind.USER_DEFINED, kind.UNUSED) for p in proto.pieces)):
            raise ValueError(f"{path}: not a plain BPE file with byte fallback")

    def pairs(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rank, merged id) of pairs; NEVER where the pair is no piece."""
        key = left.astype(np.int64) * self.size + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        hit = self.keys[at] == key
        return np.where(hit, self.ranks[at], NEVER), self.into[at]

    def counts(self, words: list[str]) -> np.ndarray:
        """Tokens of each word by rank-synchronous merging."""
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        points = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)
        word = np.repeat(np.arange(len(words)), sizes)
        sym = self.of_char[points]
        extra = np.where(sym == self.size - 1,
                         (points > 0x7F).astype(np.int64) + (points > 0x7FF) + (points > 0xFFFF), 0)
        total = np.bincount(word, extra, len(words)).astype(np.int64)
        rank = np.full(len(sym), NEVER)
        inner = np.flatnonzero(word[:-1] == word[1:])
        rank[inner] = self.pairs(sym[inner], sym[inner + 1])[0]
        while len(sym):
            first = np.flatnonzero(np.concatenate(([True], word[1:] != word[:-1])))
            length = np.diff(np.append(first, len(sym)))
            low = np.minimum.reduceat(rank, first)
            open_ = low < NEVER
            if not open_.all():                       # finished words are counted and leave
                np.add.at(total, word[first[~open_]], length[~open_])
                stay = np.repeat(open_, length)
                sym, word, rank = sym[stay], word[stay], rank[stay]
                low, length = low[open_], length[open_]
                if not len(sym):
                    break
            sym, word, rank = self.merge(sym, word, rank, np.repeat(low, length))
        return total

    def merge(self, sym, word, rank, low):
        """Each word applies its lowest-rank pair wherever it stands.  Where a
        new pair would rank no later than the one applied, one place after the
        other matters, and that word applies its first place only."""
        chosen = _disjoint(np.flatnonzero(rank == low))
        out = self.applied(sym, word, rank, chosen)
        first = np.concatenate(([True], word[chosen[1:]] != word[chosen[:-1]]))
        if first.all():
            return out[0]
        early = np.isin(word[chosen], out[1](low))
        if early.any():
            out = self.applied(sym, word, rank, chosen[first | ~early])
        return out[0]

    def applied(self, sym, word, rank, at):
        """The arrays after merging at the given places, and a function that
        names the words in which a new pair ranks no later than ``low``."""
        new = self.pairs(sym[at], sym[at + 1])[1]
        keep = np.ones(len(sym), bool)
        keep[at + 1] = False
        sym2 = sym.copy()
        sym2[at] = new
        to = (np.cumsum(keep) - 1)[at]
        sym2, word2, rank2 = sym2[keep], word[keep], rank[keep]
        for place in (to, to[to > 0] - 1):
            nxt = np.minimum(place + 1, len(sym2) - 1)
            same = (word2[place] == word2[nxt]) & (nxt > place)
            rank2[place] = np.where(same, self.pairs(sym2[place], sym2[nxt])[0], NEVER)

        def early(low):
            limit = low[at]
            left = np.where((to > 0) & (word2[to - 1] == word2[to]), rank2[to - 1], NEVER)
            nxt = np.minimum(at + 2, len(sym) - 1)
            near = (nxt == at + 2) & (word[nxt] == word[at])
            passing = np.where(near, self.pairs(new, sym[nxt])[0], NEVER)
            return word[at[(rank2[to] <= limit) | (left <= limit) | (passing <= limit)]]
        return (sym2, word2, rank2), early


def _disjoint(at: np.ndarray) -> np.ndarray:
    """Of runs of neighbouring places, every second one from the left."""
    start = np.concatenate(([True], np.diff(at) != 1))
    lead = np.maximum.accumulate(np.where(start, np.arange(len(at)), 0))
    return at[(np.arange(len(at)) - lead) % 2 == 0]


class WordCounts:
    """Counts of texts; remembers up to ``max_words`` distinct words."""

    def __init__(self, path: str, max_words: int = 500_000):
        self.table, self.max_words = MergeTable(path), max_words
        self.known: dict[str, int] = {}

    def words(self, words: list[str]) -> np.ndarray:
        missing = list(dict.fromkeys(w for w in words if w not in self.known))
        if missing:
            self.known.update(zip(missing, self.table.counts(missing).tolist()))
        return np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))

    def texts(self, texts: pa.Array) -> np.ndarray:
        if len(self.known) > self.max_words:
            self.known.clear()
        plain = pc.replace_substring(texts, SPACE, " ")
        codes, offsets, words = split_codes(plain)
        per_word = self.words([SPACE + w for w in words])
        out = segment_sums(per_word[codes], offsets)
        blank = np.fromiter((not w for w in words), bool, len(words))
        for i in np.flatnonzero(segment_sums(blank[codes].astype(np.int64), offsets)):
            text = plain[int(i)].as_py()
            out[i] = self.words(CUT.split(SPACE + text.replace(" ", SPACE))).sum() if text else 0
        return out


def count_tokens(docs: DataFrame, model_path: str, limit: int = 4096,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_bytes, n_tokens, over_limit (more than ``limit`` tokens) of every row."""
    schema = StructType([docs.schema[id_col], StructField("n_bytes", LongType()),
                         StructField("n_tokens", LongType()),
                         StructField("over_limit", BooleanType())])

    def run(batches):
        counter = kept(("counts", model_path), lambda: WordCounts(model_path))
        for batch in batches:
            for part in text_slices(batch, text_col):
                texts = texts_of(part, text_col)
                n = counter.texts(texts)
                size = pc.binary_length(texts).cast(pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [part.column(id_col), size, pa.array(n), pa.array(n > limit)],
                    names=[id_col, "n_bytes", "n_tokens", "over_limit"])
    return docs.select(F.col(id_col), F.col(text_col).cast("string").alias(text_col)) \
        .mapInArrow(run, schema)
