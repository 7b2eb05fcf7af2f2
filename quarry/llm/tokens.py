"""Token ids of whole texts by a public tokenizer file, fast enough for a corpus.

The tokenizers library gives the ids.  It spends its time on pre-tokenising and
merging, and prose repeats its words, so each worker keeps the ids of distinct
words.  Texts are cut only where the tokenizer cuts them in any case: before a
space that follows a visible character (byte-level files), or at a space or
line end (files that drop white space).  The words a Latin pattern describes
without doubt go to the library's model; anything else goes through the whole
library, and a text with unusual spacing is cut by the strict rule.
"""

from __future__ import annotations

import itertools
import json
import re
from array import array

import numpy as np
import pyarrow as pa

from quarry.llm.ragged import concat_ranges, kept, split_codes

LETTER = "A-Za-zªµºÀ-ÖØ-öø-ɏ"
DIGIT = "0-9²³¹¼-¾"
PLAIN = re.compile("[\t\n\r\x20-\x7e¡-įı-ɏ]*")
BYTE_WORD = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d| ?[{LETTER}]+| ?[{DIGIT}]+"
                       f"| ?[^\\s{LETTER}{DIGIT}]+|\\s+(?!\\S)|\\s+")
LOWER_WORD = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{LETTER}]+|[{DIGIT}]|[^\\s{LETTER}{DIGIT}]+")
TAIL = ".,;:!?"
SAFE_CUT = re.compile(r"(?<=\S)(?= )")


def byte_letters() -> list[str]:
    """The letter that stands for each byte in byte-level vocabularies:
    visible Latin-1 characters stand for themselves, the rest are counted up
    from U+0100."""
    kept = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(b) if b in kept else chr(next(others)) for b in range(256)]


class WordIds:
    """Ids of texts; remembers about ``max_words`` distinct words (as entries
    of one flat array) and as many pre-tokens (as packed bytes).  When there are
    more, the words met most often stay."""

    def __init__(self, path: str, max_words: int = 400_000):
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_file(path)
        self.model = self.tok.model
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.specials = [t["content"] for t in spec["added_tokens"]]
        if not all(s.startswith("<") for s in self.specials):
            raise ValueError(f"{path}: special tokens that do not begin with '<'")
        pre = spec.get("pre_tokenizer") or {}
        kinds = [pre.get("type"), *(p.get("type") for p in pre.get("pretokenizers", []))]
        norm = json.dumps(spec.get("normalizer"))
        if kinds == ["ByteLevel"] and spec["normalizer"] is None and not pre.get("add_prefix_space"):
            self.spaced, self.pattern = True, BYTE_WORD
        elif kinds == ["Sequence", "Split", "ByteLevel"] and "Lowercase" in norm:
            self.spaced, self.pattern = False, LOWER_WORD
        else:
            raise ValueError(f"{path}: neither byte-level nor a lower-casing word file")
        self.letters = byte_letters()
        self.max_words = max_words
        self.known: dict[str, bytes] = {}
        self.forget_words()

    def forget_words(self) -> None:
        self.entry: dict[str, int] = {}
        self.starts = np.zeros(1024, np.int64)
        self.counts = np.zeros(1024, np.int64)
        self.hits = np.zeros(1024, np.int64)
        self.flat = np.zeros(8192, np.uint32)
        self.used = 0

    def forget_rare(self) -> None:
        """Keep the words that several slices held, a third of the room at most."""
        n, room = len(self.entry), self.max_words // 3
        stay = np.flatnonzero(self.hits[:n] > 1)
        if len(stay) > room:
            stay = np.sort(stay[np.argpartition(-self.hits[stay], room)[:room]])
        words = list(self.entry)                            # in the order of their rows
        starts, counts, hits, flat = self.starts[stay], self.counts[stay], self.hits[stay], self.flat
        self.forget_words()
        self.entry = dict(zip((words[i] for i in stay.tolist()), range(len(stay))))
        self.counts, self.hits = _grown(counts, 1024), _grown(hits // 2, 1024)
        self.starts = _grown(np.cumsum(counts) - counts, 1024)
        kept_ids = flat[concat_ranges(starts, counts)]
        self.used = len(kept_ids)
        self.flat = _grown(kept_ids, 8192)

    # ---------------------------------------------------------------- words
    def word_ids(self, word: str) -> bytes:
        """Ids (unsigned 32-bit) of one piece that stands between two certain cuts."""
        # letters, perhaps with one mark behind: by far the most
        core, tail = (word[:-1], word[-1]) if word and word[-1] in TAIL else (word, "")
        if core.isascii() and (core[1:] if self.spaced and core[:1] == " " else core).isalpha():
            core = core if self.spaced else core.lower()
            ids = self.known.get(core) or self.part_ids(core)
            return ids + (self.known.get(tail) or self.part_ids(tail)) if tail else ids
        if not (word.isascii() and word.isprintable() or PLAIN.fullmatch(word)) \
                or "<" in word and any(s in word for s in self.specials):
            return packed(self.tok.encode(word, add_special_tokens=False).ids)
        parts = self.pattern.findall(word if self.spaced else word.lower())
        known = self.known
        if len(parts) == 1:
            return known.get(parts[0]) or self.part_ids(parts[0])
        return b"".join([known.get(part) or self.part_ids(part) for part in parts])

    def part_ids(self, part: str) -> bytes:
        """Ids of one pre-token by the library's model."""
        if part.isascii() and part.isprintable():
            seen = part.replace(" ", self.letters[32])
        else:
            seen = "".join([self.letters[b] for b in part.encode()])
        ids = self.known[part] = packed([t.id for t in self.model.tokenize(seen)])
        return ids

    def entries(self, words: list[str]) -> np.ndarray:
        """Row of each word in the table of remembered ids."""
        missing = list(dict.fromkeys(itertools.filterfalse(self.entry.__contains__, words)))
        if missing:
            fresh = [self.word_ids(w) for w in missing]
            n, sizes = len(self.entry), np.fromiter(map(len, fresh), np.int64, len(fresh)) // 4
            total = int(sizes.sum())
            self.starts = _grown(self.starts, n + len(fresh))
            self.hits = _grown(self.hits, n + len(fresh))
            self.counts = _grown(self.counts, n + len(fresh))
            self.flat = _grown(self.flat, self.used + total)
            self.starts[n:n + len(fresh)] = self.used + np.cumsum(sizes) - sizes
            self.counts[n:n + len(fresh)] = sizes
            self.flat[self.used:self.used + total] = np.frombuffer(b"".join(fresh), np.uint32)
            self.used += total
            self.entry.update(zip(missing, range(n, n + len(missing))))
        rows = np.fromiter(map(self.entry.__getitem__, words), np.int64, len(words))
        self.hits[rows] += 1
        return rows

    # ---------------------------------------------------------------- texts
    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids, offsets): text i owns ids[offsets[i]:offsets[i+1]]."""
        if len(self.entry) > self.max_words:
            self.forget_rare()
        if len(self.known) > self.max_words:
            self.known.clear()
        if not len(texts):
            return np.zeros(0, np.uint32), np.zeros(1, np.int64)
        codes, offsets, words = split_codes(texts)
        if self.spaced:
            odd = np.fromiter((not w or w[0].isspace() or w[-1].isspace() for w in words),
                              bool, len(words))
            strict = np.add.reduceat(odd[codes], offsets[:-1]) > 0
            rows = self.entries([" " + w for w in words])[codes]
            first = offsets[:-1]
            rows[first] = self.entries([words[c] for c in codes[first]])
        else:
            strict = np.zeros(len(texts), bool)
            rows = self.entries(words)[codes]
        counts = self.counts[rows]
        ids = self.flat[concat_ranges(self.starts[rows], counts)]
        run = np.concatenate(([0], np.cumsum(counts)))
        ends = run[offsets]
        if not strict.any():
            return ids, ends
        out, sizes = [], np.diff(ends)
        for i in range(len(texts)):
            if strict[i]:
                own = self.entries(SAFE_CUT.split(texts[i].as_py()))
                part = self.flat[concat_ranges(self.starts[own], self.counts[own])]
                sizes[i] = len(part)
            else:
                part = ids[ends[i]:ends[i + 1]]
            out.append(part)
        return np.concatenate(out), np.concatenate(([0], np.cumsum(sizes)))


def packed(ids: list[int]) -> bytes:
    return array("I", ids).tobytes()


def _grown(a: np.ndarray, n: int) -> np.ndarray:
    if n <= len(a):
        return a
    out = np.zeros(max(n, 2 * len(a)), a.dtype)
    out[:len(a)] = a
    return out


def word_ids(path: str) -> WordIds:
    """The worker's tokenizer for a file, kept until the worker turns to
    another operator."""
    import os
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return kept(("ids", path), lambda: WordIds(path))
