"""Ragged numpy arrays inside Arrow tasks: words of a batch as codes into its
distinct words, so that Python touches each distinct word once per batch."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


_KEPT: dict = {}


def kept(name, make):
    """State that a Python worker keeps between tasks.  Only the latest is held:
    a worker that serves another operator lets go of what it kept before."""
    if name not in _KEPT:
        _KEPT.clear()
        _KEPT[name] = make()
    return _KEPT[name]


def nothing_kept() -> None:
    """For operators that keep no state: let go of what another one kept."""
    _KEPT.clear()


def text_slices(batch: pa.RecordBatch, column: str,
                max_bytes: int = 16 << 20) -> Iterator[pa.RecordBatch]:
    """Consecutive slices of a batch holding about ``max_bytes`` of text each
    (a single longer text is a slice of its own); nulls count as empty."""
    if not batch.num_rows:
        return
    pa.default_memory_pool().release_unused()
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes, dtype=np.int64)
    at = 0
    while at < batch.num_rows:
        done = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, done + max_bytes, "right")))
        yield batch.slice(at, to - at)
        at = to


def texts_of(batch: pa.RecordBatch, column: str) -> pa.Array:
    """The text column with nulls as empty strings."""
    return pc.fill_null(batch.column(column).cast(pa.string()), "")


def split_codes(texts: pa.Array, pattern: str = " ") -> tuple[np.ndarray, np.ndarray, list[str]]:
    """(codes, offsets, distinct): the parts of every text between ``pattern``
    as codes into the distinct parts; text i owns codes[offsets[i]:offsets[i+1]]."""
    parts = pc.split_pattern(texts, pattern)
    offsets = np.asarray(parts.offsets, dtype=np.int64)
    values = parts.values.slice(int(offsets[0]), int(offsets[-1] - offsets[0]))
    coded = values.dictionary_encode()
    return (coded.indices.to_numpy(zero_copy_only=False).astype(np.int64, copy=False),
            offsets - offsets[0], coded.dictionary.to_pylist())


def concat_ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Indices start, start+1, ... of every range, end to end."""
    ends = np.cumsum(counts)
    total = int(ends[-1]) if len(ends) else 0
    return np.repeat(starts - (ends - counts), counts) + np.arange(total)


def segment_sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of values[offsets[i]:offsets[i+1]] for each i; empty ranges give 0."""
    run = np.concatenate(([0], np.cumsum(values)))
    return run[offsets[1:]] - run[offsets[:-1]]


def shielded(docs, run, *names: str):
    """``run(docs, *names)`` on rows whose columns that begin with ``__`` (the
    operators' own) go by other names meanwhile; ``names`` are columns it is told."""
    taken = {c: f"column {i} {c.strip('_')}" for i, c in enumerate(docs.columns) if c.startswith("__")}
    if not taken:
        return run(docs, *names)
    back = {new: old for old, new in taken.items()}
    out = run(docs.withColumnsRenamed(taken), *(taken.get(n, n) for n in names))
    return out.withColumnsRenamed(back)
