"""Words of whole texts as arrays, for use inside Arrow tasks.

A word is a maximal run of bytes other than space and ``\\x09``-``\\x0d``.
"""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

#: Text bytes handled at once inside a task; a longer single text is a slice of its own.
SLICE_BYTES = 2 * 1024 * 1024


class Words(NamedTuple):
    """Distinct words, the word number at each place, and where each text starts in ``places``."""

    distinct: list[str]
    places: np.ndarray
    starts: np.ndarray


def give_back() -> None:
    """Return freed memory to the system: several workers, idle ones too, share an executor's memory, and a driver that
    has trained a model goes on to plan jobs."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # only the GNU C library has it
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows whose texts hold about ``limit`` bytes; no row is split or lost."""
    lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    group = np.cumsum(lengths, dtype=np.int64) // limit
    edges = np.flatnonzero(np.diff(group)) + 1
    for a, b in zip([0, *edges], [*edges, batch.num_rows], strict=True):
        if b > a:
            yield batch.slice(a, b - a)
    give_back()


def split_words(texts: pa.Array) -> Words:
    """Words of every text; null and blank texts have none."""
    parts = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
    flat = parts.flatten().dictionary_encode()
    distinct, places = flat.dictionary.to_pylist(), flat.indices.to_numpy()
    starts = np.concatenate([[0], np.cumsum(pc.list_value_length(parts).to_numpy(), dtype=np.int64)])
    if "" in distinct:  # before leading and after trailing white space
        real = places != distinct.index("")
        starts = np.concatenate([[0], np.cumsum(real, dtype=np.int64)])[starts]
        places = places[real]
    return Words(distinct, places, starts)


def word_hashes(distinct: list[str]) -> np.ndarray:
    """A 64-bit hash of each word."""
    return np.fromiter((xxhash.xxh64_intdigest(w) for w in distinct), np.uint64, len(distinct))


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (a bijection)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def shingle_hashes(words: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the ``n``-word shingles of every text, in text order, and where each text starts.

    A text with fewer than ``n`` words has its whole sequence as one shingle, a text without words none.
    """
    hashes = word_hashes(words.distinct)[words.places] if len(words.places) else np.zeros(0, np.uint64)
    return shingles_of(hashes, words.starts, n)


def shingles_of(hashes: np.ndarray, edges: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """``shingle_hashes`` of texts given by the hash of the word at each place and where each text starts."""
    counts = np.diff(edges)
    rows = np.where(counts == 0, 0, np.maximum(counts - n + 1, 1))
    starts = np.concatenate([[0], np.cumsum(rows)])
    first = np.repeat(edges[:-1] - starts[:-1], rows) + np.arange(starts[-1])
    short = np.repeat(np.where(counts < n, counts, n), rows)
    out = np.zeros(starts[-1], np.uint64)
    for k in range(n):
        here = hashes[np.minimum(first + k, max(len(hashes) - 1, 0))] if len(hashes) else out
        step = mixed(out * np.uint64(0x9E3779B97F4A7C15) + here + np.uint64(k + 1))
        out = np.where(short > k, step, out)
    return out, starts
