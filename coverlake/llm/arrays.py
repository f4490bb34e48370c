"""Words, shingles and hashes as arrays, for the tasks that run Python over Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text turned into arrays at a time, so memory does not follow the size of a batch.
SLICE_BYTES = 4 << 20
ODD = np.uint64(0x9E3779B97F4A7C15)
PAD = np.uint64(0x5851F42D4C957F2D)


def mix(values: np.ndarray) -> np.ndarray:
    """A well-mixed 64-bit value of each 64-bit value."""
    x = values.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def slices(batch: pa.RecordBatch, column: str) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows whose texts have about SLICE_BYTES."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    part = np.cumsum(sizes, dtype=np.int64) // SLICE_BYTES
    edges = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
    for low, high in zip(edges, edges[1:]):
        if high > low:
            yield batch.slice(low, high - low)


def words_of(texts: pa.Array, lower: bool = False) -> tuple[pa.Array, np.ndarray]:
    """All words of the texts one after the other, and how many each text has."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts) if lower else texts)
    flat = lists.flatten()
    real = pc.greater(pc.binary_length(flat), 0).to_numpy(zero_copy_only=False)
    offsets = lists.offsets.to_numpy()
    before = np.concatenate([[0], np.cumsum(real)])
    lengths = np.diff(before[offsets - offsets[0]])
    return flat.filter(pa.array(real)), lengths


def hashes_of(words: pa.Array) -> np.ndarray:
    """A 64-bit hash of each word; each distinct word is hashed once."""
    if not len(words):
        return np.empty(0, np.uint64)
    coded = words.dictionary_encode()
    distinct = pd.util.hash_array(coded.dictionary.to_numpy(zero_copy_only=False), categorize=False)
    return distinct[coded.indices.to_numpy()]


def shingles_of(texts: pa.Array, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the n-word shingles of each text, in order, and how many each text has.

    A text of fewer words has one shingle, all its words; a text without words has none.
    """
    words, lengths = words_of(texts)
    hashed = hashes_of(words)
    short = (lengths > 0) & (lengths < n)
    if short.any():
        hashed = np.insert(hashed, np.repeat(np.cumsum(lengths)[short], n - lengths[short]), PAD)
        lengths = np.where(short, n, lengths)
    counts = np.maximum(lengths - n + 1, 0)
    if not counts.any():
        return np.empty(0, np.uint64), counts
    size = len(hashed) - n + 1
    total = np.zeros(size, np.uint64)
    for k in range(n):
        total *= ODD
        total += hashed[k : k + size]
    left = np.repeat(np.cumsum(lengths), lengths) - np.arange(len(hashed))
    return mix(total[left[:size] >= n]), counts
