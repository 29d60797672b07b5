"""Word shingles of whole texts as sorted sets of 64-bit hashes, in numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash

WIDTH = 5
#: Odd multipliers, one for each place in a shingle.
_PLACES = np.random.default_rng(5).integers(1 << 62, 1 << 63, size=WIDTH, dtype=np.uint64) | np.uint64(1)
#: A sequence shorter than a shingle is told apart from shingles by its length.
_SHORT = np.random.default_rng(6).integers(1, 1 << 63, size=WIDTH, dtype=np.uint64)
#: Bytes of text that are split into words at a time; a longer text goes alone.
SLICE_BYTES = 4 << 20


def slices(texts: pa.Array) -> Iterator[tuple[int, list[bytes | None]]]:
    """The texts as bytes, a bounded number of bytes at a time, with the first's number."""
    start, size, part = 0, 0, []
    for k, value in enumerate(texts):
        raw = value.as_py()
        raw = raw.encode() if isinstance(raw, str) else raw
        part.append(raw)
        size += len(raw or b"")
        if size >= SLICE_BYTES:
            yield start, part
            start, size, part = k + 1, 0, []
    if part:
        yield start, part


def word_hashes(part: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of the texts (A-Z in lower case), and where each text ends."""
    words: list[bytes] = []
    ends = np.empty(len(part), dtype=np.int64)
    for k, raw in enumerate(part):
        if raw:
            words += raw.lower().split()
        ends[k] = len(words)
    if not words:
        return np.empty(0, dtype=np.uint64), ends
    coded = pa.array(words, type=pa.binary()).dictionary_encode()
    distinct = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in coded.dictionary.to_pylist()), dtype=np.uint64)
    return distinct[coded.indices.to_numpy()], ends


def shingle_sets(part: list[bytes | None]) -> list[np.ndarray]:
    """The sorted set of shingle hashes of each text.

    Fewer words than a shingle has: the whole sequence counts as one; no word: empty.
    """
    hashes, ends = word_hashes(part)
    with np.errstate(over="ignore"):
        n = len(hashes) - WIDTH + 1
        windows = np.zeros(max(n, 0), dtype=np.uint64)
        for k in range(WIDTH if n > 0 else 0):
            windows += hashes[k:k + n] * _PLACES[k]
        found, start = [], 0
        for end in ends.tolist():
            size = end - start
            if size >= WIDTH:
                found.append(np.unique(windows[start:end - WIDTH + 1]))
            elif size:
                short = (hashes[start:end] * _PLACES[:size]).sum(dtype=np.uint64) + _SHORT[size]
                found.append(np.array([short], dtype=np.uint64))
            else:
                found.append(np.empty(0, dtype=np.uint64))
            start = end
    return found
