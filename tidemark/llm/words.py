"""Words of many texts at once, as 64-bit hashes in numpy arrays.

A word is a run of bytes other than ASCII white space (``[^\\x20\\x09-\\x0D]+``),
with A-Z in lower case.  Only distinct words of a chunk are touched by Python.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

CHUNK_BYTES = 8 << 20


def chunks(text: pa.Array, max_bytes: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """[start, end) of rows whose texts together stay near ``max_bytes``; one text is never split."""
    sizes = pc.fill_null(pc.binary_length(text), 0).to_numpy(zero_copy_only=False)
    start = total = 0
    for k, size in enumerate(sizes):
        if k > start and total + size > max_bytes:
            yield start, k
            start, total = k, 0
        total += int(size)
    if len(sizes) > start:
        yield start, len(sizes)


def split_words(text: pa.Array) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """(offsets of each text's words, index of every word in the chunk's distinct words, distinct words)."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(text, "")))
    encoded = lists.flatten().dictionary_encode()
    index = encoded.indices.to_numpy(zero_copy_only=False)
    words = encoded.dictionary.cast(pa.binary()).to_pylist()
    offsets = lists.offsets.to_numpy().astype(np.int64)
    offsets = offsets - offsets[0]
    if b"" in words:  # the split leaves empty words at the ends of a text
        keep = index != words.index(b"")
        offsets = np.concatenate([[0], np.cumsum(keep)])[offsets]
        index = index[keep]
    return offsets, index, words


def hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter((xxhash.xxh3_64_intdigest(w) for w in words), np.uint64, len(words))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values (splitmix64's finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_sets(text: pa.Array, width: int) -> list[np.ndarray]:
    """The distinct shingles of ``width`` words of every text, ascending; of fewer words, one for all of them; of none, none."""
    offsets, index, words = split_words(text)
    h = hashes(words)[index] if len(words) else np.zeros(0, np.uint64)
    n = len(h)
    rolled = np.zeros(max(0, n - width + 1), np.uint64)
    for k in range(width):
        rolled = mix(rolled + h[k : n - width + 1 + k] + np.uint64(0x9E3779B97F4A7C15)) if len(rolled) else rolled
    out = []
    for start, end in zip(offsets[:-1], offsets[1:], strict=True):
        if end - start >= width:
            out.append(np.unique(rolled[start : end - width + 1]))
        elif end > start:
            short = np.uint64(end - start)
            for k in range(start, end):
                short = mix(np.array([short]) + h[k])[0]
            out.append(np.array([short], np.uint64))
        else:
            out.append(np.zeros(0, np.uint64))
    return out
