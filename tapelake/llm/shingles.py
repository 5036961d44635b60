"""Word sequences and shingles of texts as 64-bit hashes, computed for many texts at once.

Words are the runs of bytes other than space and U+0009 to U+000D; ``A`` to ``Z`` are lower-cased, nothing else is changed.
A 64-bit hash stands for each word sequence: two different ones among n agree by chance with a probability of about
n * n / 2**65, which is below one in a thousand for 10**8 different shingles in a comparison.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash

WIDTH = 5
_PRIME = np.uint64(0x9E3779B97F4A7C15)


def mix(values: np.ndarray) -> np.ndarray:
    """Spread 64-bit values evenly, so that their order is as good as random."""
    values = values ^ (values >> np.uint64(33))
    values = values * np.uint64(0xFF51AFD7ED558CCD)
    values = values ^ (values >> np.uint64(33))
    values = values * np.uint64(0xC4CEB9FE1A85EC53)
    return values ^ (values >> np.uint64(33))


def split_words(text: bytes | None) -> list[bytes]:
    """Lower-cased words; none for a null."""
    return text.lower().split() if text else []


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))


def roll(hashes: np.ndarray, width: int) -> np.ndarray:
    """A hash for each run of ``width`` words."""
    runs = len(hashes) - width + 1
    out = np.full(max(runs, 0), np.uint64(width))
    for k in range(width):
        out = out * _PRIME + hashes[k : k + len(out)]
    return mix(out)


def distinct_shingles(words: list[bytes], width: int = WIDTH) -> np.ndarray:
    """Sorted hashes of the distinct shingles of ``width`` words; fewer words make one shingle, none make no shingle."""
    if not words:
        return np.empty(0, np.uint64)
    return np.unique(roll(word_hashes(words), min(width, len(words))))


def as_bytes(column: pa.Array) -> list[bytes | None]:
    """Texts of an Arrow column as UTF-8 bytes."""
    return column.cast(pa.large_binary()).to_pylist()
