"""Words of a text as 64-bit hashes, for work on whole batches in numpy."""

from __future__ import annotations

import numpy as np
import xxhash

CACHE = 500_000  # words remembered per task before the memory is cleared


class WordHashes(dict):
    """Hash of each word, computed once while it is remembered."""

    def __missing__(self, word) -> int:
        if len(self) >= CACHE:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mix(values: np.ndarray) -> np.ndarray:
    """Scramble 64-bit numbers so that every input bit moves all output bits."""
    x = values ^ (values >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hashes of all runs of ``width`` words, in order; of the whole sequence where it is shorter.

    Runs of different lengths never have the same hash by construction of the start value.
    """
    if not len(hashes):
        return hashes
    width = min(width, len(hashes))
    count = len(hashes) - width + 1
    rolled = np.full(count, width, np.uint64)
    for offset in range(width):
        rolled = mix(rolled * np.uint64(0x9E3779B97F4A7C15) + hashes[offset:offset + count])
    return rolled
