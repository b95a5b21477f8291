"""Word shingles of whole texts as sets of 64-bit hashes."""

from __future__ import annotations

import numpy as np
import xxhash

_STEP = np.uint64(0x9E3779B97F4A7C15)
_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


def mixed(values: np.ndarray) -> np.ndarray:
    """The finishing steps of the splitmix generator: a permutation of the 64-bit numbers without visible structure."""
    values = (values ^ (values >> np.uint64(30))) * _MIX[0]
    values = (values ^ (values >> np.uint64(27))) * _MIX[1]
    return values ^ (values >> np.uint64(31))


def shingle_set(text: str | None, words: int) -> np.ndarray:
    """Sorted distinct hashes of the runs of ``words`` words; of all words as one run where there are fewer.

    A-Z is lower-cased and words end at space, tab, line feed, vertical tab, form feed and carriage return only,
    which is what ``lower`` and ``split`` do on bytes. No words, no shingles.
    """
    pieces = (text or "").encode("utf-8", "surrogatepass").lower().split()
    count = len(pieces)
    if not count:
        return np.empty(0, np.uint64)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, pieces), np.uint64, count)
    width = min(words, count)
    runs = np.full(count - width + 1, width, np.uint64)
    for at in range(width):
        runs = mixed(runs * _STEP + hashes[at:count - width + 1 + at])
    return np.unique(runs)
