"""Word shingles as 64-bit numbers, for many documents at once."""

from __future__ import annotations

from itertools import chain

import numpy as np
import xxhash

WIDTH = 5
CACHE = 200_000

_ODD = np.uint64(0x9E3779B97F4A7C15)
_ODDS = [np.uint64((0x9E3779B97F4A7C15 + 2 * k * 0xBF58476D1CE4E5B9) % 2**64) for k in range(16)]
_MUL1, _MUL2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * _MUL1
    x = (x ^ (x >> np.uint64(27))) * _MUL2
    return x ^ (x >> np.uint64(31))


class Words(dict):
    """word -> 64-bit hash, remembered up to CACHE words."""

    def __missing__(self, word: str) -> int:
        got = self[word] = xxhash.xxh64_intdigest(word)
        return got

    def hashes(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The words' hashes of all texts in a row, and how many each text has."""
        split = [t.lower().split() for t in texts]
        sizes = np.fromiter(map(len, split), np.int64, len(split))
        got = np.fromiter(map(self.__getitem__, chain.from_iterable(split)), np.uint64, int(sizes.sum()))
        if len(self) > CACHE:
            self.clear()
        return got, sizes


def shingle(words: np.ndarray, sizes: np.ndarray, width: int = WIDTH) -> tuple[np.ndarray, np.ndarray]:
    """(document number, hash) of every shingle; a text of fewer words is one shingle, one of none has none."""
    ends = np.cumsum(sizes)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    left = ends[owner] - np.arange(len(words))  # words from here to the text's end
    first = left == sizes[owner]
    keep = (left >= width) | first
    total = np.zeros(len(words), np.uint64)
    padded = np.concatenate([words, np.zeros(width, np.uint64)])
    for k in range(width):
        part = padded[k : k + len(words)] * _ODDS[k]
        total += np.where(left > k, part, np.uint64(k + 1))
        total = mix(total)
    return owner[keep], total[keep]


def bags(owner: np.ndarray, found: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Different (document number, hash) in order, and how often each occurs."""
    order = np.lexsort((found, owner))
    owner, found = owner[order], found[order]
    new = np.ones(len(found), bool)
    new[1:] = (found[1:] != found[:-1]) | (owner[1:] != owner[:-1])
    at = np.flatnonzero(new)
    return owner[at], found[at], np.diff(np.append(at, len(found)))


def occurrences(found: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """A bag as a set: the k-th occurrence of an element becomes an element of its own. Sorted."""
    start = np.cumsum(counts) - counts
    nth = (np.arange(int(counts.sum())) - np.repeat(start, counts)).astype(np.uint64)
    return np.sort(mix(np.repeat(found, counts) + nth * _ODD))
