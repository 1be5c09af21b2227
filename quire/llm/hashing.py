"""Word hashes, shingles and SuperMinHash signatures as arrays."""

from __future__ import annotations

import numpy as np
import xxhash

GOLDEN = np.uint64(0x9E3779B97F4A7C15)
FIRST, SECOND = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
BASE = np.uint64(0x9E6C63D0876A9A47)
EMPTY = np.uint64(2**64 - 1)


class WordHashes(dict):
    """Hashes of words; forgets them when it holds too many, as they are cheap to make again."""

    def __init__(self, most: int = 200_000):
        self.most = most

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.most:
            self.clear()
        self[word] = value = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * FIRST
    x = (x ^ (x >> np.uint64(27))) * SECOND
    return x ^ (x >> np.uint64(31))


def run_hashes(hashes: np.ndarray, length: int) -> np.ndarray:
    """A hash of each run of so many consecutive words, by their order; none if there are fewer."""
    count = len(hashes) - length + 1
    if count <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(count, np.uint64)
    for k in range(length):
        out = out * BASE + hashes[k : k + count]
    return mixed(out + np.uint64(length))


def shingles(hashes: np.ndarray, length: int) -> np.ndarray:
    """The sorted distinct shingles; a shorter text that has words is one shingle."""
    return np.unique(run_hashes(hashes, min(length, len(hashes)))) if len(hashes) else np.zeros(0, np.uint64)


def super_min_hash(sets: list[np.ndarray], size: int = 128) -> np.ndarray:
    """A signature row for each set of 64-bit numbers: SuperMinHash, all sets at once.

    Element by element, rank j of its own random permutation of the components gets a random number in [j, j + 1); a component
    keeps its least. Ranks are dealt in rounds. After round j a set stops early if all its components are below j + 1, as
    later ranks cannot be less. Components of an empty set are EMPTY.
    """
    counts = np.array([len(s) for s in sets], np.int64)
    out = np.full(len(sets) * size, EMPTY, np.uint64)
    x = np.concatenate([np.zeros(0, np.uint64), *sets])
    owner = np.repeat(np.arange(len(sets)), counts)
    places = None
    for j in range(size):
        if not len(x):
            break
        state = mixed(x + np.uint64(int(GOLDEN) * (j + 1) % 2**64))
        value = (np.uint64(j) << np.uint64(32)) | (state >> np.uint64(32))
        pick = (j + ((state & np.uint64(0xFFFFFFFF)) * np.uint64(size - j) >> np.uint64(32))).astype(np.int64)
        if places is None:
            component = pick
        else:
            rows = np.arange(len(x))
            component = places[rows, pick]
            places[rows, pick] = places[:, j]
        np.minimum.at(out, owner * size + component, value)
        full = out.reshape(-1, size).max(axis=1) < np.uint64(j + 1) << np.uint64(32)
        left = ~full[owner]
        if not left.all():
            x, owner, pick = x[left], owner[left], pick[left]
            places = places[left] if places is not None else None
        if places is None:
            places = np.tile(np.arange(size, dtype=np.uint16), (len(x), 1))
            places[np.arange(len(x)), pick] = 0
    return out.reshape(-1, size)


def band_hashes(signatures: np.ndarray, rows: int) -> np.ndarray:
    """A hash of each band of so many components, different from band to band."""
    parts = signatures.reshape(len(signatures), -1, rows)
    out = np.broadcast_to(np.arange(1, parts.shape[1] + 1, dtype=np.uint64) * GOLDEN, parts.shape[:2])
    for k in range(rows):
        out = mixed(out * BASE + parts[:, :, k])
    return out
