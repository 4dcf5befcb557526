"""Word shingles of texts as 64-bit numbers (NumPy over whole texts, inside tasks)."""

from __future__ import annotations

import re

import numpy as np

_ASCII = re.compile("[\x00-\x7f]+")
_BASE = 0x9E3779B97F4A7C15
_POWERS = [np.ones(1, "uint64"), np.ones(1, "uint64")]
_WORD = np.zeros(256, bool)
_WORD[[*range(48, 58), *range(97, 123), *range(128, 256)]] = True


def mix(h: np.ndarray) -> np.ndarray:
    """A one-to-one scramble of 64-bit numbers."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def powers(count: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2^64."""
    if len(_POWERS[0]) < count:
        size = max(count, 2 * len(_POWERS[0]), 1 << 16)
        for k, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            steps = np.full(size, base, "uint64")
            steps[0] = 1
            _POWERS[k] = np.multiply.accumulate(steps)
    return _POWERS[0][:count], _POWERS[1][:count]


def word_hashes(text: str) -> np.ndarray:
    """A hash per word (run of letters and digits, lower case) in the order of the text."""
    low = text.lower()
    if not low.isascii():
        for sign in set(_ASCII.sub("", low)):
            if not sign.isalnum():
                low = low.replace(sign, " ")
    raw = np.frombuffer(low.encode("utf-8", "replace"), dtype="uint8")
    if not len(raw):
        return np.zeros(0, "uint64")
    inside = _WORD[raw]
    edges = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    edges = np.concatenate([[0] if inside[0] else [], edges, [len(raw)] if inside[-1] else []]).astype("int64")
    start, end = edges[::2], edges[1::2]
    up, down = powers(len(raw) + 1)
    sums = np.zeros(len(raw) + 1, "uint64")
    np.cumsum(raw * up[:-1], out=sums[1:])
    return mix((sums[end] - sums[start]) * down[start])


def shingle_set(text: str | None, width: int = 5) -> np.ndarray:
    """Sorted distinct hashes of the runs of ``width`` words; a shorter text is one run."""
    words = word_hashes(text or "")
    if not len(words):
        return words
    runs = max(len(words) - width + 1, 1)
    out = np.zeros(runs, "uint64")
    for k in range(min(width, len(words))):
        out = out * np.uint64(_BASE) + words[k:k + runs]
    return np.unique(mix(out + np.uint64(min(width, len(words)))))


def permutations(count: int, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    random = np.random.default_rng(seed)
    return (random.integers(0, 1 << 63, count, dtype="uint64") * np.uint64(2) + np.uint64(1),
            random.integers(0, 1 << 63, count, dtype="uint64"))


def minima(shingles: np.ndarray, factors: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The smallest value of the set under every permutation."""
    out = np.full(len(factors), np.uint64(0xFFFFFFFFFFFFFFFF))
    for at in range(0, len(shingles), 4096):
        part = shingles[at:at + 4096]
        for k in range(0, len(factors), 20):
            values = (part[None, :] ^ offsets[k:k + 20, None]) * factors[k:k + 20, None]
            np.minimum(out[k:k + 20], values.min(axis=1), out=out[k:k + 20])
    return out
