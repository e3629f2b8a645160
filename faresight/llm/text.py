"""Vectorised words and word shingles for batches of texts (used inside Spark tasks).

A word is a maximal run of code points other than ``\\x20`` and ``\\x09-\\x0D``,
with A-Z lower-cased.  Both rules touch ASCII bytes only, so words are found
in the UTF-8 bytes of many texts at once with numpy.

A word's 64-bit hash is a polynomial over randomised byte values modulo 2**64
followed by a bit mixer; equal words always have equal hashes.  A shingle's
hash mixes the hashes of its words in order.  Sets of shingles are compared by
these hashes: two different shingles of one pair of texts collide with a
chance of about (set size)**2 / 2**64.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

SHINGLE_WORDS = 5
# Texts are handled in groups of about this many bytes, so the numpy scratch
# arrays (about 60 bytes for each text byte) stay bounded.
GROUP_BYTES = 1 << 20

_U = np.uint64
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def mix64(x: np.ndarray) -> np.ndarray:
    """Bit mixer (splitmix64 finaliser); a bijection on uint64."""
    x = np.asarray(x, dtype=np.uint64).copy()
    x ^= x >> _U(30)
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


def random_words(n: int, seed: int) -> np.ndarray:
    """``n`` fixed pseudo-random uint64 values."""
    return mix64(np.arange(1, n + 1, dtype=np.uint64) * _U(0x9E3779B97F4A7C15) + _U(seed))


_BYTE_VALUE = random_words(256, 11)
for _b in range(ord("A"), ord("Z") + 1):
    _BYTE_VALUE[_b] = _BYTE_VALUE[_b + 32]
_BASE = int(random_words(1, 12)[0]) | 1
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_SHINGLE_MULT = random_words(64, 13) | _U(1)
_POWERS: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        p = np.full(max(n, 1 << 16), _U(base), dtype=np.uint64)
        p[0] = 1
        have = np.multiply.accumulate(p)
        if n <= 4 * GROUP_BYTES:  # keep only tables of usual size between calls
            _POWERS[base] = have
    return have


class Words:
    """Words of a group of texts: hash, byte span in its text, text number."""

    def __init__(self, encoded: list[bytes]):
        joined = b"\n".join(encoded) + b"\n"
        data = np.frombuffer(joined, dtype=np.uint8)
        lengths = np.fromiter((len(e) + 1 for e in encoded), dtype=np.int64, count=len(encoded))
        self.text_start = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)
        space = _SPACE[data]
        edge = np.diff(np.concatenate([[True], space]).astype(np.int8))
        self.start = np.flatnonzero(edge == -1)
        self.end = np.flatnonzero(edge == 1)  # the data ends with a space byte
        self.text = np.searchsorted(self.text_start, self.start, side="right") - 1
        # words of text i are [first[i], first[i + 1])
        self.first = np.searchsorted(self.start, self.text_start, side="left")
        sums = _BYTE_VALUE[data]
        sums *= _powers(_BASE, len(data))[: len(data)]
        np.cumsum(sums, out=sums)
        before = np.where(self.start > 0, sums[self.start - 1], _U(0))
        total = (sums[self.end - 1] - before) * _powers(_BASE_INVERSE, len(data))[self.start]
        self.hash = mix64(total + (self.end - self.start).astype(np.uint64) * _U(0x9E3779B97F4A7C15))
        self.data = data

    def shingles(self, first: np.ndarray | None = None, k: int = SHINGLE_WORDS) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all k-word shingles, and their bounds for each word range.

        ``first`` bounds the ranges (default: one range for each text).  A
        range with 1 to k-1 words has its whole sequence as one shingle; one
        without words has none.  Hashes may repeat within a range.
        """
        first = self.first if first is None else first
        n_words = np.diff(first)
        count = np.where(n_words >= k, n_words - k + 1, (n_words > 0).astype(np.int64))
        bounds = np.concatenate([[0], np.cumsum(count)]).astype(np.int64)
        total = int(bounds[-1])
        owner = np.repeat(np.arange(len(n_words)), count)
        at = first[:-1][owner] + (np.arange(total) - bounds[:-1][owner])
        size = np.minimum(n_words[owner], k)
        out = size.astype(np.uint64)
        last = max(len(self.hash) - 1, 0)
        for j in range(k):
            term = self.hash[np.minimum(at + j, last)] * _SHINGLE_MULT[j] if total else out
            out = out + np.where(j < size, term, _U(0)) if total else out
        return mix64(out), bounds


def groups(texts) -> Iterator[tuple[int, list[bytes]]]:
    """Texts as UTF-8 in groups of bounded bytes: (number of the first text, texts).

    A null text is an empty one; unpaired surrogates (not valid in a Spark
    string) would be kept as they are.
    """
    begin, group, size = 0, [], 0
    for i, t in enumerate(texts):
        t = t.as_py() if hasattr(t, "as_py") else t  # Arrow values one by one
        b = t.encode("utf-8", "surrogatepass") if isinstance(t, str) else b""
        if group and size + len(b) > GROUP_BYTES:
            yield begin, group
            begin, group, size = i, [], 0
        group.append(b)
        size += len(b)
    if group:
        yield begin, group


def distinct_shingle_sets(texts, k: int = SHINGLE_WORDS) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text, in order."""
    for _, encoded in groups(texts):
        values, bounds = Words(encoded).shingles(k=k)
        for i in range(len(encoded)):
            yield np.unique(values[bounds[i]:bounds[i + 1]])
