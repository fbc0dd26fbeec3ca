"""Shingle sets of texts, their MinHash values, and exact comparison of sets."""

from __future__ import annotations

import numpy as np
import xxhash

from cadastra.llm.held import held

#: Trees of the forest, MinHash values along each, and all values of a signature.
TREES, DEPTH = 16, 8
VALUES = TREES * DEPTH
#: Bits of each value that the sketch keeps, and the disagreeing values up to which two sketches may belong to a link:
#: at a similarity of 0.8, 128 values disagree in two bits at 19.2 places on average with a deviation of 4.
SKETCH_BITS, MOST_APART = 2, 36
#: Word hashes that a worker keeps.
CACHE = 200_000
_EVEN = np.uint64(0x5555555555555555)
_rng = np.random.RandomState(20_25)
_A = (_rng.randint(0, 1 << 31, VALUES).astype(np.uint32) << np.uint32(1)) | np.uint32(1)
_B = _rng.randint(0, 1 << 31, VALUES).astype(np.uint32) * np.uint32(2) + _rng.randint(0, 2, VALUES).astype(np.uint32)
_STEP, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


class _Words(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE:
            self.clear()
        self[word] = h = xxhash.xxh3_64_intdigest(word)
        return h



def _words() -> _Words:
    """The word hashes that this process keeps."""
    return held(("words",), _Words)


def shingle_set(text: str | None, width: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles; A-Z is lower-cased, ASCII white space separates.

    With fewer words than `width`, all of them are one shingle; without words, the set is empty.
    """
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    w = np.fromiter(map(_words().__getitem__, words), np.uint64, len(words))
    k = min(width, len(w))
    with np.errstate(over="ignore"):
        h = np.full(len(w) - k + 1, k, np.uint64)
        for i in range(k):
            h = (h ^ w[i : len(w) - k + 1 + i]) * _STEP
            h ^= h >> np.uint64(32)
        h *= _MIX
        h ^= h >> np.uint64(29)
    return np.unique(h)


def fingerprint(s: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(s.tobytes())


def signature(s: np.ndarray) -> np.ndarray:
    """VALUES MinHash values of a set that isn't empty."""
    x = (s >> np.uint64(32)).astype(np.uint32)
    out = np.full(VALUES, 0xFFFFFFFF, np.uint32)
    with np.errstate(over="ignore"):
        for i in range(0, len(x), 2048):
            np.minimum(out, (x[i : i + 2048, None] * _A + _B).min(axis=0), out=out)
    return out


def trees(signatures: np.ndarray) -> np.ndarray:
    """The low 16 bits of the values, tree after tree, as bytes that sort like the values: rows of 2 * VALUES bytes."""
    return (signatures & np.uint32(0xFFFF)).astype(">u2").view(np.uint8).reshape(len(signatures), 2 * VALUES)


def sketches(signatures: np.ndarray) -> np.ndarray:
    """Two bits of each value: rows of four 64-bit numbers."""
    bits = ((signatures >> np.uint32(16)) & np.uint32(3)).astype(np.uint64).reshape(len(signatures), -1, 32)
    return np.bitwise_or.reduce(bits << (np.uint64(SKETCH_BITS) * np.arange(32, dtype=np.uint64)), axis=-1)


def apart(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Number of disagreeing values of sketches."""
    x = a ^ b
    return np.bitwise_count((x | (x >> np.uint64(1))) & _EVEN).sum(axis=-1, dtype=np.int64)


def common(a: list[np.ndarray], b: list[np.ndarray], columns: int = 8192) -> np.ndarray:
    """Exact sizes of the intersections of every set in a with every set in b."""
    out = np.zeros((len(a), len(b)), np.float32)
    every = np.concatenate([*a, *b])
    row = np.repeat(np.arange(len(a) + len(b)), [len(s) for s in (*a, *b)])
    order = np.argsort(every, kind="stable")
    every, row = every[order], row[order]
    new = np.empty(len(every), bool)
    new[:1] = True
    np.not_equal(every[1:], every[:-1], out=new[1:])
    column = np.cumsum(new) - 1
    shared = np.bincount(column)[column] > 1 if len(column) else np.empty(0, bool)
    row, column = row[shared], column[shared]
    if not len(row):
        return out.astype(np.int64)
    column = np.cumsum(np.concatenate([[0], column[1:] != column[:-1]]))
    cuts = np.searchsorted(column, np.arange(0, column[-1] + columns + 1, columns))
    for i in range(len(cuts) - 1):
        r, c = row[cuts[i] : cuts[i + 1]], column[cuts[i] : cuts[i + 1]] - i * columns
        m = np.zeros((len(a) + len(b), min(columns, int(column[-1]) + 1 - i * columns)), np.float32)
        m[r, c] = 1
        out += m[: len(a)] @ m[len(a) :].T
    return np.rint(out).astype(np.int64)


def links(a: list[np.ndarray], b: list[np.ndarray], percent: int) -> np.ndarray:
    """Whether 100 * intersection >= percent * union, for every pair; empty sets have no links."""
    both = common(a, b)
    n, m = np.array([len(s) for s in a], np.int64), np.array([len(s) for s in b], np.int64)
    union = n[:, None] + m[None, :] - both
    return (100 * both >= percent * union) & (both > 0)
