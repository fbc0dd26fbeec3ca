"""Classification by compression: what a label's dictionary shortens most is most like that label's texts."""

from __future__ import annotations

import math

import numpy as np
import xxhash
import zstandard

#: Bytes that are compressed at a time, so that a long text keeps being measured against the dictionary and not against itself.
CHUNK = 1024
LEVEL = 3


class Dictionaries:
    """One raw-content dictionary for each label, in label order."""

    def __init__(self, texts: dict[str, list[str]], size: int, chunk: int = CHUNK, level: int = LEVEL):
        self.labels = sorted(texts)
        self.raw = [self.content(texts[x], size) for x in self.labels]
        self.chunk, self.level = chunk, level
        self._open: list[zstandard.ZstdCompressor] | None = None

    @staticmethod
    def content(texts: list[str], size: int) -> bytes:
        """Pieces of all texts, joined; never empty.

        Each piece has size / len(texts) bytes (64 at least), from a place that the text's hash chooses: with
        512 texts and 64,000 bytes, 125 bytes of each.  Pieces that repeat are left out.
        """
        share = max(64, size // max(1, len(texts)))
        pieces: dict[bytes, None] = {}
        for t in texts:
            raw = t.encode()
            at = xxhash.xxh3_64_intdigest(raw) % max(1, len(raw) - share + 1)
            pieces[raw[at : at + share]] = None
        return (b"\n".join(pieces)[:size]).ljust(8, b"\n")

    def __getstate__(self):
        return self.__dict__ | {"_open": None}

    def compressors(self) -> list[zstandard.ZstdCompressor]:
        if self._open is None:
            self._open = []
            for raw in self.raw:
                d = zstandard.ZstdCompressionDict(raw, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
                d.precompute_compress(level=self.level)
                self._open.append(zstandard.ZstdCompressor(dict_data=d, write_content_size=False, write_checksum=False, write_dict_id=False))
        return self._open

    def sizes(self, text: bytes) -> list[int]:
        """Compressed bytes of the whole text under each dictionary."""
        n, view = self.chunk, memoryview(text)
        cut = [view[i : i + n] for i in range(0, len(text), n)]
        return [sum(len(c.compress(x)) for x in cut) for c in self.compressors()]


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3, rounds: int = 60) -> np.ndarray:
    """Weights (the last is the intercept) of a logistic regression, by Newton's method."""
    a = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(a.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        g = a.T @ (p - y) + ridge * w
        h = (a * (p * (1 - p))[:, None]).T @ a + ridge * np.eye(len(w))
        step = np.linalg.solve(h, g)
        w -= step
        if np.abs(step).max() < 1e-9:
            break
    return w


def sigmoid(z: float) -> float:
    return 1 / (1 + math.exp(-max(-40.0, min(40.0, z))))
