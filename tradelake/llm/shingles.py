"""Words and word shingles of texts as 64-bit fingerprints."""

from __future__ import annotations

import numpy as np
import xxhash

#: Words that are kept at most, and the longest of them.
WORD_LIMIT, WORD_BYTES = 300_000, 100


class WordHashes(dict):
    """Fingerprints of words (bytes); starts anew when it holds ``WORD_LIMIT`` words."""

    def __missing__(self, word: bytes) -> int:
        out = xxhash.xxh3_64_intdigest(word)
        if len(word) <= WORD_BYTES:
            if len(self) >= WORD_LIMIT:
                self.clear()
            self[word] = out
        return out


def words_of(text: str | None) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased; bytes methods touch ASCII only."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (the finalizer of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def chain(columns: list[np.ndarray]) -> np.ndarray:
    """One fingerprint for each row of several columns, in their order."""
    out = mix(columns[0] + np.uint64(len(columns)))
    for x in columns[1:]:
        out = mix(out * np.uint64(0x9E3779B97F4A7C15) + x)
    return out


def shingle_set(text: str | None, size: int, known: WordHashes) -> np.ndarray:
    """Sorted distinct fingerprints of a text's shingles of ``size`` words; a shorter text is one shingle."""
    words = words_of(text)
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    if len(h) < size:
        return chain([h[i : i + 1] for i in range(len(h))])
    return np.unique(chain([h[i : len(h) - size + 1 + i] for i in range(size)]))
