"""64-bit hashes of the words of a text, computed for all words at once."""

from __future__ import annotations

from typing import Iterator

import numpy as np

PIECE_BYTES = 4 << 20

_random = np.random.default_rng(20260101)
_BYTE_VALUE = _random.integers(1, 1 << 63, 256, dtype=np.uint64)
_ODD = np.uint64(0x9E3779B97F4A7C15)
_powers = np.ones(1, np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers (the finishing step of the splitmix generator)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Alphabet:
    """Which bytes separate words, and which value each other byte has; A-Z counts as a-z."""

    def __init__(self, separators: bytes) -> None:
        self.separates = np.zeros(256, bool)
        self.separates[list(separators)] = True
        self.value = _BYTE_VALUE.copy()
        self.value[ord("A"):ord("Z") + 1] = self.value[ord("a"):ord("z") + 1]
        self.value[self.separates] = 0


WHITE = Alphabet(b"\x20\x09\x0a\x0b\x0c\x0d")
LETTERS = Alphabet(bytes(b for b in range(128) if not chr(b).isalnum()))


def _power_table(length: int) -> np.ndarray:
    global _powers
    while len(_powers) < length:
        _powers = np.concatenate([_powers, _powers * (_powers[-1:] * _ODD)])
    return _powers


def _pieces(raw: np.ndarray, separates: np.ndarray) -> Iterator[np.ndarray]:
    """Cut a long text at separators, so that temporary arrays stay small."""
    while len(raw) > PIECE_BYTES:
        gaps = np.flatnonzero(separates[raw[:PIECE_BYTES]])
        if not len(gaps):
            gaps = np.flatnonzero(separates[raw])
            if not len(gaps):
                break
            gaps = gaps[:1]
        yield raw[:gaps[-1] + 1]
        raw = raw[gaps[-1] + 1:]
    yield raw


def word_hashes(text: str | None, alphabet: Alphabet = WHITE) -> np.ndarray:
    """Hashes of the words in order: equal for words that differ only in the case of A-Z."""
    if not text:
        return np.empty(0, np.uint64)
    found = []
    for raw in _pieces(np.frombuffer(text.encode(), np.uint8), alphabet.separates):
        inside = ~alphabet.separates[raw]
        first = inside.copy()
        first[1:] &= ~inside[:-1]
        starts = np.flatnonzero(first)
        if not len(starts):
            continue
        raw = raw[starts[0]:]
        starts -= starts[0]
        place = np.arange(len(raw)) - np.repeat(starts, np.diff(starts, append=len(raw)))
        powers = _power_table(int(place.max()) + 1)
        found.append(mix(np.add.reduceat(alphabet.value[raw] * powers[place], starts)))
    return np.concatenate(found) if found else np.empty(0, np.uint64)


def chain(*words: np.ndarray) -> np.ndarray:
    """One hash for each tuple of words at the same place of the given arrays."""
    total = np.zeros(len(words[0]), np.uint64)
    for word in words:
        total = mix(total * _ODD + word + np.uint64(len(words)))
    return total


def shingles(words: np.ndarray, size: int) -> np.ndarray:
    """Sorted distinct hashes of the runs of ``size`` words; a shorter text has its whole sequence as one."""
    if not len(words):
        return words
    size = min(size, len(words))
    return np.unique(chain(*[words[i:len(words) - size + 1 + i] for i in range(size)]))
