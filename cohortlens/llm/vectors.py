"""Whole batches of texts as numpy arrays of word hashes; runs inside tasks."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

#: Seed of the byte values and multipliers, fixed so that every task hashes alike.
_FIXED = np.random.Generator(np.random.PCG64(20240229))
_BYTE = _FIXED.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INVERSE = np.uint64(pow(int(_BASE), -1, 2**64))
_PLACE = _FIXED.integers(1, 2**63, 16, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_CHUNK = 1 << 16


def _powers(base: np.uint64) -> np.ndarray:
    out = np.full(_CHUNK, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_POWER, _POWER_INVERSE = _powers(_BASE), _powers(_BASE_INVERSE)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(32))


@dataclass
class Words:
    """Words of several texts, one after the other."""

    data: np.ndarray  # bytes of all texts, a line feed after each
    first_byte: np.ndarray  # of each text, and the end of all
    start: np.ndarray  # byte places of each word
    end: np.ndarray
    hashes: np.ndarray
    first_word: np.ndarray  # of each text, and the number of all words

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first_word)

    @property
    def owner(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.counts)), self.counts)


def words(texts: list[bytes], fold: bool) -> Words:
    """Split texts into words and hash each; `fold` lower-cases A-Z first."""
    joined = b"\n".join([*texts, b""])
    data = np.frombuffer(joined.translate(_FOLD) if fold else joined, np.uint8)
    sizes = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
    first_byte = np.concatenate([[0], np.cumsum(sizes)])
    space = SPACE[data]
    edge = np.flatnonzero(np.diff(np.concatenate([[True], space, [True]]).astype(np.int8)))
    start, end = edge[::2], edge[1::2]
    # Polynomial prefix sums, taken anew each chunk so that the powers stay a small table; a word
    # over an edge is the sum of its parts, each scaled back to the word's first byte.
    hashes = np.zeros(len(start), np.uint64)
    for low in range(0, len(data), _CHUNK):
        high = min(low + _CHUNK, len(data))
        sums = np.zeros(high - low + 1, np.uint64)
        np.cumsum(_BYTE[data[low:high]] * _POWER[: high - low], out=sums[1:])
        a, b = np.searchsorted(end, low, "right"), np.searchsorted(start, high, "left")
        s, e = np.maximum(start[a:b], low) - low, np.minimum(end[a:b], high) - low
        part = (sums[e] - sums[s]) * _POWER_INVERSE[s]
        ahead = np.maximum(low - start[a:b], 0)
        if b > a and ahead[0]:
            part[0] = int(part[0]) * pow(int(_BASE), int(ahead[0]), 2**64) % 2**64
        hashes[a:b] += part
    hashes = mix(hashes + (end - start).astype(np.uint64) * _PLACE[15])
    return Words(data, first_byte, start, end, hashes, np.searchsorted(start, first_byte))


def runs(w: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each run of `size` words that stays in one text, and the number of its text."""
    n = max(0, len(w.hashes) - size + 1)
    total = np.zeros(n, np.uint64)
    for k in range(size):
        total += mix(w.hashes[k : k + n] * _PLACE[k])
    owner = w.owner
    whole = owner[:n] == owner[size - 1 : size - 1 + n]
    return mix(total[whole]), owner[:n][whole]


def sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sum of the values between each two bounds."""
    running = np.cumsum(values)
    total = np.concatenate([np.zeros(1, running.dtype), running])
    return total[bounds[1:]] - total[bounds[:-1]]
