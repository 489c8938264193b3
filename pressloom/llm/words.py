"""Words of whole texts as 64-bit hashes: numpy over the bytes of an Arrow batch, no loop over words.

A word is a maximal run of bytes that a table maps to a code other than 0. All separators here are
ASCII, so byte runs and code point runs are the same in UTF-8. Texts of a batch are taken in slices
of bounded size; only a single text larger than the bound makes a slice larger.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 18

_RNG = np.random.default_rng(20260301)
_CODES = _RNG.integers(1, 2**64, 256, dtype=np.uint64)
_BASE = 0x9E3779B97F4A7C15
_STEP = np.uint64(0xD6E8FEB86659FD93)


def _table(separators: bytes) -> np.ndarray:
    codes = _CODES.copy()
    codes[ord("A") : ord("Z") + 1] = codes[ord("a") : ord("z") + 1]
    codes[list(separators)] = 0
    return codes


#: Words [^\x20\x09-\x0D]+ after lower-casing A-Z.
SPACED = _table(b"\x20\x09\x0a\x0b\x0c\x0d")
#: Words [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ after lower-casing A-Z: digits, letters, all beyond ASCII.
ALNUM = _table(bytes([*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every input bit over all output bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(bits: int) -> tuple[np.ndarray, np.ndarray]:
    def run(base: int) -> np.ndarray:
        out = np.ones(1 << bits, np.uint64)
        for k in range(bits):  # doubling: x^(j + 2^k) = x^j * x^(2^k)
            out[1 << k : 2 << k] = out[: 1 << k] * np.uint64(pow(base, 1 << k, 2**64))
        return out

    return run(_BASE), run(pow(_BASE, -1, 2**64))


@dataclass
class Words:
    """Words of the texts ``row .. row + len(first) - 1`` of a batch."""

    row: int
    hashes: np.ndarray  # uint64, one per word
    first: np.ndarray  # int64: text i has the words first[i] to first[i + 1]

    def grams(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of k consecutive words at every position, and which of them lie within one text."""
        n = len(self.hashes)
        out = np.zeros(n, np.uint64)
        for j in range(min(k, n)):
            out[: n - j] += self.hashes[j:] * np.uint64(pow(int(_STEP), j + 1, 2**64))
        last = np.repeat(self.first[1:], np.diff(self.first))
        return mix(out ^ np.uint64(k)), np.arange(n) + k <= last


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Where each text of a binary array begins, with the end of the last, and all their bytes."""
    size = np.int64 if pa.types.is_large_binary(texts.type) else np.int32
    _, offsets, data = texts.buffers()
    ends = np.frombuffer(offsets, size)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    return ends, np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)


def slices(texts: pa.Array, codes: np.ndarray, most: int = SLICE_BYTES) -> Iterator[Words]:
    """Words of all texts of a binary Arrow array (no nulls), some texts at a time."""
    ends, raw = buffers(texts)
    row, powers = 0, _powers(min(most, len(raw)).bit_length())
    while row < len(texts):
        stop = max(row + 1, int(np.searchsorted(ends, ends[row] + most, "right")) - 1)
        size = int(ends[stop] - ends[row])
        if size > len(powers[0]):
            powers = _powers(size.bit_length())
        yield _words(row, raw[ends[row] : ends[stop]], ends[row : stop + 1] - ends[row], codes, powers)
        row = stop


def of_text(hashes: np.ndarray) -> Words:
    """One text whose words are hashed already."""
    return Words(0, hashes, np.array([0, len(hashes)]))


def _words(row: int, raw: np.ndarray, ends: np.ndarray, codes: np.ndarray, powers: tuple) -> Words:
    n = len(raw)
    if n == 0:
        return Words(row, np.zeros(0, np.uint64), np.zeros(len(ends), np.int64))
    power, inverse = powers
    value = codes[raw]
    inside = value != 0
    edge = np.zeros(n + 1, bool)  # where a text ends, a word ends too
    edge[ends] = True
    start = inside.copy()
    start[1:] &= ~inside[:-1] | edge[1:-1]
    end = inside.copy()
    end[:-1] &= ~inside[1:] | edge[1:-1]
    starts, stops = np.flatnonzero(start), np.flatnonzero(end)
    total = np.cumsum(value * power[:n], dtype=np.uint64)
    hashes = total[stops] - np.where(starts > 0, total[starts - 1], np.uint64(0))
    hashes = mix(hashes * inverse[starts])
    return Words(row, hashes, np.searchsorted(starts, ends))
