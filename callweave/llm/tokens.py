"""Tokens of whole texts as numpy arrays: bytes, places, owners and hashes."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text looked at in one go; only a longer token makes a piece longer.
PIECE = 1 << 20

#: Byte to byte, with A-Z lower-cased.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


@dataclass
class Tokens:
    """Tokens of one piece: ``data[start:end]`` of each, and the row of the column that holds it."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    row: np.ndarray


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts, one after the other, and where each begins (one more entry for the end); null is empty."""
    column = pc.fill_null(column, "").cast(pa.large_string())
    _, places, data = column.buffers()
    offsets = np.frombuffer(places, np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    data = np.zeros(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def tokens(column: pa.Array, inside: np.ndarray) -> Iterator[Tokens]:
    """Tokens of a column of texts, piece by piece: longest runs of bytes for which ``inside`` (by byte) holds.

    No token goes over the end of a text, and none is cut by the end of a piece.
    """
    data, offsets = flat(column)
    at = 0
    while at < len(data):
        end = at + PIECE
        while end < len(data) and not (gap := np.flatnonzero(~inside[data[end - 1 : end - 1 + PIECE]])).size:
            end += PIECE
        end = min(end + int(gap[0]) if end < len(data) else len(data), len(data))
        part = data[at:end]
        ours = inside[part]
        # a text may begin or end inside the piece
        bounds = offsets[(offsets > at) & (offsets < end)] - at
        new, last = ours.copy(), ours.copy()
        joined = ours[1:] & ours[:-1]
        joined[bounds - 1] = False
        new[1:] &= ~joined
        last[:-1] &= ~joined
        start = np.flatnonzero(new)
        yield Tokens(LOWER[part], start, np.flatnonzero(last) + 1, np.searchsorted(offsets, start + at, "right") - 1)
        at = end


def mix(x: np.ndarray) -> np.ndarray:
    """Scrambled bits of 64-bit words; a bijection."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Hashes:
    """64-bit hashes of tokens: a polynomial modulo 2**64 over random values of the bytes, scrambled with the length."""

    def __init__(self, seed: int):
        rng = np.random.default_rng([seed, 65])
        self.value = rng.integers(0, 1 << 64, 256, dtype=np.uint64)
        self.base = int(rng.integers(0, 1 << 62)) * 4 + 1
        self._grow(PIECE + 4096)

    def _grow(self, size: int) -> None:
        self.up = np.full(size, self.base, np.uint64)
        self.down = np.full(size, pow(self.base, -1, 1 << 64), np.uint64)
        self.up[0] = self.down[0] = 1
        np.cumprod(self.up, out=self.up)
        np.cumprod(self.down, out=self.down)

    def of(self, found: Tokens) -> np.ndarray:
        n = len(found.data)
        if n >= len(self.up):
            self._grow(n + 1)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(self.value[found.data] * self.down[1 : n + 1], out=sums[1:])
        return mix((sums[found.end] - sums[found.start]) * self.up[found.end] + (found.end - found.start).astype(np.uint64))
