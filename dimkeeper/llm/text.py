"""Vectorised text primitives over Arrow string columns: words, rolling hashes, sliding minima.

A word's hash is a sum over its bytes of a random number for the byte times another for its place: the
places' numbers are independent, so no pattern of bytes cancels out, however long. Stretches of words
or bytes have polynomial (Rabin-Karp) hashes modulo 2**64. The odd base has an inverse, so that the
hash of any stretch is a difference of two prefix sums. Such a polynomial loses bits on self-similar
sequences of two values as they grow (at 2,048 places all of them), so only stretches of a few hundred
places are hashed by it, and where equality of whole segments is decided, their content is compared.
Everything works on chunks of whole documents of about ``CHUNK`` bytes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK = 1 << 18  # the arrays of a chunk stay near the processor's cache

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_TABLES = [np.random.default_rng(seed).integers(1, 1 << 63, 256, dtype=np.int64).astype(_U) * _U(2) + _U(1) for seed in (1, 2)]
_powers: dict[int, np.ndarray] = {}


def separators(*ranges: tuple[int, int]) -> np.ndarray:
    """A table by byte that is True for word characters, given the ranges of separators."""
    table = np.ones(256, bool)
    for low, high in ranges:
        table[low : high + 1] = False
    return table


#: Words are ``[^\x20\x09-\x0D]+``.
BY_SPACE = separators((0x09, 0x0D), (0x20, 0x20))


def _power(base: int, n: int) -> np.ndarray:
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = max(n, CHUNK + 1)
        have = np.full(size, base, _U)
        have[0] = 1
        _powers[base] = have = np.multiply.accumulate(have)
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


_place_keys: list[np.ndarray] = [np.zeros(0, _U), np.zeros(0, _U)]


def place_keys(n: int, table: int) -> np.ndarray:
    """Random odd numbers for the first ``n`` places of a word."""
    if len(_place_keys[table]) < n:
        seed = _U(0xA0761D6478BD642F if table else 0xE7037ED1A0B428DB)
        _place_keys[table] = mix(np.arange(1, max(n, 4096) + 1, dtype=_U) * _U(0x9E3779B97F4A7C15) ^ seed) | _U(1)
    return _place_keys[table]


@dataclass
class Prefix:
    """Prefix sums of a sequence of numbers, for the hash of any stretch of it."""

    sums: np.ndarray

    @classmethod
    def of(cls, values: np.ndarray) -> Prefix:
        sums = np.zeros(len(values) + 1, _U)
        np.cumsum(values * _power(_BASE, len(values)), out=sums[1:])
        return cls(sums)

    def stretch(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (self.sums[end] - self.sums[start]) * _power(_INVERSE, len(self.sums))[start]

    def windows(self, k: int) -> np.ndarray:
        """The mixed hash of every ``k`` consecutive values."""
        n = max(0, len(self.sums) - k)
        return mix((self.sums[k:] - self.sums[:n]) * _power(_INVERSE, max(n, 1))[:n])


def byte_values(data: np.ndarray, table: int = 0) -> np.ndarray:
    return _TABLES[table][data]


@dataclass
class Chunk:
    """Some whole documents: rows ``first`` to ``first + len(offsets) - 1`` of a batch."""

    first: int
    offsets: np.ndarray
    data: np.ndarray

    @property
    def rows(self) -> int:
        return len(self.offsets) - 1


def chunks(column: pa.Array, limit: int = CHUNK) -> Iterator[Chunk]:
    """The documents of a text column (null: empty), as UTF-8."""
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    if not len(column):
        return
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(column):
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1)
        part = offsets[first : last + 1]
        yield Chunk(first, part - part[0], data[part[0] : part[-1]])
        first = last


@dataclass
class Words:
    start: np.ndarray
    end: np.ndarray
    row: np.ndarray
    first: np.ndarray  # of each row, the number of its first word; one more at the end

    def hashes(self, data: np.ndarray, table: int = 0) -> np.ndarray:
        if not len(self.start):
            return np.zeros(0, _U)
        place = np.zeros(len(data), np.int64)
        place[self.start] = self.start
        place = np.arange(len(data)) - np.maximum.accumulate(place)  # of the byte in its word; elsewhere not used
        longest = int((self.end - self.start).max())
        sums = np.zeros(len(data) + 1, _U)
        np.cumsum(byte_values(data, table) * place_keys(longest, table)[np.minimum(place, longest - 1)], out=sums[1:])
        return mix(sums[self.end] - sums[self.start])

    def counts(self) -> np.ndarray:
        return np.diff(self.first)


def words(chunk: Chunk, table: np.ndarray = BY_SPACE) -> Words:
    inside = table[chunk.data]
    before = np.zeros_like(inside)
    before[1:] = inside[:-1]
    edges = chunk.offsets[(chunk.offsets > 0) & (chunk.offsets < len(inside))]
    before[edges] = False
    after = np.zeros_like(inside)
    after[:-1] = inside[1:]
    after[edges - 1] = False
    start = np.flatnonzero(inside & ~before)
    row = np.searchsorted(chunk.offsets, start, "right") - 1
    return Words(start, np.flatnonzero(inside & ~after) + 1, row, np.searchsorted(row, np.arange(chunk.rows + 1)))


def lowered(data: np.ndarray) -> np.ndarray:
    """A-Z in lower case."""
    return np.where((data >= 65) & (data <= 90), data + np.uint8(32), data)


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """The least of every ``width`` consecutive values."""
    n = len(values) - width + 1
    if n <= 0:
        return values[:0]
    padded = np.full(-(-len(values) // width) * width, np.iinfo(np.uint64).max, _U)
    padded[: len(values)] = values
    grid = padded.reshape(-1, width)
    head = np.minimum.accumulate(grid, axis=1).ravel()
    tail = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(tail[:n], head[width - 1 : width - 1 + n])


def runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of the stretches of True."""
    edges = np.diff(np.concatenate([[0], flags.view(np.int8), [0]]))
    return np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)


def covered(starts: np.ndarray, ends: np.ndarray, n: int) -> np.ndarray:
    """Which of ``n`` places some interval covers."""
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, starts, 1)
    np.add.at(change, ends, -1)
    return np.cumsum(change[:n]) > 0


def binaries(values: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """``values[offsets[i]:offsets[i + 1]]`` as the bytes of row ``i``."""
    values = np.ascontiguousarray(values)
    if values.nbytes >= 1 << 31:
        raise OverflowError("more than 2 GiB of packed values; the text of one row is too long for them")
    at = (offsets * values.dtype.itemsize * (values.shape[1] if values.ndim > 1 else 1)).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(offsets) - 1, [None, pa.py_buffer(at), pa.py_buffer(values)])


def groups(*keys: np.ndarray) -> np.ndarray:
    """Borders of the stretches of equal keys in sorted arrays, first 0 and last the length."""
    n = len(keys[0])
    new = np.zeros(n, bool)
    new[:1] = True
    for key in keys:
        new[1:] |= key[1:] != key[:-1]
    return np.append(np.flatnonzero(new), n)
