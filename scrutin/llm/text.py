"""Words of many texts at once, as numpy arrays over the bytes of an Arrow column.

Texts are UTF-8 bytes; null counts as empty. A slice holds consecutive rows of about ``SLICE_BYTES``
(one row at least), which bounds the memory of a task whatever its input; a single text is never cut.
Words are named by 64-bit hashes that mix in eight bytes at a time, and so do not depend on how words are built: two
different words of a corpus of a billion words get the same name with a probability below 3 %, two words of
one text with one below 1e-9. Words of more than ``LONG`` bytes are named by BLAKE2b. ``span_hash`` is a polynomial
over prefix sums, for spans that overlap; strings made for it can collide, so its users compare bytes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20
LONG = 64
U64 = np.uint64
_ODD = U64(0x9E3779B97F4A7C15)
_BASE = U64(0xD6E8FEB86659FD93)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64 bits over 64 bits, one to one."""
    x = (x ^ (x >> U64(32))) * U64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> U64(32))) * U64(0xD6E8FEB86659FD93)
    return x ^ (x >> U64(32))


def table(*ranges: tuple[int, int]) -> np.ndarray:
    """Which of the 256 byte values lie in the inclusive ranges."""
    found = np.zeros(256, dtype=bool)
    for low, high in ranges:
        found[low : high + 1] = True
    return found


#: Bytes of words that white space parts, and of words made of ASCII letters, digits and all beyond ASCII.
NOT_SPACE = ~table((0x09, 0x0D), (0x20, 0x20))
LETTERS = table((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF))
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20
_NAMES = mix(np.arange(1, 257, dtype=U64) * _ODD)
_powers = [np.ones(1, dtype=U64), np.ones(1, dtype=U64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the base of the prefix sums, and their inverses."""
    if len(_powers[0]) < n:
        inverse = U64(pow(int(_BASE), -1, 1 << 64))
        for k, base in enumerate((_BASE, inverse)):
            grown = np.full(max(n, SLICE_BYTES + 2), base, dtype=U64)
            grown[0] = 1
            _powers[k] = np.multiply.accumulate(grown)
    return _powers[0][:n], _powers[1][:n]


class Slice(NamedTuple):
    """Rows ``first`` to ``first + rows - 1`` of a column; text ``i`` is ``data[offsets[i]:offsets[i+1]]``."""

    first: int
    data: np.ndarray
    offsets: np.ndarray

    @property
    def rows(self) -> int:
        return len(self.offsets) - 1


class Words(NamedTuple):
    """Places of the words of a slice, in order; ``bounds[i]:bounds[i+1]`` are those of text ``i``."""

    start: np.ndarray
    end: np.ndarray
    bounds: np.ndarray


def slices(column: pa.Array | pa.ChunkedArray, limit: int = SLICE_BYTES) -> Iterator[Slice]:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    if not len(column):
        return
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, dtype=np.uint8) if data else np.zeros(0, dtype=np.uint8)
    row = 0
    while row < len(column):
        last = max(row + 1, int(np.searchsorted(offsets, offsets[row] + limit, "right")) - 1)
        last = min(last, len(column), row + 65_536)
        begin = offsets[row]
        yield Slice(row, data[begin : offsets[last]], offsets[row : last + 1] - begin)
        row = last


def words(piece: Slice, inside: np.ndarray = NOT_SPACE) -> Words:
    """Maximal runs of bytes in ``inside``, none across two texts."""
    n = len(piece.data)
    held = np.zeros(n + 2, dtype=bool)
    held[1:-1] = inside[piece.data]
    edge = np.zeros(n + 1, dtype=bool)
    edge[piece.offsets] = True
    start = np.flatnonzero(held[1:] & (~held[:-1] | edge))
    end = np.flatnonzero(held[:-1] & (~held[1:] | edge))
    return Words(start, end, np.searchsorted(start, piece.offsets))


def sums(data: np.ndarray) -> np.ndarray:
    """Prefix sums from which ``span_hash`` takes the hash of any span."""
    total = np.zeros(len(data) + 1, dtype=U64)
    np.cumsum(_NAMES[data] * powers(len(data))[0], out=total[1:])
    return total


def span_hash(total: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A hash of the bytes of each span, its length included."""
    inverse = powers(len(total))[1]
    return mix((total[end] - total[start]) * inverse[start] + (end - start).astype(U64) * _ODD)


def word_hashes(piece: Slice, found: Words, lower: bool = True) -> np.ndarray:
    """A name for each word."""
    data = LOWER[piece.data] if lower else piece.data
    padded = np.zeros(len(data) + 8, dtype=np.uint8)
    padded[: len(data)] = data
    eight = np.ndarray((len(data) + 1,), "<u8", padded, strides=(1,))
    length = found.end - found.start
    names = mix(length.astype(U64) * _ODD)
    live = np.flatnonzero(length <= LONG)
    for at in range(0, LONG, 8):
        rest = length[live] - at
        bits = (np.maximum(8 - rest, 0) * 8).astype(U64)
        # Bytes beyond the word are shifted out.
        value = (eight[found.start[live] + at] << bits) >> bits
        names[live] = mix(names[live] ^ value) * _ODD
        live = live[rest > 8]
        if not len(live):
            break
    for k in np.flatnonzero(length > LONG).tolist():
        word = data[found.start[k] : found.end[k]].tobytes()
        names[k] = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
    return names


def chain(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hashes of the ``n`` consecutive words that begin at each word but the last ``n - 1``."""
    count = max(0, len(hashes) - n + 1)
    out = np.full(count, n, dtype=U64)
    for k in range(n):
        out = out * _BASE + hashes[k : k + count]
    return mix(out)
