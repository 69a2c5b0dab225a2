"""Words of many texts as numpy arrays.

``map_in_arrow`` tasks get texts as one byte buffer with offsets. The functions
here find words and their 64-bit hashes for all texts of a bounded piece at
once, so that a text costs a few array operations instead of a Python loop over
its words. A word is a run of bytes other than 0x20 and 0x09-0x0D; A-Z count as
a-z.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

# Text bytes handled at once; only a longer single text is handled in a larger piece.
PIECE_BYTES = 1 << 20

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
# Letters, digits and all bytes of other scripts.
LETTERS = np.zeros(256, dtype=bool)
LETTERS[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
_ODD = 0x9E3779B97F4A7C15
_ODD_INVERSE = pow(_ODD, -1, 1 << 64)


def mix(values: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    x = values + np.uint64(_ODD)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTE_VALUES = mix(np.arange(256, dtype=np.uint64))
_powers: dict[str, np.ndarray] = {}


def _power(base: int, length: int) -> np.ndarray:
    """base**0 .. base**(length - 1), modulo 2**64."""
    known = _powers.get(str(base))
    if known is None or len(known) < length:
        known = np.full(max(length, PIECE_BYTES + 1), np.uint64(base))
        known[0] = 1
        known = np.cumprod(known, dtype=np.uint64)
        if length <= 4 * PIECE_BYTES:
            _powers[str(base)] = known
    return known[:length]


class Piece(NamedTuple):
    """Some texts next to each other: their rows, bytes and the bounds of each."""

    first: int
    data: np.ndarray
    bounds: np.ndarray

    def __len__(self) -> int:
        return len(self.bounds) - 1


class Words(NamedTuple):
    """Words of a piece: byte bounds, and the first word of each text (and one more)."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    of_text: np.ndarray


def pieces(texts: pa.Array, limit: int = PIECE_BYTES) -> Iterator[Piece]:
    """The texts of an Arrow column (null: empty) in pieces of bounded size."""
    column = texts.cast(pa.large_string()).fill_null("")
    if not len(column):
        return
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    held = column.buffers()[2]
    data = np.frombuffer(held, dtype=np.uint8) if held else np.zeros(0, np.uint8)
    row = 0
    while row < len(column):
        last = int(np.searchsorted(offsets, offsets[row] + limit, side="right")) - 1
        last = min(max(last, row + 1), len(column))
        yield Piece(row, data[offsets[row] : offsets[last]], offsets[row : last + 1] - offsets[row])
        row = last


def words(
    piece: Piece, lower: bool = True, solid_bytes: np.ndarray = ~_SPACE, cuts: np.ndarray | None = None
) -> Words:
    """Runs of ``solid_bytes`` (a flag per byte value); a run never crosses into the next text.

    ``cuts`` flags bytes at which a new run begins within one.
    """
    data = _LOWER[piece.data] if lower else piece.data
    size = len(data)
    solid = solid_bytes[data]
    opens = np.ones(size, dtype=bool)
    opens[1:] = ~solid[:-1]
    closes = np.ones(size, dtype=bool)
    closes[:-1] = ~solid[1:]
    if cuts is not None:
        opens |= cuts
        closes[:-1] |= cuts[1:]
    edges = piece.bounds[(piece.bounds > 0) & (piece.bounds < size)]
    opens[edges] = True
    closes[edges - 1] = True
    starts = np.flatnonzero(solid & opens)
    ends = np.flatnonzero(solid & closes) + 1
    return Words(data, starts, ends, np.searchsorted(starts, piece.bounds))


def prefix_sums(data: np.ndarray) -> np.ndarray:
    """Sums from which any run's polynomial hash is a difference."""
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(_BYTE_VALUES[data] * _power(_ODD, len(data)), out=sums[1:])
    return sums


def run_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each run of bytes; equal runs have equal hashes wherever they stand."""
    return mix((sums[ends] - sums[starts]) * _power(_ODD_INVERSE, len(sums))[starts])


def word_hashes(found: Words) -> np.ndarray:
    return run_hashes(prefix_sums(found.data), found.starts, found.ends)


def shingle_hashes(hashes: np.ndarray, of_text: np.ndarray, width: int) -> list[np.ndarray]:
    """For each text its runs of ``width`` word hashes, hashed, in order; a shorter text is one run."""
    joined = np.zeros(max(len(hashes) - width + 1, 0), dtype=np.uint64)
    factors = mix(np.arange(1, width + 1, dtype=np.uint64)) | np.uint64(1)
    for k in range(width if len(joined) else 0):
        joined += hashes[k : k + len(joined)] * factors[k]
    joined = mix(joined)
    found = []
    for first, last in zip(of_text[:-1].tolist(), of_text[1:].tolist(), strict=True):
        if last - first >= width:
            found.append(joined[first : last - width + 1])
        elif last > first:
            short = (hashes[first:last] * factors[: last - first]).sum(dtype=np.uint64) + np.uint64(last - first)
            found.append(mix(np.array([short], dtype=np.uint64)))
        else:
            found.append(hashes[:0])
    return found
