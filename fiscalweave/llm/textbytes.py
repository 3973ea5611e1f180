"""Words of many texts at once, as numpy arrays over the bytes of an Arrow string column.

A word is a longest run of bytes other than 0x20 and 0x09-0x0D, inside one text. Words and runs of
words get 64-bit hashes from prefix sums, so a whole block of texts costs a few passes over its
bytes and no Python object per word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text that one block of rows holds at most, unless a single text is longer.
BLOCK = 1 << 21

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

#: Odd multipliers of the two independent hash families, and their inverses mod 2**64.
BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)
_powers: dict[int, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit over all others."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) mod 2**64."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = max(1 << 16, 1 << int(n - 1).bit_length())
        have = np.full(size, base, dtype=np.uint64)
        have[0] = 1
        np.multiply.accumulate(have, out=have)
        _powers[base] = have
    return have[:n]


def inverse(base: int) -> int:
    return pow(base, -1, 1 << 64)


class Block:
    """The words of some consecutive texts.

    ``starts`` and ``ends`` are byte positions in ``data``; words first[i]..first[i+1]-1 belong to
    text i of the block; ``rows`` are the row numbers of its texts in the batch.
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray, rows: slice, lower: bool):
        self.rows, self.n = rows, len(offsets) - 1
        self.data = data = _LOWER[data] if lower else data
        self.offsets = offsets
        word = ~_SPACE[data]
        begins, finishes = word.copy(), word.copy()
        begins[1:] &= ~word[:-1]
        finishes[:-1] &= ~word[1:]
        full = offsets[1:] > offsets[:-1]
        at, last = offsets[:-1][full], offsets[1:][full] - 1
        begins[at], finishes[last] = word[at], word[last]
        self.starts = np.flatnonzero(begins)
        self.ends = np.flatnonzero(finishes) + 1
        self.first = np.searchsorted(self.starts, offsets)
        self.counts = np.diff(self.first)

    def text_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(self.n), self.counts)

    def hashes(self, family: int = 0) -> np.ndarray:
        """A 64-bit hash of the bytes of each word."""
        return span_hashes(self.data, self.starts, self.ends, family)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, family: int = 0):
    base = BASES[family]
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(base, len(data)), out=sums[1:])
    back = powers(inverse(base), len(data) + 1)
    return mix((sums[ends] - sums[starts]) * back[starts] + (ends - starts).astype(np.uint64))


def run_hashes(words: np.ndarray, starts: np.ndarray, ends: np.ndarray, family: int = 0):
    """A hash of the word sequence words[start:end] for each pair of positions."""
    base = BASES[1 - family]
    sums = np.zeros(len(words) + 1, dtype=np.uint64)
    np.cumsum(words * powers(base, len(words)), out=sums[1:])
    back = powers(inverse(base), len(words) + 1)
    return mix((sums[ends] - sums[starts]) * back[starts] + (ends - starts).astype(np.uint64))


def string_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offs = np.frombuffer(offsets, kind)[column.offset:column.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offs[0]:offs[-1]], offs - offs[0]


def blocks(column: pa.Array, lower: bool, size: int = BLOCK) -> Iterator[Block]:
    """Consecutive blocks of whole texts; together they cover every row of the column."""
    data, offs = string_bytes(column)
    n, lo = len(offs) - 1, 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offs, offs[lo] + size, "right")) - 1)
        yield Block(data[offs[lo]:offs[hi]], offs[lo:hi + 1] - offs[lo], slice(lo, hi), lower)
        lo = hi


def distinct(owner: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (owner, value) pairs, ordered by owner and value, and how often each occurs."""
    order = np.lexsort((values, owner))
    owner, values = owner[order], values[order]
    new = np.ones(len(values), dtype=bool)
    new[1:] = (owner[1:] != owner[:-1]) | (values[1:] != values[:-1])
    at = np.flatnonzero(new)
    return owner[at], values[at], np.diff(np.append(at, len(values)))


def signed(x: np.ndarray) -> np.ndarray:
    """The same 64 bits as Spark's long."""
    return x.view(np.int64)


def unsigned(x: np.ndarray) -> np.ndarray:
    return x.view(np.uint64)
