"""Vectorised word hashing over the UTF-8 buffer of an Arrow string column.

A word is a run of bytes that aren't separators. Its hash is a polynomial over the bytes (A-Z
lower-cased), taken from one running sum per block, so no Python object is made per word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SPACES = b" \t\n\x0b\x0c\r"
PUNCTUATION = bytes(c for c in range(33, 127) if not chr(c).isalnum())
#: Bytes of text hashed at once; a longer document is hashed in pieces that end at separators.
BLOCK = 1 << 20

_rng = np.random.Generator(np.random.PCG64(20240517))
_BYTE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BYTE[65:91] = _BYTE[97:123]
_BASE = 0x9E3779B97F4A7C15 | 5
_INVERSE = pow(_BASE, -1, 1 << 64)
#: Odd factors by position in an n-gram, and what marks a sequence shorter than the n-gram.
_PLACE = _rng.integers(1, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SHORT = _rng.integers(1, 1 << 63, 64, dtype=np.uint64)
_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    have = _powers.get(base)
    if have is None or len(have) < n:
        have = np.full(max(n, BLOCK + 1), base, np.uint64)
        have[0] = 1
        _powers[base] = have = np.multiply.accumulate(have)
    return have


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (a bijection)."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


def separator_table(separators: bytes) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(separators)] = True
    return table


def _hash_piece(data: np.ndarray, breaks: np.ndarray, table: np.ndarray, stems: tuple[int, ...] = ()) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Hash and start of each word in data, and for each of stems the hashes of the words' first bytes.

    Words also end at the offsets in breaks.
    """
    n = len(data)
    inside = ~table[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    cut = breaks[(breaks > 0) & (breaks < n)]
    first[cut] = inside[cut]
    last[cut - 1] = inside[cut - 1]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(_BYTE[data] * _power(_BASE, n)[:n], out=total[1:])
    back = _power(_INVERSE, n + 1)[start]
    begun = [mix((total[np.minimum(end, start + k)] - total[start]) * back + _SHORT[k]) for k in stems]
    return mix((total[end] - total[start]) * back), start, begun


def buffers(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and the offsets of each row in them."""
    _, offsets, data = col.buffers()
    offsets = np.frombuffer(offsets, np.int32)[col.offset : col.offset + len(col) + 1].astype(np.int64)
    return np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8), offsets


def blocks(offsets: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Ranges of whole rows of about most bytes; one row may be longer."""
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + most, "right")) - 1)
        yield lo, min(hi, n)
        lo = min(hi, n)


def word_hashes(col: pa.Array, separators: bytes = SPACES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """For ranges of rows lo..hi: the hashes of all their words, and each row's offset among them."""
    for lo, hi, h, at, _ in stem_hashes(col, separators, ()):
        yield lo, hi, h, at


def stem_hashes(col: pa.Array, separators: bytes, stems: tuple[int, ...]) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, list[np.ndarray]]]:
    """As word_hashes, and for each length in stems the hashes of the words' first so many bytes."""
    data, offsets = buffers(col)
    table = separator_table(separators)
    for lo, hi in blocks(offsets, BLOCK):
        base, stop = int(offsets[lo]), int(offsets[hi])
        bounds = offsets[lo : hi + 1] - base
        if stop - base <= BLOCK:
            h, start, begun = _hash_piece(data[base:stop], bounds, table, stems)
            yield lo, hi, h, np.searchsorted(start, bounds, "left"), begun
        else:  # one long row
            parts, at = [], base
            while at < stop:
                end = min(at + BLOCK, stop)
                if end < stop:
                    back = np.flatnonzero(table[data[at:end]])
                    if len(back):
                        end = at + int(back[-1]) + 1
                    else:  # a word longer than a block
                        ahead = np.flatnonzero(table[data[end:stop]])
                        end = end + int(ahead[0]) + 1 if len(ahead) else stop
                parts.append(_hash_piece(data[at:end], np.zeros(0, np.int64), table, stems))
                at = end
            h = np.concatenate([p[0] for p in parts])
            yield lo, hi, h, np.array([0, len(h)]), [np.concatenate([p[2][k] for p in parts]) for k in range(len(stems))]


def grams(h: np.ndarray, offsets: np.ndarray, n: int, short: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of n words within a row, and each row's offset among them.

    short: a row of 1 to n-1 words has its whole sequence as the one gram; else it has none.
    """
    count = np.diff(offsets)
    made = np.maximum(count - n + 1, 0)
    if len(h) >= n:
        g = np.zeros(len(h) - n + 1, np.uint64)
        for k in range(n):
            g += h[k : len(h) - n + 1 + k] * _PLACE[k]
        keep = np.ones(len(g) + n - 1, bool)
        for k in range(1, n):
            end = offsets[1:] - k
            keep[end[end >= offsets[:-1]]] = False
        g = mix(g[keep[: len(g)]])
    else:
        g = np.zeros(0, np.uint64)
    if short and (few := np.flatnonzero((count > 0) & (count < n))).size:
        extra = np.zeros(len(few), np.uint64)
        for k in range(n - 1):
            has = count[few] > k
            extra[has] += h[offsets[few[has]] + k] * _PLACE[k]
        extra = mix(extra + _SHORT[count[few]])
        g = np.insert(g, np.concatenate([[0], np.cumsum(made)])[few], extra)
        made[few] = 1
    return g, np.concatenate([[0], np.cumsum(made)])
