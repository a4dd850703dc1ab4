"""Array kernels on runs of UTF-8 bytes: words, word hashes, shingles, mixing of hashes.

A run holds the texts of several rows end to end; ``offsets`` says where each begins. All
arithmetic is on unsigned 64-bit integers and wraps.
"""

from __future__ import annotations

import numpy as np

U = np.uint64

_WHITE = np.zeros(256, bool)
_WHITE[[0x20, *range(0x09, 0x0E)]] = True

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32

# Everything but ASCII letters and digits, and bytes of longer characters, ends a term.
_MARKS = np.ones(256, bool)
_MARKS[0x80:] = False
for _a, _b in ((48, 58), (65, 91), (97, 123)):
    _MARKS[_a:_b] = False

_BYTE = np.random.Generator(np.random.PCG64(20240229)).integers(1, 1 << 63, 256, np.uint64) | U(1)
_BASE = U(0x9E3779B97F4A7C15)
_INVERSE = U(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_powers: dict[str, np.ndarray] = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def _power_table(name: str, base: np.uint64, n: int) -> np.ndarray:
    """base ** 0 .. base ** (n - 1), kept between calls."""
    table = _powers[name]
    while len(table) < n:
        step = table[-1:] * base
        table = np.concatenate([table, table * step])
        _powers[name] = table
    return table[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble, so that the order of hashes says nothing about the texts."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U(27))
    x = x * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def prefix_sums(raw: np.ndarray, lower: bool = False) -> np.ndarray:
    """S with S[i] = sum over j < i of code(raw[j]) * base ** j."""
    codes = _BYTE[_LOWER] if lower else _BYTE
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(codes[raw] * _power_table("up", _BASE, len(raw)), out=sums[1:])
    return sums


def span_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of raw[start:end] for each pair, the same wherever the bytes stand."""
    down = _power_table("down", _INVERSE, len(sums))
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def window_hashes(sums: np.ndarray, width: int) -> np.ndarray:
    """Hash of every ``width`` bytes in a row."""
    down = _power_table("down", _INVERSE, len(sums))[:len(sums) - width]
    return mix((sums[width:] - sums[:-width]) * down)


def words(
    raw: np.ndarray, offsets: np.ndarray, terms: bool = False
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, first): byte spans of all words, and the number of each row's first.

    Words are what stands between ASCII white space; ``terms`` also parts them at ASCII
    punctuation. No word crosses rows.
    """
    n = len(raw)
    inside = ~(_MARKS if terms else _WHITE)[raw]
    border = np.zeros(n + 1, bool)
    border[offsets] = True
    before = np.zeros(n, bool)
    before[1:] = inside[:-1]
    after = np.zeros(n, bool)
    after[:-1] = inside[1:]
    starts = np.flatnonzero(inside & (~before | border[:-1]))
    ends = np.flatnonzero(inside & (~after | border[1:])) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of each word with A-Z as a-z."""
    return span_hashes(prefix_sums(raw, lower=True), starts, ends)


_PLACE = [U(0xA0761D6478BD642F), U(0xE7037ED1A0B428DB), U(0x8EBC6AF09C88C6E3),
          U(0x589965CC75374CC3), U(0x1D8E4E27C47D124F)]


def shingles(hashes: np.ndarray, first: np.ndarray, width: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """(shingle hashes, first): ``width`` words in a row, within rows.

    A row with fewer words has its whole sequence as the one shingle, an empty row none.
    """
    n = len(hashes)
    count = np.diff(first)
    made = np.where(count >= width, count - width + 1, (count > 0).astype(count.dtype))
    start = np.concatenate([[0], np.cumsum(made)])
    at = np.repeat(first[:-1] - start[:-1], made) + np.arange(start[-1])
    length = np.repeat(np.minimum(count, width), made)
    out = np.zeros(len(at), np.uint64)
    for k in range(width):
        place = _PLACE[k % 5] + U(2 * (k // 5))
        here = hashes[np.minimum(at + k, max(n - 1, 0))] * place if n else out
        out += here if (length > k).all() else np.where(length > k, here, U(0))
    return mix(out + length.astype(np.uint64)), start


def sorted_sets(values: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each row's values sorted, repeats removed."""
    values = values.copy()
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        values[a:b].sort()
    fresh = np.ones(len(values), bool)
    fresh[1:] = values[1:] != values[:-1]
    fresh[first[:-1][first[:-1] < len(values)]] = True
    kept = np.concatenate([[0], np.cumsum(fresh)])
    return values[fresh], kept[first]
