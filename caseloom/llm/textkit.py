"""Vectorised tokenising over Arrow text buffers: words, hashes and shingles without a Python object per word."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: The white space of the contracts: [\x20\x09-\x0D].
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
#: For bags of words: everything but ASCII letters, digits and bytes of longer characters parts words.
NON_WORD = np.ones(256, bool)
for _a, _z in ((48, 58), (65, 91), (97, 123), (128, 256)):
    NON_WORD[_a:_z] = False
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: The shape of a byte: A upper case, a lower case or longer character, 0 digit, others themselves.
SHAPE = np.arange(256, dtype=np.uint8)
SHAPE[65:91], SHAPE[97:123], SHAPE[48:58], SHAPE[128:] = 65, 97, 48, 97

_BASE = 0x9E3779B97F4A7C15
_powers: dict[str, np.ndarray] = {}


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers.get("p", ())) <= n:
        m = max(1 << 20, 1 << (n + 1).bit_length())
        for name, base in (("p", _BASE), ("q", pow(_BASE, -1, 1 << 64))):
            x = np.full(m, base, np.uint64)
            x[0] = 1
            _powers[name] = np.cumprod(x, dtype=np.uint64)
    return _powers["p"], _powers["q"]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def chunks(column: pa.Array, limit: int = 1 << 20, most: int | None = None) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of runs of whole texts of about ``limit`` bytes, ``most`` texts at most; null: empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    wide = pa.large_binary()
    column = (column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"") if column.null_count else column).cast(pa.binary() if not str(column.type).startswith("large") else wide)
    if not len(column):
        return
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, np.int64 if column.type == wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    i = 0
    while i < len(column):
        j = max(i + 1, int(np.searchsorted(off, off[i] + limit, "right")) - 1)
        j = min(j, i + most) if most else j
        yield i, j, raw[off[i] : off[j]], off[i : j + 1] - off[i]
        i = j


def spans(data: np.ndarray, off: np.ndarray, parting: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of each word."""
    inside = ~parting[data]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    cut = off[1:-1]
    cut = cut[(cut > 0) & (cut < len(data))]
    first[cut] = inside[cut]
    last[cut - 1] = inside[cut - 1]
    s, e = np.flatnonzero(first), np.flatnonzero(last) + 1
    return s, e, np.searchsorted(off, s, "right") - 1


def span_hashes(data: np.ndarray, s: np.ndarray, e: np.ndarray) -> np.ndarray:
    """64-bit hashes of the bytes in each span, the same wherever the span lies."""
    p, q = _tables(len(data))
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * p[: len(data)], out=total[1:])
    return mix((total[e] - total[s]) * q[s] + (e - s).astype(np.uint64))


def words(data: np.ndarray, off: np.ndarray, parting: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray]:
    """Hash and row of each word, A-Z lower-cased."""
    s, e, row = spans(data, off, parting)
    return span_hashes(LOWER[data], s, e), row


def hash_words(texts: list[bytes]) -> np.ndarray:
    """What ``words`` gives for texts of one word each."""
    off = np.cumsum([0, *map(len, texts)])
    data = np.frombuffer(b"".join(texts), np.uint8)
    return span_hashes(LOWER[data], off[:-1], off[1:])


def shapes(data: np.ndarray, s: np.ndarray, e: np.ndarray) -> np.ndarray:
    """Hashes of the words' shapes, runs of one sign collapsed: 'Ergeb, ' and 'Auf,' agree."""
    sh = SHAPE[data]
    keep = np.ones(len(sh), bool)
    keep[1:] = sh[1:] != sh[:-1]
    keep[s] = True
    place = np.zeros(len(sh) + 1, np.int64)
    np.cumsum(keep, out=place[1:])
    return span_hashes(sh[keep], place[s], place[e])


def shingles(h: np.ndarray, row: np.ndarray, rows: int, width: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hash and row of each run of ``width`` words; a text of fewer words (one at least) gives one shingle of all."""
    n = np.bincount(row, minlength=rows)
    first = np.cumsum(n) - n
    mult = [np.uint64((2 * j + 1) * 0xD1B54A32D192ED03 & (1 << 64) - 1) for j in range(width)]
    m = max(0, len(h) - width + 1)
    full = np.zeros(m, np.uint64)
    for j in range(width):
        full += mix(h[j : j + m] * mult[j])
    at = row[:m]
    ok = at == row[width - 1 : width - 1 + m]
    few = np.flatnonzero((n > 0) & (n < width))
    part = n[few].astype(np.uint64)
    for j in range(width - 1):
        has = n[few] > j
        part[has] += mix(h[first[few[has]] + j] * mult[j])
    return mix(np.concatenate([full[ok], part])), np.concatenate([at[ok], few])
