"""Simple-8b: word-aligned integer coding, all steps over whole arrays.

A 64-bit word holds a selector in its upper four bits and a fixed number of equally wide
values below, the first one lowest. Values of more than 60 bits go to an escape table, and
a word of its own holds the place there. Coding starts anew at every block, so any
block can be decoded alone from its word offset, and every word says what it holds, so all
words are decoded at once."""

from __future__ import annotations

import numpy as np

BLOCK = 1024
#: Fixed values of the format: selector -> (values, bits); 0 is the escape.
LAYOUT = {0: (1, 60), 1: (240, 0), 2: (60, 1), 3: (30, 2), 4: (20, 3), 5: (15, 4), 6: (12, 5), 7: (10, 6),
          8: (8, 7), 9: (7, 8), 10: (6, 10), 11: (5, 12), 12: (4, 15), 13: (3, 20), 14: (2, 30), 15: (1, 60)}
COUNTS = np.array([LAYOUT[s][0] for s in range(16)], dtype=np.int64)
#: Windows of n values made of two shorter ones that cover them.
_JOINS = {2: (1, 1), 3: (2, 1), 4: (2, 2), 5: (4, 1), 6: (4, 2), 7: (4, 3), 8: (4, 4), 10: (8, 2), 12: (8, 4),
          15: (8, 7), 20: (15, 5), 30: (15, 15), 60: (30, 30), 120: (60, 60), 240: (120, 120)}
_SMALL = np.zeros(1 << 16, dtype=np.uint8)
for _bit in range(16):
    _SMALL[1 << _bit:] = _bit + 1


def widths(values: np.ndarray) -> np.ndarray:
    if not len(values) or int(values.max()) < 1 << 16:
        return _SMALL[values.astype(np.uint16)]
    out = np.zeros(len(values), dtype=np.uint8)
    for bit in range(64):
        out += values >= np.uint64(1 << bit)
    return out


def encode(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(words, word offset of each block, escaped values)."""
    values = np.ascontiguousarray(values, dtype=np.uint64)
    n = len(values)
    blocks = -(-n // BLOCK)
    if not blocks:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    # beyond the end of a block nothing fits
    wide = np.full((blocks, BLOCK), 255, dtype=np.uint8)
    wide.reshape(-1)[:n] = widths(values)
    count = np.ones((blocks, BLOCK), dtype=np.uint8)
    select = np.where(wide <= 60, 15, 0).astype(np.uint8)
    most = {1: wide}
    by_count = {c: (s, b) for s, (c, b) in LAYOUT.items() if s}
    for c, (left, right) in _JOINS.items():
        joined = np.full_like(wide, 255)
        joined[:, :BLOCK - left] = np.maximum(most[left][:, :BLOCK - left], most[right][:, left:])
        most[c] = joined
        if c in by_count:
            s, bits = by_count[c]
            fits = joined <= bits
            if not fits.any():
                break  # longer windows have fewer bits
            select[fits], count[fits] = s, c
    # first value of every word: all blocks step at once
    starts = np.zeros((blocks, BLOCK), dtype=bool)
    ends = np.full(blocks, BLOCK)
    ends[-1] = n - (blocks - 1) * BLOCK
    row, at = np.arange(blocks), np.zeros(blocks, dtype=np.int64)
    while len(row):
        starts[row, at] = True
        at = at + count[row, at]
        going = at < ends[row]
        if not going.all():
            row, at = row[going], at[going]
    first = np.flatnonzero(starts)
    chosen = select.reshape(-1)[first]
    words = chosen.astype(np.uint64) << np.uint64(60)
    for s in np.unique(chosen):
        c, bits = LAYOUT[int(s)]
        mine = np.flatnonzero(chosen == s)
        if s == 0:
            escaped = values[first[mine]]
            words[mine] |= np.arange(len(mine), dtype=np.uint64)
        elif bits:
            for k in range(c):
                words[mine] |= values[first[mine] + k] << np.uint64(k * bits)
    offsets = np.searchsorted(first, np.arange(blocks) * BLOCK)
    return words, offsets, escaped if (chosen == 0).any() else np.zeros(0, np.uint64)


def decode(words: np.ndarray, escaped: np.ndarray) -> np.ndarray:
    """The values of whole blocks."""
    chosen = (words >> np.uint64(60)).astype(np.int64)
    counts = COUNTS[chosen]
    ends = np.cumsum(counts)
    out = np.zeros(int(ends[-1]) if len(ends) else 0, dtype=np.uint64)
    for s in np.unique(chosen):
        c, bits = LAYOUT[int(s)]
        mine = np.flatnonzero(chosen == s)
        place = ends[mine] - counts[mine]
        if s == 0:
            out[place] = escaped[(words[mine] & np.uint64((1 << 60) - 1)).astype(np.int64)]
        elif bits:
            mask = np.uint64((1 << bits) - 1)
            for k in range(c):
                out[place + k] = (words[mine] >> np.uint64(k * bits)) & mask
    return out
