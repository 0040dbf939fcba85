"""128-bit numbers for the words of many texts, as numpy arrays.

A word is a run of characters other than space and tab to return. Equal words have equal
numbers in every worker; nothing depends on the process."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

#: Odd multipliers of the two lanes.
FACTORS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)


def word_hashes(texts: pa.Array, lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """(words x 2 numbers, first word of each text and the end); a null text has no words."""
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    lists = pc.ascii_split_whitespace(texts)
    coded = lists.flatten().dictionary_encode()
    distinct = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
    # bytes know only A-Z; Arrow's own ascii_lower goes wrong on slices
    hashed = (w.encode().lower() for w in distinct) if lower else distinct
    digests = b"".join(map(xxhash.xxh3_128_digest, hashed))
    numbers = np.frombuffer(digests, "<u8").reshape(-1, 2)
    index = coded.indices.to_numpy(zero_copy_only=False)
    bounds = lists.offsets.to_numpy() - lists.offsets[0].as_py()
    try:  # blanks at the ends of a text leave an empty word
        empty = distinct.index("")
    except ValueError:
        return numbers[index], bounds
    real = index != empty
    return numbers[index[real]], np.concatenate([[0], np.cumsum(real)])[bounds]


def mix(x: np.ndarray) -> np.ndarray:
    """Well-spread 64-bit numbers from any; one to one."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def windows(numbers: np.ndarray, size: int, lane: int) -> np.ndarray:
    """Numbers of all windows of ``size`` consecutive words, by doubling."""
    n = len(numbers) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    factor = FACTORS[lane]
    power, reach = numbers[:, lane].copy(), 1
    # power[i] covers words i .. i + reach - 1
    at, out, need = 0, None, size
    while need:
        if need & 1:
            piece = power[at:at + n]
            out = piece.copy() if out is None else out * np.uint64(pow(factor, reach, 1 << 64)) + piece
            at += reach
        need >>= 1
        if need:
            longer = power[:-reach] * np.uint64(pow(factor, reach, 1 << 64)) + power[reach:]
            power, reach = longer, reach * 2
    return mix(out)
