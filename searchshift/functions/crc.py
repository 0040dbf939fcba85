"""CRC-32 of a file computed from independent byte ranges.

The checksum of a concatenation is the XOR of each piece's checksum advanced over
the bytes that follow it, so pieces can be read by different tasks and combined
with ``bit_xor``. Arithmetic is on polynomials over GF(2) in reflected bit order.
"""

from __future__ import annotations

POLYNOMIAL = 0xEDB88320  # reflected CRC-32 polynomial (fixed value)
ONE = 0x80000000         # the polynomial 1 in reflected order


def _times(a: int, b: int) -> int:
    product = 0
    while a:
        if a & ONE:
            product ^= b
        a = (a << 1) & 0xFFFFFFFF
        b = (b >> 1) ^ POLYNOMIAL if b & 1 else b >> 1
    return product


def advance(crc: int, following_bytes: int) -> int:
    """The checksum's share in a file where this many bytes follow the piece."""
    factor, step = ONE, 0x00800000  # 1 and x^8, one byte
    n = following_bytes
    while n:
        if n & 1:
            factor = _times(factor, step)
        step = _times(step, step)
        n >>= 1
    return _times(crc, factor)
