"""CRC-32 of joined strings from the CRC-32 of their parts (numpy)."""

from __future__ import annotations

import numpy as np

#: Fixed value: the reflected CRC-32 polynomial.
POLYNOMIAL = 0xEDB88320


def _one_byte() -> np.ndarray:
    t = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        t = (t >> 1) ^ np.where(t & 1, np.uint32(POLYNOMIAL), np.uint32(0))
    return t


class Joiner:
    """``joined(a, b, n)``: CRC-32 of x + y from that of x, that of y and the bytes of y.

    Appending n zero bytes is a linear map of the register; the maps of 1, 2,
    4, 8... bytes are kept as four tables of 256 values, and a vector of lengths
    is applied one binary digit at a time.
    """

    def __init__(self):
        t = _one_byte()
        b = np.arange(256, dtype=np.uint32)
        self.maps = [[self._step(b << np.uint32(8 * k), t) for k in range(4)]]

    @staticmethod
    def _step(c: np.ndarray, t: np.ndarray) -> np.ndarray:
        return (c >> np.uint32(8)) ^ t[c & 255]

    @staticmethod
    def _apply(m: list[np.ndarray], c: np.ndarray) -> np.ndarray:
        return m[0][c & 255] ^ m[1][(c >> 8) & 255] ^ m[2][(c >> 16) & 255] ^ m[3][c >> 24]

    def joined(self, a: np.ndarray, b: np.ndarray, n: np.ndarray) -> np.ndarray:
        c, n = a.astype(np.uint32), np.broadcast_to(np.asarray(n, np.int64), a.shape)
        digit = 0
        while len(n) and int(n.max()) >> digit:
            while len(self.maps) <= digit:  # twice the bytes: the map on itself
                self.maps.append([self._apply(self.maps[-1], t) for t in self.maps[-1]])
            on = (n >> digit) & 1 == 1
            c[on] = self._apply(self.maps[digit], c[on])
            digit += 1
        return c ^ b.astype(np.uint32)
