"""CRC-32C of many byte strings at once, over numpy arrays.

Every string is cut into blocks of ``BLOCK`` bytes (zeros in front of the
first, which a zero register ignores); all blocks go through two 16-bit
tables side by side, and a string's blocks are joined by the register's
linear shift over one block.
"""

from __future__ import annotations

import zlib
from functools import lru_cache

import numpy as np

#: Reversed polynomial of CRC-32C and the constant of masked checksums (fixed values).
POLYNOMIAL = 0x82F63B78
MASK_DELTA = 0xA282EAD8
BLOCK = 512


def _byte_table() -> np.ndarray:
    reg = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        reg = np.where(reg & 1, (reg >> 1) ^ np.uint32(POLYNOMIAL), reg >> 1).astype(np.uint32)
    return reg


@lru_cache(maxsize=1)
def _tables():
    """Four zero bytes over the low and the high half of a register, and the
    same over a whole block."""
    byte = _byte_table()

    def step(reg):
        for _ in range(4):
            reg = byte[reg & 0xFF] ^ (reg >> np.uint32(8))
        return reg

    half = np.arange(1 << 16, dtype=np.uint32)
    low, high = step(half), step(half << np.uint32(16))
    far_low, far_high = half, half << np.uint32(16)
    for _ in range(BLOCK // 4):
        far_low = low[far_low & 0xFFFF] ^ high[far_low >> np.uint32(16)]
        far_high = low[far_high & 0xFFFF] ^ high[far_high >> np.uint32(16)]
    return low, high, far_low, far_high


def crc32c(strings: list[bytes]) -> np.ndarray:
    """CRC-32C of each string, as unsigned 32-bit integers."""
    if not strings:
        return np.zeros(0, np.uint32)
    low, high, far_low, far_high = _tables()
    # four bytes of ones in front stand for the start value, in every length
    lens = np.array([len(s) for s in strings]) + 4
    blocks = -(-lens // BLOCK)
    last = np.cumsum(blocks)
    flat = np.zeros((int(last[-1]), BLOCK), np.uint8)
    row = flat.reshape(-1)
    for s, n, end in zip(strings, lens.tolist(), (last * BLOCK).tolist()):
        row[end - n + 4:end] = np.frombuffer(s, np.uint8)
        # the register before the first byte is all ones
        head = min(4, n - 4)
        row[end - n + 4:end - n + 4 + head] ^= 0xFF
    words = np.ascontiguousarray(flat.view("<u4").T)
    reg = np.zeros(len(flat), np.uint32)
    for word in words:
        reg ^= word
        reg = low[reg & 0xFFFF] ^ high[reg >> np.uint32(16)]
    first = last - blocks
    out = reg[first]
    for k in range(1, int(blocks.max())):
        on = np.flatnonzero(blocks > k)
        out[on] = (far_low[out[on] & 0xFFFF] ^ far_high[out[on] >> np.uint32(16)]
                   ^ reg[first[on] + k])
    out = ~out
    for i in np.flatnonzero(lens < 8):
        out[i] = _short(strings[i])
    return out


def _short(s: bytes) -> int:
    reg, byte = 0xFFFFFFFF, _byte_table()
    for b in s:
        reg = int(byte[(reg ^ b) & 0xFF]) ^ (reg >> 8)
    return reg ^ 0xFFFFFFFF


def masked(crc: np.ndarray) -> np.ndarray:
    """The checksum rotated right by 15 bits plus a constant, so that a
    checksum of data that holds checksums stays sound."""
    crc = crc.astype(np.uint32)
    return ((crc >> np.uint32(15)) | (crc << np.uint32(17))) + np.uint32(MASK_DELTA)


def ids_crc32(ids: np.ndarray) -> int:
    """CRC-32 of ids as little-endian unsigned 32-bit integers."""
    return zlib.crc32(ids.astype("<u4").tobytes())
