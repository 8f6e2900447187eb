"""CRC-32C of many byte strings at once, by table lookups over numpy columns.

The checksum is linear over XOR, so a string is cut into blocks of equal size from its end, all
blocks are folded side by side two bytes at a time, and block results are moved to their place by
tables for "followed by 2**k blocks of zeros".
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np

_POLY = np.uint32(0x82F63B78)  # fixed value: the reflected Castagnoli polynomial
BLOCK = 256


@lru_cache(maxsize=1)
def _tables() -> tuple[np.ndarray, list[np.ndarray]]:
    """For one step of two bytes, and for shifts by 2**k blocks, as four tables by byte of the state."""
    t = np.arange(1 << 16, dtype=np.uint32)
    for _ in range(16):
        t = np.where(t & 1, (t >> 1) ^ _POLY, t >> 1)
    unit = np.uint32(1) << np.arange(32, dtype=np.uint32)
    for _ in range(BLOCK // 2):
        unit = (unit >> 16) ^ t[unit & 0xFFFF]
    shifts = []
    for _ in range(40):
        tables = np.zeros((4, 256), np.uint32)
        for byte in range(4):
            for bit in range(8):
                tables[byte] ^= np.where(np.arange(256) >> bit & 1, unit[8 * byte + bit], 0).astype(np.uint32)
        shifts.append(tables)
        unit = _shift(tables, unit)
    return t, shifts


def _shift(tables: np.ndarray, state: np.ndarray) -> np.ndarray:
    return tables[0][state & 255] ^ tables[1][state >> 8 & 255] ^ tables[2][state >> 16 & 255] ^ tables[3][state >> 24]


def crc32c(strings: list[bytes]) -> np.ndarray:
    """The checksum of each string, as unsigned 32-bit integers."""
    step, shifts = _tables()
    sizes = np.array([max(len(s), 4) for s in strings], dtype=np.int64)
    blocks = -(-sizes // BLOCK)
    out = np.zeros(len(strings), np.uint32)
    if not len(strings):
        return out
    ends = np.cumsum(blocks) * BLOCK
    flat = np.zeros(int(ends[-1]), np.uint8)
    for s, end in zip(strings, ends):  # leading zeros do not change the state
        if len(s) >= 4:
            flat[end - len(s) : end] = np.frombuffer(s, np.uint8)
            flat[end - len(s) : end - len(s) + 4] ^= 255
    state = np.zeros(len(flat) // BLOCK, np.uint32)
    for column in np.ascontiguousarray(flat.view("<u2").reshape(-1, BLOCK // 2).T):
        state = (state >> 16) ^ step[(state & 0xFFFF) ^ column]
    owner = np.repeat(np.arange(len(strings)), blocks)
    after = np.repeat(np.cumsum(blocks), blocks) - 1 - np.arange(len(state))
    for k in range(int(after.max()).bit_length()):
        on = (after >> k & 1).astype(bool)
        state[on] = _shift(shifts[k], state[on])
    np.bitwise_xor.at(out, owner, state)
    out ^= np.uint32(0xFFFFFFFF)
    for i, s in enumerate(strings):
        if len(s) < 4:
            value = 0xFFFFFFFF
            for byte in s:
                value ^= byte
                for _ in range(8):
                    value = value >> 1 ^ (int(_POLY) if value & 1 else 0)
            out[i] = value ^ 0xFFFFFFFF
    return out


def masked(crc: np.ndarray) -> np.ndarray:
    """Rotated right by 15 bits plus a constant (fixed value), so that a checksum of checksums stays sound."""
    crc = crc.astype(np.uint32)
    return ((crc >> np.uint32(15)) | (crc << np.uint32(17))) + np.uint32(0xA282EAD8)
