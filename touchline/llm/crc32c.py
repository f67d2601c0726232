"""CRC-32C of many buffers at a time, and the masked form used in record files."""

from __future__ import annotations

import numpy as np

# The reversed Castagnoli polynomial and the constant added to a rotated checksum.
POLYNOMIAL = 0x82F63B78
MASK_DELTA = 0xA282EAD8

PIECE = 256


def _tables() -> np.ndarray:
    """tables[k][b]: the checksum state of byte b followed by k zero bytes."""
    first = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        first = np.where(first & 1, (first >> 1) ^ np.uint32(POLYNOMIAL), first >> 1).astype(np.uint32)
    tables = [first]
    for _ in range(7):
        tables.append(first[tables[-1] & 0xFF] ^ (tables[-1] >> 8))
    return np.stack(tables)


TABLES = _tables()


def _after_zeros(states: np.ndarray, count: int) -> np.ndarray:
    for _ in range(count):
        states = TABLES[0][states & 0xFF] ^ (states >> 8)
    return states


# The state of every byte value at each of the four places of a state, after a piece of zeros.
SHIFTED = np.stack([_after_zeros(np.arange(256, dtype=np.uint32) << np.uint32(8 * i), PIECE) for i in range(4)])


def crc32c(buffers: list[bytes]) -> np.ndarray:
    """The CRC-32C of every buffer; buffers shorter than four bytes are not supported.

    Zeros in front do not change a state that starts at zero, so buffers are
    padded there to whole pieces; all pieces advance together and the states of a
    buffer's pieces are then joined from left to right.
    """
    if not buffers:
        return np.zeros(0, np.uint32)
    counts = np.array([-(-len(b) // PIECE) for b in buffers], np.int64)
    ends = np.cumsum(counts)
    data = np.zeros(int(ends[-1]) * PIECE, np.uint8)
    for buffer, end in zip(buffers, ends * PIECE):
        start = int(end) - len(buffer)
        data[start:end] = np.frombuffer(buffer, np.uint8)
        data[start : start + 4] ^= 0xFF  # the same as starting from all ones
    words = data.view("<u4").reshape(-1, PIECE // 8, 2)
    state = np.zeros(len(words), np.uint32)
    for i in range(PIECE // 8):
        low, high = state ^ words[:, i, 0], words[:, i, 1]
        state = (
            TABLES[7][low & 0xFF]
            ^ TABLES[6][(low >> 8) & 0xFF]
            ^ TABLES[5][(low >> 16) & 0xFF]
            ^ TABLES[4][low >> 24]
            ^ TABLES[3][high & 0xFF]
            ^ TABLES[2][(high >> 8) & 0xFF]
            ^ TABLES[1][(high >> 16) & 0xFF]
            ^ TABLES[0][high >> 24]
        )
    firsts = ends - counts
    joined = state[firsts]
    order = np.argsort(-counts, kind="stable")
    for i in range(1, int(counts.max())):
        order = order[: np.searchsorted(-counts[order], -i)]
        s = joined[order]
        shifted = SHIFTED[0][s & 0xFF] ^ SHIFTED[1][(s >> 8) & 0xFF] ^ SHIFTED[2][(s >> 16) & 0xFF] ^ SHIFTED[3][s >> 24]
        joined[order] = shifted ^ state[firsts[order] + i]
    return joined ^ np.uint32(0xFFFFFFFF)


def masked_crc32c(buffers: list[bytes]) -> np.ndarray:
    """Checksums rotated and shifted, so that a checksum of data holding checksums stays useful."""
    crc = crc32c(buffers)
    return ((crc >> np.uint32(15)) | (crc << np.uint32(17))) + np.uint32(MASK_DELTA)
