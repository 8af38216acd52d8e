"""Length-delimited binary records with masked CRC-32C checksums (inside Arrow tasks).

A record is: 8 bytes length, 4 bytes masked checksum of the length, the data, 4 bytes
masked checksum of the data, all little-endian: a file is such records one after another.
The checksums of many records are computed together, block by block in lockstep.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np

# fixed values of CRC-32C and of its mask in record files
POLYNOMIAL = 0x82F63B78
MASK_DELTA = 0xA282EAD8

HEAD, TAIL = 12, 4
BLOCK = 64


class Corrupt(ValueError):
    """A record whose length or checksum is not what its file says."""


@lru_cache
def _two_bytes() -> np.ndarray:
    """State after two bytes, by their value, from state 0."""
    t = np.arange(1 << 16, dtype=np.uint32)
    for _ in range(16):
        t = (t >> 1) ^ np.where(t & 1, np.uint32(POLYNOMIAL), np.uint32(0))
    return t


def _tables(columns: np.ndarray) -> np.ndarray:
    """Lookup by byte of a linear map of 32 bits, given its value for every single bit."""
    t = np.zeros((4, 256), np.uint32)
    for k in range(4):
        for bit in range(8):
            t[k, 1 << bit:2 << bit] = t[k, :1 << bit] ^ columns[8 * k + bit]
    return t


def _apply(t: np.ndarray, v: np.ndarray) -> np.ndarray:
    return t[0][v & 255] ^ t[1][(v >> 8) & 255] ^ t[2][(v >> 16) & 255] ^ t[3][v >> 24]


@lru_cache
def _zero_blocks(power: int) -> np.ndarray:
    """Tables of the map that ``2 ** power`` blocks of zero bytes apply to a state."""
    bits = np.uint32(1) << np.arange(32, dtype=np.uint32)
    if power:
        half = _zero_blocks(power - 1)
        return _tables(_apply(half, _apply(half, bits)))
    for _ in range(BLOCK // 2):
        bits = _two_bytes()[bits & 0xFFFF] ^ (bits >> 16)
    return _tables(bits)


def crc32c(data: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """CRC-32C of consecutive messages of ``sizes`` bytes (4 at least) in ``data`` (uint8)."""
    if not len(sizes):
        return np.zeros(0, np.uint32)
    assert sizes.min() >= 4
    blocks = -(-sizes // BLOCK)
    ends, stops = np.cumsum(blocks) * BLOCK, np.cumsum(sizes)
    # zero bytes before a message don't change a state of 0, so messages end with a block;
    # the initial state of ones is the same as inverting the first four bytes
    padded = np.zeros(int(ends[-1]), np.uint8)
    padded[np.arange(len(data)) + np.repeat(ends - stops, sizes)] = data
    first = ends - sizes
    for i in range(4):
        padded[first + i] ^= 255
    steps = np.ascontiguousarray(padded.view("<u2").reshape(-1, BLOCK // 2).T)
    two, state = _two_bytes(), np.zeros(len(padded) // BLOCK, np.uint32)
    for column in steps:
        state = two[(state ^ column) & 0xFFFF] ^ (state >> 16)
    after = np.repeat(np.cumsum(blocks), blocks) - 1 - np.arange(len(state))
    power = 0
    while (after >> power).any():
        at = np.flatnonzero((after >> power) & 1)
        state[at] = _apply(_zero_blocks(power), state[at])
        power += 1
    return ~np.bitwise_xor.reduceat(state, np.cumsum(blocks) - blocks)


def masked(crc: np.ndarray) -> np.ndarray:
    return ((crc >> 15) | (crc << 17)) + np.uint32(MASK_DELTA)


def frame(messages: list[bytes]) -> list[bytes]:
    """Each message as a record."""
    sizes = np.array([len(m) for m in messages], np.int64)
    lengths = sizes.astype("<u8")
    heads = masked(crc32c(lengths.view(np.uint8), np.full(len(sizes), 8))).astype("<u4")
    tails = masked(crc32c(np.frombuffer(b"".join(messages), np.uint8), sizes)).astype("<u4")
    return [b"".join((n.tobytes(), h.tobytes(), m, t.tobytes())) for n, h, m, t in zip(lengths, heads, messages, tails)]


def unframe(raw: list[bytes]) -> list[bytes]:
    """The messages of whole records; raises ``Corrupt`` for one that was changed or cut."""
    if not raw:
        return []
    if min(map(len, raw)) < HEAD + TAIL + 4:
        raise Corrupt("a record is cut short")
    lengths = np.frombuffer(b"".join(r[:8] for r in raw), "<u8")
    heads = np.frombuffer(b"".join(r[8:HEAD] for r in raw), "<u4")
    messages = [r[HEAD:-TAIL] for r in raw]
    sizes = np.array([len(m) for m in messages], np.int64)
    tails = np.frombuffer(b"".join(r[-TAIL:] for r in raw), "<u4")
    good = (lengths == sizes) & (heads == masked(crc32c(lengths.view(np.uint8), np.full(len(sizes), 8))))
    good &= tails == masked(crc32c(np.frombuffer(b"".join(messages), np.uint8), sizes))
    if not good.all():
        raise Corrupt(f"record {int(np.flatnonzero(~good)[0])} of {len(raw)} does not match its length or checksum")
    return messages
