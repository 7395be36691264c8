"""Patched frame-of-reference blocks of unsigned integers.

A run of values is cut into blocks of ``BLOCK``.  A block stores its minimum,
and the differences to it in as many bits as a percentile of them needs; the few
that need more keep their low bits in place and list their place and high bits
at the block's end.  The start of every block is indexed, so any block can be
read alone.

Block layout, little-endian: minimum u32, width u8, exceptions u8, values u16,
``ceil(BLOCK * width / 8)`` bytes of packed low bits, then per exception its
place u8, and per exception its high bits u32.
"""

from __future__ import annotations

import numpy as np

BLOCK = 128
#: Share of a block's values that the packed width must hold.
PERCENTILE = 0.9
_HEAD = 8
_LANES = BLOCK // 32


def _bit_length(values: np.ndarray) -> np.ndarray:
    """Bits that each value needs; exact, as values are below 2**32."""
    return np.frexp(values.astype(np.float64))[1].astype(np.int64)


def encode(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all blocks and the start of each (u32 values in, u8 and u32 arrays out)."""
    n = len(values)
    blocks = -(-n // BLOCK)
    if not blocks:
        return np.zeros(0, np.uint8), np.zeros(0, np.uint32)
    padded = np.full(blocks * BLOCK, 0, np.uint32)
    padded[:n] = values
    counts = np.full(blocks, BLOCK, np.int64)
    counts[-1] = n - (blocks - 1) * BLOCK
    if n % BLOCK:
        padded[n:] = values[(blocks - 1) * BLOCK :].min()
    rows = padded.reshape(blocks, BLOCK)
    low = rows.min(axis=1)
    rows = rows - low[:, None]
    at = min(int(np.ceil(PERCENTILE * BLOCK)), BLOCK) - 1
    width = _bit_length(np.partition(rows, at, axis=1)[:, at])
    big = (rows.astype(np.uint64) >> width[:, None].astype(np.uint64)).astype(np.uint32)
    patched = big > 0
    exceptions = patched.sum(axis=1)
    packed = BLOCK // 8 * width
    sizes = _HEAD + packed + 5 * exceptions
    starts = np.cumsum(sizes) - sizes
    out = np.zeros(int(sizes.sum()), np.uint8)
    head = np.zeros((blocks, _HEAD), np.uint8)
    head[:, :4] = low.astype("<u4").view(np.uint8).reshape(blocks, 4)
    head[:, 4] = width
    head[:, 5] = exceptions
    head[:, 6:] = counts.astype("<u2").view(np.uint8).reshape(blocks, 2)
    out[starts[:, None] + np.arange(_HEAD)] = head
    for w in np.unique(width[width > 0]):
        mine = np.flatnonzero(width == w)
        bits = _pack(rows[mine], int(w))
        out[(starts[mine] + _HEAD)[:, None] + np.arange(bits.shape[1])] = bits
    block, place = np.nonzero(patched)
    if len(block):
        nth = np.arange(len(block)) - np.repeat(np.cumsum(exceptions) - exceptions, exceptions)
        tail = starts[block] + _HEAD + packed[block]
        out[tail + nth] = place
        high = big[block, place].astype("<u4").view(np.uint8).reshape(-1, 4)
        out[(tail + exceptions[block] + 4 * nth)[:, None] + np.arange(4)] = high
    return out, starts.astype(np.uint32)


def _pack(rows: np.ndarray, width: int) -> np.ndarray:
    """Low ``width`` bits of each row's values, as ``width`` 32-bit words for every 32 values."""
    lanes = np.ascontiguousarray(rows.reshape(-1, 32).T) & np.uint32((1 << width) - 1)
    words = np.zeros((width, lanes.shape[1]), np.uint32)
    for i in range(32):
        word, shift = divmod(i * width, 32)
        words[word] |= lanes[i] << np.uint32(shift)
        if shift + width > 32:
            words[word + 1] |= lanes[i] >> np.uint32(32 - shift)
    return np.ascontiguousarray(words.T).astype("<u4").view(np.uint8).reshape(len(rows), -1)


def _unpack(packed: np.ndarray, width: int) -> np.ndarray:
    count = len(packed)
    words = np.ascontiguousarray(packed).view("<u4").reshape(count * _LANES, width).T
    words = np.ascontiguousarray(words)
    mask = np.uint32((1 << width) - 1)
    lanes = np.empty((32, words.shape[1]), np.uint32)
    for i in range(32):
        word, shift = divmod(i * width, 32)
        lanes[i] = words[word] >> np.uint32(shift)
        if shift + width > 32:
            lanes[i] |= words[word + 1] << np.uint32(32 - shift)
    lanes &= mask
    return np.ascontiguousarray(lanes.T).reshape(count, BLOCK)


def decode(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The values of the blocks that begin at ``starts`` in ``data``, one after another."""
    blocks = len(starts)
    if not blocks:
        return np.zeros(0, np.uint32)
    starts = starts.astype(np.int64)
    head = data[starts[:, None] + np.arange(_HEAD)]
    low = np.ascontiguousarray(head[:, :4]).view("<u4").ravel()
    width = head[:, 4].astype(np.int64)
    exceptions = head[:, 5].astype(np.int64)
    counts = np.ascontiguousarray(head[:, 6:]).view("<u2").ravel().astype(np.int64)
    rows = np.zeros((blocks, BLOCK), np.uint32)
    for w in np.unique(width[width > 0]):
        mine = np.flatnonzero(width == w)
        span = BLOCK // 8 * int(w)
        rows[mine] = _unpack(data[(starts[mine] + _HEAD)[:, None] + np.arange(span)], int(w))
    total = int(exceptions.sum())
    if total:
        block = np.repeat(np.arange(blocks), exceptions)
        nth = np.arange(total) - np.repeat(np.cumsum(exceptions) - exceptions, exceptions)
        tail = starts[block] + _HEAD + BLOCK // 8 * width[block]
        place = data[tail + nth]
        high = data[(tail + exceptions[block] + 4 * nth)[:, None] + np.arange(4)]
        high = np.ascontiguousarray(high).view("<u4").ravel().astype(np.uint64)
        rows[block, place] |= (high << width[block].astype(np.uint64)).astype(np.uint32)
    rows += low[:, None]
    if np.all(counts == BLOCK):
        return rows.ravel()
    return rows[np.arange(BLOCK) < counts[:, None]]


def read_range(data: np.ndarray, starts: np.ndarray, first: int, last: int) -> np.ndarray:
    """Values ``first`` to ``last`` (not included), decoding only the blocks that hold them."""
    a, b = first // BLOCK, -(-last // BLOCK)
    return decode(data, starts[a:b])[first - a * BLOCK : last - a * BLOCK]
