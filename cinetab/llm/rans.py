"""Static range asymmetric numeral system with interleaved lanes, checkpoints and checksums.

A table of symbol frequencies, summing to 2**BITS, is shared by all blocks. Symbol i of a block is
coded by lane i % lanes, so numpy codes one symbol of every lane at a time. The block keeps the state of
all lanes at regular steps: decoding can start at each of these checkpoints on its own.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

BITS = 20
_LOW = np.uint64(1 << 31)
_HEAD = struct.Struct("<4sIIIIII")
MAGIC = b"RNS1"


class Table:
    """Frequencies scaled to 2**BITS; every symbol that occurs keeps 1 at least."""

    def __init__(self, counts: np.ndarray):
        size = 1 << BITS
        total = int(counts.sum())
        self.freq = np.where(counts > 0, np.maximum(1, np.floor(counts / max(total, 1) * size)), 0).astype(np.int64)
        if total:
            excess = int(self.freq.sum()) - size
            for i in np.argsort(-self.freq, kind="stable"):
                if excess <= 0:
                    break
                less = min(excess, int(self.freq[i]) - 1)
                self.freq[i] -= less
                excess -= less
            self.freq[int(np.argmax(self.freq))] -= excess  # what is left over goes to the most frequent
        self.start = np.concatenate([[0], np.cumsum(self.freq)[:-1]]).astype(np.uint64)
        self.symbol = np.repeat(np.arange(len(counts), dtype=np.uint32), self.freq)
        self.freq = self.freq.astype(np.uint64)


def encode(symbols: np.ndarray, table: Table, lanes: int = 512, every: int = 128) -> bytes:
    """One block; ``every`` steps of all lanes there is a checkpoint."""
    n = len(symbols)
    lanes = int(max(1, min(lanes, n // 64)))
    x = np.full(lanes, _LOW, np.uint64)
    steps = -(-n // lanes)
    out: list[np.ndarray] = []
    points: list[tuple[int, bytes]] = []
    written, shift = 0, np.uint64(BITS)
    freq, start = table.freq[symbols], table.start[symbols]
    for step in range(steps - 1, -1, -1):
        f, c = freq[step * lanes : (step + 1) * lanes], start[step * lanes : (step + 1) * lanes]
        s = x[: len(f)]
        full = s >= (f << np.uint64(63 - BITS))
        word = s[full]
        if len(word):
            out.append(word.astype(np.uint32))
            written += len(word)
            s[full] = word >> np.uint64(32)
        whole = s // f
        s[:] = (whole << shift) + (s - whole * f) + c
        if step and step % every == 0:
            points.append((written, x.tobytes()))
    stream = np.concatenate(out[::-1]) if out else np.zeros(0, np.uint32)
    body = x.tobytes() + b"".join(struct.pack("<I", len(stream) - at) + state for at, state in reversed(points)) + stream.tobytes()
    return _HEAD.pack(MAGIC, n, lanes, every, len(points), len(stream), zlib.crc32(body)) + body


def decode(block: bytes, table: Table, part: int | None = None) -> np.ndarray:
    """The symbols of a block, or of its part between checkpoints ``part`` and ``part`` + 1 alone."""
    magic, n, lanes, every, points, words, crc = _HEAD.unpack_from(block)
    body = memoryview(block)[_HEAD.size :]
    if magic != MAGIC or zlib.crc32(body) != crc:
        raise ValueError("a damaged block")
    state, item = 8 * lanes, 4 + 8 * lanes
    stream = np.frombuffer(body, np.uint32, words, state + points * item).astype(np.uint64)
    steps, first, at = -(-n // lanes), 0, 0
    x = np.frombuffer(body, np.uint64, lanes).copy()
    if part is not None:
        if part:
            offset = state + (part - 1) * item
            at = struct.unpack_from("<I", body, offset)[0]
            x = np.frombuffer(body, np.uint64, lanes, offset + 4).copy()
        first, steps = part * every, min(steps, (part + 1) * every)
    out = np.empty(max(0, min(n, steps * lanes) - first * lanes), np.uint32)
    mask, shift = np.uint64((1 << BITS) - 1), np.uint64(BITS)
    for step in range(first, steps):
        here = out[(step - first) * lanes : (step - first + 1) * lanes]
        s = x[: len(here)]
        slot = s & mask
        symbol = table.symbol[slot]
        here[:] = symbol
        s[:] = table.freq[symbol] * (s >> shift) + slot - table.start[symbol]
        low = np.flatnonzero(s < _LOW)
        if len(low):
            s[low] = (s[low] << np.uint64(32)) | stream[at : at + len(low)]
            at += len(low)
    return out


def parts(block: bytes) -> int:
    """Into how many parts a block's checkpoints cut it."""
    return _HEAD.unpack_from(block)[4] + 1


def part_size(block: bytes) -> int:
    """How many symbols a part has; the last one may have fewer."""
    _, _, lanes, every, *_ = _HEAD.unpack_from(block)
    return lanes * every
