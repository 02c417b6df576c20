"""Range asymmetric numeral coding of id streams in blocks, in numpy.

All blocks share one table of frequencies (they add up to 2**SCALE).  A block holds up to ``LANES * STEPS``
symbols; symbol i is coded in lane i % LANES.  Every ``CHECK`` steps the lanes' states and the place in the
stream are kept, so each such segment can be decoded by itself.  Lanes, segments and blocks go through numpy together.
"""

from __future__ import annotations

import struct
import zlib
from dataclasses import dataclass

import numpy as np

SCALE = 20
LANES = 32
STEPS = 2048
CHECK = 512
BLOCK = LANES * STEPS
_LOW = np.uint64(1 << 31)
_WORD = np.uint64(32)
_MASK32 = np.uint64(0xFFFFFFFF)


def quantise(counts: np.ndarray) -> np.ndarray:
    """Frequencies that add up to 2**SCALE, at least 1 for each symbol that occurs; zeros where none does."""
    total, seen = int(counts.sum()), np.flatnonzero(counts)
    out = np.zeros(len(counts), np.int64)
    if not total:
        return out
    share = counts[seen].astype(np.float64) * ((1 << SCALE) - len(seen)) / total
    out[seen] = 1 + np.floor(share).astype(np.int64)
    rest = (1 << SCALE) - int(out.sum())
    largest = seen[np.argsort(-(share - np.floor(share)), kind="stable")[:rest]]
    out[largest] += 1
    return out


@dataclass
class Table:
    frequency: np.ndarray

    def __post_init__(self):
        self.f = self.frequency.astype(np.uint64)
        self.c = np.cumsum(self.frequency).astype(np.uint64) - self.f
        self.limit = (_LOW >> np.uint64(SCALE) << _WORD) * self.f
        self.slot = np.repeat(np.arange(len(self.frequency), dtype=np.uint32), self.frequency)


def encode(blocks: list[np.ndarray], table: Table) -> list[bytes]:
    """Each block of 1 to BLOCK symbols as bytes that end in a checksum."""
    if not blocks:
        return []
    steps = [-(-len(b) // LANES) for b in blocks]
    if len(set(steps)) > 1:  # the last block of a shard is shorter
        by = {s: [i for i, t in enumerate(steps) if t == s] for s in set(steps)}
        out: list[bytes] = [b""] * len(blocks)
        for rows in by.values():
            for i, made in zip(rows, encode([blocks[i] for i in rows], table)):
                out[i] = made
        return out
    n, wide = steps[0], len(blocks)
    fill = int(np.argmax(table.frequency))
    grid = np.full((wide, n * LANES), fill, np.uint32)
    for row, b in zip(grid, blocks):
        row[: len(b)] = b
    grid = np.ascontiguousarray(grid.reshape(wide, n, LANES).transpose(1, 0, 2))
    state = np.full((wide, LANES), _LOW, np.uint64)
    words = np.empty((n, wide, LANES), np.uint32)
    wrote = np.empty((n, wide, LANES), bool)
    marks: dict[int, np.ndarray] = {}
    for t in range(n - 1, -1, -1):
        s = grid[t]
        f = table.f[s]
        full = state >= table.limit[s]
        words[t], wrote[t] = (state & _MASK32).astype(np.uint32), full
        state = np.where(full, state >> _WORD, state)
        quotient = state // f
        state = (quotient << np.uint64(SCALE)) + (state - quotient * f) + table.c[s]
        if t % CHECK == 0:
            marks[t] = state
    out = []
    for g, b in enumerate(blocks):
        flags, stream = wrote[:, g], words[:, g]
        each = np.concatenate(([0], np.cumsum(flags.sum(axis=1))))
        order = sorted(marks)
        head = struct.pack("<III", len(b), len(order), int(each[-1]))
        places = np.array([each[t] for t in order], "<u4").tobytes()
        body = head + places + b"".join(marks[t][g].astype("<u8").tobytes() for t in order) + stream[flags].astype("<u4").tobytes()
        out.append(body + struct.pack("<I", zlib.crc32(body)))
    return out


def decode(payloads: list[bytes], table: Table) -> list[np.ndarray]:
    """The blocks' symbols; every checksum is verified first."""
    states, places, spans, bounds, streams, base = [], [], [], [], [], 0
    for p in payloads:
        if len(p) < 16 or zlib.crc32(p[:-4]) != struct.unpack("<I", p[-4:])[0]:
            raise ValueError("a block fails its checksum")
        count, marks, n_words = struct.unpack_from("<III", p)
        at = 12
        place = np.frombuffer(p, "<u4", marks, at).astype(np.int64)
        at += 4 * marks
        states.append(np.frombuffer(p, "<u8", marks * LANES, at).reshape(marks, LANES))
        at += 8 * marks * LANES
        streams.append(np.frombuffer(p, "<u4", n_words, at))
        n = -(-count // LANES)
        spans += [min(CHECK, n - k * CHECK) for k in range(marks)]
        places.append(place + base)
        base += n_words
        bounds.append((count, marks))
    if not payloads:
        return []
    state, place, span = np.concatenate(states).astype(np.uint64), np.concatenate(places), np.array(spans)
    stream = np.concatenate([*streams, np.zeros(1, "<u4")]).astype(np.uint64)
    out = np.zeros((len(span), CHECK, LANES), np.uint32)
    order = np.argsort(-span, kind="stable")  # the longest first, so those still running are a prefix
    state, place, span = state[order], place[order], span[order]
    low_bits = np.uint64((1 << SCALE) - 1)
    for t in range(int(span[0]) if len(span) else 0):
        k = int(np.searchsorted(-span, -t, "left"))
        x = state[:k]
        slot = x & low_bits
        s = table.slot[slot]
        out[order[:k], t] = s
        x = table.f[s] * (x >> np.uint64(SCALE)) + slot - table.c[s]
        need = x < _LOW
        taken = np.cumsum(need, axis=1)
        word = stream[np.where(need, place[:k, None] + taken - 1, len(stream) - 1)]
        state[:k] = np.where(need, (x << _WORD) | word, x)
        place[:k] += taken[:, -1]
    found, at = [], 0
    for count, marks in bounds:
        found.append(out[at : at + marks].reshape(-1)[:count])
        at += marks
    return found


def crc32_join(parts: list[tuple[int, int]]) -> int:
    """The CRC-32 of a concatenation from (crc, length in bytes) of its parts."""
    total = 0
    for crc, size in parts:
        total = _times(_power(8 * size), total) ^ crc if size else total
    return total


def _times(a: int, b: int) -> int:
    """Product of two polynomials, bits reversed, modulo CRC-32's."""
    out = 0
    while b:
        if b & 0x80000000:
            out ^= a
        a = (a >> 1) ^ (0xEDB88320 if a & 1 else 0)
        b = (b << 1) & 0xFFFFFFFF
    return out


def _power(n: int) -> int:
    """x**n modulo CRC-32's polynomial."""
    out, base = 0x80000000, 0x40000000
    while n:
        if n & 1:
            out = _times(out, base)
        base = _times(base, base)
        n >>= 1
    return out
