"""XXH64 of many spans of one buffer at once, by the public description of the algorithm."""

from __future__ import annotations

import numpy as np
import xxhash

# The five primes of XXH64.
P1 = np.uint64(0x9E3779B185EBCA87)
P2 = np.uint64(0xC2B2AE3D27D4EB4F)
P3 = np.uint64(0x165667B19E3779F9)
P4 = np.uint64(0x85EBCA77C2B2AE63)
P5 = np.uint64(0x27D4EB2F165667C5)


def _turn(x: np.ndarray, n: int) -> np.ndarray:
    return (x << np.uint64(n)) | (x >> np.uint64(64 - n))


def _same_length(buffer: np.ndarray, at: np.ndarray, length: int, seed: int) -> np.ndarray:
    words = np.ndarray((len(buffer) - 7,), "<u8", buffer, strides=(1,))
    halves = np.ndarray((len(buffer) - 3,), "<u4", buffer, strides=(1,))
    pos, rest = 0, length
    with np.errstate(over="ignore"):
        start = np.uint64(seed)
        if length >= 32:
            lanes = [np.full(len(at), v, np.uint64) for v in (start + P1 + P2, start + P2, start, start - P1)]
            while rest >= 32:
                lanes = [_turn(v + words[at + (pos + 8 * i)] * P2, 31) * P1 for i, v in enumerate(lanes)]
                pos, rest = pos + 32, rest - 32
            h = _turn(lanes[0], 1) + _turn(lanes[1], 7) + _turn(lanes[2], 12) + _turn(lanes[3], 18)
            for v in lanes:
                h = (h ^ (_turn(v * P2, 31) * P1)) * P1 + P4
        else:
            h = np.full(len(at), start + P5, np.uint64)
        h = h + np.uint64(length)
        while rest >= 8:
            h = _turn(h ^ (_turn(words[at + pos] * P2, 31) * P1), 27) * P1 + P4
            pos, rest = pos + 8, rest - 8
        if rest >= 4:
            h = _turn(h ^ (halves[at + pos].astype(np.uint64) * P1), 23) * P2 + P3
            pos, rest = pos + 4, rest - 4
        while rest:
            h = _turn(h ^ (buffer[at + pos].astype(np.uint64) * P5), 11) * P1
            pos, rest = pos + 1, rest - 1
        h = (h ^ (h >> np.uint64(33))) * P2
        h = (h ^ (h >> np.uint64(29))) * P3
        return h ^ (h >> np.uint64(32))


def xxh64_spans(buffer: np.ndarray, at: np.ndarray, length: np.ndarray, seed: int = 42) -> np.ndarray:
    """The hash of each buffer[at:at+length]; the buffer ends in 8 spare bytes."""
    out = np.empty(len(at), np.uint64)
    order = np.argsort(length, kind="stable")
    cuts = np.flatnonzero(np.diff(length[order])) + 1
    for part in np.split(order, cuts) if len(order) else []:
        n = int(length[part[0]])
        if n > 256 and len(part) < 64:
            out[part] = [xxhash.xxh64_intdigest(buffer[i : i + n].tobytes(), seed) for i in at[part]]
        else:
            out[part] = _same_length(buffer, at[part], n, seed)
    return out
