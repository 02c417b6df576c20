"""A worker's memory of what spans of bytes turn into: sorted arrays, a few bytes a span."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pandas as pd

#: Bytes that a memory holds, about; when full it keeps the spans that were asked for again.
MOST_BYTES = 48_000_000
#: Spans of the younger level, which is sorted anew whenever some are added.
_YOUNG = 60_000
_SEPARATOR = 0xFF  # in no text


def distinct(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each span's number among the distinct spans, and where each of these is first.

    Spans are told apart by hash; length and both ends are compared as well.
    """
    code, _ = pd.factorize(hashes)
    first = np.empty(code.max() + 1 if len(code) else 0, np.int64)
    first[code[::-1]] = np.arange(len(code))[::-1]
    width = ends - starts
    same = width == width[first][code]
    for edge in (starts, ends - 1):
        same &= data[edge] == data[edge[first]][code]
    if not same.all():
        raise ValueError("two spans have one hash")
    return code, first


def gather(flat: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The runs flat[start:start+size] in a row."""
    at = np.cumsum(size) - size
    return flat[np.repeat(start - at, size) + np.arange(int(size.sum()))]


def texts_of(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> list[str]:
    """The spans of UTF-8 bytes as texts, cut from one buffer."""
    if not len(starts):
        return []
    width = ends - starts
    filled = np.ones(int((width + 1).sum()), bool)
    filled[np.cumsum(width + 1) - 1] = False
    out = np.full(len(filled), _SEPARATOR, np.uint8)
    out[filled] = gather(data, starts, width)
    return [x.decode() for x in out[:-1].tobytes().split(bytes([_SEPARATOR]))]


@dataclass
class _Level:
    """Spans sorted by their first hash: a second hash, the run in the pool, and whether they were met again."""

    key: np.ndarray
    second: np.ndarray
    start: np.ndarray
    size: np.ndarray
    again: np.ndarray

    @classmethod
    def none(cls) -> "_Level":
        return cls(np.empty(0, np.uint64), np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, bool))

    def columns(self) -> tuple[np.ndarray, ...]:
        return self.key, self.second, self.start, self.size, self.again

    def nbytes(self) -> int:
        return sum(c.nbytes for c in self.columns())

    def merged(self, other: "_Level") -> "_Level":
        key = np.concatenate((self.key, other.key))
        order = np.argsort(key, kind="stable")
        return _Level(key[order], *(np.concatenate(x)[order] for x in zip(self.columns()[1:], other.columns()[1:])))

    def look_up(self, hashes: np.ndarray, second: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which spans are here, and where."""
        if not len(self.key):
            return np.zeros(len(hashes), bool), np.empty(0, np.int64)
        at = np.searchsorted(self.key, hashes)
        at[at == len(self.key)] = 0
        hit = (self.key[at] == hashes) & (self.second[at] == second)
        at = at[hit]
        self.again[at] = True
        return hit, at


class SpanMemory:
    """What ``make`` turns distinct spans into - a flat array of ``kind`` and the run lengths - found again by two 64-bit hashes."""

    def __init__(self, make: Callable[[list[str]], tuple[np.ndarray, np.ndarray]], kind: type, most: int = MOST_BYTES):
        self.make, self.kind, self.most = make, kind, most
        self.clear()

    def clear(self) -> None:
        self.old, self.young = _Level.none(), _Level.none()
        self.pool = np.empty(0, self.kind)

    def held(self) -> int:
        return self.old.nbytes() + self.young.nbytes() + self.pool.nbytes

    def find(self, hashes: np.ndarray, second: np.ndarray, texts: Callable[[np.ndarray], list[str]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(pool, start, size) of distinct spans; ``texts(rows)`` gives those that are not known."""
        if self.held() > self.most:
            self._forget()
        start, size = np.empty(len(hashes), np.int64), np.empty(len(hashes), np.int64)
        unknown = np.arange(len(hashes))
        for level in (self.old, self.young):
            hit, at = level.look_up(hashes[unknown], second[unknown])
            start[unknown[hit]], size[unknown[hit]] = level.start[at], level.size[at]
            unknown = unknown[~hit]
        if len(unknown):
            flat, runs = self.make(texts(unknown))
            size[unknown] = runs
            start[unknown] = len(self.pool) + np.cumsum(runs) - runs
            self.pool = np.concatenate((self.pool, flat))
            order = unknown[np.argsort(hashes[unknown], kind="stable")]
            self.young = self.young.merged(_Level(hashes[order], second[order], start[order], size[order], np.zeros(len(order), bool)))
            if len(self.young.key) > _YOUNG:
                self.old, self.young = self.old.merged(self.young), _Level.none()
        return self.pool, start, size

    def _forget(self) -> None:
        """Keep the spans that were met again since the last time, or none if these are too many."""
        level, pool = self.old.merged(self.young), self.pool
        keep = np.flatnonzero(level.again)
        self.clear()
        size = level.size[keep]
        pool = gather(pool, level.start[keep], size)
        kept = _Level(level.key[keep], level.second[keep], np.cumsum(size) - size, size, np.zeros(len(keep), bool))
        if kept.nbytes() + pool.nbytes <= self.most // 2:
            self.old, self.pool = kept, pool
