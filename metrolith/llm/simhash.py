"""SimHash fingerprints of word shingles, in numpy."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from metrolith.llm import common
from metrolith.llm.xxh64 import xxh64_spans

_LANES = np.uint64(0x0101010101010101)


def _joined(w: common.Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All words in one buffer with one space after each; their places and widths there."""
    width = w.ends - w.starts
    at = np.cumsum(width + 1) - (width + 1)
    total = int((width + 1).sum())
    out = np.full(total + 8, 0x20, np.uint8)
    filled = np.ones(total, bool)
    filled[at + width] = False
    out[:total][filled] = w.data[w.is_word]
    return out, at, width


def majority(hashes: np.ndarray, begin: np.ndarray, count: np.ndarray) -> np.ndarray:
    """For runs of hashes (begin, count > 0, in a row): the bits set in over half of each run."""
    blocks = (count + 254) // 255
    first = np.cumsum(blocks) - blocks
    inner = np.arange(blocks.sum()) - np.repeat(first, blocks)
    cuts = np.repeat(begin, blocks) + inner * 255
    votes = np.empty((len(count), 64), np.int64)
    for bit in range(8):
        packed = np.add.reduceat((hashes >> np.uint64(bit)) & _LANES, cuts)
        lanes = packed.view(np.uint8).reshape(-1, 8).astype(np.int64)
        votes[:, bit::8] = np.add.reduceat(lanes, first, axis=0)
    bits = (2 * votes > count[:, None]).astype(np.uint64)
    return (bits << np.arange(64, dtype=np.uint64)).sum(axis=1, dtype=np.uint64)


def _shingles(w: common.Words, some: np.ndarray, buffer: np.ndarray, at: np.ndarray, width: np.ndarray, shingle: int, seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the shingles of the texts ``some``, one text after another; where each text begins and its count."""
    n_words = np.diff(w.offsets)[some]
    count = np.maximum(n_words - shingle + 1, 1)
    begin = np.cumsum(count) - count
    head = np.repeat(w.offsets[:-1][some], count) + np.arange(count.sum()) - np.repeat(begin, count)
    tail = head + np.repeat(np.minimum(n_words, shingle), count) - 1
    hashes = np.empty(len(head), np.uint64)
    for a in range(0, len(head), 1_000_000):
        h, t = head[a : a + 1_000_000], tail[a : a + 1_000_000]
        hashes[a : a + len(h)] = xxh64_spans(buffer, at[h], at[t] + width[t] - at[h], seed)
    return hashes, begin, count


def shingle_sets(column: pa.Array, shingle: int, seed: int = 42) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingle hashes of each text, ascending, one text after another; n+1 offsets. No word, no shingle."""
    w = common.scan_words(column, hashed=False, lower=True)
    some = np.flatnonzero(np.diff(w.offsets))
    sizes = np.zeros(len(w.offsets) - 1, np.int64)
    hashes = np.empty(0, np.uint64)
    if len(some):
        hashes, _, count = _shingles(w, some, *_joined(w), shingle, seed)
        owner = np.repeat(some, count)
        order = np.lexsort((hashes, owner))
        hashes, owner = hashes[order], owner[order]
        new = np.ones(len(hashes), bool)
        new[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
        hashes = hashes[new]
        sizes = np.bincount(owner[new], minlength=len(sizes))
    return hashes, np.concatenate(([0], np.cumsum(sizes)))


def band_keys(hashes: np.ndarray, offsets: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """MinHash: for each set a row of ``bands`` keys, each of ``rows`` least remixed hashes; zeros for an empty set."""
    factors = np.random.Generator(np.random.PCG64(711)).integers(0, 2**64, (bands, rows), np.uint64) | np.uint64(1)
    out = np.zeros((len(offsets) - 1, bands), np.uint64)
    some = np.flatnonzero(np.diff(offsets))
    if len(some):
        for b in range(bands):
            key = np.full(len(some), b, np.uint64)
            for f in factors[b]:
                key = common.join_hash(key, np.minimum.reduceat(hashes * f, offsets[:-1][some]))
            out[some, b] = key
    return out


def fingerprints(column: pa.Array, plan: tuple[tuple[int, int], ...] = ((3, 1),), seed: int = 42) -> np.ndarray:
    """For each text a row of 64-bit fingerprints: for each (shingle, n) of the plan, n of them.

    The first of a shingle length is by XXH64 itself, further ones by remixed hashes.
    A-Z are lower-cased, shingles are joined by a space, repeats count.
    """
    w = common.scan_words(column, hashed=False, lower=True)
    n_words = np.diff(w.offsets)
    out = np.zeros((len(n_words), sum(n for _, n in plan)), np.uint64)
    some = np.flatnonzero(n_words)
    if not len(some):
        return out
    buffer, at, width = _joined(w)
    place = 0
    for shingle, n in plan:
        hashes, begin, count = _shingles(w, some, buffer, at, width, shingle, seed)
        for k in range(n):
            out[some, place] = majority(common.mix(hashes + np.uint64(k * 0x9E3779B97F4A7C15 % 2**64)) if k else hashes, begin, count)
            place += 1
    return out
