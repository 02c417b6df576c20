"""Recompression of word sequences, in numpy: the parse behind the substring operator.

A text starts as one symbol a word.  Each round first replaces runs of a symbol by one symbol that is named after
it and the run's length, then halves the alphabet by a bit of each symbol's name and replaces every
pair (left symbol, right symbol) by a symbol named after the two.  Names are hashes of names, so
equal substrings get equal interior symbols in every text, without a table to agree on.

Every symbol carries the words on which its existence depends (``low`` to ``high``): its own words and those
neighbours that decided it.  Wherever these words occur, the same symbol is formed at the same place.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from metrolith.llm import common

ROUNDS = 3


@dataclass
class Symbols:
    """Symbols formed by a run or a pair: name, round, and the range of words that decides them."""

    name: np.ndarray
    rank: np.ndarray
    low: np.ndarray
    high: np.ndarray


def parse(hashes: np.ndarray, offsets: np.ndarray, rounds: int = ROUNDS) -> Symbols:
    """The symbols formed in all texts; word positions count through all texts."""
    name, doc = hashes, common.owner_of(offsets)
    first = np.arange(len(hashes))
    last = first + 1  # one past the symbol's words
    low, high = first, last
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = []
    for turn in range(rounds):
        if len(name) < 2:
            break
        # runs
        together = (name[1:] == name[:-1]) & (doc[1:] == doc[:-1])
        head = np.flatnonzero(np.concatenate(([True], ~together)))
        size = np.diff(np.append(head, len(name)))
        low, high = np.minimum.reduceat(low, head), np.maximum.reduceat(high, head)
        first, last, doc = first[head], last[head + size - 1], doc[head]
        name = np.where(size > 1, common.join_hash(name[head], size.astype(np.uint64)), name[head])
        near = doc[1:] == doc[:-1]
        has_left, has_right = np.concatenate(([False], near)), np.concatenate((near, [False]))
        # a neighbour whose touching word differs can't be the same symbol; else all it depends on is needed
        before, after = first - 1, np.minimum(last, len(hashes) - 1)
        like_left = has_left & (hashes[before] == hashes[last - 1])
        like_right = has_right & (hashes[after] == hashes[first])
        left, right = np.flatnonzero(like_left), np.flatnonzero(like_right)
        new_low, new_high = np.minimum(low, before), np.maximum(high, last + 1)
        new_low[left] = np.minimum(low[left], low[left - 1])
        new_low[right] = np.minimum(new_low[right], low[right + 1])
        new_high[right] = np.maximum(high[right], high[right + 1])
        new_high[left] = np.maximum(new_high[left], high[left - 1])
        low, high = new_low, new_high
        runs = np.flatnonzero(size > 1)
        if len(runs):
            found.append((name[runs], np.full(len(runs), 2 * turn, np.uint64), low[runs], high[runs]))
        # pairs
        is_left = common.mix(name ^ np.uint64(0x51ED270B9F2E4C83 + turn)) >> np.uint64(63) == 0
        begin = np.flatnonzero(is_left[:-1] & ~is_left[1:] & near)
        paired = np.zeros(len(name), bool)
        paired[begin] = True
        paired[begin + 1] = True
        wait_right, wait_left = ~paired & is_left, ~paired & ~is_left
        new_low, new_high = low.copy(), high.copy()
        for wait, near_side, step in ((wait_right, has_right, 1), (wait_left, has_left, -1)):
            at = np.flatnonzero(wait & near_side)
            new_low[at], new_high[at] = np.minimum(low[at], low[at + step]), np.maximum(high[at], high[at + step])
        at = np.flatnonzero(wait_right & ~has_right)
        new_high[at] = last[at] + 1
        at = np.flatnonzero(wait_left & ~has_left)
        new_low[at] = first[at] - 1
        new_low[begin] = np.minimum(low[begin], low[begin + 1])
        new_high[begin] = np.maximum(high[begin], high[begin + 1])
        name = name.copy()
        name[begin] = common.join_hash(name[begin], name[begin + 1] + np.uint64(turn))
        last = last.copy()
        last[begin] = last[begin + 1]
        found.append((name[begin], np.full(len(begin), 2 * turn + 1, np.uint64), new_low[begin], new_high[begin]))
        stays = np.ones(len(name), bool)
        stays[begin + 1] = False
        name, doc, first, last, low, high = (x[stays] for x in (name, doc, first, last, new_low, new_high))
    if not found:
        none = np.empty(0, np.int64)
        return Symbols(none.astype(np.uint64), none.astype(np.uint64), none, none)
    return Symbols(*(np.concatenate(x) for x in zip(*found)))


@dataclass
class Windows:
    """Every window of ``width`` words inside a text, and the symbol that stands for it."""

    start: np.ndarray
    doc: np.ndarray
    content: np.ndarray  # hash of the words
    name: np.ndarray  # of the symbol, or a hash of the content where no symbol lies inside
    item: np.ndarray  # number of the symbol occurrence (windows with one number have one symbol occurrence)
    span: np.ndarray  # hash of all windows of that occurrence and their places around it


def windows(hashes: np.ndarray, offsets: np.ndarray, width: int, rounds: int = ROUNDS) -> Windows:
    """For each window choose, among the symbols that its own words decide, one by a rule that only
    looks at the window: latest round, then least hash, then leftmost.  Equal windows choose equal symbols at
    equal places, so it is enough to compare windows whose symbols have one name."""
    content = common.window_hash(hashes, width)
    doc = common.owner_of(offsets)
    if not len(content):
        none = np.empty(0, np.int64)
        return Windows(none, none, none.astype(np.uint64), none.astype(np.uint64), none, none.astype(np.uint64))
    start = np.flatnonzero(doc[: len(content)] == doc[width - 1 :])
    s = parse(hashes, offsets, rounds)
    fits = np.flatnonzero(s.high - s.low <= width)
    low, high = s.low[fits], s.high[fits]
    weight = (s.rank[fits] << np.uint64(58)) | (common.mix(s.name[fits]) >> np.uint64(6)) | np.uint64(1)
    best = np.zeros(len(hashes), np.uint64)
    steps = []
    for back in range(width):
        rows = np.flatnonzero((high <= low - back + width) & (low - back >= 0))
        if not len(rows):
            break
        steps.append((rows, low[rows] - back))
        np.maximum.at(best, steps[-1][1], weight[rows])
    owner = np.full(len(hashes), len(fits), np.int64)
    order = np.argsort(low, kind="stable")  # leftmost first
    place = np.empty(len(fits), np.int64)
    place[order] = np.arange(len(fits))
    for rows, at in steps:
        mine = weight[rows] == best[at]
        np.minimum.at(owner, at[mine], place[rows[mine]])
    chosen = owner[start]
    inside = chosen < len(fits)
    symbol = order[np.where(inside, chosen, 0)] if len(fits) else np.zeros(len(start), np.int64)
    content = content[start]
    name = common.mix(content ^ np.uint64(0xA5A5A5A5A5A5A5A5))
    name[inside] = s.name[fits][symbol[inside]]
    shift = np.zeros(len(start), np.uint64)
    shift[inside] = (low[symbol[inside]] - start[inside]).astype(np.uint64)
    item = np.where(inside, chosen, len(fits) + np.arange(len(start)))
    used = np.zeros(len(fits) + len(start), bool)
    used[item] = True
    number = (np.cumsum(used) - 1)[item]  # items without gaps
    span = np.zeros(int(used.sum()), np.uint64)
    np.add.at(span, number, common.mix(content + shift * np.uint64(0x9E3779B97F4A7C15)))
    return Windows(start, doc[start], content, name, number, common.mix(span)[number])
