"""SentencePiece models as max-plus lattices, and the scan over their boundary states.

A position between two characters and the piece that ends there make a state; a piece that starts
there leads to another state.  For a unigram model the weight of a step is the piece's score.  For a BPE model it
is 0 where the two neighbouring pieces are what BPE makes of their joined text, and minus infinity else:
a sequence of pieces is the BPE encoding of a text exactly if all its neighbours are (merges happen in one global
order, so a merge across a border would already happen between the two pieces alone).  In both cases the
encoding is the best path, so a chunk of text is a matrix over (entry state, exit state) in the max-plus
semiring, matrices of neighbouring chunks combine associatively, and once the states at
the chunk borders are known each chunk is traced back alone.

No piece has a word-start mark after another character, so between a character and a following mark every state
is one state (a hard cut).
"""

from __future__ import annotations

import numpy as np
import sentencepiece

MARK = "▁"
_NONE = float("-inf")
#: Remembered pairs of neighbouring pieces, some hundred bytes each.
MOST_JOINS = 250_000


def _fields(raw: bytes):
    """(number, value) of a protocol buffer message."""
    at = 0

    def varint() -> int:
        nonlocal at
        out = shift = 0
        while True:
            byte = raw[at]
            at += 1
            out |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return out

    while at < len(raw):
        key = varint()
        if key & 7 == 0:
            yield key >> 3, varint()
        else:
            size = {1: 8, 5: 4}.get(key & 7) or varint()
            yield key >> 3, raw[at : at + size]
            at += size


class Model:
    """Pieces, scores and options of a model file, or of given pieces (for tests)."""

    def __init__(self, path: str | None = None, *, scores: dict[str, float] | None = None, kind: str = "bpe", byte_fallback: bool = True):
        self.kind, self.prefix, self.byte_id, self.unknown = kind, True, {}, 0
        if path is None:
            self.pieces = ["<unk>", *(f"<0x{b:02X}>" for b in range(256) if byte_fallback), *scores]
            special = set(self.pieces[: len(self.pieces) - len(scores)])
            self.score = dict(scores)
        else:
            sp = sentencepiece.SentencePieceProcessor(model_file=path)
            parts = dict(_fields(sp.serialized_model_proto()))
            trainer, normalizer = dict(_fields(parts[2])), dict(_fields(parts[3]))
            self.kind = {1: "unigram", 2: "bpe"}[trainer.get(3, 1)]
            self.prefix = bool(normalizer.get(3, 1))
            if normalizer.get(2) or normalizer.get(4, 1) or not normalizer.get(5, 1):
                raise ValueError("only models with identity normalization are read")
            self.pieces = [sp.id_to_piece(i) for i in range(sp.get_piece_size())]
            self.unknown = sp.unk_id()
            special = {self.pieces[i] for i in range(len(self.pieces)) if sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i)}
            self.score = {p: sp.get_score(i) for i, p in enumerate(self.pieces) if p not in special}
        self.id = {p: i for i, p in enumerate(self.pieces) if p not in special}
        if f"<0x{0:02X}>" in self.pieces:
            self.byte_id = {b: self.pieces.index(f"<0x{b:02X}>") for b in range(256)}
        self.longest = max(map(len, self.id), default=1)
        self.heads = {p[:k]: False for p in self.id for k in range(1, len(p))} | dict.fromkeys(self.id, True)
        self.missing = min(self.score.values(), default=0.0) - 10.0
        self._joins: dict[str | None, dict[str, bool]] = {}
        self._n_joins = 0
        if any(MARK in p.lstrip(MARK) for p in self.id):
            raise ValueError("a piece has a word-start mark inside")

    # steps

    def merged(self, text: str) -> list[str]:
        """BPE by its definition: merge the best pair, leftmost first, until none is a piece."""
        parts = list(text)
        while True:
            best, at = None, -1
            for i in range(len(parts) - 1):
                s = self.score.get(parts[i] + parts[i + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, i
            if best is None:
                return parts
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def joins(self, left: str | None, right: str) -> bool:
        if self.kind == "unigram":
            return True
        after = self._joins.get(left)
        if after is None:
            if self._n_joins > MOST_JOINS:
                self._joins.clear()
                self._n_joins = 0
            after = self._joins[left] = {}
        known = after.get(right)
        if known is None:
            known = after[right] = self.merged(right) == [right] if left is None else self.merged(left + right) == [left, right]
            self._n_joins += 1
        return known

    def weight(self, piece: str) -> float:
        return 0.0 if self.kind == "bpe" else self.score.get(piece, self.missing)

    def starting(self, text: str, at: int) -> list[str]:
        """Pieces that begin at a position; a character that is none stands for itself."""
        ids = self.id
        out = [p for e in range(at + 1, min(len(text), at + self.longest) + 1) if (p := text[at:e]) in ids]
        return out if out and len(out[0]) == 1 else [text[at], *out]

    def last(self, piece: str) -> str | None:
        """What a state remembers of the piece that led to it."""
        return piece if self.kind == "bpe" else None

    # whole units

    def unit(self, text: str) -> list[str]:
        """The best pieces of a text between hard cuts.

        For BPE every prefix has one valid last piece, so the lattice has one state a position.
        """
        if self.kind != "bpe":
            return self.path(text)
        n, heads, joins, memory = len(text), self.heads, self.joins, self._joins
        came: list[str | None] = [None] * (n + 1)
        for at in range(n):
            left = came[at]
            if at and left is None:
                continue
            after = memory.get(left) or {}
            for e in range(at + 1, n + 1):
                piece = text[at:e]
                whole = heads.get(piece)
                if whole is None and e > at + 1:
                    break
                if came[e] is None and whole is not False:
                    known = after.get(piece)
                    if known or (known is None and joins(left, piece)):
                        came[e] = piece
                if whole is None:
                    break
        out, at = [], n
        while at:
            out.append(came[at])
            at -= len(came[at])
        return out[::-1]

    def path(self, text: str, last: str | None = None, goal: tuple[int, str | None] | None = None, stop: int | None = None) -> list[str]:
        """The best pieces from position 0 (after ``last``) to the end, or of those that begin before
        ``stop`` with the last one leading to the state ``goal``."""
        stop = len(text) if stop is None else stop
        cells: dict[int, dict] = {0: {last: (0.0, None)}}
        for at in range(stop):
            here = cells.get(at)
            if not here:
                continue
            for piece in self.starting(text, at):
                best = None
                for before, (value, _) in here.items():
                    if self.joins(before, piece) and (best is None or value > best[0]):
                        best = (value, (at, before))
                if best is not None:
                    value = best[0] + self.weight(piece)
                    key, row = self.last(piece), cells.setdefault(at + len(piece), {})
                    if key not in row or value > row[key][0]:
                        row[key] = (value, (*best[1], piece))
        if goal is None:
            end = cells.get(len(text)) or {}
            goal = (len(text), max(end, key=lambda k: end[k][0])) if end else (0, last)
        out: list[str] = []
        at, key = goal
        while (came := cells[at][key][1]) is not None:
            out.append(came[2])
            at, key = came[0], came[1]
        return out[::-1]

    def value(self, pieces: list[str]) -> float:
        return sum(map(self.weight, pieces))

    # chunks

    def states(self, text: str, border: int, hard: bool) -> list[tuple[int, str | None]]:
        """(position, last) of every piece that ends at or reaches over a border, by text around it."""
        if hard or border == 0:
            return [(border, None)]
        if self.kind == "unigram":
            ends = {border} | {e for i in range(max(0, border - self.longest), border) for e in range(border + 1, min(len(text), i + self.longest) + 1) if text[i:e] in self.id}
            return [(e, None) for e in sorted(ends)]
        found = [(border, text[border - 1])] if text[border - 1] not in self.id else []
        for i in range(max(0, border - self.longest), border):
            found += [(e, text[i:e]) for e in range(border, min(len(text), i + self.longest) + 1) if text[i:e] in self.id]
        return found

    def transfer(self, text: str, begin: int, end: int, entries: list, exits: list) -> np.ndarray:
        """Best weights over pieces that start in [begin, end), from each entry to each exit state."""
        cells: dict[int, dict] = {}
        for k, (at, last) in enumerate(entries):
            row = np.full(len(entries), _NONE)
            row[k] = 0.0
            known = cells.setdefault(at, {}).get(last)
            cells[at][last] = row if known is None else np.maximum(known, row)
        for at in range(begin, end):
            here = cells.pop(at, None) if at < end else None
            if not here:
                continue
            for piece in self.starting(text, at):
                fitting = [v for before, v in here.items() if self.joins(before, piece)]
                if fitting:
                    value = np.max(fitting, axis=0) + self.weight(piece)
                    row, key = cells.setdefault(at + len(piece), {}), self.last(piece)
                    row[key] = np.maximum(row[key], value) if key in row else value
        out = np.full((len(entries), len(exits)), _NONE)
        for j, (at, last) in enumerate(exits):
            here = cells.get(at, {})
            if last is None and here:  # a hard cut, or a unigram state: what came before does not matter
                out[:, j] = np.max(list(here.values()), axis=0)
            elif last in here:
                out[:, j] = here[last]
        return out

    def ids(self, pieces: list[str]) -> list[int]:
        out: list[int] = []
        for p in pieces:
            known = self.id.get(p)
            if known is not None:
                out.append(known)
            elif self.byte_id:
                out += [self.byte_id[b] for b in p.encode()]
            elif not out or out[-1] != self.unknown:
                out.append(self.unknown)
        return out


def combine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The max-plus product."""
    if not a.shape[1]:
        return np.full((a.shape[0], b.shape[1]), _NONE)
    return np.max(a[:, :, None] + b[None, :, :], axis=1)


def scan(matrices: list[np.ndarray]) -> list[np.ndarray]:
    """All prefix products, by a balanced tree of products."""
    if len(matrices) < 2:
        return list(matrices)
    pairs = scan([combine(a, b) for a, b in zip(matrices[::2], matrices[1::2])])
    out = [matrices[0]]
    for k in range(1, len(matrices)):
        out.append(pairs[k // 2] if k % 2 else combine(pairs[k // 2 - 1], matrices[k]))
    return out


def border_states(matrices: list[np.ndarray]) -> list[tuple[int, int]]:
    """For each chunk the numbers of the entry and exit state that the best path of the whole text takes."""
    prefix = scan(matrices)
    at = int(np.argmax(prefix[-1][0]))
    out = []
    for k in range(len(matrices) - 1, -1, -1):
        before = int(np.argmax(prefix[k - 1][0] + matrices[k][:, at])) if k else 0
        out.append((before, at))
        at = before
    return out[::-1]
