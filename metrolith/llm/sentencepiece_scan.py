"""SentencePiece encoding and decoding of whole texts, giant ones in parallel chunks (operator 1).

Texts of up to ``giant`` bytes are encoded where they are: cut at hard cuts into units (white space and the word
after it), each distinct unit by the max-plus lattice of ``pieces``, remembered.
A longer text is split into chunks that go to different tasks.  Each chunk gives its transfer
matrix between the states at its two borders; the matrices of a text (a few numbers a chunk) are combined
by an associative scan, which fixes the state at each border; then every chunk is traced back by itself and the
parts are put together.  Inside a chunk the lattice is walked only up to the first hard cut and after the last
one: in between, the units' own encodings hold whatever the border states are.

The ids are those of the sentencepiece library for the same model (identity normalization, dummy
prefix, byte fallback).  Decoding puts pieces together, marks as spaces, without the dummy prefix; it is
the inverse of encoding for every text without a literal mark (U+2581), which reads as a space, as in the library.

Defined results: null and empty texts have no ids and decode to an empty text.  One row for each input row; repeated
rows and null doc_ids are kept.  Columns other than doc_id and text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from metrolith.llm import common, pieces, tokens
from metrolith.llm.memory import SpanMemory, distinct, gather, texts_of

MODEL = "piece_bpe_32k.model"
GIANT = 65_536
CHUNK = 16_384
_MARK_BYTES = pieces.MARK.encode()


class Encoder:
    """A model with a memory of units' ids."""

    def __init__(self, name: str):
        self.model = pieces.Model(tokens.model_path(name))
        self.memory = SpanMemory(self.units, np.int32)
        raw = [b"" if p in ("<s>", "</s>") else p.replace(pieces.MARK, " ").encode() for p in self.model.pieces]
        for b, i in self.model.byte_id.items():
            raw[i] = bytes([b])
        raw[self.model.unknown] = " ⁇ ".encode()
        self.piece_size = np.array([len(r) for r in raw], np.int64)
        self.piece_bytes = np.frombuffer(b"".join(raw), np.uint8)

    def units(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of units, given with the dummy prefix where they have one."""
        ids, unit = self.model.ids, self.model.unit
        flat: list[int] = []
        sizes: list[int] = []
        for u in texts:
            found = ids(unit(u.replace(" ", pieces.MARK)))
            flat += found
            sizes.append(len(found))
        return np.array(flat, np.int32), np.array(sizes, np.int64)

    def column(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and n+1 offsets."""
        w = common.scan_words(column, hashed=False)
        if _MARK_BYTES in w.data.tobytes():  # a literal mark can hide a hard cut: such texts are one unit
            begin, end, owner = _units(w, np.array([_MARK_BYTES in (t or b"") for t in column.to_pylist()]))
        else:
            begin, end, owner = _units(w, None)
        head = np.ones(len(owner), bool)
        head[1:] = owner[1:] != owner[:-1]
        heads = np.where(head, np.uint64(0x9E3779B97F4A7C15), np.uint64(0))
        hashes = common.hash_spans(w.data, begin, end) ^ heads
        code, first = distinct(w.data, begin, end, hashes)
        second = common.hash_spans(w.data, begin[first], end[first], second=True) ^ heads[first]
        prefix = " " if self.model.prefix else ""

        def texts(rows: np.ndarray) -> list[str]:
            at = first[rows]
            return [prefix + u if h else u for u, h in zip(texts_of(w.data, begin[at], end[at]), head[at].tolist())]

        pool, start, size = self.memory.find(hashes[first], second, texts)
        asked = size[code]
        ids = gather(pool, start[code], asked)
        each = np.bincount(owner, weights=asked, minlength=len(w.offsets) - 1).astype(np.int64)
        return ids, np.concatenate(([0], np.cumsum(each)))

    def decoded(self, ids: np.ndarray, offsets: np.ndarray) -> pa.Array:
        """Texts of id runs, as large_binary."""
        size = self.piece_size[ids]
        data = gather(self.piece_bytes, (np.cumsum(self.piece_size) - self.piece_size)[ids], size)
        total = np.concatenate(([0], np.cumsum(size)))[offsets]
        if self.model.prefix:  # each text's first byte is the dummy prefix's space
            filled = np.flatnonzero(np.diff(total))
            keep = np.ones(len(data), bool)
            keep[total[:-1][filled]] = False
            data = data[keep]
            shorter = np.zeros(len(total), np.int64)
            shorter[filled + 1] = 1
            total = total - np.cumsum(shorter)
        return pa.Array.from_buffers(pa.large_binary(), len(total) - 1, [None, pa.py_buffer(total.astype(np.int64).tobytes()), pa.py_buffer(data.tobytes())])


def _units(w: common.Words, whole: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Spans of units that cover every text, none empty, and their texts."""
    owner = common.owner_of(w.offsets)
    begin = np.concatenate(([0], w.ends[:-1])) if len(w.ends) else np.empty(0, np.int64)
    begin = np.maximum(begin, w.text_at[owner])
    last = np.full(len(w.offsets) - 1, -1, np.int64)
    some = np.flatnonzero(np.diff(w.offsets))
    last[some] = w.ends[w.offsets[1:][some] - 1]
    tail_at = np.where(last >= 0, last, w.text_at[:-1])
    tail = np.flatnonzero(tail_at < w.text_at[1:])  # white space after the last word, or alone
    begin = np.concatenate((begin, tail_at[tail]))
    end = np.concatenate((w.ends, w.text_at[1:][tail]))
    owner = np.concatenate((owner, tail))
    if whole is not None:
        keep = ~whole[owner]
        texts = np.flatnonzero(whole)
        begin, end, owner = (np.concatenate((x[keep], y)) for x, y in ((begin, w.text_at[texts]), (end, w.text_at[texts + 1]), (owner, texts)))
    order = np.argsort(begin, kind="stable")
    return begin[order], end[order], owner[order]


_ENCODERS: dict[str, Encoder] = {}


def encoder(name: str = MODEL) -> Encoder:
    if name not in _ENCODERS:
        _ENCODERS[name] = Encoder(name)
    return _ENCODERS[name]


class Chunk:
    """A chunk [begin, end) of a text, with the characters around it that its border states need."""

    def __init__(self, model: pieces.Model, text: str, begin: int, end: int, final: bool):
        self.model, self.text, self.begin, self.end, self.final = model, text, begin, end, final
        self.entries = model.states(text, begin, self.cut(begin))
        self.exits = [s for s in model.states(text + "\0" * final, end, self.cut(end)) if s[0] <= len(text)]
        cuts = [at for at in range(begin, end) if self.cut(at)]
        self.cuts = (cuts[0], cuts[-1]) if cuts else None

    def cut(self, at: int) -> bool:
        t = self.text
        return at == 0 or (at < len(t) and t[at] == pieces.MARK and t[at - 1] != pieces.MARK)

    def middle(self) -> list[str]:
        """Pieces between the chunk's first and last hard cut."""
        out: list[str] = []
        a = self.cuts[0]
        for b in range(a + 1, self.cuts[1] + 1):
            if self.cut(b):
                out += self.model.unit(self.text[a:b])
                a = b
        return out

    def matrix(self) -> np.ndarray:
        m, t = self.model, self.text
        if self.cuts is None:
            return m.transfer(t, self.begin, self.end, self.entries, self.exits)
        a, b = self.cuts
        into = m.transfer(t, self.begin, a, self.entries, [(a, None)])
        out = m.transfer(t, b, self.end, [(b, None)], self.exits)
        return into + m.value(self.middle()) + out

    def trace(self, entry: int, leave: int) -> list[str]:
        m, (at, last), (end, after) = self.model, self.entries[entry], self.exits[leave]
        free = after is None and m.kind == "bpe"  # the state at a hard cut forgets its piece
        if self.cuts is None:
            return self._walk(at, last, end, after, free)
        a, b = self.cuts
        head = m.path(self.text[at:a], last) if at < a else []
        return head + self.middle() + self._walk(b, None, end, after, free)

    def _walk(self, at: int, last: str | None, end: int, after: str | None, free: bool) -> list[str]:
        if free:
            return self.model.path(self.text[at:end], last)
        return self.model.path(self.text[at : end], last, (end - at, after), self.end - at)


def borders(text: str, size: int) -> list[int]:
    """Chunk borders about every ``size`` characters, at a hard cut if one is near before."""
    out = [0]
    while len(text) - out[-1] > size + size // 4:
        at = out[-1] + size
        for back in range(at, at - size // 16, -1):
            if text[back] == pieces.MARK and text[back - 1] != pieces.MARK:
                at = back
                break
        out.append(at)
    return [*out, len(text)]


def encode(spark: SparkSession, docs: DataFrame, *, model: str = MODEL, giant: int = GIANT, chunk: int = CHUNK, decoded: bool = False) -> DataFrame:
    """doc_id, ids (array of int), n_chunks for each row of ``docs`` (doc_id, text).

    ``decoded`` adds what the ids decode to, made where they are made, so that no task runs two Python workers.
    """
    common.prepare(spark)
    rows = common.id_and_bytes(docs)
    schema = "doc_id long, ids array<int>, n_chunks int" + ", decoded string" * decoded

    def here(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = encoder(model)
        for batch in batches:
            for a, b in common.slices(batch.column(1), 1_000_000):
                ids, offsets = tool.column(batch.column(1)[a:b])
                listed = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(ids))
                columns = [batch.column(0)[a:b], listed, pa.array(np.ones(b - a, np.int32))]
                if decoded:
                    columns.append(_as_string(tool.decoded(ids, offsets)))
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "ids", "n_chunks", "decoded"][: len(columns)])
        common.give_back()

    small = rows.where(F.coalesce(F.octet_length("text"), F.lit(0)) <= giant).mapInArrow(here, schema)

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice = encoder(model).model
        around = lattice.longest + 1
        for batch in batches:
            for doc, copy, raw in zip(*(c.to_pylist() for c in batch.columns)):
                text = raw.decode().replace(" ", pieces.MARK)
                text = pieces.MARK + text if lattice.prefix else text
                at = borders(text, chunk)
                n = len(at) - 1
                low = [max(0, a - around) for a in at[:-1]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([copy] * n), pa.array([doc] * n, pa.int64()), pa.array(range(n), pa.int32()), pa.array([n] * n, pa.int32()), pa.array([text[s : e + around] for s, e in zip(low, at[1:])]), pa.array([a - s for a, s in zip(at, low)], pa.int32()), pa.array([e - s for e, s in zip(at[1:], low)], pa.int32())],
                    ["copy", "doc_id", "chunk", "n_chunks", "part", "first", "last"],
                )

    pieces_sql = "copy string, doc_id long, chunk int, n_chunks int, part string, first int, last int"
    large = rows.where(F.octet_length("text") > giant)
    # rows may repeat: a name for each row that is the same whenever it is computed
    large = large.groupBy("doc_id", "text").agg(F.count("*").alias("n")).select("doc_id", F.explode(F.sequence(F.lit(1), "n")).alias("again"), "text")
    large = large.select("doc_id", F.concat_ws("-", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.sha2("text", 256), "again").alias("copy"), "text")
    chunks = large.mapInArrow(split, pieces_sql).repartition("copy", "chunk")

    def chunk_of(row: dict) -> Chunk:
        return Chunk(encoder(model).model, row["part"], row["first"], row["last"], row["chunk"] == row["n_chunks"] - 1)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [chunk_of(r).matrix() for r in batch.to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("copy"), batch.column("chunk"), pa.array([m.shape[0] for m in made], pa.int32()), pa.array([m.astype("<f8").tobytes() for m in made], pa.binary())], ["copy", "chunk", "height", "matrix"])

    def settle(table: pa.Table) -> pa.Table:
        got = sorted(table.select(["chunk", "height", "matrix", "copy"]).to_pylist(), key=lambda r: r["chunk"])
        states = pieces.border_states([np.frombuffer(r["matrix"], "<f8").reshape(r["height"], -1) for r in got])
        return pa.table({"of_copy": pa.array([r["copy"] for r in got]), "of_chunk": pa.array([r["chunk"] for r in got], pa.int32()), "entry": pa.array([s[0] for s in states], pa.int32()), "leave": pa.array([s[1] for s in states], pa.int32())})

    def trace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice = encoder(model).model
        for batch in batches:
            ids = [lattice.ids(chunk_of(r).trace(r["entry"], r["leave"])) for r in batch.to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("copy"), batch.column("doc_id"), batch.column("chunk"), pa.array(ids, pa.list_(pa.int32()))], ["copy", "doc_id", "chunk", "ids"])

    matrices = chunks.mapInArrow(measure, "copy string, chunk int, height int, matrix binary")
    states = matrices.groupBy("copy").applyInArrow(settle, "of_copy string, of_chunk int, entry int, leave int")
    placed = chunks.join(states, (F.col("copy") == F.col("of_copy")) & (F.col("chunk") == F.col("of_chunk"))).drop("of_copy", "of_chunk")
    traced = placed.mapInArrow(trace, "copy string, doc_id long, chunk int, ids array<int>")
    whole = traced.groupBy("copy").agg(F.first("doc_id").alias("doc_id"), F.sort_array(F.collect_list(F.struct("chunk", "ids"))).alias("parts"))
    whole = whole.select("doc_id", F.flatten("parts.ids").alias("ids"), F.size("parts").alias("n_chunks"))
    if decoded:
        whole = decode(spark, whole.withColumn("read", F.col("ids")), model=model, ids="read")
    return small.unionByName(whole)


def _as_string(texts: pa.Array) -> pa.Array:
    return texts.cast(pa.large_string()).cast(pa.string())


def decode(spark: SparkSession, encoded: DataFrame, *, model: str = MODEL, ids: str = "ids") -> DataFrame:
    """The rows of ``encoded`` with a column ``decoded`` instead of the ids (null ids: empty); works in column order."""
    common.prepare(spark)
    others = [c for c in encoded.columns if c != ids]
    kinds = dict(encoded.dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = encoder(model)
        for batch in batches:
            column = batch.column(0)
            if column.null_count:
                column = column.fill_null([])
            offsets = np.concatenate(([0], np.cumsum(column.value_lengths().to_numpy(zero_copy_only=False)))).astype(np.int64)
            texts = tool.decoded(column.flatten().to_numpy(zero_copy_only=False).astype(np.int64), offsets)
            yield pa.RecordBatch.from_arrays([_as_string(texts), *batch.columns[1:]], ["decoded", *others])

    return encoded.select(ids, *others).mapInArrow(run, ", ".join(["decoded string", *(f"`{c}` {kinds[c]}" for c in others)]))
