"""Token-id files: ids of documents in ascending doc_id order, coded by static rANS (operator 2).

A file set is a folder in any store that Spark writes to:

* ``table``   (symbol, frequency): the one frequency table, from the counts of all ids of all documents;
* ``blocks``  one row a block: shard, block, first (ids of the shard before it), n_tokens, payload (see ``rans``:
  lanes, checkpoints, checksum) and pieces: which document each run of ids belongs to;
* ``shards``  (shard, base, n_tokens): ids of all shards before it.

Shards are ranges of doc_id in ascending order (null last), made by a range shuffle that can also part the rows of one doc_id; ids run on from shard to shard.
Blocks hold a fixed number of ids, whatever documents these belong to, so a very long document is
many blocks.  Any block can be decoded without the others.

Defined results: a null or empty text is the end id alone.  Rows that repeat a doc_id are documents of their
own, in the order in which they were read.  Columns other than doc_id and text are not read.  An empty table gives an empty file set.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from metrolith.llm import common, rans, tokens

SHARD_BYTES = 16_000_000
#: Shards at most; beyond it they grow, which costs no memory, since a shard is coded block by block.
MOST_SHARDS = 20_000
#: Blocks that are coded side by side.
TOGETHER = 32

_BLOCKS = "shard int, block int, first long, n_tokens int, payload binary, pieces binary"
_PIECE = np.dtype([("row", "<i8"), ("doc_id", "<i8"), ("null", "<i8"), ("part", "<i8"), ("n", "<i8"), ("start", "<i8")])


def stash_ids(spark: SparkSession, docs: DataFrame, path: str, model: str, end_id: int | None) -> DataFrame:
    """doc_id, ids (binary) and row (a number of its own) of every text, written in the shared folder: each text is tokenized once."""
    kind = np.uint16 if tokens.model(model).size <= 1 << 16 else np.uint32

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            for a, b in common.slices(batch.column(1)):
                found = tokens.Tokens(batch.column(1)[a:b], model, end_id)
                offsets = found.offsets.astype(np.int64) * kind().itemsize
                held = pa.Array.from_buffers(pa.large_binary(), b - a, [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(found.ids().astype(kind).tobytes())])
                yield pa.RecordBatch.from_arrays([batch.column(0)[a:b], held.cast(pa.binary()), pa.array(np.arange(row, row + b - a))], ["doc_id", "ids", "row"])
                row += b - a
        common.give_back()

    rows = common.id_and_bytes(docs).mapInArrow(run, "doc_id long, ids binary, row long")
    rows.write.option("compression", "zstd").parquet(path)
    return spark.read.parquet(path)


def _of_stash(column: pa.Array, kind: type) -> tuple[np.ndarray, np.ndarray]:
    data, at = common.binary_parts(column)
    return data.view(kind) if len(data) else np.empty(0, kind), at // kind().itemsize


def count_ids(stash: DataFrame, size: int) -> np.ndarray:
    """How often each id occurs in all documents: one number for each entry of the vocabulary."""
    kind = np.uint16 if size <= 1 << 16 else np.uint32

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            total += np.bincount(_of_stash(batch.column(0), kind)[0], minlength=size)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], ["symbol", "n"])

    out = np.zeros(size, np.int64)
    part = stash.select("ids").mapInArrow(count, "symbol long, n long")
    for row in part.groupBy("symbol").agg(F.sum("n").alias("n")).collect():
        out[row["symbol"]] = row["n"]
    return out


class _Shard:
    """Collects ids of documents in order and gives rows of blocks."""

    def __init__(self, number: int, table: rans.Table):
        self.number, self.table = number, table
        self.ids: list[np.ndarray] = []
        self.held = self.done = self.block = self.rows = 0
        self.documents: list[np.ndarray] = []

    def add(self, ids: np.ndarray, offsets: np.ndarray, doc_id: np.ndarray, null: np.ndarray) -> None:
        piece = np.zeros(len(doc_id), _PIECE)
        piece["row"] = self.rows + np.arange(len(doc_id))
        piece["doc_id"], piece["null"], piece["n"] = doc_id, null, np.diff(offsets)
        piece["start"] = self.done + self.held + offsets[:-1]
        self.rows += len(doc_id)
        self.documents.append(piece)
        self.ids.append(ids)
        self.held += len(ids)

    def flush(self, final: bool) -> pa.RecordBatch | None:
        n = self.held if final else self.held // rans.BLOCK * rans.BLOCK
        if not n or (not final and n < TOGETHER * rans.BLOCK):
            return None
        ids, documents = np.concatenate(self.ids), np.concatenate(self.documents)
        out: dict[str, list] = {k: [] for k in ("shard", "block", "first", "n_tokens", "payload", "pieces")}
        end = documents["start"] + documents["n"]
        for a in range(0, n, TOGETHER * rans.BLOCK):
            cuts = range(a, min(n, a + TOGETHER * rans.BLOCK), rans.BLOCK)
            blocks = [ids[i : min(i + rans.BLOCK, n)] for i in cuts]
            for i, b, payload in zip(cuts, blocks, rans.encode(blocks, self.table)):
                low, high = self.done + i, self.done + i + len(b)
                held = documents[np.searchsorted(end, low, "right") : np.searchsorted(documents["start"], high, "left")].copy()
                begin = np.maximum(held["start"], low)
                held["part"] = begin - held["start"]
                held["n"] = np.minimum(held["start"] + held["n"], high) - begin
                for k, v in zip(out, (self.number, self.block, low, len(b), payload, held.tobytes())):
                    out[k].append(v)
                self.block += 1
        rest = documents[end > self.done + n] if not final else documents[:0]
        self.done, self.held = self.done + n, self.held - n
        self.ids, self.documents = [ids[n:]], [rest]
        kinds = (pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out.values(), kinds)], list(out))


def write_tokens(spark: SparkSession, docs: DataFrame, path: str, *, model: str = tokens.MODEL, end_id: int | None = tokens.END_ID) -> None:
    """Write the ids of all documents as a file set."""
    common.prepare(spark)
    size = tokens.model(model).size
    kind = np.uint16 if size <= 1 << 16 else np.uint32
    stash = stash_ids(spark, docs, common.scratch(spark, "token-ids"), model, end_id)
    counts = count_ids(stash, size)
    table = rans.Table(rans.quantise(counts))
    spark.createDataFrame([(int(i), int(table.frequency[i])) for i in np.flatnonzero(table.frequency)], "symbol int, frequency int").coalesce(1).write.parquet(f"{path}/table")
    shards = min(MOST_SHARDS, max(1, math.ceil(int(counts.sum()) * 3 / SHARD_BYTES)))

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = _Shard(TaskContext.get().partitionId(), table)
        for batch in batches:
            ids = batch.column(0)
            null = np.asarray(ids.is_null())
            ids = ids.fill_null(0).to_numpy()
            for a, b in common.slices(batch.column(1)):
                found, offsets = _of_stash(batch.column(1)[a:b], kind)
                shard.add(found, offsets, ids[a:b], null[a:b])
                if (rows := shard.flush(False)) is not None:
                    yield rows
        if (rows := shard.flush(True)) is not None:
            yield rows

    # the stash is written, so a row's number there is the same whenever it is read; it parts the rows of one doc_id
    order = [F.col("doc_id").asc_nulls_last(), F.col("row")]
    ranged = stash.repartitionByRange(shards, *order).sortWithinPartitions(*order).select("doc_id", "ids")
    ranged.mapInArrow(make, _BLOCKS).write.parquet(f"{path}/blocks")
    totals = spark.read.parquet(f"{path}/blocks").groupBy("shard").agg(F.sum("n_tokens").alias("n_tokens"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # one row a shard
    totals.select("shard", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).alias("base"), "n_tokens").write.parquet(f"{path}/shards")


def read_blocks(spark: SparkSession, path: str, block_columns: list[str], use, schema: str) -> DataFrame:
    """Decode all blocks, several at a time; ``use(ids of each block, batch)`` makes Arrow batches of ``schema``."""
    rows = spark.read.parquet(f"{path}/table").collect()  # at most one row for each entry of the vocabulary
    frequency = np.zeros(max((r["symbol"] for r in rows), default=0) + 1, np.int64)
    for r in rows:
        frequency[r["symbol"]] = r["frequency"]
    table = rans.Table(frequency)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, TOGETHER):
                part = batch.slice(a, TOGETHER)
                yield use(rans.decode(part.column("payload").to_pylist(), table), part)

    return spark.read.parquet(f"{path}/blocks").select("payload", *block_columns).mapInArrow(run, schema)


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, all from the files."""

    def pieces(found: list[np.ndarray], batch: pa.RecordBatch) -> pa.RecordBatch:
        parts, crcs = [], []
        for ids, first, raw in zip(found, batch.column("first").to_pylist(), batch.column("pieces").to_pylist()):
            held = np.frombuffer(raw, _PIECE)
            begin = held["start"] + held["part"] - first
            value = ids.astype("<u4").tobytes()
            view = memoryview(value)
            crcs += [zlib.crc32(view[4 * s : 4 * e]) for s, e in zip(begin.tolist(), (begin + held["n"]).tolist())]
            parts.append(held)
        sizes = [len(p) for p in parts]
        held = np.concatenate(parts) if parts else np.zeros(0, _PIECE)
        doc = pa.array(held["doc_id"], mask=held["null"].astype(bool))
        shard = np.repeat(batch.column("shard").to_numpy(), sizes)
        return pa.RecordBatch.from_arrays([pa.array(shard), pa.array(held["row"]), doc, pa.array(held["start"]), pa.array(held["part"]), pa.array(held["n"]), pa.array(crcs, pa.int64())], ["shard", "row", "doc_id", "start", "part", "n", "crc"])

    found = read_blocks(spark, path, ["shard", "first", "pieces"], pieces, "shard int, row long, doc_id long, start long, part long, n long, crc long")
    grouped = found.groupBy("shard", "row").agg(F.first("doc_id").alias("doc_id"), F.first("start").alias("start"), F.sum("n").alias("n_tokens"), F.sort_array(F.collect_list(F.struct("part", "crc", "n"))).alias("parts"))

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            crc = [p[0]["crc"] if len(p) == 1 else rans.crc32_join([(x["crc"], 4 * x["n"]) for x in p]) for p in batch.column(4).to_pylist()]
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(4)), pa.array(crc, pa.int64())], ["shard", "doc_id", "start", "n_tokens", "ids_crc32"])

    whole = grouped.select("shard", "doc_id", "start", "n_tokens", "parts").mapInArrow(join, "shard int, doc_id long, start long, n_tokens long, ids_crc32 long")
    bases = spark.read.parquet(f"{path}/shards").select(F.col("shard").alias("of_shard"), "base")
    return whole.join(bases, F.col("shard") == F.col("of_shard")).select("doc_id", (F.col("start") + F.col("base")).alias("start"), "n_tokens", "ids_crc32")


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start and ids (array of int) of every document."""

    def pieces(found: list[np.ndarray], batch: pa.RecordBatch) -> pa.RecordBatch:
        rows: list[tuple] = []
        for ids, first, shard, raw in zip(found, batch.column("first").to_pylist(), batch.column("shard").to_pylist(), batch.column("pieces").to_pylist()):
            for p in np.frombuffer(raw, _PIECE):
                at = int(p["start"] + p["part"]) - first
                rows.append((shard, int(p["row"]), None if p["null"] else int(p["doc_id"]), int(p["start"]), int(p["part"]), ids[at : at + int(p["n"])].astype(np.int32)))
        columns = list(zip(*rows)) if rows else [[]] * 6
        kinds = (pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32()))
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], ["shard", "row", "doc_id", "start", "part", "ids"])

    found = read_blocks(spark, path, ["shard", "first", "pieces"], pieces, "shard int, row long, doc_id long, start long, part long, ids array<int>")
    grouped = found.groupBy("shard", "row").agg(F.first("doc_id").alias("doc_id"), F.first("start").alias("start"), F.sort_array(F.collect_list(F.struct("part", "ids"))).alias("parts"))
    bases = spark.read.parquet(f"{path}/shards").select(F.col("shard").alias("of_shard"), "base")
    return grouped.join(bases, F.col("shard") == F.col("of_shard")).select("doc_id", (F.col("start") + F.col("base")).alias("start"), F.flatten("parts.ids").alias("ids"))
