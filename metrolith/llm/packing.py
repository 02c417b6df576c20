"""Best-fit packing into sequences of several permitted lengths (operator 6).

A document's tokens are cut into pieces of at most the largest length.  Pieces are dealt by a hash into shards of a
bounded number; in a shard, from the longest piece to the shortest:

* a piece goes into the open bin with the least room that holds it (ties: the bin opened first);
* if none does, a bin is opened.  Its length is chosen among all permitted ones that hold the piece: for each,
  the pieces still to come say how far it could be filled (the longest that fits, again and again); the one
  with the least cost for each filled token is opened (ties: the shorter).  A bin costs its length and ``overhead``;
* in the end each bin is cut down to the shortest permitted length that holds its contents.

Equal rows are counted and numbered first, and the number is part of the hash, so a shard's pieces are a bounded group
even if one row makes up a third of the input; no task grows with the input, and every piece is packed.

Defined results: each input row is packed, rows that repeat included; a null length counts as 0 and gets one empty
piece, so every row is found in the result.  Only doc_id and the length are read.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from metrolith.llm import common, tokens

CAPACITIES = (512, 1024, 2048, 4096)
OVERHEAD = 32
SHARD_PIECES = 20_000
#: Equal rows that are numbered together.
COPY_BLOCK = 4_096

SCHEMA = "doc_id long, piece long, start long, n_tokens long, bin long, capacity int, position long"


def room_filled(room: int, lengths: list[int], left: dict[int, int], limit: int = 64) -> int:
    """How much of ``room`` the remaining pieces fill, taking the longest that fits again and again."""
    filled, used = 0, {}
    at = bisect_right(lengths, room)
    for _ in range(limit):
        at = min(at, bisect_right(lengths, room - filled))
        while at and left[lengths[at - 1]] <= used.get(lengths[at - 1], 0):
            at -= 1
        if not at:
            break
        n = lengths[at - 1]
        take = min(left[n] - used.get(n, 0), (room - filled) // n)
        used[n] = used.get(n, 0) + take
        filled += take * n
    return filled


def pack(lengths: list[int], capacities: tuple[int, ...] = CAPACITIES, overhead: int = OVERHEAD) -> tuple[list[int], list[int], list[int]]:
    """For lengths in descending order: each one's bin and place in it; and the bins' lengths."""
    sizes = sorted(capacities)
    left: dict[int, int] = {}
    for n in lengths:
        left[n] = left.get(n, 0) + 1
    distinct = sorted(n for n in left if n)
    rooms: list[tuple[int, int]] = []  # (room, bin), sorted
    opened: list[int] = []
    content: list[int] = []
    bins, places = [], []
    for n in lengths:
        left[n] -= 1
        at = bisect_left(rooms, (n, -1))
        if at < len(rooms):
            room, number = rooms.pop(at)
        else:
            best = None
            for size in sizes[bisect_left(sizes, n) :]:
                cost = (size + overhead) / max(n + room_filled(size - n, distinct, left), 1)
                if best is None or cost < best[0]:
                    best = (cost, size)
            room, number = best[1], len(opened)
            opened.append(room)
            content.append(0)
        bins.append(number)
        places.append(content[number])
        content[number] += n
        insort(rooms, (room - n, number))
    return bins, places, [sizes[bisect_left(sizes, c)] for c in content]


def best_fit(spark: SparkSession, lengths: DataFrame, *, capacities: tuple[int, ...] = CAPACITIES, overhead: int = OVERHEAD, shard_pieces: int = SHARD_PIECES) -> DataFrame:
    """SCHEMA, one row a piece, for rows (doc_id, n_tokens)."""
    common.prepare(spark)
    most = max(capacities)
    rows = lengths.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("n_tokens").cast("long"), F.lit(0)).alias("whole"))
    # rows may repeat: number the copies, so that equal rows are pieces of their own and are dealt to all shards; a row
    # of very many copies is first split into blocks of them, which go to different tasks
    copies = rows.groupBy("doc_id", "whole").agg(F.count("*").alias("copies"))
    cut = F.greatest(F.ceil(F.col("whole") / most), F.lit(1)).cast("long")
    total = copies.agg(F.coalesce(F.sum(F.col("copies") * cut), F.lit(0)).alias("n")).first()["n"]
    shards = max(1, -(-total // shard_pieces))
    several = copies.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("copies") - 1) / COPY_BLOCK)))).repartition("doc_id", "whole", "block")
    last = F.least((F.col("block") + 1) * COPY_BLOCK, F.col("copies")) - 1
    numbered = several.select("doc_id", "whole", F.explode(F.sequence(F.col("block") * COPY_BLOCK, last)).alias("copy"))
    parts = numbered.select("doc_id", "whole", "copy", F.explode(F.sequence(F.lit(0).cast("long"), cut - 1)).alias("piece"))
    parts = parts.select("doc_id", "copy", "piece", (F.col("piece") * most).alias("start"), F.least(F.col("whole") - F.col("piece") * most, F.lit(most).cast("long")).alias("n_tokens"))
    dealt = parts.withColumn("shard", F.pmod(F.xxhash64("doc_id", "copy", "piece", "n_tokens"), F.lit(shards)))

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("n_tokens", "descending"), ("doc_id", "ascending"), ("piece", "ascending"), ("copy", "ascending")])
        bins, places, sizes = pack(table.column("n_tokens").to_pylist(), capacities, overhead)
        number = np.array(bins, np.int64)
        shard = table.column("shard").to_numpy()
        return pa.table(
            [*(table.column(c) for c in ("doc_id", "piece", "start", "n_tokens")), pa.array(shard * (1 << 32) + number), pa.array(np.array(sizes, np.int32)[number]), pa.array(places, pa.int64())],
            names=[x.split()[0] for x in SCHEMA.split(", ")],
        )

    return dealt.groupBy("shard").applyInArrow(run, SCHEMA)


def token_lengths(spark: SparkSession, docs: DataFrame, *, model: str = tokens.MODEL, end_id: int | None = tokens.END_ID) -> DataFrame:
    """doc_id and n_tokens of every whole text, the end id included."""
    common.prepare(spark)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in common.slices(batch.column(1)):
                found = tokens.Tokens(batch.column(1)[a:b], model, end_id)
                yield pa.RecordBatch.from_arrays([batch.column(0)[a:b], pa.array(np.diff(found.offsets))], ["doc_id", "n_tokens"])
        common.give_back()

    path = common.scratch(spark, "lengths")
    common.id_and_bytes(docs).mapInArrow(count, "doc_id long, n_tokens long").write.parquet(path)
    return spark.read.parquet(path)
