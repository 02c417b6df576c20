"""Removal of word passages that an earlier document has, by recompression (operator 3).

A window is ``width`` consecutive words of one text.  Every word is removed that lies in a window whose words also
start somewhere in a document with a smaller doc_id; windows are judged on the input.

``recompress`` gives each window a symbol that only the window's words decide, so equal windows carry
equal symbols.  Documents are dealt into batches by a hash of doc_id and text, and names into buckets:

1. each batch sends, for each symbol name and span (all its windows with their places) that it holds,
   one row entry with its smallest doc_id - so a passage that a third of all documents share is one entry a batch;
2. each bucket finds the smallest doc_id of each span, and the names that stand for several spans;
3. where a name has several spans, the first holder of each span sends the windows themselves;
   buckets find the smallest doc_id of each window.  This verifies partial overlaps window by window;
4. each batch marks words, and joins what is left by one space.

Entries travel in packed arrays.  The texts are shuffled once and read three times from that shuffle; nothing is
gathered on the driver but the number of bytes.  Comparisons are by 64-bit hashes of whole windows together with the
64-bit symbol name.

Defined results: null and empty texts have no words (n_words 0, kept_text empty).  Rows that share a doc_id do not
remove each other's words.  A null doc_id counts as larger than any other.  Every input row gives one row;
columns other than doc_id and text are returned only if named in ``carry`` (as ``input_<name>`` if a result has that name).
"""

from __future__ import annotations

import math
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from metrolith.llm import common, recompress

WIDTH = 13
#: Bytes of text in a batch and behind a bucket, about.
BATCH_BYTES = 2_000_000
BUCKET_BYTES = 6_000_000

_PARCEL = pa.schema([("dest", pa.int64()), ("batch", pa.int64()), ("bucket", pa.int64()), ("payload", pa.binary())])
_PARCEL_SQL = "dest long, batch long, bucket long, payload binary"


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays of 8-byte entries, or of bytes, as one value; bytes of equal weight lie together, which compresses."""
    out = [struct.pack("<q", len(arrays[0]))]
    for x in arrays:
        out.append(x.astype(np.uint8).tobytes() if x.dtype in (np.uint8, np.bool_) else np.ascontiguousarray(x.view(np.uint8).reshape(-1, 8).T).tobytes())
    return b"".join(out)


def unpack(value: bytes, *kinds: type) -> list[np.ndarray]:
    n, at, out = struct.unpack_from("<q", value)[0], 8, []
    for kind in kinds:
        size = np.dtype(kind).itemsize
        raw = np.frombuffer(value, np.uint8, n * size, at)
        out.append(raw if size == 1 else np.ascontiguousarray(raw.reshape(8, n).T).view(kind).reshape(-1))
        at += n * size
    return out


def parcels(rows: list[tuple[int, int, int, bytes]]) -> pa.Table:
    dest, batch, bucket, payload = zip(*rows) if rows else ((), (), (), ())
    return pa.table([pa.array(dest, pa.int64()), pa.array(batch, pa.int64()), pa.array(bucket, pa.int64()), pa.array(payload, pa.binary())], schema=_PARCEL)


def _groups(sorted_keys: list[np.ndarray]) -> np.ndarray:
    """Where a new combination of sorted keys begins."""
    new = np.zeros(len(sorted_keys[0]), bool)
    new[:1] = True
    for k in sorted_keys:
        new[1:] |= k[1:] != k[:-1]
    return np.flatnonzero(new)


def _runs(sorted_keys: np.ndarray) -> list[tuple[int, int, int]]:
    """(key, begin, end) of each run of equal keys."""
    begin = _groups([sorted_keys])
    return list(zip(sorted_keys[begin].tolist(), begin.tolist(), np.append(begin[1:], len(sorted_keys)).tolist()))


class Batch:
    """The windows of one batch of documents and their classes (symbol name, span)."""

    def __init__(self, table: pa.Table, width: int, buckets: int):
        ids = table.column("doc_id").combine_chunks()
        self.ids = ids.fill_null(common.LAST_ID).to_numpy(zero_copy_only=False).astype(np.int64)
        self.number = table.column("batch")[0].as_py() if table.num_rows else -1
        self.words = common.scan_words(table.column("text"))
        self.windows = w = recompress.windows(self.words.hashes, self.words.offsets, width)
        self.holder = self.ids[w.doc]
        item = w.item  # numbers without gaps
        at = np.empty(int(item.max()) + 1 if len(item) else 0, np.int64)
        at[item[::-1]] = np.arange(len(item))[::-1]
        name, span, holder = w.name[at], w.span[at], self.holder[at]
        bucket = (common.mix(name) % np.uint64(buckets)).astype(np.int64)
        order = np.lexsort((span, name, bucket))
        begin = _groups([bucket[order], name[order], span[order]]) if len(order) else np.empty(0, np.int64)
        size = np.diff(np.append(begin, len(order)))
        rank = np.empty(len(order), np.int64)
        rank[order] = np.repeat(np.arange(len(begin)), size)
        self.of_window = rank[item]
        first = order[begin]
        self.name, self.span, self.bucket = name[first], span[first], bucket[first]
        self.least = np.minimum.reduceat(holder[order], begin) if len(begin) else np.empty(0, np.int64)
        self.several = np.zeros(len(first), bool)

    def requests(self) -> list[tuple[int, int, int, bytes]]:
        """For every bucket the batch has classes in: their names, spans and smallest doc_ids."""
        return [(k, self.number, k, pack(self.name[a:b], self.span[a:b], self.least[a:b])) for k, a, b in _runs(self.bucket)]

    def learn(self, bucket: int, payload: bytes) -> None:
        place, least, several = unpack(payload, np.int64, np.int64, np.uint8)
        at = np.searchsorted(self.bucket, bucket) + place
        self.least[at] = least
        self.several[at] = several.astype(bool)

    def doubtful(self, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Windows that only a comparison window by window can judge: their rows, and distinct keys
        (sorted by bucket) with smallest doc_ids, and each row's key number."""
        rows = np.flatnonzero(self.several[self.of_window] & (self.holder == self.least[self.of_window]))
        key = common.join_hash(self.windows.name[rows], self.windows.content[rows])
        bucket = (key % np.uint64(buckets)).astype(np.int64)
        order = np.lexsort((key, bucket))
        begin = _groups([bucket[order], key[order]]) if len(order) else np.empty(0, np.int64)
        rank = np.empty(len(order), np.int64)
        rank[order] = np.repeat(np.arange(len(begin)), np.diff(np.append(begin, len(order))))
        least = np.minimum.reduceat(self.holder[rows][order], begin) if len(begin) else np.empty(0, np.int64)
        self.key_bucket = bucket[order[begin]]
        return rows, key[order[begin]], least, rank


def answer_classes(table: pa.Table) -> pa.Table:
    """A bucket's answer to requests: entries whose smallest doc_id is in another batch, or whose name has several spans."""
    payloads = [unpack(p.as_py(), np.uint64, np.uint64, np.int64) for p in table.column("payload")]
    batch = np.repeat(table.column("batch").to_numpy(), [len(p[0]) for p in payloads])
    place = np.concatenate([np.arange(len(p[0])) for p in payloads])
    name, span, least = (np.concatenate(x) for x in zip(*payloads))
    order = np.lexsort((batch, span, name))
    name, span, least, batch, place = (x[order] for x in (name, span, least, batch, place))
    begin = _groups([name, span])
    lowest = np.repeat(np.minimum.reduceat(least, begin), np.diff(np.append(begin, len(name))))
    by_name = _groups([name])
    kinds = np.diff(np.append(np.searchsorted(begin, by_name), len(begin)))
    several = np.repeat(kinds > 1, np.diff(np.append(by_name, len(name))))
    return _reply(table, batch, (lowest < least) | several, place, lowest, several)


def answer_windows(table: pa.Table) -> pa.Table:
    payloads = [unpack(p.as_py(), np.uint64, np.int64) for p in table.column("payload")]
    batch = np.repeat(table.column("batch").to_numpy(), [len(p[0]) for p in payloads])
    place = np.concatenate([np.arange(len(p[0])) for p in payloads])
    key, least = (np.concatenate(x) for x in zip(*payloads))
    order = np.lexsort((batch, key))
    key, least, batch, place = (x[order] for x in (key, least, batch, place))
    begin = _groups([key])
    lowest = np.repeat(np.minimum.reduceat(least, begin), np.diff(np.append(begin, len(key))))
    return _reply(table, batch, lowest < least, place, lowest, np.zeros(len(key), bool))


def _reply(table: pa.Table, batch: np.ndarray, keep: np.ndarray, place: np.ndarray, lowest: np.ndarray, several: np.ndarray) -> pa.Table:
    bucket = table.column("bucket")[0].as_py()
    rows = np.flatnonzero(keep)
    rows = rows[np.lexsort((place[rows], batch[rows]))]
    begin = _groups([batch[rows]]) if len(rows) else []
    out = []
    for a, b in zip(begin, np.append(begin[1:], len(rows)) if len(rows) else []):
        part = rows[a:b]
        out.append((int(batch[part[0]]), int(batch[part[0]]), bucket, pack(place[part].astype(np.int64), lowest[part], several[part])))
    return parcels(out)


def kept_texts(words: common.Words, keep: np.ndarray) -> pa.Array:
    """Each text's kept words joined by one space."""
    n_texts = len(words.offsets) - 1
    rows = np.flatnonzero(keep)
    owner = common.owner_of(words.offsets)[rows]
    width = words.ends[rows] - words.starts[rows]
    step = width + 1
    final = np.ones(len(rows), bool)
    final[:-1] = owner[1:] != owner[:-1]
    step[final] -= 1
    end = np.cumsum(step)
    at = end - step
    out = np.full(int(end[-1]) if len(end) else 0, 0x20, np.uint8)
    filled = np.ones(len(out), bool)
    filled[(at + width)[~final]] = False
    out[filled] = words.data[words.is_word][np.repeat(keep, words.ends - words.starts)]
    sizes = np.bincount(owner, weights=step, minlength=n_texts).astype(np.int64) if len(rows) else np.zeros(n_texts, np.int64)
    offsets = np.concatenate(([0], np.cumsum(sizes))).astype(np.int64)
    return pa.Array.from_buffers(pa.large_string(), n_texts, [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(out.tobytes())]).cast(pa.string())


def remove_repeats(spark: SparkSession, docs: DataFrame, *, width: int = WIDTH, carry: tuple[str, ...] = (), keep_layout: bool = False) -> DataFrame:
    """doc_id, n_words, n_removed, kept_text, and the carried columns, for each row of ``docs``.

    With ``keep_layout`` a text that loses no word stays as it is, white space included.
    """
    common.prepare(spark)
    size = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("n")).first()["n"]
    batches = max(1, math.ceil(size / BATCH_BYTES))
    buckets = max(1, math.ceil(size / BUCKET_BYTES))
    kept = [F.col(f"`{c}`").alias(f"carried_{i}") for i, c in enumerate(carry)]
    dealt = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"), *kept)
    dealt = dealt.withColumn("batch", F.pmod(F.xxhash64("doc_id", F.xxhash64("text")), F.lit(batches)))
    spill = 1 << 40  # parcels that a batch sends to itself go to groups of their own

    def ask(table: pa.Table) -> pa.Table:
        out = parcels(Batch(table, width, buckets).requests())
        common.give_back()
        return out

    def taught(table: pa.Table, replies: pa.Table) -> tuple[Batch, list[tuple[int, bytes]], list[tuple[int, bytes]]]:
        """The batch with what it was told of classes; that, and what it was told of windows."""
        batch = Batch(table, width, buckets)
        told: tuple[list, list] = ([], [])
        for k, payload in zip(replies.column("bucket").to_pylist(), replies.column("payload").to_pylist()):
            told[k < 0].append((k, payload))
        for k, payload in told[0]:
            batch.learn(k, payload)
        return batch, *told

    def ask_windows(key, table: pa.Table, replies: pa.Table) -> pa.Table:
        if not table.num_rows:
            return parcels([])
        batch, classes, _ = taught(table, replies)
        _, keys, least, _ = batch.doubtful(buckets)
        rows = [(k, batch.number, -1 - k, pack(keys[a:b], least[a:b])) for k, a, b in _runs(batch.key_bucket)]
        rows += [(spill + batch.number, batch.number, k, p) for k, p in classes]
        del batch, keys, least
        common.give_back()
        return parcels(rows)

    def pass_on(table: pa.Table) -> pa.Table:
        return table.select(_PARCEL.names).cast(_PARCEL) if table.column("dest")[0].as_py() >= spill else answer_windows(table)

    names = ["doc_id", "n_words", "n_removed", "kept_text", *(f"carried_{i}" for i in range(len(carry)))]

    def finish(key, table: pa.Table, replies: pa.Table) -> pa.Table:
        batch, _, told = taught(table, replies)
        w = batch.windows
        gone = batch.holder > batch.least[batch.of_window]
        rows, keys, least, rank = batch.doubtful(buckets)
        for k, payload in told:
            place, low, _ = unpack(payload, np.int64, np.int64, np.uint8)
            least[np.searchsorted(batch.key_bucket, -1 - k) + place] = low
        if len(rows):
            gone[rows] |= least[rank] < batch.holder[rows]
        edge = np.bincount(w.start[gone], minlength=len(batch.words.hashes) + width + 1)
        edge[width:] -= edge[:-width].copy()
        removed = np.cumsum(edge)[: len(batch.words.hashes)] > 0
        total = np.concatenate(([0], np.cumsum(removed)))
        off = batch.words.offsets
        n_removed = total[off[1:]] - total[off[:-1]]
        texts = kept_texts(batch.words, ~removed)
        if keep_layout:
            texts = pc.if_else(pa.array(n_removed == 0), table.column("text").cast(pa.string()), texts)
        columns = [table.column("doc_id"), pa.array(np.diff(off)), pa.array(n_removed), texts]
        del batch, w, gone, rows, keys, least, rank, edge, removed, total, off
        common.give_back()
        return pa.table([*columns, *(table.column(f"carried_{i}") for i in range(len(carry)))], names=names)

    first = dealt.groupBy("batch").applyInArrow(ask, _PARCEL_SQL).groupBy("dest").applyInArrow(answer_classes, _PARCEL_SQL)
    asked = dealt.groupBy("batch").cogroup(first.groupBy("batch")).applyInArrow(ask_windows, _PARCEL_SQL)
    second = asked.groupBy("dest").applyInArrow(pass_on, _PARCEL_SQL)
    schema = T.StructType([T.StructField(n, T.StringType() if n == "kept_text" else T.LongType()) for n in names[:4]])
    for i, c in enumerate(carry):
        schema = schema.add(f"carried_{i}", docs.schema[c].dataType)
    out = dealt.groupBy("batch").cogroup(second.groupBy("batch")).applyInArrow(finish, schema)
    named = ["doc_id", "n_words", "n_removed", "kept_text"]
    return out.select(*named, *(F.col(f"carried_{i}").alias(f"input_{c}" if c in named else c) for i, c in enumerate(carry)))


def oracle_sql(table: str = "documents", width: int = WIDTH) -> str:
    """doc_id, n_words, n_removed and kept_sha256 by plain SQL: every window as a text of its own."""
    return f"""
with texts as (
  select doc_id, row_number() over () as rn, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') as words from {table}
), spans as (
  select doc_id, rn, p, array_to_string(words[p : p + {width - 1}], ' ') as span_text from (select *, unnest(range(1, len(words) - {width - 2})) as p from texts where len(words) >= {width})
), first as (
  select span_text, min(doc_id) as holder from spans group by 1
), gone as (
  select distinct rn, p + k as p from spans join first using (span_text), range({width}) t(k) where holder < doc_id
), each as (
  select rn, unnest(words) as word, unnest(range(1, len(words) + 1)) as p from texts
), kept as (
  select each.rn, count(*) as n_words, count(gone.rn) as n_removed, coalesce(string_agg(word, ' ' order by each.p) filter (where gone.rn is null), '') as kept
  from each left join gone on gone.rn = each.rn and gone.p = each.p group by 1
)
select doc_id, coalesce(n_words, 0) as n_words, coalesce(n_removed, 0) as n_removed, sha256(coalesce(kept, '')) as kept_sha256 from texts left join kept using (rn)
"""
