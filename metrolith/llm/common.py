"""What the training-data operators share: column choice, words, word hashes, batches."""

from __future__ import annotations

import ctypes
import time
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from metrolith.session import checkpoint_root, scratch_path, ship_package

#: Rows and bytes of an Arrow batch. Texts may be long, so batches are kept short.
BATCH_ROWS = 1000
BATCH_BYTES = 4_000_000
#: Bytes of text that are worked on at a time; what Python holds besides is some ten times as much.
SLICE_BYTES = 1_500_000
#: Stands for a null doc_id where documents are ordered: after every other.
LAST_ID = 2**63 - 1


def prepare(spark: SparkSession) -> None:
    """Ship the package and bound Arrow batches; call before building a plan with Python in it."""
    ship_package(spark)
    checkpoint_root(spark)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))


#: A new path in the shared folder.
scratch = scratch_path

_trim = getattr(ctypes.CDLL(None), "malloc_trim", None)


_gave_back = time.monotonic()


def give_back() -> None:
    """Return free memory to the system, now and then; a worker that waits for its next task would hold it."""
    global _gave_back
    if time.monotonic() - _gave_back < 2:
        return
    _gave_back = time.monotonic()
    pa.default_memory_pool().release_unused()
    if _trim is not None:
        _trim(0)


def id_and_bytes(docs: DataFrame) -> DataFrame:
    """doc_id as long and text as UTF-8 bytes; every other column is left out, so names can't clash."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))


@dataclass
class Words:
    """The words `[^\\x20\\x09-\\x0D]+` of a batch of texts, as positions in one buffer."""

    data: np.ndarray  # the texts' bytes, one after another
    text_at: np.ndarray  # n+1 byte offsets of the texts
    starts: np.ndarray  # byte offset of each word
    ends: np.ndarray
    offsets: np.ndarray  # n+1 offsets of the texts in the words
    hashes: np.ndarray  # 64-bit hash of each word
    is_word: np.ndarray  # of each byte

    def word(self, i: int) -> bytes:
        return self.data[self.starts[i] : self.ends[i]].tobytes()


def binary_parts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and n+1 offsets of a binary column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null(b"")
    kind = np.int64 if pa.types.is_large_binary(column.type) or pa.types.is_large_string(column.type) else np.int32
    if not len(column):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    held = column.buffers()
    offsets = np.frombuffer(held[1], kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(held[2], np.uint8)[offsets[0] : offsets[-1]] if held[2] is not None else np.empty(0, np.uint8)
    return data, offsets - offsets[0]


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: Of a load of eight bytes, those of a span's last n.
_FIRST_BYTES = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)
#: Odd factors of the two span hashes.
_FACTORS = ((np.uint64(0x9FB21C651E98DF25), np.uint64(0xD6E8FEB86659FD93)), (np.uint64(0xE7037ED1A0B428DB), np.uint64(0xA0761D6478BD642F)))
#: Longer spans are hashed one by one, in one call each.
_LONG_SPAN = 256


def word_bytes(data: np.ndarray) -> np.ndarray:
    """Of each byte whether it is part of a word: all but space and 0x09 to 0x0D."""
    return ~((data == 0x20) | (data - np.uint8(9) <= 4))


def hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, second: bool = False) -> np.ndarray:
    """A 64-bit hash of data[start:end], none empty, eight bytes at a time; ``second`` asks for another, independent one."""
    factor, sizes = _FACTORS[second]
    padded = np.zeros(len(data) + 8, np.uint8)
    padded[: len(data)] = data
    loads = np.ndarray((len(data) + 1,), "<u8", padded, strides=(1,))
    width = ends - starts
    out = width.astype(np.uint64) * sizes
    some, at, left = None, starts, width
    while len(at):
        value = loads[at] & _FIRST_BYTES[np.minimum(left, 8)]
        value ^= out if some is None else out[some]
        value *= factor
        value ^= value >> np.uint64(29)
        if some is None:
            out = value
            some = np.flatnonzero((width > 8) & (width <= _LONG_SPAN))
            at, left = starts[some] + 8, width[some] - 8
        else:
            out[some] = value
            more = left > 8
            some, at, left = some[more], at[more] + 8, left[more] - 8
    for i in np.flatnonzero(width > _LONG_SPAN):
        out[i] = xxhash.xxh64_intdigest(data[starts[i] : ends[i]].tobytes(), int(factor))
    return mix(out)


def scan_words(column: pa.Array, hashed: bool = True, lower: bool = False) -> Words:
    """lower: A-Z as a-z; hashed: with the words' hashes."""
    data, at = binary_parts(column)
    if lower:
        data = _LOWER[data]
    is_word = word_bytes(data)
    begin, finish = is_word.copy(), is_word.copy()
    if len(data):
        begin[1:] &= ~is_word[:-1]
        finish[:-1] &= ~is_word[1:]
        heads = at[:-1][at[:-1] < at[1:]]
        begin[heads] = is_word[heads]
        tails = at[1:][at[:-1] < at[1:]] - 1
        finish[tails] = is_word[tails]
    starts, ends = np.flatnonzero(begin), np.flatnonzero(finish) + 1
    return Words(data, at, starts, ends, np.searchsorted(starts, at), hash_spans(data, starts, ends) if hashed else np.empty(0, np.uint64), is_word)


def slices(column: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``most`` bytes, or one row."""
    _, at = binary_parts(column)
    a = 0
    while a < len(at) - 1:
        b = max(a + 1, int(np.searchsorted(at, at[a] + most, "right")) - 1)
        yield a, b
        a = b


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of MurmurHash3 for 64 bits, a bijection."""
    x = x ^ (x >> np.uint64(33))
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


def join_hash(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A hash of ordered pairs of hashes."""
    right = mix(b + np.uint64(0x2545F4914F6CDD1D))
    right += a * np.uint64(0x9E3779B97F4A7C15)
    return mix(right)


def window_hash(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of every k consecutive entries (n-k+1 of them), by doubling."""
    n = len(hashes)
    if n < k:
        return np.empty(0, np.uint64)
    out, width, total = None, 1, 0
    power = hashes
    todo = k
    while todo:
        if todo & 1:
            out = power.copy() if out is None else join_hash(out[: n - total - width + 1], power[total : n - width + 1])
            total += width
            out = out[: n - total + 1]
        todo >>= 1
        if todo:
            power = join_hash(power[: n - 2 * width + 1], power[width : n - width + 1])
            width *= 2
    return out


def owner_of(offsets: np.ndarray) -> np.ndarray:
    """For each entry the number of its text."""
    return np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
