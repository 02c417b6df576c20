"""Quality rules: base rules, then a hashed n-gram log-likelihood ratio (operator 10).

Word unigrams and bigrams are hashed into a fixed number of buckets.  Two multinomials are
counted over them: one over every document (raw), one over the trusted documents (target).
A document's score is the mean, over its n-grams, of log p_target - log p_raw; it is kept when
that mean reaches ``threshold``.  Counts are integers summed exactly, so scores do not depend on
how rows are dealt to tasks.

Trusted documents: all of ``labels.quality = 1``, joined by their ids (sent to every task up to a counted
number of them, else by a shuffle; the counts are the same).  The raw counts cover all
documents.  Without trusted documents every ratio is zero, so the base rules decide.

Defined results: a null or empty text, or one without a word, has zero counts and fails the base
rules (fewer than ``min_words``).  Each input row gives one row; repeated rows and null doc_ids
are kept as they are.  Columns other than doc_id and text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from metrolith.llm import common

BUCKETS = 1 << 14
THRESHOLD = -0.07
#: Trusted ids are broadcast only up to this number (8 bytes each).
BROADCAST_IDS = 1_000_000
MIN_WORDS = 10
REPEAT_PERCENT = 20
SYMBOLS = b"#*$%&|<>"
_IS_SYMBOL = np.zeros(256, bool)
_IS_SYMBOL[list(SYMBOLS)] = True
#: Continuation bytes of UTF-8; without them, bytes count code points.
_CONTINUES = np.zeros(256, bool)
_CONTINUES[0x80:0xC0] = True

SCHEMA = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, kept boolean, n_grams long, llr double"
)


def repeated_words(hashes: np.ndarray, offsets: np.ndarray, width: int = 5) -> np.ndarray:
    """Per text: words in windows of ``width`` words that occur twice or more in that text."""
    n_texts = len(offsets) - 1
    windows = common.window_hash(hashes, width)
    if not len(windows):
        return np.zeros(n_texts, np.int64)
    owner = common.owner_of(offsets)
    starts = np.flatnonzero(owner[: len(windows)] == owner[width - 1 :])
    keys = common.join_hash(owner[starts].astype(np.uint64), windows[starts])
    _, inverse, counts = np.unique(keys, return_inverse=True, return_counts=True)
    again = starts[counts[inverse] >= 2]
    inside = np.zeros(len(hashes), bool)
    for k in range(width):
        inside[again + k] = True
    covered = np.concatenate(([0], np.cumsum(inside)))
    return covered[offsets[1:]] - covered[offsets[:-1]]


def duplicate_lines(text: bytes) -> int:
    lines = [line for line in text.split(b"\n") if line.strip()]
    return len(lines) - len(set(lines))


def grams(hashes: np.ndarray, offsets: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket and text number of every unigram, then of every bigram inside a text."""
    owner = common.owner_of(offsets)
    mask = np.uint64(buckets - 1)
    pairs = common.window_hash(hashes, 2)
    inside = np.flatnonzero(owner[: len(pairs)] == owner[1:]) if len(pairs) else np.empty(0, np.int64)
    bucket = np.concatenate((common.mix(hashes) & mask, pairs[inside] & mask)).astype(np.int64)
    return bucket, np.concatenate((owner, owner[inside]))


def ratio_table(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """log p_target - log p_raw by bucket; the target is smoothed towards the raw multinomial."""
    if not target.sum():
        return np.zeros(len(raw))
    p_raw = (raw + 1.0) / (raw.sum() + len(raw))
    weight = 4.0 * len(raw)
    p_target = (target + weight * p_raw) / (target.sum() + weight)
    return np.log(p_target) - np.log(p_raw)


def score_texts(column: pa.Array, table: np.ndarray, threshold: float) -> dict[str, np.ndarray]:
    """All output columns but doc_id for a column of texts."""
    w = common.scan_words(column)
    n, offsets = len(column), w.offsets
    n_words = np.diff(offsets)
    bucket, owner = grams(w.hashes, offsets, len(table))
    n_grams = np.bincount(owner, minlength=n)
    total = np.bincount(owner, weights=table[bucket], minlength=n)
    llr = total / np.maximum(n_grams, 1)
    repeats = repeated_words(w.hashes, offsets)
    failed = (n_words < MIN_WORDS) | (100 * repeats > REPEAT_PERCENT * n_words)
    return {
        "n_words": n_words,
        "word_chars": by_text(w.is_word & ~_CONTINUES[w.data], w.text_at),
        "n_symbols": by_text(_IS_SYMBOL[w.data], w.text_at),
        "n_dup_lines": np.array([duplicate_lines(t or b"") for t in column.to_pylist()], np.int64),
        "n_repeat_words": repeats,
        "base_failed": failed,
        "kept": ~failed & (llr >= threshold),
        "n_grams": n_grams.astype(np.int64),
        "llr": llr,
    }


def by_text(flags: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The number of set flags in each text."""
    total = np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))
    return total[at[1:]] - total[at[:-1]]


def count_grams(docs: DataFrame, trusted: DataFrame, buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray]:
    """Raw and target counts by bucket: two arrays of ``buckets`` integers, whatever the input's size."""
    ids = trusted.select(F.col("doc_id").cast("long").alias("trusted_id")).where("trusted_id is not null").distinct()
    # counted first: so many ids are sent to every task, more are joined by a shuffle
    ids = F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids
    rows = common.id_and_bytes(docs).join(ids, F.col("doc_id") == F.col("trusted_id"), "left")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw, target = np.zeros(buckets, np.int64), np.zeros(buckets, np.int64)
        for batch in batches:
            good = batch.column(1).to_numpy(zero_copy_only=False)
            for a, b in common.slices(batch.column(0)):
                w = common.scan_words(batch.column(0)[a:b])
                bucket, owner = grams(w.hashes, w.offsets, buckets)
                raw += np.bincount(bucket, minlength=buckets)
                target += np.bincount(bucket[good[a:b][owner]], minlength=buckets)
        seen = np.flatnonzero(raw)
        common.give_back()
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(raw[seen]), pa.array(target[seen])], ["bucket", "raw", "target"])

    part = rows.select("text", F.col("trusted_id").isNotNull().alias("good")).mapInArrow(count, "bucket long, raw long, target long")
    raw, target = np.zeros(buckets, np.int64), np.zeros(buckets, np.int64)
    for row in part.groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")).collect():
        raw[row["bucket"]], target[row["bucket"]] = row["raw"], row["target"]
    return raw, target


def quality_rules(
    spark: SparkSession,
    docs: DataFrame,
    trusted: DataFrame,
    *,
    buckets: int = BUCKETS,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """One row of SCHEMA for each row of ``docs`` (doc_id, text); ``trusted`` has the doc_ids of trusted texts."""
    common.prepare(spark)
    table = ratio_table(*count_grams(docs, trusted, buckets))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [x.split()[0] for x in SCHEMA.split(", ")]
        for batch in batches:
            for a, b in common.slices(batch.column(1)):
                found = score_texts(batch.column(1)[a:b], table, threshold)
                yield pa.RecordBatch.from_arrays([batch.column(0)[a:b], *(pa.array(found[n]) for n in names[1:])], names)
        common.give_back()

    return common.id_and_bytes(docs).mapInArrow(score, SCHEMA)


def keep_good(spark: SparkSession, docs: DataFrame, trusted: DataFrame, **options) -> DataFrame:
    """The rows of ``docs``, all columns, whose text is kept by ``quality_rules``."""
    common.prepare(spark)
    threshold = options.pop("threshold", THRESHOLD)
    table = ratio_table(*count_grams(docs, trusted, **options))
    place = docs.columns.index("text")

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in common.slices(batch.column(place)):
                part = batch.slice(a, b - a)
                texts = part.column(place).cast(pa.binary())
                yield part.filter(pa.array(score_texts(texts, table, threshold)["kept"]))
        common.give_back()

    return docs.mapInArrow(keep, docs.schema)
