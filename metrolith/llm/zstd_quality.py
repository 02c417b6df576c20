"""Quality classifier by compression (operator 9).

Two zstandard dictionaries are built, one from good and one from bad labelled texts.  Every whole
text is cut into blocks of ``BLOCK`` bytes; each block is compressed with either dictionary, alone.
The feature is (bytes with the bad dictionary - bytes with the good one) / (sum of both), over
all blocks of the text; its calibration is a logistic curve in that feature and the text's
own compression ratio, fitted on labelled texts that the dictionaries have not seen.

Labels are learned from rows with crc32(doc_id as text) mod 4 != 2 only, at most ``FIT_ROWS`` of each label
(those with the smallest xxhash64 of doc_id), ``FIT_BYTES`` of text in all for each label and use: a
documented bound on the fit.  The labels themselves are all counted, and the curve's constant is moved from the
odds in the sample to the odds among all of them, so scores stay probabilities whatever share the sample is.
Scores are made for every document from its text alone.

Defined results: a null or empty text gets the score of the feature's zero point; one row for each
input row, repeated rows and null doc_ids (held_out false) included.  Without both labels in the fit all scores
are the share of good labels (0.5 without any).  A doc_id with both labels says nothing and is left out of the
fit.  Columns other than doc_id, text and quality are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from metrolith.llm import common

FIT_ROWS = 3_000
FIT_BYTES = 6_000_000
DICT_BYTES = 112_640
BLOCK = 2_048
LEVEL = 1
CUT = 0.7
SCHEMA = "doc_id long, held_out boolean, score double, predicted int, size_good long, size_bad long"


def held_out(doc_id: int | None) -> bool:
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 4 == 2


@dataclass
class Model:
    good: bytes
    bad: bytes
    weights: tuple[float, ...]
    block: int = BLOCK

    def scorer(self) -> "Scorer":
        return Scorer(self)


class Scorer:
    """The model's compressors; one for each task, as they hold native state."""

    def __init__(self, model: Model):
        self.model = model
        self.tools = [zstandard.ZstdCompressor(level=LEVEL, write_content_size=False, write_dict_id=False, dict_data=_prepared(d)) for d in (model.good, model.bad)] if model.good and model.bad else []

    def sizes(self, text: bytes) -> tuple[int, int]:
        if not self.tools:
            return 0, 0
        good, bad = (t.compress for t in self.tools)
        blocks = [text[i : i + self.model.block] for i in range(0, len(text), self.model.block)]
        return sum(len(good(b)) for b in blocks), sum(len(bad(b)) for b in blocks)

    def score(self, text: bytes | None) -> tuple[float, int, int]:
        g, b = self.sizes(text or b"")
        z = float(np.dot(features(len(text or b""), g, b), self.model.weights))
        return 1.0 / (1.0 + np.exp(-np.clip(z, -40, 40))), g, b


def _prepared(raw: bytes) -> zstandard.ZstdCompressionDict:
    made = zstandard.ZstdCompressionDict(raw)
    made.precompute_compress(level=LEVEL)
    return made


def features(size: int, good: int, bad: int) -> np.ndarray:
    """1, the normalised difference, and the compression ratio (0 for an empty text)."""
    if not size or not good + bad:
        return np.array([1.0, 0.0, 0.0])
    return np.array([1.0, 20.0 * (bad - good) / (bad + good), 2.0 * min(good, bad) / size - 1.0])


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> tuple[float, ...]:
    """Newton's method for a ridge-penalised logistic curve."""
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -40, 40)))
        grad = x.T @ (p - y) + ridge * w
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w)), grad)
        w -= step
        if np.abs(step).max() < 1e-10:
            break
    return tuple(float(v) for v in w)


def dictionary(texts: list[bytes], size: int = DICT_BYTES) -> bytes:
    """A dictionary from blocks of the texts; raw content if there is too little to train on."""
    blocks = [t[i : i + BLOCK] for t in texts for i in range(0, len(t), BLOCK)]
    blocks = [b for b in blocks if len(b) >= 8]
    try:
        return zstandard.train_dictionary(size, blocks, level=LEVEL, threads=0).as_bytes()
    except zstandard.ZstdError:
        return b"\n".join(blocks)[-size:]


def fit(rows: list[tuple[int, bytes, int]], counts: tuple[int, int] | None = None) -> Model:
    """Fit on (doc_id, text, quality): even places build dictionaries, odd ones calibrate.

    ``counts`` are the numbers of all bad and good labels that the rows are a sample of.
    """
    rows = sorted((r for r in rows if r[1]), key=lambda r: (zlib.crc32(b"%d" % r[0]), r[0]))
    sides = {q: [r[1] for r in rows if r[2] == q] for q in (0, 1)}
    if not all(len(s) >= 2 for s in sides.values()):
        seen = counts if counts and sum(counts) else (len(sides[0]), len(sides[1]))
        share = seen[1] / sum(seen) if sum(seen) else 0.5
        share = min(max(share, 0.01), 0.99)
        return Model(b"", b"", (float(np.log(share / (1 - share))), 0.0, 0.0))
    good, bad = (dictionary(sides[q][::2]) for q in (1, 0))
    scorer = Scorer(Model(good, bad, (0.0, 0.0, 0.0)))
    x, y = [], []
    for q in (0, 1):
        for text in sides[q][1::2]:
            x.append(features(len(text), *scorer.sizes(text)))
            y.append(q)
    weights = logistic(np.array(x), np.array(y, float))
    if counts and all(counts):
        weights = (weights[0] + float(np.log(counts[1] / counts[0]) - np.log(sum(y) / (len(y) - sum(y)))), *weights[1:])
    return Model(good, bad, weights)


def fit_rows(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS, size: int = FIT_BYTES) -> tuple[list[tuple[int, bytes, int]], tuple[int, int]]:
    """The bounded sample that the classifier is fitted on, and the numbers of all bad and good labels."""
    asked = labels.select(F.col("doc_id").cast("long").alias("label_id"), F.col("quality").cast("int").alias("quality"))
    asked = asked.where("label_id is not null and quality in (0, 1) and crc32(cast(label_id as string)) % 4 <> 2")
    asked = asked.groupBy("label_id").agg(F.min("quality").alias("quality"), F.max("quality").alias("other")).where("quality = other").drop("other")
    n = asked.agg(F.count_if(F.col("quality") == 0).alias("bad"), F.count_if(F.col("quality") == 1).alias("good")).first()
    picked = None
    for q in (0, 1):
        part = asked.where(F.col("quality") == q).orderBy(F.xxhash64("label_id"), "label_id").limit(rows)
        picked = part if picked is None else picked.unionByName(part)
    found = common.id_and_bytes(docs).join(F.broadcast(picked), F.col("doc_id") == F.col("label_id"))
    found = found.select("doc_id", F.xxhash64("text").alias("copy"), "text", "quality", F.octet_length("text").alias("size")).where("size > 0")
    # a label whose doc_id is reused holds for each of its texts; at most as many short rows as there are picked labels
    order = found.groupBy("doc_id", "quality").agg(F.min(F.struct("copy", "size")).alias("one")).orderBy(F.xxhash64("doc_id"), "doc_id")
    kept, total = {}, {0: 0, 1: 0}
    for r in order.collect():
        if total[r["quality"]] + r["one"]["size"] <= 2 * size:
            total[r["quality"]] += r["one"]["size"]
            kept[r["doc_id"]] = r["one"]["copy"]
    if not kept:
        return [], (n["bad"], n["good"])
    chosen = F.col("doc_id").isin(list(kept)) & F.col("copy").isin(list(kept.values()))
    texts = found.where(chosen).groupBy("doc_id", "copy", "quality").agg(F.first("text").alias("text"))
    return [(r["doc_id"], bytes(r["text"]), r["quality"]) for r in texts.collect() if kept[r["doc_id"]] == r["copy"]], (n["bad"], n["good"])


def quality_scores(spark: SparkSession, docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row of SCHEMA for each row of ``docs`` (doc_id, text), with labels (doc_id, quality)."""
    common.prepare(spark)
    model = fit(*fit_rows(docs, labels))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = model.scorer()
        for batch in batches:
            ids = batch.column(0).to_pylist()
            found = [scorer.score(t) for t in batch.column(1).to_pylist()]
            p = [x[0] for x in found]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([held_out(i) for i in ids], pa.bool_()), pa.array(p, pa.float64()), pa.array([int(v >= CUT) for v in p], pa.int32()), pa.array([x[1] for x in found], pa.int64()), pa.array([x[2] for x in found], pa.int64())],
                [x.split()[0] for x in SCHEMA.split(", ")],
            )

    return common.id_and_bytes(docs).mapInArrow(score, SCHEMA)
