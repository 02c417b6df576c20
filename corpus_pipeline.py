"""Cleaning of ``documents`` for training, in five stages, each on all that its predecessor kept.

1. quality rules: documents that the base rules or the n-gram ratio reject go;
2. line dedup: lines repeated from earlier documents are taken out, documents left without a line go;
3. near-dedup: of each group of near copies (five-word shingles, similarity 0.8 and up) the smallest doc_id stays;
4. substring dedup: 13-word windows that an earlier document has are taken out, documents left without a word go;
5. packing: the tokens of what is left are packed into sequences.

Stages 1 to 4 return the columns of ``documents``, whatever their names; n_chars is kept true to the text.

Defined results: an empty table gives an empty one.  Quality rules reject null, empty and very short texts (too few
words); the other stages let a null or empty text stay as it is, near-dedup one of all without a word.  Rows may share a doc_id:
they do not remove each other's words, and each is judged by its own text; of rows that are equal in doc_id and text one stays.  A null doc_id
counts as larger than any other.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from metrolith.llm import common, line_winnow, ngram_llr, packing, substring_dedup, vp_simhash
from metrolith.session import drop_scratch, scratch_mark

#: Near copies: five trees over two-word fingerprints find pairs, five-word shingles at 0.8 confirm them.
NEAR = {"shingle": 2, "radius": 3, "tables": 5, "check": vp_simhash.Check(shingle=5, similarity=0.8)}


def _held(docs: DataFrame) -> DataFrame:
    """doc_id, text and all other columns in one, so that no name of theirs meets one of an operator's."""
    return docs.select("doc_id", "text", F.struct(*(F.col(f"`{c}`") for c in docs.columns if c != "text")).alias("document"))


def _restored(found: DataFrame, columns: list[str]) -> DataFrame:
    """The documents' columns, with n_chars of the present text where there is such a column."""
    present = {"text": F.col("text"), "n_chars": F.length("text").cast("long")}
    return found.select(*(present.get(c, F.col("document").getField(c)).alias(c) for c in columns))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    trusted = spark.read.parquet(f"{sf_dir}/labels.parquet").where(F.col("quality") == 1)
    return ngram_llr.keep_good(spark, docs, trusted)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = line_winnow.remove_repeated_lines(spark, _held(docs))
    return _restored(found.where((F.col("n_removed") == 0) | (F.col("n_removed") < F.col("n_lines"))), docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return vp_simhash.one_of_each(spark, docs, **NEAR)


def substring_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = substring_dedup.remove_repeats(spark, _held(docs), carry=("document",), keep_layout=True)
    found = found.where((F.col("n_removed") == 0) | (F.col("n_removed") < F.col("n_words")))
    return _restored(found.withColumnRenamed("kept_text", "text"), docs.columns)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.best_fit(spark, packing.token_lengths(spark, docs))


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("substring_dedup", substring_stage),
    ("best_fit_packing", best_fit_packing),
]

#: No SQL: the n-gram ratio, fingerprints and greedy packing are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written as Parquet in the shared folder and read again.

    What a stage wrote on its way goes when its result is there, and that result when the next one is.
    """
    docs, mark = spark.read.parquet(f"{sf_dir}/documents.parquet"), scratch_mark()
    for name, stage in STAGES[:-1]:
        path = common.scratch(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        drop_scratch(spark, mark, path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
