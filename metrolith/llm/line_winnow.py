"""Line dedup by winnowing over line hashes (operator 8), with DataFrame functions only.

A text is its lines (split at ``\\n``).  A line is deleted if it lies in a passage that also occurs, in this order, at an
earlier place: in a document with a smaller doc_id, or further up in the same one.  A passage is ``run``
consecutive lines or more, or a single line of ``long_bytes`` bytes or more.  Places are judged on the input.

1. Winnowing: every ``run`` consecutive line hashes are a window, and each window selects its least hash (the last of equal ones).
   The selected places are the text's fingerprints, about 2 / (run + 1) of its lines; neighbouring windows
   mostly select the same place.  A repeated passage of ``run`` lines or more therefore has a fingerprint in common with its
   earlier copy.  A long line is a window of its own, so its place is always selected.
2. Places are joined by fingerprint; those whose fingerprint is at one place only are done with.
3. A match is extended both ways: k lines to the left and run - 1 - k to the right of the fingerprint, for each such window
   that selected it, have to equal those of an earlier place.  Windows that do make up the repeated passage, across as many
   fingerprints as it has.
4. Passages at later places are deleted; the earliest place stays.

Groups are counted and searched for their earliest place with map-side aggregation, so a hot line costs a row a task; what is joined
back comes from written tables on both sides, so adaptive execution can split a hot fingerprint.

Defined results: null text stays null with no lines; an empty text is one empty line.  Empty lines count like others.
Rows that share doc_id and text are at the same places: both stay as they are.  A null doc_id is after all others.
All columns of the input stay; ``n_lines`` and ``n_removed`` are added (or take the place of columns of these names).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from metrolith.llm import common

RUN = 3
#: A repeated line of so many bytes goes even if the lines around it differ; shorter ones may be headings or list items.
LONG_BYTES = 32


def select_fingerprints(docs: DataFrame, run: int = RUN, long_bytes: int = LONG_BYTES) -> DataFrame:
    """doc, copy, at, fp, check, is_long, around (the 2 * run - 1 hashes about ``at``, null past the text's ends) of each selected place."""
    split = F.split("text", "\n", -1)
    lines = docs.where("text is not null").select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(common.LAST_ID)).alias("doc"),
        F.xxhash64("text").alias("copy"),
        F.transform(split, lambda x: F.xxhash64(x)).alias("h"),
        F.transform(split, lambda x: F.when(F.octet_length(x) >= long_bytes, F.crc32(x.cast("binary")))).alias("c"),
    )

    def least(i: Column) -> Column:
        """The place that the window from line i on selects."""
        own = [F.get("h", i + F.lit(k)) for k in range(run)]
        low = F.least(*own) if run > 1 else own[0]
        place = F.lit(0)
        for k in range(run):
            place = F.when(own[k] == low, F.lit(k)).otherwise(place)
        return (i + place).cast("int")

    starts = F.when(F.size("h") >= run, F.sequence(F.lit(0), F.size("h") - F.lit(run))).otherwise(F.array().cast("array<int>"))
    long_lines = F.filter(F.transform("c", lambda c, i: F.when(c.isNotNull(), i)), lambda i: i.isNotNull())
    places = F.array_union(F.transform(starts, least), long_lines)

    def row(at: Column) -> Column:
        check = F.get("c", at)
        around = F.array(*(F.get("h", at + F.lit(d)) for d in range(1 - run, run)))
        return F.struct(at.alias("at"), F.get("h", at).alias("fp"), check.alias("check"), check.isNotNull().alias("is_long"), around.alias("around"))

    return lines.select("doc", "copy", F.explode(F.transform(places, row)).alias("f")).select("doc", "copy", "f.*")


def _extended(places: DataFrame, run: int) -> DataFrame:
    """doc, copy, fp, start, n, content: each window around a place that selected it, and each long line."""

    def window(k: int) -> Column:
        own = [F.get("around", F.lit(run - 1 - k + j)) for j in range(run)]
        selects = F.lit(True)
        for j in range(run):
            selects = selects & own[j].isNotNull() & ((F.col("fp") < own[j]) if j > k else (F.col("fp") <= own[j]))
        return F.when(selects, F.struct((F.col("at") - k).cast("int").alias("start"), F.lit(run).alias("n"), F.xxhash64(*own).alias("content")))

    alone = F.when(F.col("is_long"), F.struct(F.col("at").cast("int").alias("start"), F.lit(1).alias("n"), F.col("check").alias("content")))
    found = F.filter(F.array(*(window(k) for k in range(run)), alone), lambda w: w.isNotNull())
    return places.select("doc", "copy", "fp", F.explode(found).alias("w")).select("doc", "copy", "fp", "w.*")


def repeated_windows(spark: SparkSession, docs: DataFrame, run: int = RUN, long_bytes: int = LONG_BYTES) -> DataFrame:
    """doc, copy, spans (start, n): the passages of each text that occur earlier."""

    def written(rows: DataFrame, name: str) -> DataFrame:
        path = common.scratch(spark, name)
        rows.write.parquet(path)
        return spark.read.parquet(path)

    places = written(select_fingerprints(docs, run, long_bytes), "line-fingerprints")
    shared = places.groupBy("fp").agg(F.min(F.struct("doc", "at")).alias("low"), F.max(F.struct("doc", "at")).alias("high"))
    shared = written(shared.where("low < high").select(F.col("fp").alias("shared_fp")), "shared-fingerprints")
    matched = places.join(shared, F.col("fp") == F.col("shared_fp"), "left_semi")
    windows = written(_extended(matched, run), "line-windows")
    first = windows.groupBy("fp", "n", "content").agg(F.min(F.struct("doc", "start")).alias("first"), F.max(F.struct("doc", "start")).alias("last")).where("first < last")
    first = written(first.select(F.col("fp").alias("first_fp"), F.col("n").alias("first_n"), F.col("content").alias("first_content"), "first"), "first-windows")
    later = windows.join(first, (F.col("fp") == F.col("first_fp")) & (F.col("n") == F.col("first_n")) & (F.col("content") == F.col("first_content")))
    later = later.where(F.struct("doc", "start") > F.col("first"))
    return written(later.groupBy("doc", "copy").agg(F.collect_set(F.struct("start", "n")).alias("spans")), "line-marks")


def remove_repeated_lines(spark: SparkSession, docs: DataFrame, *, run: int = RUN, long_bytes: int = LONG_BYTES) -> DataFrame:
    """The rows of ``docs`` with later repeated lines taken out of ``text``, n_lines and n_removed."""
    marks = repeated_windows(spark, docs, run, long_bytes).select(F.col("doc").alias("marked_doc"), F.col("copy").alias("marked_copy"), F.col("spans").alias("marked_spans"))
    kept = [F.col(f"`{c}`") for c in docs.columns if c not in ("text", "n_lines", "n_removed")]
    rows = docs.select(F.struct(*kept).alias("own"), "text", F.coalesce(F.col("doc_id").cast("long"), F.lit(common.LAST_ID)).alias("doc"), F.xxhash64("text").alias("copy"))
    rows = rows.join(marks, (F.col("doc") == F.col("marked_doc")) & (F.col("copy") == F.col("marked_copy")), "left")
    covered = F.array_sort(F.array_distinct(F.flatten(F.transform("marked_spans", lambda s: F.sequence(s["start"], s["start"] + s["n"] - F.lit(1))))))
    rows = rows.select("own", "text", F.split("text", "\n", -1).alias("lines"), covered.alias("gone"))
    # one byte a line, '1' where it goes: built from the gaps between deleted lines, read by place
    steps = F.transform("gone", lambda g, i: F.concat(F.repeat(F.lit("0"), g - F.when(i > 0, F.element_at("gone", F.greatest(i, F.lit(1)))).otherwise(F.lit(-1)) - F.lit(1)), F.lit("1")))
    rows = rows.withColumn("mask", F.array_join(steps, "").cast("binary"))
    left = F.filter("lines", lambda x, i: F.substring(F.col("mask"), i + F.lit(1), F.lit(1)) != F.lit("1").cast("binary"))
    text = F.when(F.col("gone").isNull(), F.col("text")).otherwise(F.array_join(left, "\n"))
    return rows.select(
        "own.*",
        text.alias("text"),
        F.coalesce(F.when(F.col("lines").isNotNull(), F.size("lines")), F.lit(0)).cast("long").alias("n_lines"),
        F.coalesce(F.when(F.col("gone").isNotNull(), F.size("gone")), F.lit(0)).cast("long").alias("n_removed"),
    )


def oracle_sql(table: str = "documents", run: int = RUN, long_bytes: int = LONG_BYTES) -> str:
    """The same by plain SQL: every window and every long line by the lines themselves."""
    parts = ", ".join(f"lead(line, {k}) over (partition by doc_id order by pos) as l{k}" for k in range(1, run))
    names = ", ".join(["line", *(f"l{k}" for k in range(1, run))])
    return f"""
with lines as (
  select doc_id, unnest(string_split(text, chr(10))) as line, unnest(range(len(string_split(text, chr(10))))) as pos from {table}
), led as (
  select doc_id, pos, line, {parts}, count(*) over (partition by doc_id) as total from lines
), ranked as (
  select doc_id, pos, row_number() over (partition by {names} order by doc_id, pos) as place from led where total - pos >= {run}
), alone as (
  select doc_id, pos, row_number() over (partition by line order by doc_id, pos) as place from lines where strlen(line) >= {long_bytes}
), gone as (
  select distinct doc_id, pos + k as pos from ranked, range({run}) t(k) where place > 1
  union select doc_id, pos from alone where place > 1
), joined as (
  select l.doc_id, l.line, l.pos, g.pos is not null as removed from lines l left join gone g on l.doc_id = g.doc_id and l.pos = g.pos
)
select doc_id, coalesce(string_agg(line, chr(10) order by pos) filter (where not removed), '') as text,
  count(*) as n_lines, sum(removed::int)::bigint as n_removed
from joined group by doc_id
"""
