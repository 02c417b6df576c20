"""A canonical order: rows numbered by sorted keys, without gathering them in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from metrolith.session import scratch_path

#: Rows of a few numbers that may go to every task.
MOST_SENT = 1_000_000


def sent(rows: DataFrame) -> DataFrame:
    """``rows`` to be sent to all tasks if they are few (counted), so that a join that makes many rows of them needs no shuffle."""
    return F.broadcast(rows) if rows.count() <= MOST_SENT else rows


def spread(rows: DataFrame, *by: str) -> DataFrame:
    """``rows`` dealt over all tasks: few rows of which a join makes many would else be put in one."""
    return rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), *by)


def numbered(rows: DataFrame, order: list[Column], name: str) -> DataFrame:
    """``rows`` with their place (from 0) in a total order: ranges are sorted apart, and moved on by the sizes of those before.

    The sorted ranges are written in the shared folder, so the places hold whenever they are read.
    """
    path = scratch_path(rows.sparkSession, "ordered")
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_range", F.spark_partition_id())
    within = Window.partitionBy("_range").orderBy(*order)
    ranged.withColumn("_nth", F.row_number().over(within) - 1).write.parquet(path)
    found = rows.sparkSession.read.parquet(path)
    sizes = found.groupBy("_range").agg(F.count("*").alias("_n"))  # a row a range
    before = sizes.withColumn("_base", F.coalesce(F.sum("_n").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("_n")
    return found.join(F.broadcast(before), "_range").withColumn(name, (F.col("_base") + F.col("_nth")).cast("bigint")).drop("_range", "_nth", "_base")
