"""Trip ends as a stream: the same counts as in batch, kept up to date as monthly files arrive.

Counting is by quarter hour, not by event-time windows with a watermark: a late row belongs to its day however
late its file is, so nothing may be dropped.  State is one row a key, day, bin, bike and direction.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from metrolith.sources.mobility import TRIP_COLUMNS, TRIP_NAMES, trip_ends


def read_trip_stream(spark: SparkSession, path: str, files_per_trigger: int = 64) -> DataFrame:
    """Trip rows of CSV files as they arrive in a folder."""
    schema = ", ".join(f"{c} string" for c in [*TRIP_COLUMNS, *TRIP_NAMES])
    return spark.readStream.schema(schema).option("header", True).option("escape", '"').option("enforceSchema", False).option("maxFilesPerTrigger", files_per_trigger).csv(path)


def count_stream(trips: DataFrame) -> DataFrame:
    """Counts by id, day, bin, bike and direction, in update or complete mode."""
    ends = trip_ends(trips).where("bike is not null and day is not null and id <> ''")
    return ends.groupBy("id", "day", "bin", "bike", "direction").agg(F.count("*").alias("n"))


def windowed_ends(ends: DataFrame, time: str = "ts", lateness: str = "2 days", width: str = "15 minutes") -> DataFrame:
    """Counts by tumbling window for live monitoring, where rows later than ``lateness`` may be left out."""
    return ends.withWatermark(time, lateness).groupBy(F.window(time, width), "direction").agg(F.count("*").alias("n"))


def start_incremental(trips: DataFrame, target: str, checkpoint: str) -> StreamingQuery:
    """Process what has arrived and stop; each batch's counts are added as a part of its own, so a batch that is
    repeated after a failure replaces its own part and nothing counts twice.  ``read_counts`` sums the parts."""

    def store(batch: DataFrame, number: int) -> None:
        count_stream(batch).write.mode("overwrite").parquet(f"{target}/batch={number}")

    return trips.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def read_counts(spark: SparkSession, target: str) -> DataFrame:
    parts = spark.read.parquet(target)
    return parts.groupBy("id", "day", "bin", "bike", "direction").agg(F.sum("n").alias("n"))
