"""What is kept of fetched sources: the outcome of a fetch, and the archive of feed versions, as tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def fetch_outcomes(cached: DataFrame, answers: DataFrame) -> DataFrame:
    """(url, outcome, etag, sha256): what a build uses of each source after a conditional fetch.

    cached: url, etag, sha256; answers: url, status (null: no answer), etag, sha256, valid.  A 304 keeps what is cached; a
    valid 200 replaces it; anything else falls back to a stale copy, if there is one.
    """
    old = cached.select(F.col("url").alias("_url"), F.col("etag").alias("_etag"), F.col("sha256").alias("_sha"))
    both = answers.join(old, F.col("url") == F.col("_url"), "full").withColumn("_have", F.col("_url").isNotNull())
    fresh = F.coalesce((F.col("status") == 200) & F.col("valid"), F.lit(False))
    outcome = F.when(fresh, "new").when((F.col("status") == 304) & F.col("_have"), "unchanged").when(F.col("_have"), "stale").otherwise("missing")
    use = lambda new, kept: F.when(fresh, F.col(new)).otherwise(F.col(kept))
    return both.select(F.coalesce("url", "_url").alias("url"), outcome.alias("outcome"), use("etag", "_etag").alias("etag"), use("sha256", "_sha").alias("sha256"))


def archive_key(feed, published, sha256):
    return F.concat_ws("/", feed, F.date_format(published, "yyyyMMdd"), F.substring(sha256, 1, 16))


def add_versions(archive: DataFrame, incoming: DataFrame) -> DataFrame:
    """(feed, key, sha256, published, first, last, added): the archive with every content that it did not have.

    incoming: feed, sha256, published, first, last.  A content is kept once a feed, under the earliest day it was published.
    """
    held = archive.select("feed", "sha256").distinct()
    new = incoming.groupBy("feed", "sha256").agg(F.min(F.struct("published", "first", "last")).alias("v"))
    new = new.join(held, ["feed", "sha256"], "left_anti").select("feed", archive_key(F.col("feed"), F.col("v.published"), F.col("sha256")).alias("key"), "sha256", "v.published", "v.first", "v.last", F.lit(True).alias("added"))
    return archive.select("feed", "key", "sha256", "published", "first", "last", F.lit(False).alias("added")).unionByName(new)


def expired_versions(archive: DataFrame, today, keep_days: int) -> DataFrame:
    """(feed, key) of versions whose last day is long gone; the newest version of a feed always stays."""
    newest = archive.groupBy("feed").agg(F.max(F.struct("published", "key")).alias("_top")).select("feed", F.col("_top.key").alias("_newest"))
    old = archive.join(newest, "feed").where((F.col("last") < F.date_sub(today, keep_days)) & (F.col("key") != F.col("_newest")))
    return old.select("feed", "key")
