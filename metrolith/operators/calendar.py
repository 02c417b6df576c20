"""Service calendars, source versions and day coverage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def rule_days(rules: DataFrame, exceptions: DataFrame) -> DataFrame:
    """(rule, day) on which a rule is active.

    rules: rule, mask (bit 0 Monday; null: no weekly calendar), first, last (dates).
    exceptions: rule, day, kind (1 added, 2 removed); an exception outranks the calendar, the last one given wins upstream.
    Weekly ranges are expanded to days, so the override is an equi-join and not a range join.
    """
    span = rules.where("mask is not null and first <= last").select("rule", "mask", F.explode(F.sequence("first", "last", F.expr("interval 1 day"))).alias("day"))
    weekly = span.where(F.col("mask").bitwiseAND(F.pow(F.lit(2), F.weekday("day")).cast("int")) != 0).select("rule", "day")
    removed = exceptions.where("kind = 2").select("rule", "day")
    added = exceptions.where("kind = 1").select("rule", "day")
    return weekly.join(removed, ["rule", "day"], "left_anti").unionByName(added).distinct()


def select_sources(sources: DataFrame) -> DataFrame:
    """(slot, day, source): for each slot and day the covering source with the least priority, then the newest.

    sources: source, slot, priority, published, ord, first, last.  Versions never merge on one day.
    """
    days = sources.select("slot", "source", "priority", "published", "ord", F.explode(F.sequence("first", "last", F.expr("interval 1 day"))).alias("day"))
    # an argmin by aggregation: one row a slot and day leaves each task
    best = days.groupBy("slot", "day").agg(F.min_by("source", F.struct(F.col("priority"), -F.unix_micros(F.col("published").cast("timestamp")), F.col("ord"))).alias("source"))
    return best


def merge_intervals(df: DataFrame, keys: list[str], first: str = "first", last: str = "last") -> DataFrame:
    """Overlapping or adjacent day intervals as one (gaps and islands)."""
    order = Window.partitionBy(*keys).orderBy(first, last)
    before = F.max(last).over(order.rowsBetween(Window.unboundedPreceding, -1))
    opened = F.when(before.isNull() | (F.col(first) > F.date_add(before, 1)), 1).otherwise(0)
    marked = df.withColumn("_new", opened)
    numbered = marked.withColumn("_island", F.sum("_new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return numbered.groupBy(*keys, "_island").agg(F.min(first).alias(first), F.max(last).alias(last)).drop("_island")


def common_days(slot_days: DataFrame, slot: str = "slot", day: str = "day") -> DataFrame:
    """Days that every slot covers: the intersection over slots of the union over sources."""
    slots = slot_days.select(slot).distinct().agg(F.count("*").alias("_slots"))
    return slot_days.groupBy(day).agg(F.count_distinct(slot).alias("_have")).crossJoin(F.broadcast(slots)).where("_have = _slots").select(day)


def consecutive_days(days: DataFrame, keys: list[str], today: Column, day: str = "day") -> DataFrame:
    """How many covered days follow one another from ``today`` on (0 if today is not covered)."""
    order = Window.partitionBy(*keys).orderBy(day)
    ahead = days.where(F.col(day) >= today).select(*keys, day).distinct()
    run = ahead.withColumn("_n", F.row_number().over(order)).where(F.datediff(day, today) == F.col("_n") - 1)
    return days.select(*keys).distinct().join(run.groupBy(*keys).agg(F.count("*").alias("days")), keys, "left").select(*keys, F.coalesce("days", F.lit(0)).cast("bigint").alias("days"))


def reference_day(rule_sets: DataFrame, today: Column, weeks: int = 5) -> DataFrame:
    """(slot, weekday, day): of the last ``weeks`` covered days before ``today`` of a weekday, the latest with the commonest rule set.

    rule_sets: slot, day, rules (sorted array of the active rules).
    """
    own = rule_sets.where(F.col("day") < today).withColumn("weekday", F.weekday("day"))
    recent = own.withColumn("_n", F.row_number().over(Window.partitionBy("slot", "weekday").orderBy(F.desc("day")))).where(F.col("_n") <= weeks)
    sets = recent.groupBy("slot", "weekday", "rules").agg(F.count("*").alias("n"), F.max("day").alias("day"))
    return sets.groupBy("slot", "weekday").agg(F.max(F.struct("n", "day")).alias("best")).select("slot", "weekday", F.col("best.day").alias("day"))


def extrapolated(rules: DataFrame, references: DataFrame, active: DataFrame, day: Column, grace: int = 14) -> DataFrame:
    """Rules taken to run on ``day``: on the reference day of its weekday, with a calendar that ended at most ``grace`` days before."""
    wanted = references.where(F.col("weekday") == F.weekday(day)).select("slot", F.col("day").alias("ref"))
    ran = active.join(wanted, active["day"] == wanted["ref"]).select("rule", "slot")
    return rules.where(F.col("mask").isNotNull() & (day <= F.date_add("last", grace))).join(ran, "rule").select("slot", "rule")


def useful_versions(sources: DataFrame, first: Column, last: Column) -> DataFrame:
    """Sources that are selected on some day of the horizon."""
    inside = sources.withColumn("first", F.greatest("first", first)).withColumn("last", F.least("last", last)).where("first <= last")
    return select_sources(inside).select("slot", "source").distinct()


def first_service_day(days: DataFrame, holidays: DataFrame, day: str = "day") -> DataFrame:
    """The first covered Tuesday to Thursday that is no holiday, else weekday that is none, else any day."""
    marked = days.select(day).distinct().join(holidays.select(F.col("day").alias("_holiday")), F.col(day) == F.col("_holiday"), "left")
    kind = F.when(F.col("_holiday").isNull() & F.weekday(day).between(1, 3), 0).when(F.col("_holiday").isNull() & (F.weekday(day) < 5), 1).otherwise(2)
    return marked.agg(F.min(F.struct(kind.alias("rank"), F.col(day).alias("day"))).alias("best")).select(F.col("best.day").alias("day"), F.col("best.rank").alias("rank"))


def months_to_build(files: DataFrame, systems: list[str], count: int) -> DataFrame:
    """(month, missing): the newest month that all systems have and those before it; missing if a system has none."""
    have = files.groupBy("month").agg(F.count_distinct("system").alias("n"))
    newest = have.where(F.col("n") == len(systems)).agg(F.max("month").alias("newest"))
    serial = F.floor(F.col("newest") / 100) * 12 + F.col("newest") % 100 - 1
    wanted = newest.where("newest is not null").select(F.explode(F.sequence(serial - (count - 1), serial)).alias("s")).select((F.floor(F.col("s") / 12) * 100 + F.col("s") % 12 + 1).cast("int").alias("month"))
    return wanted.join(have, "month", "left").select("month", (F.coalesce("n", F.lit(0)) < len(systems)).alias("missing"))


def clip(rules: DataFrame, start: Column, days: int = 800) -> DataFrame:
    """Rules inside a window that begins at ``start`` and has at most ``days`` days; those without a day in it go."""
    last = F.date_add(start, days - 1)
    return rules.withColumn("first", F.greatest("first", start)).withColumn("last", F.least("last", last)).where("first <= last")
