"""Cleaning and compiling of schedules: stop times, patterns, first-in-first-out splits, lookups."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from metrolith.session import ship_package


def first_by(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """The first row of each key by an input ordinal (map-side aggregation, no window)."""
    others = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.min_by(F.struct(*others), F.col(order)).alias("_row")).select(*keys, *[F.col(f"_row.{c}").alias(c) for c in others])


def last_by(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    others = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.max_by(F.struct(*others), F.col(order)).alias("_row")).select(*keys, *[F.col(f"_row.{c}").alias(c) for c in others])


def known_only(df: DataFrame, column: str, known: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Rows whose column is a known key, and the others (dropped rows are counted, never lost silently)."""
    keys = known.select(F.col(key).alias("_known")).distinct()
    return df.join(keys, F.col(column) == F.col("_known"), "left_semi"), df.join(keys, F.col(column) == F.col("_known"), "left_anti")


def clean_times(events: DataFrame) -> DataFrame:
    """Stop events with repaired times: midnight unwrapped, gaps interpolated, order made monotone.

    events: trip, pos, arrival, departure (seconds or null).  Added: times of a trip never go back.
    A time more than twelve hours before the one before it is on the next day, and so is all that follows.
    Missing times lie evenly by position between the last known departure and the next known arrival.
    """
    trip = Window.partitionBy("trip")
    filled = events.withColumn("a", F.coalesce("arrival", "departure")).withColumn("d", F.coalesce("departure", "arrival"))
    order = trip.orderBy("pos")
    upto = order.rowsBetween(Window.unboundedPreceding, -1)
    before = F.last("d", ignorenulls=True).over(upto)
    jump_a = F.when(F.col("a") + 43_200 < before, 1).otherwise(0)
    jump_d = F.when(F.col("d") + 43_200 < F.col("a"), 1).otherwise(0)
    marked = filled.withColumn("_ja", jump_a).withColumn("_jd", jump_d)
    through = order.rowsBetween(Window.unboundedPreceding, 0)
    days_a = F.sum(F.col("_ja")).over(through) + F.coalesce(F.sum("_jd").over(upto), F.lit(0))
    days_d = F.sum(F.col("_ja") + F.col("_jd")).over(through)
    plain = marked.withColumn("a", F.col("a") + 86_400 * days_a).withColumn("d", F.col("d") + 86_400 * days_d).drop("_ja", "_jd")
    after = order.rowsBetween(1, Window.unboundedFollowing)
    known = F.col("a").isNotNull()
    low, high = F.last("d", ignorenulls=True).over(upto), F.first("a", ignorenulls=True).over(after)
    low_pos = F.last(F.when(known, F.col("pos")), ignorenulls=True).over(upto)
    high_pos = F.first(F.when(known, F.col("pos")), ignorenulls=True).over(after)
    ranked = plain.withColumn("_low", low).withColumn("_high", high).withColumn("_lp", low_pos).withColumn("_hp", high_pos)
    between = F.col("_low") + F.floor((F.col("_high") - F.col("_low")) * (F.col("pos") - F.col("_lp")) / (F.col("_hp") - F.col("_lp"))).cast("bigint")
    guessed = ranked.withColumn("a", F.when(known, F.col("a")).otherwise(between)).withColumn("d", F.when(known, F.col("d")).otherwise(between)).drop("_low", "_high", "_lp", "_hp")
    # never earlier than anything before it in the trip
    floor_a = F.greatest(F.max(F.greatest("a", "d")).over(upto), F.col("a"))
    level = guessed.withColumn("_a", floor_a).withColumn("_d", F.greatest(F.col("_a"), F.col("d")))
    repaired = (F.col("_a") > F.col("a")) | (F.col("_d") > F.col("d"))
    return level.select(*[c for c in events.columns if c not in ("arrival", "departure")], F.col("_a").alias("arrival"), F.col("_d").alias("departure"), repaired.alias("repaired"))


def trip_drop_reason(events: DataFrame) -> DataFrame:
    """(trip, reason): fewer than two calls, no first departure or no last arrival; null for trips that stay."""
    ends = events.groupBy("trip").agg(F.count("*").alias("calls"), F.min_by(F.coalesce("departure", "arrival"), "pos").alias("first"), F.max_by(F.coalesce("arrival", "departure"), "pos").alias("last"))
    return ends.select("trip", F.when(F.col("calls") < 2, "few_calls").when(F.col("first").isNull() | F.col("last").isNull(), "no_end_time").alias("reason"))


def pass_through_stops(events: DataFrame) -> DataFrame:
    """Stops at which every call neither picks up nor drops off."""
    return events.groupBy("stop").agg(F.bool_and((F.col("pickup") == 1) & (F.col("drop_off") == 1)).alias("none")).where("none").select("stop")


def with_ancestors(called: DataFrame, parents: DataFrame, levels: int = 8) -> DataFrame:
    """Called stops and what they belong to, up to ``levels`` steps up."""
    kept = called.select("stop").distinct()
    front = kept
    for _ in range(levels):
        front = front.join(parents, "stop").where("parent is not null").select(F.col("parent").alias("stop")).distinct()
        kept = kept.unionByName(front)
    return kept.distinct()


def base_patterns(events: DataFrame, trips: DataFrame) -> DataFrame:
    """(trip, pattern): trips with one slot, route and list of (stop, flags) share a pattern."""
    lists = events.groupBy("trip").agg(F.sort_array(F.collect_list(F.struct("pos", "stop", "flags"))).alias("_calls"))
    calls = F.transform("_calls", lambda c: F.concat_ws(":", c["stop"], c["flags"]))
    joined = lists.join(trips, "trip").select("trip", F.concat_ws("|", "slot", "route", F.array_join(calls, ",")).alias("_key"))
    named = joined.groupBy("_key").agg(F.min("trip").alias("pattern"))
    return joined.join(named, "_key").select("trip", "pattern")


def fifo_split(trips: list[tuple], shares) -> list[int]:
    """Sub-pattern of each trip: greedy first fit, so that trips that run on a common day never overtake.

    trips: (name, service class, times), times being the alternating arrivals and departures; the order
    is by first departure, then every later arrival and departure, then name.
    """
    order = sorted(range(len(trips)), key=lambda i: (trips[i][2][1], trips[i][2][2:], trips[i][0]))
    subs: list[dict] = []
    out = [0] * len(trips)
    for i in order:
        _, own, times = trips[i]
        for number, latest in enumerate(subs):
            if all(not shares(other, own) or all(x >= y for x, y in zip(times, last)) for other, last in latest.items()):
                break
        else:
            number, latest = len(subs), {}
            subs.append(latest)
        latest[own] = times
        out[i] = number
    return out


def fifo_patterns(events: DataFrame, patterns: DataFrame, service: DataFrame) -> DataFrame:
    """(trip, pattern, sub) after the first-in-first-out split of every base pattern.

    service: trip, days (sorted array of the days it runs).  Trips of equal days form one class.  The greedy order
    makes this a step for each pattern; a pattern's trips of one timetable are a bounded group.
    """
    ship_package(events.sparkSession)
    times = events.groupBy("trip").agg(F.sort_array(F.collect_list(F.struct("pos", "arrival", "departure"))).alias("_t"))
    flat = F.flatten(F.transform("_t", lambda c: F.array(c["arrival"], c["departure"])))
    rows = patterns.join(times.select("trip", flat.alias("times")), "trip").join(service, "trip")
    grouped = rows.groupBy("pattern").agg(F.collect_list(F.struct("trip", "days", "times")).alias("trips"))

    def split(members) -> list[int]:
        classes = {d: frozenset(d) for d in {tuple(m["days"]) for m in members}}
        memory: dict = {}

        def shares(a, b) -> bool:
            if (a, b) not in memory:
                memory[a, b] = memory[b, a] = a == b or not classes[a].isdisjoint(classes[b])
            return memory[a, b]

        return fifo_split([(m["trip"], tuple(m["days"]), tuple(m["times"])) for m in members], shares)

    def run(batches):
        for frame in batches:
            subs = [split(members) if len(members) > 1 else [0] for members in frame["trips"]]
            yield pd.DataFrame({
                "trip": [m["trip"] for members in frame["trips"] for m in members],
                "pattern": np.repeat(frame["pattern"].to_numpy(), [len(x) for x in subs]),
                "sub": np.concatenate(subs) if subs else np.empty(0, int),
            })

    kind = dict(patterns.dtypes)
    return grouped.mapInPandas(run, f"trip {kind['trip']}, pattern {kind['pattern']}, sub int")


def overtaking(first: Column, second: Column) -> Column:
    """Whether the second list of times falls behind the first one anywhere (not dominated)."""
    return ~F.forall(F.zip_with(first, second, lambda a, b: b >= a), lambda x: x)


def merge_stops(stops: DataFrame, calls: DataFrame) -> DataFrame:
    """One row a stop id of several feeds, with the attributes of the feed that calls there most (ties: the earlier feed)."""
    counts = calls.groupBy("feed", "stop").agg(F.count("*").alias("_n"))
    joined = stops.join(counts, ["feed", "stop"], "left")
    others = [c for c in stops.columns if c != "stop"]
    best = joined.groupBy("stop").agg(F.max_by(F.struct(*others), F.struct(F.coalesce("_n", F.lit(0)), -F.col("feed"))).alias("_row"))
    return best.select("stop", *[F.col(f"_row.{c}").alias(c) for c in others])


def common_shape(trips: DataFrame) -> DataFrame:
    """(pattern, shape): the commonest shape of its trips, ties to the first seen."""
    counts = trips.where("shape is not null").groupBy("pattern", "shape").agg(F.count("*").alias("n"), F.min("ord").alias("seen"))
    return counts.groupBy("pattern").agg(F.max_by("shape", F.struct("n", -F.col("seen"))).alias("shape"))


def calls_at(events: DataFrame, stops: DataFrame, station: Column) -> DataFrame:
    """Calls at a station and its platforms, by departure, arrival, trip."""
    own = stops.where((F.col("stop") == station) | (F.col("parent") == station)).select("stop")
    return events.join(F.broadcast(own), "stop").orderBy("departure", "arrival", "trip")


def incidence(pattern_stops: DataFrame) -> DataFrame:
    """For each stop the patterns and positions that serve it, as a sorted list and a count."""
    return pattern_stops.groupBy("stop").agg(F.count_distinct("pattern").alias("patterns"), F.count("*").alias("places"))


def ordinal_ids(rows: DataFrame, parent: str, order: list[str], tag: str = "-E") -> DataFrame:
    """Children named after their parent and their place by ``order``."""
    nth = F.row_number().over(Window.partitionBy(parent).orderBy(*order))
    return rows.withColumn("id", F.concat(F.col(parent).cast("string"), F.lit(tag), nth.cast("string")))


def services_on_days(trips: DataFrame, rule_days: DataFrame) -> DataFrame:
    """Trips and stop events by covered day.  Trips are counted by rule first, so the join is rules by days, not trips by days."""
    by_rule = trips.groupBy("rule").agg(F.count("*").alias("trips"), F.sum("calls").alias("calls"))
    return rule_days.join(by_rule, "rule").groupBy("day").agg(F.sum("trips").alias("trips"), F.sum("calls").alias("calls"))


def stop_vertices(stops: list[tuple[float, float]], line: list[tuple[float, float]], close: float = 60.0, leave: float = 250.0) -> list[int]:
    """A vertex of the line for each stop, never going back: the nearest ahead, until the line has come
    close and then left again."""
    out, at = [], 0
    for x, y in stops:
        best, least = at, float("inf")
        for i in range(at, len(line)):
            d = ((line[i][0] - x) ** 2 + (line[i][1] - y) ** 2) ** 0.5
            if d < least:
                best, least = i, d
            elif least <= close and d > least + leave:
                break
        out.append(best)
        at = best
    return out if line else [0] * len(stops)


def match_shape(stops: list, line: list, retry: float = 100.0, give_up: float = 250.0) -> tuple[list[int] | None, bool, float]:
    """(vertices, reversed, worst distance); the reversed line is tried when the worst is over ``retry``, none over ``give_up``."""

    def worst(places, points):
        return max((((points[i][0] - x) ** 2 + (points[i][1] - y) ** 2) ** 0.5 for i, (x, y) in zip(places, stops)), default=0.0)

    if not line:
        return None, False, float("inf")
    found = stop_vertices(stops, line)
    gap, back = worst(found, line), False
    if gap > retry:
        other = stop_vertices(stops, line[::-1])
        if worst(other, line[::-1]) < gap:
            found, gap, back = other, worst(other, line[::-1]), True
    return (None if gap > give_up else found), back, gap


def match_shapes(pattern_stops: DataFrame, shape_points: DataFrame, shape_of: DataFrame) -> DataFrame:
    """(pattern, vertices, reversed, worst) of each pattern on its shape; points are planar x, y in metres."""
    ship_package(pattern_stops.sparkSession)
    stops = pattern_stops.groupBy("pattern").agg(F.sort_array(F.collect_list(F.struct("pos", "x", "y"))).alias("stops"))
    lines = shape_points.groupBy("shape").agg(F.sort_array(F.collect_list(F.struct("seq", "x", "y"))).alias("line"))
    rows = shape_of.join(stops, "pattern").join(lines, "shape")

    def run(batches):
        for frame in batches:
            out = [match_shape([(p["x"], p["y"]) for p in s], [(p["x"], p["y"]) for p in line]) for s, line in zip(frame["stops"], frame["line"])]
            yield pd.DataFrame({"pattern": frame["pattern"], "vertices": [o[0] for o in out], "reversed": [o[1] for o in out], "worst": [o[2] for o in out]})

    return rows.mapInPandas(run, f"pattern {dict(shape_of.dtypes)['pattern']}, vertices array<int>, reversed boolean, worst double")


def subsequence(short: Column, long: Column) -> Column:
    """Whether the first array occurs in the second in order, gaps allowed."""
    reached = F.aggregate(long, F.lit(0), lambda at, x: at + F.when((at < F.size(short)) & (F.element_at(short, F.least(at + 1, F.size(short))) == x), 1).otherwise(0))
    return reached == F.size(short)


def borrowed_shapes(patterns: DataFrame) -> DataFrame:
    """(pattern, lender): for patterns without a shape the shortest pattern of their route that has one and calls
    at all their stops in order.  patterns: pattern, route, stops (array), has_shape."""
    need = patterns.where(~F.col("has_shape")).select("pattern", "route", "stops")
    lend = patterns.where("has_shape").select(F.col("pattern").alias("lender"), "route", F.col("stops").alias("all_stops"))
    fits = need.join(lend, "route").where(subsequence(F.col("stops"), F.col("all_stops")))
    return fits.groupBy("pattern").agg(F.min_by("lender", F.struct(F.size("all_stops"), F.col("lender"))).alias("lender"))
