"""Data-quality gates: each gives rows that say what was checked and what failed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def trip_count_gate(current: DataFrame, previous: DataFrame, holidays: DataFrame, most_percent: int = 25, accepted: tuple[str, ...] = (), floor_percent: int = 90) -> DataFrame:
    """(system, day, trips, reference, basis, status) for each day of the new build.

    The reference is the previous build's same day; else, on a holiday, the nearest of its medians for that
    weekday, Saturday and Sunday; else its median for the weekday.  Holidays do not enter medians.  A zero reference never fails.
    """
    off = holidays.select(F.col("day").alias("_off")).distinct()
    usual = previous.join(off, F.col("day") == F.col("_off"), "left_anti").withColumn("weekday", F.weekday("day"))
    medians = usual.groupBy("system", "weekday").agg(F.median("trips").alias("usual"))
    same = previous.select("system", "day", F.col("trips").alias("same"))
    base = current.join(same, ["system", "day"], "left").join(off, F.col("day") == F.col("_off"), "left").withColumn("weekday", F.weekday("day"))
    by_day = medians.select("system", "weekday", F.col("usual").alias("own"))
    # on holidays the three profiles compete; a medians table has at most seven rows a system
    profiles = base.where("_off is not null").select("system", "day", "trips", F.explode(F.array_distinct(F.array(F.col("weekday"), F.lit(5), F.lit(6)))).alias("weekday"))
    nearest = profiles.join(medians, ["system", "weekday"]).groupBy("system", "day").agg(F.min(F.struct(F.abs(F.col("trips") - F.col("usual")), "usual")).alias("near"))
    nearest = nearest.select("system", "day", F.col("near.usual").alias("profile"))
    joined = base.join(by_day, ["system", "weekday"], "left").join(nearest, ["system", "day"], "left")
    holiday = F.col("_off").isNotNull()
    reference = F.coalesce(F.col("same").cast("double"), F.when(holiday, F.col("profile")).otherwise(F.col("own")))
    basis = F.when(F.col("same").isNotNull(), "same day").when(holiday & F.col("profile").isNotNull(), "holiday profile").when(~holiday & F.col("own").isNotNull(), "weekday median").otherwise("none")
    judged = joined.select("system", "day", "trips", reference.alias("reference"), basis.alias("basis"))
    change = (F.col("trips") - F.col("reference")) * 100
    beyond = (F.col("reference") > 0) & (F.abs(change) > F.col("reference") * most_percent)
    taken = F.col("system").isin(*accepted) if accepted else F.lit(False)
    status = (
        F.when(F.col("basis") == "none", "no reference")
        .when(~beyond, "ok")
        .when(taken & (-change <= F.col("reference") * floor_percent), "accepted")
        .otherwise("failed")
    )
    return judged.withColumn("status", status)


def coverage_gate(days: DataFrame, least: int) -> DataFrame:
    """days: key columns and ``days`` ahead; soft failure under ``least``."""
    return days.withColumn("status", F.when(F.col("days") >= least, "ok").otherwise("soft failure"))


def kept_share_gate(lengths: DataFrame, least_percent: int) -> DataFrame:
    """(region, total, kept, status) from rows region, length, kept (boolean)."""
    sums = lengths.groupBy("region").agg(F.sum("length").alias("total"), F.sum(F.when(F.col("kept"), F.col("length")).otherwise(0)).alias("kept"))
    return sums.withColumn("status", F.when(F.col("kept") * 100 >= F.col("total") * least_percent, "ok").otherwise("failed"))


def snapping_gate(snaps: DataFrame, allowed: DataFrame, most: int) -> DataFrame:
    """(stop, mm, status): no snap or one beyond ``most`` fails, unless the stop is allowed, up to its own limit; allow-list
    entries that nothing needed are stale."""
    own = allowed.select(F.col("stop").alias("_stop"), F.col("most").alias("_most"))
    joined = snaps.join(own, F.col("stop") == F.col("_stop"), "left")
    bad = F.col("mm").isNull() | (F.col("mm") > most)
    fits = F.col("_stop").isNotNull() & (F.col("_most").isNull() | (F.coalesce(F.col("mm"), F.lit(0)) <= F.col("_most")))
    judged = joined.select("stop", "mm", F.when(~bad, "ok").when(fits, "allowed").otherwise("failed").alias("status"))
    needed = judged.where("status = 'allowed'").select(F.col("stop").alias("_needed"))
    stale = own.join(needed, F.col("_stop") == F.col("_needed"), "left_anti").select(F.col("_stop").alias("stop"), F.lit(None).cast("bigint").alias("mm"), F.lit("stale").alias("status"))
    return judged.unionByName(stale)


def missing_references(rows: DataFrame, column: str, known: DataFrame, key: str) -> DataFrame:
    """Rows that refer to nothing (null references are none)."""
    return rows.where(F.col(column).isNotNull()).join(known.select(F.col(key).alias("_known")), F.col(column) == F.col("_known"), "left_anti")


def lineage_breaks(built: DataFrame, present: DataFrame) -> DataFrame:
    """(artifact, input, sha): inputs that an artifact was built against and that the set does not hold with that hash."""
    return built.join(present.select(F.col("artifact").alias("input"), "sha"), ["input", "sha"], "left_anti").select("artifact", "input", "sha")


def artifact_gate(artifacts: DataFrame, required: list[tuple[str, int]]) -> DataFrame:
    """(kind, status): each required kind is there once, opens, and has the format that is asked for."""
    wanted = artifacts.sparkSession.createDataFrame(required, "kind string, wanted int")
    found = artifacts.groupBy("kind").agg(F.count("*").alias("n"), F.bool_and("opens").alias("opens"), F.max("format").alias("format"))
    status = F.when(F.col("n").isNull(), "missing").when(F.col("n") > 1, "repeated").when(~F.col("opens"), "unreadable").when(F.col("format") != F.col("wanted"), "wrong format").otherwise("ok")
    return wanted.join(found, "kind", "left").select("kind", status.alias("status"))


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def not_ascending(df: DataFrame, keys: list[str], order: str, value: str) -> DataFrame:
    """Rows whose value is not above the one before."""
    before = F.lag(value).over(Window.partitionBy(*keys).orderBy(order))
    return df.withColumn("before", before).where(F.col(value) <= F.col("before"))


def incomplete_pairs(members: DataFrame, pairs: DataFrame) -> DataFrame:
    """(low, high, problem): unordered pairs of groups in use without an entry, or with several, or entries of unused groups.

    Groups are zones: some dozens, so all pairs of them are few.
    """
    used = members.select("zone").distinct()
    wanted = used.select(F.col("zone").alias("low")).join(used.select(F.col("zone").alias("high")), F.col("low") <= F.col("high"))
    have = pairs.select(F.least("a", "b").alias("low"), F.greatest("a", "b").alias("high")).groupBy("low", "high").agg(F.count("*").alias("n"))
    missing = wanted.join(have, ["low", "high"], "left_anti").select("low", "high", F.lit("missing").alias("problem"))
    known = have.join(wanted, ["low", "high"], "left_semi")
    return missing.unionByName(known.where("n > 1").select("low", "high", F.lit("repeated").alias("problem"))).unionByName(have.join(wanted, ["low", "high"], "left_anti").select("low", "high", F.lit("unused").alias("problem")))


def conflicting_pairs(first: DataFrame, second: DataFrame) -> DataFrame:
    """Unordered pairs that stand in both lists, and pairs of one with itself."""
    norm = lambda df: df.select(F.least("a", "b").alias("low"), F.greatest("a", "b").alias("high"))
    both = norm(first).intersect(norm(second)).withColumn("problem", F.lit("in both"))
    own = norm(first).unionByName(norm(second)).where("low = high").distinct().withColumn("problem", F.lit("self"))
    return both.unionByName(own)


def overlapping_windows(windows: DataFrame, key: str) -> DataFrame:
    """(key, a, b): windows of one key that overlap on a shared weekday.  windows: key, id, weekdays (bits), start, end.

    Sorted by start and compared with those still open: a join inside a key, whose windows are few.
    """
    a = windows.select(key, F.col("id").alias("a"), F.col("weekdays").alias("wa"), F.col("start").alias("sa"), F.col("end").alias("ea"))
    b = windows.select(key, F.col("id").alias("b"), F.col("weekdays").alias("wb"), F.col("start").alias("sb"), F.col("end").alias("eb"))
    return a.join(b, key).where((F.col("a") < F.col("b")) & (F.col("sa") < F.col("eb")) & (F.col("sb") < F.col("ea")) & (F.col("wa").bitwiseAND(F.col("wb")) != 0)).select(key, "a", "b")


def one_way_only(links: DataFrame) -> DataFrame:
    """Links that are not there in the other direction with the same value."""
    return links.select("a", "b", "value").exceptAll(links.select(F.col("b").alias("a"), F.col("a").alias("b"), "value"))


def carry_forward(local: DataFrame, previous: DataFrame, kind: str = "kind") -> DataFrame:
    """Local artifacts, and the previous ones of kinds that are not local, marked as carried."""
    kept = previous.join(local.select(kind).distinct(), kind, "left_anti")
    return local.withColumn("carried", F.lit(False)).unionByName(kept.withColumn("carried", F.lit(True)))


def set_id(artifacts: DataFrame) -> DataFrame:
    """One row: the SHA-256 over names and hashes of a set's artifacts in name order (a set has some dozens)."""
    rows = artifacts.agg(F.sort_array(F.collect_list(F.concat_ws("=", "name", "sha"))).alias("all"))
    return rows.select(F.sha2(F.array_join("all", "\n"), 256).alias("set_id"))


def swept(objects: DataFrame, manifests: DataFrame, keep_last: int, always: Column | None = None) -> DataFrame:
    """(name, action): objects that no kept manifest names are deleted.  manifests: set_ord, name - the newest sets are kept."""
    newest = manifests.select("set_ord").distinct().orderBy(F.desc("set_ord")).limit(keep_last)
    used = manifests.join(F.broadcast(newest), "set_ord").select("name").distinct().withColumn("_used", F.lit(True))
    joined = objects.join(used, "name", "left")
    keep = F.coalesce("_used", F.lit(False)) | (always if always is not None else F.lit(False))
    return joined.select("name", F.when(keep, "keep").otherwise("delete").alias("action"))


def rollback_plan(manifests: DataFrame, blobs: DataFrame, set_id: str, current_at: Column, now: Column) -> DataFrame:
    """(name, status, generated_at): what putting an older set back finds for each of its artifacts, under a new time.

    manifests: set_id, generated_at, name, sha, bytes - the newest manifest of the set counts; blobs: sha, bytes.  Status: ok,
    missing, wrong size, or too early where the new time is not after the current set's.
    """
    own = manifests.where(F.col("set_id") == set_id)
    newest = own.agg(F.max("generated_at").alias("_at"))
    rows = own.join(F.broadcast(newest), F.col("generated_at") == F.col("_at"))  # one row
    held = blobs.select(F.col("sha").alias("_sha"), F.col("bytes").alias("_bytes"))
    status = F.when(now <= current_at, "too early").when(F.col("_bytes").isNull(), "missing").when(F.col("_bytes") != F.col("bytes"), "wrong size").otherwise("ok")
    return rows.join(held, F.col("sha") == F.col("_sha"), "left").select("name", status.alias("status"), now.alias("generated_at"))


def reference_check(rows: DataFrame, column: str, known: DataFrame | None, key: str, check: str) -> DataFrame:
    """One row (check, checked, errors, status) of a reference check; skipped where what it refers to was carried forward."""
    if known is None:
        return rows.agg(F.lit(check).alias("check"), F.lit(0).cast("bigint").alias("checked"), F.lit(0).cast("bigint").alias("errors"), F.lit("skipped").alias("status"))
    wrong = missing_references(rows, column, known, key).agg(F.count("*").alias("errors"))
    total = rows.agg(F.count(column).alias("checked"))
    status = F.when(F.col("errors") > 0, "failed").otherwise("ok")
    return total.crossJoin(F.broadcast(wrong)).select(F.lit(check).alias("check"), "checked", "errors", status.alias("status"))  # one row each


def vouched(artifacts: DataFrame, reports: DataFrame, previous: DataFrame) -> DataFrame:
    """(name, status): an artifact is checked if a built report has its hash, skipped if the previous set holds the same one, else failed.

    artifacts: name, sha; reports: name, sha, outcome, passed; previous: name, sha.
    """
    told = reports.select(F.col("name").alias("_r"), F.col("sha").alias("_rsha"), "outcome", "passed")
    old = previous.select(F.col("name").alias("_p"), F.col("sha").alias("_psha"))
    both = artifacts.join(told, F.col("name") == F.col("_r"), "left").join(old, F.col("name") == F.col("_p"), "left")
    own = F.coalesce((F.col("outcome") == "built") & (F.col("_rsha") == F.col("sha")), F.lit(False))
    same = F.coalesce(F.col("_psha") == F.col("sha"), F.lit(False))
    return both.select("name", F.when(own & F.col("passed"), "ok").when(own, "failed").when(same, "skipped").otherwise("failed").alias("status"))


# invariants of what is built: rows that break a rule


def broken_offsets(offsets: DataFrame, total: DataFrame) -> DataFrame:
    """(section, place, rule): offsets of a section begin at 0, never fall, and end at its number of entries.

    offsets: section, place (from 0), value; total: section, entries.
    """
    before = F.lag("value").over(Window.partitionBy("section").orderBy("place"))
    falls = offsets.withColumn("_b", before).where(F.col("value") < F.col("_b")).select("section", "place", F.lit("falls").alias("rule"))
    starts = offsets.where("place = 0 and value <> 0").select("section", "place", F.lit("does not begin at 0").alias("rule"))
    last = offsets.groupBy("section").agg(F.max(F.struct("place", "value")).alias("l")).select("section", "l.place", "l.value")
    ends = last.join(total, "section").where("value <> entries").select("section", "place", F.lit("does not end at its entries").alias("rule"))
    return starts.unionByName(falls).unionByName(ends)


def broken_edges(edges: DataFrame, segments: DataFrame) -> DataFrame:
    """(edge, rule): an edge may be used by some mode, and its segment joins its own ends in the stated direction.

    edges: edge, src, dst, segment, reversed, walk, ride; segments: segment, a, b.
    """
    useless = edges.where(~(F.col("walk") | F.col("ride"))).select("edge", F.lit("no mode").alias("rule"))
    held = segments.select(F.col("segment").alias("_s"), "a", "b")
    joined = edges.join(held, F.col("segment") == F.col("_s"), "left")
    start, end = F.when(F.col("reversed"), F.col("b")).otherwise(F.col("a")), F.when(F.col("reversed"), F.col("a")).otherwise(F.col("b"))
    rule = F.when(F.col("_s").isNull(), "no segment").when((start != F.col("src")) | (end != F.col("dst")), "other ends")
    return useless.unionByName(joined.select("edge", rule.alias("rule")).where("rule is not null"))


def broken_hops(hops: DataFrame, rail: DataFrame) -> DataFrame:
    """(origin, dest, rule): hops lead between different rail stops, once a pair, with a bound, pickups and docks without repeats.

    hops: origin, dest, min_decameters, min_walk, pickups, docks (arrays, nulls only at the end); rail: stop.
    """
    stops = rail.select("stop").distinct()
    pair = ["origin", "dest"]
    found = hops.where("origin = dest").select(*pair, F.lit("to itself").alias("rule"))
    for end in pair:
        found = found.unionByName(hops.join(stops, F.col(end) == F.col("stop"), "left_anti").select(*pair, F.lit(f"{end} is no rail stop").alias("rule")))
    found = found.unionByName(hops.groupBy(*pair).agg(F.count("*").alias("n")).where("n > 1").select(*pair, F.lit("repeated").alias("rule")))
    found = found.unionByName(hops.where("min_decameters is null or min_walk is null").select(*pair, F.lit("no bound").alias("rule")))
    for name in ("pickups", "docks"):
        used = F.filter(name, lambda x: x.isNotNull())
        rule = F.when(F.size(used) == 0, f"no {name}").when(F.exists(F.slice(name, F.lit(1), F.size(used)), lambda x: x.isNull()), f"gap in {name}").when(F.size(F.array_distinct(used)) < F.size(used), f"repeat in {name}")
        found = found.unionByName(hops.select(*pair, rule.alias("rule")).where("rule is not null"))
    return found


def broken_patterns(patterns: DataFrame, stops: DataFrame, trips: DataFrame) -> DataFrame:
    """(pattern, rule): a pattern has two stops and a trip at least, all of its trips as many times as it has stops.

    patterns: pattern; stops: pattern, pos; trips: trip, pattern, calls.
    """
    n_stops = stops.groupBy("pattern").agg(F.count("*").alias("n_stops"))
    of_trips = trips.groupBy("pattern").agg(F.min("calls").alias("low"), F.max("calls").alias("high"))
    joined = patterns.join(n_stops, "pattern", "left").join(of_trips, "pattern", "left")
    rule = F.when(F.coalesce("n_stops", F.lit(0)) < 2, "fewer than two stops").when(F.col("low").isNull(), "no trip").when((F.col("low") != F.col("n_stops")) | (F.col("high") != F.col("n_stops")), "a trip of another length")
    return joined.select("pattern", rule.alias("rule")).where("rule is not null")


#: Steps of a build and what they need; a failed step stops those that need it, the others go on.
STEPS = {"streets": (), "timetables": (), "stations": ("streets",), "config": (), "links": ("streets", "timetables", "stations", "config"), "flows": (), "gate": ("streets", "timetables", "stations", "config", "links", "flows"), "manifest": ("gate",), "heartbeat": ()}


def run_plan(failed: set[str], steps: dict[str, tuple[str, ...]] = STEPS) -> dict[str, str]:
    """Step -> ok, failed or skipped."""
    out: dict[str, str] = {}
    for step, needs in steps.items():
        out[step] = "skipped" if any(out.get(n) != "ok" for n in needs) else "failed" if step in failed else "ok"
    return out
