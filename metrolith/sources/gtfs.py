"""GTFS feeds as typed DataFrames; rows that are dropped are counted by reason in ``issues``."""

from __future__ import annotations

import io
import zipfile
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from metrolith.functions import fields
from metrolith.operators.timetable import first_by, known_only, last_by
from metrolith.session import scratch_path, ship_package
from metrolith.sources.csv import CsvError, frames, read_exact_csv, records

WEEK = ("monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday")
REQUIRED = ("agency", "routes", "stops", "trips", "stop_times")

#: file -> (required columns, optional columns)
LAYOUT: dict[str, tuple[list[str], list[str]]] = {
    "agency": (["agency_name", "agency_timezone"], ["agency_id"]),
    "feed_info": ([], ["feed_version", "feed_start_date", "feed_end_date"]),
    "routes": (["route_id"], ["agency_id", "route_short_name", "route_long_name", "route_desc", "route_type", "route_color", "route_text_color"]),
    "stops": (["stop_id"], ["stop_name", "stop_code", "stop_lat", "stop_lon", "location_type", "parent_station"]),
    "calendar": (["service_id", *WEEK, "start_date", "end_date"], []),
    "calendar_dates": (["service_id", "date", "exception_type"], []),
    "trips": (["route_id", "trip_id", "service_id"], ["trip_headsign", "trip_short_name", "direction_id", "shape_id", "peak_offpeak"]),
    "stop_times": (["trip_id", "stop_id", "stop_sequence"], ["arrival_time", "departure_time", "pickup_type", "drop_off_type"]),
    "shapes": (["shape_id", "shape_pt_lat", "shape_pt_lon", "shape_pt_sequence"], []),
    "transfers": (["from_stop_id", "to_stop_id"], ["transfer_type", "min_transfer_time", "from_trip_id", "to_trip_id"]),
    "frequencies": (["trip_id"], []),
}


def read_zip(spark: SparkSession, path: str, file: str, required: list[str], optional: list[str]) -> DataFrame:
    """One table of zipped feeds, below any folder of the archive, with ord and file."""
    return table_of_zips(spark.read.format("binaryFile").load(path).select("path", "content"), file, required, optional)


def table_of_zips(files: DataFrame, file: str, required: list[str], optional: list[str]) -> DataFrame:
    """One table of archives given as (path, content), with ord and file."""
    ship_package(files.sparkSession)
    names = [*required, *optional]

    def parse(batches):
        for frame in batches:
            for origin, content in zip(frame["path"], frame["content"]):
                with zipfile.ZipFile(io.BytesIO(bytes(content))) as archive:
                    for entry in sorted(archive.namelist()):
                        if entry.startswith("__MACOSX/") or entry.rsplit("/", 1)[-1] != f"{file}.txt":
                            continue
                        rows = records(archive.read(entry))
                        header = [c.strip() for c in next(rows, [])]
                        missing = [c for c in required if c not in header]
                        if missing:
                            raise CsvError(f"{entry}: columns are missing: {', '.join(missing)}")
                        at = [header.index(c) if c in header else None for c in names]
                        yield from frames(rows, at, names, origin)

    return files.mapInPandas(parse, ", ".join([*(f"`{c}` string" for c in names), "ord bigint", "file string"]))


def entries_of_zips(files: DataFrame) -> set[str]:
    """The names of the tables that any of the archives (path, content) holds; some dozens at most."""
    ship_package(files.sparkSession)

    def names(batches):
        for frame in batches:
            found = set()
            for content in frame["content"]:
                with zipfile.ZipFile(io.BytesIO(bytes(content))) as archive:
                    found |= {e.rsplit("/", 1)[-1] for e in archive.namelist() if not e.startswith("__MACOSX/")}
            yield pd.DataFrame({"name": sorted(n[:-4] for n in found if n.endswith(".txt"))}, dtype=object)

    return {r["name"] for r in files.mapInPandas(names, "name string").distinct().collect() if r["name"] in LAYOUT}


def present(c: Column) -> Column:
    return F.coalesce(c, F.lit("")) != ""


@dataclass
class Feed:
    """A feed's tables and, by reason, the rows that were dropped."""

    tables: dict[str, DataFrame] = field(default_factory=dict)
    dropped: dict[str, DataFrame] = field(default_factory=dict)

    def issues(self) -> DataFrame:
        """(reason, n)."""
        out = None
        for reason, rows in self.dropped.items():
            one = rows.agg(F.count("*").alias("n")).select(F.lit(reason).alias("reason"), "n")
            out = one if out is None else out.unionByName(one)
        return out


def agencies(raw: DataFrame) -> DataFrame:
    return first_by(raw.select(F.coalesce("agency_id", F.lit("")).alias("agency"), F.col("agency_name").alias("name"), F.col("agency_timezone").alias("timezone"), "ord"), ["agency"], "ord")


def routes(raw: DataFrame, default_agency: str = "") -> tuple[DataFrame, DataFrame]:
    """Routes by id, the first of repeated ones; rows without an id or repeated are dropped."""
    agency = F.when(present(F.col("agency_id")), F.col("agency_id")).otherwise(F.lit(default_agency))
    typed = raw.select(
        F.col("route_id").alias("route"), agency.alias("agency"),
        F.coalesce("route_short_name", F.lit("")).alias("short_name"), F.coalesce("route_long_name", F.lit("")).alias("long_name"), F.coalesce("route_desc", F.lit("")).alias("description"),
        F.coalesce(fields.parse_count(F.col("route_type")), F.lit(3)).alias("route_type"), fields.parse_color(F.col("route_color")).alias("color"), fields.parse_color(F.col("route_text_color")).alias("text_color"), "ord",
    )
    named = typed.where(present(F.col("route")))
    kept = first_by(named, ["route"], "ord")
    return kept, typed.select("route", "ord").join(kept.select("route", "ord"), ["route", "ord"], "left_anti")


def stops(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Stops with coordinates in microdegrees; a location type outside 0 to 4 counts as 0."""
    kind = fields.parse_count(F.col("location_type"))
    typed = raw.select(
        F.col("stop_id").alias("stop"), F.coalesce("stop_name", F.lit("")).alias("name"), F.coalesce("stop_code", F.lit("")).alias("code"),
        fields.parse_microdegrees(F.col("stop_lat")).alias("lat_e6"), fields.parse_microdegrees(F.col("stop_lon")).alias("lon_e6"),
        F.when(kind.between(0, 4), kind).otherwise(0).cast("int").alias("kind"), F.when(present(F.col("parent_station")), F.col("parent_station")).alias("parent"), "ord",
    )
    named = first_by(typed.where(present(F.col("stop"))), ["stop"], "ord")
    kept = named.where("lat_e6 is not null and lon_e6 is not null")
    return kept, typed.select("stop", "ord").join(kept.select("stop", "ord"), ["stop", "ord"], "left_anti")


def calendars(weekly: DataFrame | None, dates: DataFrame | None) -> tuple[DataFrame | None, DataFrame | None]:
    """Weekly rules (the last row of a service wins) and exceptions (the last of a service and day).  A malformed value is an error."""
    rules = exceptions = None
    if weekly is not None:
        bits = sum((F.when(F.btrim(d, F.lit(" \t")) == "1", 1 << i).otherwise(0) for i, d in enumerate(map(F.col, WEEK))), F.lit(0))
        first, last = fields.parse_day(F.col("start_date")), fields.parse_day(F.col("end_date"))
        checked = lambda c, what: F.when(c.isNull(), F.raise_error(F.concat(F.lit(f"bad {what} of service "), "service_id"))).otherwise(c)
        rules = last_by(weekly.select(F.col("service_id").alias("rule"), bits.cast("int").alias("mask"), checked(first, "start_date").alias("first"), checked(last, "end_date").alias("last"), "ord"), ["rule"], "ord")
    if dates is not None:
        day, kind = fields.parse_day(F.col("date")), fields.parse_count(F.col("exception_type"))
        checked_day = F.when(day.isNull(), F.raise_error(F.concat(F.lit("bad date of service "), "service_id"))).otherwise(day)
        checked_kind = F.when(kind.isin(1, 2), kind).otherwise(F.raise_error(F.concat(F.lit("bad exception_type of service "), "service_id")))
        exceptions = last_by(dates.select(F.col("service_id").alias("rule"), checked_day.alias("day"), checked_kind.cast("int").alias("kind"), "ord"), ["rule", "day"], "ord")
    return rules, exceptions


def trips(raw: DataFrame, known_routes: DataFrame, known_rules: DataFrame) -> tuple[DataFrame, dict[str, DataFrame]]:
    """Trips of known routes and services; empty and repeated ids are dropped; a direction over 1 is null."""
    direction = fields.parse_count(F.col("direction_id"))
    typed = raw.select(
        F.col("trip_id").alias("trip"), F.col("route_id").alias("route"), F.col("service_id").alias("rule"), F.coalesce("trip_headsign", F.lit("")).alias("headsign"), F.coalesce("trip_short_name", F.lit("")).alias("short_name"),
        F.when(direction <= 1, direction).cast("int").alias("direction"), F.when(present(F.col("shape_id")), F.col("shape_id")).alias("shape"), (F.btrim(F.coalesce("peak_offpeak", F.lit("")), F.lit(" \t")) == "1").alias("peak"), "ord",
    )
    named = first_by(typed.where(present(F.col("trip"))), ["trip"], "ord")
    routed, no_route = known_only(named, "route", known_routes, "route")
    kept, no_rule = known_only(routed, "rule", known_rules, "rule")
    again = typed.select("trip", "ord").join(named.select("trip", "ord"), ["trip", "ord"], "left_anti")
    return kept, {"trip id empty or repeated": again, "trip of unknown route": no_route, "trip without calendar": no_rule}


def stop_times(raw: DataFrame, known_trips: DataFrame, known_stops: DataFrame) -> tuple[DataFrame, dict[str, DataFrame]]:
    """Stop events numbered by (sequence, file order) in their trip; an unparsable time is missing and counted."""
    from pyspark.sql import Window

    typed = raw.select(
        F.col("trip_id").alias("trip"), F.col("stop_id").alias("stop"), fields.parse_count(F.col("stop_sequence")).alias("sequence"),
        fields.parse_clock(F.col("arrival_time")).alias("arrival"), fields.parse_clock(F.col("departure_time")).alias("departure"),
        ((present(fields.trim_blanks(F.col("arrival_time"))) & fields.parse_clock(F.col("arrival_time")).isNull()) | (present(fields.trim_blanks(F.col("departure_time"))) & fields.parse_clock(F.col("departure_time")).isNull())).alias("bad_time"),
        F.coalesce(fields.parse_count(F.col("pickup_type")), F.lit(0)).cast("int").alias("pickup"), F.coalesce(fields.parse_count(F.col("drop_off_type")), F.lit(0)).cast("int").alias("drop_off"), "ord",
    )
    ridden, no_trip = known_only(typed, "trip", known_trips, "trip")
    stopped, no_stop = known_only(ridden, "stop", known_stops, "stop")
    placed = stopped.where("sequence is not null")
    nth = F.row_number().over(Window.partitionBy("trip").orderBy("sequence", "ord")) - 1
    kept = placed.withColumn("pos", nth).withColumn("arrival", F.coalesce("arrival", "departure")).withColumn("departure", F.coalesce("departure", "arrival"))
    return kept, {"call of unknown trip": no_trip, "call at unknown stop": no_stop, "call without sequence": stopped.where("sequence is null"), "bad time": placed.where("bad_time")}


def shapes(raw: DataFrame, used: DataFrame) -> DataFrame:
    """Points of shapes that trips use, numbered by (sequence, file order)."""
    from pyspark.sql import Window

    typed = raw.select(F.col("shape_id").alias("shape"), fields.parse_microdegrees(F.col("shape_pt_lat")).alias("lat_e6"), fields.parse_microdegrees(F.col("shape_pt_lon")).alias("lon_e6"), fields.parse_count(F.col("shape_pt_sequence")).alias("sequence"), "ord")
    wanted = typed.where("lat_e6 is not null and lon_e6 is not null and sequence is not null").join(used.select("shape").distinct(), "shape", "left_semi")
    return wanted.withColumn("seq", F.row_number().over(Window.partitionBy("shape").orderBy("sequence", "ord")) - 1).select("shape", "seq", "lat_e6", "lon_e6")


def transfers(raw: DataFrame) -> DataFrame:
    kind = F.coalesce(fields.parse_count(F.col("transfer_type")), F.lit(0))
    rows = raw.where(present(F.col("from_stop_id")) & present(F.col("to_stop_id")))
    return rows.select(F.col("from_stop_id").alias("from_stop"), F.col("to_stop_id").alias("to_stop"), kind.cast("int").alias("kind"), fields.parse_count(F.col("min_transfer_time")).alias("seconds"), (present(F.col("from_trip_id")) | present(F.col("to_trip_id"))).alias("trip_specific"))


def refuse_frequencies(raw: DataFrame, known_trips: DataFrame) -> None:
    """A frequency of a known trip is not supported and fails the build."""
    if known_only(raw, "trip_id", known_trips, "trip")[0].limit(1).count():
        raise CsvError("frequencies.txt names a trip of the feed")


def entrances(raw: DataFrame) -> DataFrame:
    """One row a station of each subway entrance; ids may be lists such as 'A12; D13'."""
    station = F.explode(F.transform(F.split("GTFS Stop ID", ";"), lambda x: fields.trim_blanks(x)))
    open_ = lambda c: F.lower(fields.trim_blanks(F.coalesce(c, F.lit("")))) != "no"
    rows = raw.select(
        station.alias("station"), F.col("Entrance Type").alias("kind"), open_(F.col("Entry Allowed")).alias("entry"), open_(F.col("Exit Allowed")).alias("exit"),
        fields.parse_microdegrees(F.col("Entrance Latitude")).alias("lat_e6"), fields.parse_microdegrees(F.col("Entrance Longitude")).alias("lon_e6"),
    )
    return rows.where((F.col("station") != "") & F.col("lat_e6").isNotNull() & F.col("lon_e6").isNotNull())


def coverage(rules: DataFrame, exceptions: DataFrame) -> DataFrame:
    """First and last day of a feed, over weekly rules and added days."""
    days = rules.where("mask is not null").select(F.col("first").alias("a"), F.col("last").alias("b")).unionByName(exceptions.where("kind = 1").select(F.col("day").alias("a"), F.col("day").alias("b")))
    return days.agg(F.min("a").alias("first"), F.max("b").alias("last"))


def read_feed(spark: SparkSession, path: str, zipped: bool = False) -> Feed:
    """A feed from a folder of .txt files, or from zip archives."""

    held = entries_of_zips(spark.read.format("binaryFile").load(path).select("path", "content")) if zipped else set()

    def load(name: str) -> DataFrame | None:
        required, optional = LAYOUT[name]
        if zipped:
            if name in REQUIRED and name not in held:
                raise CsvError(f"a feed needs {name}.txt")
            return read_zip(spark, path, name, required, optional) if name in held else None
        try:
            return read_exact_csv(spark, f"{path}/{name}.txt", required, optional)
        except Exception as error:  # only a file that is not there may be left out
            if name in REQUIRED or "PATH_NOT_FOUND" not in str(error):
                raise
            return None

    return parse_feed(spark, {name: load(name) for name in LAYOUT})


def kept_rows(rows: DataFrame) -> DataFrame:
    """``rows``, written once in the shared folder, for files that are asked for several times."""
    path = scratch_path(rows.sparkSession, "rows")
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def parse_feed(spark: SparkSession, raw: dict[str, DataFrame | None]) -> Feed:
    """A feed from its files' rows; files that are not there are None.  Files are parsed once, when this is called."""
    if raw["calendar"] is None and raw["calendar_dates"] is None:
        raise CsvError("a feed needs calendar.txt or calendar_dates.txt")
    raw = {name: kept_rows(rows) if rows is not None and name in REQUIRED else rows for name, rows in raw.items()}
    feed = Feed()
    t = feed.tables
    t["agency"] = agencies(raw["agency"])
    first_agency = raw["agency"].orderBy("ord").limit(1).select("agency_id").collect()
    t["route"], feed.dropped["route id empty or repeated"] = routes(raw["routes"], (first_agency[0][0] or "") if first_agency else "")
    t["stop"], feed.dropped["stop empty, repeated or without place"] = stops(raw["stops"])
    rules, exceptions = calendars(raw["calendar"], raw["calendar_dates"])
    if rules is None:
        rules = spark.createDataFrame([], "rule string, mask int, first date, last date, ord bigint")
    if exceptions is None:
        exceptions = spark.createDataFrame([], "rule string, day date, kind int, ord bigint")
    t["rule"], t["rule_exception"] = rules, exceptions
    t["trip"], lost = trips(raw["trips"], t["route"], rules.select("rule").unionByName(exceptions.select("rule")))
    feed.dropped |= lost
    t["stop_event"], lost = stop_times(raw["stop_times"], t["trip"], t["stop"])
    feed.dropped |= lost
    if raw["shapes"] is not None:
        t["shape_point"] = shapes(raw["shapes"], t["trip"])
    if raw["transfers"] is not None:
        t["transfer"] = transfers(raw["transfers"])
    if raw["frequencies"] is not None:
        refuse_frequencies(raw["frequencies"], t["trip"])
    return feed

