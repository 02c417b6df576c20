"""Queries on sources and sinks: files of the driver tables' rows are written to the shared folder and read back by the readers."""

from __future__ import annotations

import io
import zipfile

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from metrolith.functions import blobs, fields
from metrolith.operators import calendar
from metrolith.operators.order import numbered
from metrolith.plans import adapters as a
from metrolith.plans.registry import query, table
from metrolith.session import scratch_path, ship_package
from metrolith.sources import csv, gtfs, mobility, versions
from metrolith.streaming import trip_stream

LAYOUT = gtfs.LAYOUT


def _file(spark: SparkSession, rows: DataFrame, header: str, order: str = "k", parts: int = 1) -> str:
    """A folder of text files: the header, then the lines (k, line) in order; one file, since its order is part of the rules."""
    path = scratch_path(spark, "lines")
    head = spark.range(1).select(F.lit(-1).cast("bigint").alias("k"), F.lit(header).alias("line"))
    rows.select(F.col(order).cast("bigint").alias("k"), "line").unionByName(head).repartition(parts).sortWithinPartitions("k").select("line").write.text(path)
    return path


def _text(*parts) -> Column:
    return F.concat(*(p.cast("string") if isinstance(p, Column) else F.lit(p) for p in parts))


def _raw(spark, path, name):
    return csv.read_exact_csv(spark, path, *LAYOUT[name])


@query("""select c_custkey as id, concat(c_name, ', "', c_mktsegment, '"', case when c_custkey % 5 = 0 then chr(10) else '' end) as name, case when c_custkey % 4 = 0 then '' else 'a"b' end as note, cast(null as varchar) as missing, row_number() over (order by c_custkey) - 1 as ord from customer""")
def s1_s3_exact_csv(spark, sf):
    k = F.col("c_custkey")
    quoted = _text('"', F.col("c_name"), ', ""', F.col("c_mktsegment"), '""', F.when(k % 5 == 0, "\n").otherwise(""), '"')
    line = _text(quoted, ",", k, ",", F.when(k % 4 == 0, "").otherwise('a"b'), F.when(k % 3 == 0, "\r").otherwise(""), F.when(k % 7 == 0, "\n").otherwise(""))
    path = _file(spark, table(spark, sf, "customer").select(k.alias("k"), line.alias("line")), ' name ,id,"note"\r')
    found = csv.read_exact_csv(spark, path, ["id", "note"], ["name", "missing"])
    return found.select(F.col("id").cast("bigint").alias("id"), "name", "note", "missing", "ord")


@query(f"with {a.LINES} select l_orderkey, l_linenumber, concat('stop ', l_suppkey, case when l_partkey % 6 = 0 then ', \"side\"' else '' end) as stop, l_partkey from lines")
def s1_split_csv(spark, sf):
    line = a.lines(spark, sf)
    stop = _text('"stop ', F.col("l_suppkey"), F.when(F.col("l_partkey") % 6 == 0, ', ""side""').otherwise(""), '"')
    text = _text(F.col("l_orderkey"), ",", stop, ",", F.col("l_linenumber"), ",", F.col("l_partkey"), F.when(F.col("l_partkey") % 2 == 0, "\r").otherwise(""))
    path = _file(spark, line.select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("k"), text.alias("line")), "order, stop ,line,part\r")
    found = csv.read_split_csv(spark, path, ["order", "line", "stop"], ["part"])
    return found.select(F.col("order").cast("bigint").alias("l_orderkey"), F.col("line").cast("int").alias("l_linenumber"), "stop", F.col("part").cast("bigint").alias("l_partkey"))


# feeds

_STOPS = """sraw as (select row_number() over (order by s_suppkey) - 1 as ord, case when s_suppkey % 29 = 0 then '' else concat('S', s_suppkey % 83) end as stop, s_name as name, concat('c', s_nationkey) as code,
  case when s_suppkey % 17 <> 0 then cast(40000000 + s_suppkey * 13 % 1000000 as integer) end as lat_e6, cast(-73000000 - s_suppkey * 7 % 1000000 as integer) as lon_e6, cast(case when s_suppkey % 7 <= 4 then s_suppkey % 7 else 0 end as integer) as kind,
  case when s_suppkey % 5 = 0 then concat('S', s_suppkey % 10) end as parent from supplier),
stops as (select stop, name, code, lat_e6, lon_e6, kind, parent, ord from (select *, row_number() over (partition by stop order by ord) as rn from sraw where stop <> '') where rn = 1 and lat_e6 is not null)"""


def _stops_file(spark, sf):
    k = F.col("s_suppkey")
    six = lambda x: F.lpad((x % 1_000_000).cast("string"), 6, "0")
    line = _text(
        F.when(k % 29 == 0, "").otherwise(_text("S", k % 83)), ',"', F.col("s_name"), '",c', F.col("s_nationkey"), ",", F.when(k % 17 == 0, "").otherwise(_text("40.", six(k * 13))), ",-73.", six(k * 7), ",", k % 7, ",", F.when(k % 5 == 0, _text("S", k % 10)).otherwise("")
    )
    return _file(spark, table(spark, sf, "supplier").select(k.alias("k"), line.alias("line")), "stop_id,stop_name,stop_code,stop_lat,stop_lon,location_type,parent_station")


def _stops(spark, sf):
    return gtfs.stops(_raw(spark, _stops_file(spark, sf), "stops"))


@query(f"with {_STOPS} select * from stops")
def s7_stops(spark, sf):
    return _stops(spark, sf)[0].select("stop", "name", "code", "lat_e6", "lon_e6", "kind", "parent", "ord")


_TRIPS = """traw as (select row_number() over (order by o_orderkey) - 1 as ord, case when o_orderkey % 31 = 0 then '' else concat('T', o_orderkey // 2) end as trip, concat('R', o_custkey % 30) as route, concat('C', o_orderkey % 10) as rule, o_orderpriority as headsign,
  case when o_orderkey % 4 <= 1 then cast(o_orderkey % 4 as integer) end as direction, case when o_orderkey % 3 <> 0 then concat('H', o_orderkey % 40) end as shape, o_orderkey % 5 = 0 as peak from orders),
tfirst as (select * from (select *, row_number() over (partition by trip order by ord) as rn from traw where trip <> '') where rn = 1),
trips as (select trip, route, rule, headsign, direction, shape, peak, ord from tfirst where route in (select concat('R', n_nationkey) from nation) and rule not in ('C8', 'C9'))"""


def _trips_file(spark, sf):
    k = F.col("o_orderkey")
    line = _text(
        F.when(k % 31 == 0, "").otherwise(_text("T", F.floor(k / 2))), ",R", F.col("o_custkey") % 30, ",C", k % 10, ",", F.col("o_orderpriority"), ",", k % 4, ",", F.when(k % 3 != 0, _text("H", k % 40)).otherwise(""), ",", F.when(k % 5 == 0, " 1").otherwise("0")
    )
    return _file(spark, table(spark, sf, "orders").select(k.alias("k"), line.alias("line")), "trip_id,route_id,service_id,trip_headsign,direction_id,shape_id,peak_offpeak")


def _trips(spark, sf):
    known = table(spark, sf, "nation").select(_text("R", F.col("n_nationkey")).alias("route"))
    rules = spark.range(8).select(_text("C", F.col("id")).alias("rule"))
    return gtfs.trips(_raw(spark, _trips_file(spark, sf), "trips"), known, rules)


@query(f"with {_TRIPS} select * from trips")
def s9_trips(spark, sf):
    return _trips(spark, sf)[0].select("trip", "route", "rule", "headsign", "direction", "shape", "peak", "ord")


@query(f"""with {_TRIPS} select 'trip id empty or repeated' as reason, (select count(*) from traw) - (select count(*) from tfirst) as n union all select 'trip of unknown route', count(*) from tfirst where route not in (select concat('R', n_nationkey) from nation)
union all select 'trip without calendar', count(*) from tfirst where route in (select concat('R', n_nationkey) from nation) and rule in ('C8', 'C9')""")
def s9_trip_issues(spark, sf):
    return gtfs.Feed(dropped=_trips(spark, sf)[1]).issues()


_CALLS = f"""{a.LINES}, craw as (select row_number() over (order by l_orderkey, l_linenumber) - 1 as ord, concat('T', l_orderkey) as trip, concat('S', l_suppkey) as stop, case when l_partkey % 37 = 0 then null else 100 - l_linenumber // 2 * 10 end as sequence,
  case when l_partkey % 9 = 0 or l_partkey % 41 = 0 then null else l_partkey * 7 % 100000 end as arr, case when l_partkey % 11 = 0 or l_partkey % 43 = 0 then null else l_partkey * 7 % 100000 + 30 end as dep, l_partkey % 41 = 0 and l_partkey % 9 <> 0 or l_partkey % 43 = 0 and l_partkey % 11 <> 0 as bad_time,
  cast(case when l_partkey % 4 = 0 then 1 else 0 end as integer) as pickup, cast(l_linenumber % 2 as integer) as drop_off from lines),
kept as (select * from craw where trip in (select concat('T', o_orderkey) from orders where o_orderkey % 13 <> 0) and stop in (select concat('S', s_suppkey) from supplier where s_suppkey % 11 <> 0)),
calls as (select trip, stop, sequence, coalesce(arr, dep) as arrival, coalesce(dep, arr) as departure, bad_time, pickup, drop_off, ord, row_number() over (partition by trip order by sequence, ord) - 1 as pos from kept where sequence is not null)"""


def _calls(spark, sf):
    k = F.col("l_partkey")
    two = lambda x: F.lpad(x.cast("string"), 2, "0")
    clock = lambda s: _text(F.floor(s / 3600), ":", two(F.floor(s / 60) % 60), ":", two(s % 60))
    at = k * 7 % 100_000
    arrival = F.when(k % 9 == 0, "").when(k % 41 == 0, "25:7x:00").otherwise(clock(at))
    departure = F.when(k % 11 == 0, " ").when(k % 43 == 0, "soon").otherwise(_text(" ", clock(at + 30)))
    line = _text("T", F.col("l_orderkey"), ",", arrival, ",", departure, ",S", F.col("l_suppkey"), ",", F.when(k % 37 == 0, "x").otherwise((100 - F.floor(F.col("l_linenumber") / 2) * 10).cast("string")), ",", F.when(k % 4 == 0, "1").otherwise(""), ",", F.col("l_linenumber") % 2)
    rows = a.lines(spark, sf).select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("k"), line.alias("line"))
    raw = csv.read_exact_csv(spark, _file(spark, rows, "trip_id,arrival_time,departure_time,stop_id,stop_sequence,pickup_type,drop_off_type"), *LAYOUT["stop_times"])
    trips = table(spark, sf, "orders").where("o_orderkey % 13 <> 0").select(_text("T", F.col("o_orderkey")).alias("trip"))
    stops = table(spark, sf, "supplier").where("s_suppkey % 11 <> 0").select(_text("S", F.col("s_suppkey")).alias("stop"))
    return gtfs.stop_times(gtfs.kept_rows(raw), trips, stops)


@query(f"with {_CALLS} select trip, pos, stop, sequence, arrival, departure, bad_time, pickup, drop_off, ord from calls")
def s10_stop_times(spark, sf):
    return _calls(spark, sf)[0].select("trip", "pos", "stop", F.col("sequence").cast("bigint").alias("sequence"), F.col("arrival").cast("bigint").alias("arrival"), F.col("departure").cast("bigint").alias("departure"), "bad_time", "pickup", "drop_off", "ord")


@query(f"""with {_CALLS}, ridden as (select * from craw where trip in (select concat('T', o_orderkey) from orders where o_orderkey % 13 <> 0)) select 'call of unknown trip' as reason, (select count(*) from craw) - (select count(*) from ridden) as n union all select 'call at unknown stop', (select count(*) from ridden) - (select count(*) from kept)
union all select 'call without sequence', count(*) from kept where sequence is null union all select 'bad time', count(*) from calls where bad_time""")
def s10_call_issues(spark, sf):
    return gtfs.Feed(dropped=_calls(spark, sf)[1]).issues()


@query(f"""with {a.LINES}, r as (select row_number() over (order by l_orderkey, l_linenumber) - 1 as ord, concat('H', l_suppkey) as shape, case when l_partkey % 23 <> 0 then 40000000 + l_partkey * 17 % 1000000 end as lat_e6, -73000000 - l_partkey * 29 % 1000000 as lon_e6, l_partkey % 50 as sequence from lines)
select shape, cast(lat_e6 as integer) as lat_e6, cast(lon_e6 as integer) as lon_e6, row_number() over (partition by shape order by sequence, ord) - 1 as seq from r where lat_e6 is not null and shape in (select concat('H', s_suppkey) from supplier where s_suppkey % 3 <> 0)""")
def s11_shapes(spark, sf):
    k = F.col("l_partkey")
    six = lambda x: F.lpad((x % 1_000_000).cast("string"), 6, "0")
    line = _text("H", F.col("l_suppkey"), ",", F.when(k % 23 == 0, "north").otherwise(_text("40.", six(k * 17))), ",-73.", six(k * 29), ",", k % 50)
    rows = a.lines(spark, sf).select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("k"), line.alias("line"))
    raw = _raw(spark, _file(spark, rows, "shape_id,shape_pt_lat,shape_pt_lon,shape_pt_sequence"), "shapes")
    used = table(spark, sf, "supplier").where("s_suppkey % 3 <> 0").select(_text("H", F.col("s_suppkey")).alias("shape"))
    return gtfs.shapes(raw, used).select("shape", F.col("seq").cast("bigint").alias("seq"), "lat_e6", "lon_e6")


@query("""select concat('P', l_suppkey) as from_stop, concat('P', l_partkey) as to_stop, cast(case when l_linenumber % 5 = 4 then 0 else l_linenumber % 5 end as integer) as kind, case when l_partkey % 3 = 0 then l_partkey end as seconds, l_orderkey % 6 = 0 as trip_specific from lineitem where l_partkey % 8 <> 0""")
def s12_transfers(spark, sf):
    k, n = F.col("l_partkey"), F.col("l_linenumber") % 5
    line = _text("P", F.col("l_suppkey"), ",", F.when(k % 8 == 0, "").otherwise(_text("P", k)), ",", F.when(n == 4, "").otherwise(n.cast("string")), ",", F.when(k % 3 == 0, k.cast("string")).otherwise(""), ",,", F.when(F.col("l_orderkey") % 6 == 0, "t").otherwise(""))
    rows = table(spark, sf, "lineitem").select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("k"), line.alias("line"))
    raw = _raw(spark, _file(spark, rows, "from_stop_id,to_stop_id,transfer_type,min_transfer_time,from_trip_id,to_trip_id"), "transfers")
    return gtfs.transfers(raw).select("from_stop", "to_stop", "kind", F.col("seconds").cast("bigint").alias("seconds"), "trip_specific")


@query("select * from (values ('unknown trips only', false), ('a known trip', true)) t(feed, refused)")
def s13_frequencies(spark, sf):
    trips = table(spark, sf, "orders").select(_text("T", F.col("o_orderkey")).alias("trip"))
    found = []
    for feed, rows in (("unknown trips only", trips.select(F.concat(F.lit("x"), "trip").alias("trip"))), ("a known trip", trips)):
        raw = _raw(spark, _file(spark, rows.select(F.lit(0).alias("k"), F.col("trip").alias("line")), "trip_id"), "frequencies")
        try:
            gtfs.refuse_frequencies(raw, trips)
            found.append((feed, False))
        except csv.CsvError:
            found.append((feed, True))
    return spark.createDataFrame(found, "feed string, refused boolean")


@query("""with d as (select s_suppkey as k, unnest(case when s_suppkey % 4 = 0 then [concat('A', s_suppkey), concat('D', s_suppkey)] else [concat('A', s_suppkey)] end) as station from supplier) select station, case when k % 2 = 0 then 'Stair' else 'Elevator' end as kind, k % 3 <> 0 as entry, k % 5 <> 0 as exit, cast(40000000 + k * 11 as integer) as lat_e6, cast(-73000000 - k * 3 as integer) as lon_e6 from d where k % 19 <> 0""")
def s14_entrances(spark, sf):
    k = F.col("s_suppkey")
    six = lambda x: F.lpad(x.cast("string"), 6, "0")
    line = _text(
        "A", k, F.when(k % 4 == 0, _text("; D", k)).otherwise(""), ",", F.when(k % 2 == 0, "Stair").otherwise("Elevator"), ",", F.when(k % 3 == 0, "No").otherwise("YES"), ",", F.when(k % 5 == 0, " NO").otherwise(""), ",", F.when(k % 19 == 0, "").otherwise(_text("40.", six(k * 11))), ",-73.", six(k * 3)
    )
    names = ["GTFS Stop ID", "Entrance Type", "Entry Allowed", "Exit Allowed", "Entrance Latitude", "Entrance Longitude"]
    path = _file(spark, table(spark, sf, "supplier").select(k.alias("k"), line.alias("line")), ",".join(names))
    return gtfs.entrances(csv.read_exact_csv(spark, path, names))


_FEED = f"""{_STOPS}, {_TRIPS}, ev as (select 'T' || (l_orderkey // 2) as trip, 'S' || (l_suppkey % 90) as stop from lineitem), ridden as (select * from ev where trip in (select trip from trips)), called as (select * from ridden where stop in (select stop from stops))"""


@query(f"""with {_FEED} select 'agency' as what, (select count(*) from region) as n union all select 'route', count(*) from nation union all select 'stop', count(*) from stops union all select 'rule', 8 union all select 'trip', count(*) from trips union all select 'stop_event', count(*) from called
union all select 'stop empty, repeated or without place', (select count(*) from sraw) - (select count(*) from stops) union all select 'trip id empty or repeated', (select count(*) from traw) - (select count(*) from tfirst) union all select 'trip of unknown route', count(*) from tfirst where route not in (select concat('R', n_nationkey) from nation)
union all select 'trip without calendar', count(*) from tfirst where route in (select concat('R', n_nationkey) from nation) and rule in ('C8', 'C9') union all select 'call of unknown trip', (select count(*) from ev) - (select count(*) from ridden) union all select 'call at unknown stop', (select count(*) from ridden) - (select count(*) from called)""")
def s4_s5_feed_of_files(spark, sf):
    """A whole feed from a folder: tables and issues by number of rows."""
    nation, region = table(spark, sf, "nation"), table(spark, sf, "region")
    line = table(spark, sf, "lineitem").select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("k"), _text("T", F.floor(F.col("l_orderkey") / 2), ",S", F.col("l_suppkey") % 90, ",", F.col("l_linenumber"), ",8:00:00,8:00:30").alias("line"))
    files = {
        "agency": _file(spark, region.select(F.col("r_regionkey").alias("k"), _text(F.col("r_regionkey"), ",", F.col("r_name"), ",America/New_York").alias("line")), "agency_id,agency_name,agency_timezone"),
        "routes": _file(spark, nation.select(F.col("n_nationkey").alias("k"), _text("R", F.col("n_nationkey"), ",", F.col("n_regionkey")).alias("line")), "route_id,agency_id"),
        "stops": _stops_file(spark, sf),
        "trips": _trips_file(spark, sf),
        "calendar": _file(spark, spark.range(8).select(F.col("id").alias("k"), _text("C", F.col("id"), ",1,1,1,1,1,0,0,20260101,20261231").alias("line")), "service_id," + ",".join(gtfs.WEEK) + ",start_date,end_date"),
        "stop_times": _file(spark, line, "trip_id,stop_id,stop_sequence,arrival_time,departure_time"),
    }
    feed = gtfs.parse_feed(spark, {name: _raw(spark, files[name], name) if name in files else None for name in LAYOUT})
    counts = [t.agg(F.count("*").alias("n")).select(F.lit(name).alias("what"), "n") for name, t in feed.tables.items() if name != "rule_exception"]
    out = feed.issues().where("n > 0").select(F.col("reason").alias("what"), "n")
    for one in counts:
        out = out.unionByName(one)
    return out


def _zipped(texts: DataFrame, entry: str) -> DataFrame:
    """(path, content): an archive for each ``path`` with one entry of the lines (path, k, line), and one to pass over."""
    ship_package(texts.sparkSession)

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        out = io.BytesIO()
        with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as archive:
            archive.writestr(f"below/{entry}", "\n".join(frame.sort_values("k")["line"]))
            archive.writestr(f"__MACOSX/below/{entry}", "junk")
        return pd.DataFrame({"path": [frame["path"].iloc[0]], "content": [out.getvalue()]})

    return texts.groupBy("path").applyInPandas(run, "path string, content binary")


@query("select concat('feed ', n_regionkey) as file, concat('R', n_nationkey) as route, n_name as long_name, row_number() over (partition by n_regionkey order by n_nationkey) - 1 as ord from nation")
def s4_feed_of_archives(spark, sf):
    n = table(spark, sf, "nation")
    rows = n.select(_text("feed ", F.col("n_regionkey")).alias("path"), F.col("n_nationkey").alias("k"), _text("R", F.col("n_nationkey"), ',"', F.col("n_name"), '"').alias("line"))
    heads = n.select(_text("feed ", F.col("n_regionkey")).alias("path"), F.lit(-1).alias("k"), F.lit("route_id,route_long_name").alias("line")).distinct()
    found = gtfs.table_of_zips(_zipped(rows.unionByName(heads), "routes.txt"), "routes", *LAYOUT["routes"])
    return found.select("file", F.col("route_id").alias("route"), F.col("route_long_name").alias("long_name"), "ord")


# trips, stations, ways, areas


@query("""with e as (select event_id, user_id, ts, event_id % 3 as b from events) select case when b = 0 then 'ebike' when b = 1 then 'classic' end as bike, 'departures' as direction, concat('st', user_id) as id, cast(ts as date) as day, cast(hour(ts) * 60 + minute(ts) as integer) as minute, cast((hour(ts) * 60 + minute(ts)) // 15 as integer) as bin, count(*) as n from e where b < 2 group by all
union all select case when b = 0 then 'ebike' when b = 1 then 'classic' end, 'arrivals', '', case when event_id % 5 <> 0 then cast(ts as date) end, case when event_id % 5 <> 0 then cast(hour(ts) * 60 + minute(ts) as integer) end, case when event_id % 5 <> 0 then cast((hour(ts) * 60 + minute(ts)) // 15 as integer) end, count(*) from e where b < 2 group by all""")
def s15_s16_trip_archives(spark, sf):
    e = table(spark, sf, "events").where("event_id % 3 < 2")
    k, at = F.col("event_id"), F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    line = _text(F.when(k % 3 == 0, "electric_bike").otherwise("classic_bike"), ",", at, ".123,", F.when(k % 5 == 0, "bad").otherwise(at), ",st", F.col("user_id"), ',,"name, of start"')
    name = _text(F.date_format("ts", "yyyyMM"), "-tripdata.zip")
    rows = e.select(name.alias("path"), k.alias("k"), line.alias("line"))
    heads = rows.select("path", F.lit(-1).cast("bigint").alias("k"), F.lit(" rideable_type,started_at,ended_at,start_station_id,end_station_id,start_station_name").alias("line")).distinct()
    ends = mobility.trip_ends(mobility.trips_of_zips(_zipped(rows.unionByName(heads), "a.csv")))
    return ends.groupBy("bike", "direction", "id", "day", "minute", "bin").agg(F.count("*").alias("n"))


@query("""select concat('trips/', p_brand, '&', p_partkey) as key, concat('e', p_size) as etag, cast(p_partkey * 100 as bigint) as size, case when p_size % 2 = 0 then concat('t', p_size) end as next from part""")
def s17_bucket_listing(spark, sf):
    k = F.col("p_partkey")
    entry = _text("<Contents><Key>trips/", F.col("p_brand"), "&amp;", k, '</Key><ETag>"e', F.col("p_size"), '"</ETag><Size>', k * 100, "</Size></Contents>")
    more = F.when(F.col("p_size") % 2 == 0, _text("<IsTruncated>true</IsTruncated><NextContinuationToken>t", F.col("p_size"), "</NextContinuationToken>")).otherwise("<IsTruncated>false</IsTruncated>")
    pages = table(spark, sf, "part").groupBy("p_size", more.alias("more")).agg(F.array_join(F.collect_list(entry), "").alias("body"))  # a page for each of 50 sizes
    return mobility.listed_objects(pages.select(_text("<ListBucketResult>", F.col("more"), F.col("body"), "</ListBucketResult>").alias("value")))


_GBFS = "select cast(c_custkey as varchar) as station_id, c_name as name, cast(40000000 + c_custkey * 13 % 1000000 as integer) as lat_e6, cast(-73000000 - c_custkey * 7 % 1000000 as integer) as lon_e6, case when c_custkey % 4 <> 0 then cast(c_nationkey as varchar) end as region, cast(case when c_custkey % 6 = 0 then 0 else c_custkey % 60 end as integer) as capacity, c_custkey % 3 = 0 as charging from customer where c_custkey % 9 <> 0"


@query(_GBFS)
def s19_station_feeds(spark, sf):
    k = F.col("c_custkey")
    station = F.struct(
        F.when(k % 9 != 0, k).alias("station_id"), F.col("c_name").alias("name"), (F.lit(40) + (k * 13 % 1_000_000) / 1_000_000).alias("lat"), (F.lit(-73) - (k * 7 % 1_000_000) / 1_000_000).alias("lon"),
        F.when(k % 4 != 0, F.col("c_nationkey").cast("string")).alias("region_id"), F.when(k % 6 != 0, k % 60).alias("capacity"), (k % 3 == 0).alias("is_charging"),
    )
    documents = table(spark, sf, "customer").groupBy("c_nationkey").agg(F.collect_list(station).alias("stations"))  # a document for each nation
    good, _ = mobility.stations_of(documents.select(F.to_json(F.struct(F.struct("stations").alias("data"))).alias("value")))
    return good.select("station_id", "name", "lat_e6", "lon_e6", "region", "capacity", "charging")


@query(f"with {a.LINES} select l_orderkey as way, max(concat('Street ', l_orderkey, ' é')) as name, count(*) as n, cast(sum(l_partkey) as bigint) as id_sum, cast(sum(407000000 + l_suppkey * 321) as bigint) as lat_sum, cast(sum(-739000000 - l_linenumber) as bigint) as lon_sum from lines group by 1")
def s20_way_lines(spark, sf):
    seven = lambda x: F.lpad(x.cast("string"), 7, "0")
    degrees = lambda e7: _text(F.floor(e7 / 10_000_000), ".", seven(e7 % 10_000_000))
    node = _text("n", F.col("l_partkey"), "x-", degrees(739_000_000 + F.col("l_linenumber")), "y", degrees(407_000_000 + F.col("l_suppkey") * 321))
    ways = a.lines(spark, sf).groupBy("l_orderkey").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("l_linenumber", node.alias("node")))), lambda x: x["node"]), ",").alias("nodes"))
    path = scratch_path(spark, "ways")
    ways.select(_text("w", F.col("l_orderkey"), " Thighway=residential,name=Street%20%", F.col("l_orderkey"), "%20%%e9% N", F.col("nodes"))).write.text(path)
    found = mobility.read_ways(spark, path).select("way", F.col("tags")["name"].alias("name"), F.explode("nodes").alias("v"))
    return found.groupBy("way", "name").agg(F.count("*").alias("n"), F.sum("v.id").alias("id_sum"), F.sum("v.lat_e7").alias("lat_sum"), F.sum("v.lon_e7").alias("lon_sum"))


@query("select concat('area ', s_suppkey) as name, case when s_suppkey % 2 = 0 then 2 else 1 end as rings, cast(case when s_suppkey % 2 = 0 then 10 else 5 end as bigint) as corners, cast(case when s_suppkey % 2 = 0 then 10 * s_suppkey + 20 else 5 * s_suppkey + 10 end as double) as x_sum from supplier")
def s21_area_sequence(spark, sf):
    k = F.col("s_suppkey")
    point = lambda x, y: F.array(x.cast("double"), y.cast("double"))
    ring = F.array(point(k, k), point(k + 5, k), point(k + 5, k + 5), point(k, k + 5), point(k, k))
    one = F.struct(F.lit("Polygon").alias("type"), F.array(ring).alias("coordinates"))
    two = F.struct(F.lit("MultiPolygon").alias("type"), F.array(F.array(ring), F.array(ring)).alias("coordinates"))
    feature = lambda geometry: F.to_json(F.struct(F.lit("Feature").alias("type"), F.struct(_text("area ", k).alias("name")).alias("properties"), geometry.alias("geometry")))
    path = scratch_path(spark, "areas")
    table(spark, sf, "supplier").select(F.concat(F.lit("\x1e"), F.when(k % 2 == 0, feature(two)).otherwise(feature(one)))).write.text(path)
    found = mobility.geojson_areas(spark, path, sequence=True)
    corners = F.flatten("rings")
    return found.select("name", F.size("rings").alias("rings"), F.size(corners).cast("bigint").alias("corners"), F.aggregate(corners, F.lit(0.0), lambda s, p: s + p["x"]).alias("x_sum"))


@query("select * from (values ('holiday', '2026-07-03', 'weekend'), ('holiday', '2026-11-27', 'weekday'), ('depot', 'D1', 'prefix'), ('depot', 'D2', 'exact'), ('month', '202512', ''), ('month', '202601', ''), ('refused', 'weekend day', ''), ('refused', 'repeated key', ''), ('refused', 'gap', '')) t(kind, name, value)")
def s22_s23_hand_kept_lists(spark, sf):
    rows = [("holiday", str(day), profile) for day, profile in mobility.holidays("date,name,profile\n20260703,Fourth,weekend\n20261127,Friday,weekday\n")]
    rows += [("depot", name, kind) for name, kind in mobility.depots("id,match,name,note\nD1,prefix,one,\nD2,exact,two,x\n")]
    rows += [("month", str(m), "") for m in mobility.month_list("202512-202601")]
    for name, call in (("weekend day", lambda: mobility.holidays("date,name,profile\n20260704,x,weekend\n")), ("repeated key", lambda: mobility.strict_json('{"a": 1, "a": 2}')), ("gap", lambda: mobility.month_list("202601,202603"))):
        try:
            call()
        except ValueError:
            rows.append(("refused", name, ""))
    return spark.createDataFrame(rows, "kind string, name string, value string")


# what is kept


@query("select c_custkey % 20 as source, case when c_custkey % 20 >= 15 then 'missing' when c_custkey % 5 = 0 then 'new' when c_custkey % 5 = 1 then 'unchanged' else 'stale' end as outcome, count(*) as n, count(distinct case when c_custkey % 20 < 15 or c_custkey % 5 = 0 then 1 end) as with_content from customer where not (c_custkey % 20 >= 15 and c_custkey % 5 = 0) group by all union all select c_custkey % 20, 'new', count(*), 1 from customer where c_custkey % 20 >= 15 and c_custkey % 5 = 0 group by all")
def s24_fetch_outcomes(spark, sf):
    k = F.col("c_custkey")
    c = table(spark, sf, "customer")
    cached = c.where("c_custkey % 20 < 15").select(k.cast("string").alias("url"), F.lit("e1").alias("etag"), F.sha2(k.cast("string"), 256).alias("sha256"))
    status = F.when(k % 5 == 0, 200).when(k % 5 == 1, 304).when(k % 5 == 2, 500).when(k % 5 == 3, 200)
    answers = c.select(k.cast("string").alias("url"), status.alias("status"), F.lit("e2").alias("etag"), F.sha2(F.col("c_name"), 256).alias("sha256"), (k % 5 != 3).alias("valid"))
    found = versions.fetch_outcomes(cached, answers)
    return found.groupBy((F.col("url").cast("bigint") % 20).alias("source"), "outcome").agg(F.count("*").alias("n"), F.count_distinct(F.when(F.col("sha256").isNotNull(), 1)).alias("with_content"))


_VERSIONS = """v as (select concat('feed', o_custkey % 7) as feed, sha256(cast(o_orderkey % 900 as varchar)) as sha256, cast(o_orderdate as date) as published, cast(o_orderdate as date) as first, cast(o_orderdate as date) + cast(o_orderkey % 30 as integer) as last, o_orderkey from orders),
held as (select feed, sha256, min(struct_pack(published, first, last)) as m from v where o_orderkey % 3 = 0 group by all), fresh as (select feed, sha256, min(struct_pack(published, first, last)) as m from v where o_orderkey % 3 <> 0 group by all),
allv as (select feed, sha256, m, false as added from held union all select feed, sha256, m, true from fresh f where not exists (select 1 from held h where h.feed = f.feed and h.sha256 = f.sha256)),
arch as (select feed, concat(feed, '/', strftime(m.published, '%Y%m%d'), '/', substr(sha256, 1, 16)) as key, sha256, m.published as published, m.first as first, m.last as last, added from allv)"""


def _versions(spark, sf):
    k, day = F.col("o_orderkey"), F.col("o_orderdate").cast("date")
    v = table(spark, sf, "orders").select(_text("feed", F.col("o_custkey") % 7).alias("feed"), F.sha2((k % 900).cast("string"), 256).alias("sha256"), day.alias("published"), day.alias("first"), F.date_add(day, (k % 30).cast("int")).alias("last"), k)
    empty = spark.createDataFrame([], "feed string, key string, sha256 string, published date, first date, last date")
    held = versions.add_versions(empty, v.where("o_orderkey % 3 = 0")).drop("added")
    return versions.add_versions(held, v.where("o_orderkey % 3 <> 0"))


@query(f"with {_VERSIONS} select * from arch")
def s25_version_archive(spark, sf):
    return _versions(spark, sf)


@query(f"with {_VERSIONS}, n as (select feed, max(struct_pack(published, key)) as top from arch group by 1) select a.feed, a.key from arch a join n on n.feed = a.feed where a.last < date '1998-01-01' - 200 and a.key <> n.top.key")
def s25_expired_versions(spark, sf):
    return versions.expired_versions(_versions(spark, sf), F.lit("1998-01-01").cast("date"), 200)


@query("select l_returnflag as flag, l_linenumber as line, count(*) as n, cast(sum(l_partkey) as bigint) as total from lineitem group by all")
def s26_s27_tables(spark, sf):
    path = scratch_path(spark, "table")
    rows = table(spark, sf, "lineitem").select("l_orderkey", F.col("l_linenumber").alias("line"), "l_partkey", F.col("l_returnflag").alias("flag"))
    mobility.write_table(rows, path, ["flag"])
    back = mobility.read_table(spark, path, {"flag": "string", "line": "int", "l_partkey": "bigint"})
    return back.groupBy("flag", "line").agg(F.count("*").alias("n"), F.sum("l_partkey").alias("total"))


@query("select (select count(*) from nation) as nations, (select count(*) from lineitem) as lines, (select cast(max(o_orderdate) as date) from orders) as newest")
def s29_json_report(spark, sf):
    newest = table(spark, sf, "orders").agg(F.max("o_orderdate").cast("date").alias("d")).first()["d"]
    path = scratch_path(spark, "report") + ".json"
    mobility.write_report({"nations": table(spark, sf, "nation").count(), "lines": table(spark, sf, "lineitem").count(), "newest": newest}, path, spark)
    found = spark.read.json(path, "nations bigint, lines bigint, newest date", multiLine=True)
    return found.select("nations", "lines", "newest")


@query("select doc_id, sha256(text) as content, true as same from documents")
def s28_xz_round_trip(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", F.col("text").cast("binary").alias("data"))
    back = d.select("doc_id", "data", blobs.unxz(blobs.xz(F.col("data"))).alias("back"))
    return back.select("doc_id", F.sha2("back", 256).alias("content"), (F.col("back") == F.col("data")).alias("same"))


@query("select concat('blob', c_custkey) as name, case when c_custkey % 8 = 0 then 'missing' when c_custkey % 8 = 1 then 'wrong size' when c_custkey % 8 = 2 then 'does not unpack' when c_custkey % 8 = 3 then 'wrong content' else 'ok' end as status from customer")
def q7_blob_integrity(spark, sf):
    k, name = F.col("c_custkey"), _text("blob", F.col("c_custkey"))
    c = table(spark, sf, "customer").select(k, name.alias("name"), F.col("c_name").cast("binary").alias("data"))
    path = scratch_path(spark, "blobs")  # packed once, then both recorded and stored
    c.repartition(int(spark.conf.get("spark.sql.shuffle.partitions"))).withColumn("blob", blobs.xz(F.col("data"))).write.parquet(path)
    packed = spark.read.parquet(path)
    recorded = packed.select("name", (F.length("blob") + F.when(k % 8 == 1, 1).otherwise(0)).alias("size"), F.sha2(F.when(k % 8 == 3, F.lit("other").cast("binary")).otherwise(F.col("data")), 256).alias("sha256"))
    cut = F.concat(F.expr("substring(blob, 1, length(blob) - 4)"), F.lit("cut!").cast("binary"))
    return blobs.blob_problems(recorded, packed.where("c_custkey % 8 <> 0").select("name", F.when(k % 8 == 2, cut).otherwise(F.col("blob")).alias("blob")))


# fields and calendars that have no query elsewhere

_DAYS = """d as (select distinct date '2024-01-01' + cast(o_orderkey % 2500 as integer) as day from orders), y as (select day, make_date(year(day), 3, 8) as m, make_date(year(day), 11, 1) as n from d),
z as (select day, m + cast((7 - isodow(m)) % 7 as integer) as spring, n + cast((7 - isodow(n)) % 7 as integer) as autumn from y)"""


@query(f"with {_DAYS} select day, cast(epoch(day::timestamp) as bigint) + case when day >= spring and day < autumn then 4 else 5 end * 3600 as origin from z")
def f8_service_day_origin(spark, sf):
    days = table(spark, sf, "orders").select(F.date_add(F.lit("2024-01-01").cast("date"), (F.col("o_orderkey") % 2500).cast("int")).alias("day")).distinct()
    return days.select("day", fields.service_seconds_origin(F.col("day")).alias("origin"))


@query(f"with {_DAYS}, t as (select z.*, day::timestamp + to_minutes(cast(h * 30 as integer)) as local from z, range(0, 8) r(h)) select local, cast(epoch(local) as bigint) + case when local >= spring::timestamp + interval 3 hour and local < autumn::timestamp + interval 2 hour then 4 else 5 end * 3600 as seconds from t")
def f8_gaps_and_overlaps(spark, sf):
    days = table(spark, sf, "orders").select(F.date_add(F.lit("2024-01-01").cast("date"), (F.col("o_orderkey") % 2500).cast("int")).alias("day")).distinct()
    local = days.select(F.explode(F.sequence(F.col("day").cast("timestamp"), F.col("day").cast("timestamp") + F.expr("interval 210 minutes"), F.expr("interval 30 minutes"))).alias("local"))
    return local.select(F.col("local").cast("timestamp_ntz").alias("local"), fields.local_epoch(F.col("local")).alias("seconds"))


_MIX = "(((({z})::uhugeint * {k}::uhugeint) % 18446744073709551616::uhugeint)::ubigint)"


def _mixed_sql() -> str:
    step = f"((s::uhugeint + (n::uhugeint * {0x9E3779B97F4A7C15}::uhugeint) % 18446744073709551616::uhugeint) % 18446744073709551616::uhugeint)::ubigint"
    return f"""with r as (select p_partkey, (p_size * 7919)::ubigint as s, (p_partkey % 1000 + 1)::ubigint as n from part), a as (select *, {step} as z from r), b as (select *, {_MIX.format(z="xor(z, z >> 30)", k=0xBF58476D1CE4E5B9)} as y from a),
c as (select *, {_MIX.format(z="xor(y, y >> 27)", k=0x94D049BB133111EB)} as x from b) select p_partkey, cast(xor(x, x >> 31) as varchar) as number from c"""


@query(_mixed_sql())
def f34_split_mix(spark, sf):
    p = table(spark, sf, "part")
    number = fields.split_mix(F.col("p_size") * 7919, F.col("p_partkey") % 1000 + 1)
    unsigned = F.when(F.col("z") < 0, F.col("z").cast("decimal(20,0)") + F.lit(str(2**64)).cast("decimal(20,0)")).otherwise(F.col("z").cast("decimal(20,0)"))
    return p.select("p_partkey", number.alias("z")).select("p_partkey", unsigned.cast("string").alias("number"))


@query("""with w as (select p_partkey, [struct_pack(weekdays := case when p_partkey % 2 = 0 then [1, 2, 5] else [3] end, "start" := cast(p_size as integer), "end" := cast(p_size + 600 as integer)), struct_pack(weekdays := [6, 7], "start" := 600, "end" := 1440)] as w from part where p_partkey % 5 <> 0)
select p_partkey, i - 1 as place, array_to_string(list_sort(w)[i].weekdays, ',') as weekdays, list_sort(w)[i]."start" as first, list_sort(w)[i]."end" as last from w, (values (1), (2)) t(i)""")
def f36_valet_windows(spark, sf):
    k, size = F.col("p_partkey"), F.col("p_size").cast("bigint")
    two = lambda x: F.lpad(x.cast("string"), 2, "0")
    clock = lambda m: _text(two(F.floor(m / 60)), ":", two(m % 60))
    cell = F.when(k % 5 == 0, "").otherwise(_text("76 10:00-24:00|", F.when(k % 2 == 0, "215").otherwise("3"), " ", clock(size), "-", clock(size + 600)))
    found = table(spark, sf, "part").select("p_partkey", F.posexplode(fields.valet_windows(cell)).alias("place", "w"))
    return found.select("p_partkey", F.col("place").cast("bigint").alias("place"), F.concat_ws(",", F.transform("w.weekdays", lambda d: d.cast("string"))).alias("weekdays"), F.col("w.start").alias("first"), F.col("w.end").alias("last"))


@query("select p_partkey, array_to_string(list_sort(string_split(p_type, ' ')), '/') as keywords from part")
def f36_keyword_lists(spark, sf):
    return table(spark, sf, "part").select("p_partkey", F.array_join(fields.keyword_list(F.translate("p_type", " ", "|")), "/").alias("keywords"))


@query(f"with {a.RULES} select rule, greatest(first, date '1995-03-01') as first, least(last, date '1995-03-01' + 799) as last from rules where greatest(first, date '1995-03-01') <= least(last, date '1995-03-01' + 799)")
def p5_clipped_rules(spark, sf):
    return calendar.clip(a.rules(spark, sf), F.lit("1995-03-01").cast("date"), 800).select("rule", "first", "last")


@query("select p_partkey, row_number() over (order by p_name, p_size desc, p_partkey) - 1 as place from part")
def t10_canonical_order(spark, sf):
    return numbered(table(spark, sf, "part"), [F.col("p_name"), F.col("p_size").desc(), F.col("p_partkey")], "place").select("p_partkey", "place")


@query("""with t as (select event_id, concat('st', user_id) as a, case when event_id % 7 = 0 then '' else concat('en', event_id % 50) end as b, ts, ts + interval 10 minute as later, case when event_id % 3 = 0 then 'ebike' else 'classic' end as bike from events where event_id % 3 < 2),
e as (select a as id, ts as at_, bike, 'departures' as direction from t union all select b, later, bike, 'arrivals' from t) select id, cast(at_ as date) as day, cast((hour(at_) * 60 + minute(at_)) // 15 as integer) as bin, bike, direction, count(*) as n from e where id <> '' group by all""")
def s2_9_trip_stream(spark, sf):
    """Monthly files as a stream, in two runs of one checkpoint: the second finds only what is new."""
    e = table(spark, sf, "events").where("event_id % 3 < 2")
    k, fmt = F.col("event_id"), "yyyy-MM-dd HH:mm:ss"
    rows = e.select(
        F.when(k % 3 == 0, "electric_bike").otherwise("classic_bike").alias("rideable_type"), F.date_format("ts", fmt).alias("started_at"), F.date_format(F.col("ts") + F.expr("interval 10 minutes"), fmt).alias("ended_at"),
        _text("st", F.col("user_id")).alias("start_station_id"), F.when(k % 7 == 0, "").otherwise(_text("en", k % 50)).alias("end_station_id"), F.lit("a").alias("start_station_name"), F.lit("b").alias("end_station_name"), k,
    )
    folder, target, checkpoint = (scratch_path(spark, n) for n in ("arriving", "counts", "stream"))
    for part in (0, 1):
        rows.where(k % 2 == part).drop("event_id").write.mode("append").option("header", True).csv(folder)
        trip_stream.start_incremental(trip_stream.read_trip_stream(spark, folder), target, checkpoint).awaitTermination()
    return trip_stream.read_counts(spark, target)
