"""Queries on places, streets, links and graphs."""

from __future__ import annotations

from pyspark.sql import functions as F

from metrolith.functions import fields, geo, street_rules
from metrolith.functions.half import from_half, to_half
from metrolith.operators import areas, graph, links, stations, timetable
from metrolith.plans import adapters as a
from metrolith.plans.registry import query, table
from metrolith.session import checkpoint_root

_AREA = "lat_e6 between 40710000 and 40750000"


@query(f"""with {a.STATIONS}, r as (select *, case when region is not null and region not in ('171', '172', '175', '180', '189') then 'region' when region is null and not ({_AREA}) then 'area' when capacity <= 0 then 'capacity' end as first_reason from stations),
n as (select *, row_number() over (partition by station_id, first_reason is null order by ord) as nth from r) select coalesce(first_reason, case when nth > 1 then 'repeated' end, 'kept') as reason, count(*) as n, cast(sum(ord) as bigint) as ord_sum from n group by 1""")
def p1_station_selection(spark, sf):
    inside = F.col("lat_e6").between(40_710_000, 40_750_000)
    found = stations.select_stations(a.stations(spark, sf), ["171", "172", "175", "180", "189"], inside)
    return found.groupBy(F.coalesce("reason", F.lit("kept")).alias("reason")).agg(F.count("*").alias("n"), F.sum("ord").alias("ord_sum"))


@query(f"with {a.STATIONS}, f as (select distinct cast(user_id as varchar) as key from events) select s.ord, s.station_id, f.key as row_key from stations s left join f on f.key = s.station_id")
def j4_station_flow_rows(spark, sf):
    keys = table(spark, sf, "events").select(F.col("user_id").cast("string").alias("row_key")).distinct()
    return a.stations(spark, sf).join(keys, F.col("station_id") == F.col("row_key"), "left").select("ord", "station_id", "row_key")


_POINTS = "pts as (select c_custkey as point, cast(c_custkey * 7919 % 30000 as integer) as x, cast(c_custkey * 104729 % 30000 as integer) as y, c_name as name from customer)"


def _points(spark, sf):
    key = F.col("c_custkey")
    return table(spark, sf, "customer").select(key.alias("point"), (key * 7_919 % 30_000).cast("int").alias("x"), (key * 104_729 % 30_000).cast("int").alias("y"), F.col("c_name").alias("name"))


@query(f"with {_POINTS} select a.point, b.point as other, (a.x - b.x)::bigint * (a.x - b.x) + (a.y - b.y)::bigint * (a.y - b.y) as square from pts a, pts b where a.point <> b.point and (a.x - b.x)::bigint * (a.x - b.x) + (a.y - b.y)::bigint * (a.y - b.y) <= 500 * 500")
def j10_within_radius(spark, sf):
    return stations.within(_points(spark, sf), _points(spark, sf), 500)


_SEGMENTS = "seg as (select s_suppkey as segment, (s_suppkey * 331 % 3000)::double as ax, (s_suppkey * 577 % 3000)::double as ay, (s_suppkey * 331 % 3000 + s_suppkey % 40 * 8 - 150)::double as bx, (s_suppkey * 577 % 3000 + 128)::double as by2 from supplier)"


def _segments(spark, sf):
    k = F.col("s_suppkey")
    return table(spark, sf, "supplier").select(
        k.alias("segment"), (k * 331 % 3000).cast("double").alias("ax"), (k * 577 % 3000).cast("double").alias("ay"), (k * 331 % 3000 + k % 40 * 8 - 150).cast("double").alias("bx"), (k * 577 % 3000 + 128).cast("double").alias("by")
    )


@query(f"""with {_POINTS}, {_SEGMENTS}, p as (select point, (x / 10)::double as x, (y / 10)::double as y from pts), j as (select point, segment, x, y, ax, ay, bx, by2, greatest(0.0, least(1.0, case when (bx - ax) * (bx - ax) + (by2 - ay) * (by2 - ay) > 0 then ((x - ax) * (bx - ax) + (y - ay) * (by2 - ay)) / ((bx - ax) * (bx - ax) + (by2 - ay) * (by2 - ay)) else 0 end)) as t from p, seg),
d as (select point, segment, t, sqrt((x - (ax + t * (bx - ax))) * (x - (ax + t * (bx - ax))) + (y - (ay + t * (by2 - ay))) * (y - (ay + t * (by2 - ay)))) as apart from j)
select point, segment, cast(round(apart * 1000) as bigint) as mm, row_number() over (partition by point order by cast(round(apart * 1000) as bigint), segment) as rank from d where apart <= 150 qualify rank <= 2""")
def j11_snap_to_segments(spark, sf):
    points = _points(spark, sf).select("point", (F.col("x") / 10).alias("x"), (F.col("y") / 10).alias("y"))
    return stations.snap(points, _segments(spark, sf), 150.0, count=2).select("point", "segment", "mm", "rank")


@query(f"""with recursive {a.STATIONS}, walk as (select ord, cast((lon_e6 + 74000000) // 4 as bigint) as x, cast((lat_e6 - 40700000) // 4 as bigint) as y, 0::bigint as d, 32768::bigint as s from stations
union all select ord, case when ry = 0 then (case when rx = 1 then 2 * s - 1 - y else y end) else x end & (s - 1), case when ry = 0 then (case when rx = 1 then 2 * s - 1 - x else x end) else y end & (s - 1), d + s * s * xor(3 * rx, ry), s // 2
from (select *, case when x & s > 0 then 1::bigint else 0 end as rx, case when y & s > 0 then 1::bigint else 0 end as ry from walk where s > 0)) select ord, d as curve from walk where s = 0""")
def f25_t4_hilbert_order(spark, sf):
    return stations.hilbert_order(a.stations(spark, sf), 40_700_000, -74_000_000, 4).select("ord", "curve")


_PAIRS = "pair as (select c_custkey as id, 40.5 + (c_custkey % 1000) / 4096 as lat1, -74.25 + (c_custkey % 700) / 2048 as lon1, 40.5 + (c_custkey * 7 % 1000) / 4096 as lat2, -74.25 + (c_custkey * 13 % 700) / 2048 as lon2 from customer)"


def _pairs(spark, sf):
    k = F.col("c_custkey")
    return table(spark, sf, "customer").select(
        k.alias("id"), (40.5 + (k % 1000) / 4096).alias("lat1"), (-74.25 + (k % 700) / 2048).alias("lon1"), (40.5 + (k * 7 % 1000) / 4096).alias("lat2"), (-74.25 + (k * 13 % 700) / 2048).alias("lon2")
    )


@query(f"""with {_PAIRS}, h as (select id, sin(radians(lat2 - lat1) / 2) as u, sin(radians(lon2 - lon1) / 2) as v, cos(radians(lat1)) * cos(radians(lat2)) as c from pair)
select id, cast(round(2 * 6371008.8 * asin(least(1.0, sqrt(u * u + c * v * v)))) as bigint) as metres from h""")
def f19_haversine(spark, sf):
    return _pairs(spark, sf).select("id", F.round(geo.haversine(F.col("lat1"), F.col("lon1"), F.col("lat2"), F.col("lon2"))).cast("bigint").alias("metres"))


@query(f"""with {_PAIRS}, b as (select id, degrees(atan2(sin(radians(lon2 - lon1)) * cos(radians(lat2)), cos(radians(lat1)) * sin(radians(lat2)) - sin(radians(lat1)) * cos(radians(lat2)) * cos(radians(lon2 - lon1)))) as d from pair),
n as (select id, case when d < 0 then d + 360 when d >= 360 then d - 360 else d end as d from b) select id, cast(round(d, 3) * 1000 as bigint) as milli, cast(round(d / 360 * 256) as integer) % 256 as code from n""")
def f20_f26_bearings(spark, sf):
    turn = geo.bearing(F.col("lat1"), F.col("lon1"), F.col("lat2"), F.col("lon2"))
    return _pairs(spark, sf).select("id", F.round(F.round(turn, 3) * 1000).cast("bigint").alias("milli"), geo.bearing_code(turn).alias("code"))


@query(f"with {_PAIRS} select id, cast(round(radians(lon2 - lon1) * cos(radians(lat1)) * 6371008.8 * 100) as bigint) as x_cm, cast(round(radians(lat2 - lat1) * 6371008.8 * 100) as bigint) as y_cm, cast(round(lat2 * 1e6) as bigint) as back_lat, cast(round(lon2 * 1e6) as bigint) as back_lon from pair")
def f21_local_projection(spark, sf):
    x, y = geo.project(F.col("lat2"), F.col("lon2"), F.col("lat1"), F.col("lon1"))
    rows = _pairs(spark, sf).withColumn("x", x).withColumn("y", y)
    lat, lon = geo.unproject(F.col("x"), F.col("y"), F.col("lat1"), F.col("lon1"))
    cm = lambda c: F.round(F.col(c) * 100).cast("bigint")
    return rows.select("id", cm("x").alias("x_cm"), cm("y").alias("y_cm"), F.round(lat * 1e6).cast("bigint").alias("back_lat"), F.round(lon * 1e6).cast("bigint").alias("back_lon"))


@query(f"with {_POINTS}, j as (select point, x, y, (point * 331 % 30000)::double as ax, (point * 577 % 30000)::double as ay, (point * 331 % 30000 + point % 40 * 800 - 15000)::double as bx, (point * 577 % 30000 + 1280)::double as by2 from pts), r as (select point, ((x - ax) * (bx - ax) + (y - ay) * (by2 - ay)) / ((bx - ax) * (bx - ax) + (by2 - ay) * (by2 - ay)) as raw from j) select point, cast(round(greatest(0.0, least(1.0, raw)) * 1000000) as bigint) as micro from r")
def f22_point_on_segment(spark, sf):
    k = F.col("point")
    own = _points(spark, sf).select("point", "x", "y", (k * 331 % 30_000).cast("double").alias("ax"), (k * 577 % 30_000).cast("double").alias("ay"), (k * 331 % 30_000 + k % 40 * 800 - 15_000).cast("double").alias("bx"), (k * 577 % 30_000 + 1_280).cast("double").alias("by"))
    t, _ = geo.segment_projection(F.col("x"), F.col("y"), F.col("ax"), F.col("ay"), F.col("bx"), F.col("by"))
    return own.select("point", F.round(t * 1_000_000).cast("bigint").alias("micro"))


@query(f"with {_POINTS} select point, (x between 1001 and 20000 and y between 1001 and 20000 and not (x between 5001 and 9000 and y between 5001 and 9000)) as inside from (select point, x + 0.5 as x, y + 0.5 as y from pts)")
def f23_point_in_polygon(spark, sf):
    ring = lambda low, high: F.array(*[F.struct(F.lit(float(x)).alias("x"), F.lit(float(y)).alias("y")) for x, y in ((low, low), (high, low), (high, high), (low, high))])
    rings = F.array(ring(1_001, 20_000), ring(5_001, 9_000))
    return _points(spark, sf).select("point", geo.in_rings(F.col("x") + F.lit(0.5), F.col("y") + F.lit(0.5), rings).alias("inside"))


@query(f"with {_POINTS} select point, true as same from pts")
def f24_polyline_round_trip(spark, sf):
    k = F.col("point")
    rows = _points(spark, sf).select("point", F.array(k / 64, k / 32 - 90, -k / 128).alias("lats"), F.array(-k / 16, k / 256, k / 8).alias("lons"))
    text = rows.withColumn("text", geo.polyline_of("lats", "lons")).withColumn("back", geo.polyline_points("text"))
    near = lambda c, want: F.forall(F.zip_with(F.transform("back", lambda p: p[c]), want, lambda x, y: F.abs(x - y) <= 0.0000051), lambda ok: ok)
    return text.select("point", (near("lat", F.col("lats")) & near("lon", F.col("lons"))).alias("same"))


@query("select p_partkey, p_size % 64 as value_back from part")
def f29_half_cells(spark, sf):
    rows = table(spark, sf, "part").select("p_partkey", (F.col("p_size") % 64).cast("double").alias("v"))
    return rows.select("p_partkey", from_half(to_half("v")).cast("int").alias("value_back"))


@query("select l_orderkey, l_linenumber, l_partkey, (l_partkey * 10000 + 4469) // 4470 as seconds, least(cast(l_partkey as bigint) * 4000000 + 5, 4294967294) as total from lineitem")
def f30_f31_ride_seconds_and_costs(spark, sf):
    line = table(spark, sf, "lineitem")
    return line.select("l_orderkey", "l_linenumber", "l_partkey", fields.ride_seconds(F.col("l_partkey"), 4_470).alias("seconds"), fields.add_cost(F.col("l_partkey") * 4_000_000, F.lit(5)).alias("total"))


@query("""with e as (select p_partkey, p_size * 8 as dm, p_partkey % 5 <> 0 as walk, p_partkey % 7 = 0 as stairs, p_partkey % 3 <> 0 as ride, p_partkey % 11 = 0 as dismount, ['protected', 'painted', 'shared', 'arterial'][p_partkey % 4 + 1] as class from part)
select p_partkey, case when walk then cast(round(dm * (100 / (3.5::double * 0.44704::double)) * case when stairs then 2.0 else 1.0 end) as bigint) end as walk_ms,
case when ride then cast(round(dm * case when dismount then 100 / (3.0::double * 0.44704::double) else [0.8, 0.9, 1.0, 1.3][p_partkey % 4 + 1]::double * 100 / (10.0::double * 0.44704::double) end) as bigint) end as bike_ms from e""")
def f33_edge_costs(spark, sf):
    k = F.col("p_partkey")
    kind = F.element_at(F.array(*map(F.lit, ("protected", "painted", "shared", "arterial"))), (k % 4 + 1).cast("int"))
    rows = table(spark, sf, "part").withColumn("dm", F.col("p_size") * 8)
    return rows.select("p_partkey", fields.walk_cost(F.col("dm"), k % 5 != 0, k % 7 == 0).alias("walk_ms"), fields.bike_cost(F.col("dm"), k % 3 != 0, k % 11 == 0, kind).alias("bike_ms"))


# the rules for ways that have only these tags, one case after another
_STREET = """with t as (select p_partkey, list_value({routed}, 'motorway', 'construction')[p_partkey % 22 + 1] as highway, [null, 'yes', '-1', null, 'reversible'][p_partkey // 3 % 5 + 1] as oneway, [null, 'yes', 'no', null, 'designated', null][p_partkey // 5 % 6 + 1] as bicycle, [null, null, 'no', 'yes'][p_partkey // 7 % 4 + 1] as foot,
  [null, null, null, 'private'][p_partkey // 11 % 4 + 1] as access, [null, 'lane', null, 'track', 'opposite_lane', 'shared_lane'][p_partkey // 13 % 6 + 1] as lane, [null, null, null, 'sidewalk', 'crossing'][p_partkey // 17 % 5 + 1] as footway, [null, 'Main St', null][p_partkey // 19 % 3 + 1] as own_name, [null, null, 'yes'][p_partkey // 23 % 3 + 1] as over from part),
u as (select *, case when highway in ('motorway', 'construction') then 'not routed' end as first_drop, footway is not null as on_side, coalesce(bicycle in ('yes', 'designated'), false) as may_ride, access is not null as shut, case oneway when 'yes' then 1 when '-1' then -1 when 'reversible' then 2 else 0 end as road, coalesce(lane like 'opposite%', false) as counter, over is not null as bridge from t),
v as (select *, first_drop is null and not on_side and coalesce(foot, '') <> 'no' and (not shut or coalesce(foot, '') = 'yes') as walk,
  first_drop is null and highway <> 'steps' and coalesce(bicycle, '') <> 'no' and not (shut and not may_ride) and (highway not in ('trunk', 'trunk_link', 'footway', 'path', 'pedestrian', 'bridleway') or may_ride) and (not on_side or highway = 'cycleway' or may_ride) as rides,
  case when counter and road in (1, -1) then 0 else road end as bike_way, case when counter then case when road = -1 then 1 else -1 end when road in (1, -1) then road else 0 end as serves, case when lane = 'track' then 0 when lane in ('lane', 'opposite_lane') then 1 when lane = 'shared_lane' then 2 else 3 end as side_class,
  case when highway in ('cycleway', 'footway', 'path', 'track', 'bridleway') then 0 when highway like 'trunk%' or highway like 'primary%' or highway like 'secondary%' or highway like 'tertiary%' then 3 else 2 end as base from u),
w as (select *, rides and bike_way in (0, 1) as forward, rides and bike_way in (0, -1) as backward from v),
x as (select *, first_drop is null and not walk and not forward and not backward as useless, ['protected', 'painted', 'shared', 'arterial'] as classes,
  case when highway = 'service' then 'service road' when bridge and highway in ('footway', 'path', 'cycleway', 'pedestrian', 'steps', 'track', 'bridleway') then 'bridge path' when highway = 'footway' then 'footpath' when highway = 'path' then 'path' when highway = 'cycleway' then 'bike path' when highway = 'steps' then 'steps' when highway = 'pedestrian' then 'pedestrian street' when highway = 'track' then 'track' when highway = 'bridleway' then 'bridle path' else 'road' end as label from w)
select p_partkey, coalesce(first_drop, case when useless and on_side then 'sidewalk' when useless then 'no access' end) as "drop", walk, forward as bike_forward, backward as bike_backward, case when forward then classes[least(case when serves in (0, 1) then side_class else 3 end, base) + 1] end as class_forward,
case when backward then classes[least(case when serves in (0, -1) then side_class else 3 end, base) + 1] end as class_backward, bridge, highway = 'steps' as stairs, case when first_drop is null then coalesce(own_name, label) end as name, case when first_drop is null then case when own_name is not null then 'name' else 'label' end end as name_kind, on_side as sidewalk from x""".replace("{routed}", ", ".join(f"'{v}'" for v in street_rules.ROUTED))


@query(_STREET)
def f35_p8_street_rules(spark, sf):
    k = F.col("p_partkey")
    pick = lambda values, by: F.element_at(F.array(*[F.lit(v) for v in values]), (by % len(values) + 1).cast("int"))
    pairs = {
        "highway": pick(street_rules.ROUTED + ("motorway", "construction"), k),
        "oneway": pick((None, "yes", "-1", None, "reversible"), F.floor(k / 3)),
        "bicycle": pick((None, "yes", "no", None, "designated", None), F.floor(k / 5)),
        "foot": pick((None, None, "no", "yes"), F.floor(k / 7)),
        "access": pick((None, None, None, "private"), F.floor(k / 11)),
        "cycleway": pick((None, "lane", None, "track", "opposite_lane", "shared_lane"), F.floor(k / 13)),
        "footway": pick((None, None, None, "sidewalk", "crossing"), F.floor(k / 17)),
        "name": pick((None, "Main St", None), F.floor(k / 19)),
        "bridge": pick((None, None, "yes"), F.floor(k / 23)),
    }
    entries = F.filter(F.array(*[F.struct(F.lit(n).alias("key"), v.alias("value")) for n, v in pairs.items()]), lambda e: e["value"].isNotNull())
    tagged = table(spark, sf, "part").select("p_partkey", F.map_from_entries(entries).alias("tags"))
    return tagged.select("p_partkey", *[c.alias(n) for n, c in street_rules.classify(F.col("tags")).items()])


# links

_TRANSFERS = """tr as (select l_suppkey % 40 as from_stop, l_partkey % 40 as to_stop, cast(l_linenumber % 4 as integer) as kind, case when l_partkey % 2 = 0 then l_partkey % 400 end as seconds, cast(l_suppkey * 3 as bigint) as walk, l_orderkey % 20 = 0 as trip_specific from lineitem),
pf as (select s_suppkey % 40 as station, 1000 + s_suppkey as platform from supplier)"""


def _transfers(spark, sf):
    line = table(spark, sf, "lineitem")
    rows = line.select((F.col("l_suppkey") % 40).alias("from_stop"), (F.col("l_partkey") % 40).alias("to_stop"), (F.col("l_linenumber") % 4).alias("kind"), F.when(F.col("l_partkey") % 2 == 0, F.col("l_partkey") % 400).alias("seconds"), (F.col("l_suppkey") * 3).alias("walk"), (F.col("l_orderkey") % 20 == 0).alias("trip_specific"))
    platforms = table(spark, sf, "supplier").select((F.col("s_suppkey") % 40).alias("station"), (F.col("s_suppkey") + 1000).alias("platform"))
    return rows, platforms


@query(f"with {_TRANSFERS} select a.platform as a, b.platform as b, cast(min(greatest(30, coalesce(seconds, walk))) as bigint) as seconds from tr join pf a on a.station = tr.from_stop join pf b on b.station = tr.to_stop where not trip_specific and kind <> 3 and from_stop <> to_stop and a.platform <> b.platform group by all")
def j5_platform_transfers(spark, sf):
    return links.station_transfers(*_transfers(spark, sf))


@query("with e as (select l_suppkey as a, l_partkey % 100 as b, l_linenumber * 10 + l_orderkey % 7 as seconds from lineitem), u as (select * from e union all select b, a, seconds from e) select a, b, cast(min(seconds) as bigint) as seconds from u where a <> b group by all")
def j6_fixed_transfers(spark, sf):
    line = table(spark, sf, "lineitem")
    return links.both_ways(line.select(F.col("l_suppkey").alias("a"), (F.col("l_partkey") % 100).alias("b"), (F.col("l_linenumber") * 10 + F.col("l_orderkey") % 7).alias("seconds")))


@query("""with s as (select s_suppkey as stop, case when s_suppkey % 3 <> 0 then s_suppkey % 20 end as parent from supplier), e as (select distinct s_suppkey % 10 as station, 5000 + s_suppkey as entrance from supplier)
select s.stop, coalesce(e.entrance, s.parent, s.stop) as access, case when e.entrance is not null then 'entrance' when s.parent is not null then 'station' else 'stop' end as basis from s left join e on e.station = coalesce(s.parent, s.stop)""")
def j7_access_points(spark, sf):
    s = table(spark, sf, "supplier")
    stops = s.select(F.col("s_suppkey").alias("stop"), F.when(F.col("s_suppkey") % 3 != 0, F.col("s_suppkey") % 20).alias("parent"))
    return links.access_points(stops, s.select((F.col("s_suppkey") % 10).alias("station"), (F.col("s_suppkey") + 5000).alias("entrance")).distinct())


@query(f"with {_TRANSFERS} select a.platform as a, b.platform as b, cast(30 as integer) as seconds from pf a join pf b on a.station = b.station where a.platform <> b.platform")
def g16_station_platform_pairs(spark, sf):
    return links.platform_pairs(_transfers(spark, sf)[1], 30)


_RIDES = f"""{a.LINES}, ev as (select l_orderkey as trip, l_linenumber as pos, l_suppkey % 30 as parent, (l_orderkey * 577) % 72000 + l_linenumber * 600 as arrival, (l_orderkey * 577) % 72000 + l_linenumber * 600 + 45 as departure, l_partkey % 5 <> 0 as b, l_partkey % 6 <> 0 as al from lines),
rides as (select x.trip, x.parent as a, y.parent as b, y.arrival - x.departure as ride, x.departure between 36000 and 57599 as midday from ev x join ev y on x.trip = y.trip and x.pos < y.pos where x.b and y.al and x.parent <> y.parent),
by_trip as (select trip, a, b, min(ride) filter (where midday) as midday, min(ride) as day from rides group by all), seat as (select a, b, count(midday) as trips, min(midday) as midday_least, min(day) as day_least from by_trip group by all)"""


def _rides(spark, sf):
    line = a.lines(spark, sf)
    start = (F.col("l_orderkey") * 577) % 72_000 + F.col("l_linenumber") * 600
    return links.one_seat(line.select(F.col("l_orderkey").alias("trip"), F.col("l_linenumber").alias("pos"), (F.col("l_suppkey") % 30).alias("parent"), start.alias("arrival"), (start + 45).alias("departure"), (F.col("l_partkey") % 5 != 0).alias("may_board"), (F.col("l_partkey") % 6 != 0).alias("may_alight")))


@query(f"with {_RIDES} select a, b, trips, midday_least, day_least from seat")
def j15_a19_one_seat_rides(spark, sf):
    return _rides(spark, sf)


_HOP = f"""{_RIDES}, pk as (select s_suppkey % 30 as parent, s_suppkey as station, 60 + s_suppkey * 7 % 200 as seconds from supplier union all select (s_suppkey + 1) % 30, s_suppkey, 90 + s_suppkey * 11 % 150 from supplier where s_suppkey % 2 = 0),
ds as (select distinct l_suppkey as origin, l_partkey % 100 + 1 as dest, 20 + (l_suppkey * 31 + (l_partkey % 100 + 1) * 17) % 900 as decameters from lineitem),
tu as (select p.parent as a, q.parent as b, p.station as u, q.station as d, p.seconds as us, q.seconds as ds, decameters, p.seconds + q.seconds + 150 + (decameters * 10000 + 4469) // 4470 as total from pk p join ds on ds.origin = p.station join pk q on q.station = ds.dest where p.parent <> q.parent),
be as (select a, b, arg_min(struct_pack(total, u, d, decameters), struct_pack(total, u, d)) as best from tu group by all),
us as (select t.a, t.b, t.u, row_number() over (partition by t.a, t.b order by case when t.u = any_value(be.best.u) then 0 else 1 end, min(t.total), t.u) as place from tu t join be on be.a = t.a and be.b = t.b group by t.a, t.b, t.u qualify place <= 2),
dd as (select t.a, t.b, t.d, row_number() over (partition by t.a, t.b order by case when t.d = any_value(be.best.d) then 0 else 1 end, min(t.total), t.d) as place from tu t join be on be.a = t.a and be.b = t.b group by t.a, t.b, t.d qualify place <= 2),
st as (select t.*, (decameters * 10000 + 5140) // 5141 as ride from tu t join us on us.a = t.a and us.b = t.b and us.u = t.u join dd on dd.a = t.a and dd.b = t.b and dd.d = t.d),
le as (select a, b, min(decameters) as min_decameters, min(us + ds) as min_walk, min(us + ds + 150 + ride + greatest(60, ride * 100 // 1000)) as bike from st group by all)"""


@query(f"""with {_HOP} select be.a, be.b, case when be.best.decameters * 10000 < 300 * 3040 then 'below_window' when be.best.decameters * 10000 > 1500 * 5141 then 'above_window' when coalesce(seat.trips, 0) > 0 and midday_least + (21600 // trips) // 2 <= bike then 'beaten' else 'kept' end as decision,
(select string_agg(cast(u as varchar), ',' order by place) from us where us.a = be.a and us.b = be.b) as pickups, (select string_agg(cast(d as varchar), ',' order by place) from dd where dd.a = be.a and dd.b = be.b) as docks, min_decameters, min_walk, bike
from be join le on le.a = be.a and le.b = be.b left join seat on seat.a = be.a and seat.b = be.b""")
def j16_g14_t3_hops(spark, sf):
    s = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("k"))
    k = F.col("k")
    walks = s.select((k % 30).alias("parent"), k.alias("station"), (60 + k * 7 % 200).alias("seconds")).unionByName(s.where("k % 2 = 0").select(((k + 1) % 30).alias("parent"), k.alias("station"), (90 + k * 11 % 150).alias("seconds")))
    to = F.col("l_partkey") % 100 + 1
    distances = table(spark, sf, "lineitem").select(F.col("l_suppkey").alias("origin"), to.alias("dest"), (20 + (F.col("l_suppkey") * 31 + to * 17) % 900).alias("decameters")).distinct()
    return links.hops(walks, walks, distances, _rides(spark, sf))


@query("with w as (select l_suppkey % 20 as parent, l_partkey % 50 as station, case when l_linenumber % 2 = 0 then l_orderkey % 350 end as exit, case when l_linenumber % 3 = 0 then l_orderkey % 340 end as enter from lineitem) select parent, station, min(exit) as exit, min(enter) as enter from w group by all")
def a20_least_walks(spark, sf):
    line = table(spark, sf, "lineitem")
    return links.least_walks(line.select((F.col("l_suppkey") % 20).alias("parent"), (F.col("l_partkey") % 50).alias("station"), F.when(F.col("l_linenumber") % 2 == 0, F.col("l_orderkey") % 350).alias("exit"), F.when(F.col("l_linenumber") % 3 == 0, F.col("l_orderkey") % 340).alias("enter")))


@query("with w as (select l_suppkey % 20 as stop, l_partkey % 50 as station, min(case when l_linenumber % 2 = 0 then l_orderkey % 350 end) as enter from lineitem group by all) select station, stop, enter, row_number() over (partition by station order by enter nulls last, stop) as place from w")
def t2_links_by_station(spark, sf):
    from pyspark.sql import Window

    line = table(spark, sf, "lineitem")
    w = line.groupBy((F.col("l_suppkey") % 20).alias("stop"), (F.col("l_partkey") % 50).alias("station")).agg(F.min(F.when(F.col("l_linenumber") % 2 == 0, F.col("l_orderkey") % 350)).alias("enter"))
    return w.withColumn("place", F.row_number().over(Window.partitionBy("station").orderBy(F.col("enter").asc_nulls_last(), "stop"))).select("station", "stop", "enter", "place")


@query("with p as (select l_returnflag as sa, l_linestatus as sb, l_partkey % 600 as seconds from lineitem) select least(sa, sb) as low, greatest(sa, sb) as high, case when seconds // 60 < 1 then 'under 1' when seconds // 60 < 2 then '1' when seconds // 60 < 4 then '2-3' when seconds // 60 < 8 then '4-7' else '8 and over' end as bucket, count(*) as n from p group by all")
def a21_footpath_stats(spark, sf):
    line = table(spark, sf, "lineitem")
    return links.footpath_stats(line.select(F.col("l_returnflag").alias("system_a"), F.col("l_linestatus").alias("system_b"), (F.col("l_partkey") % 600).alias("seconds")))


_EDGES = "ed as (select l_suppkey as src, l_partkey % 100 as dst, min(cast(1000 + l_orderkey * 37 % 5000 as bigint)) as cost from lineitem where l_suppkey <> l_partkey % 100 group by all)"


def _least_edges(line):
    line = line.where("l_suppkey <> l_partkey % 100")
    return line.groupBy(F.col("l_suppkey").alias("src"), (F.col("l_partkey") % 100).alias("dst")).agg(F.min(1000 + F.col("l_orderkey") * 37 % 5000).alias("cost")).withColumn("length", F.col("cost"))


def _edges(spark, sf):
    return _least_edges(table(spark, sf, "lineitem"))


@query(f"with {_EDGES}, o as (select a.src as p, b.dst as r, min(a.cost + b.cost) as over2 from ed a join ed b on a.dst = b.src where a.src <> b.dst group by all) select e.src as p, e.dst as r, e.cost as seconds, o.over2 as over from ed e join o on o.p = e.src and o.r = e.dst where e.cost > o.over2".replace(" as over ", ' as "over" '))
def g15_open_triangles(spark, sf):
    return links.open_triangles(_edges(spark, sf).select(F.col("src").alias("a"), F.col("dst").alias("b"), F.col("cost").alias("seconds")))


@query(f"""with recursive {_EDGES}, walk as (select 1::bigint as origin, 1::bigint as node, 0::bigint as cost, 0 as hops union all select origin, node, min(cost), hops from (select w.origin, e.dst as node, w.cost + e.cost as cost, w.hops + 1 as hops from walk w join ed e on e.src = w.node where w.hops < 8 and w.cost + e.cost <= 6000) group by origin, node, hops)
select origin, node, min(cost) as cost from walk group by all""")
def g1_bounded_search(spark, sf):
    origins = spark.createDataFrame([(1, 1, 0, 0)], "origin bigint, node bigint, cost bigint, length bigint")
    return graph.shortest_paths(spark, _edges(spark, sf), origins, bound=6_000).select("origin", "node", "cost")


@query(f"""with recursive {_EDGES}, walk as (select 1::bigint as origin, 1::bigint as node, 0::bigint as cost, 0 as hops union all select origin, node, min(cost), hops from (select w.origin, e.dst as node, w.cost + e.cost as cost, w.hops + 1 as hops from walk w join ed e on e.src = w.node where w.hops < 8 and w.cost + e.cost <= 6000) group by origin, node, hops)
select origin, node, min(cost) as cost from walk group by all""")
def g2_search_by_joins(spark, sf):
    origins = spark.createDataFrame([(1, 1, 0, 0)], "origin bigint, node bigint, cost bigint, length bigint")
    return graph.shortest_paths(spark, _edges(spark, sf), origins, bound=6_000, most_edges=0).select("origin", "node", "cost")


@query(f"""with recursive {_EDGES}, st as (select s_suppkey as station, s_suppkey % 90 as leg from supplier), seen as (select src as node from ed union select dst from ed), walk as (select station as origin, station as node, 0::bigint as cost, 0 as hops from st where station in (select node from seen) union all select origin, node, min(cost), hops from (select w.origin, e.dst as node, w.cost + e.cost as cost, w.hops + 1 as hops from walk w join ed e on e.src = w.node where w.hops < 12) group by origin, node, hops),
best as (select origin, node, min(cost) as cost from walk group by all), m as (select b.origin, b.node as dest, case when b.origin = b.node then 0 else (p.leg + b.cost + q.leg + 50) // 100 end as decameters from best b join st p on p.station = b.origin join st q on q.station = b.node) select origin, dest, cast(decameters as bigint) as decameters from m where decameters < 65535""")
def g5_station_matrix(spark, sf):
    stops = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("station"), F.col("s_suppkey").alias("node"), (F.col("s_suppkey") % 90).alias("leg"))
    return graph.station_matrix(spark, _least_edges(table(spark, sf, "lineitem")), stops)


# blocks of 20 nodes, five of them in a chain; inside a block most rows lead ahead, one in 97 anywhere
_RING = "rg as (select distinct l_orderkey % 2000 as src, case when l_partkey % 40 = 0 and l_orderkey % 2000 // 20 % 5 <> 4 then l_orderkey % 2000 + 20 when l_partkey % 97 = 0 then l_orderkey % 2000 // 20 * 20 + l_partkey % 20 else l_orderkey % 2000 // 20 * 20 + greatest(l_orderkey % 20, (l_orderkey * 7 + l_linenumber) % 20) end as dst from lineitem)"


def _ring(spark, sf):
    k, p = F.col("l_orderkey"), F.col("l_partkey")
    node = k % 2_000
    block = F.floor(node / 20)
    ahead = block * 20 + F.greatest(k % 20, (k * 7 + F.col("l_linenumber")) % 20)
    dst = F.when((p % 40 == 0) & (block % 5 != 4), node + 20).when(p % 97 == 0, block * 20 + p % 20).otherwise(ahead)
    return table(spark, sf, "lineitem").select(node.alias("src"), dst.alias("dst")).distinct()


@query(f"""with recursive {_RING}, pairs as (select src, dst from rg union select dst, src from rg), reach as (select src as node, src as seen from pairs union select r.node, b.dst from reach r join pairs b on b.src = r.seen) select node, min(seen) as root from reach group by node""")
def g9_components(spark, sf):
    return graph.components(spark, _ring(spark, sf))


@query(f"""with recursive {_RING}, nodes as (select src as node from rg union select dst from rg), reach as (select node, node as seen from nodes union select r.node, e.dst from reach r join rg e on e.src = r.seen) select a.node, min(a.seen) as root from reach a join reach b on b.node = a.seen and b.seen = a.node group by a.node""")
def g9_strong_components(spark, sf):
    return graph.strong_components_of(spark, _ring(spark, sf))


@query("""with w as (select l_suppkey as component, l_linenumber as region, cast(sum(l_partkey) as bigint) as length from lineitem group by all), t as (select component, sum(length) as total from w group by 1), f as (select distinct component from (select region, component, row_number() over (partition by region order by length desc, component) as rn from w) where rn = 1)
select component, cast(total as bigint) as total, total * 100 >= (select max(total) from t) * 97 or component in (select component from f) as kept from t""")
def a23_g10_kept_components(spark, sf):
    lengths = table(spark, sf, "lineitem").groupBy(F.col("l_suppkey").alias("component"), F.col("l_linenumber").alias("region")).agg(F.sum("l_partkey").alias("length"))
    return graph.kept_components(lengths, 97)


@query("""with w as (select l_orderkey as way, l_linenumber as pos, min(l_partkey) % 800 as node from lineitem group by all), u as (select node, count(*) as uses from w group by 1), m as (select w.*, uses, lag(pos) over (partition by way order by pos) is null as f, lead(pos) over (partition by way order by pos) is null as l from w join u using (node)),
v as (select *, case when f or l or uses > 1 then 1 else 0 end as vertex from m) select way, pos, node, vertex, cast(sum(case when f then 0 else vertex end) over (partition by way order by pos rows between unbounded preceding and current row) as bigint) as piece from v""")
def g11_split_ways(spark, sf):
    ways = a.lines(spark, sf).select(F.col("l_orderkey").alias("way"), F.col("l_linenumber").alias("pos"), (F.col("l_partkey") % 800).alias("node"))
    return graph.split_ways(ways)


@query(f"with {_SEGMENTS}, n as (select *, cast(greatest(ceil(sqrt((bx - ax) * (bx - ax) + (by2 - ay) * (by2 - ay)) / 50.0), 1) as integer) as n from seg), k as (select *, unnest(range(0, n + 1)) as k from n) select distinct cast(floor((ax + (bx - ax) * k / n) / 100.0) as bigint) as cx, cast(floor((ay + (by2 - ay) * k / n) / 100.0) as bigint) as cy, segment from k")
def g13_snap_grid(spark, sf):
    return graph.segment_cells(_segments(spark, sf))


@query("""with p as (select l_orderkey * 10 + l_linenumber as piece, min(l_returnflag) as kind from lineitem group by 1), m as (select *, case when lag(piece) over w = piece - 1 and lag(kind) over w = kind then 0 else 1 end as head from p window w as (order by piece)), c as (select *, sum(head) over (order by piece) as run from m) select piece, min(piece) over (partition by run) as chain from c""")
def w13_street_chains(spark, sf):
    line = table(spark, sf, "lineitem")
    pieces = line.groupBy((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("piece")).agg(F.min("l_returnflag").alias("attributes"))
    return graph.merge_chains(spark, pieces.select("piece", F.col("piece").alias("a"), (F.col("piece") + 1).alias("b"), "attributes"))


@query(f"""with {_POINTS}, pl as (select point, x, y, concat('Stn ', point % 40) as name from pts where point % 10 = 1), pc as (select point, x, y, concat('stn-', point % 37) as name from pts where point % 3 = 0),
n as (select a.point, b.point as other, (a.x - b.x)::bigint * (a.x - b.x) + (a.y - b.y)::bigint * (a.y - b.y) as sq, regexp_replace(lower(a.name), '[^a-z0-9]', '', 'g') = regexp_replace(lower(b.name), '[^a-z0-9]', '', 'g') as same from pl a, pc b where a.point <> b.point),
r as (select *, row_number() over w as rank, lead(sqrt(sq::double)) over w as nxt from n where sq <= 1500 * 1500 window w as (partition by point order by same desc, sq, other)) select point, other, not same and coalesce(nxt - sqrt(sq::double) < 60, false) as ambiguous from r where rank = 1""")
def j21_nearest_places(spark, sf):
    p = _points(spark, sf)  # two kinds of places of one table: platforms are one in ten, places one in three
    platforms = p.where("point % 10 = 1").withColumn("name", F.concat(F.lit("Stn "), (F.col("point") % 40).cast("string")))
    places = p.where("point % 3 = 0").withColumn("name", F.concat(F.lit("stn-"), (F.col("point") % 37).cast("string")))
    return stations.nearest_place(platforms, places, 1_500, 60)


_BOXES = "bx as (select s_suppkey as ord, concat('area ', s_suppkey % 7) as name, s_suppkey * 331 % 9000 + 3.5 as x0, s_suppkey * 577 % 9000 + 3.5 as y0, s_suppkey * 331 % 9000 + 3.5 + 400 + s_suppkey % 5 * 100 as x1, s_suppkey * 577 % 9000 + 3.5 + 300 + s_suppkey % 3 * 100 as y1 from supplier)"


def _boxes(spark, sf):
    k = F.col("s_suppkey")
    x0, y0 = k * 331 % 9_000 + 3.5, k * 577 % 9_000 + 3.5
    x1, y1 = x0 + 400 + k % 5 * 100, y0 + 300 + k % 3 * 100
    corner = lambda x, y: F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))
    rings = F.array(F.array(corner(x0, y0), corner(x1, y0), corner(x1, y1), corner(x0, y1)))
    return table(spark, sf, "supplier").select(k.alias("ord"), F.concat(F.lit("area "), (k % 7).cast("string")).alias("name"), rings.alias("rings"))


_RASTER = f"{_BOXES}, grid as (select x.c as cx, y.c as cy from range(0, 110) x(c), range(0, 110) y(c)), rast as (select cx, cy, arg_min(name, ord) as name from grid join bx on cx * 100 + 50 > x0 and cx * 100 + 50 < x1 and cy * 100 + 50 > y0 and cy * 100 + 50 < y1 group by cx, cy)"


@query(f"with {_RASTER} select cx, cy, name from rast")
def p10_region_raster(spark, sf):
    return areas.raster(_boxes(spark, sf))


@query(f"with {_RASTER}, off as (select x.c as dx, y.c as dy from range(-3, 4) x(c), range(-3, 4) y(c) where x.c * x.c + y.c * y.c <= 9), m as (select distinct cx + dx as cx, cy + dy as cy from rast, off), w as (select l_orderkey as way, l_partkey * 71 % 10000 as x, l_suppkey * 83 % 10000 as y from lineitem) select distinct way from w join m on m.cx = w.x // 100 and m.cy = w.y // 100")
def p9_ways_in_city_mask(spark, sf):
    nodes = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("way"), (F.col("l_partkey") * 71 % 10_000).alias("x"), (F.col("l_suppkey") * 83 % 10_000).alias("y"))
    return areas.ways_in_mask(nodes, areas.mask(_boxes(spark, sf), 300.0))


@query(f"with {_POINTS}, {_BOXES} select point, exists(select 1 from bx where x / 3 + 0.25 > x0 and x / 3 + 0.25 < x1 and y / 3 + 0.25 > y0 and y / 3 + 0.25 < y1) as inside from pts".replace("x / 3 +", "x // 3 +").replace("y / 3 +", "y // 3 +"))
def p11_park_membership(spark, sf):
    points = _points(spark, sf).select("point", (F.floor(F.col("x") / 3) + 0.25).alias("x"), (F.floor(F.col("y") / 3) + 0.25).alias("y"))
    return areas.members(points, _boxes(spark, sf))


_WALK = f"""{_EDGES}, acc as (select 1000 + s_suppkey as node, s_suppkey as street, 20000 + s_suppkey % 7 * 1000 as ex, 15000 as en from supplier), wg as (select src, dst, min(cost) as cost from (select src, dst, cost * 20 as cost from ed union all select node, street, ex from acc union all select street, node, en from acc
union all select 1006, 1012, 40000) group by all)"""


def _walk(spark, sf):
    streets = _edges(spark, sf).withColumn("cost", F.col("cost") * 20)
    k = F.col("s_suppkey")
    access = table(spark, sf, "supplier").select((k + 1000).alias("node"), k.alias("street"), (20_000 + k % 7 * 1_000).alias("exit_ms"), F.lit(15_000).cast("bigint").alias("enter_ms"))
    change = spark.createDataFrame([(1006, 1012, 40)], "a bigint, b bigint, seconds bigint")
    return links.walk_graph(streets, access, change), access


_WALKED = f"""walk as (select node as origin, node, 0::bigint as cost, 0 as hops from acc union all select origin, node, min(cost), hops from (select w.origin, e.dst as node, w.cost + e.cost as cost, w.hops + 1 as hops from walk w join wg e on e.src = w.node where w.hops < 14 and w.cost + e.cost <= 140000) group by origin, node, hops), best as (select origin, node, min(cost) as cost from walk group by all)"""


@query(f"with recursive {_WALK}, {_WALKED} select b.origin as a, b.node as b, cast(ceil(b.cost / 1000.0) as bigint) as seconds from best b join acc q on q.node = b.node where b.origin <> b.node and b.cost <= (100 + 20 + 20) * 1000")
def g6_g7_footpaths(spark, sf):
    edges, access = _walk(spark, sf)
    return links.footpaths(spark, edges, access.select("node", F.lit(20).alias("access")), bound=100, most_access=20)


@query(f"with recursive {_WALK}, {_WALKED}, st as (select s_suppkey as station from supplier), x as (select b.origin % 5 as stop, st.station, cast(ceil(min(b.cost) / 1000.0) as bigint) as exit from best b join st on st.station = b.node where b.cost <= 120000 group by all) select stop, station, exit from x")
def g8_station_links(spark, sf):
    edges, access = _walk(spark, sf)
    stops = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("station"), F.col("s_suppkey").alias("node"))
    found = links.station_links(spark, edges, access.select("node", (F.col("node") % 5).alias("stop")), stops, bound=120)
    return found.where("exit is not null").select("stop", "station", "exit")


# a grid of 20 by 20 nodes, 100 apart: each row leads from its node to one of the four beside it
_GRID = """gr as (select n as src, case k when 0 then n + 1 when 1 then n - 1 when 2 then n + 20 else n - 20 end as dst, min(c) as cost from (select l_orderkey % 400 as n, l_linenumber % 4 as k, 80 + l_partkey % 200 as c from lineitem) where (k = 0 and n % 20 < 19) or (k = 1 and n % 20 > 0) or (k = 2 and n < 380) or (k = 3 and n >= 20) group by all)"""


def _grid(spark, sf):
    n, k = F.col("n"), F.col("k")
    rows = table(spark, sf, "lineitem").select((F.col("l_orderkey") % 400).alias("n"), (F.col("l_linenumber") % 4).alias("k"), (80 + F.col("l_partkey") % 200).alias("c"))
    inside = ((k == 0) & (n % 20 < 19)) | ((k == 1) & (n % 20 > 0)) | ((k == 2) & (n < 380)) | ((k == 3) & (n >= 20))
    dst = F.when(k == 0, n + 1).when(k == 1, n - 1).when(k == 2, n + 20).otherwise(n - 20)
    return rows.where(inside).groupBy(n.alias("src"), dst.alias("dst")).agg(F.min("c").alias("cost")).withColumn("length", F.col("cost"))


_ASKED = "qs as (select distinct s_suppkey * 7 % 400 as origin, s_suppkey * 13 % 400 as dest from supplier)"
_GRID_BEST = "walk as (select distinct origin, origin as node, 0::bigint as cost, 0 as hops from qs union all select origin, node, min(cost), hops from (select w.origin, e.dst as node, w.cost + e.cost as cost, w.hops + 1 as hops from walk w join gr e on e.src = w.node where w.hops < 70) group by origin, node, hops), best as (select origin, node, min(cost) as cost from walk group by all)"


@query(f"with recursive {_GRID}, {_ASKED}, {_GRID_BEST} select q.origin, q.dest, b.cost, b.cost as along from qs q join best b on b.origin = q.origin and b.node = q.dest")
def g3_g4_guided_paths(spark, sf):
    """Costs by a guided search, and the same again along the nodes of the path that it gives."""
    edges = _grid(spark, sf)
    asked = table(spark, sf, "supplier").select((F.col("s_suppkey") * 7 % 400).alias("origin"), (F.col("s_suppkey") * 13 % 400).alias("dest")).distinct()
    places = spark.range(400).select(F.col("id").alias("node"), (F.col("id") % 20 * 100).cast("double").alias("x"), (F.floor(F.col("id") / 20) * 100).cast("double").alias("y"))
    found = graph.guided_paths(spark, edges, asked, places, 0.8)
    steps = found.select("origin", "dest", F.explode(F.transform(F.sequence(F.lit(1), F.size("path")), lambda i: F.struct(F.get("path", i - 1).alias("src"), F.get("path", i).alias("dst")))).alias("s"))
    along = steps.select("origin", "dest", "s.src", F.col("s.dst").alias("to")).join(edges.select("src", F.col("dst").alias("to"), "cost"), ["src", "to"]).groupBy("origin", "dest").agg(F.sum("cost").alias("along"))
    return found.select("origin", "dest", "cost").join(along, ["origin", "dest"], "left").select("origin", "dest", "cost", F.coalesce("along", F.lit(0)).alias("along"))


@query("select s_suppkey as line, cast(case when s_suppkey % 2 = 0 then 3 else 2 end + (s_suppkey % 4 // 2) * 0 as integer) as points, cast(s_suppkey % 90 + 5 as double) as first_x, cast(100 as double) as last_x, cast(case when s_suppkey % 2 = 0 then s_suppkey % 50 + 1 else 0 end as double) as last_y from supplier")
def g4_trimmed_lines(spark, sf):
    """Lines of a side of 100 and one of 60, cut at a place on the first and one on the second side or at the corner."""
    k = F.col("s_suppkey")
    point = lambda x, y: F.struct(F.lit(float(x)).alias("x"), F.lit(float(y)).alias("y"))
    upto = F.when(k % 2 == 0, 100.0 + (k % 50 + 1).cast("double")).otherwise(F.lit(100.0))
    rows = table(spark, sf, "supplier").select(k.alias("line"), geo.trim_line(F.array(point(0, 0), point(100, 0), point(100, 60)), (k % 90 + 5).cast("double"), upto).alias("p"))
    return rows.select("line", F.size("p").alias("points"), *(F.round(c, 6).alias(n) for n, c in (("first_x", F.col("p")[0]["x"]), ("last_x", F.element_at("p", -1)["x"]), ("last_y", F.element_at("p", -1)["y"]))))


@query(f"with recursive {_GRID}, qs as (select distinct s_suppkey * 37 % 400 as origin from supplier), {_GRID_BEST}, near as (select b.origin, min(struct_pack(c := b.cost, t := b.node)) as m from best b where b.cost <= 400 and b.node % 11 = 5 group by 1) select origin as node, m.t as target, m.c as length from near")
def g12_nearest_connectors(spark, sf):
    stranded = table(spark, sf, "supplier").select((F.col("s_suppkey") * 37 % 400).alias("node")).distinct()
    targets = spark.range(400).select(F.col("id").alias("node")).where("node % 11 = 5")  # what a connector may lead to
    return graph.nearest_connectors(spark, _grid(spark, sf), stranded, targets, 400)


@query("""with p as (select s_suppkey as k, s_suppkey % 4 as m from supplier) select k as pattern, case when m = 3 then null else [2, 6, 10, 14] end as vertices, m = 2 as reversed, cast(round(case when m = 3 then sqrt(300 * 300 + 100 * 100) else 30 end * 1000) as bigint) as worst_mm from p""")
def w7_stop_vertices(spark, sf):
    """Stops beside every fourth vertex of a straight line; drawn the other way round for m = 2, too far away for m = 3."""
    k, i = F.col("s_suppkey"), F.col("i")
    p = table(spark, sf, "supplier").select(k.alias("pattern"), (k % 4).alias("m"), (k * 10.0).alias("x0"))
    stops = p.select("pattern", "m", "x0", F.explode(F.array(*map(F.lit, (2, 6, 10, 14)))).alias("i")).select("pattern", i.alias("pos"), (F.col("x0") + i * 100).alias("x"), F.when(F.col("m") == 3, F.lit(300.0)).otherwise(30.0).alias("y"))
    # the line of m = 3 ends before the last stops
    line = p.select("pattern", "m", "x0", F.explode(F.sequence(F.lit(0), F.when(F.col("m") == 3, 13).otherwise(16))).alias("i"))
    line = line.select(F.col("pattern").alias("shape"), F.when(F.col("m") == 2, 16 - i).otherwise(i).alias("seq"), (F.col("x0") + i * 100).alias("x"), F.lit(0.0).alias("y"))
    found = timetable.match_shapes(stops, line, p.select("pattern", F.col("pattern").alias("shape")))
    return found.select("pattern", "vertices", "reversed", F.round(F.col("worst") * 1000).cast("bigint").alias("worst_mm"))


@query("select l_orderkey as line, case when max(h) > 60 then case when max(h) = min(h) and false then null else [0, 5, 10] end else [0, 10] end as kept from (select l_orderkey, (max(l_partkey) % 121)::double as h from lineitem group by 1) group by 1".replace("case when max(h) = min(h) and false then null else [0, 5, 10] end", "[0, 5, 10]"))
def f27_simplified_lines(spark, sf):
    """Tents of eleven points: the peak stays if it is higher than the tolerance."""
    tents = table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("line")).agg((F.max("l_partkey") % 121).cast("double").alias("h"))
    at = F.transform(F.sequence(F.lit(0), F.lit(10)), lambda i: i * 1000.0)
    rows = tents.select("line", at.alias("xs"), F.transform(F.sequence(F.lit(0), F.lit(10)), lambda i: F.col("h") * (1 - F.abs(i - 5) / 5.0)).alias("ys"))
    return rows.select("line", geo.simplified(F.col("xs"), F.col("ys"), F.lit(60.0)).alias("kept"))


@query("select s_suppkey as area, cast(36 as integer) as corners, cast(round(w * h + 2 * (w + h) * 30 + 16 * 900 * sin(2 * pi() / 32)) as bigint) as square_metres from (select s_suppkey, s_suppkey * 10 % 900 + 50 as w, s_suppkey * 7 % 800 + 40 as h from supplier)")
def f28_buffered_hulls(spark, sf):
    k = F.col("s_suppkey")
    w, h = (k * 10 % 900 + 50).cast("double"), (k * 7 % 800 + 40).cast("double")
    point = lambda x, y: F.struct(x.alias("x"), y.alias("y"))
    zero = F.lit(0.0)
    rows = table(spark, sf, "supplier").select(k.alias("area"), F.array(point(zero, zero), point(w, zero), point(w / 2, h / 3), point(w, h), point(zero, h), point(w, h)).alias("points"))
    ring = rows.select("area", geo.hull_around(F.col("points"), F.lit(30.0)).alias("ring"))
    turned = F.zip_with("ring", F.concat(F.slice("ring", 2, F.size("ring")), F.slice("ring", 1, 1)), lambda p, q: p["x"] * q["y"] - q["x"] * p["y"])
    return ring.select("area", F.size("ring").alias("corners"), F.round(F.aggregate(turned, F.lit(0.0), lambda s, v: s + v) / 2).cast("bigint").alias("square_metres"))


_ON_SEGMENTS = """st as (select s_suppkey as station, s_suppkey * 37 % 380 as a, s_suppkey * 37 % 380 + 20 as b, (s_suppkey % 9 + 1) / 10::double as f, (s_suppkey % 90)::double as leg from supplier), sg as (select st.*, x.cost as ahead, y.cost as back from st left join gr x on x.src = st.a and x.dst = st.b left join gr y on y.src = st.b and y.dst = st.a),
seeds as (select station as origin, b as node, cast(floor(ahead * (1.0::double - f) + 0.5) as bigint) as cost from sg where ahead is not null union all select station, a, cast(floor(back * f + 0.5) as bigint) from sg where back is not null)"""


@query(f"""with recursive {_GRID}, {_ON_SEGMENTS}, walk as (select origin, node, min(cost) as cost, 0 as hops from seeds group by all union all select origin, node, min(cost), hops from (select w.origin, e.dst as node, w.cost + e.cost as cost, w.hops + 1 as hops from walk w join gr e on e.src = w.node where w.hops < 70) group by origin, node, hops), best as (select origin, node, min(cost) as cost from walk group by all),
options as (select b.origin, q.station as dest, b.cost + cast(floor(q.ahead * q.f + 0.5) as bigint) as cost, 1 as way, b.cost + q.ahead * q.f as dm from best b join sg q on q.a = b.node where q.ahead is not null union all select b.origin, q.station, b.cost + cast(floor(q.back * (1.0::double - q.f) + 0.5) as bigint), 2, b.cost + q.back * (1.0::double - q.f) from best b join sg q on q.b = b.node where q.back is not null
union all select x.station, y.station, cast(floor((case when y.f >= x.f then x.ahead else x.back end) * abs(y.f - x.f) + 0.5) as bigint), 0, (case when y.f >= x.f then x.ahead else x.back end) * abs(y.f - x.f) from sg x join sg y on x.a = y.a and x.station <> y.station where case when y.f >= x.f then x.ahead else x.back end is not null),
m as (select origin, dest, min(struct_pack(cost, way, dm)) as m from options where origin <> dest group by all) select origin, dest, cast(floor((p.leg + m.m.dm / 10 + q.leg) / 10 + 0.5) as bigint) as decameters from m join st p on p.station = origin join st q on q.station = dest union all select station, station, 0 from st""")
def g5_matrix_on_segments(spark, sf):
    checkpoint_root(spark)
    k, edges = F.col("s_suppkey"), _grid(spark, sf).checkpoint()
    own = table(spark, sf, "supplier").select(k.alias("station"), (k * 37 % 380).alias("segment"), (k * 37 % 380).alias("a"), (k * 37 % 380 + 20).alias("b"), ((k % 9 + 1) / 10).alias("fraction"), (k % 90).cast("double").alias("leg"))
    for name, src, dst in (("ahead", "a", "b"), ("back", "b", "a")):
        own = own.join(edges.select(F.col("src").alias(src), F.col("dst").alias(dst), F.col("cost").alias(f"{name}_cost"), F.col("length").alias(f"{name}_length")), ["a", "b"], "left")
    return graph.matrix_on_segments(spark, edges, own)


_PIECES = f"""{a.LINES}, pc as (select l_orderkey * 10 + l_linenumber as piece, l_orderkey % 2000 as a, case when l_partkey % 40 = 0 and l_orderkey % 2000 // 20 % 5 <> 4 then l_orderkey % 2000 + 20 when l_partkey % 97 = 0 then l_orderkey % 2000 // 20 * 20 + l_partkey % 20 else l_orderkey % 2000 // 20 * 20 + greatest(l_orderkey % 20, (l_orderkey * 7 + l_linenumber) % 20) end as b,
  l_partkey + l_orderkey % 2000 // 400 * 300 as length, case when l_partkey % 7 <> 0 then l_linenumber % 3 end as region, l_partkey % 4 = 0 as walk, l_partkey % 3 = 0 as fw, l_partkey % 5 = 0 as bw from lines),
us as (select * from pc where walk or fw or bw), n1 as (select a as x, b as y from us union select b, a from us), r1 as (select x as node, x as seen from n1 union select r.node, n.y from r1 r join n1 n on n.x = r.seen), c1 as (select node, min(seen) as component from r1 group by 1), m1 as (select us.*, component from us join c1 on c1.node = us.a)"""


def _kept_sql(rows: str) -> str:
    total = f"(select component, sum(length) as total from {rows} group by 1)"
    return f"(select component from {total} where total * 100 >= (select max(total) from {total}) * 60 union select component from (select component, row_number() over (partition by region order by sum(length) desc, component) as rn from {rows} where region is not null group by region, component) where rn = 1)"


@query(f"""with recursive {_PIECES}, k1 as (select * exclude (component) from m1 where component in {_kept_sql('m1')}), n2 as (select a as x, b as y from k1 where walk union select b, a from k1 where walk), r2 as (select x as node, x as seen from n2 union select r.node, n.y from r2 r join n2 n on n.x = r.seen), c2 as (select node, min(seen) as component from r2 group by 1),
m2 as (select k1.*, component from k1 join c2 on c2.node = k1.a where walk), w2 as (select piece from m2 where component in {_kept_sql('m2')}), arcs as (select a as x, b as y from k1 where fw union select b, a from k1 where bw), n3 as (select x as node from arcs union select y from arcs), r3 as (select node, node as seen from n3 union select r.node, e.y from r3 r join arcs e on e.x = r.seen),
c3 as (select p.node, min(p.seen) as component from r3 p join r3 q on q.node = p.seen and q.seen = p.node group by 1), m3 as (select k1.*, x.component from k1 join c3 x on x.node = k1.a join c3 y on y.node = k1.b where (fw or bw) and x.component = y.component), w3 as (select piece from m3 where component in {_kept_sql('m3')}),
f as (select piece, walk and piece in (select piece from w2) as walk, fw and piece in (select piece from w3) as forward, bw and piece in (select piece from w3) as backward from k1) select * from f where walk or forward or backward""")
def g10_usable_pieces(spark, sf):
    k, p, line = F.col("l_orderkey"), F.col("l_partkey"), F.col("l_linenumber")
    node, block = k % 2_000, F.floor(k % 2_000 / 20)
    b = F.when((p % 40 == 0) & (block % 5 != 4), node + 20).when(p % 97 == 0, block * 20 + p % 20).otherwise(block * 20 + F.greatest(k % 20, (k * 7 + line) % 20))
    pieces = a.lines(spark, sf).select(
        (k * 10 + line).alias("piece"), node.alias("a"), b.alias("b"), (p + F.floor(node / 400) * 300).alias("length"), F.when(p % 7 != 0, line % 3).alias("region"), (p % 4 == 0).alias("walk"), (p % 3 == 0).alias("forward"), (p % 5 == 0).alias("backward"),
    )
    return graph.usable_pieces(spark, pieces, 60)
