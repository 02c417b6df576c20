"""Queries on trip ends and their keys."""

from __future__ import annotations

from pyspark.sql import functions as F

from metrolith.functions import fields
from metrolith.operators import flows, smoothing
from metrolith.plans import adapters as a
from metrolith.plans.registry import query, table

def _window():
    return F.lit(a.FIRST).cast("date"), F.lit(a.LAST).cast("date")


def _counts(spark, sf):
    return flows.count_ends(a.ends(spark, sf))


def _active(spark, sf):
    return flows.active_days(_counts(spark, sf), a.holidays(spark), *_window())


@query(f"with {a.COUNTS} select key, day, bin, bike, direction, least(n, 65535) as n, greatest(n - 65535, 0) as lost from counts")
def a1_trip_end_counts(spark, sf):
    return _counts(spark, sf)


_TALLY = f"""daily as (select key, day, direction, bin, {a.DAY_TYPE.format(d='day')} as day_type, sum(case when bike = 'classic' then n else 0 end) as classic, sum(case when bike = 'ebike' then n else 0 end) as ebike
  from counts group by all),
three as (select key, day_type, direction, bin, 'classic' as series, classic as c from daily union all select key, day_type, direction, bin, 'ebike', ebike from daily union all select key, day_type, direction, bin, 'any', classic + ebike from daily),
tally as (select key, day_type, direction, bin, series, cast(sum(c) as bigint) as s, cast(sum(c * c) as bigint) as q from three group by all having sum(c) > 0)"""


@query(f"with {a.COUNTS}, {a.HOLIDAYS}, {_TALLY} select * from tally")
def a2_day_type_tally(spark, sf):
    return flows.tally(flows.with_day_type(_counts(spark, sf), a.holidays(spark)))


_ACTIVE = f"""span as (select key, min(day) as low, max(day) as high from counts group by key),
sides as (select key, direction, greatest(low, date '{a.FIRST}') as a, least(high, case when direction = 'departures' then date '{a.LAST}' - 1 else date '{a.LAST}' end) as b from span, (values ('arrivals'), ('departures')) t(direction)),
active_day as (select key, direction, cast(unnest(generate_series(a, b, interval 1 day)) as date) as day from sides where a <= b),
active as (select key, {a.DAY_TYPE.format(d='day')} as day_type, direction, count(*) as n from active_day group by all)"""


@query(f"with {a.COUNTS}, {a.HOLIDAYS}, {_ACTIVE} select * from active")
def a3_active_days(spark, sf):
    return _active(spark, sf)


@query(f"""with {a.COUNTS}, days as (select cast(unnest(generate_series(date '{a.FIRST}', date '{a.LAST}', interval 1 day)) as date) as day),
sides as (select day, direction from days, (values ('arrivals'), ('departures')) t(direction) where direction = 'arrivals' or day <= date '{a.LAST}' - 1)
select s.direction, s.day, cast(coalesce(sum(n), 0) as bigint) as n from sides s left join counts c on s.day = c.day and s.direction = c.direction group by all""")
def a4_daily_totals(spark, sf):
    return flows.daily_totals(_counts(spark, sf), *_window())


def _half(value: str, rounded: str = "round_even({}, 0)") -> str:
    """SQL of the 16-bit pattern of a value, by its exponent ``e`` (see _EXPONENT)."""
    return f"cast(case when {value} < pow(2.0, -14) then {rounded.format(f'{value} * 16777216.0')} else (e + 15) * 1024 + {rounded.format(f'{value} * pow(2.0, 10 - e)')} - 1024 end as integer)"


def _with_exponent(table: str, value: str) -> str:
    """SQL of a table's rows with ``c``, the value held at the largest finite one, and its exponent ``e``."""
    return f"""(select *, case when c < pow(2.0, -14) then -14 when pow(2.0, e0) > c then e0 - 1 when pow(2.0, e0 + 1) <= c then e0 + 1 else e0 end as e from (select *, floor(log2(greatest(c, 1e-300))) as e0 from (select *, least({value}, 65504.0) as c from {table})))"""


_VALUE = "case when {0} // 1024 = 0 then {0} * pow(2.0, -24) else (1024 + {0} % 1024) * pow(2.0, {0} // 1024 - 25) end"
_BY_HOUR = "list_transform(range(0, 96), lambda b: (({0}[b // 4 * 4 + 1] + {0}[b // 4 * 4 + 2]) + {0}[b // 4 * 4 + 3]) + {0}[b // 4 * 4 + 4])"
_LIMIT = (1000 * 1024 * 1_000_000 // 111_195) ** 2

# the folds of the operator, in its order: lists of 96 bins, sums from left to right, neighbours by rank
_SMOOTHED = f"""with {a.COUNTS}, {a.HOLIDAYS}, {_TALLY}, {_ACTIVE}, keys as (select distinct key from counts),
pl as (select key, 40700000 + cast(key as bigint) * 7919 % 20000 as lat, -74000000 + cast(key as bigint) * 104729 % 20000 as lon from keys),
pairs as (select x.key, y.key as neighbour, ((x.lat - y.lat) * 1024) * ((x.lat - y.lat) * 1024) + ((x.lon - y.lon) * 776) * ((x.lon - y.lon) * 776) as sq from pl x join pl y on x.key <> y.key),
nb as (select key, neighbour, row_number() over (partition by key order by sq, neighbour) as rank from pairs where sq <= {_LIMIT} qualify rank <= 8),
side as (select k.key, d.day_type, r.direction, coalesce(x.n, 0) as n from keys k cross join (values ('weekday'), ('weekend')) d(day_type) cross join (values ('arrivals'), ('departures')) r(direction) left join active x on x.key = k.key and x.day_type = d.day_type and x.direction = r.direction),
dense as (select s.key, s.day_type, s.direction, s.n, v.series, list(coalesce(t.s, 0)::double order by b.bin) as s, list(coalesce(t.q, 0)::double order by b.bin) as q from side s cross join (values ('classic'), ('ebike'), ('any')) v(series) cross join range(0, 96) b(bin)
  left join tally t on t.key = s.key and t.day_type = s.day_type and t.direction = s.direction and t.series = v.series and t.bin = b.bin group by all),
means as (select *, list_transform(s, lambda x: case when n > 0 then x / n else 0.0::double end) as raw from dense),
lent as (select nb.key, m.day_type, m.direction, m.series, list(m.raw order by nb.rank) as rs from nb join means m on m.key = nb.neighbour where m.n > 0 group by all),
shaped as (select m.*, len(l.rs) as lenders, list_transform(range(1, 97), lambda i: case when l.rs is null then 0.0::double else list_reduce(list_transform(l.rs, lambda r: r[i]), lambda x, y: x + y) end) as shape from means m left join lent l on l.key = m.key and l.day_type = m.day_type and l.direction = m.direction and l.series = m.series),
folded as (select *, list_reduce(shape, lambda x, y: x + y) as mass, list_reduce(raw, lambda x, y: x + y) as total from shaped),
priored as (select *, list_transform(shape, lambda x: case when mass > 0 then x / mass * (case when n > 0 then total else mass / lenders end) else total / 96 end) as prior from folded),
hourly as (select *, {_BY_HOUR.format('s')} as hs, {_BY_HOUR.format('prior')} as hp, {_BY_HOUR.format('raw')} as busy, list_transform(range(1, 97), lambda i: case when n >= 2 then (n * q[i] - s[i] * s[i]) / (n * (n - 1)) else 0.0::double end) as variance from priored),
varied as (select *, {_BY_HOUR.format('variance')} as hv from hourly),
bins as (select key, day_type, direction, series, n, i - 1 as bin, (s[i] + 4.0::double * ((hs[i] + 8.0::double * hp[i]) / (4 * (n + 8.0::double)))) / (n + 4.0::double) as mean, raw[i] as raw, variance[i] as variance, case when busy[i] > 0 then hv[i] / busy[i] else 1.0::double end as ratio from varied, range(1, 97) t(i)),
cells as (select key, day_type, direction, series, bin, mean, case when n < 2 then 1.0::double else greatest(1.0::double, (n * (case when raw > 0 then variance / raw else ratio end) + 6.0::double * ratio) / (n + 6.0::double)) end as phi from bins),
two as (select *, mean as v, 'mean' as slot from cells where series <> 'any' union all select *, mean * phi, 'variance' from cells where series <> 'any'),
stored as (select key, day_type, direction, bin, series, slot, {_half('c')} as bits from {_with_exponent('two', 'v')}),
flat as (select key, day_type, direction, bin, max(bits) filter (where series = 'classic' and slot = 'mean') as mean_classic, max(bits) filter (where series = 'classic' and slot = 'variance') as variance_classic, max(bits) filter (where series = 'ebike' and slot = 'mean') as mean_ebike, max(bits) filter (where series = 'ebike' and slot = 'variance') as variance_ebike from stored group by all),
whole as (select f.*, {_VALUE.format('f.mean_classic')} + {_VALUE.format('f.mean_ebike')} as least_any, (c.mean + e.mean) * y.phi as exact from flat f join cells c on c.series = 'classic' and c.key = f.key and c.day_type = f.day_type and c.direction = f.direction and c.bin = f.bin
  join cells e on e.series = 'ebike' and e.key = f.key and e.day_type = f.day_type and e.direction = f.direction and e.bin = f.bin join cells y on y.series = 'any' and y.key = f.key and y.day_type = f.day_type and y.direction = f.direction and y.bin = f.bin),
near as (select key, day_type, direction, bin, mean_classic, variance_classic, mean_ebike, variance_ebike, least_any, {_half('c')} as own from {_with_exponent('whole', 'exact')})
select key, day_type, direction, cast(bin as integer) as bin, mean_classic, variance_classic, mean_ebike, variance_ebike, greatest(own, {_half('c', 'ceil({})')}) as variance_any from {_with_exponent('near', 'least_any')}"""


@query(_SMOOTHED)
def a5_a6_smoothed_cells(spark, sf):
    counts = flows.with_day_type(_counts(spark, sf), a.holidays(spark))
    keys = counts.select("key").distinct()
    n = F.col("key").cast("bigint")
    placed = keys.select("key", (40_700_000 + n * 7_919 % 20_000).cast("int").alias("lat_e6"), (-74_000_000 + n * 104_729 % 20_000).cast("int").alias("lon_e6"), F.lit(True).alias("has_trips"))
    return smoothing.smooth(flows.tally(counts), _active(spark, sf), flows.nearest_keys(placed), keys)


@query(f"""with {a.COUNTS}, {a.HOLIDAYS}, {_ACTIVE}, ends_of as (select key, sum(n) as ends from counts group by key),
days_of as (select key, sum(n) as days, sum(case when day_type = 'weekday' then n else 0 end) as wd, sum(case when day_type = 'weekend' then n else 0 end) as we from active where direction = 'departures' group by key)
select e.key, cast(ends as bigint) as ends, cast(coalesce(days, 0) as bigint) as days, ends = 0 or ends < coalesce(days, 0) as low_data, coalesce(wd, 0) < 4 or coalesce(we, 0) < 4 as dominated from ends_of e left join days_of d on e.key = d.key""")
def a7_station_flags(spark, sf):
    counts = _counts(spark, sf)
    return flows.station_flags(counts, _active(spark, sf), counts.select("key").distinct())


_IDS = """ids as (select event_id, case when event_id % 13 = 0 then '' when event_id % 17 = 0 then concat('DEPOT', user_id) when event_id % 19 = 0 then concat('X', user_id % 40)
  when event_id % 5 = 0 then concat(user_id, '.', user_id % 10) else concat(user_id, '.', user_id % 10, '0') end as id from events),
keys as (select distinct concat(user_id, '.', user_id % 10, '0') as key from events where user_id % 9 <> 0),
resolved as (select event_id, id, coalesce(k.key, r.key) as key, case when k.key is not null then 'exact' when r.key is not null then 'repaired' when id = '' then 'dockless' when starts_with(id, 'DEPOT') or id = 'X7' then 'depot' else 'unmatched' end as outcome
  from ids left join keys k on id = k.key left join keys r on regexp_full_match(id, '[0-9]+\\.[0-9]') and concat(id, '0') = r.key)"""


def _resolved(spark, sf):
    e = table(spark, sf, "events")
    user = F.col("user_id").cast("string")
    short = F.concat(user, F.lit("."), (F.col("user_id") % 10).cast("string"))
    ident = F.when(F.col("event_id") % 13 == 0, "").when(F.col("event_id") % 17 == 0, F.concat(F.lit("DEPOT"), user)).when(F.col("event_id") % 19 == 0, F.concat(F.lit("X"), (F.col("user_id") % 40).cast("string")))
    ident = ident.when(F.col("event_id") % 5 == 0, short).otherwise(F.concat(short, F.lit("0")))
    keys = e.where("user_id % 9 <> 0").select(F.concat(short, F.lit("0")).alias("key")).distinct()
    return flows.resolve_ends(e.select("event_id", ident.alias("id")), keys, [("DEPOT", "prefix"), ("X7", "exact")])


@query(f"with {_IDS} select event_id, id, key, outcome from resolved")
def j2_station_resolution(spark, sf):
    return _resolved(spark, sf).select("event_id", "id", "key", "outcome")


@query(f"with {_IDS} select id, count(*) as n from resolved where outcome = 'unmatched' group by id order by n desc, id limit 12")
def a8_top_unmatched_ids(spark, sf):
    return flows.top_ids(_resolved(spark, sf).where("outcome = 'unmatched'"))


@query(f"""with {_IDS} select count(*) as ends, case when count(*) filter (outcome in ('exact', 'repaired', 'unmatched')) = 0 then 0.0::double else (count(*) filter (outcome = 'unmatched'))::double / count(*) filter (outcome in ('exact', 'repaired', 'unmatched')) end as unmatched_share,
case when count(*) filter (outcome in ('exact', 'repaired')) = 0 then 0.0::double else (count(*) filter (outcome = 'repaired'))::double / count(*) filter (outcome in ('exact', 'repaired')) end as repaired_share from resolved""".replace("filter (outcome", "filter (where outcome"))
def a9_resolution_shares(spark, sf):
    of = lambda *names: F.count_if(F.col("outcome").isin(*names))
    return _resolved(spark, sf).agg(F.count("*").alias("ends"), flows.share(of("unmatched"), of("exact", "repaired", "unmatched")).alias("unmatched_share"), flows.share(of("repaired"), of("exact", "repaired")).alias("repaired_share"))


@query("""with d as (select o_orderpriority as slot, cast(floor(o_totalprice) as bigint) as v from orders), r as (select slot, v, row_number() over (partition by slot order by v) - 1 as i, count(*) over (partition by slot) as n from d)
select slot, max(n) as n, min(v) as min, max(case when i = floor((n - 1) * 0.5 + 0.5) then v end) as p50, max(case when i = floor((n - 1) * 0.9 + 0.5) then v end) as p90, max(case when i = floor((n - 1) * 0.99 + 0.5) then v end) as p99, max(v) as max, sum(v)::double / max(n) as mean from r group by slot""")
def a10_distribution(spark, sf):
    rows = table(spark, sf, "orders").select(F.col("o_orderpriority").alias("slot"), F.floor("o_totalprice").alias("v"))
    return flows.nearest_rank(rows, "v", ["slot"])


@query("select isodow(cast(o_orderdate as date)) - 1 as weekday, median(cast(o_custkey as bigint)) as middle from orders group by 1")
def a11_weekday_median(spark, sf):
    o = table(spark, sf, "orders")
    return o.groupBy(F.weekday("o_orderdate").cast("bigint").alias("weekday")).agg(F.median("o_custkey").alias("middle"))


@query(f"""with {a.STATIONS}, t as (select *, coalesce(region in ('189', '190'), false) as tested from stations), n as (select *, row_number() over (partition by station_id, tested order by ord) as nth from t)
select case when region in ('189', '190') then 'test_region' when nth > 1 then 'repeated' when short_name = '' then 'no_short_name' else 'kept' end as reason, count(*) as n, cast(sum(ord) as bigint) as ord_sum from n group by 1""")
def p2_key_universe(spark, sf):
    found = flows.key_universe(a.stations(spark, sf))
    return found.groupBy(F.coalesce("reason", F.lit("kept")).alias("reason")).agg(F.count("*").alias("n"), F.sum("ord").alias("ord_sum"))


@query(f"""with {a.STATIONS}, k as (select distinct short_name as key from stations where short_name <> '') select a.key, b.key as longer from k a join k b on concat(a.key, '0') = b.key where regexp_full_match(a.key, '[0-9]+\\.[0-9]')""")
def p2_ambiguous_keys(spark, sf):
    return flows.ambiguous_keys(a.stations(spark, sf).where("short_name <> ''").select(F.col("short_name").alias("key")).distinct())


@query(f"""with {a.ENDS} select direction, case when day < date '2024-01-05' or day > date '2024-01-25' then 'outside_window' when direction = 'departures' and day > date '2024-01-25' - 1 then 'outside_direction_window' else 'counted' end as reason, count(*) as n from ends group by all""")
def p6_window_reasons(spark, sf):
    reason = flows.window_reason(F.col("day"), F.col("direction"), F.lit("2024-01-05").cast("date"), F.lit("2024-01-25").cast("date"))
    return a.ends(spark, sf).groupBy("direction", F.coalesce(reason, F.lit("counted")).alias("reason")).agg(F.count("*").alias("n"))


_NEAR = f"""{a.STATIONS}, st as (select ord as key, lat_e6, lon_e6, capacity > 0 as has_trips from stations),
pairs as (select a.key, b.key as neighbour, ((a.lat_e6 - b.lat_e6)::bigint * 1024) * ((a.lat_e6 - b.lat_e6)::bigint * 1024) + ((a.lon_e6 - b.lon_e6)::bigint * 776) * ((a.lon_e6 - b.lon_e6)::bigint * 776) as square from st a, st b where b.has_trips and a.key <> b.key),
near as (select *, row_number() over (partition by key order by square, neighbour) as rank from pairs where square <= ((1000 * 1024 * 1000000::bigint) // 111195) * ((1000 * 1024 * 1000000::bigint) // 111195))"""


@query(f"with {_NEAR} select key, neighbour, rank, square from near where rank <= 8")
def j9_nearest_keys(spark, sf):
    st = a.stations(spark, sf).select(F.col("ord").alias("key"), "lat_e6", "lon_e6", (F.col("capacity") > 0).alias("has_trips"))
    return flows.nearest_keys(st)


_MONTHS = """months as (select case when o_custkey % 4 = 0 then 'JC' else 'NYC' end as system, cast(year(o_orderdate) * 100 + month(o_orderdate) as integer) as month, count(*) as rows from orders group by all),
previous as (select system, month, rows + month % 7 as rows from months where month % 2 = 0)"""


def _months(spark, sf):
    o = table(spark, sf, "orders")
    rows = o.groupBy(F.when(F.col("o_custkey") % 4 == 0, "JC").otherwise("NYC").alias("system"), (F.year("o_orderdate") * 100 + F.month("o_orderdate")).alias("month")).agg(F.count("*").alias("rows"))
    return rows, rows.where("month % 2 = 0").withColumn("rows", F.col("rows") + F.col("month") % 7)


@query(f"""with {_MONTHS}, j as (select m.system, m.month, m.rows, p.rows as old_rows, coalesce(pb.rows, mb.rows) as before from months m left join previous p using (system, month)
left join previous pb on m.system = pb.system and (m.month // 100) * 12 + m.month % 100 = (pb.month // 100) * 12 + pb.month % 100 + 1 left join months mb on m.system = mb.system and (m.month // 100) * 12 + m.month % 100 = (mb.month // 100) * 12 + mb.month % 100 + 1)
select system, month, rows, coalesce(old_rows, before) as reference, case when old_rows is not null then 'same_month' when before is not null then 'month_before' else 'none' end as basis,
case when old_rows is not null then rows >= old_rows * 0.9::double when before is not null then rows >= before * 0.5::double else true end as passed from j""")
def w12_month_gate(spark, sf):
    return flows.month_gate(*_months(spark, sf))


@query("""with s as (select l_returnflag as system, l_linestatus as side, year(l_shipdate) >= 1998 as newest, count(*) filter (where l_suppkey % 50 > 1) as exact, count(*) filter (where l_suppkey % 50 = 1) as repaired, count(*) filter (where l_partkey % 60 = 0) as unmatched,
  count(*) filter (where l_partkey % 150 = 0) as dropped, 0 as saturated from lineitem group by all), w as (select system, side, sum(exact) as exact, sum(repaired) as repaired, sum(unmatched) as unmatched, sum(dropped) as dropped, sum(saturated) as saturated from s group by all)
select system, side, 'unmatched_newest' as "check", unmatched::double / (exact + repaired + unmatched) < 0.02 as passed from s where newest
union all select system, side, 'unmatched_window', unmatched::double / (exact + repaired + unmatched) < 0.05 from w union all select system, side, 'dropped', dropped::double / (exact + repaired + dropped) < 0.01 from w union all select system, side, 'saturated', saturated = 0 from w""")
def q5_flows_gate(spark, sf):
    line = table(spark, sf, "lineitem")
    stats = line.groupBy(F.col("l_returnflag").alias("system"), F.col("l_linestatus").alias("side"), (F.year("l_shipdate") >= 1998).alias("newest")).agg(
        F.count_if(F.col("l_suppkey") % 50 > 1).alias("exact"), F.count_if(F.col("l_suppkey") % 50 == 1).alias("repaired"), F.count_if(F.col("l_partkey") % 60 == 0).alias("unmatched"),
        F.count_if(F.col("l_partkey") % 150 == 0).alias("dropped"), F.lit(0).alias("saturated"))
    return flows.flows_gate(stats)


@query("""select grouping(system) as no_system, coalesce(system, '') as system, coalesce(month, 0) as month, cast(sum(rows) as bigint) as rows from (select case when o_custkey % 4 = 0 then 'JC' else 'NYC' end as system, cast(year(o_orderdate) * 100 + month(o_orderdate) as integer) as month, count(*) as rows from orders group by all) group by grouping sets ((system, month), (system), ())""")
def a4_totals_by_file_system_window(spark, sf):
    rows, _ = _months(spark, sf)
    rows.createOrReplaceTempView("month_rows")
    return spark.sql("select cast(grouping(system) as bigint) as no_system, coalesce(system, '') as system, coalesce(month, 0) as month, sum(rows) as rows from month_rows group by grouping sets ((system, month), (system), ())")


@query("""with t as (select event_id, strftime(ts, '%Y-%m-%d') || case when event_id % 2 = 0 then 'T' else ' ' end || strftime(ts, '%H:%M') || case event_id % 4 when 0 then '' when 1 then ':30' when 2 then ':61' else ':05.125' end as x, ts from events)
select event_id, case when event_id % 4 <> 2 then cast(ts as date) end as day, case when event_id % 4 <> 2 then cast(hour(ts) * 60 + minute(ts) as integer) end as minute from t""")
def f9_local_time(spark, sf):
    e = table(spark, sf, "events")
    tail = F.when(F.col("event_id") % 4 == 0, "").when(F.col("event_id") % 4 == 1, ":30").when(F.col("event_id") % 4 == 2, ":61").otherwise(":05.125")
    text = F.concat(F.date_format("ts", "yyyy-MM-dd"), F.when(F.col("event_id") % 2 == 0, "T").otherwise(" "), F.date_format("ts", "HH:mm"), tail)
    day, minute = fields.local_minute(text)
    return e.select("event_id", day.alias("day"), minute.alias("minute"))


@query("""select event_id, case event_id % 4 when 0 then 'ebike' when 1 then 'classic' when 2 then 'classic' end as bike, cast((event_id % 1440) // 15 as integer) as bin, regexp_full_match(concat(event_id % 900, '.', event_id % 30), '[0-9]+\\.[0-9]') as lost_zero from events""")
def f10_f11_f13_trip_fields(spark, sf):
    e = table(spark, sf, "events")
    kind = F.element_at(F.array(*map(F.lit, ("electric_bike", "classic_bike", "docked_bike", "scooter"))), (F.col("event_id") % 4 + 1).cast("int"))
    ident = F.concat((F.col("event_id") % 900).cast("string"), F.lit("."), (F.col("event_id") % 30).cast("string"))
    return e.select("event_id", fields.bike_kind(kind).alias("bike"), fields.quarter_hour(F.col("event_id") % 1440).alias("bin"), fields.lost_zero(ident).alias("lost_zero"))


@query(f"with {a.HOLIDAYS} select distinct cast(ts as date) as day, {a.DAY_TYPE.format(d='cast(ts as date)')} as day_type from events")
def f12_day_types(spark, sf):
    return flows.with_day_type(table(spark, sf, "events").select(F.col("ts").cast("date").alias("day")).distinct(), a.holidays(spark)).select("day", "day_type")


@query("""with f as (select o_orderkey, case o_orderkey % 5 when 0 then '202608-citibike-tripdata.zip' when 1 then 'JC-202607-citibike-tripdata.csv.zip' when 2 then 'JC-201708 citibike-tripdata.csv.zip' when 3 then 'JC-202207-citbike-tripdata.csv.zip' else '2023-citibike-tripdata.zip' end as key from orders)
select o_orderkey, case o_orderkey % 5 when 0 then 'NYC' when 4 then null else 'JC' end as system, case o_orderkey % 5 when 0 then 202608 when 1 then 202607 when 2 then 201708 when 3 then 202207 end as month from f""")
def s18_trip_file_names(spark, sf):
    names = ("202608-citibike-tripdata.zip", "JC-202607-citibike-tripdata.csv.zip", "JC-201708 citibike-tripdata.csv.zip", "JC-202207-citbike-tripdata.csv.zip", "2023-citibike-tripdata.zip")
    key = F.element_at(F.array(*map(F.lit, names)), (F.col("o_orderkey") % 5 + 1).cast("int"))
    return table(spark, sf, "orders").select("o_orderkey", *[c.alias(n) for n, c in fields.trip_file(key).items()])


@query("select m as month, cast(case when m % 100 > 9 then m + 100 - 9 else m + 3 end as integer) as later from (select distinct cast(year(o_orderdate) * 100 + month(o_orderdate) as integer) as m from orders)")
def f32_add_months(spark, sf):
    months = table(spark, sf, "orders").select((F.year("o_orderdate") * 100 + F.month("o_orderdate")).alias("month")).distinct()
    return months.select("month", fields.add_months(F.col("month"), 3).alias("later"))
