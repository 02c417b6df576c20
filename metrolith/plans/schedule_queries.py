"""Queries on calendars and schedules."""

from __future__ import annotations

from pyspark.sql import functions as F

from metrolith.functions import fields
from metrolith.operators import calendar, timetable
from metrolith.plans import adapters as a
from metrolith.plans.registry import query, table
from metrolith.sources import gtfs

_EXCEPTIONS = """exceptions as (select o_orderkey as rule, cast(o_orderdate as date) + cast(o_orderkey % 9 as integer) as day, case when o_orderkey % 2 = 0 then 1 else 2 end as kind from orders where o_orderkey % 3 = 0)"""
_RULE_DAYS = f"""{a.RULES}, {_EXCEPTIONS}, span as (select rule, mask, cast(unnest(generate_series(first, last, interval 1 day)) as date) as day from rules),
weekly as (select rule, day from span where (mask >> (isodow(day) - 1)) & 1 = 1),
rule_days as (select rule, day from weekly w where not exists (select 1 from exceptions e where e.kind = 2 and e.rule = w.rule and e.day = w.day) union select rule, day from exceptions where kind = 1)"""


def _exceptions(spark, sf):
    o = table(spark, sf, "orders").where("o_orderkey % 3 = 0")
    day = F.date_add(F.col("o_orderdate").cast("date"), (F.col("o_orderkey") % 9).cast("int"))
    return o.select(F.col("o_orderkey").alias("rule"), day.alias("day"), F.when(F.col("o_orderkey") % 2 == 0, 1).otherwise(2).alias("kind"))


def _rule_days(spark, sf):
    return calendar.rule_days(a.rules(spark, sf), _exceptions(spark, sf))


@query(f"with {_RULE_DAYS} select rule, day from rule_days")
def j13_rule_days(spark, sf):
    return _rule_days(spark, sf)


_CHOSEN = f"""{a.RULES}, cover as (select slot, rule as source, priority, published, ord, cast(unnest(generate_series(first, last, interval 1 day)) as date) as day from rules),
chosen as (select slot, day, source from (select *, row_number() over (partition by slot, day order by priority, published desc, ord) as rn from cover) where rn = 1)"""


def _sources(spark, sf):
    return a.rules(spark, sf).withColumnRenamed("rule", "source")


@query(f"with {_CHOSEN} select slot, day, source from chosen")
def j14_source_selection(spark, sf):
    return calendar.select_sources(_sources(spark, sf))


@query(f"with {_CHOSEN} select day from chosen group by day having count(distinct slot) = (select count(distinct slot) from chosen)")
def a16_common_coverage(spark, sf):
    return calendar.common_days(calendar.select_sources(_sources(spark, sf)))


@query(f"with {_CHOSEN}, ahead as (select slot, day, row_number() over (partition by slot order by day) as n from chosen where day >= date '1996-05-01') select s.slot, count(a.day) as days from (select distinct slot from chosen) s left join ahead a on a.slot = s.slot and date_diff('day', date '1996-05-01', a.day) = a.n - 1 group by s.slot")
def a17_consecutive_days(spark, sf):
    return calendar.consecutive_days(calendar.select_sources(_sources(spark, sf)), ["slot"], F.lit("1996-05-01").cast("date"))


@query(f"""with {a.RULES}, c as (select o.o_custkey as customer, r.first, r.last from rules r join orders o on o.o_orderkey = r.rule), m as (select *, max(last) over (partition by customer order by first, last rows between unbounded preceding and 1 preceding) as before from c),
g as (select *, sum(case when before is null or first > before + 1 then 1 else 0 end) over (partition by customer order by first, last rows between unbounded preceding and current row) as island from m) select customer, min(first) as first, max(last) as last from g group by customer, island""")
def a18_interval_merge(spark, sf):
    o = table(spark, sf, "orders").select(F.col("o_orderkey").alias("rule"), F.col("o_custkey").alias("customer"))
    return calendar.merge_intervals(a.rules(spark, sf).join(o, "rule").select("customer", "first", "last"), ["customer"])


@query(f"with {a.RULES}, {_EXCEPTIONS}, d as (select first as a, last as b from rules union all select day, day from exceptions where kind = 1) select min(a) as first, max(b) as last from d")
def a25_feed_coverage(spark, sf):
    return gtfs.coverage(a.rules(spark, sf), _exceptions(spark, sf))


_SETS = f"""{_RULE_DAYS}, sets as (select r.slot, d.day, list(r.rule order by r.rule) as ran from rule_days d join rules r on r.rule = d.rule group by all)"""


def _sets(spark, sf):
    active = _rule_days(spark, sf).join(a.rules(spark, sf).select("rule", "slot"), "rule")
    return active.groupBy("slot", "day").agg(F.sort_array(F.collect_list("rule")).alias("rules")), active


@query(f"""with {_SETS}, recent as (select *, isodow(day) - 1 as weekday from sets where day < date '1998-01-01' qualify row_number() over (partition by slot, isodow(day) order by day desc) <= 5),
g as (select slot, weekday, ran, count(*) as n, max(day) as day from recent group by all) select slot, cast(weekday as integer) as weekday, day from g qualify row_number() over (partition by slot, weekday order by n desc, day desc) = 1""")
def w9_reference_day(spark, sf):
    return calendar.reference_day(_sets(spark, sf)[0], F.lit("1998-01-01").cast("date"))


@query(f"""with {_SETS}, recent as (select *, isodow(day) - 1 as weekday from sets where day < date '1998-01-01' qualify row_number() over (partition by slot, isodow(day) order by day desc) <= 5),
g as (select slot, weekday, ran, count(*) as n, max(day) as day from recent group by all), ref as (select slot, weekday, day from g qualify row_number() over (partition by slot, weekday order by n desc, day desc) = 1)
select r.slot, d.rule from ref f join rule_days d on d.day = f.day join rules r on r.rule = d.rule and r.slot = f.slot where f.weekday = isodow(date '1998-01-05') - 1 and date '1998-01-05' <= r.last + 14""")
def w10_extrapolated_rules(spark, sf):
    sets, active = _sets(spark, sf)
    references = calendar.reference_day(sets, F.lit("1998-01-01").cast("date"))
    day = F.lit("1998-01-05").cast("date")
    ran = calendar.extrapolated(a.rules(spark, sf).drop("slot"), references, active.select("rule", "day"), day)
    return ran.join(a.rules(spark, sf).select("rule", "slot"), ["rule", "slot"], "left_semi").select("slot", "rule")


@query(f"with {a.RULES}, cover as (select slot, rule as source, priority, published, ord, cast(unnest(generate_series(greatest(first, date '1997-01-01'), least(last, date '1997-03-31'), interval 1 day)) as date) as day from rules where last >= date '1997-01-01' and first <= date '1997-03-31') select distinct slot, source from (select *, row_number() over (partition by slot, day order by priority, published desc, ord) as rn from cover) where rn = 1")
def w11_useful_versions(spark, sf):
    return calendar.useful_versions(_sources(spark, sf), F.lit("1997-01-01").cast("date"), F.lit("1997-03-31").cast("date"))


@query("""with f as (select distinct case when o_custkey % 4 = 0 then 'JC' else 'NYC' end as system, cast(year(o_orderdate) * 100 + month(o_orderdate) as integer) as month from orders where not (o_custkey % 4 = 0 and month(o_orderdate) = 6)), h as (select month, count(distinct system) as n from f group by month),
newest as (select max(month) as m from h where n = 2), w as (select unnest(range((m // 100) * 12 + m % 100 - 1 - 2, (m // 100) * 12 + m % 100)) as s from newest) select cast(s // 12 * 100 + s % 12 + 1 as integer) as month, coalesce(h.n, 0) < 2 as missing from w left join h on h.month = s // 12 * 100 + s % 12 + 1""")
def t6_months_to_build(spark, sf):
    o = table(spark, sf, "orders").where("not (o_custkey % 4 = 0 and month(o_orderdate) = 6)")
    files = o.select(F.when(F.col("o_custkey") % 4 == 0, "JC").otherwise("NYC").alias("system"), (F.year("o_orderdate") * 100 + F.month("o_orderdate")).alias("month")).distinct()
    return calendar.months_to_build(files, ["NYC", "JC"], 3)


@query(f"with {a.HOLIDAYS}, d as (select distinct cast(ts as date) as day from events where hour(ts) = 3), r as (select day, case when day not in (select day from holidays) and isodow(day) between 2 and 4 then 0 when day not in (select day from holidays) and isodow(day) < 6 then 1 else 2 end as rank from d) select day, rank from r order by rank, day limit 1")
def t8_first_service_day(spark, sf):
    days = table(spark, sf, "events").where("hour(ts) = 3").select(F.col("ts").cast("date").alias("day"))
    return calendar.first_service_day(days, a.holidays(spark))


@query(f"with {_CHOSEN}, c as (select day from chosen group by day having count(distinct slot) = (select count(distinct slot) from chosen)) select min(day) as day from c where isodow(day) = 4 and day between date '1996-03-01' and date '1996-03-01' + 60")
def t9_representative_day(spark, sf):
    common = calendar.common_days(calendar.select_sources(_sources(spark, sf)))
    start = F.lit("1996-03-01").cast("date")
    return common.where((F.weekday("day") == 3) & F.col("day").between(start, F.date_add(start, 60))).agg(F.min("day").alias("day"))


@query("with e as (select distinct cast(ts as date) as day from events where event_type = 'click' and hour(ts) = 1), f as (select distinct cast(ts as date) as day from events where event_type = 'view' and hour(ts) = 2) select 'both' as side, day from (select day from e intersect select day from f) union all select 'first only', day from (select day from e except select day from f)")
def t7_set_operations(spark, sf):
    e = table(spark, sf, "events")
    first = e.where("event_type = 'click' and hour(ts) = 1").select(F.col("ts").cast("date").alias("day"))
    second = e.where("event_type = 'view' and hour(ts) = 2").select(F.col("ts").cast("date").alias("day"))
    return first.intersect(second).select(F.lit("both").alias("side"), "day").unionByName(first.subtract(second).select(F.lit("first only").alias("side"), "day"))


# stop times

@query(f"""with {a.EVENTS_OF_TRIPS}, f as (select trip, pos, coalesce(arrival, departure) as a, coalesce(departure, arrival) as d from calls),
b as (select *, last_value(d ignore nulls) over (partition by trip order by pos rows between unbounded preceding and 1 preceding) as before from f),
j as (select *, case when a + 43200 < before then 1 else 0 end as ja, case when d + 43200 < a then 1 else 0 end as jd from b),
u as (select trip, pos, a + 86400 * sum(ja) over w + 86400 * coalesce(sum(jd) over v, 0) as a, d + 86400 * sum(ja + jd) over w as d from j window w as (partition by trip order by pos rows between unbounded preceding and current row), v as (partition by trip order by pos rows between unbounded preceding and 1 preceding)),
n as (select *, last_value(d ignore nulls) over p as low, first_value(a ignore nulls) over q as high, last_value(case when a is not null then pos end ignore nulls) over p as lp, first_value(case when a is not null then pos end ignore nulls) over q as hp from u window p as (partition by trip order by pos rows between unbounded preceding and 1 preceding), q as (partition by trip order by pos rows between 1 following and unbounded following)),
g as (select trip, pos, coalesce(a, low + ((high - low) * (pos - lp)) // nullif(hp - lp, 0)) as a, case when a is null then low + ((high - low) * (pos - lp)) // nullif(hp - lp, 0) else d end as d from n),
m as (select trip, pos, a, d, greatest(max(greatest(a, d)) over (partition by trip order by pos rows between unbounded preceding and 1 preceding), a) as aa from g)
select trip, pos, cast(aa as bigint) as arrival, cast(greatest(aa, d) as bigint) as departure, coalesce(aa > a, false) or coalesce(greatest(aa, d) > d, false) as repaired from m""")
def w1_w2_w3_clean_times(spark, sf):
    found = timetable.clean_times(a.events_of_trips(spark, sf))
    return found.select("trip", "pos", "arrival", "departure", F.coalesce("repaired", F.lit(False)).alias("repaired"))


@query(f"""with {a.EVENTS_OF_TRIPS}, e as (select trip, count(*) as calls, arg_min(struct_pack(x := coalesce(departure, arrival)), pos).x as first, arg_max(struct_pack(x := coalesce(arrival, departure)), pos).x as last from calls group by trip)
select trip, case when calls < 2 then 'few_calls' when first is null or last is null then 'no_end_time' end as reason from e""")
def p4_trip_drop_reasons(spark, sf):
    return timetable.trip_drop_reason(a.events_of_trips(spark, sf).withColumn("stop", F.col("stop")))


@query(f"with {a.EVENTS_OF_TRIPS} select l_partkey % 300 as stop from (select l_partkey, cast(l_partkey % 3 = 0 as integer) as pickup, cast(l_partkey % 3 = 0 as integer) as drop_off from lines) group by 1 having bool_and(pickup = 1 and drop_off = 1)")
def p3_pass_through_stops(spark, sf):
    none = (F.col("l_partkey") % 3 == 0).cast("int")
    return timetable.pass_through_stops(a.lines(spark, sf).select((F.col("l_partkey") % 300).alias("stop"), none.alias("pickup"), none.alias("drop_off")))


@query("""with c as (select distinct cast(l_suppkey as bigint) as stop from lineitem), p as (select s_suppkey as stop, case when s_suppkey > 3 then s_suppkey // 3 end as parent from supplier),
u0 as (select stop from c), u1 as (select distinct parent as stop from p join u0 using (stop) where parent is not null), u2 as (select distinct parent as stop from p join u1 using (stop) where parent is not null), u3 as (select distinct parent as stop from p join u2 using (stop) where parent is not null),
u4 as (select distinct parent as stop from p join u3 using (stop) where parent is not null), u5 as (select distinct parent as stop from p join u4 using (stop) where parent is not null), u6 as (select distinct parent as stop from p join u5 using (stop) where parent is not null), u7 as (select distinct parent as stop from p join u6 using (stop) where parent is not null), u8 as (select distinct parent as stop from p join u7 using (stop) where parent is not null)
select stop from u0 union select stop from u1 union select stop from u2 union select stop from u3 union select stop from u4 union select stop from u5 union select stop from u6 union select stop from u7 union select stop from u8""")
def p7_called_stops_and_ancestors(spark, sf):
    called = table(spark, sf, "lineitem").select(F.col("l_suppkey").alias("stop"))
    parents = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("stop"), F.when(F.col("s_suppkey") > 3, F.floor(F.col("s_suppkey") / 3)).alias("parent"))
    return timetable.with_ancestors(called, parents)


@query("with r as (select c_nationkey as route, c_custkey as ord, c_name as name from customer) select route, arg_min(name, ord) as name, min(ord) as ord from r group by route")
def s6_first_row_wins(spark, sf):
    rows = table(spark, sf, "customer").select(F.col("c_nationkey").alias("route"), F.col("c_custkey").alias("ord"), F.col("c_name").alias("name"))
    return timetable.first_by(rows, ["route"], "ord").select("route", "name", "ord")


@query("select l_suppkey as rule, cast(l_shipdate as date) as day, max_by(l_partkey % 2 + 1, l_orderkey * 10 + l_linenumber) as kind from lineitem group by all")
def s8_last_row_wins(spark, sf):
    rows = table(spark, sf, "lineitem").select(F.col("l_suppkey").alias("rule"), F.col("l_shipdate").cast("date").alias("day"), (F.col("l_partkey") % 2 + 1).alias("kind"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("ord"))
    return timetable.last_by(rows, ["rule", "day"], "ord").select("rule", "day", "kind")


@query("with k as (select c_custkey from customer where c_custkey % 7 <> 0) select case when o_custkey in (select c_custkey from k) then 'kept' else 'unknown' end as outcome, count(*) as n from orders group by 1")
def j1_unknown_rows(spark, sf):
    kept, lost = timetable.known_only(table(spark, sf, "orders"), "o_custkey", table(spark, sf, "customer").where("c_custkey % 7 <> 0"), "c_custkey")
    return kept.agg(F.lit("kept").alias("outcome"), F.count("*").alias("n")).unionByName(lost.agg(F.lit("unknown").alias("outcome"), F.count("*").alias("n")))


_PATTERN = a.LINES + ", keyed as (select l_orderkey as trip, concat_ws('|', o_orderstatus, cast(o_custkey % 2 as varchar), string_agg(concat(cast(l_suppkey % 4 as varchar), ':', cast(l_partkey % 2 as varchar)), ',' order by l_linenumber)) as k from lines join orders on o_orderkey = l_orderkey group by l_orderkey, o_orderstatus, o_custkey)"


def _patterns(spark, sf):
    line = a.lines(spark, sf)
    calls = line.select(F.col("l_orderkey").alias("trip"), F.col("l_linenumber").alias("pos"), (F.col("l_suppkey") % 4).alias("stop"), (F.col("l_partkey") % 2).alias("flags"))
    trips = table(spark, sf, "orders").select(F.col("o_orderkey").alias("trip"), F.col("o_orderstatus").alias("slot"), (F.col("o_custkey") % 2).cast("string").alias("route"))
    return timetable.base_patterns(calls, trips)


@query(f"with {_PATTERN} select trip, min(trip) over (partition by k) as pattern from keyed")
def w4_base_patterns(spark, sf):
    return _patterns(spark, sf)


# greedy first fit: a trip's part is the least number that no earlier trip has which shares a day and would be overtaken
@query(f"""with recursive {_PATTERN}, base as (select trip, min(trip) over (partition by k) as pattern from keyed), tm as (select l_orderkey as trip, flatten(list([m, m + 30] order by l_linenumber)) as t from (select *, (l_orderkey % 500) * 10 + l_linenumber * 600 - (l_orderkey % 7) * 60 * l_linenumber as m from lines) group by 1),
r as (select b.trip, b.pattern, t, b.trip % 3 as day, row_number() over (partition by b.pattern order by t[2], t[3:], b.trip) as i from base b join tm on tm.trip = b.trip),
bad as (select y.pattern, y.i, list(x.i) as js from r x join r y on x.pattern = y.pattern and x.i < y.i and abs(x.day - y.day) <= 1 and len(list_filter(range(1, len(x.t) + 1), lambda j: y.t[j] < x.t[j])) > 0 group by all),
go as (select pattern, 0::bigint as i, []::integer[] as subs from r where i = 1 union all select g.pattern, g.i + 1, list_append(g.subs, list_min(list_filter(range(0, cast(g.i as bigint) + 1), lambda s: not list_contains(list_transform(coalesce(b.js, []::bigint[]), lambda j: g.subs[j]), cast(s as integer))))::integer) from go g join r on r.pattern = g.pattern and r.i = g.i + 1 left join bad b on b.pattern = g.pattern and b.i = g.i + 1),
done as (select pattern, arg_max(subs, i) as subs from go group by 1) select r.trip, r.pattern, d.subs[r.i] as sub from r join done d on d.pattern = r.pattern""")
def w5_fifo_patterns(spark, sf):
    line = a.lines(spark, sf)
    at = (F.col("l_orderkey") % 500) * 10 + F.col("l_linenumber") * 600 - (F.col("l_orderkey") % 7) * 60 * F.col("l_linenumber")
    events = line.select(F.col("l_orderkey").alias("trip"), F.col("l_linenumber").alias("pos"), at.alias("arrival"), (at + 30).alias("departure"))
    service = table(spark, sf, "orders").select(F.col("o_orderkey").alias("trip"), F.array(F.col("o_orderkey") % 3, F.col("o_orderkey") % 3 + 1).alias("days"))
    return timetable.fifo_patterns(events, _patterns(spark, sf), service)


@query("""with s as (select l_suppkey as stop, l_linenumber as feed, count(*) as n from lineitem group by all), a as (select s_suppkey as stop, f as feed, concat(s_name, '/', f) as name from supplier, (values (1), (2), (3)) t(f)), j as (select a.*, coalesce(n, 0) as n from a left join s on s.stop = a.stop and s.feed = a.feed)
select stop, feed, name from j qualify row_number() over (partition by stop order by n desc, feed) = 1""")
def j3_merged_stops(spark, sf):
    s = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("stop"), F.explode(F.array(F.lit(1), F.lit(2), F.lit(3))).alias("feed"), "s_name")
    stops = s.select("stop", "feed", F.concat("s_name", F.lit("/"), F.col("feed").cast("string")).alias("name"))
    calls = table(spark, sf, "lineitem").select(F.col("l_linenumber").alias("feed"), F.col("l_suppkey").alias("stop"))
    return timetable.merge_stops(stops, calls).select("stop", "feed", "name")


@query("""with d as (select l_suppkey as station, l_linenumber as kind, cast(l_partkey as integer) as lat, cast(l_orderkey as integer) as lon from lineitem)
select station, lat, lon, kind, concat(cast(station as varchar), '-E', row_number() over (partition by station order by lat, lon, kind)) as id from d""")
def j8_w6_entrance_ids(spark, sf):
    doors = table(spark, sf, "lineitem").select(F.col("l_suppkey").alias("station"), F.col("l_linenumber").alias("kind"), F.col("l_partkey").cast("int").alias("lat"), F.col("l_orderkey").cast("int").alias("lon"))
    return timetable.ordinal_ids(doors, "station", ["lat", "lon", "kind"])


@query("select l_suppkey as stop, count(distinct l_orderkey % 500) as patterns, count(*) as places from lineitem group by 1")
def j12_stop_incidence(spark, sf):
    return timetable.incidence(table(spark, sf, "lineitem").select((F.col("l_orderkey") % 500).alias("pattern"), F.col("l_suppkey").alias("stop")))


_SUBWAY = "ids as (select l_orderkey * 10 + l_linenumber as row, case when l_orderkey % 11 = 0 then concat('AFA_', l_partkey) else concat('AFA26GEN-', l_suppkey % 10, '_', case when l_partkey % 9 = 0 then '-' else '' end, lpad(cast(l_partkey * 37 % 1000000 as varchar), 6, '0'), '_', l_linenumber, case when l_linenumber % 2 = 0 then '..' else '.' end, case when l_suppkey % 2 = 0 then 'N' else 'S' end, case when l_orderkey % 3 = 0 then '' else concat(l_suppkey % 90, 'R') end) end as id from lineitem)"
_SUBWAY_KEYS = f"""{_SUBWAY}, keyed as (select row, id, case when regexp_matches(id, '_(-?[0-9]{{6}})_([A-Z0-9]+)\\.+([NS])(.*)$') then regexp_extract(id, '_(-?[0-9]{{6}})_([A-Z0-9]+)\\.+([NS])(.*)$', ['origin', 'route', 'direction', 'path']) end as k from ids)"""


def _subway_ids(spark, sf):
    line = table(spark, sf, "lineitem")
    text = lambda c: c.cast("string")
    number = F.lpad(text(F.col("l_partkey") * 37 % 1000000), 6, "0")
    long = F.concat(
        F.lit("AFA26GEN-"), text(F.col("l_suppkey") % 10), F.lit("_"), F.when(F.col("l_partkey") % 9 == 0, "-").otherwise(""), number, F.lit("_"), text(F.col("l_linenumber")),
        F.when(F.col("l_linenumber") % 2 == 0, "..").otherwise("."), F.when(F.col("l_suppkey") % 2 == 0, "N").otherwise("S"), F.when(F.col("l_orderkey") % 3 == 0, "").otherwise(F.concat(text(F.col("l_suppkey") % 90), F.lit("R"))),
    )
    ident = F.when(F.col("l_orderkey") % 11 == 0, F.concat(F.lit("AFA_"), text(F.col("l_partkey")))).otherwise(long)
    return line.select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("row"), ident.alias("id"))


@query(f"with {_SUBWAY_KEYS} select row, cast(k.origin as integer) as origin, k.route as route, k.direction as direction, k.path as path, cast((cast(k.origin as integer) * 60 + case when cast(k.origin as integer) >= 0 then 50 else -50 end) // 100 as integer) as seconds from keyed")
def f15_f16_subway_trip_keys(spark, sf):
    ids = _subway_ids(spark, sf)
    keyed = ids.select("row", *[c.alias(n) for n, c in fields.subway_key(F.col("id")).items()])
    return keyed.withColumn("seconds", fields.half_minute_seconds(F.col("origin")))


@query(f"with {_SUBWAY_KEYS} select row, row_number() over (order by k.route, k.direction, cast(k.origin as integer), k.path, row) as place from keyed where k is not null order by place limit 100")
def t5_subway_key_order(spark, sf):
    from pyspark.sql import Window

    keyed = _subway_ids(spark, sf).select("row", *[c.alias(n) for n, c in fields.subway_key(F.col("id")).items()]).where("route is not null")
    first = keyed.orderBy("route", "direction", "origin", "path", "row").limit(100)  # a top-k report
    return first.select("row", F.row_number().over(Window.orderBy("route", "direction", "origin", "path", "row")).alias("place"))


@query(f"with {_SUBWAY_KEYS} select a.row as static_row, b.row as live_row from keyed a join keyed b on a.k.route = b.k.route and a.k.direction = b.k.direction and a.k.origin = b.k.origin and a.k.path = b.k.path where a.row % 3 = 0 and b.row % 3 = 1")
def j17_static_and_live_keys(spark, sf):
    keyed = _subway_ids(spark, sf).select("row", *[c.alias(n) for n, c in fields.subway_key(F.col("id")).items()]).where("route is not null")
    live = keyed.where("row % 3 = 1").withColumnRenamed("row", "live_row")
    return keyed.where("row % 3 = 0").withColumnRenamed("row", "static_row").join(live, ["route", "direction", "origin", "path"]).select("static_row", "live_row")


@query("select l_orderkey as trip, l_linenumber as pos, l_suppkey as stop from lineitem where l_orderkey in (7, 100, 1001)")
def j18_lookup_by_id(spark, sf):
    return table(spark, sf, "lineitem").where(F.col("l_orderkey").isin(7, 100, 1001)).select(F.col("l_orderkey").alias("trip"), F.col("l_linenumber").alias("pos"), F.col("l_suppkey").alias("stop"))


@query("select l_orderkey as trip, l_partkey * 30 as arrival, l_partkey * 30 + l_linenumber as departure from lineitem where l_suppkey = 5 or l_suppkey in (select s_suppkey from supplier where s_nationkey = 5)")
def t1_calls_at_station(spark, sf):
    events = table(spark, sf, "lineitem").select(F.col("l_suppkey").alias("stop"), F.col("l_orderkey").alias("trip"), (F.col("l_partkey") * 30).alias("arrival"), (F.col("l_partkey") * 30 + F.col("l_linenumber")).alias("departure"))
    stops = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("stop"), F.col("s_nationkey").cast("bigint").alias("parent"))
    return timetable.calls_at(events, stops, F.lit(5)).select("trip", "arrival", "departure")


@query(f"with {_RULE_DAYS}, calls as (select l_orderkey as rule, count(*) as calls from lineitem group by 1) select d.day, count(*) as trips, cast(sum(c.calls) as bigint) as calls from rule_days d join calls c on c.rule = d.rule group by d.day")
def a12_trips_by_day(spark, sf):
    trips = table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("rule")).agg(F.count("*").alias("calls"))
    return timetable.services_on_days(trips, _rule_days(spark, sf))


_MODE = "case when p_type like 'PROMO%' then 'subway' when p_type like 'STANDARD%' then 'path' else 'bus' end"


@query(f"""with r as (select p_partkey, {_MODE} as system, concat(case p_partkey % 8 when 0 then 'x' when 1 then 'Bx' when 2 then 'BxM' when 3 then 'sim' when 4 then 'QM' when 5 then 'M' when 6 then 'B' else 'bm' end, p_size, case when p_size % 5 = 0 then '+' else '' end) as route from part)
select system, case when system <> 'bus' then system when route like '%+' then 'sbs' when regexp_matches(upper(route), '^(BXM|SIM|BM|QM|X)') then 'express_bus' else 'local_bus' end as mode, count(*) as n from r group by all""")
def f17_a13_routes_by_mode(spark, sf):
    p = table(spark, sf, "part")
    system = F.when(F.col("p_type").startswith("PROMO"), "subway").when(F.col("p_type").startswith("STANDARD"), "path").otherwise("bus")
    head = F.element_at(F.array(*map(F.lit, ("x", "Bx", "BxM", "sim", "QM", "M", "B", "bm"))), (F.col("p_partkey") % 8 + 1).cast("int"))
    route = F.concat(head, F.col("p_size").cast("string"), F.when(F.col("p_size") % 5 == 0, "+").otherwise(""))
    return p.groupBy(system.alias("system"), fields.route_mode(system, route).alias("mode")).agg(F.count("*").alias("n"))


@query(f"select p_partkey, case when {_MODE} = 'path' and p_size % 3 <> 0 then p_brand else p_name end as name from part")
def f18_route_long_names(spark, sf):
    p = table(spark, sf, "part")
    system = F.when(F.col("p_type").startswith("PROMO"), "subway").when(F.col("p_type").startswith("STANDARD"), "path").otherwise("bus")
    return p.select("p_partkey", fields.route_long_name(system, F.col("p_name"), F.when(F.col("p_size") % 3 != 0, F.col("p_brand")).otherwise("")).alias("name"))


@query("with c as (select l_suppkey as pattern, l_partkey % 5 as shape, count(*) as n, min(l_orderkey * 10 + l_linenumber) as seen from lineitem where l_partkey % 7 <> 0 group by all) select pattern, shape from c qualify row_number() over (partition by pattern order by n desc, seen) = 1")
def a14_common_shape(spark, sf):
    line = table(spark, sf, "lineitem")
    trips = line.select(F.col("l_suppkey").alias("pattern"), F.when(F.col("l_partkey") % 7 != 0, F.col("l_partkey") % 5).alias("shape"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("ord"))
    return timetable.common_shape(trips)


@query(f"""with {a.LINES}, t as (select l_orderkey as trip, list(l_partkey % 400 + l_linenumber * 300 order by l_linenumber) as times from lines group by 1) select a.trip, len(list_filter(range(1, len(a.times) + 1), lambda i: b.times[i] < a.times[i])) > 0 as overtaken from t a join t b on b.trip = a.trip + 1 where len(a.times) = len(b.times)""")
def a15_overtaking(spark, sf):
    times = a.lines(spark, sf).groupBy(F.col("l_orderkey").alias("trip")).agg(F.transform(F.sort_array(F.collect_list(F.struct("l_linenumber", (F.col("l_partkey") % 400 + F.col("l_linenumber") * 300).alias("t")))), lambda x: x["t"]).alias("times"))
    later = times.select((F.col("trip") - 1).alias("trip"), F.col("times").alias("later"))
    pairs = times.join(later, "trip").where(F.size("times") == F.size("later"))
    return pairs.select("trip", timetable.overtaking(F.col("times"), F.col("later")).alias("overtaken"))


@query(f"""with {a.LINES}, p as (select l_orderkey as pattern, l_orderkey // 40 as route, list(l_suppkey % 2 order by l_linenumber) as stops, l_orderkey % 4 = 0 as has_shape from lines group by 1), f as (select a.pattern, b.pattern as lender, len(b.stops) as n from p a join p b on a.route = b.route and b.has_shape where not a.has_shape
  and list_reduce(list_prepend(0::bigint, b.stops), lambda k, x: case when k < len(a.stops) and a.stops[k + 1] = x then k + 1 else k end) = len(a.stops)) select pattern, lender from f qualify row_number() over (partition by pattern order by n, lender) = 1""")
def w8_borrowed_shapes(spark, sf):
    line = a.lines(spark, sf)
    p = line.groupBy(F.col("l_orderkey").alias("pattern")).agg(F.transform(F.sort_array(F.collect_list(F.struct("l_linenumber", (F.col("l_suppkey") % 2).alias("s")))), lambda x: x["s"]).alias("stops"))
    return timetable.borrowed_shapes(p.select("pattern", F.floor(F.col("pattern") / 40).alias("route"), "stops", (F.col("pattern") % 4 == 0).alias("has_shape")))


@query("""with l as (select l_orderkey as trip, l_linenumber as pos, lpad(cast(l_partkey % 48 as varchar), case when l_suppkey % 2 = 0 then 1 else 2 end, '0') as h, l_partkey as k from lineitem),
x as (select trip, pos, k, concat(case when k % 5 = 0 then ' ' else '' end, cast(k % 48 as varchar), ':', lpad(cast(k % 70 as varchar), 2, '0'), ':', lpad(cast(k % 60 as varchar), 2, '0')) as t from l) select trip, pos, case when k % 70 < 60 then (k % 48) * 3600 + (k % 70) * 60 + k % 60 end as seconds from x""")
def f2_clock_times(spark, sf):
    k = F.col("l_partkey")
    two = lambda c: F.lpad(c.cast("string"), 2, "0")
    text = F.concat(F.when(k % 5 == 0, " ").otherwise(""), (k % 48).cast("string"), F.lit(":"), two(k % 70), F.lit(":"), two(k % 60))
    return table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("trip"), F.col("l_linenumber").alias("pos"), fields.parse_clock(text).alias("seconds"))


@query("""select p_partkey, case p_partkey % 4 when 3 then null else (case when p_partkey % 2 = 0 then 1 else -1 end) * ((p_partkey % 90) * 1000000 + (p_partkey * 7919) % 1000000 + case when p_partkey % 10 >= 5 then 1 else 0 end) end as micro,
case when p_partkey % 3 = 0 then null else p_partkey * 65537 % 16777216 end as color, case when p_partkey % 13 = 0 then null else date '1998-01-01' + cast(p_partkey % 400 as integer) end as day, case when p_partkey % 2 = 0 then p_partkey end as count_of, case when p_partkey % 5 = 0 then null else -p_partkey end as signed from part""")
def f1_f3_f4_f5_f6_s2_fields(spark, sf):
    k = F.col("p_partkey")
    degrees = F.concat(F.when(k % 2 == 0, "").otherwise("-"), (k % 90).cast("string"), F.lit("."), F.lpad((k * 7919 % 1000000).cast("string"), 6, "0"), (k % 10).cast("string"), F.when(k % 4 == 3, "x").otherwise("9 \t"))
    color = F.concat(F.when(k % 2 == 0, "#").otherwise(""), F.lpad(F.hex(k * 65537 % 16777216), 6, "0"), F.when(k % 3 == 0, "0").otherwise(""))
    day = F.when(k % 13 == 0, "19980231").otherwise(F.date_format(F.date_add(F.lit("1998-01-01").cast("date"), (k % 400).cast("int")), "yyyyMMdd"))
    count = F.concat(F.lit(" "), k.cast("string"), F.when(k % 2 == 0, "\t").otherwise("-"))
    signed = F.concat(F.lit("-"), k.cast("string"), F.when(k % 5 == 0, " ").otherwise(""))
    return table(spark, sf, "part").select("p_partkey", fields.parse_microdegrees(degrees).alias("micro"), fields.parse_color(color).alias("color"), fields.parse_day(day).alias("day"), fields.parse_count(count).alias("count_of"), fields.parse_int(signed).alias("signed"))


@query("select distinct cast(o_orderdate as date) as day, date_diff('day', date '1970-01-01', cast(o_orderdate as date)) as number, isodow(o_orderdate) - 1 as weekday, cast(o_orderdate as date) + 10 as later from orders")
def f7_day_numbers(spark, sf):
    day = F.col("o_orderdate").cast("date")
    return table(spark, sf, "orders").select(day.alias("day"), fields.day_number(day).alias("number"), F.weekday(day).alias("weekday"), F.date_add(day, 10).alias("later")).distinct()
