"""Queries that check: gates, references, constraints."""

from __future__ import annotations

from pyspark.sql import functions as F

from metrolith.operators import calendar, flows, gates
from metrolith.plans import adapters as a
from metrolith.plans.registry import query, table

_TRIPS = """old as (select l_returnflag as system, cast(l_shipdate as date) as day, count(*) as trips from lineitem where l_shipdate < timestamp '1997-01-01' group by all),
new as (select l_returnflag as system, cast(l_shipdate as date) + case when l_orderkey % 2 = 0 then 0 else 400 end as day, count(*) as trips from lineitem where l_shipdate >= timestamp '1996-10-01' and l_shipdate < timestamp '1997-02-01' group by all),
off as (select cast(unnest(['1996-11-28', '1996-12-25', '1997-01-01', '1998-01-29']) as date) as day)"""


def _trip_counts(spark, sf):
    line = table(spark, sf, "lineitem")
    day = F.col("l_shipdate").cast("date")
    old = line.where("l_shipdate < '1997-01-01'").groupBy(F.col("l_returnflag").alias("system"), day.alias("day")).agg(F.count("*").alias("trips"))
    moved = F.date_add(day, F.when(F.col("l_orderkey") % 2 == 0, 0).otherwise(400))
    new = line.where("l_shipdate >= '1996-10-01' and l_shipdate < '1997-02-01'").groupBy(F.col("l_returnflag").alias("system"), moved.alias("day")).agg(F.count("*").alias("trips"))
    off = spark.createDataFrame([("1996-11-28",), ("1996-12-25",), ("1997-01-01",), ("1998-01-29",)], "day string").select(F.col("day").cast("date").alias("day"))
    return new, old, off


@query(f"""with {_TRIPS}, md as (select system, isodow(day) - 1 as weekday, median(trips) as usual from old where day not in (select day from off) group by all),
hp as (select n.system, n.day, arg_min(m.usual, struct_pack(d := abs(n.trips - m.usual), u := m.usual)) as profile from new n join md m on m.system = n.system and m.weekday in (isodow(n.day) - 1, 5, 6) where n.day in (select day from off) group by all),
r as (select n.system, n.day, n.trips, o.trips as same, n.day in (select day from off) as holiday, m.usual, hp.profile from new n left join old o on o.system = n.system and o.day = n.day left join md m on m.system = n.system and m.weekday = isodow(n.day) - 1 left join hp on hp.system = n.system and hp.day = n.day),
j as (select system, day, trips, coalesce(same::double, case when holiday then profile else usual end) as reference, case when same is not null then 'same day' when holiday and profile is not null then 'holiday profile' when not holiday and usual is not null then 'weekday median' else 'none' end as basis from r)
select *, case when basis = 'none' then 'no reference' when not (reference > 0 and abs((trips - reference) * 100) > reference * 60) then 'ok' when system = 'A' and -(trips - reference) * 100 <= reference * 75 then 'accepted' else 'failed' end as status from j""")
def q1_j22_trip_count_gate(spark, sf):
    new, old, off = _trip_counts(spark, sf)
    return gates.trip_count_gate(new, old, off, 60, ("A",), 75)


@query(f"""with {a.RULES}, cover as (select distinct slot, cast(unnest(generate_series(first, last, interval 1 day)) as date) as day from rules), ahead as (select slot, day, row_number() over (partition by slot order by day) as n from cover where day >= date '1996-05-01'),
c as (select s.slot, count(x.day) as days from (select distinct slot from cover) s left join ahead x on x.slot = s.slot and date_diff('day', date '1996-05-01', x.day) = x.n - 1 group by s.slot) select slot, days, case when days >= 14 then 'ok' else 'soft failure' end as status from c""")
def q2_coverage_gate(spark, sf):
    rules = a.rules(spark, sf)
    days = rules.select("slot", F.explode(F.sequence("first", "last", F.expr("interval 1 day"))).alias("day")).distinct()
    return gates.coverage_gate(calendar.consecutive_days(days, ["slot"], F.lit("1996-05-01").cast("date")), 14)


@query("with s as (select l_linenumber as region, cast(sum(l_partkey) as bigint) as total, cast(sum(case when l_suppkey % 100 >= l_linenumber then l_partkey else 0 end) as bigint) as kept from lineitem group by 1) select region, total, kept, case when kept * 100 >= total * 96 then 'ok' else 'failed' end as status from s")
def q3_a22_kept_share_gate(spark, sf):
    line = table(spark, sf, "lineitem")
    return gates.kept_share_gate(line.select(F.col("l_linenumber").alias("region"), F.col("l_partkey").alias("length"), (F.col("l_suppkey") % 100 >= F.col("l_linenumber")).alias("kept")), 96)


@query("""with s as (select s_suppkey as stop, case when s_suppkey % 9 <> 0 then s_suppkey * 2711 % 200000 end as mm from supplier), al as (select s_suppkey as stop, case when s_suppkey % 2 = 0 then 180000::bigint end as most from supplier where s_suppkey % 4 = 0 union all select s_suppkey + 100000, null from supplier where s_suppkey < 4),
j as (select s.stop, mm, case when not (mm is null or mm > 150000) then 'ok' when al.stop is not null and (most is null or coalesce(mm, 0) <= most) then 'allowed' else 'failed' end as status from s left join al on al.stop = s.stop)
select * from j union all select stop, null, 'stale' from al where stop not in (select stop from j where status = 'allowed')""")
def q4_snapping_gate(spark, sf):
    s = table(spark, sf, "supplier")
    k = F.col("s_suppkey")
    snaps = s.select(k.alias("stop"), F.when(k % 9 != 0, k * 2_711 % 200_000).alias("mm"))
    allowed = s.where("s_suppkey % 4 = 0").select(k.alias("stop"), F.when(k % 2 == 0, F.lit(180_000).cast("bigint")).alias("most"))
    unknown = s.where("s_suppkey < 4").select((k + 100_000).alias("stop"), F.lit(None).cast("bigint").alias("most"))
    return gates.snapping_gate(snaps, allowed.unionByName(unknown), 150_000)


@query("select * from (values ('streets', 'ok'), ('links', 'missing'), ('flows', 'repeated'), ('config', 'wrong format'), ('stations', 'unreadable')) t(kind, status)")
def q6_artifact_gate(spark, sf):
    rows = [("streets", True, 1), ("flows", True, 1), ("flows", True, 1), ("config", True, 2), ("stations", False, 1)]
    artifacts = spark.createDataFrame(rows, "kind string, opens boolean, format int")
    return gates.artifact_gate(artifacts, [("streets", 1), ("links", 1), ("flows", 1), ("config", 1), ("stations", 1)])


@query("with b as (select l_returnflag as artifact, l_linestatus as input, cast(l_suppkey as varchar) as sha from lineitem), p as (select distinct l_linestatus as artifact, cast(l_suppkey as varchar) as sha from lineitem where l_suppkey % 5 <> 0) select b.artifact, b.input, b.sha from b where not exists (select 1 from p where p.artifact = b.input and p.sha = b.sha)")
def j20_lineage_breaks(spark, sf):
    line = table(spark, sf, "lineitem")
    built = line.select(F.col("l_returnflag").alias("artifact"), F.col("l_linestatus").alias("input"), F.col("l_suppkey").cast("string").alias("sha"))
    present = line.where("l_suppkey % 5 <> 0").select(F.col("l_linestatus").alias("artifact"), F.col("l_suppkey").cast("string").alias("sha")).distinct()
    return gates.lineage_breaks(built, present)


@query("select o_orderkey, o_custkey from orders where o_custkey not in (select c_custkey from customer where c_custkey % 10 <> 3)")
def j19_missing_references(spark, sf):
    return gates.missing_references(table(spark, sf, "orders").select("o_orderkey", "o_custkey"), "o_custkey", table(spark, sf, "customer").where("c_custkey % 10 <> 3"), "c_custkey")


@query("with f as (select distinct cast(ts as date) as day from events), k as (select cast(ts as date) as day, user_id, count(*) as n, min(event_id) as low from events group by all) select user_id, day, n from k where n > 3 or day < date '2024-01-01'")
def q10_flow_invariants(spark, sf):
    counts = table(spark, sf, "events").groupBy("user_id", F.col("ts").cast("date").alias("day")).agg(F.count("*").alias("n"))
    return counts.where((F.col("n") > 3) | (F.col("day") < F.lit("2024-01-01").cast("date")))


@query("select l_orderkey, l_linenumber, count(*) as n from lineitem group by all having count(*) > 1")
def v1_duplicate_keys(spark, sf):
    return gates.duplicate_keys(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(f"with {a.LINES}, b as (select l_orderkey, l_linenumber, l_partkey, lag(l_partkey) over (partition by l_orderkey order by l_linenumber) as before from lines) select l_orderkey, l_linenumber, l_partkey, before as \"before\" from b where l_partkey <= before")
def v5_v7_not_ascending(spark, sf):
    return gates.not_ascending(a.lines(spark, sf).drop("l_suppkey"), ["l_orderkey"], "l_linenumber", "l_partkey")


@query("""with z as (select distinct n_nationkey % 9 as zone from nation), f as (select s_suppkey % 9 as x, s_nationkey % 10 as y from supplier), w as (select p.zone as low, q.zone as high from z p join z q on p.zone <= q.zone), h as (select least(x, y) as low, greatest(x, y) as high, count(*) as n from f group by all)
select low, high, 'missing' as problem from w where not exists (select 1 from h where h.low = w.low and h.high = w.high) union all select low, high, 'repeated' from h where n > 1 and exists (select 1 from w where h.low = w.low and h.high = w.high) union all select low, high, 'unused' from h where not exists (select 1 from w where h.low = w.low and h.high = w.high)""")
def v2_zone_matrix(spark, sf):
    members = table(spark, sf, "nation").select((F.col("n_nationkey") % 9).cast("bigint").alias("zone"))
    pairs = table(spark, sf, "supplier").select((F.col("s_suppkey") % 9).alias("a"), (F.col("s_nationkey") % 10).cast("bigint").alias("b"))
    return gates.incomplete_pairs(members, pairs)


@query("""with f as (select s_suppkey % 12 as a, s_nationkey % 12 as b from supplier), g as (select s_suppkey % 7 as a, s_nationkey % 5 as b from supplier where s_suppkey % 4 = 0), fn as (select least(a, b) as low, greatest(a, b) as high from f), gn as (select least(a, b) as low, greatest(a, b) as high from g)
select low, high, 'in both' as problem from (select low, high from fn intersect select low, high from gn) union all select distinct low, high, 'self' from (select * from fn union all select * from gn) where low = high""")
def v3_conflicting_pairs(spark, sf):
    s = table(spark, sf, "supplier")
    first = s.select((F.col("s_suppkey") % 12).alias("a"), (F.col("s_nationkey") % 12).cast("bigint").alias("b"))
    second = s.where("s_suppkey % 4 = 0").select((F.col("s_suppkey") % 7).alias("a"), (F.col("s_nationkey") % 5).cast("bigint").alias("b"))
    return gates.conflicting_pairs(first, second)


_VALET = "v as (select p_partkey % 200 as station, p_partkey as id, cast(p_partkey % 127 + 1 as integer) as weekdays, p_partkey * 13 % 1200 as s, p_partkey * 13 % 1200 + p_size * 3 as e from part)"


@query(f"with {_VALET} select x.station, x.id as a, y.id as b from v x join v y on x.station = y.station and x.id < y.id and x.s < y.e and y.s < x.e and x.weekdays & y.weekdays <> 0")
def v4_overlapping_windows(spark, sf):
    k = F.col("p_partkey")
    windows = table(spark, sf, "part").select((k % 200).alias("station"), k.alias("id"), (k % 127 + 1).cast("int").alias("weekdays"), (k * 13 % 1200).alias("start"), (k * 13 % 1200 + F.col("p_size") * 3).alias("end"))
    return gates.overlapping_windows(windows, "station")


@query("select p_partkey from part where not (p_size < p_size + p_partkey % 3 and p_partkey % 3 <= p_size)")
def v6_threshold_orderings(spark, sf):
    caution, block = F.col("p_size"), F.col("p_size") + F.col("p_partkey") % 3
    return table(spark, sf, "part").where(~((caution < block) & (F.col("p_partkey") % 3 <= F.col("p_size")))).select("p_partkey")


@query("with e as (select distinct l_suppkey as src, l_partkey % 120 as dst from lineitem), n as (select s_suppkey as node from supplier) select src, dst from e where dst not in (select node from n) or src not in (select node from n)")
def v8_edges_out_of_range(spark, sf):
    nodes = table(spark, sf, "supplier").select("s_suppkey")
    edges = table(spark, sf, "lineitem").select(F.col("l_suppkey").alias("src"), (F.col("l_partkey") % 120).alias("dst")).distinct()
    return gates.missing_references(edges, "dst", nodes, "s_suppkey").unionByName(gates.missing_references(edges, "src", nodes, "s_suppkey")).distinct()


@query("with l as (select distinct l_suppkey % 40 as a, l_partkey % 300 as b, l_linenumber as value from lineitem) select a, b, value from l where not exists (select 1 from l m where m.a = l.b and m.b = l.a and m.value = l.value)")
def v9_one_way_links(spark, sf):
    line = table(spark, sf, "lineitem")
    return gates.one_way_only(line.select((F.col("l_suppkey") % 40).alias("a"), (F.col("l_partkey") % 300).alias("b"), F.col("l_linenumber").alias("value")).distinct())


@query(f"with {a.COUNTS}, {a.HOLIDAYS}, per as (select key, direction, count(distinct day) as days, max(day) - min(day) + 1 as span from counts group by all) select key, direction, days from per where days > span or days > 25")
def v10_active_day_limits(spark, sf):
    per = flows.count_ends(a.ends(spark, sf)).groupBy("key", "direction").agg(F.count_distinct("day").alias("days"), (F.datediff(F.max("day"), F.min("day")) + 1).alias("span"))
    return per.where("days > span or days > 25").select("key", "direction", "days")


@query("with r as (select l_returnflag as name, cast(l_suppkey as varchar) as sha from lineitem), s as (select l_returnflag as name, cast(l_suppkey as varchar) as sha from lineitem where l_suppkey % 9 <> 0) select name, sha from r except all select name, sha from s")
def v11_report_against_set(spark, sf):
    line = table(spark, sf, "lineitem")
    rows = line.select(F.col("l_returnflag").alias("name"), F.col("l_suppkey").cast("string").alias("sha"))
    return rows.exceptAll(rows.where("cast(sha as int) % 9 <> 0"))


@query("with l as (select n_name as kind, n_nationkey as size from nation where n_nationkey % 3 = 0), p as (select n_name as kind, n_nationkey + 100 as size from nation where n_nationkey % 2 = 0) select kind, size, false as carried from l union all select kind, size, true from p where kind not in (select kind from l)")
def v12_carry_forward(spark, sf):
    n = table(spark, sf, "nation")
    local = n.where("n_nationkey % 3 = 0").select(F.col("n_name").alias("kind"), F.col("n_nationkey").alias("size"))
    previous = n.where("n_nationkey % 2 = 0").select(F.col("n_name").alias("kind"), (F.col("n_nationkey") + 100).alias("size"))
    return gates.carry_forward(local, previous)


@query("select sha256(string_agg(concat(n_name, '=', sha256(cast(n_nationkey as varchar))), chr(10) order by concat(n_name, '=', sha256(cast(n_nationkey as varchar))))) as set_id from nation")
def a24_s28_set_id(spark, sf):
    return gates.set_id(table(spark, sf, "nation").select(F.col("n_name").alias("name"), F.sha2(F.col("n_nationkey").cast("string"), 256).alias("sha")))


@query("with m as (select o_custkey % 30 as set_ord, concat('blob-', o_orderkey % 4000) as name from orders), keep as (select distinct name from m where set_ord >= 27), o as (select distinct concat('blob-', o_orderkey % 5000) as name from orders) select name, case when name in (select name from keep) then 'keep' else 'delete' end as action from o")
def q12_retention(spark, sf):
    o = table(spark, sf, "orders")
    blob = lambda n: F.concat(F.lit("blob-"), (F.col("o_orderkey") % n).cast("string"))
    return gates.swept(o.select(blob(5000).alias("name")).distinct(), o.select((F.col("o_custkey") % 30).alias("set_ord"), blob(4000).alias("name")), 3)


@query("select * from (values ('streets', 'failed'), ('timetables', 'ok'), ('stations', 'skipped'), ('config', 'ok'), ('links', 'skipped'), ('flows', 'ok'), ('gate', 'skipped'), ('manifest', 'skipped'), ('heartbeat', 'ok')) t(step, status)")
def q11_exit_policy(spark, sf):
    return spark.createDataFrame(list(gates.run_plan({"streets"}).items()), "step string, status string")


@query("select l_suppkey as pattern, max(l_partkey) as worst, max_by(l_orderkey * 10 + l_linenumber, l_partkey * 1000000 + l_orderkey * 10 + l_linenumber) as label from lineitem group by 1")
def a26_worst_with_label(spark, sf):
    label = F.col("l_orderkey") * 10 + F.col("l_linenumber")
    return table(spark, sf, "lineitem").groupBy(F.col("l_suppkey").alias("pattern")).agg(F.max("l_partkey").alias("worst"), F.max_by(label, F.col("l_partkey") * 1_000_000 + label).alias("label"))


@query("select distinct l_suppkey as a, l_partkey % 50 as b, l_linenumber as kind from lineitem")
def a_distinct_transfers(spark, sf):
    return table(spark, sf, "lineitem").select(F.col("l_suppkey").alias("a"), (F.col("l_partkey") % 50).alias("b"), F.col("l_linenumber").alias("kind")).dropDuplicates()


@query("""with m as (select concat('set', o_custkey % 50) as set_id, cast(o_orderdate as date) as at_, concat('part', o_orderkey) as name, o_orderkey % 4000 as sha, o_orderkey * 7 % 1000 as bytes from orders), n as (select max(at_) as top from m where set_id = 'set7'), b as (select o_orderkey as sha, o_orderkey * 7 % 1000 as bytes from orders where o_orderkey % 11 <> 0)
select m.name, case when b.bytes is null then 'missing' when b.bytes <> m.bytes then 'wrong size' else 'ok' end as status, date '2030-01-01' as generated_at from m join n on m.at_ = n.top left join b on b.sha = m.sha where m.set_id = 'set7'""")
def q12_rollback(spark, sf):
    o, k = table(spark, sf, "orders"), F.col("o_orderkey")
    size = (k * 7 % 1000).alias("bytes")
    manifests = o.select(F.concat(F.lit("set"), (F.col("o_custkey") % 50).cast("string")).alias("set_id"), F.col("o_orderdate").cast("date").alias("generated_at"), F.concat(F.lit("part"), k.cast("string")).alias("name"), (k % 4000).alias("sha"), size)
    day = lambda d: F.lit(d).cast("date")
    return gates.rollback_plan(manifests, o.where("o_orderkey % 11 <> 0").select(k.alias("sha"), size), "set7", day("2029-01-01"), day("2030-01-01"))


@query("""select 'order customers' as "check", (select count(*) from orders) as checked, (select count(*) from orders where o_custkey not in (select c_custkey from customer where c_custkey % 50 <> 1)) as errors, case when (select count(*) from orders where o_custkey not in (select c_custkey from customer where c_custkey % 50 <> 1)) > 0 then 'failed' else 'ok' end as status
union all select 'supplier nations', (select count(*) from supplier), 0, 'ok' union all select 'part brands', 0, 0, 'skipped'""")
def q8_reference_checks(spark, sf):
    customers = table(spark, sf, "customer").where("c_custkey % 50 <> 1")  # a planted gap
    found = gates.reference_check(table(spark, sf, "orders"), "o_custkey", customers, "c_custkey", "order customers")
    found = found.unionByName(gates.reference_check(table(spark, sf, "supplier"), "s_nationkey", table(spark, sf, "nation"), "n_nationkey", "supplier nations"))
    return found.unionByName(gates.reference_check(table(spark, sf, "part"), "p_brand", None, "", "part brands"))


@query("select c_name as name, case when c_custkey % 6 in (0, 1) then 'ok' when c_custkey % 6 = 2 then 'failed' when c_custkey % 4 = 0 then 'skipped' else 'failed' end as status from customer")
def q8_vouched_artifacts(spark, sf):
    c, k = table(spark, sf, "customer"), F.col("c_custkey")
    sha = F.sha2(k.cast("string"), 256)
    reports = c.where("c_custkey % 6 <> 5").select(F.col("c_name").alias("name"), F.when(k % 6 == 3, F.lit("another")).otherwise(sha).alias("sha"), F.when(k % 6 == 4, "gate failed").otherwise("built").alias("outcome"), (k % 6 != 2).alias("passed"))
    previous = c.select(F.col("c_name").alias("name"), F.when(k % 4 == 0, sha).otherwise(F.lit("old")).alias("sha"))
    return gates.vouched(c.select(F.col("c_name").alias("name"), sha.alias("sha")), reports, previous)


@query("""with l as (select l_suppkey as section, l_orderkey * 10 + l_linenumber as k, min(l_partkey) as p from lineitem group by all), o as (select section, row_number() over (partition by section order by k) - 1 as place, p from l), v as (select section, place, case when place = 0 and section % 7 <> 0 then 0 else place * 50 + p % 60 end as value from o),
b as (select *, lag(value) over (partition by section order by place) as low from v), e as (select section, max_by(value, place) as value, max(place) as place from v group by 1)
select section, place, 'does not begin at 0' as rule from v where place = 0 and value <> 0 union all select section, place, 'falls' from b where value < low union all select section, place, 'does not end at its entries' from e where section % 3 = 0""")
def q10_offset_invariants(spark, sf):
    from pyspark.sql import Window

    rows = table(spark, sf, "lineitem").groupBy(F.col("l_suppkey").alias("section"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("k")).agg(F.min("l_partkey").alias("p"))
    place = F.row_number().over(Window.partitionBy("section").orderBy("k")) - 1
    offsets = rows.withColumn("place", place.cast("bigint")).select("section", "place", F.when((F.col("place") == 0) & (F.col("section") % 7 != 0), 0).otherwise(F.col("place") * 50 + F.col("p") % 60).alias("value"))
    total = offsets.groupBy("section").agg(F.max_by("value", "place").alias("v")).select("section", (F.col("v") + F.when(F.col("section") % 3 == 0, 1).otherwise(0)).alias("entries"))
    return gates.broken_offsets(offsets, total)


@query(f"""with {a.LINES}, e as (select l_orderkey * 10 + l_linenumber as edge, l_suppkey as src, l_suppkey + 1 + l_partkey % 2 as dst, l_orderkey * 10 + l_linenumber as segment, l_partkey % 3 = 0 as rev, l_partkey % 5 = 0 as walk, l_partkey % 7 <> 0 as ride, l_partkey from lines)
select edge, 'no mode' as rule from e where not (walk or ride) union all select edge, 'no segment' from e where l_partkey % 41 = 0 union all select edge, 'other ends' from e where l_partkey % 41 <> 0 and l_partkey % 13 = 0""")
def q10_edge_invariants(spark, sf):
    line, p = a.lines(spark, sf), F.col("l_partkey")
    edge, src = F.col("l_orderkey") * 10 + F.col("l_linenumber"), F.col("l_suppkey")
    dst, back = src + 1 + p % 2, p % 3 == 0
    edges = line.select(edge.alias("edge"), src.alias("src"), dst.alias("dst"), edge.alias("segment"), back.alias("reversed"), (p % 5 == 0).alias("walk"), (p % 7 != 0).alias("ride"))
    start = F.when(p % 13 == 0, src + 500).otherwise(src)
    segments = line.where("l_partkey % 41 <> 0").select(edge.alias("segment"), F.when(back, dst).otherwise(start).alias("a"), F.when(back, start).otherwise(dst).alias("b"))
    return gates.broken_edges(edges, segments)


@query(f"""with {a.LINES}, h as (select l_suppkey as origin, l_partkey % 120 as dest, l_partkey as p, l_orderkey % 9 as m from lines), rail as (select s_suppkey as stop from supplier where s_suppkey % 10 <> 3)
select origin, dest, 'to itself' as rule from h where origin = dest union all select origin, dest, 'origin is no rail stop' from h where origin not in (select stop from rail) union all select origin, dest, 'dest is no rail stop' from h where dest not in (select stop from rail)
union all select origin, dest, 'repeated' from h group by all having count(*) > 1 union all select origin, dest, 'no bound' from h where p % 17 = 0 union all select origin, dest, 'gap in pickups' from h where m = 1 union all select origin, dest, 'repeat in pickups' from h where m = 2 union all select origin, dest, 'no docks' from h where m = 3""")
def q10_hop_invariants(spark, sf):
    p, m = F.col("l_partkey"), F.col("l_orderkey") % 9
    none = F.lit(None).cast("bigint")
    pickups = F.when(m == 1, F.array(p, none, p + 1)).when(m == 2, F.array(p, p, none)).otherwise(F.array(p, p + 1, none))
    docks = F.when(m == 3, F.array(none, none)).otherwise(F.array(p, none))
    hops = a.lines(spark, sf).select(F.col("l_suppkey").alias("origin"), (p % 120).alias("dest"), F.when(p % 17 != 0, p).alias("min_decameters"), p.alias("min_walk"), pickups.alias("pickups"), docks.alias("docks"))
    return gates.broken_hops(hops, table(spark, sf, "supplier").where("s_suppkey % 10 <> 3").select(F.col("s_suppkey").alias("stop")))


@query(f"""with {a.LINES}, s as (select l_orderkey as pattern, count(*) as n, max(l_partkey) as p from lines group by 1) select pattern, case when n < 2 then 'fewer than two stops' when p % 19 = 0 then 'no trip' when p % 5 = 0 then 'a trip of another length' end as rule from s where n < 2 or p % 19 = 0 or p % 5 = 0""")
def q10_pattern_invariants(spark, sf):
    line = a.lines(spark, sf)
    stops = line.select(F.col("l_orderkey").alias("pattern"), F.col("l_linenumber").alias("pos"))
    sizes = line.groupBy(F.col("l_orderkey").alias("pattern")).agg(F.count("*").alias("n"), F.max("l_partkey").alias("p"))
    trips = sizes.where("p % 19 <> 0").select(F.concat(F.lit("t"), F.col("pattern").cast("string")).alias("trip"), "pattern", F.explode(F.array(F.col("n"), F.when(F.col("p") % 5 == 0, F.col("n") + 1).otherwise(F.col("n")))).alias("calls"))
    return gates.broken_patterns(sizes.select("pattern"), stops, trips)
