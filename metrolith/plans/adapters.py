"""The driver's tables in the shapes that the operators take, with the SQL of each shape."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from metrolith.plans.registry import table

FIRST, LAST = "2024-01-01", "2024-01-30"


def ends(spark: SparkSession, sf: str) -> DataFrame:
    """Trip ends of events: key, id, day, minute, bin, bike, direction."""
    e = table(spark, sf, "events")
    bike = F.when(F.col("event_id") % 3 == 0, "electric_bike").when(F.col("event_id") % 3 == 1, "classic_bike").otherwise("docked_bike")
    minute = F.hour("ts") * 60 + F.minute("ts")
    from metrolith.functions import fields

    return e.select(
        F.col("user_id").cast("string").alias("key"), F.col("ts").cast("date").alias("day"), minute.alias("minute"), fields.quarter_hour(minute).alias("bin"), fields.bike_kind(bike).alias("bike"),
        F.when(F.col("event_type").isin("view", "click"), "departures").otherwise("arrivals").alias("direction"),
    )


ENDS = """ends as (
  select cast(user_id as varchar) as key, cast(ts as date) as day, hour(ts) * 60 + minute(ts) as minute, cast((hour(ts) * 60 + minute(ts)) // 15 as integer) as bin,
    case when event_id % 3 = 0 then 'ebike' else 'classic' end as bike, case when event_type in ('view', 'click') then 'departures' else 'arrivals' end as direction
  from events)"""


def holidays(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([("2024-01-01", "weekend"), ("2024-01-15", "weekend"), ("2024-01-12", "weekday")], "day string, profile string").withColumn("day", F.col("day").cast("date"))


HOLIDAYS = "holidays as (select cast(d as date) as day, p as profile from (values ('2024-01-01', 'weekend'), ('2024-01-15', 'weekend'), ('2024-01-12', 'weekday')) t(d, p))"

COUNTS = f"""{ENDS}, counts as (select key, day, bin, bike, direction, count(*) as n from ends group by all)"""
DAY_TYPE = "case when isodow({d}) >= 6 or {d} in (select day from holidays where profile = 'weekend') then 'weekend' else 'weekday' end"


def rules(spark: SparkSession, sf: str) -> DataFrame:
    """Calendar rules of orders: rule, slot, mask, first, last, priority, published, ord."""
    o = table(spark, sf, "orders")
    first = F.col("o_orderdate").cast("date")
    return o.select(
        F.col("o_orderkey").alias("rule"), F.col("o_orderpriority").alias("slot"), (F.col("o_orderkey") % 127 + 1).cast("int").alias("mask"),
        first.alias("first"), F.date_add(first, (F.col("o_orderkey") % 20).cast("int")).alias("last"), (F.col("o_custkey") % 3).alias("priority"), first.alias("published"), F.col("o_orderkey").alias("ord"),
    )


RULES = """rules as (select o_orderkey as rule, o_orderpriority as slot, cast(o_orderkey % 127 + 1 as integer) as mask, cast(o_orderdate as date) as first,
  cast(o_orderdate as date) + cast(o_orderkey % 20 as integer) as last, o_custkey % 3 as priority, cast(o_orderdate as date) as published, o_orderkey as ord from orders)"""


def lines(spark: SparkSession, sf: str) -> DataFrame:
    """Line items with one row an order and line."""
    return table(spark, sf, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.min("l_partkey").alias("l_partkey"), F.min("l_suppkey").alias("l_suppkey"))


LINES = "lines as (select l_orderkey, l_linenumber, min(l_partkey) as l_partkey, min(l_suppkey) as l_suppkey from lineitem group by all)"


def events_of_trips(spark: SparkSession, sf: str) -> DataFrame:
    """Stop events of line items: an order is a trip; every third call lacks its times; late trips run past midnight."""
    line = lines(spark, sf)
    seconds = (F.col("l_orderkey") * 97 + F.col("l_linenumber") * 5_400).cast("bigint") % 86_400
    known = F.col("l_linenumber") % 3 != 2
    return line.select(
        F.col("l_orderkey").alias("trip"), F.col("l_linenumber").alias("pos"), F.col("l_suppkey").alias("stop"), F.when(known, seconds).alias("arrival"), F.when(known, seconds + F.col("l_partkey") % 120).alias("departure"),
        (F.col("l_partkey") % 3 == 0).cast("int").alias("pickup"), (F.col("l_partkey") % 3 == 0).cast("int").alias("drop_off"),
    )


EVENTS_OF_TRIPS = f"""{LINES}, calls as (select l_orderkey as trip, l_linenumber as pos, l_suppkey as stop,
  case when l_linenumber % 3 <> 2 then (l_orderkey * 97 + l_linenumber * 5400) % 86400 end as arrival,
  case when l_linenumber % 3 <> 2 then (l_orderkey * 97 + l_linenumber * 5400) % 86400 + l_partkey % 120 end as departure,
  cast(l_partkey % 3 = 0 as integer) as pickup, cast(l_partkey % 3 = 0 as integer) as drop_off from lines)"""


def stations(spark: SparkSession, sf: str) -> DataFrame:
    """Stations of customers on an integer grid: ord, station_id, short_name, region, capacity, lat_e6, lon_e6."""
    c = table(spark, sf, "customer")
    key = F.col("c_custkey")
    return c.select(
        key.alias("ord"), (key % 997).cast("string").alias("station_id"), F.when(key % 11 == 0, "").otherwise(F.concat((key % 50).cast("string"), F.lit("."), (key % 91).cast("string"))).alias("short_name"),
        F.when(key % 7 != 0, (F.col("c_nationkey") + 170).cast("string")).alias("region"), (key % 5 - 1).cast("int").alias("capacity"),
        (40_700_000 + key * 7_919 % 60_000).cast("int").alias("lat_e6"), (-74_000_000 + key * 104_729 % 60_000).cast("int").alias("lon_e6"),
    )


STATIONS = """stations as (select c_custkey as ord, cast(c_custkey % 997 as varchar) as station_id, case when c_custkey % 11 = 0 then '' else concat(c_custkey % 50, '.', c_custkey % 91) end as short_name,
  case when c_custkey % 7 <> 0 then cast(c_nationkey + 170 as varchar) end as region, cast(c_custkey % 5 - 1 as integer) as capacity,
  cast(40700000 + c_custkey * 7919 % 60000 as integer) as lat_e6, cast(-74000000 + c_custkey * 104729 % 60000 as integer) as lon_e6 from customer)"""
