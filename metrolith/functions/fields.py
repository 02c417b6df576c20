"""Field parsers and small scalar rules, as Column functions that stay in generated code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def trim_blanks(c: Column) -> Column:
    """Without spaces and tabs at the ends (no other white space)."""
    return F.btrim(c, F.lit(" \t"))


def parse_int(c: Column) -> Column:
    """An integer with an optional sign, null if malformed or beyond 64 bits."""
    return F.when(c.rlike("^[+-]?[0-9]+$"), c.try_cast("bigint"))


def parse_count(c: Column) -> Column:
    """A non-negative integer of at most 18 digits, blanks around it allowed."""
    t = trim_blanks(c)
    return F.when(t.rlike("^[0-9]{1,18}$"), t.try_cast("bigint"))


def parse_clock(c: Column) -> Column:
    """H:MM:SS as seconds; hours are unbounded, minutes and seconds below 60, one to six digits each."""
    t = trim_blanks(c)
    part = [F.regexp_extract(t, "^([0-9]{1,6}):([0-9]{1,6}):([0-9]{1,6})$", k).try_cast("bigint") for k in (1, 2, 3)]
    return F.when((part[1] < 60) & (part[2] < 60), part[0] * 3600 + part[1] * 60 + part[2])


def parse_microdegrees(c: Column) -> Column:
    """Decimal degrees as microdegrees; only the seventh decimal rounds, away from zero; null if malformed or over 1000."""
    t = trim_blanks(c)
    pattern = r"^[+-]?([0-9]*)\.?([0-9]*)$"
    whole, fraction = F.regexp_extract(t, pattern, 1), F.regexp_extract(t, pattern, 2)
    degrees = F.when(whole == "", F.lit(0)).otherwise(whole.try_cast("bigint"))
    micro = F.rpad(F.substring(fraction, 1, 6), 6, "0").cast("bigint")
    up = F.when(F.substring(fraction, 7, 1) >= "5", 1).otherwise(0)
    value = degrees * 1_000_000 + micro + up
    fine = t.rlike(pattern) & (F.length(whole) + F.length(fraction) > 0) & (degrees <= 1000)
    return F.when(fine, F.when(t.startswith("-"), -value).otherwise(value)).cast("int")


def parse_color(c: Column) -> Column:
    """RRGGBB, a leading # allowed, as an integer."""
    t = F.regexp_replace(trim_blanks(c), "^#", "")
    return F.when(t.rlike("^[0-9A-Fa-f]{6}$"), F.conv(t, 16, 10).cast("int"))


def parse_day(c: Column) -> Column:
    """YYYYMMDD as a date, null if it is none."""
    t = trim_blanks(c)
    return F.when(t.rlike("^[0-9]{8}$"), F.try_to_date(t, "yyyyMMdd"))


def day_number(c: Column) -> Column:
    return F.unix_date(c)


def is_weekend(day: Column) -> Column:
    return F.weekday(day) >= 5


def local_minute(c: Column) -> tuple[Column, Column]:
    """Date and minute of the day of a wall-clock text YYYY-MM-DD[ T]HH:MM[:SS[.f]], nulls if it is none."""
    fine = c.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[ T]([01][0-9]|2[0-3]):[0-5][0-9](:([0-5][0-9]|60)(\.[0-9]+)?)?$")
    day = F.when(fine, F.try_to_date(F.substring(c, 1, 10), "yyyy-MM-dd"))
    minute = F.substring(c, 12, 2).try_cast("int") * 60 + F.substring(c, 15, 2).try_cast("int")
    return day, F.when(day.isNotNull(), minute)


def bike_kind(c: Column) -> Column:
    return F.when(c == "electric_bike", "ebike").when(c.isin("classic_bike", "docked_bike"), "classic")


def quarter_hour(minute: Column) -> Column:
    """The 15-minute bin of a minute of the day."""
    return F.floor(minute / 15).cast("int")


def lost_zero(c: Column) -> Column:
    """Whether an id may have lost a trailing zero: digits, a dot, one digit."""
    return c.rlike(r"^[0-9]+\.[0-9]$")


def half_minute_seconds(hundredths: Column) -> Column:
    """Hundredths of a minute as seconds, rounded to the nearest (away from zero)."""
    return ((hundredths * 60 + F.when(hundredths >= 0, 50).otherwise(-50)) / 100).cast("int")


_STATIC = r"_(-?[0-9]{6})_([A-Z0-9]+)\.+([NS])(.*)$"


def subway_key(trip_id: Column, realtime: bool = False) -> dict[str, Column]:
    """origin (hundredths of a minute), route, direction, path of a subway trip id; nulls where it is none."""
    pattern = "^" + _STATIC[1:] if realtime else _STATIC
    fits = trip_id.rlike(pattern)
    parts = [F.when(fits, F.regexp_extract(trip_id, pattern, k)) for k in (1, 2, 3, 4)]
    return {"origin": parts[0].cast("int"), "route": parts[1], "direction": parts[2], "path": parts[3]}


def route_mode(system: Column, route_id: Column) -> Column:
    """The mode of a route; for buses by suffix + (select) or an express prefix."""
    name = F.upper(route_id)
    express = name.startswith("BXM") | name.startswith("SIM") | name.startswith("BM") | name.startswith("QM") | name.startswith("X")
    bus = F.when(route_id.endswith("+"), "sbs").when(express, "express_bus").otherwise("local_bus")
    return F.when(system == "bus", bus).otherwise(system)


def route_long_name(system: Column, long_name: Column, description: Column) -> Column:
    return F.when((system == "path") & (F.coalesce(description, F.lit("")) != ""), description).otherwise(long_name)


def ride_seconds(decameters: Column, speed_mm: int) -> Column:
    """Whole seconds for a ride, rounded up."""
    return F.floor((decameters * 10_000 + (speed_mm - 1)) / F.lit(speed_mm)).cast("bigint")


MOST_COST = 2**32 - 2


def add_cost(a: Column, b: Column) -> Column:
    """Costs in milliseconds, held at the largest finite one."""
    return F.least(a.cast("bigint") + b.cast("bigint"), F.lit(MOST_COST))


def edge_portion(cost: Column, fraction: Column) -> Column:
    """The part of an edge's cost that a fraction of it (held in 0..1) takes."""
    return F.round(cost * F.greatest(F.lit(0.0), F.least(F.lit(1.0), fraction))).cast("bigint")


MPH = 0.44704
# Cost multipliers of the bike classes.
CLASS_COST = {"protected": 0.8, "painted": 0.9, "shared": 1.0, "arterial": 1.3}


def walk_cost(decimeters: Column, walkable: Column, stairs: Column, speed: float = 3.5 * MPH, stairs_times: float = 2.0) -> Column:
    """Milliseconds on foot, null where walking is not allowed."""
    ms = decimeters.cast("double") * F.lit(100 / speed)
    ms = F.when(stairs, ms * F.lit(stairs_times)).otherwise(ms)
    return F.when(walkable, F.least(F.round(ms).cast("bigint"), F.lit(MOST_COST)))


def bike_cost(decimeters: Column, rideable: Column, dismount: Column, bike_class: Column, speed: float = 10 * MPH, dismount_speed: float = 3 * MPH) -> Column:
    """Milliseconds by bike, null where riding is not allowed; a class costs its multiple, a dismount walking pace."""
    pace = F.lit(None).cast("double")
    for name, times in CLASS_COST.items():
        pace = F.when(bike_class == name, F.lit(times * 100 / speed)).otherwise(pace)
    pace = F.when(dismount, F.lit(100 / dismount_speed)).otherwise(pace)
    return F.when(rideable, F.least(F.round(decimeters.cast("double") * pace).cast("bigint"), F.lit(MOST_COST)))


def service_seconds_origin(day: Column, zone: str = "America/New_York") -> Column:
    """Epoch seconds of a service day's origin: noon in the zone less twelve hours."""
    noon = F.to_utc_timestamp(F.to_timestamp_ltz(F.concat(day.cast("string"), F.lit(" 12:00:00"))), zone)
    return F.unix_seconds(noon) - 12 * 3600


def trip_file(key: Column) -> dict[str, Column]:
    """system and month of a monthly trip file's name, nulls for other names."""
    pattern = r"^(JC-)?([0-9]{6})[- ](citibike|citbike)-tripdata(\.csv)?\.zip$"
    month = F.regexp_extract(key, pattern, 2)
    fits = key.rlike(pattern) & (F.substring(month, 5, 2).try_cast("int").between(1, 12))
    return {"system": F.when(fits, F.when(key.startswith("JC-"), "JC").otherwise("NYC")), "month": F.when(fits, month.cast("int"))}


def add_months(month: Column, n: int) -> Column:
    """YYYYMM n months on."""
    count = F.floor(month / 100) * 12 + month % 100 - 1 + n
    return (F.floor(count / 12) * 100 + count % 12 + 1).cast("int")


def unescape_opl(c: Column) -> Column:
    """Text with %hex% escapes of code points resolved."""
    parts = F.split(c, "%")
    each = F.transform(parts, lambda x, i: F.when(i % 2 == 0, x).otherwise(F.decode(F.unhex(F.lpad(x, 8, "0")), "UTF-32")))
    return F.when(c.contains("%"), F.array_join(each, "")).otherwise(c)


_WINDOW = r"^([1-7]+) ((?:[01][0-9]|2[0-3]):[0-5][0-9]|24:00)-((?:[01][0-9]|2[0-3]):[0-5][0-9]|24:00)$"


def valet_windows(c: Column) -> Column:
    """Windows such as '135 08:15-12:30|6 09:00-24:00' as a sorted array of struct(weekdays, start, end); null for an empty
    cell, an error for any other text.  weekdays are ascending ISO numbers, times are minutes."""
    minutes = lambda t: F.substring(t, 1, 2).cast("int") * 60 + F.substring(t, 4, 2).cast("int")

    def window(x: Column) -> Column:
        part = lambda k: F.regexp_extract(x, _WINDOW, k)
        days = F.array_sort(F.transform(F.split(part(1), ""), lambda d: d.cast("int")))
        made = F.struct(days.alias("weekdays"), minutes(part(2)).alias("start"), minutes(part(3)).alias("end"))
        return F.when(x.rlike(_WINDOW), made).otherwise(F.raise_error(F.concat(F.lit("not a window: "), x)))

    return F.when(F.coalesce(c, F.lit("")) != "", F.array_sort(F.transform(F.split(c, r"\|"), window)))


def keyword_list(c: Column) -> Column:
    """The keywords of a cell, parted by bars, in order of their bytes."""
    return F.array_sort(F.split(c, r"\|"))


def local_epoch(local: Column, zone: str = "America/New_York") -> Column:
    """Epoch seconds of a local time; one that is skipped moves on by the gap, one that occurs twice is the first."""
    return F.unix_seconds(F.to_utc_timestamp(local, zone))


def _number(value: int) -> Column:
    return F.lit(str(value)).cast("decimal(20,0)")


def _bound(x: Column, use) -> Column:
    """``use(x)`` with x made once."""
    return F.element_at(F.transform(F.array(x), use), 1)


def _long_of(total: Column) -> Column:
    """The long with the bits of a number below 2**64."""
    full = _number(2**64)
    return F.when(total >= _number(2**63), total - full).otherwise(total).cast("bigint")


def _times(x: Column, k: int) -> Column:
    """x * k modulo 2**64, by 32-bit halves, so that no product leaves the decimals."""
    low, high = x.bitwiseAND(F.lit(0xFFFFFFFF)).cast("decimal(20,0)"), F.shiftrightunsigned(x, 32).cast("decimal(20,0)")
    cross = F.pmod(low * _number(k >> 32) + high * _number(k & 0xFFFFFFFF), _number(2**32))
    return _bound(F.pmod(low * _number(k & 0xFFFFFFFF) + cross * _number(2**32), _number(2**64)), _long_of)


def split_mix(seed: Column, n: Column) -> Column:
    """The n-th (from 1) number of the SplitMix64 sequence of a seed, as the long of the same 64 bits."""
    # fixed values of the generator
    step, one, two = 0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB
    number = lambda c: F.when(c < 0, c.cast("decimal(20,0)") + _number(2**64)).otherwise(c.cast("decimal(20,0)"))
    first = _bound(_times(n.cast("bigint"), step), lambda z: _long_of(F.pmod(number(seed.cast("bigint")) + number(z), _number(2**64))))
    second = _bound(first, lambda z: _times(z.bitwiseXOR(F.shiftrightunsigned(z, 30)), one))
    third = _bound(second, lambda z: _times(z.bitwiseXOR(F.shiftrightunsigned(z, 27)), two))
    return _bound(third, lambda z: z.bitwiseXOR(F.shiftrightunsigned(z, 31)))
