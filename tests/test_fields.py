"""Scalar rules on hand-made values."""

import datetime

import pytest
from pyspark.sql import functions as F

from metrolith.functions import fields, geo, half, street_rules


def one(spark, value, rule, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(rule(F.col("x"))).first()[0]


@pytest.mark.parametrize(
    ("text", "seconds"),
    [("25:10:00", 90600), (" 8:05:09\t", 29109), ("", None), ("8:60:00", None), ("8:05", None), ("a:05:00", None), ("100:00:00", 360000), ("1:2:3", 3723), (None, None)],
)
def test_clock(spark, text, seconds):
    assert one(spark, text, fields.parse_clock) == seconds


@pytest.mark.parametrize(
    ("text", "micro"),
    [("40.7127281", 40712728), ("40.71272850", 40712729), ("-73.9999995", -74000000), ("-0.0000005", -1), ("+5", 5000000), (".5", 500000), ("5.", 5000000), (".", None), ("", None), ("1001", None), ("4x", None), ("1.2.3", None), ("12.12345649999", 12123456)],
)
def test_microdegrees(spark, text, micro):
    assert one(spark, text, fields.parse_microdegrees) == micro


def test_other_fields(spark):
    assert one(spark, "#00Ff10", fields.parse_color) == 0x00FF10
    assert one(spark, "00FF1", fields.parse_color) is None
    assert one(spark, "20240229", fields.parse_day) == datetime.date(2024, 2, 29)
    assert one(spark, "20230229", fields.parse_day) is None
    assert one(spark, "-9223372036854775808", fields.parse_int) == -(2**63)
    assert one(spark, "9223372036854775808", fields.parse_int) is None
    assert one(spark, "1234567890123456789", fields.parse_count) is None
    assert one(spark, "Main%20%St", fields.unescape_opl) == "Main St"
    assert one(spark, 2147, lambda c: fields.half_minute_seconds(c), "int") == 1288
    assert one(spark, -150, lambda c: fields.half_minute_seconds(c), "int") == -90


def test_subway_key_takes_the_leftmost_match(spark):
    rule = lambda c: F.struct(*[v.alias(n) for n, v in fields.subway_key(c).items()])
    assert tuple(one(spark, "AFA26GEN-1038-Sunday-00_-00150_1..S03R", rule)) == (None, None, None, None)
    assert tuple(one(spark, "A_000650_1..S03R", rule)) == (650, "1", "S", "03R")
    live = lambda c: F.struct(*[v.alias(n) for n, v in fields.subway_key(c, realtime=True).items()])
    assert tuple(one(spark, "-00650_GS.N01R", live))[0] is None
    assert tuple(one(spark, "000650_GS.N01R", live)) == (650, "GS", "N", "01R")


@pytest.mark.parametrize(("day", "hours"), [("2026-11-01", 23), ("2027-03-14", 25), ("2026-10-05", 24)])
def test_service_day_origin_moves_with_the_clock(spark, day, hours):
    df = spark.createDataFrame([(day,)], "d string").select(F.col("d").cast("date").alias("d"))
    a, b = df.select(fields.service_seconds_origin(F.date_sub("d", 0)), fields.service_seconds_origin(F.date_sub("d", 1))).first()
    assert (a - b) // 3600 in (23, 24, 25)
    assert {"2026-11-01": 25, "2027-03-14": 23}.get(day, 24) == (a - b) // 3600


def test_polyline_and_hilbert(spark):
    points = [(38.5, -120.2), (40.7, -120.95), (43.252, -126.453)]
    text = geo.encode_polyline(points)
    assert text == "_p~iF~ps|U_ulLnnqC_mqNvxq`@"
    assert geo.decode_polyline(text) == points
    assert geo.decode_polyline("_") is None

    def curve(x, y, order=16):
        d, s = 0, 1 << (order - 1)
        while s:
            rx, ry = int(bool(x & s)), int(bool(y & s))
            d += s * s * ((3 * rx) ^ ry)
            if not ry:
                if rx:
                    x, y = 2 * s - 1 - x, 2 * s - 1 - y
                x, y = y, x
            x &= s - 1
            y &= s - 1
            s >>= 1
        return d

    pairs = [(0, 0), (1, 0), (65535, 65535), (12345, 54321), (3, 7), (40000, 2)]
    df = spark.createDataFrame(pairs, "x int, y int")
    assert [r[0] for r in df.select(geo.hilbert(F.col("x"), F.col("y"))).collect()] == [curve(*p) for p in pairs]
    grid = spark.range(16).select((F.col("id") % 4).alias("x"), F.floor(F.col("id") / 4).alias("y"))
    seen = sorted((r["d"], r["x"], r["y"]) for r in grid.select("x", "y", geo.hilbert(F.col("x"), F.col("y"), 2).alias("d")).collect())
    assert [s[0] for s in seen] == list(range(16))
    assert all(abs(a[1] - b[1]) + abs(a[2] - b[2]) == 1 for a, b in zip(seen, seen[1:]))


def test_half_floats():
    import numpy as np

    assert half.half_bits(np.array([0.0, 1.0, 65504.0, 1e9, 2049.0, 2051.0])).tolist() == [0, 0x3C00, 0x7BFF, 0x7BFF, 0x6800, 0x6802]
    raised = half.raise_to(np.array([0x3C00]), np.array([1.0005]))
    assert half.half_value(raised)[0] >= 1.0005 and raised[0] == 0x3C01


def test_simplify_and_hull():
    import numpy as np

    xs, ys = np.array([0.0, 1, 2, 3, 4]), np.array([0.0, 0.1, 5, 0.1, 0])
    assert geo.simplify(xs, ys, 1.0).tolist() == [0, 2, 4]  # the low points are 0.89 from the sides of the peak
    assert geo.simplify(xs, ys, 0.8).tolist() == [0, 1, 2, 3, 4]
    assert geo.simplify(xs, np.zeros(5), 1.0).tolist() == [0, 4]
    assert geo.simplify(xs, np.zeros(5), 1.0, np.array([0, 0, 1, 0, 0])).tolist() == [0, 2, 4]
    assert geo.convex_hull([(0, 0), (2, 0), (1, 1), (2, 2), (0, 2), (1, 0)]) == [(0, 0), (2, 0), (2, 2), (0, 2)]
    assert len(geo.buffered_hull([(0, 0), (10, 0), (10, 10)], 1.0)) >= 32


STREETS = [
    ({"highway": "residential"}, {"walk": True, "bike_forward": True, "bike_backward": True, "class_forward": "shared", "drop": None}),
    ({"highway": "motorway"}, {"drop": "not routed"}),
    ({"highway": "primary", "oneway": "yes"}, {"bike_backward": False, "class_forward": "arterial", "walk": True}),
    ({"highway": "primary", "oneway": "yes", "cycleway": "opposite_lane"}, {"bike_backward": True, "class_backward": "painted", "class_forward": "arterial"}),
    ({"highway": "secondary", "cycleway:right": "track"}, {"class_forward": "protected", "class_backward": "arterial"}),
    ({"highway": "footway", "footway": "sidewalk"}, {"drop": "sidewalk"}),
    ({"highway": "cycleway", "footway": "crossing"}, {"walk": False, "bike_forward": True, "drop": None}),
    ({"highway": "steps"}, {"walk": True, "bike_forward": False, "stairs": True, "name": "steps"}),
    ({"highway": "pedestrian", "area": "yes"}, {"walk": True, "bike_forward": False, "name": "plaza"}),
    ({"highway": "service", "area": "yes"}, {"drop": "area"}),
    ({"highway": "path"}, {"bike_forward": False, "walk": True}),
    ({"highway": "path", "bicycle": "designated"}, {"bike_forward": True, "class_forward": "protected"}),
    ({"highway": "residential", "access": "private"}, {"drop": "no access"}),
    ({"highway": "residential", "access": "private", "foot": "yes"}, {"walk": True, "bike_forward": False}),
    ({"highway": "trunk", "sidewalk": "none", "bicycle": "yes", "ref": "US 1;NY 9"}, {"walk": False, "bike_forward": True, "name": "US 1 / NY 9", "name_kind": "ref"}),
    ({"highway": "tertiary", "junction": "roundabout"}, {"bike_forward": True, "bike_backward": False}),
    ({"highway": "tertiary", "oneway": "yes", "oneway:bicycle": "no"}, {"bike_backward": True}),
]


def test_street_rules(spark):
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(STREETS)], "i int, tags map<string,string>")
    found = {r["i"]: r.asDict() for r in df.select("i", *[c.alias(n) for n, c in street_rules.classify(F.col("tags")).items()]).collect()}
    for i, (tags, wanted) in enumerate(STREETS):
        assert {k: found[i][k] for k in wanted} == wanted, tags
