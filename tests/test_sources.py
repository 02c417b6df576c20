"""Readers on small hand-made inputs."""

import datetime
import json
import os
import zipfile

import pytest
from pyspark.sql import functions as F

from metrolith.functions import geo
from metrolith.sources import csv, gtfs, mobility


@pytest.mark.parametrize(
    ("data", "rows"),
    [
        (b"a,b\r\n1,\"x\ny\"\n\n\r2,\"q\"\"q\"\r3,", [["a", "b"], ["1", "x\ny"], ["2", 'q"q'], ["3", ""]]),
        (b"\xef\xbb\xbfa\n b\"c ,d\n", [["a"], [' b"c ', "d"]]),
        (b"", []),
        (b'""\n,\n', [[""], ["", ""]]),
    ],
)
def test_records(data, rows):
    assert list(csv.records(data)) == rows


@pytest.mark.parametrize("data", [b'"x"y,1\n', b'a,"open\n'])
def test_broken_quotes_are_errors(data):
    with pytest.raises(csv.CsvError):
        list(csv.records(data))


FEED = {
    "agency": "agency_id,agency_name,agency_timezone\nMTA,Metro,America/New_York\n",
    "routes": 'route_id, route_short_name,agency_id,route_type,route_color\r\n1,One,MTA,1,#EE352E\r\n1,Again,MTA,1,\r\n2,Two,,x,zz\r\n,None,MTA,1,\r\n',
    "stops": "stop_id,stop_name,stop_lat,stop_lon,location_type,parent_station\nA,\"A, main\",40.1234565,-73.5,1,\nA1,A north,40.1,-73.5,9,A\nB1,B,40.2,-73.6,0,\nX,no place,,,0,\n",
    "calendar": "service_id,monday,tuesday,wednesday,thursday,friday,saturday,sunday,start_date,end_date\nWK,1,1,1,1,1,0,0,20261005,20261016\nWK,1,1,1,1,0,0,0,20261005,20261016\n",
    "calendar_dates": "service_id,date,exception_type\nWK,20261007,1\nWK,20261007,2\nSA,20261007,1\n",
    "trips": "route_id,trip_id,service_id,direction_id\n1,t1,WK,0\n1,t2,WK,2\n9,t3,WK,0\n1,t4,NO,0\n2,t1,WK,1\n2,t5,SA,1\n",
    "stop_times": "trip_id,arrival_time,departure_time,stop_id,stop_sequence\nt1,25:10:00,,B1,20\nt1,,24:50:30,A1,3\nt2,bad,8:00:00,A1,1\nt2,9:00:00,9:00:00,Z,2\nt3,1:00:00,1:00:00,A1,1\nt5,8:00:00,8:00:00,A1,\n",
    "transfers": "from_stop_id,to_stop_id,transfer_type,min_transfer_time\nA,B1,2,180\nA,,2,1\n",
}


def write_feed(folder):
    for name, text in FEED.items():
        (folder / f"{name}.txt").write_text(text, newline="")


def test_feed(spark, tmp_path):
    write_feed(tmp_path)
    feed = gtfs.read_feed(spark, str(tmp_path))
    t = feed.tables
    assert {r["route"]: (r["short_name"], r["agency"], r["route_type"], r["color"]) for r in t["route"].collect()} == {"1": ("One", "MTA", 1, 0xEE352E), "2": ("Two", "MTA", 3, None)}
    assert {r["stop"]: (r["lat_e6"], r["kind"], r["parent"]) for r in t["stop"].collect()} == {"A": (40123457, 1, None), "A1": (40100000, 0, "A"), "B1": (40200000, 0, None)}
    assert [(r["rule"], r["mask"], r["first"]) for r in t["rule"].collect()] == [("WK", 0b0001111, datetime.date(2026, 10, 5))]
    assert sorted((r["rule"], r["kind"]) for r in t["rule_exception"].collect()) == [("SA", 1), ("WK", 2)]
    assert {r["trip"]: (r["route"], r["direction"]) for r in t["trip"].collect()} == {"t1": ("1", 0), "t2": ("1", None), "t5": ("2", 1)}
    events = {(r["trip"], r["pos"]): (r["stop"], r["arrival"], r["departure"]) for r in t["stop_event"].collect()}
    assert events == {("t1", 0): ("A1", 89430, 89430), ("t1", 1): ("B1", 90600, 90600), ("t2", 0): ("A1", 28800, 28800)}
    issues = {r["reason"]: r["n"] for r in feed.issues().collect()}
    assert issues == {"route id empty or repeated": 2, "stop empty, repeated or without place": 1, "trip id empty or repeated": 1, "trip of unknown route": 1, "trip without calendar": 1, "call of unknown trip": 1, "call at unknown stop": 1, "call without sequence": 1, "bad time": 1}
    assert [tuple(r) for r in t["transfer"].collect()] == [("A", "B1", 2, 180, False)]
    folder = tmp_path / "zips"
    folder.mkdir()
    with zipfile.ZipFile(folder / "f.zip", "w") as out:
        for name, text in FEED.items():
            out.writestr(f"sub/{name}.txt", text)
        out.writestr("__MACOSX/routes.txt", "junk")
    zipped = gtfs.read_feed(spark, str(folder / "f.zip"), zipped=True)
    assert zipped.tables["stop_event"].count() == 3
    (tmp_path / "calendar_dates.txt").write_text("service_id,date,exception_type\nWK,20261399,1\n")
    with pytest.raises(Exception, match="bad date"):
        gtfs.read_feed(spark, str(tmp_path)).tables["rule_exception"].collect()


def test_large_files_are_read_in_splits_in_their_order(spark, tmp_path):
    for name, n in (("a.csv", 900), ("b.csv", 40)):
        rows = [f'{k},"v, {k}",{name}\r\n' for k in range(n)]
        (tmp_path / name).write_text("id,value , origin\r\n" + "".join(rows), newline="")
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, "1000")
    try:
        found = csv.read_split_csv(spark, str(tmp_path), ["id", "origin"], ["value", "none"])
        assert found.rdd.getNumPartitions() > 10
        rows = found.collect()
    finally:
        spark.conf.set(key, before)
    for name, n in (("a.csv", 900), ("b.csv", 40)):
        own = sorted((r for r in rows if r[1] == name), key=lambda r: r["ord"])
        assert [(r["id"], r["value"], r["none"]) for r in own] == [(str(k), f"v, {k}", None) for k in range(n)]
    with pytest.raises(csv.CsvError):
        csv.read_split_csv(spark, str(tmp_path), ["other"])


def test_entrances(spark):
    raw = spark.createDataFrame([("A12; D13", "Stair", "YES", "no", "40.5", "-73.5"), ("", "Stair", "YES", "YES", "40.5", "-73.5")], "`GTFS Stop ID` string, `Entrance Type` string, `Entry Allowed` string, `Exit Allowed` string, `Entrance Latitude` string, `Entrance Longitude` string")
    assert sorted(tuple(r)[:4] for r in gtfs.entrances(raw).collect()) == [("A12", "Stair", True, False), ("D13", "Stair", True, False)]


TRIPS = 'ride_id,rideable_type,started_at,ended_at,start_station_id,end_station_id\n"1",electric_bike,2026-08-01 23:59:59.123,2026-08-02 00:15:00,5343.10,5343.1\n2,docked_bike,2026-08-01T08:00,bad,,X\n'


def test_trips_in_batch_zip_and_stream(spark, tmp_path):
    folder = tmp_path / "trips"
    folder.mkdir()
    (folder / "a.csv").write_text(TRIPS)
    ends = {(r["direction"], r["id"]): (r["bike"], r["day"], r["bin"]) for r in mobility.trip_ends(mobility.read_trips(spark, str(folder))).collect()}
    day = datetime.date(2026, 8, 1)
    assert ends == {("departures", "5343.10"): ("ebike", day, 95), ("arrivals", "5343.1"): ("ebike", day + datetime.timedelta(1), 1), ("departures", ""): ("classic", day, 32), ("arrivals", "X"): ("classic", None, None)}
    with zipfile.ZipFile(tmp_path / "m.zip", "w") as out:
        out.writestr("x/a.csv", TRIPS)
        out.writestr("__MACOSX/x/a.csv", "junk")
    assert mobility.trip_ends(mobility.read_trip_zips(spark, str(tmp_path / "m.zip"))).count() == 4
    from metrolith.streaming import trip_stream

    head = "rideable_type,started_at,ended_at,start_station_id,end_station_id,start_station_name,end_station_name\n"
    live = tmp_path / "live"
    live.mkdir()
    (live / "1.csv").write_text(head + "electric_bike,2026-08-01 08:00:00,2026-08-01 08:20:00,a,b,,\n")
    for _ in range(2):
        trip_stream.start_incremental(trip_stream.read_trip_stream(spark, str(live)), str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
        (live / "2.csv").write_text(head + "electric_bike,2026-08-01 08:00:00,2026-08-01 08:20:00,a,c,,\n")
    counts = {(r["id"], r["direction"]): r["n"] for r in trip_stream.read_counts(spark, str(tmp_path / "out")).collect()}
    assert counts == {("a", "departures"): 2, ("b", "arrivals"): 1, ("c", "arrivals"): 1}


def test_stations_ways_and_areas(spark, tmp_path):
    body = {"data": {"stations": [{"station_id": 12, "name": "N", "short_name": "5343.10", "lat": 40.7, "lon": -74.0, "region_id": "71", "capacity": 20, "is_charging": True}, {"station_id": "x", "lat": "no", "lon": 1}, {"name": "no id", "lat": 1, "lon": 1}]}}
    (tmp_path / "s.json").write_text(json.dumps(body))
    good, bad = mobility.gbfs_stations(spark, str(tmp_path / "s.json"))
    assert [(r["station_id"], r["lat_e6"], r["region"], r["capacity"], r["charging"]) for r in good.collect()] == [("12", 40700000, "71", 20, True)]
    assert bad.count() == 2
    (tmp_path / "w.opl").write_text("n1 v1 x1 y2\nw7 Thighway=residential,name=Main%20%St Nn1x-73.5y40.25,n2x-73.4y40.5\n")
    way = mobility.read_ways(spark, str(tmp_path / "w.opl")).first()
    assert (way["way"], way["tags"]["name"], way["nodes"][1]["lat_e7"], way["nodes"][0]["id"]) == (7, "Main St", 405000000, 1)
    square = [[0, 0], [10, 0], [10, 10], [0, 10], [0, 0]]
    hole = [[4, 4], [6, 4], [6, 6], [4, 6], [4, 4]]
    area = {"type": "FeatureCollection", "features": [{"properties": {"boro_name": "B"}, "geometry": {"type": "Polygon", "coordinates": [square, hole]}}, {"properties": {"name": "M"}, "geometry": {"type": "MultiPolygon", "coordinates": [[square]]}}]}
    (tmp_path / "a.json").write_text(json.dumps(area))
    rows = mobility.geojson_areas(spark, str(tmp_path / "a.json"))
    inside = {r["name"]: (r["a"], r["b"], r["c"]) for r in rows.select("name", *[geo.in_rings(F.lit(x), F.lit(x), F.col("rings")).alias(n) for n, x in (("a", 1.0), ("b", 5.0), ("c", 11.0))]).collect()}
    assert inside == {"B": (True, False, False), "M": (True, True, False)}


def test_hand_kept_lists():
    assert mobility.holidays("date,name,profile\n20260703,Fourth,weekend\n") == [(datetime.date(2026, 7, 3), "weekend")]
    for bad in ("date,name,profile\n20260704,x,weekend\n", "date,name,profile\n20260703,x,other\n", "date,name\n", "date,name,profile\n20260703,a,weekday\n20260703,b,weekday\n"):
        with pytest.raises(csv.CsvError):
            mobility.holidays(bad)
    assert mobility.month_list("203010-203101") == [203010, 203011, 203012, 203101]
    with pytest.raises(ValueError):
        mobility.month_list("202611,202701")
    with pytest.raises(ValueError):
        mobility.strict_json('{"a": 1, "a": 2}')
    with pytest.raises(ValueError):
        mobility.strict_json('{"a": {"b": 1}}', {"": {"a"}, "a": {"c"}})
    page = '<ListBucketResult xmlns="http://s3.amazonaws.com/doc/2006-03-01/"><IsTruncated>true</IsTruncated><Contents><Key>a&amp;b.zip</Key><ETag>"e"</ETag><Size>5</Size></Contents><NextContinuationToken>t</NextContinuationToken></ListBucketResult>'
    assert mobility.bucket_listing(page) == ([{"key": "a&b.zip", "etag": "e", "size": 5}], "t")
    assert mobility.depots("id,match,name,note\nD,prefix,x,y\n") == [("D", "prefix")]


def test_reports(tmp_path):
    mobility.write_report({"b": 1, "a": 2}, str(tmp_path / "r.json"))
    assert list(json.load(open(tmp_path / "r.json"))) == ["a", "b"] and not os.path.exists(tmp_path / "r.json.part")
