"""Queries and operators on the inputs that a review found them to fail on."""

import lzma
import random
import time

import duckdb
import pytest
from pyspark.sql import functions as F

from metrolith.functions import blobs
from metrolith.llm import url_rules
from metrolith.operators import flows, graph, links, stations
from metrolith.plans import catalog
from metrolith.sources import csv
from tests.test_oracles import SF, TABLES, rows


def same_as_sql(spark, name, folder, **tables):
    """A query's rows and its SQL's over sf0.001, some tables replaced by DuckDB's answers to the given SQL."""
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    for t, sql in tables.items():
        con.execute(f"create table new_{t} as {sql}")
    for t in TABLES:
        con.execute(f"copy (select * from {f'new_{t}' if t in tables else t}) to '{folder}/{t}.parquet' (format parquet)")
    for t in tables:
        con.execute(f"create or replace view {t} as select * from new_{t}")
    got = catalog.QUERIES[name](spark, str(folder))
    names = got.columns
    want = con.execute(f"select {', '.join(names)} from ({catalog.ORACLES[name]})").fetchall()
    assert rows(names, [tuple(r) for r in got.collect()]) == rows(names, want)


def test_ways_over_a_degree(spark, tmp_path):
    same_as_sql(spark, "s20_way_lines", tmp_path, lineitem="select * replace (l_suppkey + 9340 as l_suppkey) from lineitem")


def test_nearest_keys_of_crowded_places(spark):
    rows = spark.range(60_000).select(F.col("id").alias("key"), (40_700_000 + F.col("id") % 3 * 100).cast("int").alias("lat_e6"), F.lit(-74_000_000).alias("lon_e6"), (F.col("id") % 3 < 2).alias("has_trips"))
    start = time.time()
    got = flows.nearest_keys(rows)
    some = {(r["key"], r["rank"]): r["neighbour"] for r in got.where("key in (0, 4, 59999)").collect()}
    assert got.count() == 480_000 and time.time() - start < 90  # pairs of keys would be 2,400,000,000
    assert [some[0, k] for k in range(1, 9)] == [3, 6, 9, 12, 15, 18, 21, 24]
    assert [some[4, k] for k in range(1, 9)] == [1, 7, 10, 13, 16, 19, 22, 25]
    assert [some[59_999, k] for k in range(1, 9)] == [1, 4, 7, 10, 13, 16, 19, 22]


def test_nearest_keys_of_copies(spark, tmp_path):
    same_as_sql(spark, "j9_nearest_keys", tmp_path, customer="select c.* replace (c_custkey + 60000 * i as c_custkey) from customer c, (select range as i from range(12))")


def test_pairs_of_places_with_many_points(spark, tmp_path):
    same_as_sql(spark, "j10_within_radius", tmp_path, customer="select c.* replace (c_custkey + 30000 * i as c_custkey) from customer c, (select range as i from range(9))")


def test_snapping_of_points_and_segments_of_one_place(spark):
    points = spark.range(30_000).select(F.col("id").alias("point"), F.lit(5.0).alias("x"), (F.col("id") % 2 * 1.0).alias("y"))
    segments = spark.range(30_000).select(F.col("id").alias("segment"), F.lit(0.0).alias("ax"), F.lit(-3.0).alias("ay"), F.lit(400.0).alias("bx"), F.lit(-3.0).alias("by"))
    start = time.time()
    got = stations.snap(points, segments, 150.0, count=2).groupBy("mm", "segment", "rank").count().collect()
    assert time.time() - start < 60  # pairs would be 900,000,000
    assert {tuple(r) for r in got} == {(mm, k, k + 1, 15_000) for mm in (3000, 4000) for k in (0, 1)}


def test_snapping_of_copies(spark, tmp_path):
    copies = "select t.* replace (KEY + STEP * i as KEY) from TABLE t, (select range as i from range(5))"
    asked = {t: copies.replace("KEY", k).replace("STEP", n).replace("TABLE", t) for t, k, n in (("customer", "c_custkey", "30000"), ("supplier", "s_suppkey", "3000"))}
    same_as_sql(spark, "j11_snap_to_segments", tmp_path, **asked)


def test_transfers_of_busy_stations_are_reduced_before_they_are_spread(spark):
    rows = spark.range(400_000).select((F.col("id") % 2).alias("from_stop"), (1 - F.col("id") % 2).alias("to_stop"), F.lit(0).alias("kind"), (F.col("id") + 31).alias("seconds"), F.lit(5).cast("bigint").alias("walk"), F.lit(False).alias("trip_specific"))
    platforms = spark.range(300).select((F.col("id") % 2).alias("station"), F.col("id").alias("platform")).union(spark.createDataFrame([(0, 901), (1, 901)], "station bigint, platform bigint"))
    start = time.time()
    got = {(r["a"], r["b"]): r["seconds"] for r in links.station_transfers(rows, platforms).collect()}
    assert time.time() - start < 60  # every row with every pair of platforms would be 9,000,000,000
    least = {0: 31, 1: 32}
    homes = {p: {p % 2} for p in range(300)} | {901: {0, 1}}
    assert got == {(a, b): min(least[x] for x in homes[a] for y in homes[b] if x != y) for a in homes for b in homes if a != b and (len(homes[a] | homes[b]) > 1)}


def test_links_to_stations_take_one_search_a_stop(spark, monkeypatch):
    searches = []
    found = links.shortest_paths
    monkeypatch.setattr(links, "shortest_paths", lambda s, e, starts, **k: (searches.append(starts.select("origin").distinct().count()), found(s, e, starts, **k))[1])
    edges = spark.createDataFrame([(1, 10, 1500, 0), (2, 10, 900, 0), (10, 1, 2500, 0), (10, 20, 700, 0), (3, 20, 9000, 0)], "src bigint, dst bigint, cost bigint, length bigint")
    platforms = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b")], "node bigint, stop string")
    stations = spark.createDataFrame([(k, 10 * (k % 2 + 1)) for k in range(8)], "station bigint, node bigint")
    got = {(r["stop"], r["station"], r["exit"], r["enter"]) for r in links.station_links(spark, edges, platforms, stations, bound=5).collect()}
    assert got == {("a", k, *((1, 3) if k % 2 == 0 else (2, None))) for k in range(8)}
    assert searches == [2, 2]  # eight before, one a station


def test_matrix_on_segments_searches_once_a_place(spark, monkeypatch, tmp_path):
    searches = []
    found = graph.shortest_paths
    monkeypatch.setattr(graph, "shortest_paths", lambda s, e, starts, **k: (searches.append(starts.select("origin").distinct().count()), found(s, e, starts, **k))[1])
    same_as_sql(spark, "g5_matrix_on_segments", tmp_path, supplier="select s.* replace (s_suppkey + 3420 * i as s_suppkey) from supplier s, (select range as i from range(3))")
    assert searches == [10]  # thirty before, one a station


def test_small_blobs_are_packed_in_little_time():
    start = time.process_time()
    packed = [blobs.pack(b"Customer#%09d" % k) for k in range(4_000)]
    assert time.process_time() - start < 1.2  # some 3 s with a dictionary of 8 MB for each
    assert [lzma.decompress(x, format=lzma.FORMAT_XZ) for x in packed] == [b"Customer#%09d" % k for k in range(4_000)]
    long = bytes(range(256)) * 20_000
    assert len(blobs.pack(long)) == len(lzma.compress(long, format=lzma.FORMAT_XZ, check=lzma.CHECK_SHA256)) and lzma.decompress(blobs.pack(long)) == long


def test_blobs_of_the_query(spark, tmp_path):
    same_as_sql(spark, "q7_blob_integrity", tmp_path)


def _whole(data: bytes, names):
    """A file's records with their numbers, by the reader of whole files."""
    rows = list(csv.records(data))
    header = [c.strip() for c in rows[0]]
    return [tuple(None if c not in header else (r[header.index(c)] if header.index(c) < len(r) else "") for c in names) + (k,) for k, r in enumerate(rows[1:])]


def test_exact_csv_in_splits_is_as_of_whole_files(spark, tmp_path):
    rng = random.Random(5)
    fields = ["a", "", "xyz" * 3, '"q"', '"one\ntwo"', '"a\r\n\n""b"",\n"', 'in"side', '""', '"' + "long\n" * 12 + '"', "é"]
    ends = ["\n", "\r\n", "\r", "\n\n", "\n\r"]
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    for case in range(6):
        plain = case == 0
        text = "".join(",".join(rng.choice(fields[:3] if plain else fields) for _ in range(3 if plain else rng.randint(1, 4))) + ("\n" if plain else rng.choice(ends)) for _ in range(150))
        data = ("﻿" * (case % 2) + (' id,"v",w\n' if case % 2 == 0 else '"id",v, w\r\n') + text).encode()
        folder = tmp_path / f"with space {case}"
        folder.mkdir()
        (folder / "a.csv").write_bytes(data)
        spark.conf.set(key, "97")
        try:
            found = csv.read_exact_csv(spark, str(folder), ["id", "v"], ["none", "w"])
            assert found.rdd.getNumPartitions() > 4
        finally:
            spark.conf.set(key, before)
        got = sorted(found.collect(), key=lambda r: r["ord"])
        assert [tuple(r)[:5] for r in got] == _whole(data, ["id", "v", "none", "w"]), case
        assert {r["file"] for r in got} == {f"file:{folder}/a.csv"}


def test_exact_csv_in_splits_refuses_what_whole_files_refuse(spark, tmp_path):
    for k, (data, why) in enumerate(((b"id\n" + b"1\n" * 50 + b'"open\n' + b"2\n" * 50, "does not end"), (b"id\n" + b"1\n" * 50 + b'"x"y\n' + b"2\n" * 50, "after a closing quote"), (b"other\n1\n", "columns are missing"))):
        (tmp_path / f"{k}.csv").write_bytes(data)
        spark.conf.set("spark.sql.files.maxPartitionBytes", "40")
        try:
            with pytest.raises(Exception, match=why):
                csv.read_exact_csv(spark, str(tmp_path / f"{k}.csv"), ["id"]).collect()
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_rules_of_urls_with_many_items(spark):
    """Ten words more often bad than the pair that is always bad: none of a url's items is left out."""
    rng = random.Random(8)
    words = ["ab", "cd", "ef", "gh", "ij", "kl", "mn", "op", "qr", "st"]
    rows = []
    for k in range(400):  # bad: the pair, with most of the words
        rows.append((f"http://x{k}.org/{'/'.join(['uv', 'wx', *rng.sample(words, 9)])}", 0))
    for k in range(1200):  # good: one of the pair
        rows.append((f"http://y{k}.org/{rng.choice(['uv', 'wx'])}", 1))
    for k in range(200):  # good: some words
        rows.append((f"http://z{k}.org/{'/'.join(rng.sample(words, 4))}", 1))
    for k in range(50):  # not labelled: the pair alone
        rows.append((f"http://w{k}.org/uv/wx", None))
    pages = spark.createDataFrame([(k, u) for k, (u, _) in enumerate(rows)], "page_id long, url string")
    labels = spark.createDataFrame([(k, q, 0) for k, (_, q) in enumerate(rows) if q is not None], "doc_id long, quality int, toxic int")
    mined = {tuple(r["tokens"]): (r["rows"], r["confidence"]) for r in url_rules.mine(pages, labels).collect()}
    assert mined[("path=uv", "path=wx")] == (400, 1.0)
    verdicts = url_rules.filter_urls(spark, pages, labels).where("page_id >= 1800").groupBy("verdict").count().collect()
    assert [tuple(r) for r in verdicts] == [("block", 50)]


def test_grown_sets_are_those_of_fp_growth(spark, monkeypatch):
    rng = random.Random(9)
    words = "abcdefgh"
    urls = [f"http://s{k % 90}.org/{'/'.join(rng.sample(words, rng.randint(1, 6)))}" for k in range(500)]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    labels = spark.createDataFrame([(k, int(not ("a" in u[12:] and "b" in u[12:]) and rng.random() < 0.7), 0) for k, u in enumerate(urls)], "doc_id long, quality int, toxic int")
    found = []
    for most in (60, 0):
        monkeypatch.setattr(url_rules, "BASKET_ITEMS", most)
        found.append(sorted(tuple(r) for r in url_rules.mine(pages, labels).collect()))
    assert found[0] == found[1] and any(len(r[0]) > 1 for r in found[0])
