"""Queries without SQL cover the whole tables, against brute force."""

import heapq
import random

import pandas as pd
import pytest

from metrolith.operators import graph
from metrolith.plans import catalog

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def line():
    return pd.read_parquet(f"{SF}/lineitem.parquet")


def reached(pairs):
    """For each node those that a path leads to, itself included."""
    out = {}
    for a, b in pairs:
        out.setdefault(a, set()).add(b)
        out.setdefault(b, set())
    found = {}
    for start in out:
        seen, todo = {start}, [start]
        while todo:
            new = out[todo.pop()] - seen
            seen |= new
            todo += new
        found[start] = seen
    return found


def test_strong_components_by_groups_and_by_joins(spark):
    rng = random.Random(3)
    pairs = {(a, rng.choice([a + 1, a + 2, max(0, a - 2), a])) for a in range(0, 24) for _ in range(2)} | {(40, 41), (41, 40), (50, 50)}
    to, back = reached(pairs), reached({(b, a) for a, b in pairs})
    wanted = {n: min(to[n] & back[n]) for n in to}
    edges = spark.createDataFrame(sorted(pairs), "src bigint, dst bigint")
    for most in (1_000, 0):
        assert {r["node"]: r["root"] for r in graph.strong_components_of(spark, edges, most).collect()} == wanted


def test_street_chains_of_all_rows(spark, line):
    pieces = {}
    for o, n, f in zip(line.l_orderkey, line.l_linenumber, line.l_returnflag):
        pieces[10 * o + n] = min(f, pieces.get(10 * o + n, f))
    chain = {}
    for p in sorted(pieces):
        chain[p] = chain[p - 1] if pieces.get(p - 1) == pieces[p] else p
    got = {r["piece"]: r["chain"] for r in catalog.QUERIES["w13_street_chains"](spark, SF).collect()}
    assert got == chain


def test_station_matrix_of_all_rows(spark, line):
    cost = {}
    for o, s, p in zip(line.l_orderkey, line.l_suppkey, line.l_partkey):
        if s != p % 100:
            cost[s, p % 100] = min(cost.get((s, p % 100), 10**9), 1000 + o * 37 % 5000)
    ahead = {}
    for (a, b), c in cost.items():
        ahead.setdefault(a, []).append((b, c))
    stations = sorted(set(pd.read_parquet(f"{SF}/supplier.parquet").s_suppkey))
    wanted = {}
    for start in stations:
        if start not in ahead and all(start != b for _, b in cost):
            continue
        best, todo = {}, [(0, start)]
        while todo:
            d, node = heapq.heappop(todo)
            if node not in best:
                best[node] = d
                for b, c in ahead.get(node, ()):
                    heapq.heappush(todo, (d + c, b))
        for end in stations:
            if end in best:
                far = 0 if end == start else (start % 90 + best[end] + end % 90 + 50) // 100
                if far < 65535:
                    wanted[start, end] = far
    got = {(r["origin"], r["dest"]): r["decameters"] for r in catalog.QUERIES["g5_station_matrix"](spark, SF).collect()}
    assert got == wanted
