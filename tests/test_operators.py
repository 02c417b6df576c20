"""Ordered and graph operators against definitions."""

import itertools
import random

import numpy as np
import pytest

from metrolith.operators import gates, graph, smoothing, timetable


def test_smoothing_by_hand():
    s, q = np.zeros(96), np.zeros(96)
    s[32:36], q[32:36] = [4, 0, 2, 2], [8, 0, 2, 4]
    near = np.zeros(96)
    near[32], near[40] = 3.0, 1.0
    mean, phi = smoothing.smooth_cell(s, q, 4, [near])
    prior = near / 4 * 2.0
    hour = (8 + 8 * prior[32:36].sum()) / (4 * 12)
    assert mean[32] == (4 + 4 * hour) / 8 and mean[33] == (0 + 4 * hour) / 8
    v = (4 * q[32:36] - s[32:36] ** 2) / 12
    of_hour = v.sum() / 2.0
    assert phi[32] == max(1.0, (4 * (v[0] / 1.0) + 6 * of_hour) / 10) and phi[33] == max(1.0, (4 * of_hour + 6 * of_hour) / 10)
    empty, flat = smoothing.smooth_cell(np.zeros(96), np.zeros(96), 0, [])
    assert not empty.any() and (flat == 1).all()
    closed, _ = smoothing.smooth_cell(np.zeros(96), np.zeros(96), 0, [near, near])
    assert closed[32] == pytest.approx(8 * 3.0 / (4 * 8) * 1.0)
    cells = smoothing.cells_of({m: (s, q) for m in ("classic", "ebike", "any")}, 4, {m: [near] for m in ("classic", "ebike", "any")})
    from metrolith.functions.half import half_value

    both = half_value(cells["mean_classic"]) + half_value(cells["mean_ebike"])
    assert (half_value(cells["variance_any"]) >= both).all() and (cells["variance_classic"] >= cells["mean_classic"]).all()


def test_smoothed_cells_do_not_depend_on_partitions(spark):
    from metrolith.plans import catalog

    found = catalog.QUERIES["a5_a6_smoothed_cells"](spark, "/root/testdata/sf0.001")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    a = sorted(map(tuple, found.collect()))
    spark.conf.set("spark.sql.shuffle.partitions", "7")
    b = sorted(map(tuple, catalog.QUERIES["a5_a6_smoothed_cells"](spark, "/root/testdata/sf0.001").collect()))
    spark.conf.set("spark.sql.shuffle.partitions", before)
    assert a == b and len(a) % (96 * 4) == 0 and all(r[8] >= 0 for r in a)


def test_fifo_split_never_overtakes_and_is_first_fit():
    rng = random.Random(1)
    for _ in range(40):
        trips = [(k, rng.choice([(1, 2), (2, 3), (4,)]), tuple(sorted(rng.randint(0, 60) for _ in range(6)))) for k in range(rng.randint(1, 12))]
        shares = lambda a, b: bool(set(a) & set(b))
        subs = timetable.fifo_split(trips, shares)
        for (a, x), (b, y) in itertools.combinations(zip(subs, trips), 2):
            if a == b and shares(x[1], y[1]):
                assert all(p <= q for p, q in zip(x[2], y[2])) or all(p >= q for p, q in zip(x[2], y[2]))
        assert set(subs) == set(range(max(subs) + 1))
    pair = [("a", (1,), (0, 0, 10, 10)), ("b", (1,), (1, 1, 5, 5)), ("c", (2,), (1, 1, 5, 5))]
    assert timetable.fifo_split(pair, lambda a, b: a == b) == [0, 1, 0]


def test_clean_times_on_a_night_trip(spark):
    rows = [("t", 0, 86000, 86000), ("t", 1, None, None), ("t", 2, 600, 600), ("t", 3, 500, 700), ("u", 0, 100, 100), ("u", 5, 50, 60)]
    found = {(r["trip"], r["pos"]): (r["arrival"], r["departure"], r["repaired"]) for r in timetable.clean_times(spark.createDataFrame(rows, "trip string, pos int, arrival int, departure int")).collect()}
    assert found[("t", 1)][:2] == (86500, 86500) and found[("t", 2)][0] == 87000 and found[("t", 3)] == (87000, 87100, True)
    assert found[("u", 5)] == (100, 100, True)


def test_shape_matching():
    line = [(float(x), 0.0) for x in range(0, 2001, 100)]
    assert timetable.match_shape([(0.0, 5.0), (500.0, 5.0), (2000.0, 5.0)], line)[0] == [0, 5, 20]
    assert timetable.match_shape([(2000.0, 5.0), (500.0, 5.0), (0.0, 5.0)], line)[:2] == ([0, 15, 20], True)
    assert timetable.match_shape([(0.0, 900.0)], line)[0] is None
    loop = line[:6] + [(500.0, 400.0), (300.0, 400.0), (0.0, 300.0), (10.0, 0.0)]
    assert timetable.stop_vertices([(10.0, 0.0)], loop) == [0]


def test_searches_equal_all_pairs(spark):
    rng = random.Random(3)
    edges = {(rng.randrange(25), rng.randrange(25)): rng.randint(1, 40) for _ in range(110)}
    edges = {k: v for k, v in edges.items() if k[0] != k[1]}
    best = {(a, a): 0 for a in range(25)} | dict(edges)
    for k, i, j in itertools.product(range(25), repeat=3):
        if (i, k) in best and (k, j) in best and best[i, k] + best[k, j] < best.get((i, j), 10**9):
            best[i, j] = best[i, k] + best[k, j]
    df = spark.createDataFrame([(a, b, c, c * 2) for (a, b), c in edges.items()], "src bigint, dst bigint, cost bigint, length bigint")
    starts = spark.createDataFrame([(a, a, 0, 0) for a in range(0, 25, 6)], "origin bigint, node bigint, cost bigint, length bigint")
    used = {n for e in edges for n in e}
    wanted = {(a, b): c for (a, b), c in best.items() if a % 6 == 0 and b in used and a in used}
    for most in (1000, 0):
        found = {(r["origin"], r["node"]): (r["cost"], r["length"]) for r in graph.shortest_paths(spark, df, starts, most_edges=most).where("origin in (0, 6, 12, 18, 24)").collect()}
        assert {k: c for k, (c, _) in found.items() if k[0] in used} == wanted
        assert all(length == 2 * cost for cost, length in found.values())
    back = {(r["origin"], r["node"]): r["cost"] for r in graph.shortest_paths(spark, df, starts, reverse=True, bound=50).collect()}
    assert all(best[b, a] == c and c <= 50 for (a, b), c in back.items())
    csr = graph.Csr.of(*zip(*[(a, b, c, c) for (a, b), c in edges.items()]))
    for a, b in list(wanted)[:30]:
        goal = csr.place(b)
        cost, parent = csr.search([(a, 0, 0)], goal=goal, guess=lambda i: 0)
        assert cost[goal][0] == best[a, b] and csr.path(parent, goal)[0] == a


def test_components(spark):
    rng = random.Random(4)
    edges = [(rng.randrange(60), rng.randrange(60)) for _ in range(45)] + [(100 + i, 101 + i) for i in range(40)]
    strong = graph.strong_components(edges)
    reach = {n: {n} for e in edges for n in e}
    for _ in range(110):
        for a, b in edges:
            reach[a] |= reach[b]
    assert all(strong[a] == min(b for b in reach[a] if a in reach[b]) for a in reach)
    found = {r["node"]: r["root"] for r in graph.components(spark, spark.createDataFrame(edges, "src bigint, dst bigint")).collect()}
    label = {n: n for n in reach}
    for _ in range(110):
        for a, b in edges:
            label[a] = label[b] = min(label[a], label[b])
    assert found == label


def test_connectors_and_chains(spark):
    pool = spark.createDataFrame([(1, 2, 100, 100), (2, 3, 150, 150), (2, 4, 300, 300)], "src bigint, dst bigint, cost bigint, length bigint")
    node = lambda *n: spark.createDataFrame([(x,) for x in n], "node bigint")
    assert [tuple(r) for r in graph.nearest_connectors(spark, pool, node(1), node(3, 4), 300).collect()] == [(1, 3, 250)]
    assert graph.nearest_connectors(spark, pool, node(1), node(4), 300).count() == 0
    pieces = spark.createDataFrame([(1, 10, 11, "x"), (2, 11, 12, "x"), (3, 12, 13, "y"), (4, 20, 21, "x")], "piece bigint, a bigint, b bigint, attributes string")
    assert {r["piece"]: r["chain"] for r in graph.merge_chains(spark, pieces).collect()} == {1: 1, 2: 1, 3: 3, 4: 4}


def test_run_plan_skips_what_needs_a_failed_step():
    assert gates.run_plan({"links"})["manifest"] == "skipped" and gates.run_plan({"links"})["flows"] == "ok"
    assert set(gates.run_plan(set()).values()) == {"ok"}


def test_match_shapes_in_spark(spark):
    stops = spark.createDataFrame([(1, 0, 0.0, 1.0), (1, 1, 300.0, 1.0)], "pattern int, pos int, x double, y double")
    points = spark.createDataFrame([("s", k, 100.0 * k, 0.0) for k in range(5)], "shape string, seq int, x double, y double")
    row = timetable.match_shapes(stops, points, spark.createDataFrame([(1, "s")], "pattern int, shape string")).first()
    assert row["vertices"] == [0, 3] and not row["reversed"] and row["worst"] == pytest.approx(1.0)
