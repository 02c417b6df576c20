"""Empirical-Bayes smoothing of flow tallies into mean and variance cells.

All sums over bins and neighbours run in a fixed order (bin 0 first, nearest neighbour first), in double precision with
+ - * / only, so results do not depend on partitioning.  Each station's cells come from 96-entry arrays
of its own and of at most eight neighbours: no group is unbounded.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from metrolith.functions.half import half_bits, half_value, raise_to
from metrolith.operators.flows import BINS
from metrolith.session import ship_package


@dataclass(frozen=True)
class Kappas:
    cell: float = 4.0
    hour: float = 8.0
    dispersion: float = 6.0


def _fold(values: np.ndarray) -> float:
    """A sum from left to right (a running sum keeps that order, which np.sum does not)."""
    return float(np.cumsum(values)[-1])


def _by_hour(values: np.ndarray) -> np.ndarray:
    """Sums of the four bins of each hour, from left to right, one for each bin."""
    x = values.reshape(-1, 4)
    return np.repeat(((x[:, 0] + x[:, 1]) + x[:, 2]) + x[:, 3], 4)


def smooth_cell(s: np.ndarray, q: np.ndarray, n: int, neighbours: list[np.ndarray], k: Kappas = Kappas()) -> tuple[np.ndarray, np.ndarray]:
    """(mean, dispersion) of 96 bins from sums, sums of squares, active days and the neighbours' raw means."""
    s, q = np.asarray(s, np.float64), np.asarray(q, np.float64)
    raw = s / n if n else np.zeros(BINS)
    total = _fold(raw)
    shape = np.zeros(BINS)
    for m in neighbours:
        shape = shape + m
    mass = _fold(shape)
    if mass > 0:
        prior = shape / mass * (total if n else mass / len(neighbours))
    else:
        prior = np.full(BINS, total / BINS)
    weight = n + k.hour
    of_hour = (_by_hour(s) + k.hour * _by_hour(prior)) / (4 * weight) if weight else np.zeros(BINS)
    mean = (s + k.cell * of_hour) / (n + k.cell) if n + k.cell else of_hour
    if n < 2:
        return mean, np.ones(BINS)
    variance = (n * q - s * s) / (n * (n - 1))
    busy = _by_hour(raw)
    ratio = np.where(busy > 0, _by_hour(variance) / np.where(busy > 0, busy, 1.0), 1.0)
    own = np.where(raw > 0, variance / np.where(raw > 0, raw, 1.0), ratio)
    return mean, np.maximum(1.0, (n * own + k.dispersion * ratio) / (n + k.dispersion))


CELL_SCHEMA = "key string, day_type string, direction string, bin int, mean_classic int, variance_classic int, mean_ebike int, variance_ebike int, variance_any int"


def cells_of(series: dict[str, tuple[np.ndarray, np.ndarray]], n: int, neighbours: dict[str, list[np.ndarray]], k: Kappas = Kappas()) -> dict[str, np.ndarray]:
    """The five stored half-float slots of one key, day type and direction."""
    found = {name: smooth_cell(*series[name], n, neighbours[name], k) for name in ("classic", "ebike", "any")}
    out = {}
    for name in ("classic", "ebike"):
        mean, phi = found[name]
        out[f"mean_{name}"], out[f"variance_{name}"] = half_bits(mean), half_bits(mean * phi)
    both = half_value(out["mean_classic"]) + half_value(out["mean_ebike"])
    exact = (found["classic"][0] + found["ebike"][0]) * found["any"][1]
    out["variance_any"] = raise_to(half_bits(exact), both)
    return out


_SERIES = ("classic", "ebike", "any")


def _dense(cells: pa.Array) -> np.ndarray:
    """Lists of (series, bin, s, q) as an array (row, series, sum or square, bin); bins without a cell are zero."""
    if isinstance(cells, pa.ChunkedArray):
        cells = cells.combine_chunks()
    sizes = np.asarray(pc.fill_null(pc.list_value_length(cells), 0))
    out = np.zeros((len(cells), len(_SERIES), 2, BINS))
    flat = cells.flatten()
    if len(flat):
        row = np.repeat(np.arange(len(cells)), sizes)
        series = np.asarray(pc.index_in(flat.field("series"), pa.array(_SERIES)))
        place = np.asarray(flat.field("bin"))
        for k, name in enumerate(("s", "q")):
            out[row, series, k, place] = np.asarray(flat.field(name), np.float64)
    return out


def smooth(tallies: DataFrame, active: DataFrame, neighbours: DataFrame, keys: DataFrame, kappas: Kappas = Kappas()) -> DataFrame:
    """Cells of every key, day type and direction.

    tallies: as ``flows.tally``; active: key, day_type, direction, n; neighbours: key, neighbour, rank; keys: key.
    """
    ship_package(keys.sparkSession)
    side = ["key", "day_type", "direction"]
    sides = keys.select("key", F.explode(F.array(F.lit("weekday"), F.lit("weekend"))).alias("day_type"))
    sides = sides.select("key", "day_type", F.explode(F.array(F.lit("arrivals"), F.lit("departures"))).alias("direction"))
    sides = sides.join(active, side, "left").select(*side, F.coalesce("n", F.lit(0)).alias("n"))
    packed = tallies.groupBy(*side).agg(F.collect_list(F.struct("series", "bin", "s", "q")).alias("cells"))  # 288 at most
    wide = sides.join(packed, side, "left")
    lent = wide.where("n > 0").select(F.col("key").alias("neighbour"), "day_type", "direction", F.col("n").alias("days"), "cells")
    near = neighbours.select("key", "neighbour", "rank").join(lent, "neighbour").groupBy(*side).agg(F.collect_list(F.struct("rank", "days", "cells")).alias("near"))
    rows = wide.join(near, side, "left")
    names = [c.split()[0] for c in CELL_SCHEMA.split(", ")]

    def run(batches):
        for batch in batches:
            own, near = _dense(batch.column("cells")), batch.column("near")
            flat = near.flatten()
            owner = np.repeat(np.arange(batch.num_rows), np.asarray(pc.fill_null(pc.list_value_length(near), 0)))
            order = np.lexsort((np.asarray(flat.field("rank")), owner)) if len(flat) else np.empty(0, int)
            lent = _dense(flat.field("cells"))[:, :, 0] / np.asarray(flat.field("days"), np.float64)[:, None, None] if len(flat) else np.zeros((0, 3, BINS))
            at = np.searchsorted(owner[order], np.arange(batch.num_rows + 1))
            made = []
            for r, n in enumerate(batch.column("n").to_pylist()):
                around = lent[order[at[r] : at[r + 1]]]
                made.append(cells_of({m: (own[r, i, 0], own[r, i, 1]) for i, m in enumerate(_SERIES)}, n, {m: list(around[:, i]) for i, m in enumerate(_SERIES)}, kappas))
            every = pa.array(np.repeat(np.arange(batch.num_rows), BINS))
            same = [batch.column(c).take(every) for c in side]
            bins = pa.array(np.tile(np.arange(BINS, dtype=np.int32), batch.num_rows))
            yield pa.RecordBatch.from_arrays([*same, bins, *(pa.array(np.concatenate([m[c] for m in made]) if made else [], pa.int32()) for c in names[4:])], names)

    return rows.mapInArrow(run, CELL_SCHEMA)
