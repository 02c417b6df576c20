"""SimHash near-duplicates found by a vantage-point tree over Hamming distance (operator 7).

1. Every text gets a 64-bit SimHash (see ``simhash``).  Equal fingerprints are one class.
2. A vantage-point tree is built on the driver from at most ``MOST_SAMPLE`` distinct fingerprints, so its
   size is bounded.  It only decides how work is dealt, never which links are found.
3. Every distinct fingerprint goes down the tree: at a node with vantage v and bound mu it goes inside if
   its distance d <= mu, else outside; and if mu < d <= mu + radius it is also sent inside, because by the
   triangle inequality only such outsiders can have a partner there.  So two fingerprints within the
   radius share at least one leaf.
4. A leaf goes on splitting in the same way down to small blocks, compares these exactly, and
   gives a star of links for each group it finds, never all pairs.
5. Components of the stars give each fingerprint, and so each document, its smallest doc_id.

With ``check`` a link is a pair of texts whose sets of ``check.shingle``-word shingles have a Jaccard similarity of
``check.similarity`` or more, counted on the sets themselves (as 64-bit hashes).  Pairs to count come from two finders:
- several independent fingerprints (``tables``), each with a tree of its own; a small radius is what lets the triangle
  inequality prune.  SimHash bits of the check's shingles pick what is worth counting;
- MinHash keys: texts of Jaccard s meet in one of ``bands`` keys of ``rows`` least hashes with probability
  1 - (1 - s^rows)^bands, whatever the edit between them (0.99993 at 0.8, more above).
In each bucket of a MinHash key all are counted against one, then ``HUBS`` of them.  Texts of buckets that still hold
several components are compared across components, found by the rarest of their own shingles (a prefix filter, exact), so
neither large groups nor passages that very many texts share cost a square, and no pair that could add a link is left out.

Defined results: null and empty texts have fingerprint zero, linked like any other; texts shorter than a
shingle are one shingle.  Null doc_ids get a row and count as larger than any other; a
component of only such rows has a null component_id.  Repeated rows are kept.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from metrolith.llm import common, simhash
from metrolith.llm.components import components
from metrolith.session import drop_scratch, scratch_mark

#: Fingerprints that the tree is built from: 16 a leaf, but so many at least and at most.
SAMPLE = 65_536
MOST_SAMPLE = 2_000_000
LEAF = 32_768
BLOCK = 512
HUBS = 3
GIST = 64
#: Ids are broadcast only up to this number (8 bytes each).
BROADCAST_IDS = 1_000_000


def distances(points: np.ndarray, vantage: np.uint64) -> np.ndarray:
    return np.bitwise_count(points ^ vantage)


def choose(points: np.ndarray, radius: int, seed: int, tries: int = 6) -> tuple[np.uint64, int] | None:
    """A vantage point and bound that split the points and leave few in the border, or None."""
    rng = np.random.default_rng(seed)
    best = None
    for v in points[rng.integers(0, len(points), tries)]:
        d = distances(points, v)
        share = np.cumsum(np.bincount(d, minlength=66)) / len(points)
        for mu in range(64):
            if 0.2 <= share[mu] <= 0.8:
                border = share[min(mu + radius, 65)] - share[mu]
                cost = (share[mu] + border) ** 2 + (1 - share[mu]) ** 2
                if best is None or cost < best[0]:
                    best = (cost, v, mu)
    return (best[1], best[2]) if best and best[0] < 0.97 else None


def build_tree(sample: np.ndarray, leaf: float, radius: int) -> list[tuple[int, int, int, int]]:
    """Nodes (vantage, mu, inside, outside); a child below zero is leaf number -child - 1."""
    nodes: list[tuple[int, int, int, int]] = []
    leaves = 0

    def grow(points: np.ndarray, depth: int) -> int:
        nonlocal leaves
        cut = choose(points, radius, depth) if len(points) > max(leaf, 8) and depth < 40 else None
        if cut is None:
            leaves += 1
            return -leaves
        place = len(nodes)
        nodes.append((0, 0, 0, 0))
        v, mu = cut
        d = distances(points, v)
        nodes[place] = (int(v), mu, grow(points[d <= mu], depth + 1), grow(points[d > mu], depth + 1))
        return place

    grow(np.sort(sample), 0)
    return nodes


def route(points: np.ndarray, nodes: list[tuple[int, int, int, int]], radius: int) -> Iterator[tuple[int, np.ndarray]]:
    """(leaf, indices of points) for every leaf that a point belongs or overlaps to."""
    todo = [(0, np.arange(len(points)))] if nodes else []
    if not nodes:
        yield 0, np.arange(len(points))
    while todo:
        node, rows = todo.pop()
        if node < 0:
            yield -node - 1, rows
        elif len(rows):
            v, mu, inside, outside = nodes[node]
            d = distances(points[rows], np.uint64(v))
            todo += [(inside, rows[d <= mu + radius]), (outside, rows[d > mu])]


def link_points(points: np.ndarray, radius: int, sketch: np.ndarray | None = None, most: int = 0) -> np.ndarray:
    """For distinct fingerprints: the index of the least linked one that is reachable here."""
    root = np.arange(len(points))
    ends: list[np.ndarray] = []

    def block(rows: np.ndarray) -> None:
        near = np.bitwise_count(points[rows][:, None] ^ points[rows][None, :])
        i, j = np.nonzero(near <= radius)
        i, j = i[i < j], j[i < j]
        if sketch is not None and len(i):
            apart = near[i, j].astype(np.int64)
            for k in range(sketch.shape[1]):
                apart += np.bitwise_count(sketch[rows[i], k] ^ sketch[rows[j], k])
            i, j = i[apart <= most], j[apart <= most]
        if len(i):
            label = _least(len(rows), i, j)
            changed = np.flatnonzero(label != np.arange(len(rows)))
            ends.append(np.stack((rows[changed], rows[label[changed]])))

    def descend(rows: np.ndarray, depth: int) -> None:
        cut = choose(points[rows] if len(rows) <= 4096 else points[rows[:: len(rows) // 2048]], radius, depth, 4) if len(rows) > BLOCK and depth < 60 else None
        if cut is None:
            if len(rows) <= 4 * BLOCK:
                block(rows)
            else:  # no bound prunes: compare exactly, block against block
                parts = [rows[a : a + BLOCK] for a in range(0, len(rows), BLOCK)]
                for x, a in enumerate(parts):
                    for b in parts[x:]:
                        block(np.unique(np.concatenate((a, b))) if a is not b else a)
            return
        d = distances(points[rows], cut[0])
        descend(rows[d <= cut[1] + radius], depth + 1)
        descend(rows[d > cut[1]], depth + 1)

    if len(points):
        descend(np.arange(len(points)), 0)
    if ends:
        i, j = np.concatenate(ends, axis=1)
        root = _least(len(points), i, j)
    return root


def _least(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Least index reachable over edges i-j, by hooking and pointer jumping."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[i], label[j])
        before = label.copy()
        np.minimum.at(label, label[i], low)
        np.minimum.at(label, label[j], low)
        np.minimum.at(label, i, low)
        np.minimum.at(label, j, low)
        label = label[label]
        if (label == before).all():
            return label


@dataclass(frozen=True)
class Check:
    """Which pairs count as near copies, and how they are found."""

    shingle: int = 5
    similarity: float = 0.8
    words: int = 4
    slack: float = 1.5
    bands: int = 24
    rows: int = 5

    def most_apart(self) -> int:
        bits = 64 * self.words
        p = math.acos(2 * self.similarity / (1 + self.similarity)) / math.pi
        return int(bits * p + self.slack * math.sqrt(bits * p * (1 - p)))


def fingerprint_table(docs: DataFrame, shingle: int, tables: int, check: Check | None) -> DataFrame:
    """doc_id, copy (hash of the text), fp (the first key), keys (8 bytes for each table), sketch (the check's bits, or empty).

    With ``check`` also n, mark and bands (size, sum of mixed hashes and MinHash keys of the shingle set) and text.
    """
    plan = ((shingle, tables),) + (((check.shingle, check.words),) if check else ())
    schema = "doc_id long, copy long, fp long, keys binary, sketch binary" + (", n long, mark long, bands array<long>, text binary" if check else "")
    names = [x.split()[0] for x in schema.split(", ")]

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in common.slices(batch.column(1)):
                text = batch.column(1)[a:b]
                found = simhash.fingerprints(text, plan)
                parts = [pa.array([x.tobytes() for x in found[:, i:j]], pa.binary()) for i, j in ((0, tables), (tables, found.shape[1]))]
                first = pa.array(np.ascontiguousarray(found[:, 0]).view(np.int64))
                if check:
                    hashes, at = simhash.shingle_sets(text, check.shingle)
                    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(common.mix(hashes), dtype=np.uint64)))
                    keys = simhash.band_keys(hashes, at, check.bands, check.rows)
                    lists = pa.ListArray.from_arrays(pa.array(np.arange(len(keys) + 1, dtype=np.int32) * check.bands), pa.array(keys.reshape(-1).view(np.int64)))
                    parts += [pa.array(np.diff(at)), pa.array((total[at[1:]] - total[at[:-1]]).view(np.int64)), lists, text]
                yield pa.RecordBatch.from_arrays([batch.column(0)[a:b], batch.column(2)[a:b], first, *parts], names)
        common.give_back()

    return common.id_and_bytes(docs).withColumn("copy", F.xxhash64("text")).mapInArrow(make, schema)


def _few(spark: SparkSession, rows: DataFrame) -> DataFrame:
    """Rows of ids to look up by: sent to every task if they are counted and few, else joined by a shuffle."""
    rows = rows.checkpoint()
    return F.broadcast(rows) if rows.count() <= BROADCAST_IDS else rows


def _shingle_sets(spark: SparkSession, table: DataFrame, nodes: DataFrame, check: Check) -> DataFrame:
    """node, grams (its distinct shingle hashes), gist (how many of them in each of ``GIST`` parts) of the asked nodes."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for x, y in common.slices(batch.column(1)):
                hashes, at = simhash.shingle_sets(batch.column(1)[x:y], check.shingle)
                lists = pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(hashes.view(np.int64)))
                counts = np.bincount(common.owner_of(at) * GIST + (hashes >> np.uint64(58)).astype(np.int64), minlength=(y - x) * GIST)
                gist = np.minimum(counts, 255).astype(np.uint8).reshape(-1, GIST)
                yield pa.RecordBatch.from_arrays([batch.column(0)[x:y], lists, pa.array([g.tobytes() for g in gist], pa.binary())], ["node", "grams", "gist"])
        common.give_back()

    path = common.scratch(spark, "shingle-sets")
    texts = table.select("node", "text").join(_few(spark, nodes.distinct()), "node", "left_semi").groupBy("node").agg(F.first("text").alias("text"))
    texts.mapInArrow(make, "node long, grams array<long>, gist binary").write.parquet(path)
    return spark.read.parquet(path)


def _similar(spark: SparkSession, pairs: DataFrame, sets: DataFrame, check: Check) -> DataFrame:
    """The ``pairs`` (a, b) whose shingle sets are as similar as ``check`` asks.

    Only the sets that a side asks for are shuffled; pairs of many texts with few hubs should have the hubs as b.
    """

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # sets differ in at least as many shingles as their counts do, so this drops no pair that is similar enough
        for batch in batches:
            p, q = (np.frombuffer(b"".join(c.to_pylist()), np.uint8).reshape(-1, GIST).astype(np.int64) for c in (batch.column(2), batch.column(3)))
            sizes = batch.column(4).to_numpy()
            keep = np.abs(p - q).sum(axis=1) <= (1 - check.similarity) / (1 + check.similarity) * sizes + 1e-6
            yield batch.select([0, 1]).filter(pa.array(keep))

    pairs = pairs.checkpoint()
    if not pairs.limit(1).count():
        return pairs
    close = pairs
    for end in ("a", "b"):
        close = close.join(sets.select(F.col("node").alias(end), F.col("gist").alias(f"gist_{end}"), F.size("grams").alias(f"n_{end}")), end)
    close = close.select("a", "b", "gist_a", "gist_b", (F.col("n_a") + F.col("n_b")).alias("sizes")).mapInArrow(near, "a long, b long").checkpoint()
    counted = close
    for end in ("a", "b"):
        asked = _few(spark, close.select(F.col(end).alias("node")).distinct())
        counted = counted.join(sets.join(asked, "node", "left_semi").select(F.col("node").alias(end), F.col("grams").alias(f"grams_{end}")), end)
    both = F.size(F.array_intersect("grams_a", "grams_b"))
    return counted.where(both / (F.size("grams_a") + F.size("grams_b") - both) >= check.similarity).select("a", "b").checkpoint()


def _merged(spark: SparkSession, labels: DataFrame, links: DataFrame) -> DataFrame:
    """(node, root) of the components that ``labels`` (node, root, roots included) make together with new links: only roots are linked anew."""
    if not links.limit(1).count():
        return labels
    for end in ("a", "b"):
        links = links.join(labels.select(F.col("node").alias(end), F.col("root").alias(f"root_{end}")), end, "left")
    found = components(spark, links.select(F.coalesce("root_a", "a").alias("a"), F.coalesce("root_b", "b").alias("b")))
    moved = labels.join(found.select(F.col("node").alias("root"), F.col("root").alias("_new")), "root", "left").select("node", F.coalesce("_new", "root").alias("root"))
    return moved.unionByName(found.join(labels.select("node"), "node", "left_anti")).checkpoint()


def _ordered(rows: DataFrame, x: str = "x", y: str = "y") -> DataFrame:
    return rows.select(F.greatest(x, y).alias("a"), F.least(x, y).alias("b")).distinct()


def _apart(pairs: DataFrame, comps: DataFrame) -> DataFrame:
    """The ``pairs`` (a, b) whose ends are in different components (node, root; others are their own)."""
    for end in ("a", "b"):
        pairs = pairs.join(comps.select(F.col("node").alias(end), F.col("root").alias(f"root_{end}")), end, "left")
    return pairs.where(F.coalesce("root_a", "a") != F.coalesce("root_b", "b")).select("a", "b")


def _confirmed(spark: SparkSession, found: DataFrame, table: DataFrame, classes: DataFrame, check: Check) -> DataFrame:
    """(node, root) of the classes that links join, each link counted on its shingle sets; ``found`` are pairs from elsewhere to count too.

    Three rounds, each only for what the one before left apart: every text with its best hub, with the other hubs of
    its buckets, and across the components that still share a bucket.
    """
    mark = scratch_mark()
    path, tried_path, found_path = (common.scratch(spark, n) for n in ("buckets", "pairs", "tree-pairs"))
    # the place of a key is part of it (see band_keys); texts without a shingle are one class and have no pair
    members = classes.where("n > 0").select("node", "n", F.explode("bands").alias("key"))
    several = members.groupBy("key").agg(F.count("*").alias("size")).where("size > 1")
    members = members.join(several, "key")
    # the text in the middle of a group shares the most buckets with others: it is the best hub
    nodes = members.groupBy("node", "n").agg(F.sum("size").alias("weight"), F.collect_list("key").alias("keys"))  # a key a band
    nodes.select("node", "n", "weight", F.explode("keys").alias("key")).write.parquet(path)
    members = spark.read.parquet(path)
    found.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct().write.parquet(found_path)
    found = spark.read.parquet(found_path)
    sets = _shingle_sets(spark, table, members.select("node").unionByName(found.select(F.explode(F.array("a", "b")).alias("node"))), check)

    orders = [-F.col("weight"), *(F.xxhash64("node", F.lit(k)) for k in range(1, HUBS))]
    hubs = members.groupBy("key").agg(*(F.min(F.struct(h.alias("h"), "node", "n", "weight")).alias(f"hub{k}") for k, h in enumerate(orders)))
    hubs = hubs.select("key", F.array_distinct(F.array(*(F.struct(f"hub{k}.node", f"hub{k}.n", f"hub{k}.weight") for k in range(HUBS)))).alias("hubs"))
    starred = members.select("key", "node", "n").join(hubs, "key").select("node", "n", F.explode("hubs").alias("y"))
    can = F.least("n", "y.n") / F.greatest("n", "y.n") >= check.similarity
    starred.where((F.col("node") != F.col("y.node")) & can).select(F.col("node").alias("x"), F.col("y.node").alias("y"), "y.weight").distinct().write.parquet(tried_path)
    tried = spark.read.parquet(tried_path)

    best = tried.groupBy("x").agg(F.max(F.struct("weight", "y")).alias("best")).select("x", F.col("best.y").alias("y"))
    best = best.select(F.col("x").alias("a"), F.col("y").alias("b"))
    links = _similar(spark, best.unionByName(found), sets, check)
    comps = components(spark, links).checkpoint()
    other = _apart(tried.select(F.col("x").alias("a"), F.col("y").alias("b")).distinct(), comps).join(best, ["a", "b"], "left_anti")
    comps = _merged(spark, comps, _similar(spark, other, sets, check))
    grouped = members.join(comps, "node", "left").withColumn("comp", F.coalesce("root", "node")).select("key", "comp", "node", "n")
    mixed = grouped.groupBy("key").agg(F.min("comp").alias("low"), F.max("comp").alias("high")).where("low < high").select("key")
    unsettled = grouped.join(mixed, "key", "left_semi").select("node", "comp", "n").distinct()
    rest = _across(spark, unsettled, sets, check).join(_ordered(tried), ["a", "b"], "left_anti").checkpoint()
    comps = _merged(spark, comps, _similar(spark, rest, sets, check))
    drop_scratch(spark, mark)
    return comps


def _across(spark: SparkSession, unsettled: DataFrame, sets: DataFrame, check: Check) -> DataFrame:
    """Pairs (a, b) of different components of ``unsettled`` (node, comp, n) that can reach ``check.similarity``.

    A prefix filter: shingles are ordered by the number of components that hold them, then by hash.  Of two sets x, y with
    |x| <= |y| and similarity t, the first |x| - ceil(2t/(1+t) |x|) + 1 shingles of x and the first
    |y| - ceil(t |y|) + 1 of y have one in common, whatever the order, so no pair is lost.  A shingle of one component only
    can't be that one, and what is left of a set without these has to hold the overlap that the similarity asks for.  A
    passage that very many texts share comes last in their order, so it makes no pairs.
    """
    t = check.similarity
    path, shared_path = common.scratch(spark, "unsettled-sets"), common.scratch(spark, "shared-grams")
    sets.select("node", "grams").join(_few(spark, unsettled), "node").write.parquet(path)
    grams = spark.read.parquet(path).select("node", "comp", "n", F.explode("grams").alias("gram"))
    # counted in two steps, so that a shingle of very many texts is one row a task
    spread = grams.groupBy("gram", "comp").agg(F.lit(1).alias("one")).groupBy("gram").agg(F.count("*").alias("comps")).where("comps > 1")
    spread.write.parquet(shared_path)
    lists = grams.join(spark.read.parquet(shared_path), "gram").groupBy("node", "comp", "n").agg(F.sort_array(F.collect_list(F.struct("comps", "gram"))).alias("grams"))
    probe = F.col("n") - F.ceil(F.col("n") * t - 1e-6) + 1
    index = F.col("n") - F.ceil(F.col("n") * (2 * t / (1 + t)) - 1e-6) + 1
    alone = F.col("n") - F.size("grams")  # shingles of one component come first and match nothing
    heads = lists.select("node", "comp", "n", F.size("grams").alias("most"), index.alias("index"), alone.alias("alone"), F.slice("grams", F.lit(1), F.greatest(probe - alone, F.lit(0)).cast("int")).alias("grams"))
    heads = heads.select("node", "comp", "n", "most", "index", "alone", F.posexplode("grams").alias("at", "g"))
    heads = heads.select("node", "comp", "n", "most", (F.col("at") + F.col("alone") < F.col("index")).alias("low"), F.col("g.gram").alias("gram")).checkpoint()
    x = heads.where("low").select("gram", F.struct("node", "comp", "n", "most").alias("x"))
    y = heads.select("gram", F.struct("node", "comp", "n", "most").alias("y"))
    later = (F.col("x.n") < F.col("y.n")) | ((F.col("x.n") == F.col("y.n")) & (F.col("x.node") < F.col("y.node")))
    room = F.least("x.most", "y.most") >= (F.col("x.n") + F.col("y.n")) * (t / (1 + t)) - 1e-6
    pairs = x.join(y, "gram").where(later & (F.col("x.comp") != F.col("y.comp")) & (F.col("x.n") >= F.col("y.n") * t - 1e-6) & room)
    return _ordered(pairs, "x.node", "y.node")


def near_duplicates(
    spark: SparkSession,
    docs: DataFrame,
    *,
    shingle: int = 3,
    radius: int = 2,
    tables: int = 1,
    check: Check | None = None,
) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id for each row of ``docs`` (doc_id, text)."""
    found = _labelled(spark, docs, shingle, radius, tables, check)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def _labelled(spark: SparkSession, docs: DataFrame, shingle: int = 3, radius: int = 2, tables: int = 1, check: Check | None = None) -> DataFrame:
    """doc_id, copy, fp, component_id and component (its name, also where doc_ids are reused or null) for each row."""
    common.prepare(spark)
    path, class_path = common.scratch(spark, "fingerprints"), common.scratch(spark, "classes")
    # a class: texts with equal keys (and sketch and shingle set), named by their hash and known by the smallest doc_id
    same = ["keys", "sketch"] + (["n", "mark"] if check else [])
    fingerprint_table(docs, shingle, tables, check).withColumn("node", F.xxhash64(*same) if check else F.xxhash64("keys")).write.option("compression", "zstd").parquet(path)
    table = spark.read.parquet(path)
    table.groupBy(*same, "node", *(["bands"] if check else [])).agg(F.min("doc_id").alias("first")).write.parquet(class_path)
    classes = spark.read.parquet(class_path)
    total = classes.count()
    wanted = min(max(SAMPLE, 16 * total // LEAF), MOST_SAMPLE)
    share = min(1.0, wanted / max(total, 1))
    picked = classes.where(F.pmod(F.xxhash64("keys", F.lit(7)), F.lit(1 << 20)) < int(share * (1 << 20)) + 1).select("keys").limit(2 * wanted)
    sample = np.array([np.frombuffer(r["keys"], np.uint64) for r in picked.collect()], np.uint64).reshape(-1, tables)
    trees = [build_tree(np.unique(sample[:, t]), max(LEAF * len(sample) / max(total, 1), 8), radius) for t in range(tables)]
    most = check.most_apart() if check else 0

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = np.frombuffer(b"".join(batch.column(0).to_pylist()), np.uint64).reshape(-1, tables)
            for t in range(tables):
                points = np.ascontiguousarray(keys[:, t])
                for leaf, rows in route(points, trees[t], radius):
                    if len(rows):
                        at = pa.array(rows)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.full(len(rows), leaf * tables + t, np.int64)), pa.array(points[rows].view(np.int64)), batch.column(1).take(at), batch.column(2).take(at)],
                            ["leaf", "fp", "node", "sketch"],
                        )

    def link(part: pd.DataFrame) -> pd.DataFrame:
        points = part["fp"].to_numpy(np.int64).view(np.uint64)
        names = part["node"].to_numpy(np.int64)
        sketch = np.frombuffer(b"".join(part["sketch"]), np.uint64).reshape(len(part), -1) if check else None
        root = link_points(points, radius, sketch, most)
        common.give_back()
        rows = np.flatnonzero(root != np.arange(len(root)))
        return pd.DataFrame({"a": names[rows], "b": names[root[rows]]})

    dealt = classes.select("keys", "node", "sketch").mapInArrow(deal, "leaf long, fp long, node long, sketch binary")
    links = dealt.groupBy("leaf").applyInPandas(link, "a long, b long")
    roots = _confirmed(spark, links, table, classes, check) if check else components(spark, links)
    # only linked classes have a root; the least doc_id of each root is a small table of its own, so that the join
    # with a very large component has two shuffled sides, which adaptive execution can split
    smallest = classes.join(roots, "node").groupBy("root").agg(F.min("first").alias("least")).checkpoint()
    linked = roots.join(smallest, "root").select("node", "root", "least")
    by_class = classes.join(linked, "node", "left").select(*(F.col(c).alias(f"class_{c}") for c in same), F.coalesce("least", "first").alias("component_id"), F.coalesce("root", "node").alias("component"))
    found = table.join(by_class, [F.col(c) == F.col(f"class_{c}") for c in same], "left")
    return found.select("doc_id", "copy", "fp", "component_id", "component")


def one_of_each(spark: SparkSession, docs: DataFrame, **options) -> DataFrame:
    """One row of ``docs`` of each component, all columns: the one with the smallest doc_id, a null one being the largest.

    Where rows of a component share that doc_id, the one with the smallest xxhash64 of its text stays, and of rows that are
    equal in both the one whose other columns come first as JSON.
    """
    found = _labelled(spark, docs, **options)
    place = lambda: F.coalesce(F.col("doc_id").cast("long"), F.lit(common.LAST_ID))
    least = found.groupBy("component").agg(F.min(F.struct(place().alias("doc"), "copy")).alias("low"))
    path = common.scratch(spark, "leaders")
    least.select(F.col("low.doc").alias("leader"), F.col("low.copy").alias("leader_copy")).write.parquet(path)
    leaders = spark.read.parquet(path)
    names = docs.columns
    others = F.struct(*(F.col(f"`{c}`") for c in names if c not in ("doc_id", "text")), F.lit(0).alias("none_"))
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in names)).alias("row"), place().alias("doc"), F.xxhash64("text").alias("copy"), F.to_json(others).alias("tie"))
    rows = rows.join(leaders, (F.col("doc") == F.col("leader")) & (F.col("copy").eqNullSafe(F.col("leader_copy"))), "left_semi")
    kept = rows.groupBy("doc", "copy").agg(F.min_by("row", "tie").alias("row"))
    return kept.select(*(F.col("row").getField(c).alias(c) for c in names))
