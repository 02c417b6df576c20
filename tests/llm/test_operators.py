"""The training-data operators against brute force, and on edge cases."""

import hashlib
import itertools
import math
import random
import struct
import zlib
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
import xxhash
from pyspark.sql import functions as F

from metrolith.llm import line_winnow, multi_index, ngram_llr, packing, pieces, rans, recompress, sentencepiece_scan, simhash, substring_dedup, token_files, tokens, url_rules, vp_simhash, zstd_quality

SCHEMA = "doc_id long, text string, n_words long, batch long, own string, node long, ids string, kept boolean"


def frame(spark, rows, parts=3):
    """Documents with extra columns whose names clash with what operators use inside."""
    return spark.createDataFrame([(i, t, 7, 1, "x", 2, "y", True) for i, t in rows], SCHEMA).repartition(parts)


def passages(seed=1, n=40):
    """Random texts with shared passages, repeated lines, runs of one word, and every odd case."""
    rng = random.Random(seed)
    words = [f"w{k}" for k in range(60)] + ["été", "ÀB", "the,", "<|endoftext|>", "日本"]
    shared = [" ".join(rng.choices(words, k=rng.randint(14, 40))) for _ in range(5)]
    rows = []
    for i in range(n):
        parts = [" ".join(rng.choices(words, k=rng.randint(0, 30))) for _ in range(rng.randint(1, 5))]
        for _ in range(rng.randint(0, 2)):
            parts.insert(rng.randint(0, len(parts)), rng.choice(shared))
        rows.append((i * 3, rng.choice([" ", "\n", " \t", "\r\n"]).join(parts)))
    rows += [(200, None), (201, ""), (202, " \n\t "), (203, "a " * 40), (204, "a " * 60), (205, rows[0][1]), (5, rows[1][1]), (5, rows[1][1]), (206, "x" * 3000), (207, "\x1c\x85\u3000 mixed\x0bspaces\x0cx"), (None, rows[2][1]), (None, "alone"), (208, "ab " * 20 + "\n" + "cd " * 20)]
    return rows


ROWS = passages()
EDGES = ["rows", "empty"]


def words_of(text):
    return (text or "").encode().split()


# 1


def test_sentencepiece_equals_library_in_one_piece_and_in_chunks(spark):
    library = sentencepiece.SentencePieceProcessor(model_file=tokens.model_path(sentencepiece_scan.MODEL))
    rows = ROWS + [(300, "qu" * 700), (301, "日本" * 300 + " é\t" * 200)]
    wanted = sorted((i is None, i or 0, library.encode(t or ""), t or "") for i, t in rows)
    for giant, chunk in ((1 << 16, 1 << 14), (400, 120)):
        encoded = sentencepiece_scan.encode(spark, frame(spark, rows), giant=giant, chunk=chunk)
        found = sentencepiece_scan.decode(spark, encoded.withColumn("kept_ids", F.col("ids"))).collect()
        assert sorted((r["doc_id"] is None, r["doc_id"] or 0, r["kept_ids"], r["decoded"]) for r in found) == wanted
        assert (max(r["n_chunks"] for r in found) > 1) == (giant == 400)
    assert sentencepiece_scan.encode(spark, frame(spark, [])).collect() == []


def test_sentencepiece_of_giant_texts_with_the_production_sizes(spark):
    library = sentencepiece.SentencePieceProcessor(model_file=tokens.model_path(sentencepiece_scan.MODEL))
    rng = random.Random(31)
    words = [f"word{k}" for k in range(300)] + ["été", "日本", "\n", "  "]
    rows = [(1, " ".join(rng.choices(words, k=40_000))), (2, "x" * 70_000), (3, "short"), (1, "ab\t" * 30_000), (None, None)]
    found = sentencepiece_scan.encode(spark, frame(spark, rows), decoded=True).collect()
    wanted = Counter((i, tuple(library.encode(t or "")), t or "") for i, t in rows)
    assert Counter((r["doc_id"], tuple(r["ids"]), r["decoded"]) for r in found) == wanted
    assert sorted(r["n_chunks"] > 1 for r in found) == [False, False, True, True, True]


def test_a_memory_forgets_when_its_bytes_are_used_up():
    from metrolith.llm import common, memory

    asked = []

    def make(texts):
        asked.extend(texts)
        return np.frombuffer("".join(texts).encode(), np.uint8), np.array([len(t) for t in texts])

    tool = memory.SpanMemory(make, np.uint8, most=20_000)
    hot = [f"hot--{k:09d}" for k in range(20)]
    for a in range(0, 3000, 100):
        spans = [f"span-{k:09d}" for k in range(a, a + 100)] + hot
        data = np.frombuffer("".join(spans).encode(), np.uint8)
        at = np.array([14 * k for k in range(len(spans))])
        one, two = (common.hash_spans(data, at, at + 14, second) for second in (False, True))
        pool, start, size = tool.find(one, two, lambda rows: memory.texts_of(data, at[rows], at[rows] + 14))
        assert [pool[s : s + n].tobytes().decode() for s, n in zip(start, size)] == spans and tool.held() <= 20_000 + 120 * 50
    assert len(set(asked)) == 3020 and asked.count(hot[0]) == 1


# 2


def test_token_files_round_trip(spark, tmp_path, monkeypatch):
    library = tokens.model().model
    path = str(tmp_path / "files")
    rng = random.Random(41)
    long = " ".join(rng.choices([f"word{k}" for k in range(500)], k=90_000))  # several blocks of ids
    rows = ROWS + [(150, long), (5, "other text of this id")]
    monkeypatch.setattr(token_files, "SHARD_BYTES", 200_000)
    token_files.write_tokens(spark, frame(spark, rows), path)
    assert spark.read.parquet(f"{path}/shards").count() > 2
    order = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))
    at, wanted = 0, Counter()
    starts = []
    for i, t in order:
        ids = library.encode(t or "", add_special_tokens=False).ids + [1]
        starts.append(at)
        wanted[(i, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids)))] += 1
        at += len(ids)
    found = token_files.read_documents(spark, path).collect()
    assert Counter((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in found) == wanted
    spans = sorted((r["start"], r["n_tokens"]) for r in found)
    assert [s for s, _ in spans] == [sum(n for _, n in spans[:k]) for k in range(len(spans))]
    last = max((r["start"] for r in found if r["doc_id"] is not None))
    assert all(r["start"] > last for r in found if r["doc_id"] is None)
    whole = sorted((r["start"], r["doc_id"], r["ids"]) for r in token_files.read_ids(spark, path).collect())
    by_id = {}
    for i, t in rows:
        by_id.setdefault(i, Counter())[tuple(library.encode(t or "", add_special_tokens=False).ids + [1])] += 1
    got = {}
    for _, i, ids in whole:
        got.setdefault(i, Counter())[tuple(ids)] += 1
    assert got == by_id and list(got) == sorted(by_id, key=lambda i: (i is None, i or 0))
    assert [s for s, _, _ in whole] == [sum(len(x) for _, _, x in whole[:k]) for k in range(len(whole))]
    assert max(len(ids) for _, _, ids in whole) > 2 * rans.BLOCK
    token_files.write_tokens(spark, frame(spark, []), path + "0")
    assert token_files.read_documents(spark, path + "0").collect() == []


def test_rans_blocks_are_independent_and_checked():
    rng = np.random.default_rng(3)
    ids = (rng.zipf(1.4, 200_000) % 3000).astype(np.uint32)
    table = rans.Table(rans.quantise(np.bincount(ids, minlength=3100)))
    assert table.frequency.sum() == 1 << rans.SCALE and ((table.frequency > 0) == (np.bincount(ids, minlength=3100) > 0)).all()
    blocks = [ids[a : a + rans.BLOCK] for a in range(0, len(ids), rans.BLOCK)] + [ids[:1], ids[:33]]
    coded = rans.encode(blocks, table)
    for k in (0, len(blocks) - 1, 2):
        assert (rans.decode([coded[k]], table)[0] == blocks[k]).all()
    assert all((a == b).all() for a, b in zip(rans.decode(coded, table), blocks))
    broken = bytearray(coded[0])
    broken[len(broken) // 2] ^= 1
    with pytest.raises(ValueError):
        rans.decode([bytes(broken)], table)
    parts = [b"", b"abc", b"x" * 1000, b"\0"]
    assert rans.crc32_join([(zlib.crc32(p), len(p)) for p in parts]) == zlib.crc32(b"".join(parts))


# 3


def removed_by_hand(rows, width=13):
    first = {}
    key = lambda i: math.inf if i is None else i
    for i, t in rows:
        w = words_of(t)
        for j in range(len(w) - width + 1):
            k = tuple(w[j : j + width])
            first[k] = min(first.get(k, math.inf), key(i))
    out = []
    for i, t in rows:
        w, gone = words_of(t), set()
        for j in range(len(w) - width + 1):
            if first[tuple(w[j : j + width])] < key(i):
                gone.update(range(j, j + width))
        out.append((i is None, i or 0, len(w), len(gone), b" ".join(x for k, x in enumerate(w) if k not in gone).decode()))
    return sorted(out)


@pytest.mark.parametrize("parts", [1, 7])
def test_substring_dedup_equals_brute_force(spark, monkeypatch, parts):
    monkeypatch.setattr(substring_dedup, "BATCH_BYTES", 2_000)
    monkeypatch.setattr(substring_dedup, "BUCKET_BYTES", 3_000)
    for rows in (ROWS, []):
        found = substring_dedup.remove_repeats(spark, frame(spark, rows, parts), carry=("batch", "kept")).collect()
        assert sorted((r["doc_id"] is None, r["doc_id"] or 0, r["n_words"], r["n_removed"], r["kept_text"]) for r in found) == removed_by_hand(rows)
        assert all(r["batch"] == 1 and r["kept"] for r in found)
    assert sum(x[3] for x in removed_by_hand(ROWS)) > 100


def test_equal_windows_choose_equal_symbols():
    rng = np.random.default_rng(5)
    letters = rng.integers(0, 2**63, 5).astype(np.uint64)
    for width in (3, 13):
        texts = [letters[rng.integers(0, rng.integers(1, 6), rng.integers(0, 70))] for _ in range(60)]
        offsets = np.concatenate(([0], np.cumsum([len(t) for t in texts])))
        hashes = np.concatenate(texts)
        w = recompress.windows(hashes, offsets, width)
        names = {}
        for s, n in zip(w.start, w.name):
            assert names.setdefault(tuple(hashes[s : s + width].tolist()), n) == n


# 4


def test_nearest_neighbours(spark):
    rng = np.random.default_rng(7)
    base = rng.standard_normal((6, 16))
    x = (base[rng.integers(0, 6, 900)] + 0.6 * rng.standard_normal((900, 16))).astype(np.float32)
    x[500:520] = x[0]
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    odd = [(1000, None), (1100, []), (1200, [0.0] * 16), (1300, [float("nan")] * 16), (1400, [1.0] * 15 + [None]), (1500, [float("inf")] + [0.0] * 15), (None, [1.0] * 16), (1600, [1.0] * 3)]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>").withColumn("shard", F.lit("clash"))
    found = multi_index.nearest(spark, df, F.col("vec_id") % 100 == 0, shard_rows=400, block_queries=4).collect()
    got = {}
    for r in sorted(found, key=lambda r: (r["query_id"], r["rank"])):
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    assert sorted(got) == list(range(0, 900, 100))
    hits = 0
    for q, rows_of in got.items():
        d = np.sqrt(((x.astype(float) - x[q].astype(float)) ** 2).sum(axis=1))
        d[q] = np.inf
        best = np.lexsort((np.arange(900), d))[:10]
        assert [r for r, _, _ in rows_of] == list(range(1, 11))
        assert all(abs(s - d[v]) < 1e-12 for _, v, s in rows_of)
        hits += len({v for _, v, _ in rows_of} & set(best.tolist()))
    assert hits >= 0.9 * 90
    assert [v for _, v, _ in got[0]] == list(range(500, 510))
    few = spark.createDataFrame(rows[:4], "vec_id long, embedding array<float>")
    assert multi_index.nearest(spark, few, F.col("vec_id") == 0).count() == 3
    assert multi_index.nearest(spark, few.where("false"), F.col("vec_id") == 0).collect() == []


def test_probing_meets_every_code_within_the_radius_and_few_others():
    rng = np.random.default_rng(3)
    x = rng.standard_normal((6000, 64))
    x /= np.linalg.norm(x, axis=1)[:, None]
    x[5000:] = x[:1000] + 0.05 * rng.standard_normal((1000, 64))
    model = multi_index.fit(x[:2000])
    codes = multi_index.encode(x, model)
    index = multi_index.Index(codes)
    hits, share = [], []
    for q in range(1000, 1100):
        met = set(index.meet(codes[q]).tolist())
        apart = np.bitwise_count(codes ^ codes[q])
        assert met == set(np.flatnonzero((apart <= multi_index.PROBE).any(axis=1)).tolist())
        assert met >= set(np.flatnonzero(apart.sum(axis=1) <= multi_index.PARTS * (multi_index.PROBE + 1) - 1).tolist())
        best = np.argsort(((x - x[q]) ** 2).sum(axis=1))[1:11]
        hits.append(len(met & set(best.tolist())))
        share.append(len(met) / len(x))
    assert np.mean(hits) > 9 and np.mean(share) < 0.2
    assert all(5000 + q in index.meet(codes[q]) for q in range(0, 1000, 50))
    assert len(index.meet(codes[0], 0, 6000)) == 6000


def test_a_repeated_query_is_asked_with_its_least_vector(spark):
    rows = [(0, [1.0, 0.0]), (0, [0.0, 1.0]), (1, [0.0, 2.0]), (2, [2.0, 0.5])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    found = multi_index.nearest(spark, table, F.col("vec_id") == 0).orderBy("rank").collect()
    assert [(r["vec_id"], r["score"]) for r in found] == [(1, 1.0), (2, pytest.approx(math.sqrt(4.25)))]


# 5


def judged_by_hand(url):
    if url is None or "://" not in url:
        return "", "", None, None
    rest = url.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host, path = rest[:cut], rest[cut:]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    path = path[: min([path.find(c) for c in "?#" if c in path], default=len(path))]
    fits = [(len(h + p), h + p, v) for v, h, p in url_rules.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return host, path, *(max(fits)[1:] if fits else (None, None))


def test_url_rules(spark):
    urls = ["http://A.Example.COM/en/x?q=/es/", "https://www.example.com/en/", "http://net/es/", "http://x.net/fr", "http://x.net/fr/#a", "https://com?x", "http://com/", "HTTP://ÀB.org/É", None, "", "no scheme", "://x.com/a", "a://b://c.com/d", "http://x.com#/en/", "http://notcom/", "http://bad-site.org/p/1", "http://bad-site.org/p/1"]
    urls += [f"http://{'casino' if i % 4 == 0 else 'shop'}.org/{'win' if i % 2 else 'buy'}/{i}" for i in range(80)]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").withColumn("has", F.lit(1)).withColumn("doc_id", F.lit(5))
    labels = spark.createDataFrame([(i, 0 if "casino" in (u or "") else 1, 0) for i, u in enumerate(urls) if i > 16] + [(None, 0, 0), (40, None, None)], "doc_id long, quality int, toxic int")
    found = {r["page_id"]: r for r in url_rules.filter_urls(spark, pages, labels, min_support=0.05, min_rows=5).collect()}
    assert len(found) == len(urls)
    for i, u in enumerate(urls):
        host, path, rule, verdict = judged_by_hand(u)
        r = found[i]
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule), u
        bad = u is not None and "casino" in u
        assert r["verdict"] == (verdict or ("block" if bad else "allow")), u
        assert (r["mined_rule"] is not None) == bad
    assert url_rules.filter_urls(spark, pages, labels.where("false")).where("mined_rule is not null").count() == 0
    assert url_rules.filter_urls(spark, pages.where("false"), labels).count() == 0


def mined_by_hand(has, bad, min_support, min_confidence, min_rows):
    """Rules by plain counting: leading tokens, items of the same bad urls, up to eight a url, up to four in a rule."""
    least = max(min_rows, math.ceil(min_support * len(has) - 1e-9))
    base = sum(bad) / len(bad)
    holders = {}
    for k, tokens_of in enumerate(has):
        for t in tokens_of:
            holders.setdefault(t, []).append(k)
    groups = {}
    for t, rows in holders.items():
        of_bad = frozenset(k for k in rows if bad[k])
        if len(of_bad) >= least and len(of_bad) / len(rows) > base:
            groups.setdefault(of_bad, []).append(t)
    items = {tuple(sorted(ts)): (max(len(rows) / len(holders[t]) for t in ts), rows) for rows, ts in groups.items()}
    baskets = []
    for k in range(len(has)):
        if bad[k]:
            mine = sorted((-share, -len(rows), "\x1f".join(i), i) for i, (share, rows) in items.items() if k in rows)
            baskets.append(frozenset(x[3] for x in mine[:8]))
    counts = Counter(combo for b in baskets for n in range(1, 5) for combo in map(frozenset, itertools.combinations(b, n)))
    rules = {}
    for combo, n in counts.items():
        tokens_of = frozenset(t for i in combo for t in i)
        rows = [b for h, b in zip(has, bad) if tokens_of <= h]
        if n >= least and sum(rows) / len(rows) >= min_confidence:
            rules[combo] = (tokens_of, sum(rows) / len(rows), len(rows))
    kept = {c: r for c, r in rules.items() if not any(d < c and q[1] >= r[1] for d, q in rules.items())}
    return {r[0]: (r[1], r[2]) for r in kept.values()}


def test_mined_rules_equal_counting_by_hand(spark):
    rng = random.Random(4)
    urls = [f"http://{rng.choice('ab')}.org/{rng.choice(['x', 'y', 'z'])}/{rng.choice(['p', 'q'])}" for _ in range(200)]
    urls += [f"http://one-{rng.choice('abcdef')}.{rng.choice('ab')}.net/{'/'.join(rng.sample('klmnopqrstuv', 10))}?id=1&s=2" for _ in range(100)]
    bad = [("/x/" in u and u.endswith("p")) or ("one-a" in u and "/k/" in u) or rng.random() < 0.1 for u in urls]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    labels = spark.createDataFrame([(i, 0 if b else 1, 0) for i, b in enumerate(bad)], "doc_id long, quality int, toxic int")
    has = [frozenset(r[0]) for r in pages.orderBy("page_id").select(url_rules.url_tokens(F.col("url"))).collect()]
    for options in ((0.03, 0.6, 5), (0.01, 0.5, 3)):
        found = url_rules.mine(pages, labels, *options).collect()
        wanted = mined_by_hand(has, bad, *options)
        assert {frozenset(r["tokens"]): r["rows"] for r in found} == {t: rows for t, (_, rows) in wanted.items()} and wanted
        assert {frozenset(r["tokens"]): r["confidence"] for r in found} == pytest.approx({t: share for t, (share, _) in wanted.items()})
        assert all(r["anchor"] in r["tokens"] for r in found)


def test_many_equal_and_many_long_urls_are_mined_at_once(spark):
    rng = random.Random(14)
    same = "http://spam.example/" + "/".join(f"s{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(60))
    urls = [same] * 1000 + [f"http://good.org/{'/'.join(rng.sample('abcdefghijklmnopqrstuvwxyz', 20))}" for _ in range(2000)]
    urls += [f"http://far.net/{'/'.join(x for x in same.split('/')[3:] if rng.random() < 0.9)}" for _ in range(300)]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    labels = spark.createDataFrame([(i, int(1000 <= i < 3000), 0) for i in range(len(urls))], "doc_id long, quality int, toxic int")
    found = url_rules.filter_urls(spark, pages, labels)
    verdicts = Counter((r["page_id"] // 1000 if r["page_id"] < 3000 else 3, r["verdict"]) for r in found.collect())
    assert verdicts == {(0, "block"): 1000, (1, "allow"): 1000, (2, "allow"): 1000, (3, "block"): 300}


# 6


def packed_by_hand(lengths, sizes, overhead):
    """The same rules, with lists only."""
    free, opened, content, out = [], [], [], []
    for k, n in enumerate(lengths):
        fits = [(r, b) for b, r in enumerate(free) if r >= n]
        if fits:
            b = min(fits)[1]
        else:
            options = []
            for size in sorted(s for s in sizes if s >= n):
                rest, filled = sorted(lengths[k + 1 :], reverse=True), n
                for m in rest:
                    if m and m <= size - filled:
                        filled += m
                options.append(((size + overhead) / max(filled, 1), size))
            b = len(free)
            free.append(min(options)[1])
            opened.append(free[-1])
            content.append(0)
        out.append((b, content[b]))
        content[b] += n
        free[b] -= n
    return out, [min(s for s in sizes if s >= c) for c in content]


def test_packing(spark):
    rng = random.Random(6)
    for _ in range(30):
        lengths = sorted((rng.randint(0, 40) for _ in range(rng.randint(0, 60))), reverse=True)
        bins, places, sizes = packing.pack(lengths, (10, 20, 40), 3)
        assert (list(zip(bins, places)), sizes) == packed_by_hand(lengths, (10, 20, 40), 3)
    rows = [(i, rng.randint(0, 300)) for i in range(300)] + [(1, 5), (1, 5), (None, 7), (9999, 10_000), (8888, None)]
    df = spark.createDataFrame(rows, "doc_id long, n_tokens long").withColumn("shard", F.lit("x"))
    found = packing.best_fit(spark, df, capacities=(64, 128, 256), shard_pieces=100).collect()
    assert sum(r["n_tokens"] for r in found) == sum(n or 0 for _, n in rows)
    assert Counter(r["doc_id"] for r in found if r["piece"] == 0) == Counter(i for i, _ in rows)
    for r in found:
        assert r["position"] + r["n_tokens"] <= r["capacity"] and r["start"] == 256 * r["piece"]
    of_bin = {}
    for r in found:
        of_bin.setdefault(r["bin"], []).append((r["position"], r["n_tokens"], r["capacity"]))
    for rows_of in of_bin.values():
        end = sum(n for _, n, _ in rows_of)
        assert {c for _, _, c in rows_of} == {min(s for s in (64, 128, 256) if s >= end)}
        spans = sorted((p, n) for p, n, _ in rows_of)
        assert all(p == sum(n for _, n in spans[:k]) for k, (p, _) in enumerate(spans))
    assert packing.best_fit(spark, df.where("false")).collect() == []
    lengths = {(r["doc_id"], r["n_tokens"]) for r in packing.token_lengths(spark, frame(spark, ROWS)).collect()}
    library = tokens.model().model
    assert lengths == {(i, len(library.encode(t or "", add_special_tokens=False).ids) + 1) for i, t in ROWS}


def test_equal_rows_are_dealt_to_all_shards(spark):
    equal = spark.range(30_000).selectExpr("7L as doc_id", "100L as n_tokens")
    found = packing.best_fit(spark, equal, shard_pieces=1_000)
    by_shard = found.groupBy(F.expr("bin >> 32").alias("shard")).count().collect()
    assert len(by_shard) == 30 and max(r["count"] for r in by_shard) < 1_300 and sum(r["count"] for r in by_shard) == 30_000
    assert found.select("bin", "position").distinct().count() == 30_000


# 7


def fingerprint_by_hand(text, k=3):
    w = (text or "").encode().lower().split()
    if not w:
        return 0
    h = [xxhash.xxh64_intdigest(b" ".join(w[i : i + k]), seed=42) for i in range(max(1, len(w) - k + 1))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_fingerprints():
    texts = [t.encode() if t is not None else None for _, t in ROWS] + [b"word " * 400, b"y" * 500 + b" a b"]
    for k in (2, 3, 5):
        found = simhash.fingerprints(pa.array(texts, pa.binary()), ((k, 1),))[:, 0]
        assert found.tolist() == [fingerprint_by_hand(t.decode() if t else "", k) for t in texts]


def test_near_duplicates_equal_brute_force(spark):
    rng = random.Random(8)
    rows = list(ROWS)
    long = [" ".join(rng.choices([f"v{k}" for k in range(400)], k=300)) for _ in range(6)]
    for n, text in enumerate(long):
        for c in range(6):
            w = text.split()
            for _ in range(c // 2):
                w[rng.randrange(len(w))] = "CHANGED"
            rows.append((500 + 10 * n + c, " ".join(w)))
    prints = [fingerprint_by_hand(t) for _, t in rows]
    label = list(range(len(rows)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if bin(prints[i] ^ prints[j]).count("1") <= 2:
                label[root(i)] = root(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[root(i)] = min(least.get(root(i), d), d)
    wanted = Counter((d, f"{p:016x}", least.get(root(i))) for i, ((d, _), p) in enumerate(zip(rows, prints)))
    found = vp_simhash.near_duplicates(spark, frame(spark, rows)).collect()
    assert Counter((r["doc_id"], r["fingerprint"], r["component_id"]) for r in found) == wanted
    assert len({r["component_id"] for r in found}) < len(rows) - 10
    assert vp_simhash.near_duplicates(spark, frame(spark, [])).collect() == []
    kept = vp_simhash.one_of_each(spark, frame(spark, rows), shingle=2, radius=3, tables=5, check=vp_simhash.Check()).collect()
    ids = [r["doc_id"] for r in kept]
    assert {500 + 10 * n for n in range(6)} <= set(ids) and not any(500 + 10 * n + 2 in ids for n in range(6)) and ids.count(5) <= 1


@pytest.mark.parametrize("radius", [0, 2, 5])
def test_vantage_point_tree_loses_no_link(radius):
    rng = np.random.default_rng(radius)
    base = rng.integers(0, 2**64, 3000, np.uint64)
    near = base[:800] ^ (np.uint64(1) << rng.integers(0, 64, 800).astype(np.uint64)) ^ (np.uint64(1) << rng.integers(0, 64, 800).astype(np.uint64))
    points = np.unique(np.concatenate((base, near)))
    i, j = (x[x0] for x in np.nonzero(np.bitwise_count(points[:, None] ^ points[None, :]) <= radius) for x0 in [slice(None)])
    i, j = i[i < j], j[i < j]
    assert (vp_simhash.link_points(points, radius) == vp_simhash._least(len(points), i, j)).all()
    tree = vp_simhash.build_tree(points[::3], 200, radius)
    homes = [set() for _ in points]
    for leaf, rows in vp_simhash.route(points, tree, radius):
        for r in rows:
            homes[r].add(leaf)
    assert all(homes) and all(homes[a] & homes[b] for a, b in zip(i, j))


# 8


def lines_by_hand(rows, run=3, long_bytes=32):
    """For (doc_id, text), null ids last: the numbers of the lines that go, by comparing lines themselves."""
    key = lambda r: (r[0] is None, r[0] or 0)
    first, gone = {}, []
    for i, t in sorted((r for r in rows if r[1] is not None), key=key):
        lines = t.split("\n")
        for j in range(len(lines)):
            for n in (1, run):
                if len(lines) - j >= n and (n > 1 or len(lines[j].encode()) >= long_bytes):
                    first.setdefault((n, *lines[j : j + n]), (key((i, t)), j))
    for i, t in rows:
        lines, out = (t or "").split("\n"), set()
        for j in range(len(lines)) if t is not None else ():
            for n in (1, run):
                if first.get((n, *lines[j : j + n]), ((True, math.inf),)) < (key((i, t)), j):
                    out.update(range(j, j + n))
        gone.append(out)
    return gone


def test_line_dedup_equals_brute_force_and_sql(spark):
    rng = random.Random(9)
    pool = [f"line {k} é" for k in range(14)] + ["", " ", "a longer line that is enough by itself é", "é" * 16]
    rows = [(i, "\n".join(rng.choices(pool, k=rng.randint(1, 25)))) for i in range(60)] + [(100, ""), (101, "a\n" * 30), (102, "\n".join(f"u{k}" for k in range(400)))]
    rows += [(103, rows[-1][1]), (104, "one line alone, long enough to go"), (105, "one line alone, long enough to go"), (106, "short twice"), (107, "short twice")]
    wanted = []
    for (i, t), gone in zip(rows, lines_by_hand(rows)):
        lines = t.split("\n")
        wanted.append((i, "\n".join(x for k, x in enumerate(lines) if k not in gone), len(lines), len(gone)))
    odd = [(200, None), (None, rows[0][1]), (7, rows[7][1])]
    found = line_winnow.remove_repeated_lines(spark, frame(spark, rows + odd))
    got = [(r["doc_id"], r["text"], r["n_lines"], r["n_removed"]) for r in found.collect()]
    assert sorted(x for x in got if x[0] not in (None, 200, 7)) == sorted(x for x in wanted if x[0] != 7)
    assert [x for x in got if x[0] == 7] == [x for x in wanted if x[0] == 7] * 2
    assert (200, None, 0, 0) in got and found.columns[0] == "doc_id" and "own" in found.columns
    assert (105, "", 1, 1) in got and (107, "short twice", 1, 0) in got
    assert line_winnow.remove_repeated_lines(spark, frame(spark, [])).collect() == []
    con = duckdb.connect()
    con.execute("create table documents (doc_id bigint, text varchar)")
    con.executemany("insert into documents values (?, ?)", rows)
    answer = con.execute(line_winnow.oracle_sql()).fetchall()
    assert sorted(answer) == sorted(wanted)


@pytest.mark.parametrize("run", [2, 3, 5])
def test_winnowing_selects_few_places_that_extension_completes(spark, run):
    rng = random.Random(12)
    passage = [f"p{k}" for k in range(60)]
    rows = [(i, "\n".join([f"own{i}-{k}" for k in range(rng.randint(0, 80))] + passage[rng.randint(0, 20) :] + [f"end{i}"])) for i in range(12)]
    picked = line_winnow.select_fingerprints(frame(spark, rows), run).collect()
    at, hashes = {}, {}
    for r in picked:
        at.setdefault(r["doc"], set()).add(r["at"])
        hashes.setdefault(r["fp"], set()).add((r["doc"], r["at"]))
    n_lines = {i: len(t.split("\n")) for i, t in rows}
    # every window holds a selected place, and they are about 2 / (run + 1) of all
    assert all(at[i] & set(range(j, j + run)) for i in at for j in range(n_lines[i] - run + 1))
    assert 1.5 / (run + 1) < len(picked) / sum(n_lines.values()) < 2.6 / (run + 1)
    wanted = dict(zip((i for i, _ in rows), lines_by_hand(rows, run)))
    found = {r["doc"]: {s["start"] + k for s in r["spans"] for k in range(s["n"])} for r in line_winnow.repeated_windows(spark, frame(spark, rows), run).collect()}
    assert found == {i: g for i, g in wanted.items() if g}
    # matched places alone, without extension, are not the repeated passages
    matched = {(i, a) for group in hashes.values() for i, a in group if (i, a) > min(group)}
    assert matched < {(i, a) for i, g in wanted.items() for a in g} and len(matched) < 0.9 * sum(map(len, wanted.values()))


# 9


def test_compression_classifier(spark):
    rng = random.Random(10)
    good = lambda: " ".join(rng.choice(["the", "river", "was", "calm", "and", "slow", "under", "bridges"]) for _ in range(60)) + "."
    junk = lambda: " ".join(rng.choice(["BUY", "###", "$$$", "CLICK!!", "win", "%%%"]) for _ in range(60))
    rows = [(i, good() if i % 3 else junk()) for i in range(400)]
    odd = [(900, None), (901, ""), (None, "x"), (5, rows[5][1]), (902, good() * 300)]
    labels = [(i, 1 if i % 3 else 0, 0) for i in range(400)]
    table = lambda rows: spark.createDataFrame(rows, "doc_id long, quality int, toxic int")
    found = zstd_quality.quality_scores(spark, frame(spark, rows + odd), table(labels)).collect()
    assert len(found) == len(rows) + len(odd) and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7) for r in found)
    held = [r for r in found if r["held_out"] and r["doc_id"] < 400]
    assert all(r["held_out"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in found)
    assert sum(r["predicted"] == int(r["doc_id"] % 3 > 0) for r in held) >= 0.97 * len(held)
    # labels of held-out rows are never learned from
    turned = [(i, 1 - q if zlib.crc32(str(i).encode()) % 4 == 2 else q, t) for i, q, t in labels]
    again = zstd_quality.quality_scores(spark, frame(spark, rows + odd), table(turned)).collect()
    assert Counter((r["doc_id"], r["score"]) for r in again) == Counter((r["doc_id"], r["score"]) for r in found)
    alone = zstd_quality.quality_scores(spark, frame(spark, rows[:3]), table([])).collect()
    assert [r["score"] for r in alone] == [0.5] * 3
    assert zstd_quality.quality_scores(spark, frame(spark, []), table(labels)).collect() == []
    # a doc_id with both labels is left out of the fit
    both = table(labels + [(i, 0 if i % 3 else 1, 0) for i in range(0, 400, 7)])
    without = table([x for x in labels if x[0] % 7])
    scores = [Counter((r["doc_id"], r["score"]) for r in zstd_quality.quality_scores(spark, frame(spark, rows), t).collect()) for t in (both, without)]
    assert scores[0] == scores[1]


def test_scores_equal_a_plain_reckoning(spark):
    """Dictionaries, block sizes, curve and odds by the docstring, without the operator's functions."""
    import zstandard

    rng = random.Random(17)
    vocabulary = {1: ["the", "river", "was", "calm", "and", "slow"], 0: ["BUY", "###", "win", "the", "and", "$"]}
    quality = {i: int(rng.random() < 0.8) for i in range(500)}
    rows = [(i, " ".join(rng.choice(vocabulary[q if rng.random() < 0.8 else 1 - q]) for _ in range(rng.randint(20, 900)))) for i, q in quality.items()]
    labels = spark.createDataFrame([(i, q, 0) for i, q in quality.items()], "doc_id long, quality int, toxic int")
    learned = [(i, t.encode()) for i, t in rows if zlib.crc32(str(i).encode()) % 4 != 2]
    learned.sort(key=lambda r: (zlib.crc32(str(r[0]).encode()), r[0]))
    sides = {q: [t for i, t in learned if quality[i] == q] for q in (0, 1)}

    def cut(t):
        return [t[a : a + 2048] for a in range(0, len(t), 2048)]

    made = {}
    for q in (0, 1):
        blocks = [b for t in sides[q][::2] for b in cut(t) if len(b) >= 8]
        raw = zstandard.train_dictionary(112_640, blocks, level=1, threads=0).as_bytes()
        made[q] = zstandard.ZstdCompressor(level=1, write_content_size=False, write_dict_id=False, dict_data=zstandard.ZstdCompressionDict(raw))
    size = lambda t, q: sum(len(made[q].compress(b)) for b in cut(t))

    def x(t):
        if not t:
            return [1.0, 0.0, 0.0]
        g, b = size(t, 1), size(t, 0)
        return [1.0, 20 * (b - g) / (b + g), 2 * min(g, b) / len(t) - 1]

    points = [(x(t), q) for q in (0, 1) for t in sides[q][1::2]]
    w = np.zeros(3)
    xs, ys = np.array([p[0] for p in points]), np.array([p[1] for p in points], float)
    for _ in range(200_000):  # plain gradient descent on the penalised log-likelihood
        step = xs.T @ (1 / (1 + np.exp(-xs @ w)) - ys) + w
        w -= 0.002 * step
        if np.abs(step).max() < 1e-9:
            break
    n = {q: len(sides[q]) for q in (0, 1)}
    w[0] += math.log(n[1] / n[0]) - math.log(ys.sum() / (len(ys) - ys.sum()))
    found = {r["doc_id"]: r["score"] for r in zstd_quality.quality_scores(spark, frame(spark, rows + [(900, None)]), labels).collect()}
    for i, t in rows + [(900, "")]:
        assert found[i] == pytest.approx(1 / (1 + math.exp(-float(np.dot(x(t.encode()), w)))), abs=1e-5)


def test_the_sample_size_does_not_move_the_odds():
    rng = random.Random(18)
    texts = {q: [" ".join(rng.choice(["a1", "b2", "c3"] if (q if rng.random() < 0.7 else 1 - q) else ["x9", "y8", "c3"]) for _ in range(40)).encode() for _ in range(600)] for q in (0, 1)}
    rows = [(2 * k + q, t, q) for q in (0, 1) for k, t in enumerate(texts[q])]
    even = zstd_quality.fit(rows, (1000, 9000))
    few = zstd_quality.fit([r for r in rows if r[2] == 1 or r[0] % 3 == 0], (1000, 9000))
    plain = zstd_quality.fit(rows)
    assert abs(even.weights[0] - plain.weights[0] - math.log(9)) < 1e-9
    mean = lambda m: np.mean([m.scorer().score(t)[0] for t in texts[1][:100]])
    assert abs(mean(even) - mean(few)) < 0.03


# 10


def plain_mix(x):
    x ^= x >> 33
    x = x * 0xFF51AFD7ED558CCD % 2**64
    x ^= x >> 33
    x = x * 0xC4CEB9FE1A85EC53 % 2**64
    return x ^ x >> 33


def plain_hash(word):
    """The hash of a word's bytes, one word and eight bytes after another."""
    factor, sizes = 0x9FB21C651E98DF25, 0xD6E8FEB86659FD93
    h = len(word) * sizes % 2**64
    for k in range(0, len(word), 8):
        h = (h ^ int.from_bytes(word[k : k + 8], "little")) * factor % 2**64
        h ^= h >> 29
    return plain_mix(xxhash.xxh64_intdigest(word, factor) if len(word) > 256 else h)


def plain_pair(a, b):
    return plain_mix((a * 0x9E3779B97F4A7C15 + plain_mix((b + 0x2545F4914F6CDD1D) % 2**64)) % 2**64)


def test_quality_rules_equal_brute_force(spark):
    trusted = spark.createDataFrame([(i,) for i in range(0, 60, 6)] + [(None,), (0,)], "doc_id long")
    buckets = 64
    found = ngram_llr.quality_rules(spark, frame(spark, ROWS), trusted, buckets=buckets, threshold=0.0)
    got = found.collect()
    wanted = Counter()
    grams = []
    for _, t in ROWS:
        h = [plain_hash(w) for w in words_of(t)]
        grams.append([plain_mix(x) % buckets for x in h] + [plain_pair(x, y) % buckets for x, y in zip(h, h[1:])])
    raw, target = Counter(), Counter()
    for (i, _), g in zip(ROWS, grams):
        raw.update(g)
        if i in range(0, 60, 6):
            target.update(g)
    n, m = sum(raw.values()), sum(target.values())
    ratio = {}
    for k in range(buckets):
        p = (raw[k] + 1) / (n + buckets)
        ratio[k] = math.log((target[k] + 4 * buckets * p) / (m + 4 * buckets)) - math.log(p)
    for (i, t), g in zip(ROWS, grams):
        text = t or ""
        w = words_of(t)
        runs = Counter(tuple(w[k : k + 5]) for k in range(len(w) - 4))
        twice = {j for k in range(len(w) - 4) if runs[tuple(w[k : k + 5])] > 1 for j in range(k, k + 5)}
        lines = [x for x in text.encode().split(b"\n") if x.split()]
        failed = len(w) < 10 or 100 * len(twice) > 20 * len(w)
        llr = sum(ratio[x] for x in g) / max(len(g), 1)
        wanted[(i, len(w), sum(len(x.decode()) for x in w), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(twice), failed, not failed and llr >= 0, round(llr, 9))] += 1
    assert Counter((*tuple(r)[:8], round(r["llr"], 9)) for r in got) == wanted
    assert {r["kept"] for r in got} == {True, False}
    kept = ngram_llr.keep_good(spark, frame(spark, ROWS), trusted, buckets=buckets, threshold=0.0)
    assert kept.columns == frame(spark, []).columns
    assert Counter(r["doc_id"] for r in kept.collect()) == Counter(r["doc_id"] for r in got if r["kept"])
    assert ngram_llr.quality_rules(spark, frame(spark, []), trusted).collect() == []
    none = ngram_llr.quality_rules(spark, frame(spark, ROWS), trusted.where("false")).collect()
    assert all(r["llr"] == 0 and r["kept"] != r["base_failed"] for r in none)


def test_kept_hash_of_the_query(spark):
    from metrolith.llm import queries

    found = queries.op3_recompression_dedup(spark, "/root/testdata/sf0.001")
    r = found.orderBy("doc_id").first()
    text = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").where(F.col("doc_id") == r["doc_id"]).first()["text"]
    assert r["n_removed"] > 0 or r["kept_sha256"] == hashlib.sha256(b" ".join(text.encode().split())).hexdigest()


def edited(rng, words, kind, similarity):
    """A copy with one replaced block, appended text or single words replaced, and its five-word Jaccard similarity."""
    grams = lambda w: {tuple(w[k : k + 5]) for k in range(len(w) - 4)}
    copy = list(words)
    new = lambda: f"new{rng.randrange(10**9)}"
    at = rng.randrange(20, len(words) // 2)
    places = rng.sample(range(len(words)), len(words))
    before = (words, 1.0)
    for step in range(len(words) // 2):
        if kind == "block":
            copy[at + step] = new()
        elif kind == "append":
            copy.append(new())
        else:
            copy[places[step]] = new()
        s = len(grams(words) & grams(copy)) / len(grams(words) | grams(copy))
        if s < similarity:
            return before
        before = (list(copy), s)
    return before


def test_checked_links_are_the_pairs_of_similarity_for_every_edit(spark):
    rng = random.Random(21)
    rows, wanted = [], {}
    for n in range(240):
        words = [f"w{rng.randrange(3000)}" for _ in range(rng.randint(100, 500))]
        kind, least = ("block", "append", "words")[n % 3], (0.74, 0.801, 0.82, 0.87)[n // 3 % 4]
        copy, s = edited(rng, words, kind, least)
        rows += [(2 * n, " ".join(words)), (2 * n + 1, " ".join(copy))]
        wanted[2 * n] = 2 * n
        wanted[2 * n + 1] = 2 * n + (s < 0.8)
    found = vp_simhash.near_duplicates(spark, frame(spark, rows), shingle=2, radius=3, tables=5, check=vp_simhash.Check())
    got = {r["doc_id"]: r["component_id"] for r in found.collect()}
    assert got == wanted and sum(i != c for i, c in got.items()) >= 150


def test_rows_that_share_a_doc_id_are_judged_by_their_own_texts(spark):
    text = [" ".join(f"{x}{k}" for k in range(60)) for x in "abc"]
    rows = [(3, text[2]), (5, text[0]), (5, text[1]), (5, text[1]), (5, text[2]), (6, text[0]), (7, text[1])]
    for options in ({}, {"shingle": 2, "radius": 3, "tables": 5, "check": vp_simhash.Check()}):
        kept = vp_simhash.one_of_each(spark, frame(spark, rows), **options).collect()
        assert sorted((r["doc_id"], r["text"]) for r in kept) == [(3, text[2]), (5, text[0]), (5, text[1])]


def test_the_target_counts_every_trusted_document(spark):
    docs = spark.range(21_000).selectExpr("id as doc_id", "concat('word', id % 50, ' other') as text")
    raw, target = ngram_llr.count_grams(docs, docs.select("doc_id"))
    assert raw.sum() == 3 * 21_000 and (raw == target).all()
