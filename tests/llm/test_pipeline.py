"""The corpus pipeline, stage by stage, and the entry point with and without the subpackage."""

import os
import shutil
import subprocess
import sys
from collections import Counter

from pyspark.sql import functions as F

import corpus_pipeline
from metrolith.llm import ngram_llr, tokens, vp_simhash

from .test_operators import lines_by_hand, removed_by_hand

SF = "/root/testdata/sf0.001"
ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    wanted = docs.columns
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path / name)
        stage(spark, docs, SF).write.parquet(path)
        before, docs = docs, spark.read.parquet(path)
        seen[name] = (before, docs)
        if name != "best_fit_packing":
            assert docs.columns == wanted
            assert docs.where("n_chars <> length(text)").count() == 0
    before, after = seen["quality_rules"]
    trusted = spark.read.parquet(f"{SF}/labels.parquet").where("quality = 1")
    kept = {r["doc_id"] for r in ngram_llr.quality_rules(spark, before, trusted).where("kept").collect()}
    assert {r["doc_id"] for r in after.collect()} == kept

    before, after = seen["line_dedup"]
    by_hand = {}
    rows = [(r["doc_id"], r["text"]) for r in before.collect()]
    for (i, t), gone in zip(rows, lines_by_hand(rows)):
        lines = t.split("\n")
        if len(gone) < len(lines):
            by_hand[i] = "\n".join(x for k, x in enumerate(lines) if k not in gone)
    assert {r["doc_id"]: r["text"] for r in after.collect()} == by_hand

    before, after = seen["near_dedup"]
    groups = vp_simhash.near_duplicates(spark, before, **corpus_pipeline.NEAR).collect()
    assert sorted(r["doc_id"] for r in after.collect()) == sorted({r["component_id"] for r in groups})
    texts = {r["doc_id"]: r["text"] for r in before.collect()}
    shingles = {i: Counter(tuple(w[k : k + 5]) for w in [t.lower().split()] for k in range(max(1, len(w) - 4))) for i, t in texts.items()}
    group = {r["doc_id"]: r["component_id"] for r in groups}
    for a in texts:
        for b in texts:
            if a < b and shingles[a].keys() and len(shingles[a].keys() & shingles[b].keys()) >= 0.9 * len(shingles[a].keys() | shingles[b].keys()):
                assert group[a] == group[b]

    before, after = seen["substring_dedup"]
    rows = [(r["doc_id"], r["text"]) for r in before.collect()]
    left = {r["doc_id"]: r["text"] for r in after.collect()}
    for _, i, n, gone, text in removed_by_hand(rows):
        if gone and gone == n:
            assert i not in left
        else:
            assert left[i] == (text if gone else dict(rows)[i])

    before, after = seen["best_fit_packing"]
    library = tokens.model().model
    sizes = {r["doc_id"]: len(library.encode(r["text"], add_special_tokens=False).ids) + 1 for r in before.collect()}
    packed = {r["doc_id"]: r["n"] for r in after.groupBy("doc_id").agg(F.sum("n_tokens").alias("n")).collect()}
    assert packed == sizes
    assert corpus_pipeline.run(spark, SF).count() == after.count()


EXTRA = ("n_words", "n_removed", "n_lines", "kept_text", "leader", "row", "copy", "document", "tie", "batch")


def odd_documents(spark):
    """Nulls in any column, empty and very long texts, repeated rows, shared doc_ids, and names that operators use."""
    prose = [" ".join(f"{a}{k}{a}" for k in range(n, n + 80)) for n, a in enumerate("abcdefgh")]
    long = "\n".join(" ".join(f"x{(k * 7919 + j) % 100_003}" for j in range(100)) for k in range(15_000))  # some 10 MB
    rows = [(1, prose[0]), (2, prose[1]), (2, prose[1]), (3, prose[2]), (3, prose[3]), (4, prose[0] + " more"), (5, None), (6, ""), (7, " \n\t\n"), (None, prose[4]), (None, prose[4] + " more"), (8, long), (9, prose[5] + "\n" + prose[6]), (10, prose[7] + "\n" + prose[6])]
    schema = "doc_id long, text string, n_chars long, " + ", ".join(f"{c} string" for c in EXTRA)
    return spark.createDataFrame([(i, t, None if t is None else len(t), *(None if i == 1 and c == "leader" else "keep" for c in EXTRA)) for i, t in rows], schema).repartition(3)


def test_every_stage_on_odd_documents(spark, tmp_path):
    docs = odd_documents(spark)
    docs.write.parquet(str(tmp_path / "in"))
    docs = spark.read.parquet(str(tmp_path / "in"))
    texts = Counter((r["doc_id"], r["text"]) for r in docs.collect())
    got = {}
    for name, stage in corpus_pipeline.STAGES:
        none = stage(spark, docs.where("false"), SF)
        assert none.collect() == []
        if name == "best_fit_packing":
            continue
        assert none.columns == docs.columns
        stage(spark, docs, SF).write.parquet(str(tmp_path / name))
        found = spark.read.parquet(str(tmp_path / name))
        assert found.dtypes == docs.dtypes
        rows = found.collect()
        assert all(r[c] == "keep" or (r["doc_id"] == 1 and c == "leader" and r[c] is None) for r in rows for c in EXTRA)
        assert all(r["n_chars"] == (None if r["text"] is None else len(r["text"])) for r in rows)
        got[name] = Counter((r["doc_id"], r["text"]) for r in rows)
    first, long = {t[:10]: t for _, t in texts if t}, next(t for i, t in texts if i == 8)
    # no trusted text is like these: only documents without ten words have to go
    assert set(got["quality_rules"]) <= {(i, t) for i, t in texts if t and len(t.split()) >= 10}
    lines = got["line_dedup"]
    assert lines[5, None] == 1 and lines[6, ""] == 1 and lines[8, long] == 1
    assert lines[2, first["b1b b2b b3"]] == 2 and sum(n for (i, _), n in lines.items() if i == 3) == 2
    assert [t.count("\n") for i, t in lines if i == 10] == [0]  # its second line is that of document 9
    near = got["near_dedup"]
    assert sorted((i is None, i or 0) for i, _ in near.elements()) == [(False, 1), (False, 2), (False, 3), (False, 3), (False, 5), (False, 8), (False, 9), (False, 10), (True, 0)]
    by_hand = {}
    for _, i, n, gone, text in removed_by_hand(list(texts.elements())):
        by_hand.setdefault(i, []).append((n, gone, text))
    kept = Counter()
    for i, t in got["substring_dedup"].elements():
        kept[i] += 1
        assert any((t or "").split() == text.split() for _, _, text in by_hand[i or 0])
    assert kept == Counter(i for i, t in texts.elements()) - Counter({i: 1 for i, _ in texts for n, gone, _ in by_hand.get(i or 0, []) if i is not None and gone and gone == n})
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF).groupBy("doc_id").agg(F.sum("n_tokens").alias("n"), F.count_if(F.col("piece") == 0).alias("rows"))
    assert {r["doc_id"]: r["rows"] for r in packed.collect()} == {i: n for i, n in Counter(i for i, _ in texts.elements()).items()}


def test_entry_point_without_the_subpackage(tmp_path):
    shutil.copytree(ROOT, tmp_path / "copy", ignore=shutil.ignore_patterns(".git", "__pycache__", "llm", "corpus_pipeline.py", ".pytest_cache"))
    code = "import __spark_entry__ as e; print(len(e.queries()), any(k.startswith('op') for k in e.queries()), set(e.oracle_sql()) <= set(e.queries()))"
    said = subprocess.run([sys.executable, "-c", code], cwd=tmp_path / "copy", capture_output=True, text=True, env={**os.environ, "PYTHONPATH": ""})
    assert said.stdout.split()[1:] == ["False", "True"], said.stderr


def test_the_entry_point_does_not_hide_other_missing_modules():
    code = "import sys; sys.modules['zstandard'] = None; import __spark_entry__"
    said = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True)
    assert said.returncode != 0 and "zstandard" in said.stderr
