"""Operators with Python in their plans work where the workers' folder does not hold the package."""

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

CODE = """
import sys
sys.path.insert(0, {root!r})
from pyspark.sql import functions as F
from metrolith.functions import blobs, geo
from metrolith.functions.half import from_half, to_half
from metrolith.operators import graph
from metrolith.session import build_session
spark = build_session("away", "local[2]", spark__checkpoint__dir={shared!r}, spark__sql__shuffle__partitions="2")
edges = spark.createDataFrame([(1, 2, 5, 5), (2, 1, 5, 5), (2, 3, 5, 5)], "src bigint, dst bigint, cost bigint, length bigint")
ask = spark.createDataFrame([(1, 1, 0, 0)], "origin bigint, node bigint, cost bigint, length bigint")
print(sorted(tuple(r)[1:3] for r in graph.shortest_paths(spark, edges, ask).collect()))
print(sorted(tuple(r) for r in graph.strong_components_of(spark, edges).collect()))
one = spark.range(1).select(F.lit(1.5).alias("v"), F.array(F.lit(1.0)).alias("a"), F.lit("x").cast("binary").alias("b"))
print(one.select(from_half(to_half("v")), geo.polyline_of("a", "a"), blobs.unxz(blobs.xz(F.col("b"))) == F.col("b")).first()[0::2])
"""


def test_from_another_folder(tmp_path):
    shared = tmp_path / "shared"
    shared.mkdir()
    code = CODE.format(root=ROOT, shared=str(shared))
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    said = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert said.stdout.split("\n")[:3] == ["[(1, 0), (2, 5), (3, 10)]", "[(1, 1), (2, 1), (3, 3)]", "(1.5, True)"], said.stderr[-2000:]


def test_a_cluster_without_a_shared_folder_is_refused():
    import pytest

    from metrolith import session

    class Context:
        master = "spark://somewhere:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            get = staticmethod(lambda key, other: other)

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.checkpoint_root(Session())
