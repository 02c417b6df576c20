"""Session factory and the shipping of this package to executors."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_SHIPPED = "_metrolith_shipped"


def build_session(app: str = "metrolith", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings that every operator here assumes: UTC, ANSI, AQE."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.ansi.enabled": "true",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    } | {k.replace("__", "."): v for k, v in conf.items()}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ship_package(spark: SparkSession) -> None:
    """Give the executors this package once per application, for plans that hold Python functions."""
    context = spark.sparkContext
    if getattr(context, _SHIPPED, False):
        return
    root = Path(__file__).resolve().parent
    archive = os.path.join(tempfile.mkdtemp(prefix="metrolith-"), "metrolith_pkg.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for path in sorted(root.rglob("*.py")):
            out.write(path, str(Path(root.name) / path.relative_to(root)))
    context.addPyFile(archive)
    setattr(context, _SHIPPED, True)


def ship_active() -> None:
    """``ship_package`` for the session in use, for column functions that are Python inside."""
    session = SparkSession.getActiveSession()
    if session is not None:
        ship_package(session)


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for checkpoints: the cluster's own setting; one is made only for a local master without it."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    if not named and context.getCheckpointDir() is None and not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="metrolith-checkpoint-"))
    return named or context.getCheckpointDir()


#: Paths given out and not dropped yet.
_GIVEN: list[str] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    path = f"{checkpoint_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    _GIVEN.append(path)
    return path


def drop_scratch(spark: SparkSession, mark: int, *keep: str) -> None:
    """Delete the scratch paths given out since ``mark`` (see ``scratch_mark``) but those to keep.

    Only for a job whose result is written: a DataFrame that still reads from such a path would lose its rows.
    """
    jvm = spark._jvm
    for path in [p for p in _GIVEN[mark:] if p not in keep]:
        place = jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
        _GIVEN.remove(path)


def scratch_mark() -> int:
    return len(_GIVEN)


def write_bytes(spark: SparkSession, path: str, data: bytes) -> None:
    """A small file in any store that Spark writes to, put in place in one step."""
    jvm = spark._jvm
    target, part = (jvm.org.apache.hadoop.fs.Path(p) for p in (path, f"{path}.part"))
    store = target.getFileSystem(spark._jsc.hadoopConfiguration())
    out = store.create(part, True)
    try:
        out.write(bytearray(data))
    finally:
        out.close()
    if store.exists(target):
        store.delete(target, False)
    if not store.rename(part, target):
        raise OSError(f"{path} was not put in place")
