"""Compressed blobs: xz, and checks of what is stored against what was recorded."""

from __future__ import annotations

import lzma

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from metrolith.session import ship_active


#: The dictionary of preset 6, and the least that xz takes.
_DICTIONARY, _LEAST = 8 << 20, 4096


def pack(data: bytes) -> bytes:
    """An xz stream as of preset 6; a dictionary larger than the data would only cost time."""
    chain = [{"id": lzma.FILTER_LZMA2, "preset": 6, "dict_size": min(_DICTIONARY, max(_LEAST, len(data)))}]
    return lzma.compress(data, format=lzma.FORMAT_XZ, check=lzma.CHECK_SHA256, filters=chain)


@F.pandas_udf(T.BinaryType())
def _packed(data: pd.Series) -> pd.Series:
    return data.map(lambda x: None if x is None else pack(bytes(x)))


@F.pandas_udf(T.BinaryType())
def _unpacked(data: pd.Series) -> pd.Series:
    def one(x):
        try:
            return None if x is None else lzma.decompress(bytes(x), format=lzma.FORMAT_XZ)
        except (lzma.LZMAError, EOFError):
            return None

    return data.map(one)


def xz(data: Column) -> Column:
    """Bytes as an xz stream with a SHA-256 check."""
    ship_active()
    return _packed(data)


def unxz(data: Column) -> Column:
    """What an xz stream holds; null where it is cut, changed or none."""
    ship_active()
    return _unpacked(data)


def blob_problems(recorded: DataFrame, stored: DataFrame) -> DataFrame:
    """(name, status) of recorded blobs: ok, missing, wrong size, does not unpack or wrong content.

    recorded: name, size (of the stored bytes), sha256 (hex, of the unpacked content); stored: name, blob.
    """
    held = stored.select(F.col("name").alias("_stored"), F.col("blob"), unxz(F.col("blob")).alias("_content"))
    both = recorded.join(held, F.col("name") == F.col("_stored"), "left")
    status = (
        F.when(F.col("blob").isNull(), "missing")
        .when(F.length("blob") != F.col("size"), "wrong size")
        .when(F.col("_content").isNull(), "does not unpack")
        .when(F.sha2("_content", 256) != F.col("sha256"), "wrong content")
        .otherwise("ok")
    )
    return both.select("name", status.alias("status"))
