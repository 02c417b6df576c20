"""IEEE binary16 cells: 16-bit patterns, ties to even, held at the largest finite value."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from metrolith.session import ship_active

LARGEST = 65_504.0


def half_bits(values: np.ndarray) -> np.ndarray:
    return np.minimum(np.asarray(values, np.float64), LARGEST).astype(np.float16).view(np.uint16).astype(np.int32)


def half_value(bits: np.ndarray) -> np.ndarray:
    return np.asarray(bits, np.uint16).view(np.float16).astype(np.float64)


def raise_to(bits: np.ndarray, least: np.ndarray) -> np.ndarray:
    """Patterns raised step by step until their value is at least ``least``."""
    bits = np.array(bits, np.int32)
    low = (half_value(bits) < least) & (bits < 0x7BFF)
    while low.any():
        bits[low] += 1
        low = (half_value(bits) < least) & (bits < 0x7BFF)
    return bits


@F.pandas_udf(T.IntegerType())
def _to_half(value: pd.Series) -> pd.Series:
    out = pd.Series(half_bits(value.fillna(0.0).to_numpy())).astype("Int32")
    return out.mask(value.isna().to_numpy())


@F.pandas_udf(T.DoubleType())
def _from_half(bits: pd.Series) -> pd.Series:
    return pd.Series(half_value(bits.fillna(0).to_numpy(np.int64))).mask(bits.isna().to_numpy())


def to_half(value: Column | str) -> Column:
    ship_active()
    return _to_half(value)


def from_half(bits: Column | str) -> Column:
    ship_active()
    return _from_half(bits)
