"""Deterministic fractions of text keys, for sampling and splitting without random state."""

from __future__ import annotations

import hashlib

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def unit_fraction(key: Column) -> Column:
    """[0, 1) from the first 52 bits of the key's md5: native, and the same in any SQL engine."""
    return F.conv(F.substring(F.md5(key.cast("binary")), 1, 13), 16, 10).cast("long") / F.lit(float(1 << 52))


@F.pandas_udf(T.DoubleType())
def unit_fraction_blake2b(keys: pd.Series) -> pd.Series:
    """[0, 1) from an 8-byte blake2b digest, big-endian: assignments compatible with that convention."""
    return keys.map(lambda k: None if k is None else int.from_bytes(hashlib.blake2b(k.encode(), digest_size=8).digest(), "big") / 2.0**64)


FRACTIONS = {"md5": unit_fraction, "blake2b": unit_fraction_blake2b}
