"""Similarities that need more than an expression, and bit distances."""

from __future__ import annotations

from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType


@F.pandas_udf(DoubleType())  # a type name would need a session at import
def matching_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """Ratcliff-Obershelp ratio.  It is not symmetric: keep the order of the arguments.  Null counts as empty."""
    return pd.Series([SequenceMatcher(None, x or "", y or "").ratio() for x, y in zip(a, b)], dtype="float64")


def hash_bits(c: Column) -> Column:
    """A hash of 16 hexadecimal digits as bigint, null for anything else."""
    h = F.lower(F.trim(c))
    hi, lo = (F.conv(F.substring(h, i, 8), 16, 10).cast("bigint") for i in (1, 9))
    return F.when(h.rlike("^[0-9a-f]{16}$"), F.shiftleft(hi, 32).bitwiseOR(lo))


def hamming(a: Column, b: Column) -> Column:
    """Bits in which two hexadecimal hashes of 16 digits differ; null if either is none."""
    return F.bit_count(hash_bits(a).bitwiseXOR(hash_bits(b)))
