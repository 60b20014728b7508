"""Tolerant comparison of postal addresses, JVM-side."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from claimloom.functions.text import jaccard


def postal_code(c: Column) -> Column:
    """The first word of four or five digits (which may be a house number); null without one."""
    return F.nullif(F.regexp_extract(F.coalesce(c.cast("string"), F.lit("")), r"(?U)\b(\d{4,5})\b", 1), F.lit(""))


def place_tokens(c: Column) -> Column:
    s = F.regexp_replace(F.lower(F.coalesce(c.cast("string"), F.lit(""))), "[^a-zäöüß ]", " ")
    return F.array_distinct(F.filter(F.split(s, " +"), lambda t: F.length(t) >= 4))


def addresses_agree(a: Column, b: Column, least: float = 0.3) -> Column:
    """Equal postal codes where both have one; else enough common words."""
    pa, pb = postal_code(a), postal_code(b)
    return F.when(pa.isNotNull() & pb.isNotNull(), pa == pb).otherwise(jaccard(place_tokens(a), place_tokens(b)) >= least)
