"""Quality gates of a batch.  The denominators differ from gate to gate on purpose."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _at_least_one(c: Column) -> Column:
    return F.greatest(F.lit(1), c)


def crawl_gate(stats: DataFrame, least_yield: float = 0.3, least_direct: float = 0.4, least_score: float = 2.0) -> DataFrame:
    """``stats(kept, rejected, direct, mean_score)`` with yield, direct share, breaches and stop (two breaches)."""
    y = F.col("kept") / _at_least_one(F.col("kept") + F.col("rejected"))
    d = F.least(F.lit(1.0), F.col("direct") / _at_least_one(F.col("kept")))
    s = F.coalesce("mean_score", F.lit(0.0))
    n = (y < least_yield).cast("int") + (d < least_direct).cast("int") + (s < least_score).cast("int")
    return stats.select("*", y.alias("yield"), d.alias("direct_share"), n.alias("breaches"), (n >= 2).alias("stop"))


def image_gate(stats: DataFrame) -> DataFrame:
    """``stats(found, new, junk, mean_score)`` with yield, cheap share and the number of warnings."""
    y = F.col("new") / _at_least_one(F.col("found"))
    j = F.col("junk") / _at_least_one(F.col("found"))
    some = F.col("found") > 0
    n = (some & (y < 0.3)).cast("int") + (some & (j >= 0.7)).cast("int") + F.coalesce((F.col("mean_score") < 2).cast("int"), F.lit(0))
    return stats.select("*", y.alias("yield"), j.alias("cheap_share"), n.alias("warnings"))


def text_gate(stats: DataFrame) -> DataFrame:
    """``stats(found, new, strong, score_sum)`` with yield, strong share, mean score and stop."""
    new, found = _at_least_one(F.col("new")), _at_least_one(F.col("found"))
    y, s, m = F.col("new") / found, F.col("strong") / new, F.col("score_sum") / new
    n = (y < 0.3).cast("int") + (s < 0.4).cast("int") + (m < 2).cast("int")
    return stats.select("*", y.alias("yield"), s.alias("strong_share"), m.alias("source_score"), (n >= 2).alias("stop"))


def discovery_gate(stats: DataFrame) -> DataFrame:
    """``stats(new, known, candidates, rejected)`` with yield, pass share and the number of warnings."""
    y = F.col("new") / _at_least_one(F.col("new") + F.col("known"))
    p = (F.col("candidates") - F.col("rejected")) / _at_least_one(F.col("candidates"))
    return stats.select("*", y.alias("yield"), p.alias("pass_share"), ((y < 0.3).cast("int") + (p < 0.4).cast("int")).alias("warnings"))
