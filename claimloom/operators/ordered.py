"""Order-dependent operators as windows and ordered aggregates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_by_key(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], last: bool = False) -> DataFrame:
    """One whole row for every key, the first (or last) by ``order``.

    An ordered aggregate instead of a window: rows are reduced before the shuffle, so a key with a large share
    of the rows costs one row a task.  Rows whose keys are all null form one group.
    """
    o = F.struct(*order)
    row = F.struct(*df.columns)
    pick = F.max_by(row, o) if last else F.min_by(row, o)
    return df.groupBy(*keys).agg(pick.alias("_row")).select("_row.*")


def mark_duplicates(df: DataFrame, keys: Sequence[str], best_first: Sequence[Column], flag: str = "is_duplicate") -> DataFrame:
    """``df`` with a flag on all rows but the best of each key; rows with an empty key are never flagged.

    The best row's order is aggregated first and joined back, so no key is sorted in one task.  ``best_first``
    must order the rows of a key without ties (end it with an id).
    """
    o = F.struct(*[c.alias(f"o{i}") for i, c in enumerate(best_first)])
    x = df.withColumn("_o", o)
    empty = " and ".join(f"coalesce({k}, '') = ''" for k in keys)
    best = x.groupBy(*keys).agg(F.min("_o").alias("_best"))
    joined = x.join(best, [x[k].eqNullSafe(best[k]) for k in keys]).select(x["*"], best["_best"])
    return joined.withColumn(flag, F.when(F.expr(empty), False).otherwise(F.col("_o") != F.col("_best"))).drop("_o", "_best")


def numbered(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], name: str = "n") -> DataFrame:
    """Running number within each key."""
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))


def top_n(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], n: int) -> DataFrame:
    """The first ``n`` rows of each key; Spark limits groups before the shuffle."""
    return numbered(df, keys, order, "_n").where(F.col("_n") <= n).drop("_n")


def cumulative(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, name: str) -> DataFrame:
    """Running sum within each key."""
    w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn(name, F.sum(value).over(w))


def last_update_wins(target: DataFrame, updates: DataFrame, key: str, order: Sequence[str], fields: Sequence[str]) -> DataFrame:
    """``target`` with the fields of the last update of its key; nulls in an update become empty texts, keys
    without an update stay as they are, and updates without a row are dropped."""
    u = first_by_key(updates.where(F.col(key).isNotNull()), [key], order, last=True)
    u = u.select(F.col(key).alias("_k"), F.lit(True).alias("_hit"), *[F.coalesce(F.col(f).cast("string"), F.lit("")).alias(f"_u_{f}") for f in fields])
    j = target.join(u, target[key] == u["_k"], "left")
    return j.withColumns({f: F.when(F.col("_hit"), F.col(f"_u_{f}")).otherwise(F.col(f)) for f in fields}).select(*target.columns)
