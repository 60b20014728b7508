"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimloom.session import materialize


def star_edges(df: DataFrame, id_col: str, key_col: str) -> DataFrame:
    """Edges ``(src, dst)`` that tie every row to the smallest id with the same key; null keys tie nothing.

    One edge a row, however many rows share the key; the minimum is pre-aggregated before its shuffle.
    """
    keyed = df.where(F.col(key_col).isNotNull() & F.col(id_col).isNotNull()).select(F.col(id_col).alias("src"), F.col(key_col).alias("_k"))
    hubs = keyed.groupBy("_k").agg(F.min("src").alias("dst"), F.count(F.lit(1)).alias("_n")).where("_n > 1")
    return keyed.join(hubs, "_k").where("src <> dst").select("src", "dst").distinct()


def _signature(edges: DataFrame) -> tuple:
    r = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("src", "dst"))).first()
    return r[0], r[1]


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``(node, component)`` for every node of ``edges(src, dst)``; component is the smallest node in reach.

    Self-loops and repeated edges are allowed, edges with a null end are ignored, an empty table gives an
    empty result.  Each round is two aggregations and joins on node ids; the number of rounds grows with the
    logarithm of the longest path.  Every round is a written table.
    """
    e = edges.where("src is not null and dst is not null and src <> dst").select(
        F.greatest("src", "dst").alias("src"), F.least("src", "dst").alias("dst")
    ).distinct()
    e = materialize(e, "cc")
    sig = _signature(e)
    for _ in range(max_rounds):
        if not sig[0]:
            break
        both = e.union(e.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
        low = both.groupBy("src").agg(F.min("dst").alias("m")).select("src", F.least("src", "m").alias("m"))
        large = both.where("dst > src").join(low, "src").select(F.col("dst").alias("src"), F.col("m").alias("dst")).where("src <> dst").distinct()
        low = large.groupBy("src").agg(F.min("dst").alias("m"))
        small = (
            large.join(low, "src")
            .select(F.explode(F.array(F.struct(F.col("dst").alias("src"), F.col("m").alias("dst")), F.struct("src", F.col("m").alias("dst")))).alias("x"))
            .select("x.*")
            .where("src <> dst")
            .distinct()
        )
        e = materialize(small, "cc")
        new = _signature(e)
        if new == sig:
            break
        sig = new
    else:
        raise RuntimeError(f"no fixed point within {max_rounds} rounds")
    return e.select(F.col("src").alias("node"), F.col("dst").alias("component")).union(
        e.select(F.col("dst").alias("node"), F.col("dst").alias("component")).distinct()
    )
