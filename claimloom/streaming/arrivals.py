"""Streams of arriving records."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from claimloom.functions import url as U


def windowed_metrics(stream: DataFrame, time: str, key: str, value: str, size: str = "1 hour", slide: str | None = None, late: str = "2 hours") -> DataFrame:
    """``(key, start, n, total)`` for each window; rows later than ``late`` are dropped, state is bounded by it."""
    w = F.window(time, size, slide) if slide else F.window(time, size)
    x = stream.withWatermark(time, late).groupBy(key, w.alias("w")).agg(F.count(F.lit(1)).alias("n"), F.sum(value).alias("total"))
    return x.select(key, F.col("w.start").alias("start"), "n", "total")


def sessions(stream: DataFrame, time: str, key: str, gap: str = "30 minutes", late: str = "2 hours") -> DataFrame:
    x = stream.withWatermark(time, late).groupBy(key, F.session_window(time, gap).alias("w")).agg(F.count(F.lit(1)).alias("n"))
    return x.select(key, F.col("w.start").alias("start"), "n")


def new_addresses(stream: DataFrame, url: str, time: str, late: str = "7 days") -> DataFrame:
    """Trusted records with the first arrival of each normalised address within the watermark."""
    x = stream.where(~U.low_trust(F.col(url))).withColumn("url_key", U.norm_url(F.col(url)))
    return x.withWatermark(time, late).dropDuplicatesWithinWatermark(["url_key"])


def run_batches(stream: DataFrame, path: str, checkpoint: str, step: Callable[[DataFrame], DataFrame]) -> StreamingQuery:
    """Apply ``step`` to everything available, batch by batch, and write each batch to its own folder.

    A batch that is run again after a failure overwrites its folder, so the result holds every batch once.
    """

    def one(batch: DataFrame, n: int) -> None:
        step(batch).write.mode("overwrite").parquet(f"{path}/batch={n}")

    return stream.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
