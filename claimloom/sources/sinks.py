"""Sinks: files, append logs, and batched writes to a record store with retries."""

from __future__ import annotations

import datetime
import json
import subprocess
import time
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class TransientError(Exception):
    """A failure worth another try: connection, timeout, too many requests, server errors."""


def with_retry(call: Callable[[], object], tries: int = 3, pause: float = 0.5, sleep: Callable[[float], None] = time.sleep) -> object:
    """``call`` with up to ``tries`` more tries on TransientError, the pause doubling; other errors pass at once."""
    for i in range(tries + 1):
        try:
            return call()
        except TransientError:
            if i == tries:
                raise
            sleep(pause * 2**i)
    return None


def write_batches(df: DataFrame, send: Callable[[list[dict]], None], size: int = 10, pause: float = 0.0, loud: bool = True) -> int:
    """Send every row to a store in batches of ``size`` from the executors; the number of rows that failed.

    ``send`` must be idempotent (keyed): a lost task is run again.  A batch that fails for good is counted and
    the rest goes on; in the end a count above zero is an error unless ``loud`` is false.
    """
    failed = df.sparkSession.sparkContext.accumulator(0)

    def part(rows: Iterator) -> None:
        batch: list[dict] = []

        def flush() -> None:
            if batch:
                try:
                    with_retry(lambda: send(list(batch)))
                except Exception:
                    failed.add(len(batch))
                batch.clear()
                if pause:
                    time.sleep(pause)

        for r in rows:
            batch.append(r.asDict(recursive=True))
            if len(batch) == size:
                flush()
        flush()

    df.foreachPartition(part)
    if loud and failed.value:
        raise RuntimeError(f"{failed.value} rows were not written")
    return failed.value


def write_csv(df: DataFrame, path: str, columns: list[str]) -> None:
    """Fixed columns in fixed order; missing ones are empty."""
    have = set(df.columns)
    df.select(*[F.col(c) if c in have else F.lit("").alias(c) for c in columns]).write.mode("overwrite").option("header", True).csv(path)


def append_log(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def run_id(now: datetime.datetime, rule_version: str) -> str:
    return f"{now:%Y%m%d-%H%M}-{rule_version}"


def revision(folder: str = ".") -> str:
    """Short revision of the code, or the empty text outside a repository."""
    try:
        return subprocess.run(["git", "-C", folder, "rev-parse", "--short", "HEAD"], capture_output=True, text=True, timeout=10).stdout.strip()
    except (OSError, subprocess.TimeoutExpired):
        return ""


def stamped(df: DataFrame, run: str, rule_version: str) -> DataFrame:
    return df.withColumns({"run_id": F.lit(run), "rule_version": F.lit(rule_version)})


def snapshot(df: DataFrame, path: str, run: str, rule_version: str, suffix: str) -> None:
    """The records before a run as JSON lines beside a small header file's worth of columns."""
    stamped(df, run, rule_version).withColumn("suffix", F.lit(suffix)).write.mode("overwrite").json(path)


def run_summary(run: str, rule_version: str, records: int, recall: float | None = None, precision: float | None = None, yield_: float | None = None, note: str = "") -> str:
    return json.dumps({"run_id": run, "rule_version": rule_version, "revision": revision(), "records": records, "recall": recall, "precision": precision, "yield": yield_, "note": note})
