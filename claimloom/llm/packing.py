"""Filling containers of fixed token capacity with whole documents.

Documents are measured once with a public tokenizer.  A plan is made from the histogram of lengths, whose size
is bounded by the capacity however large the corpus, and every document finds its place in the plan by its
rank among the documents of its length.  Items go in descending order to an open container with room: under
``policy="cost"`` to the one of lowest estimated cost (linear plus quadratic attention cost), under the default
``policy="fit"`` to the one with the least room left, cost deciding between equals.
"""

from __future__ import annotations

import os
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimloom.session import materialize

TOKENIZER = os.environ.get("CLAIMLOOM_TOKENIZER", "/opt/tokenizers/byte_bpe_50k.tiktoken")
#: Fixed value: the usual pattern that cuts text into pieces before byte-level BPE.
PIECES = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

_encoders: dict[str, object] = {}


def _encoder(path: str):
    if path not in _encoders:
        import base64

        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
        _encoders[path] = tiktoken.Encoding(os.path.basename(path), pat_str=PIECES, mergeable_ranks=ranks, special_tokens={})
    return _encoders[path]


def count_tokens(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: str = TOKENIZER) -> DataFrame:
    """``(doc_id, n_tokens)`` of every row; null and empty texts have no tokens, special tokens are plain text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = _encoder(tokenizer)
        for b in batches:
            n = [len(enc.encode_ordinary(t)) if t else 0 for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64())], names=["doc_id", "n_tokens"])

    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, "doc_id bigint, n_tokens bigint")


def cost(n, linear: float, quadratic: float):
    """Estimated cost of attending over ``n`` tokens."""
    return linear * n + quadratic * n * n


def plan(histogram: dict[int, int], capacity: int, policy: str = "fit", linear: float = 1.0, quadratic: float = 1 / 4096) -> tuple[list[tuple[int, int, int, int]], int]:
    """Runs ``(length, first rank, first container, items a container)`` and the number of containers.

    ``histogram`` counts items by length, none above ``capacity``.  Containers with equal content are handled
    together as a range of numbers, so the work grows with the number of lengths and not of items.
    """
    runs: list[tuple[int, int, int, int]] = []
    opened = 0
    if policy == "fit":
        order = lambda room, c, first: (room, c, first)
    elif policy == "cost":
        order = lambda room, c, first: (c, room, first)
    else:
        raise ValueError(f"no policy {policy!r}")
    ranges: list[tuple[tuple, int, float, int, int]] = []  # (order, room, cost, first container, containers)

    def put(room: int, c: float, first: int, many: int) -> None:
        if room > 0 and many > 0:
            insort(ranges, (order(room, c, first), room, c, first, many))

    if policy == "cost":
        opened = -(-sum(x * k for x, k in histogram.items()) // capacity)
        put(capacity, 0.0, 0, opened)
    for x in sorted((x for x in histogram if x > 0), reverse=True):
        left, rank = histogram[x], 0
        if x > capacity:
            raise ValueError("an item exceeds the capacity")
        one = cost(x, linear, quadratic)
        while left:
            if policy == "fit":
                at = bisect_left(ranges, ((x, float("-inf"), -1),))
            else:
                at = next((i for i, r in enumerate(ranges) if r[1] >= x), len(ranges))
            if at < len(ranges):
                _, room, c, first, many = ranges.pop(at)
            else:
                room, c, first = capacity, 0.0, opened
                many = left if policy == "cost" else -(-left // (capacity // x))
                opened += many
            # the tightest container stays the tightest until it is full; the cheapest takes one item at a time
            each = room // x if policy == "fit" else 1
            full, rest = divmod(left, each)
            if full >= many:
                full, rest = many, 0
            if full:
                runs.append((x, rank, first, each))
                put(room - each * x, c + each * one, first, full)
                rank += full * each
                left -= full * each
            if rest and full < many:
                runs.append((x, rank, first + full, rest))
                put(room - rest * x, c + rest * one, first + full, 1)
                rank += rest
                left -= rest
                full += 1
            put(room, c, first + full, many - full)
    return runs, opened


def assign(lengths: DataFrame, kinds: DataFrame, policy: str = "fit", slot_rows: int = 100_000) -> DataFrame:
    """``(kind, container, doc_id, part_no, start_token, n_tokens)`` for every document and kind of container.

    A text that fits into one container is never split; a longer one gives full parts of their own and one
    last part that is packed as an item.  Documents without tokens take no room and lie in some container.
    Every row is packed by itself, also where ids repeat or are null: containers of full parts are named by a
    number of the row.  Kinds without a positive capacity are left out; an empty table of documents gives an
    empty result.  Rows are ranked within slots of about ``slot_rows`` rows, however many share a length.
    """
    spark = lengths.sparkSession
    caps = {r["kind"]: int(r["cap"]) for r in kinds.where("capacity_tokens > 0 and kind is not null").groupBy("kind").agg(F.max("capacity_tokens").alias("cap")).collect()}
    if not caps:
        return spark.createDataFrame([], "kind string, container string, doc_id bigint, part_no bigint, start_token bigint, n_tokens bigint")
    # the number of a row is written with it, so it stays the same for all that reads it
    docs = materialize(lengths.select("doc_id", "n_tokens", F.monotonically_increasing_id().alias("row")), "lengths")
    docs = docs.withColumn("slot", F.pmod(F.col("row"), F.lit(1 + docs.count() // slot_rows)))
    each = docs.select("row", "doc_id", "n_tokens", "slot", F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), F.lit(c).cast("bigint").alias("cap")) for k, c in sorted(caps.items())])).alias("k")).select("row", "doc_id", "n_tokens", "slot", "k.*")
    whole = F.col("n_tokens") <= F.col("cap")
    items = each.select("kind", "cap", "row", "doc_id", "slot", "n_tokens", F.when(whole, F.col("n_tokens")).otherwise(F.col("n_tokens") % F.col("cap")).alias("len"))
    items = items.where("len > 0 or n_tokens = 0")
    # rank among the items of one length: within a slot of rows, plus the counts of the slots before;
    # a length that a third of all documents share is still spread over all slots
    counts = materialize(items.groupBy("kind", "len", "slot").agg(F.count(F.lit(1)).alias("n")), "counts")
    histogram: dict[str, dict[int, int]] = {k: {} for k in caps}
    for r in counts.where("len > 0").groupBy("kind", "len").agg(F.sum("n").alias("n")).collect():
        histogram[r["kind"]][r["len"]] = r["n"]
    plans = {k: plan(h, caps[k], policy) for k, h in histogram.items()}
    before = Window.partitionBy("kind", "len").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("kind", "len", "slot", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    inside = Window.partitionBy("kind", "len", "slot").orderBy("row")
    ranked = items.withColumn("r", F.row_number().over(inside)).join(offsets, ["kind", "len", "slot"])
    ranked = ranked.select("kind", "cap", "doc_id", "n_tokens", "len", (F.col("offset") + F.col("r") - 1).alias("rank"))
    tables = {}
    for k, (runs, n) in plans.items():
        a = np.array(sorted(runs), dtype=np.int64).reshape(-1, 4)
        tables[k] = (a, n)
    sent = spark.sparkContext.broadcast(tables)  # bounded by the capacities

    def place(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        index = {}
        for k, (a, n) in sent.value.items():
            keys = a[:, 0] << 44 | a[:, 1]
            index[k] = (a, keys, n)
        for f in frames:
            got = np.zeros(len(f), dtype=np.int64)
            for k in f["kind"].unique():
                a, keys, n = index[k]
                here = (f["kind"] == k).to_numpy()
                x, rank = f["len"].to_numpy()[here], f["rank"].to_numpy()[here]
                c = rank % max(n, 1)
                full = x > 0
                if full.any():
                    at = np.searchsorted(keys, x[full] << 44 | rank[full], side="right") - 1
                    c[full] = a[at, 2] + (rank[full] - a[at, 1]) // a[at, 3]
                got[here] = c
            yield pd.DataFrame({"kind": f["kind"], "cap": f["cap"], "doc_id": f["doc_id"], "n_tokens": f["n_tokens"], "len": f["len"], "c": got})

    placed = ranked.mapInPandas(place, "kind string, cap bigint, doc_id bigint, n_tokens bigint, len bigint, c bigint")
    last = placed.select(
        "kind",
        F.concat_ws("-", "kind", F.col("c").cast("string")).alias("container"),
        "doc_id",
        F.when(F.col("n_tokens") > F.col("cap"), F.floor(F.col("n_tokens") / F.col("cap"))).otherwise(0).cast("bigint").alias("part_no"),
        (F.col("n_tokens") - F.col("len")).alias("start_token"),
        F.col("len").alias("n_tokens"),
    )
    parts = each.where(~whole).select("kind", "cap", "row", "doc_id", F.explode(F.sequence(F.lit(0), F.floor(F.col("n_tokens") / F.col("cap")) - 1)).alias("part_no"))
    own: Column = F.concat_ws("-", "kind", F.lit("row"), F.col("row").cast("string"), F.col("part_no").cast("string"))
    full = parts.select("kind", own.alias("container"), "doc_id", F.col("part_no").cast("bigint").alias("part_no"), (F.col("part_no") * F.col("cap")).cast("bigint").alias("start_token"), F.col("cap").alias("n_tokens"))
    return last.unionByName(full)


def container_report(assignment: DataFrame, kinds: DataFrame, linear: float = 1.0, quadratic: float = 1 / 4096) -> DataFrame:
    """``(kind, containers, used_tokens, unused_tokens, unused_share, mean_cost, max_cost)``, one row a kind."""
    caps = kinds.groupBy("kind").agg(F.max("capacity_tokens").alias("cap"))
    n = F.col("n_tokens")
    per = assignment.groupBy("kind", "container").agg(F.sum(n).alias("used"), F.sum(cost(n, linear, quadratic)).alias("cost"))
    return per.join(caps, "kind").groupBy("kind").agg(
        F.count(F.lit(1)).alias("containers"),
        F.sum("used").alias("used_tokens"),
        F.sum(F.col("cap") - F.col("used")).alias("unused_tokens"),
        (F.sum(F.col("cap") - F.col("used")) / F.sum("cap")).alias("unused_share"),
        F.avg("cost").alias("mean_cost"),
        F.max("cost").alias("max_cost"),
    )
