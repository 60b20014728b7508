"""The history of the batch deduplicator: several processes, interrupted appends, crowded keys, rewriting."""

import os
import random
import subprocess
import sys

import pytest

from claimloom.llm.incremental import BatchDeduplicator, BitIndex, content_hash, repeated_pictures
from tests.llm.test_problems import brute_repeats, reviews

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
PROCESS = """
import sys
sys.path.insert(0, {root!r})
from pyspark.sql import functions as F
from claimloom.llm.incremental import BatchDeduplicator, content_hash
from claimloom.session import get_session
spark = get_session("other", cores="2", shuffle_partitions="2", driver_memory="1g", **{{"spark.sql.warehouse.dir": {path!r} + "-warehouse"}})
spark.sparkContext.setLogLevel("ERROR")
rows = spark.createDataFrame({rows!r}, "id bigint, content string, h bigint").withColumn("content", content_hash(F.col("content")))
print("GOT", sorted(tuple(r) for r in BatchDeduplicator(spark, {path!r}, buckets=2).process(rows).collect()))
"""


def elsewhere(path, rows):
    out = subprocess.run([sys.executable, "-c", PROCESS.format(root=ROOT, path=str(path), rows=rows)], capture_output=True, text=True, timeout=300)
    assert "GOT" in out.stdout, out.stderr[-2000:]
    return eval(out.stdout.split("GOT")[1].strip())


def batch(spark, rows):
    df = spark.createDataFrame(rows, "id bigint, content string, h bigint")
    return df.withColumn("content", content_hash(df.content))


def found(df):
    return sorted(tuple(r) for r in df.collect())


def test_history_outlives_the_process(tmp_path):
    path = tmp_path / "history"
    assert elsewhere(path, [(1, "a", 5), (2, "b", None)]) == []
    assert elsewhere(path, [(7, "a", None), (8, None, 4), (9, "c", 0x3FF << 40)]) == [(1, 7), (1, 8)]


def test_interrupted_appends_are_not_seen(spark, tmp_path):
    path = str(tmp_path / "history")
    one = BatchDeduplicator(spark, path, buckets=2)
    one.accept(batch(spark, [(1, "a", 5)]))
    real, one._write_log = one._write_log, lambda *a: (_ for _ in ()).throw(RuntimeError("gone"))
    with pytest.raises(RuntimeError):
        one.accept(batch(spark, [(2, "b", 0x3FF << 40)]))
    two = BatchDeduplicator(spark, path)
    assert two.lost == [2] and two.buckets == 2
    assert found(two.process(batch(spark, [(3, "b", 0x3FF << 40), (4, "a", None)]))) == [(1, 4)]
    three = BatchDeduplicator(spark, path)
    three.compact()
    assert three.lost == [] and found(BatchDeduplicator(spark, path).process(batch(spark, [(5, "b", None)]))) == [(3, 5)]


def test_rewriting_keeps_everything(spark, tmp_path):
    path = str(tmp_path / "history")
    index = BatchDeduplicator(spark, path, buckets=2, compact_after=2, crowd=3)
    rng = random.Random(3)
    # one stripe in common: its key is split when the tables are rewritten, the append after that goes to the finer keys
    hashes = [rng.getrandbits(40) << 22 | 7 for _ in range(12)]
    for i in range(0, 12, 3):
        assert found(index.process(batch(spark, [(j, f"u{j}", hashes[j]) for j in range(i, i + 3)]))) == []
    assert index.generation == 2 and index.hot is not None and index.hot.count() >= 1
    files = [f for _, _, fs in os.walk(f"{path}/g2/parts") for f in fs if f.endswith(".parquet")]
    assert len(files) <= 2
    again = BatchDeduplicator(spark, path, crowd=3)
    repeats = [(100 + i, f"v{i}", h ^ 1 << 30 ^ 1 << 45 ^ 1 << 60 ^ 1 ^ 2) for i, h in enumerate(hashes)]
    assert found(again.process(batch(spark, repeats))) == [(i, 100 + i) for i in range(12)]


@pytest.mark.parametrize("crowd", [2, 100])
def test_one_run_gives_what_single_batches_give(spark, crowd):
    rng = random.Random(8)
    base = [rng.getrandbits(42) << 22 for _ in range(8)]
    rows = []
    for i in range(90):
        h = rng.choice(base)
        for _ in range(rng.choice([0, 1, 3, 5, 6])):
            h ^= 1 << rng.randrange(64)
        rows.append((i + 1, i // 35, f"https://a.test/{rng.randrange(70)}.jpg", f"{h:016x}"))
    rows += [(500 + i, 3, "https://a.test/copy.jpg", f"{base[0]:016x}") for i in range(30)]
    whole = {r.rejected_id: r.accepted_id for r in repeated_pictures(reviews(spark, rows), buckets=2, crowd=crowd).collect()}
    assert whole.keys() == brute_repeats(rows).keys()
    if crowd == 2:
        single = {r.rejected_id: r.accepted_id for r in repeated_pictures(reviews(spark, rows), one_by_one=True, buckets=2, crowd=crowd).collect()}
        assert single == whole


@pytest.mark.parametrize("stripes", [2, 3])
def test_keys_of_close_values_meet(spark, stripes):
    rng = random.Random(stripes)
    pairs = []
    for _ in range(40):
        a = rng.getrandbits(64)
        b = a
        for place in rng.sample(range(64), rng.randrange(6)):
            b ^= 1 << place
        pairs.append((a - (1 << 64) if a >> 63 else a, b - (1 << 64) if b >> 63 else b))
    index = BitIndex(5, stripes)
    df = spark.createDataFrame(pairs, "a bigint, b bigint")
    from pyspark.sql import functions as F

    part = lambda c: F.transform(c, lambda x: x["part"])
    met = df.select(F.arrays_overlap(part(index.sought(df.a)), part(index.stored(df.b))).alias("m"), F.size(index.stored(df.a)).alias("n")).collect()
    assert all(r.m and r.n == stripes for r in met)
    # with every first key split
    hot = index.keys(df.select(F.col("a").alias("h")).union(df.select(F.col("b").alias("h"))), None, False).select("part").distinct()
    fine = index.keys(df.select(F.col("b").alias("h"), F.col("a").alias("q")), hot, False)
    asked = index.keys(df.select(F.col("a").alias("h")), hot, True).select(F.col("h").alias("q"), F.col("part").alias("p"))
    assert fine.join(asked, (fine.part == asked.p) & (fine.q == asked.q)).select(fine.q).distinct().count() == len({a for a, _ in pairs})
