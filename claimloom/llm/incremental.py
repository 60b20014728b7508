"""Deduplicating new batches against all history, without going through the history again.

Every accepted record leaves exact hashes of its normalised content and part hashes in two bucketed tables that
outlive the session.  New batches are brought to the buckets (the history is not shuffled), bucket-local joins
find full copies and shared parts, what is new is accepted, and its hashes are appended.

Content here is a picture: its address in canonical form, and a 64-bit perceptual hash, whose parts are stripes
of its bits (``BitIndex``); the search for close hashes is exact.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable
from itertools import combinations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from claimloom.session import Scratch, delete_path, materialize, new_path

#: Query parameters that only serve tracking (a trailing * stands for any ending).
TRACKING = ["utm_*", "fbclid", "gclid", "dclid", "msclkid", "yclid", "igshid", "mc_cid", "mc_eid", "_ga", "ref", "ref_src", "referrer"]
#: Query parameters by which a site scales the same file.
SCALING = ["w", "h", "width", "height"]
#: Endings of file names by which a site marks its scaled copy; sizes have three or four digits a side.
SCALED = r"(?i)[-_](?:\d{3,4}x\d{3,4}|thumb|thumbnail|scaled|small|medium|large)(?=\.[a-z0-9]{2,5}$)"


def _decoded(c: Column) -> Column:
    return F.coalesce(F.try_url_decode(F.replace(c, F.lit("+"), F.lit("%2B"))), c)


def picture_address(c: Column) -> Column:
    """The canonical form of an image address, null for blank ones.

    Scheme, case of the host, www., default ports, percent encoding, empty and dot segments of the path, the
    fragment, tracking parameters, the order of parameters and the mark of a scaled copy do not matter.  Case
    and names in the path and all other parameters (object, view, product) do.  A size that is part of a
    product's name has two-digit parts (track width by pitch) and stays.
    """
    u = F.regexp_replace(F.trim(F.regexp_replace(c, r"(?U)^\s+|\s+$", "")), "#.*$", "")
    rest = F.regexp_replace(u, r"^(?i:[a-z][a-z0-9+.\-]*:)?//", "")
    addr = F.regexp_extract(rest, r"^([^?]*)", 1)
    query = F.regexp_extract(rest, r"\?(.*)$", 1)
    host = F.lower(F.regexp_extract(addr, r"^([^/]*)", 1))
    host = F.regexp_replace(F.regexp_replace(F.regexp_replace(host, r"^.*@", ""), r"\.?(?::(?:80|443))?$", ""), r"^www\d?\.", "")
    plain = F.concat(F.lit("/"), _decoded(F.regexp_extract(addr, r"^[^/]*/?(.*)$", 1)), F.lit("/"))
    plain = F.regexp_replace(plain, r"/(?:\.?/)+", "/")
    # only a path with a step back is walked segment by segment
    walked = F.aggregate(
        F.split(plain, "/"),
        F.array().cast("array<string>"),
        lambda acc, s: F.when(s == "", acc).when(s == "..", F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0)))).otherwise(F.concat(acc, F.array(s))),
    )
    path = F.when(F.contains(plain, F.lit("/../")), F.array_join(walked, "/")).otherwise(F.regexp_replace(plain, "^/|/$", ""))
    path = F.regexp_replace(path, SCALED, "")
    drop = "|".join(t.replace("*", ".*") for t in (*TRACKING, *SCALING))
    kept = F.array_sort(F.filter(F.transform(F.split(query, "[&;]"), _decoded), lambda p: (p != "") & ~p.rlike(rf"(?i)^(?:{drop})(?:=|$)")))
    return F.when(F.length(u) > 0, F.concat_ws("\n", host, path, F.array_join(kept, "&")))


def content_hash(c: Column) -> Column:
    """128-bit hash of normalised content as binary; null stays null."""
    return F.unhex(F.md5(c))


def picture_hash(c: Column) -> Column:
    """The 64-bit perceptual hash as bigint: 16 hexadecimal digits in either case, with or without 0x and
    separators; null if it cannot be read in full or is zero."""
    h = F.regexp_replace(F.regexp_replace(F.lower(F.trim(c)), "^0x", ""), r"[\s:_\-]", "")
    ok = h.rlike("^[0-9a-f]{16}$") & ~h.rlike("^0+$")
    # two halves: a 64-bit literal would overflow the conversion
    hi = F.conv(F.substring(h, 1, 8), 16, 10).cast("bigint")
    lo = F.conv(F.substring(h, 9, 8), 16, 10).cast("bigint")
    return F.when(ok, F.shiftleft(hi, 32).bitwiseOR(lo))


def _flips(mask: int, radius: int) -> list[int]:
    """All patterns of at most ``radius`` bits within a mask."""
    bits = [1 << i for i in range(64) if mask >> i & 1]
    return [sum(c) for r in range(radius + 1) for c in combinations(bits, r)]


def _long(v: int) -> int:
    return v - (1 << 64) if v >= 1 << 63 else v


def _longs(values: Iterable[int]) -> Column:
    return F.lit([_long(v) for v in values]).cast("array<bigint>")


class BitIndex:
    """Keys by which two 64-bit values within ``distance`` bits are sure to meet.

    The bits are cut into stripes.  Of two values within ``distance`` bits some stripe differs in at most
    ``distance // stripes`` of its bits: a stored value gives one key for each stripe, a looked-up value one for
    everything within that many bits of its stripe.  Few rows are stored (three a value), and a key holds a
    third of the value.  A key that very many values share is split: what the key leaves of the value is cut
    into two halves, and the stored value gives one key for each half, the looked-up one all keys near its halves.
    """

    def __init__(self, distance: int = 5, stripes: int = 3):
        self.distance, self.stripes = distance, stripes
        edges = [64 * i // stripes for i in range(stripes + 1)]
        self.masks = [((1 << (b - a)) - 1) << a for a, b in zip(edges, edges[1:])]

    def stored(self, h: Column) -> Column:
        """Array of (part, mask): the keys under which a value is stored."""
        return F.transform(_longs(self.masks), lambda m: F.struct(F.xxhash64(h.bitwiseAND(m), m).alias("part"), m.alias("mask")))

    def sought(self, h: Column) -> Column:
        """Array of (part, mask): the keys under which the values near ``h`` are stored."""
        near = [(m, f) for m in self.masks for f in _flips(m, self.distance // self.stripes)]
        # two constant arrays in one small expression: a list of hashes would be a huge generated method
        masks, flips = _longs(m for m, _ in near), _longs(f for _, f in near)
        return F.zip_with(masks, flips, lambda m, f: F.struct(F.xxhash64(h.bitwiseAND(m).bitwiseXOR(f), m).alias("part"), m.alias("mask")))

    def split(self, part: Column, mask: Column, h: Column, sought: bool) -> Column:
        """Array of the finer keys of a split key."""
        out = None
        for m in self.masks:
            bits = [1 << i for i in range(64) if not m >> i & 1]
            halves = [sum(bits[0::2]), sum(bits[1::2])]
            near = [(r, f) for r in halves for f in (_flips(r, self.distance // 2) if sought else [0])]
            masks, flips = _longs(r for r, _ in near), _longs(f for _, f in near)
            keys = F.zip_with(masks, flips, lambda r, f: F.xxhash64(part, h.bitwiseAND(r).bitwiseXOR(f), r))
            out = F.when(mask == _long(m), keys) if out is None else out.when(mask == _long(m), keys)
        return out

    def keys(self, df: DataFrame, hot: DataFrame | None, sought: bool) -> DataFrame:
        """``df(h, ...)`` with a column ``part``, one row for each key; ``hot(part)`` are the split keys.

        A looked-up value keeps the key itself beside the finer ones: values stored before the split lie there.
        """
        if sought:
            # a small table is read in one task, but the keys are many
            df = df.repartition(df.sparkSession.sparkContext.defaultParallelism)
        x = df.withColumn("_k", F.explode(self.sought(F.col("h")) if sought else self.stored(F.col("h")))).select(*df.columns, "_k.part", "_k.mask")
        if hot is not None:
            x = x.join(hot.select("part", F.lit(True).alias("_hot")), "part", "left")
            fine, own = self.split(F.col("part"), F.col("mask"), F.col("h"), sought), F.array("part")
            x = x.select(*df.columns, F.explode(F.when(F.col("_hot"), F.concat(own, fine) if sought else fine).otherwise(own)).alias("part"))
        return x.select(*df.columns, "part")

    def crowded(self, hashes: DataFrame, most: int) -> DataFrame:
        """``(part)``: the keys under which more than ``most`` of the different values ``hashes(h)`` are stored."""
        n = self.keys(hashes.select("h"), None, False).groupBy("part").agg(F.count(F.lit(1)).alias("n"))
        return n.where(F.col("n") > most).select("part")

    def close(self, a: str, b: str) -> Column:
        return F.bit_count(F.col(a).bitwiseXOR(F.col(b))) <= self.distance


class BatchDeduplicator:
    """Accepts records in order and reports which repeat an accepted one, against a history that outlives the session.

    ``path`` is the history's folder: two tables bucketed and sorted by their key, ``content`` (exact hashes) and
    ``parts`` (keys of picture hashes), and a log of what was appended.  An existing folder is opened as it is; its
    own ``buckets`` and ``stripes`` hold.  Without ``path`` the history ends with the application.

    Records are ``(id bigint, content binary, h bigint)`` and may have ``batch bigint``; null content and null hash
    match nothing.  Each call of ``process`` reads the two narrow tables once, whole buckets in place (the history is
    neither shuffled nor sorted: the sought keys are hashed, the history streams past them), whether it is given one
    batch or all batches that wait.  Appends whose log entry is missing (an application that died) are not seen.
    After ``compact_after`` appends the tables are rewritten with one file a bucket.  One writer at a time.

    A key with more than ``crowd`` stored values is split (``BitIndex``); that is exact and bounds what one key holds.
    """

    TABLES = {"content": ("content", "content binary, owner bigint, seq int"), "parts": ("part", "part bigint, h bigint, owner bigint, seq int")}

    def __init__(self, spark: SparkSession, path: str | None = None, buckets: int | None = None, distance: int = 5, stripes: int = 3, crowd: int = 100_000, compact_after: int = 16):
        self.spark, self.crowd, self.compact_after = spark, crowd, compact_after
        self.path = (path or new_path(spark, "history")).rstrip("/")
        self.name = f"claimloom_{uuid.uuid4().hex[:12]}"
        log = self._read_log()
        if not log:
            buckets = buckets or max(24, int(spark.conf.get("spark.sql.shuffle.partitions")))
            log = [self._write_log("created", 0, 0, buckets, stripes, distance)]
        first = log[0]
        self.buckets, self.index = first["buckets"], BitIndex(first["distance"], first["stripes"])
        self.generation = max(r["generation"] for r in log)
        here = [r["seq"] for r in log if r["generation"] == self.generation]
        self.appends = sum(r["generation"] == self.generation and r["what"] == "appended" for r in log)
        self._register()
        started = max(here)
        for name in self.TABLES:
            got = self.spark.table(self._table(name)).agg(F.max("seq")).first()[0]
            started = max(started, got or 0)
        whole = {r["seq"] for r in log if r["generation"] == self.generation and r["what"] == "appended"}
        rewritten = max((r["seq"] for r in log if r["generation"] == self.generation and r["what"] == "compacted"), default=0)
        #: numbers of appends that never ended
        self.lost = [n for n in range(rewritten + 1, started + 1) if n not in whole]
        self.seq = started

    def _read_log(self) -> list[dict]:
        jvm = self.spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(f"{self.path}/log")
        if not p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(p):
            return []
        # one short line an append, a handful after each compaction
        rows = self.spark.read.schema("what string, generation int, seq int, buckets int, stripes int, distance int").json(f"{self.path}/log")
        return [r.asDict() for r in rows.orderBy("generation", "seq", F.col("what") != "created").collect()]

    def _write_log(self, what: str, generation: int, seq: int, buckets: int = 0, stripes: int = 0, distance: int = 0) -> dict:
        row = {"what": what, "generation": generation, "seq": seq, "buckets": buckets, "stripes": stripes, "distance": distance}
        self.spark.range(1).select(*[F.lit(v).alias(k) for k, v in row.items()]).coalesce(1).write.mode("append").json(f"{self.path}/log")
        return row

    def _table(self, name: str, generation: int | None = None) -> str:
        return f"{self.name}_{name}_{self.generation if generation is None else generation}"

    def _register(self) -> None:
        # names the folder's tables to this session's catalog; writes nothing
        for name, (key, cols) in self.TABLES.items():
            self.spark.sql(
                f"CREATE TABLE IF NOT EXISTS {self._table(name)} ({cols}) USING parquet CLUSTERED BY ({key}) SORTED BY ({key}) INTO {self.buckets} BUCKETS "
                f"LOCATION '{self.path}/g{self.generation}/{name}'"
            )
        hot = f"{self.path}/g{self.generation}/hot"
        jvm = self.spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(hot)
        there = p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(p)
        self.hot = self.spark.read.schema("part bigint").parquet(hot).distinct() if there else None

    def stored(self, name: str) -> DataFrame:
        """A table of the history, without appends that never ended."""
        t = self.spark.table(self._table(name))
        return t.where(~F.col("seq").isin(self.lost)) if self.lost else t

    def _append(self, name: str, df: DataFrame) -> None:
        # one file a bucket: the hash partitioning of the exchange is that of the buckets
        key, cols = self.TABLES[name]
        df.select(*[c.split()[0] for c in cols.split(", ")]).repartition(self.buckets, key).write.insertInto(self._table(name))

    def _crowded(self, hashes: DataFrame) -> DataFrame | None:
        """The split keys: the known ones and those that ``hashes`` crowd."""
        new = self.index.crowded(hashes, self.crowd)
        new = materialize(new if self.hot is None else new.join(self.hot, "part", "left_anti"), "hot")
        if new.isEmpty():
            return self.hot
        new.write.mode("append").parquet(f"{self.path}/g{self.generation}/hot")
        return self.spark.read.schema("part bigint").parquet(f"{self.path}/g{self.generation}/hot").distinct()

    def accept(self, records: DataFrame) -> None:
        """Take records into the history as they stand."""
        self.seq += 1
        seq = F.lit(self.seq).alias("seq")
        # the earliest owner of a content or hash answers for it: index rows do not grow with copies
        self._append("content", records.where("content is not null").groupBy("content").agg(F.min("id").alias("owner")).select("content", "owner", seq))
        hs = materialize(records.where("h is not null").groupBy("h").agg(F.min("id").alias("owner")), "hashes")
        self.hot = self._crowded(hs)
        self._append("parts", self.index.keys(hs.select("h", "owner", seq), self.hot, False))
        self._write_log("appended", self.generation, self.seq)
        self.appends += 1
        if self.appends >= self.compact_after:
            self.compact()

    def compact(self) -> None:
        """Rewrite the history with one sorted file a bucket, and split keys that became crowded bit by bit."""
        old, parts, content = self.generation, self.stored("parts"), self.stored("content")
        stored = parts.groupBy("part").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > self.crowd).select("part")
        # only a stripe's own key can be split; a finer key is no value's first key
        first = self.index.keys(parts.select("h").distinct(), None, False)
        hot = materialize(first.select("part").distinct().join(stored, "part", "left_semi").union(self.hot or stored.limit(0)).distinct(), "hot")
        whole = materialize(parts.groupBy("h").agg(F.min(F.struct("seq", "owner")).alias("x")).select("h", "x.*"), "hashes")
        content = content.groupBy("content").agg(F.min(F.struct("seq", "owner")).alias("x")).select("content", "x.*")
        self.generation = old + 1
        delete_path(self.spark, f"{self.path}/g{self.generation}")  # of a rewriting that never ended
        self._register()
        if not hot.isEmpty():
            hot.write.mode("overwrite").parquet(f"{self.path}/g{self.generation}/hot")
            self.hot = self.spark.read.schema("part bigint").parquet(f"{self.path}/g{self.generation}/hot")
        self._append("content", content)
        self._append("parts", self.index.keys(whole, self.hot, False))
        # from this entry on the new generation holds; what never ended is not in it
        self._write_log("compacted", self.generation, self.seq)
        self.appends, self.lost = 0, []
        for name in self.TABLES:
            self.spark.sql(f"DROP TABLE {self._table(name, old)}")
        delete_path(self.spark, f"{self.path}/g{old}")

    def process(self, batch: DataFrame) -> DataFrame:
        """``(accepted_id, rejected_id)`` of records against everything accepted before them, by ``batch``, then id.

        Without a column ``batch`` the records are one batch.  The accepted ones are appended to the history.
        Repeated ids are not expected; they must be reduced before.
        """
        number = F.col("batch") if "batch" in batch.columns else F.lit(0).cast("bigint")
        with Scratch(self.spark, "batch") as s:
            judged = self._judged(s, s.cut(batch.select("id", number.alias("batch"), "content", "h")))
            self.accept(judged.where("accepted_id is null").select(F.col("rep.id").alias("id"), "content", "h"))
            rows = batch.select("id", "content", "h")
            same = F.col("content").eqNullSafe(F.col("c2")) & F.col("h").eqNullSafe(F.col("h2"))
            members = rows.join(judged.select(F.col("content").alias("c2"), F.col("h").alias("h2"), F.col("rep.id").alias("rep"), "accepted_id"), same)
            out = members.where("accepted_id is not null or id <> rep").select(F.coalesce("accepted_id", "rep").alias("accepted_id"), F.col("id").alias("rejected_id"))
            return materialize(out, "repeats")

    def _judged(self, s: Scratch, rows: DataFrame) -> DataFrame:
        """``(rep, content, h, accepted_id)``: the verdict on every class of records with one content and one hash;
        ``rep(batch, id)`` is its first record.  Classes fare alike but for that record."""
        classes = s.cut(rows.where("content is not null or h is not null").groupBy("content", "h").agg(F.min(F.struct("batch", "id")).alias("rep")))
        before = F.min(F.struct("seq", "owner")).alias("hit")
        by_content = classes.where("content is not null").hint("shuffle_hash").join(self.stored("content"), "content").groupBy("rep").agg(before)
        hashes = s.cut(classes.where("h is not null").select("h").distinct())
        # the sought keys are the hashed side, the history streams in its buckets
        sought = self.index.keys(hashes, self.hot, True).hint("shuffle_hash")
        found = sought.join(self.stored("parts").withColumnRenamed("h", "old"), "part").where(self.index.close("h", "old")).groupBy("h").agg(before)
        hits = by_content.union(found.join(classes, "h").select("rep", "hit")).groupBy("rep").agg(F.min("hit").alias("hit"))
        state = s.cut(classes.join(hits, "rep", "left").select("rep", "content", "h", F.col("hit.owner").alias("accepted_id")))
        open_ = state.where("accepted_id is null").select("rep", "content", "h")
        alone = s.cut(open_.where("h is not null").select("h").distinct())
        crowded = s.cut(self.index.crowded(alone, self.crowd))
        crowded = None if crowded.isEmpty() else crowded
        other = self.index.keys(alone, crowded, False).withColumnRenamed("h", "h2")
        # the keys are many times the hashes that the planner sees: never broadcast them
        near = self.index.keys(alone, crowded, True).hint("merge").join(other, "part").where(self.index.close("h", "h2")).select("h", "h2").distinct()
        near = s.cut(near)
        done = f"{s.path}/done"
        state.where("accepted_id is not null").select("rep", "accepted_id").write.parquet(done)
        nothing = F.lit(None).cast("bigint").alias("accepted_id")
        while True:
            first_c = open_.where("content is not null").groupBy("content").agg(F.min("rep").alias("first_c"))
            first_h = open_.where("h is not null").groupBy("h").agg(F.min("rep").alias("first_h"))
            around = near.join(first_h.withColumnRenamed("h", "h2"), "h2").groupBy("h").agg(F.min("first_h").alias("first_n"))
            ranked = open_.join(first_c, "content", "left").join(around, "h", "left")
            first = F.least("rep", F.coalesce("first_c", "rep"), F.coalesce("first_n", "rep"))
            # a class without an earlier open neighbour is accepted; its open neighbours are all later ones
            round_ = s.cut(ranked.select("rep", "content", "h", (F.col("rep") == first).alias("ok")))
            won = round_.where("ok").select("rep", "content", "h")
            won.select("rep", nothing).write.mode("append").parquet(done)
            rest = round_.where("not ok").select("rep", "content", "h")
            if rest.isEmpty():
                break
            via_c = rest.join(won.where("content is not null").groupBy("content").agg(F.min("rep").alias("a")), "content").select("rep", "a")
            won_h = won.where("h is not null").groupBy("h").agg(F.min("rep").alias("a")).withColumnRenamed("h", "h2")
            via_h = rest.join(near.join(won_h, "h2").groupBy("h").agg(F.min("a").alias("a")), "h").select("rep", "a")
            lost = s.cut(rest.join(via_c.union(via_h).groupBy("rep").agg(F.min("a").alias("a")), "rep", "left").select("rep", "content", "h", F.col("a.id").alias("accepted_id")))
            lost.where("accepted_id is not null").select("rep", "accepted_id").write.mode("append").parquet(done)
            open_ = lost.where("accepted_id is null").select("rep", "content", "h")
            if open_.isEmpty():
                break
        decided = self.spark.read.schema("rep struct<batch:bigint,id:bigint>, accepted_id bigint").parquet(done)
        return s.cut(state.select("rep", "content", "h").join(decided, "rep"))


def repeated_pictures(review: DataFrame, one_by_one: bool = False, **params) -> DataFrame:
    """``(accepted_id, rejected_id)``: batch 0 is accepted as it stands, later batches follow in order.

    A record without a batch number comes in one batch after all others.  Records without a readable address
    and hash are accepted and match nothing; rows without an id are left out, of rows that repeat an id one stays.
    All batches that wait are judged in one run over the history, in their order; with ``one_by_one`` each gets a
    run of its own, as if they arrived one after the other, with the same result.
    """
    spark = review.sparkSession
    rows = review.select(
        F.col("review_id").alias("id"),
        F.coalesce(F.col("batch_no").cast("bigint"), F.lit(2**62)).alias("batch"),
        content_hash(picture_address(F.col("bild_url"))).alias("content"),
        picture_hash(F.col("bild_hash")).alias("h"),
    )
    rows = materialize(rows.where("id is not null").groupBy("id").agg(F.min(F.struct("batch", "content", "h")).alias("r")).select("id", "r.*"), "pictures")
    index = BatchDeduplicator(spark, **params)
    index.accept(rows.where("batch <= 0"))
    later = rows.where("batch > 0")
    if not one_by_one:
        return index.process(later)
    out = spark.createDataFrame([], "accepted_id bigint, rejected_id bigint")
    for (b,) in later.select("batch").distinct().orderBy("batch").collect():
        out = out.union(index.process(later.where(F.col("batch") == b)))
    return out


def near_pictures(review: DataFrame, distance: int = 5, stripes: int = 3, crowd: int = 100_000) -> DataFrame:
    """``(a_id, b_id, bits)``: all pairs of records, of the same or of different batches, whose readable hashes
    differ in at most ``distance`` bits; ``a_id < b_id``.

    Only distinct hashes are searched, the records are joined to the close ones; the result itself grows with the
    square of the records that share a hash.
    """
    index = BitIndex(distance, stripes)
    rows = review.select(F.col("review_id").cast("bigint").alias("id"), picture_hash(F.col("bild_hash")).alias("h")).where("id is not null and h is not null")
    rows = materialize(rows.distinct(), "pictures")
    hashes = materialize(rows.select("h").distinct(), "hashes")
    hot = materialize(index.crowded(hashes, crowd), "hot")
    hot = None if hot.isEmpty() else hot
    bits = F.bit_count(F.col("h").bitwiseXOR(F.col("h2"))).cast("int").alias("bits")
    # the keys are many times the hashes that the planner sees: never broadcast them
    near = index.keys(hashes, hot, True).hint("merge").join(index.keys(hashes, hot, False).withColumnRenamed("h", "h2"), "part")
    near = near.where("h < h2").select("h", "h2", bits).where(F.col("bits") <= distance).distinct()
    same = rows.groupBy("h").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("h", F.col("h").alias("h2"), F.lit(0).alias("bits"))
    pairs = near.union(same).join(rows.select("h", F.col("id").alias("a")), "h").join(rows.select(F.col("h").alias("h2"), F.col("id").alias("b")), "h2")
    pairs = pairs.where("a <> b and (h <> h2 or a < b)")
    # a repeated id may carry two hashes: the closer one counts
    return pairs.groupBy(F.least("a", "b").alias("a_id"), F.greatest("a", "b").alias("b_id")).agg(F.min("bits").alias("bits"))
