"""Queries on addresses, trust, harvest and gates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimloom.functions import text as T
from claimloom.functions import url as U
from claimloom.operators import gates, ordered
from claimloom.plans.catalog import query

SQL_HOST = r"regexp_replace(lower(regexp_extract({0}, '^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//([^/?#]*)', 1)), '^www\.', '')"
SQL_NORM = (
    r"regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(lower(trim({0})), '^https?://', ''), '(?s)[#?].*$', ''), '^www\.', ''), '/+$', ''), "
    r"'[-_](?:\d{{2,4}}x\d{{2,4}}|thumb|thumbnail|scaled|small|medium|large)(\.[a-z]{{2,4}})$', '\1')"
)


def _cat(category: str, h: str) -> str:
    return "(" + " OR ".join(f"contains({h}, '{n}')" for n in U.HOST_RULES[category]) + ")"


def sql_reason(h: str) -> str:
    return f"CASE WHEN {h} = '' THEN 'no host' " + " ".join(f"WHEN {_cat(c, h)} THEN '{c}'" for c in U.LOW_TRUST) + " ELSE 'ok' END"


def sql_score(h: str) -> str:
    return f"CASE WHEN {sql_reason(h)} <> 'ok' THEN 1 WHEN {_cat('maker', h)} THEN 3 ELSE 2 END"


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


_REV = f"SELECT *, {SQL_HOST.format('bild_url')} AS host, {SQL_NORM.format('bild_url')} AS url_key FROM review"


def _review(spark: SparkSession, d: str, *cols: str) -> DataFrame:
    return table(spark, d, "review").select(*cols, "bild_url", U.host(F.col("bild_url")).alias("host"), U.norm_url(F.col("bild_url")).alias("url_key"))


@query(
    f"WITH r AS ({_REV}), ok AS (SELECT *, row_number() OVER (PARTITION BY url_key ORDER BY review_id) AS n FROM r WHERE {sql_reason('host')} = 'ok') "
    f"SELECT url_key, review_id, host, {sql_score('host')} AS source_score FROM ok WHERE n = 1"
)
def url_trust_dedup(spark: SparkSession, d: str) -> DataFrame:
    """Sources that survive the trust filter, one row for every picture address, first come first kept."""
    ok = _review(spark, d, "review_id").where(~U.low_trust(F.col("bild_url"))).select("url_key", "review_id", "host", U.source_score(F.col("bild_url")).alias("source_score"))
    return ordered.first_by_key(ok, ["url_key"], ["review_id"])


@query(f"SELECT review_id, {SQL_HOST.format('bild_url')} AS host FROM review")
def url_hosts(spark: SparkSession, d: str) -> DataFrame:
    return _review(spark, d, "review_id").select("review_id", "host")


@query(
    f"SELECT review_id, {SQL_NORM.format('bild_url')} AS url_key, lower(regexp_replace(regexp_replace(trim(bild_url), '(?s)\\?.*$', ''), '/+$', '')) AS update_key FROM review"
)
def url_keys(spark: SparkSession, d: str) -> DataFrame:
    return _review(spark, d, "review_id").select("review_id", "url_key", U.update_key(F.col("bild_url")).alias("update_key"))


@query(f"WITH r AS ({_REV}) SELECT {sql_reason('host')} AS reason, count(*) AS n FROM r GROUP BY 1")
def trust_block_reasons(spark: SparkSession, d: str) -> DataFrame:
    return _review(spark, d).groupBy(U.block_reason(F.col("bild_url")).alias("reason")).agg(F.count(F.lit(1)).alias("n"))


@query(
    f"WITH r AS ({_REV}) SELECT host, max({sql_score('host')}) AS score_image, max(CASE WHEN {sql_reason('host')} <> 'ok' THEN 1 ELSE 3 END) AS score_text, count(*) AS n FROM r GROUP BY host"
)
def source_scores(spark: SparkSession, d: str) -> DataFrame:
    u = F.col("bild_url")
    x = _review(spark, d).select("host", U.source_score(u).alias("a"), U.source_score(u, unknown=3).alias("b"))
    return x.groupBy("host").agg(F.max("a").alias("score_image"), F.max("b").alias("score_text"), F.count(F.lit(1)).alias("n"))


@query(
    f"WITH r AS ({_REV}), s AS (SELECT batch_no, count(*) AS found, count_if({sql_reason('host')} <> 'ok') AS junk, "
    f"count(DISTINCT CASE WHEN {sql_reason('host')} = 'ok' THEN url_key END) AS new, avg(CASE WHEN {sql_reason('host')} = 'ok' THEN {sql_score('host')} END) AS mean_score FROM r GROUP BY batch_no) "
    "SELECT batch_no, found, junk, new, round(mean_score, 6) AS mean_score, round(new / greatest(1, found), 6) AS yield, round(junk / greatest(1, found), 6) AS cheap_share, "
    "CAST((found > 0 AND new / greatest(1, found) < 0.3) AS INT) + CAST((found > 0 AND junk / greatest(1, found) >= 0.7) AS INT) + coalesce(CAST(mean_score < 2 AS INT), 0) AS warnings FROM s"
)
def gate_image_batches(spark: SparkSession, d: str) -> DataFrame:
    """The image gate over every batch of review records."""
    u = F.col("bild_url")
    ok = ~U.low_trust(u)
    s = _review(spark, d, "batch_no").groupBy("batch_no").agg(
        F.count(F.lit(1)).alias("found"),
        F.count_if(~ok).alias("junk"),
        F.countDistinct(F.when(ok, F.col("url_key"))).alias("new"),
        F.avg(F.when(ok, U.source_score(u))).alias("mean_score"),
    )
    return gates.image_gate(s).select("batch_no", "found", "junk", "new", *[F.round(c, 6).alias(c) for c in ("mean_score", "yield", "cheap_share")], "warnings")


@query(
    f"WITH r AS (SELECT quelle, status, {SQL_HOST.format('bild_url')} AS host FROM review), s AS (SELECT quelle, count_if(status = 'Geprüft') AS kept, count_if(status <> 'Geprüft') AS rejected, "
    f"count_if(status = 'Geprüft' AND {_cat('maker', 'host')}) AS direct, avg({sql_score('host')}) AS mean_score FROM r GROUP BY quelle), "
    "m AS (SELECT *, kept / greatest(1, kept + rejected) AS y, least(1.0, direct / greatest(1, kept)) AS ds FROM s) "
    "SELECT quelle, kept, rejected, direct, round(y, 6) AS yield, round(ds, 6) AS direct_share, "
    "CAST(y < 0.3 AS INT) + CAST(ds < 0.4 AS INT) + CAST(mean_score < 2 AS INT) AS breaches, CAST(y < 0.3 AS INT) + CAST(ds < 0.4 AS INT) + CAST(mean_score < 2 AS INT) >= 2 AS stop FROM m"
)
def gate_crawl_sources(spark: SparkSession, d: str) -> DataFrame:
    """The crawl gate over every source."""
    u, kept = F.col("bild_url"), F.col("status") == "Geprüft"
    s = table(spark, d, "review").groupBy("quelle").agg(
        F.count_if(kept).alias("kept"),
        F.count_if(~kept).alias("rejected"),
        F.count_if(kept & U.host_is(u, "maker")).alias("direct"),
        F.avg(U.source_score(u)).alias("mean_score"),
    )
    return gates.crawl_gate(s).select("quelle", "kept", "rejected", "direct", F.round("yield", 6).alias("yield"), F.round("direct_share", 6).alias("direct_share"), "breaches", "stop")


#: Terms that anchor a text in the subject.
ANCHORS = ["joystick", "raupe", "kette", "hydraulik", "fernsteuerung", "tracked", "crawler", "control panel"]
_ANCHOR_SQL = "list_filter([" + ", ".join(f"'{a}'" for a in ANCHORS) + "], lambda a: contains(t, a))"


@query(
    f"WITH x AS (SELECT doc_id, lower(coalesce(text, '')) AS t FROM documents) SELECT doc_id, array_to_string({_ANCHOR_SQL}, ',') AS terms, len({_ANCHOR_SQL}) >= 2 AS strong FROM x"
)
def text_anchor_terms(spark: SparkSession, d: str) -> DataFrame:
    t = F.lower(F.coalesce("text", F.lit("")))
    hits = F.filter(F.array(*[F.lit(a) for a in ANCHORS]), lambda a: F.contains(t, a))
    return table(spark, d, "documents").select("doc_id", F.array_join(hits, ",").alias("terms"), (F.size(hits) >= 2).alias("strong"))


@query(
    f"WITH x AS (SELECT source, url, lower(coalesce(text, '')) AS t, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS n, doc_id FROM documents), "
    f"y AS (SELECT doc_kind AS k, count(*) AS found FROM documents GROUP BY 1), "
    f"z AS (SELECT d.doc_kind AS k, count(*) AS new, count_if(len({_ANCHOR_SQL}) >= 2) AS strong, sum({sql_score(SQL_HOST.format('x.url'))}) AS score_sum FROM x JOIN documents d USING (doc_id) WHERE n = 1 GROUP BY 1) "
    "SELECT k AS doc_kind, found, coalesce(new, 0) AS new, coalesce(strong, 0) AS strong, coalesce(score_sum, 0) AS score_sum, round(coalesce(new, 0) / greatest(1, found), 6) AS yield, "
    "round(coalesce(strong, 0) / greatest(1, coalesce(new, 0)), 6) AS strong_share, "
    "CAST(coalesce(new, 0) / greatest(1, found) < 0.3 AS INT) + CAST(coalesce(strong, 0) / greatest(1, coalesce(new, 0)) < 0.4 AS INT) + CAST(coalesce(score_sum, 0) / greatest(1, coalesce(new, 0)) < 2 AS INT) >= 2 AS stop "
    "FROM y LEFT JOIN z USING (k)"
)
def gate_text_kinds(spark: SparkSession, d: str) -> DataFrame:
    """The text gate over every kind of page; of each source only its first page counts as new."""
    docs = table(spark, d, "documents")
    found = docs.groupBy("doc_kind").agg(F.count(F.lit(1)).alias("found"))
    first = ordered.first_by_key(docs.select("source", "doc_id", "doc_kind", "url", "text"), ["source"], ["doc_id"])
    t = F.lower(F.coalesce("text", F.lit("")))
    strong = F.size(F.filter(F.array(*[F.lit(a) for a in ANCHORS]), lambda a: F.contains(t, a))) >= 2
    new = first.groupBy("doc_kind").agg(F.count(F.lit(1)).alias("new"), F.count_if(strong).alias("strong"), F.sum(U.source_score(F.col("url"))).alias("score_sum"))
    s = found.join(new, found["doc_kind"].eqNullSafe(new["doc_kind"]), "left").select(found["doc_kind"], "found", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("new", "strong", "score_sum")])
    return gates.text_gate(s).select("doc_kind", "found", "new", "strong", "score_sum", F.round("yield", 6).alias("yield"), F.round("strong_share", 6).alias("strong_share"), "stop")


@query(
    "WITH t AS (SELECT doc_id, regexp_replace(regexp_replace(coalesce(text, ''), '(?is)<script.*?</script>|<style.*?</style>|<noscript.*?</noscript>', ' ', 'g'), '(?s)<[^>]+>', ' ', 'g') AS t FROM documents) "
    "SELECT doc_id, md5(trim(regexp_replace(t, '[\\s\\x{00A0}\\x{2000}-\\x{200A}\\x{2028}\\x{2029}\\x{202F}\\x{205F}\\x{3000}\\x{0085}]+', ' ', 'g'))) AS text_hash FROM t"
)
def html_plain_text(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", F.md5(T.html_text(F.col("text"))).alias("text_hash"))


@query(
    f"WITH r AS ({_REV}), f AS (SELECT url_key, min(batch_no) AS b FROM r GROUP BY url_key), s AS (SELECT r.batch_no, count(DISTINCT CASE WHEN r.batch_no = f.b THEN url_key END) AS new, count(DISTINCT CASE WHEN r.batch_no > f.b THEN url_key END) AS known, "
    "count(*) AS candidates, count_if(status = 'Archiv') AS rejected FROM r JOIN f USING (url_key) GROUP BY 1) "
    "SELECT batch_no, new, known, candidates, rejected, round(new / greatest(1, new + known), 6) AS yield, round((candidates - rejected) / greatest(1, candidates), 6) AS pass_share, "
    "CAST(new / greatest(1, new + known) < 0.3 AS INT) + CAST((candidates - rejected) / greatest(1, candidates) < 0.4 AS INT) AS warnings FROM s"
)
def gate_discovery_batches(spark: SparkSession, d: str) -> DataFrame:
    r = _review(spark, d, "batch_no", "status")
    first = r.groupBy("url_key").agg(F.min("batch_no").alias("b"))
    s = r.join(first, "url_key").groupBy("batch_no").agg(
        F.countDistinct(F.when(F.col("batch_no") == F.col("b"), F.col("url_key"))).alias("new"),
        F.countDistinct(F.when(F.col("batch_no") > F.col("b"), F.col("url_key"))).alias("known"),
        F.count(F.lit(1)).alias("candidates"),
        F.count_if(F.col("status") == "Archiv").alias("rejected"),
    )
    return gates.discovery_gate(s).select("batch_no", "new", "known", "candidates", "rejected", F.round("yield", 6).alias("yield"), F.round("pass_share", 6).alias("pass_share"), "warnings")


@query(f"WITH r AS ({_REV}) SELECT url_key, count(*) AS n FROM r WHERE batch_no > 0 AND url_key NOT IN (SELECT url_key FROM r WHERE batch_no = 0) GROUP BY 1")
def known_url_anti_join(spark: SparkSession, d: str) -> DataFrame:
    """New addresses that the accepted history does not hold."""
    r = _review(spark, d, "batch_no")
    return r.where("batch_no > 0").join(r.where("batch_no = 0").select("url_key"), "url_key", "left_anti").groupBy("url_key").agg(F.count(F.lit(1)).alias("n"))


@query(
    "WITH u AS (SELECT lower(regexp_replace(regexp_replace(trim(bild_url), '(?s)\\?.*$', ''), '/+$', '')) AS k, review_id, batch_no, status FROM review), "
    "l AS (SELECT k, arg_max(status, review_id) AS s FROM u WHERE batch_no > 0 GROUP BY k) "
    "SELECT u.review_id, CASE WHEN l.k IS NOT NULL THEN coalesce(l.s, '') ELSE u.status END AS status FROM u LEFT JOIN l USING (k) WHERE u.batch_no = 0"
)
def update_last_wins(spark: SparkSession, d: str) -> DataFrame:
    """The accepted records with the status of the last later record of the same address."""
    u = table(spark, d, "review").select("review_id", "batch_no", "status", U.update_key(F.col("bild_url")).alias("k"))
    return ordered.last_update_wins(u.where("batch_no = 0"), u.where("batch_no > 0"), "k", ["review_id"], ["status"]).select("review_id", "status")


@query(
    f"SELECT source, url, doc_id FROM (SELECT source, url, doc_id, row_number() OVER (PARTITION BY source ORDER BY CASE WHEN contains(url, 'datenblatt') THEN 2 ELSE 0 END + CASE WHEN contains({SQL_HOST.format('url')}, source) THEN 3 ELSE 0 END "
    f"- CASE WHEN {sql_reason(SQL_HOST.format('url'))} <> 'ok' THEN 5 ELSE 0 END DESC, doc_id) AS n FROM documents WHERE url IS NOT NULL) WHERE n = 1"
)
def best_spec_page(spark: SparkSession, d: str) -> DataFrame:
    """For every source the page that most likely holds its specification; the first of equals."""
    u = F.col("url")
    score = F.when(F.contains(u, F.lit("datenblatt")), 2).otherwise(0) + F.when(F.contains(U.host(u), F.col("source")), 3).otherwise(0) - F.when(U.low_trust(u), 5).otherwise(0)
    x = table(spark, d, "documents").where(u.isNotNull()).select("source", "url", "doc_id", (-score).alias("_s"))
    return ordered.first_by_key(x, ["source"], ["_s", "doc_id"]).select("source", "url", "doc_id")
