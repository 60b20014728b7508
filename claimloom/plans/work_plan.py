"""Queries on labels, searches, firms, seeds, parsing and time windows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from claimloom.functions import similarity as S
from claimloom.functions import text as T
from claimloom.operators import evaluate as E
from claimloom.operators import firms, ordered, search
from claimloom.plans.catalog import query
from claimloom.plans.resolve_plan import sql_brand, sql_norm
from claimloom.plans.sources_plan import table


def _rule_sql(t: str, rules, otherwise: str = "''") -> str:
    whens = " ".join("WHEN " + " OR ".join(f"contains({t}, '{n}')" for n in needles) + f" THEN '{v}'" for needles, v in rules)
    return f"CASE {whens} ELSE {otherwise} END"


def _verdict_sql(c: str) -> str:
    return f"CASE WHEN {sql_norm(c)} = 'ja' THEN 'In-Scope' ELSE {_rule_sql(sql_norm(c), E.VERDICT_RULES)} END"


_MACHINE = "CASE status WHEN 'Archiv' THEN 'Out-of-Scope' WHEN 'Geprüft' THEN 'In-Scope' ELSE 'Unsicher' END"
_CODE = r"nullif(regexp_extract({0}, '^\s*(P\d+)\b', 1), '')"


def _rated(spark: SparkSession, d: str) -> DataFrame:
    machine = F.when(F.col("status") == "Archiv", "Out-of-Scope").when(F.col("status") == "Geprüft", "In-Scope").otherwise("Unsicher")
    return table(spark, d, "review").select("review_id", F.col("pattern_vorschlag").alias("pattern"), F.col("verdikt").alias("human"), machine.alias("machine"), "quelle", "suchquery")


@query(f"SELECT review_id, {_verdict_sql('verdikt')} AS class, nullif({_rule_sql(sql_norm('verdikt'), E.GOLD_RULES)}, '') AS gold FROM review")
def verdict_classes(spark: SparkSession, d: str) -> DataFrame:
    v = F.col("human")
    return _rated(spark, d).select("review_id", E.verdict_class(v).alias("class"), E.gold_label(v).alias("gold"))


@query(
    f"WITH x AS (SELECT nullif({_rule_sql(sql_norm('verdikt'), E.GOLD_RULES)}, '') AS g, CASE WHEN {_MACHINE} = 'In-Scope' THEN 'target' ELSE 'other' END AS p FROM review), "
    "n AS (SELECT count_if(g = 'target' AND p = 'target') AS tp, count_if(g = 'other' AND p = 'target') AS fp, count_if(g = 'target' AND p = 'other') AS fn, count_if(g = 'other' AND p = 'other') AS tn, count_if(g IS NULL) AS ignored FROM x), "
    "m AS (SELECT *, coalesce(tp / nullif(tp + fn, 0), 0) AS recall, coalesce(tp / nullif(tp + fp, 0), 0) AS precision FROM n) SELECT *, coalesce(2 * precision * recall / nullif(precision + recall, 0), 0) AS f1 FROM m"
)
def confusion_metrics(spark: SparkSession, d: str) -> DataFrame:
    return E.confusion(_rated(spark, d), E.gold_label(F.col("human")), E.predicted_label(F.col("machine")))


_HM = (
    f"x AS (SELECT coalesce({_CODE.format('pattern_vorschlag')}, '?') AS pattern, {_verdict_sql('verdikt')} AS h, {_MACHINE} AS c FROM review), "
    "y AS (SELECT pattern, CASE WHEN h = 'Kein Objekt' THEN 'Out-of-Scope' ELSE h END AS m, c FROM x WHERE h <> '')"
)


@query(f"WITH {_HM} SELECT pattern, count(*) AS n, count_if(m = c) AS hits, count_if(m = c) / count(*) AS rate FROM y GROUP BY ROLLUP (pattern)")
def hit_rates_by_pattern(spark: SparkSession, d: str) -> DataFrame:
    return E.hit_rates(_rated(spark, d))


@query(f"WITH {_HM} SELECT h AS human, c AS machine, count(*) AS n FROM x WHERE h <> '' AND h <> c GROUP BY 1, 2")
def confused_classes(spark: SparkSession, d: str) -> DataFrame:
    return E.confused_pairs(_rated(spark, d))


@query(
    f"WITH x AS (SELECT review_id, {_verdict_sql('verdikt')} AS class, {sql_norm('quelle')} || '|' || {sql_norm('suchquery')} AS key FROM review), y AS (SELECT *, row_number() OVER (PARTITION BY key ORDER BY review_id) AS k FROM x WHERE class IN ('In-Scope', 'Out-of-Scope', 'Unsicher') AND key <> '|'), "
    "z AS (SELECT *, row_number() OVER (PARTITION BY class ORDER BY review_id) AS n FROM y WHERE k = 1) SELECT class, review_id AS ord, key FROM z WHERE n <= 4"
)
def balanced_lessons(spark: SparkSession, d: str) -> DataFrame:
    r = _rated(spark, d).select(F.col("review_id").alias("ord"), F.col("quelle").alias("maker"), F.col("suchquery").alias("application"), F.col("human").alias("verdict"))
    return E.balanced_examples(r, 4)


_OUT = " OR ".join(f"contains({sql_norm('pattern_code')}, '{w}')" for w in E.OUT_WORDS)


@query(
    f"SELECT seed_id, {_rule_sql(sql_norm('scope'), E.SCOPE_RULES)} AS scope_class, CASE WHEN {sql_norm('pattern_code')} IN ('out_scope', 'unknown', 'in_scope') THEN {sql_norm('pattern_code')} ELSE coalesce({_CODE.format('pattern_code')}, CASE WHEN {_OUT} THEN 'out_scope' END, 'unknown') END AS class FROM seed"
)
def seed_labels(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "seed").select("seed_id", E.scope_label(F.col("scope")).alias("scope_class"), E.pattern_class(F.col("pattern_code")).alias("class"))


_SPLIT = (
    r"q AS (SELECT review_id, batch_no, suchquery, trim(regexp_replace(coalesce(suchquery, ''), '(?:^|\s)-\S+', '', 'g')) AS query, array_to_string(regexp_extract_all(coalesce(suchquery, ''), '(?:^|\s)-(\S+)', 1), ' ') AS negative FROM review)"
)


def _guard_sql(q: str, n: str) -> str:
    q, n = sql_norm(q), sql_norm(n)
    parts = [f"WHEN {q} = '' THEN 'empty'"]
    for reason, words in search.FORBIDDEN.items():
        parts.append("WHEN " + " OR ".join(rf"(regexp_matches({q}, '\b{w}\b') AND NOT regexp_matches({n}, '\b{w}\b'))" for w in words) + f" THEN '{reason}'")
    one, two = ("|".join(words) for words in search.TOGETHER)
    parts.append(rf"WHEN regexp_matches({q}, '\b({one})\b') AND regexp_matches({q}, '\b({two})\b') THEN 'tunnel inspection'")
    parts.append("WHEN NOT (" + " OR ".join(f"contains({q}, '{a}')" for a in search.ANCHORS) + ") THEN 'no anchor'")
    return "CASE " + " ".join(parts) + " ELSE 'ok' END"


@query(f"WITH {_SPLIT} SELECT suchquery, query, negative, {_guard_sql('query', 'negative')} AS reason, count(*) AS n FROM q WHERE suchquery IS NOT NULL GROUP BY ALL")
def query_guard(spark: SparkSession, d: str) -> DataFrame:
    """Every search query with the reason why it is not run, or ok."""
    q = table(spark, d, "review").where("suchquery is not null").groupBy("suchquery").agg(F.count(F.lit(1)).alias("n"))
    plain, negative = search.split_negative(F.col("suchquery"))
    q = q.withColumns({"query": plain, "negative": negative})
    return q.select("suchquery", "query", "negative", search.guard(F.col("query"), F.col("negative")).alias("reason"), "n")


@query(
    "WITH h AS (SELECT suchquery AS query, batch_no AS run, row_number() OVER (PARTITION BY lower(bild_url) ORDER BY batch_no, review_id) = 1 AS is_new FROM review), "
    "g AS (SELECT query, run, count(*) AS found, count_if(is_new) AS new FROM h GROUP BY 1, 2) "
    "SELECT query, run, found, new, new / greatest(1, found) AS yield, sum(new) OVER (PARTITION BY query ORDER BY run ROWS UNBOUNDED PRECEDING)::BIGINT AS new_so_far FROM g"
)
def query_yields(spark: SparkSession, d: str) -> DataFrame:
    """Found, new and cumulative new hits of each query in each batch."""
    r = table(spark, d, "review").select(F.col("suchquery").alias("query"), F.col("batch_no").alias("run"), "review_id", F.lower("bild_url").alias("u"))
    first = r.groupBy("u").agg(F.min(F.struct("run", "review_id")).alias("f"))
    h = r.join(first, r["u"].eqNullSafe(first["u"])).select("query", "run", (F.struct("run", "review_id") == F.col("f")).alias("is_new"))
    return search.yields(h)


@query(
    f"WITH {_SPLIT}, p AS (SELECT code AS pattern, 'image' AS kind, img_query AS query, exclude_terms FROM pattern_dim WHERE harvest_method <> 'Text' UNION ALL SELECT code, 'text', text_terms, exclude_terms FROM pattern_dim WHERE harvest_method <> 'Bild'), "
    f"x AS (SELECT *, {sql_norm('query')} AS key FROM p WHERE query <> '' AND {_guard_sql('query', 'exclude_terms')} = 'ok'), k AS (SELECT DISTINCT {sql_norm('query')} AS key FROM q) "
    "SELECT min(pattern) AS pattern, kind, arg_min(query, pattern) AS query FROM x WHERE key NOT IN (SELECT key FROM k) GROUP BY kind, key"
)
def query_seeding(spark: SparkSession, d: str) -> DataFrame:
    """Queries of the patterns that the history of searches does not hold yet."""
    plain, _ = search.split_negative(F.coalesce("suchquery", F.lit("")))
    return search.seeded(table(spark, d, "pattern_dim"), table(spark, d, "review").select(plain.alias("query")).distinct())


@query(
    f"WITH c AS (SELECT seed_id, {sql_norm('oem')} AS n, {sql_brand('oem')} AS t FROM seed), f AS (SELECT id, {sql_norm('canonical_name')} AS n, {sql_brand('canonical_name')} AS t FROM organization), "
    "e AS (SELECT seed_id, max(id) AS id, 1.0 AS score FROM c JOIN f USING (n) WHERE n <> '' GROUP BY 1), "
    "s AS (SELECT seed_id, min(id) AS id, 0.9 AS score FROM c, f WHERE len(c.n) >= 5 AND len(f.n) >= 5 AND (contains(c.n, f.n) OR contains(f.n, c.n)) AND seed_id NOT IN (SELECT seed_id FROM e) GROUP BY 1), "
    "j AS (SELECT seed_id, id, len(list_intersect(c.t, f.t)) / len(list_distinct(list_concat(c.t, f.t))) AS score FROM c, f WHERE len(c.t) > 0 AND len(f.t) > 0 AND c.n <> '' AND seed_id NOT IN (SELECT seed_id FROM e UNION SELECT seed_id FROM s)), "
    "k AS (SELECT *, row_number() OVER (PARTITION BY seed_id ORDER BY score DESC, id) AS r FROM j WHERE score >= 0.34), u AS (SELECT * FROM e UNION ALL SELECT * FROM s UNION ALL SELECT seed_id, id, score FROM k WHERE r = 1) "
    "SELECT c.seed_id AS cand_id, u.id AS firm_id, CASE WHEN u.id IS NULL THEN 'none' ELSE 'exact' END AS level, coalesce(u.score, 0.0) AS score FROM c LEFT JOIN u USING (seed_id)"
)
def firm_cascade(spark: SparkSession, d: str) -> DataFrame:
    """Seeds against the organisations as a customer list: the stages that SQL can state."""
    return firms.firm_matches(*_firms(spark, d), spelling=False)


def _firms(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    return table(spark, d, "seed").select(F.col("seed_id").alias("cand_id"), F.col("oem").alias("name")), table(spark, d, "organization").select(F.col("id").alias("firm_id"), F.col("canonical_name").alias("name"))


@query()
def firm_cascade_with_spelling(spark: SparkSession, d: str) -> DataFrame:
    """The whole cascade; the ratio of the last stage has no SQL, it is tested against brute force."""
    return firms.firm_matches(*_firms(spark, d))


@query()
def firm_dedup_status(spark: SparkSession, d: str) -> DataFrame:
    """Seeds against the organisations as a customer list whose applications are the segments known of them; tested on
    a fixture, as the ratio of spellings has no SQL."""
    s = table(spark, d, "seed").select(F.col("seed_id").alias("cand_id"), F.col("oem").alias("name"), F.col("segment").alias("application"), F.col("pattern_code").alias("model"))
    known = table(spark, d, "seed").select(T.norm(F.col("oem")).alias("n"), F.col("segment").alias("application")).distinct()
    o = table(spark, d, "organization").select(F.col("id").alias("firm_id"), F.col("canonical_name").alias("name"))
    return firms.dedup_status(s, o.join(known, T.norm(F.col("name")) == known["n"], "left").select("firm_id", "name", "application"))


@query(
    f"WITH n AS (SELECT seed_id, {sql_norm('segment')} AS n FROM seed), p AS (SELECT pattern_id, code, {sql_norm('segment')} AS k FROM pattern_dim) "
    "SELECT seed_id AS id, arg_min(code, pattern_id) AS code FROM n, p WHERE n <> '' AND k <> '' AND (contains(n, k) OR contains(k, n)) GROUP BY 1"
)
def pattern_by_containment(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "pattern_dim").select(F.col("pattern_id").alias("ord"), "code", F.col("segment").alias("key"))
    return firms.contained_pattern(table(spark, d, "seed").select(F.col("seed_id").alias("id"), F.col("segment").alias("name")), p)


@query(
    f"SELECT seed_id, oem, row_no FROM seed WHERE upper(trim(land)) IN ('DE', 'AT', 'CH') AND {_CODE.format('pattern_code')} IS NOT NULL AND coalesce(scope, '') <> 'exclude' "
    f"AND {sql_norm('oem')} NOT IN (SELECT norm_name FROM organization WHERE norm_name IS NOT NULL)"
)
def seeds_to_do(spark: SparkSession, d: str) -> DataFrame:
    """Seeds of the wanted countries with a pattern, not excluded and not yet among the organisations."""
    s = table(spark, d, "seed").where(F.upper(F.trim("land")).isin("DE", "AT", "CH") & T.code_of(F.col("pattern_code")).isNotNull() & (F.coalesce("scope", F.lit("")) != "exclude"))
    done = table(spark, d, "organization").select(F.col("norm_name").alias("k"))
    return s.join(done, T.norm(F.col("oem")) == done["k"], "left_anti").select("seed_id", "oem", "row_no")


@query("SELECT source, doc_id, n FROM (SELECT source, doc_id, row_number() OVER (PARTITION BY source ORDER BY n_chars DESC, doc_id) AS n FROM documents) WHERE n <= 3")
def longest_pages(spark: SparkSession, d: str) -> DataFrame:
    """The three longest pages of each source, numbered (a top-k report)."""
    x = ordered.numbered(table(spark, d, "documents").select("source", "doc_id", "n_chars"), ["source"], [F.desc("n_chars"), "doc_id"])
    return x.where("n <= 3").select("source", "doc_id", "n")


@query("SELECT review_id, split_part(bild_id, '__', 1) AS class, split_part(bild_id, '__', 2) AS org, split_part(bild_id, '__', 3) AS idx FROM review WHERE bild_id IS NOT NULL")
def image_file_groups(spark: SparkSession, d: str) -> DataFrame:
    """Class, organisation and number read from image names of the form class__organisation__number."""
    p = F.split("bild_id", "__")
    return table(spark, d, "review").where("bild_id is not null").select("review_id", *[F.coalesce(F.get(p, i), F.lit("")).alias(n) for i, n in enumerate(("class", "org", "idx"))])


@query("SELECT review_id, len(bild) AS n_images, coalesce(bild[1].url, '') AS first_url FROM review WHERE bild IS NOT NULL")
def review_attachments(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "review").where("bild is not null").select("review_id", F.size("bild").alias("n_images"), F.coalesce(F.get("bild", F.lit(0))["url"], F.lit("")).alias("first_url"))


@query(
    "WITH h AS (SELECT review_id, batch_no, lower(trim(bild_hash)) AS h FROM review WHERE regexp_matches(lower(trim(bild_hash)), '^[0-9a-f]{16}$')), "
    "p AS (SELECT *, lag(review_id) OVER w AS before_id, lag(h) OVER w AS b FROM h WINDOW w AS (PARTITION BY batch_no ORDER BY review_id)) "
    "SELECT review_id, before_id, bit_count(xor(('0x' || substr(h, 1, 8))::BIGINT, ('0x' || substr(b, 1, 8))::BIGINT)) + bit_count(xor(('0x' || substr(h, 9, 8))::BIGINT, ('0x' || substr(b, 9, 8))::BIGINT)) AS bits FROM p"
)
def hash_distances(spark: SparkSession, d: str) -> DataFrame:
    """Bits between the hash of every record and that of the record before it in its batch."""
    h = table(spark, d, "review").where(S.hash_bits(F.col("bild_hash")).isNotNull()).select("review_id", "batch_no", "bild_hash")
    w = Window.partitionBy("batch_no").orderBy("review_id")
    p = h.withColumns({"before_id": F.lag("review_id").over(w), "b": F.lag("bild_hash").over(w)})
    return p.select("review_id", "before_id", S.hamming(F.col("bild_hash"), F.col("b")).alias("bits"))


@query("SELECT event_id, json_extract_string(regexp_extract('reply: ' || props || ' end', '(?s)\\{.*\\}'), '$.k')::INT AS k, coalesce(json_extract_string(props, '$.k')::INT <> 0, true) AS keep FROM events")
def json_in_noise(spark: SparkSession, d: str) -> DataFrame:
    """A field read out of JSON within other text, and its truth with a default."""
    noisy = F.concat(F.lit("reply: "), F.col("props"), F.lit(" end"))
    j = T.json_slice(noisy)
    return table(spark, d, "events").select("event_id", F.try_variant_get(F.try_parse_json(j), "$.k", "int").alias("k"), T.truthy(j, "k", True).alias("keep"))


@query("SELECT event_type, time_bucket(INTERVAL 1 DAY, ts) AS start, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1, 2")
def events_daily(spark: SparkSession, d: str) -> DataFrame:
    """Extension: tumbling windows over the event table."""
    x = table(spark, d, "events").groupBy("event_type", F.window("ts", "1 day").alias("w")).agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 4).alias("total"))
    return x.select("event_type", F.col("w.start").alias("start"), "n", "total")


@query(
    "WITH x AS (SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) >= INTERVAL 30 MINUTE OR lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) IS NULL THEN 1 ELSE 0 END AS s FROM events), "
    "y AS (SELECT *, sum(s) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS g FROM x) SELECT user_id, min(ts) AS start, count(*) AS n FROM y GROUP BY user_id, g"
)
def events_sessions(spark: SparkSession, d: str) -> DataFrame:
    """Extension: sessions of a user with gaps under thirty minutes."""
    x = table(spark, d, "events").groupBy("user_id", F.session_window("ts", "30 minutes").alias("w")).agg(F.count(F.lit(1)).alias("n"))
    return x.select("user_id", F.col("w.start").alias("start"), "n")
