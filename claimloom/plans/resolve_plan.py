"""Queries on names, entity resolution and claims."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimloom.functions import address as A
from claimloom.functions import text as T
from claimloom.operators import claims as C
from claimloom.operators import imports
from claimloom.operators import ordered
from claimloom.operators import resolve as R
from claimloom.plans.catalog import query
from claimloom.plans.sources_plan import table
from claimloom.session import materialize

PH = "(" + ", ".join("'" + p.replace("'", "''") + "'" for p in T.PLACEHOLDERS) + ")"
_WS = r"[\s\x{00A0}\x{0085}\x{200B}\x{FEFF}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+"


def sql_norm(c: str) -> str:
    return f"trim(regexp_replace(lower(coalesce({c}, '')), '{_WS}', ' ', 'g'))"


def sql_filled(c: str) -> str:
    return f"CASE WHEN {sql_norm(c)} NOT IN {PH} THEN trim({c}) END"


def sql_brand(c: str) -> str:
    forms = "|".join(T.BRAND_FORMS)
    n = rf"regexp_replace(regexp_replace({sql_norm(c)}, '\b({forms})\b', '', 'g'), '\(.*?\)', '', 'g')"
    return f"list_sort(list_distinct(list_filter(regexp_split_to_array({n}, '[^a-z0-9]+'), lambda t: len(t) >= 3)))"


def _joined(c):
    return F.array_join(F.array_sort(c), ",")


@query(f"SELECT id, {sql_norm('canonical_name')} AS norm_name, array_to_string({sql_brand('canonical_name')}, ',') AS tokens FROM organization")
def name_brand_tokens(spark: SparkSession, d: str) -> DataFrame:
    n = F.col("canonical_name")
    return table(spark, d, "organization").select("id", T.norm(n).alias("norm_name"), _joined(T.brand_tokens(n)).alias("tokens"))


@query(
    "WITH x AS (SELECT entry_id, lower(replace(regexp_replace(coalesce(legal_name, ''), '\\(.*?\\)', ' ', 'g'), '&', ' ')) AS s FROM register_entry), "
    rf"y AS (SELECT entry_id, regexp_replace(regexp_replace(s, '\b({'|'.join(T.REGISTER_FORMS)})\b\.?', ' ', 'g'), '[^a-z0-9äöüß ]+', ' ', 'g') AS s FROM x) "
    "SELECT entry_id, array_to_string(list_sort(list_distinct(list_filter(regexp_split_to_array(s, ' +'), lambda t: len(t) >= 3))), ',') AS tokens FROM y"
)
def name_register_tokens(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "register_entry").select("entry_id", _joined(T.register_tokens(F.col("legal_name"))).alias("tokens"))


_MAKER = f"array_to_string(list_filter(regexp_split_to_array(replace(lower(coalesce(oem, '')), '.', ''), '[^a-z0-9]+'), lambda t: t <> '' AND t NOT IN ({', '.join(repr(w) for w in T.MAKER_NOISE)})), ' ')"
_KEYED = (
    f"SELECT *, {_MAKER} AS o, regexp_replace(lower(coalesce(pattern_code, '')), '[^a-z0-9]+', '', 'g') AS m FROM seed"
)


@query(f"WITH x AS ({_KEYED}) SELECT seed_id, CASE WHEN o = '' THEN '' WHEN m <> '' THEN split_part(o, ' ', 1) ELSE o END AS k1, CASE WHEN o = '' THEN '' ELSE m END AS k2 FROM x")
def entity_keys(spark: SparkSession, d: str) -> DataFrame:
    k = T.entity_key(F.col("oem"), F.col("pattern_code"))
    return table(spark, d, "seed").select("seed_id", k.alias("k")).select("seed_id", "k.k1", "k.k2")


@query(
    f"WITH x AS ({_KEYED}), y AS (SELECT *, CASE WHEN o = '' THEN '' WHEN m <> '' THEN split_part(o, ' ', 1) ELSE o END AS k1, CASE WHEN o = '' THEN '' ELSE m END AS k2 FROM x), "
    "z AS (SELECT seed_id, k1, row_number() OVER (PARTITION BY k1, k2 ORDER BY (domain IS NOT NULL AND trim(domain) <> '') DESC, (land IS NOT NULL) DESC, seed_id) AS n FROM y) "
    "SELECT seed_id, k1 <> '' AND n > 1 AS is_duplicate FROM z"
)
def entity_duplicates(spark: SparkSession, d: str) -> DataFrame:
    """Seeds flagged but for the best filled one of each (maker, model); the earliest of equals stays."""
    k = T.entity_key(F.col("oem"), F.col("pattern_code"))
    x = table(spark, d, "seed").select("seed_id", k["k1"].alias("k1"), k["k2"].alias("k2"), (F.coalesce(F.trim("domain"), F.lit("")) != "").alias("has_domain"), F.col("land").isNotNull().alias("has_land"))
    return ordered.mark_duplicates(x, ["k1", "k2"], [~F.col("has_domain"), ~F.col("has_land"), F.col("seed_id")]).select("seed_id", "is_duplicate")


@query("SELECT seed_id, trim(regexp_replace(regexp_replace(" + sql_norm("segment") + ", '[^a-z0-9äöüß ]+', ' ', 'g'), ' +', ' ', 'g')) AS application FROM seed")
def application_names(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "seed").select("seed_id", T.application(F.col("segment")).alias("application"))


@query("SELECT id, TRY_CAST(replace(regexp_extract(object_value, '[-+]?\\d+(?:[.,]\\d+)?'), ',', '.') AS DOUBLE) AS number FROM claim WHERE object_value IS NOT NULL")
def numbers_in_claims(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "claim").where("object_value is not null").select("id", T.number_in(F.col("object_value")).alias("number"))


@query("SELECT seed_id, left(regexp_replace(coalesce(oem, ''), '[^A-Za-z0-9]+', '_', 'g'), 60) AS token FROM seed")
def safe_file_tokens(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "seed").select("seed_id", T.safe_token(F.col("oem")).alias("token"))


@query(
    "WITH a AS (SELECT id, k, row_number() OVER (PARTITION BY id ORDER BY r) AS n, org FROM (SELECT x.id, 1 AS r, 'lei' AS k, min(o.id) AS org FROM organization x JOIN organization o ON "
    f"{sql_filled('x.lei')} = {sql_filled('o.lei')} GROUP BY x.id UNION ALL SELECT x.id, 2, 'vat', min(o.id) FROM organization x JOIN organization o ON {sql_filled('x.vat')} = {sql_filled('o.vat')} GROUP BY x.id "
    f"UNION ALL SELECT x.id, 3, 'hr_number', min(o.id) FROM organization x JOIN organization o ON {sql_filled('x.hr_number')} = {sql_filled('o.hr_number')} GROUP BY x.id)) "
    "SELECT id AS new_id, org AS org_id, k AS key FROM a WHERE n = 1"
)
def er_strong_keys(spark: SparkSession, d: str) -> DataFrame:
    """Every organisation row's first row with an equal strong key, keys tried in order."""
    o = table(spark, d, "organization")
    return R.strong_matches(o.select(F.col("id").alias("new_id"), *R.STRONG_KEYS), o)


@query(
    f"SELECT s.seed_id AS new_id, min(o.id) AS org_id FROM seed s JOIN organization o ON o.norm_name = {sql_norm('s.oem')} WHERE s.land IS NULL OR o.country IS NULL OR s.land = o.country GROUP BY 1"
)
def er_exact_names(spark: SparkSession, d: str) -> DataFrame:
    new = table(spark, d, "seed").select(F.col("seed_id").alias("new_id"), F.col("oem").alias("name"), F.col("land").alias("country"))
    return R.name_matches(new, table(spark, d, "organization"))


_WEAK = (
    f"n AS (SELECT seed_id, {sql_norm('oem')} AS ln, {sql_brand('oem')} AS lt FROM seed), o AS (SELECT id, coalesce(norm_name, {sql_norm('canonical_name')}) AS rn, {sql_brand('canonical_name')} AS rt FROM organization), "
    "p AS (SELECT seed_id, id, 'substring' AS tier, 0 AS t, least(len(ln), len(rn)) / greatest(len(ln), len(rn)) AS score FROM n, o WHERE len(ln) >= 5 AND len(rn) >= 5 AND (contains(ln, rn) OR contains(rn, ln)) "
    "UNION ALL SELECT seed_id, id, 'brand', 1, len(list_intersect(lt, rt)) / len(list_distinct(list_concat(lt, rt))) FROM n, o WHERE len(lt) > 0 AND len(rt) > 0 AND len(list_intersect(lt, rt)) / len(list_distinct(list_concat(lt, rt))) >= 0.34), "
    "w AS (SELECT *, row_number() OVER (PARTITION BY seed_id ORDER BY score DESC, id, t) AS k FROM p)"
)


@query(f"WITH {_WEAK} SELECT seed_id AS new_id, id AS org_id, tier, score FROM w WHERE k = 1")
def er_weak_candidates(spark: SparkSession, d: str) -> DataFrame:
    """The best weak candidate of each seed, by containment or brand tokens."""
    return R.weak_matches(table(spark, d, "seed").select(F.col("seed_id").alias("new_id"), F.col("oem").alias("name")), table(spark, d, "organization"))


@query(
    f"WITH {_WEAK}, e AS (SELECT s.seed_id, min(o.id) AS id FROM seed s JOIN organization o ON o.norm_name = {sql_norm('s.oem')} WHERE s.land IS NULL OR o.country IS NULL OR s.land = o.country GROUP BY 1) "
    "SELECT s.seed_id AS new_id, coalesce(e.id, w.id) AS org_id, CASE WHEN e.id IS NOT NULL THEN 'norm' ELSE coalesce(w.tier, 'none') END AS tier, CASE WHEN e.id IS NOT NULL THEN 1.0 ELSE coalesce(w.score, 0.0) END AS score "
    "FROM seed s LEFT JOIN e USING (seed_id) LEFT JOIN (SELECT * FROM w WHERE k = 1) w USING (seed_id)"
)
def er_classify(spark: SparkSession, d: str) -> DataFrame:
    new = table(spark, d, "seed").select(F.col("seed_id").alias("new_id"), F.col("oem").alias("name"), F.col("land").alias("country"))
    return R.classify(new, table(spark, d, "organization"))


@query(
    f"WITH x AS (SELECT seed_id, row_no, {sql_norm('oem')} AS n, land AS c FROM seed), f AS (SELECT n, min(row_no) AS first, arg_min(coalesce(c, chr(0)), row_no) AS fc FROM x GROUP BY n), "
    "o AS (SELECT n, c, min(row_no) AS own FROM x WHERE c IS NOT NULL GROUP BY n, c) "
    "SELECT x.row_no AS ord, CASE WHEN x.c IS NULL OR fc = chr(0) THEN first ELSE own END AS target, CASE WHEN x.row_no = CASE WHEN x.c IS NULL OR fc = chr(0) THEN first ELSE own END THEN 'created' ELSE 'merged-norm' END AS outcome "
    "FROM x JOIN f USING (n) LEFT JOIN o ON o.n = x.n AND o.c = x.c"
)
def er_import_fold(spark: SparkSession, d: str) -> DataFrame:
    """Seeds of one import resolved by name against those before them."""
    return R.batch_names(table(spark, d, "seed").select(F.col("row_no").cast("bigint").alias("ord"), F.col("oem").alias("name"), F.col("land").alias("country")))


def _sql_pass(src: str, key: str) -> str:
    fill = ("domain", "address", "vat", "hr_number", "lei")
    cols = ", ".join(f"arg_min({c}, id) FILTER (WHERE {c} IS NOT NULL) AS {c}" for c in fill)
    return f"SELECT min(id) AS id, {cols}, arg_min(canonical_name, id) AS canonical_name FROM {src} GROUP BY coalesce('k' || {key}, 'i' || id)"


_MERGED = (
    "a AS (SELECT id, canonical_name, " + ", ".join(f"{sql_filled(c)} AS {c}" for c in ("domain", "address", "vat", "hr_number", "lei")) + " FROM organization), "
    f"b AS ({_sql_pass('a', 'lei')}), c AS ({_sql_pass('b', 'vat')}), e AS ({_sql_pass('c', 'hr_number')})"
)


@query(f"WITH {_MERGED} SELECT id, canonical_name, domain, address, vat, hr_number, lei FROM e")
def er_merged_organizations(spark: SparkSession, d: str) -> DataFrame:
    cols = ["id", "canonical_name", "domain", "address", "vat", "hr_number", "lei"]
    return R.merge_by_keys(table(spark, d, "organization").select(*cols))[0]


@query(
    f"WITH {_MERGED}, m1 AS (SELECT id, min(id) OVER (PARTITION BY coalesce('k' || lei, 'i' || id)) AS s FROM a), m2 AS (SELECT id, min(id) OVER (PARTITION BY coalesce('k' || vat, 'i' || id)) AS s FROM b), "
    "m3 AS (SELECT id, min(id) OVER (PARTITION BY coalesce('k' || hr_number, 'i' || id)) AS s FROM c) SELECT m1.id, m3.s AS survivor_id FROM m1 JOIN m2 ON m1.s = m2.id JOIN m3 ON m2.s = m3.id"
)
def er_merge_map(spark: SparkSession, d: str) -> DataFrame:
    cols = ["id", "canonical_name", "domain", "address", "vat", "hr_number", "lei"]
    return R.merge_by_keys(table(spark, d, "organization").select(*cols))[1]


@query(
    f"WITH {_MERGED}, m1 AS (SELECT id, min(id) OVER (PARTITION BY coalesce('k' || lei, 'i' || id)) AS s FROM a), m2 AS (SELECT id, min(id) OVER (PARTITION BY coalesce('k' || vat, 'i' || id)) AS s FROM b), "
    "m3 AS (SELECT id, min(id) OVER (PARTITION BY coalesce('k' || hr_number, 'i' || id)) AS s FROM c), m AS (SELECT m1.id, m3.s FROM m1 JOIN m2 ON m1.s = m2.id JOIN m3 ON m2.s = m3.id) "
    "SELECT coalesce(m.s, claim.subject_id) AS subject_id, count(*) AS n FROM claim LEFT JOIN m ON m.id = claim.subject_id WHERE subject_type = 'organization' GROUP BY 1"
)
def er_repointed_claims(spark: SparkSession, d: str) -> DataFrame:
    cols = ["id", "canonical_name", "domain", "address", "vat", "hr_number", "lei"]
    m = R.merge_by_keys(table(spark, d, "organization").select(*cols))[1]
    c = table(spark, d, "claim").where("subject_type = 'organization'").select("subject_id")
    return R.repoint(c, "subject_id", m).groupBy("subject_id").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT lei, count(*) AS n FROM organization WHERE lei IS NOT NULL GROUP BY lei HAVING count(*) > 1")
def keys_used_twice(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "organization").where("lei is not null").groupBy("lei").agg(F.count(F.lit(1)).alias("n")).where("n > 1")


_C = f"c AS (SELECT id, subject_id, predicate, object_value, {sql_norm('source_type')} AS st FROM claim WHERE subject_type = 'organization' AND object_value IS NOT NULL AND object_value <> '')"
_PLZ = r"nullif(regexp_extract({0}, '\b(\d{{4,5}})\b', 1), '')"
_PLACE = r"list_distinct(list_filter(regexp_split_to_array(regexp_replace(lower({0}), '[^a-zäöüß ]', ' ', 'g'), ' +'), lambda t: len(t) >= 4))"
_AGREE = (
    f"CASE WHEN {_PLZ.format('a.v')} IS NOT NULL AND {_PLZ.format('b.v')} IS NOT NULL THEN {_PLZ.format('a.v')} = {_PLZ.format('b.v')} "
    f"ELSE len({_PLACE.format('a.v')}) > 0 AND len({_PLACE.format('b.v')}) > 0 AND len(list_intersect({_PLACE.format('a.v')}, {_PLACE.format('b.v')})) / len(list_distinct(list_concat({_PLACE.format('a.v')}, {_PLACE.format('b.v')}))) >= 0.3 END"
)
_VERIFY = (
    f"WITH {_C}, n AS (SELECT subject_id, count(DISTINCT st) AS ns FROM c WHERE predicate IN ('lei', 'legal_name', 'address', 'company_number', 'vat_valid') GROUP BY 1), "
    "f AS (SELECT subject_id, st, arg_min(object_value, id) AS v FROM c WHERE predicate = 'address' GROUP BY 1, 2), k AS (SELECT subject_id, count(*) AS na FROM f GROUP BY 1), "
    f"g AS (SELECT a.subject_id, bool_or({_AGREE}) AS agree FROM f a JOIN f b ON a.subject_id = b.subject_id AND a.st < b.st GROUP BY 1), "
    "r AS (SELECT o.id, coalesce(ns, 0) AS n_sources, coalesce(na, 0) AS n_addresses, CASE WHEN coalesce(na, 0) < 2 THEN 'few' WHEN agree THEN 'verified' ELSE 'conflict' END AS address_status, "
    "CASE WHEN coalesce(ns, 0) >= 2 THEN 'verified' WHEN ns = 1 THEN 'single source' ELSE 'unconfirmed' END AS verdict, "
    "CASE WHEN coalesce(ns, 0) >= 2 THEN least(1.0, 0.6 + 0.2 * ns) WHEN ns = 1 THEN greatest(confidence, 0.5) ELSE confidence END AS confidence "
    "FROM organization o LEFT JOIN n ON o.id = n.subject_id LEFT JOIN k ON o.id = k.subject_id LEFT JOIN g ON o.id = g.subject_id) "
)


@query(_VERIFY + "SELECT * FROM r")
def claims_corroboration(spark: SparkSession, d: str) -> DataFrame:
    return C.corroborate(table(spark, d, "organization"), table(spark, d, "claim"))


@query(
    _VERIFY + "SELECT count(*) AS orgs, count_if(n_addresses >= 2) AS two_addresses, count_if(address_status = 'verified') AS address_verified, count_if(address_status = 'conflict') AS address_conflict, "
    "count_if(verdict = 'verified') AS id_verified, count_if(verdict = 'single source') AS single_source, count_if(verdict = 'unconfirmed') AS unconfirmed FROM r"
)
def claims_corroboration_stats(spark: SparkSession, d: str) -> DataFrame:
    return C.corroboration_stats(claims_corroboration(spark, d))


@query(
    f"WITH {_C} SELECT o.id, coalesce(nullif(o.lei, ''), arg_min(c.object_value, c.id) FILTER (WHERE predicate = 'lei')) AS lei, coalesce(nullif(o.domain, ''), arg_min(c.object_value, c.id) FILTER (WHERE predicate = 'domain')) AS domain, "
    "coalesce(nullif(o.address, ''), arg_min(c.object_value, c.id) FILTER (WHERE predicate = 'address')) AS address FROM organization o LEFT JOIN c ON c.subject_id = o.id GROUP BY o.id, o.lei, o.domain, o.address"
)
def claims_fill_keys(spark: SparkSession, d: str) -> DataFrame:
    return C.fill_from_claims(table(spark, d, "organization").select("id", "lei", "domain", "address"), table(spark, d, "claim"))


_SIX = (
    "x AS (SELECT subject_id, id, coalesce(predicate || '=' || coalesce(object_value, '') || '[' || coalesce(source_type, '') || ']', '') AS p, row_number() OVER (PARTITION BY subject_id ORDER BY id) AS n FROM claim WHERE subject_type = 'organization'), "
    "s AS (SELECT subject_id, string_agg(p, '; ' ORDER BY id) AS claims FROM x WHERE n <= 6 GROUP BY subject_id)"
)


@query(f"WITH {_SIX} SELECT subject_id, claims FROM s")
def claims_first_six(spark: SparkSession, d: str) -> DataFrame:
    return C.first_claims(table(spark, d, "claim"))


@query(
    f"WITH {_SIX}, m AS (SELECT {sql_norm('oem')} AS n, arg_min(segment, seed_id) AS model FROM seed GROUP BY 1) "
    "SELECT row_number() OVER (ORDER BY o.id) AS n, o.id, o.canonical_name, m.model, s.claims FROM organization o LEFT JOIN s ON s.subject_id = o.id LEFT JOIN m ON m.n = o.norm_name"
)
def export_master_view(spark: SparkSession, d: str) -> DataFrame:
    """One numbered row an organisation with its first model and first claims (no query per row)."""
    o = table(spark, d, "organization").select("id", "canonical_name", "norm_name")
    model = table(spark, d, "seed").groupBy(T.norm(F.col("oem")).alias("norm_name")).agg(F.min_by("segment", F.when(F.col("segment").isNotNull(), F.col("seed_id"))).alias("model"))
    c = C.first_claims(table(spark, d, "claim")).withColumnRenamed("subject_id", "id")
    x = o.join(model, "norm_name", "left").join(c, "id", "left")
    # numbers by rank of the id: counts of earlier ids per range, so no single task sorts the whole table
    return _global_number(x, "id").select("n", "id", "canonical_name", "model", "claims")


def _global_number(df: DataFrame, key: str) -> DataFrame:
    """Running number over a whole table by a unique bigint key: ranks within blocks of keys plus block offsets."""
    from pyspark.sql import Window

    b = df.withColumn("_b", F.floor(F.col(key) / 4096))
    size = b.groupBy("_b").agg(F.count(F.lit(1)).alias("_c"))
    coarse = size.withColumn("_s", F.floor(F.col("_b") / 4096))
    upper = coarse.groupBy("_s").agg(F.sum("_c").alias("_cs"))
    off_s = upper.withColumn("_os", F.coalesce(F.sum("_cs").over(Window.orderBy("_s").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).select("_s", "_os")
    off = coarse.withColumn("_ob", F.coalesce(F.sum("_c").over(Window.partitionBy("_s").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).join(off_s, "_s").select("_b", (F.col("_ob") + F.col("_os")).alias("_o"))
    return b.withColumn("_r", F.row_number().over(Window.partitionBy("_b").orderBy(key))).join(off, "_b").withColumn("n", F.col("_o") + F.col("_r"))


@query(
    f"WITH {_WEAK} SELECT s.oem AS new_name, o.canonical_name AS matched_name, w.tier, round(w.score, 2) AS score, w.seed_id FROM w JOIN seed s USING (seed_id) JOIN organization o ON o.id = w.id WHERE k = 1"
)
def export_merge_review(spark: SparkSession, d: str) -> DataFrame:
    """The weak candidates with their names, best first."""
    # written before it is sorted: the sort looks for its ranges in a run of its own
    w = materialize(er_weak_candidates(spark, d), "weak")
    s = table(spark, d, "seed").select(F.col("seed_id").alias("new_id"), F.col("oem").alias("new_name"))
    o = table(spark, d, "organization").select(F.col("id").alias("org_id"), F.col("canonical_name").alias("matched_name"))
    # the product is rounded, as in SQL: 23 / 40 * 100 is a little less than 57.5
    score = (F.round(F.col("score") * 100) / 100).alias("score")
    return w.join(s, "new_id").join(o, "org_id").select("new_name", "matched_name", "tier", score, F.col("new_id").alias("seed_id")).orderBy(F.desc("score"), "seed_id")


@query(
    f"SELECT o.id, e.entry_id, {_AGREE.replace('a.v', 'o.address').replace('b.v', 'e.address_lines')} AS agree FROM organization o JOIN register_entry e ON o.norm_name = {sql_norm('e.legal_name')} WHERE o.address IS NOT NULL AND e.address_lines IS NOT NULL"
)
def address_agreement(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "organization").where("address is not null").select("id", "norm_name", "address")
    e = table(spark, d, "register_entry").where("address_lines is not null").select("entry_id", T.norm(F.col("legal_name")).alias("norm_name"), "address_lines")
    return o.join(e, "norm_name").select("id", "entry_id", A.addresses_agree(F.col("address"), F.col("address_lines")).alias("agree"))


@query("SELECT (SELECT count(*) FROM organization) AS orgs, (SELECT count(lei) FROM organization) AS with_lei, (SELECT count(*) FROM claim) AS claims, (SELECT count(*) FROM seed) AS seeds")
def table_counts(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "organization").agg(F.count(F.lit(1)).alias("orgs"), F.count("lei").alias("with_lei"))
    c = table(spark, d, "claim").agg(F.count(F.lit(1)).alias("claims"))
    return o.join(c, F.lit(True)).join(table(spark, d, "seed").agg(F.count(F.lit(1)).alias("seeds")), F.lit(True))


_REG = r"""list_sort(list_distinct(list_filter(regexp_split_to_array(regexp_replace(regexp_replace(lower(replace(regexp_replace(coalesce({0}, ''), '\(.*?\)', ' ', 'g'), '&', ' ')), '\b({1})\b\.?', ' ', 'g'), '[^a-z0-9äöüß ]+', ' ', 'g'), ' +'), lambda t: len(t) >= 3)))"""


def _reg(c: str) -> str:
    return _REG.format(c, "|".join(T.REGISTER_FORMS))


@query(
    f"WITH l AS (SELECT id, {_reg('canonical_name')} AS t, country AS c FROM organization), r AS (SELECT entry_id, {_reg('legal_name')} AS t, country AS c FROM register_entry), "
    "j AS (SELECT id, entry_id, len(list_intersect(l.t, r.t)) / len(list_distinct(list_concat(l.t, r.t))) AS score FROM l, r WHERE len(l.t) > 0 AND len(r.t) > 0 AND (l.c IS NULL OR r.c IS NULL OR l.c = r.c)), "
    "k AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY score DESC, entry_id) AS n FROM j WHERE score >= 0.6) SELECT id, entry_id, score FROM k WHERE n = 1"
)
def register_best_hits(spark: SparkSession, d: str) -> DataFrame:
    """For every organisation the register's entry with the most similar name, guarded by the country."""
    o = table(spark, d, "organization").select("id", F.col("canonical_name").alias("name"), "country")
    return imports.best_register_hits(o, table(spark, d, "register_entry").select("entry_id", "legal_name", "country"))


_IMPORT = (
    f"s AS (SELECT seed_id AS ord, oem AS name, land AS c, {sql_norm('oem')} AS n, {sql_brand('oem')} AS t FROM seed), o AS (SELECT id, coalesce(norm_name, {sql_norm('canonical_name')}) AS n, norm_name AS nn, country AS c, {sql_brand('canonical_name')} AS t FROM organization), "
    "k AS (SELECT ord, min(id) AS m FROM s JOIN o ON s.n = o.nn WHERE s.c IS NULL OR o.c IS NULL OR s.c = o.c GROUP BY ord), "
    "x AS (SELECT * FROM s WHERE ord NOT IN (SELECT ord FROM k)), f AS (SELECT n, min(ord) AS first, arg_min(coalesce(c, '<none>'), ord) AS fc FROM x GROUP BY n), w AS (SELECT n, c, min(ord) AS own FROM x WHERE c IS NOT NULL GROUP BY n, c), "
    "b AS (SELECT x.*, CASE WHEN x.c IS NULL OR f.fc = '<none>' THEN f.first ELSE w.own END AS target FROM x JOIN f USING (n) LEFT JOIN w ON x.n = w.n AND x.c = w.c), "
    "made AS (SELECT * FROM b WHERE target = ord), old AS (SELECT id AS r, -1 AS since, n, t FROM o UNION ALL SELECT -ord - 1, ord, n, t FROM made), "
    "p AS (SELECT a.ord, r, since, 'substring' AS tier, 0 AS tk, least(len(a.n), len(z.n)) / greatest(len(a.n), len(z.n)) AS score FROM made a JOIN old z ON since < a.ord WHERE len(a.n) >= 5 AND len(z.n) >= 5 AND (contains(a.n, z.n) OR contains(z.n, a.n)) "
    "UNION ALL SELECT a.ord, r, since, 'brand', 1, len(list_intersect(a.t, z.t)) / len(list_distinct(list_concat(a.t, z.t))) FROM made a JOIN old z ON since < a.ord WHERE len(a.t) > 0 AND len(z.t) > 0 AND len(list_intersect(a.t, z.t)) / len(list_distinct(list_concat(a.t, z.t))) >= 0.34), "
    "q AS (SELECT *, row_number() OVER (PARTITION BY ord ORDER BY score DESC, since, r, tk) AS g FROM p)"
)


@query(
    f"WITH {_IMPORT} SELECT ord, 'merged-norm' AS outcome, m AS matched, 'norm' AS tier, 1.0 AS score FROM k UNION ALL SELECT ord, 'merged-norm', -target - 1, 'norm', 1.0 FROM b WHERE target <> ord "
    "UNION ALL SELECT made.ord, CASE WHEN r IS NULL THEN 'created' ELSE 'review' END, r, coalesce(tier, 'none'), coalesce(score, 0.0) FROM made LEFT JOIN q ON made.ord = q.ord AND g = 1"
)
def er_import_outcomes(spark: SparkSession, d: str) -> DataFrame:
    """The seeds imported in order into the organisations: merged, created or created with a row for review."""
    s = table(spark, d, "seed").select(F.col("seed_id").alias("ord"), F.col("oem").alias("name"), F.col("land").alias("country"))
    return imports.import_outcomes(s, table(spark, d, "organization"))
