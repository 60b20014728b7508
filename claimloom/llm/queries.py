"""The queries of the eight problems, each over its whole tables with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from claimloom.llm import contamination, incremental, linkage, mapping, packing, readability, survivor, variants

Query = Callable[[SparkSession, str], DataFrame]


def _t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return incremental.repeated_pictures(_t(spark, d, "review"))


def p1_hash_neighbours(spark: SparkSession, d: str) -> DataFrame:
    return incremental.near_pictures(_t(spark, d, "review"))


def p4_matches(spark: SparkSession, d: str) -> DataFrame:
    return linkage.match_companies(_t(spark, d, "organization"), _t(spark, d, "register_entry"))


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return p4_matches(spark, d).select("org_id", "entry_id")


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return survivor.survivors(_t(spark, d, "organization"), _t(spark, d, "claim"), _t(spark, d, "source_trust"))


def p5_golden_records(spark: SparkSession, d: str) -> DataFrame:
    return survivor.golden_records(_t(spark, d, "organization"), _t(spark, d, "claim"), _t(spark, d, "source_trust"))


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return variants.link_variants(_t(spark, d, "seed"), _t(spark, d, "organization"))


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return mapping.typed_verdicts_and_predicates(*(_t(spark, d, t) for t in ("review", "claim", "verdikt_list", "predicate_list")))


def p6_assignment(spark: SparkSession, d: str) -> DataFrame:
    return packing.assign(packing.count_tokens(_t(spark, d, "documents")), _t(spark, d, "container_kind"))


def p6_container_report(spark: SparkSession, d: str) -> DataFrame:
    return packing.container_report(p6_assignment(spark, d), _t(spark, d, "container_kind"))


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    return contamination.leaked_items(_t(spark, d, "documents"), _t(spark, d, "eval_item"))


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    return readability.reading_levels(_t(spark, d, "documents"), _t(spark, d, "reading_label"))


def p8_profile(spark: SparkSession, d: str) -> DataFrame:
    return readability.level_profile(p8_found(spark, d), _t(spark, d, "documents"))


_ALL: tuple[Query, ...] = (
    p1_found, p1_hash_neighbours, p2_found, p3_found, p4_found, p4_matches, p5_found, p5_golden_records, p6_assignment, p6_container_report, p7_found, p8_found, p8_profile,
)


def queries() -> dict[str, Query]:
    return {f.__name__: f for f in _ALL}


def oracle_sql() -> dict[str, str]:
    """SQL for the problems that SQL can state; the others are tested against brute force in tests/llm."""
    return {"p5_found": P5_SQL}


#: Components by repeated minimum, as a recursive query over the groups of equal keys.
P5_SQL = r"""
WITH RECURSIVE
k AS (
  SELECT id, 'l' || regexp_replace(upper(lei), '[^0-9A-Z]', '', 'g') AS key FROM organization
  WHERE lower(trim(lei)) NOT IN ('', '-', '--', '?', 'n/a', 'na', 'n.a.', 'k.a.', 'ka', 'none', 'null', 'nil', 'unbekannt', 'tbd', 'xxx', 'keine angabe', 'entfällt')
  UNION ALL
  SELECT id, 'v' || regexp_replace(upper(vat), '[^0-9A-Z]', '', 'g') FROM organization
  WHERE lower(trim(vat)) NOT IN ('', '-', '--', '?', 'n/a', 'na', 'n.a.', 'k.a.', 'ka', 'none', 'null', 'nil', 'unbekannt', 'tbd', 'xxx', 'keine angabe', 'entfällt')
),
e AS (SELECT DISTINCT a.id AS x, b.id AS y FROM k a JOIN k b USING (key) WHERE a.id <> b.id),
r(x, y) AS (SELECT x, y FROM e UNION SELECT r.x, e.y FROM r JOIN e ON r.y = e.x),
g AS (SELECT x AS id, least(x, min(y)) AS first_id FROM r GROUP BY x),
t AS (
  SELECT subject_id AS id, max(trust) AS trust FROM claim JOIN source_trust s ON lower(trim(claim.source_type)) = s.source_type
  WHERE subject_type = 'organization' GROUP BY subject_id
),
s AS (
  SELECT g.first_id, o.id,
    (SELECT count(*) FROM (VALUES (lei), (vat), (hr_number), (country), (domain), (address), (status)) v(c)
     WHERE lower(trim(c)) NOT IN ('', '-', '--', '?', 'n/a', 'na', 'n.a.', 'k.a.', 'ka', 'none', 'null', 'nil', 'unbekannt', 'tbd', 'xxx', 'keine angabe', 'entfällt')) AS n,
    coalesce(confidence, -1) AS c, coalesce(last_verified, TIMESTAMP '0001-01-01') AS v, coalesce(trust, -1) AS t
  FROM organization o JOIN g USING (id) LEFT JOIN t USING (id)
),
m AS (SELECT first_id, max(n) AS n, max(c) AS c, max(v) AS v, max(t) AS t FROM s GROUP BY first_id)
SELECT s.first_id, min(s.id) AS survivor_id FROM s JOIN m USING (first_id) WHERE s.n = m.n AND s.c = m.c AND s.v = m.v AND s.t = m.t GROUP BY s.first_id
"""
