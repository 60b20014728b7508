"""Claims about subjects: corroboration across independent sources, first-wins keys, exports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimloom.functions.address import addresses_agree
from claimloom.functions.text import squeeze
from claimloom.operators.ordered import top_n

IDENTITY = ("lei", "legal_name", "address", "company_number", "vat_valid")


def _about(claims: DataFrame, subject_type: str) -> DataFrame:
    c = claims.where((F.col("subject_type") == subject_type) & F.col("subject_id").isNotNull())
    return c.where("object_value is not null and object_value <> ''").withColumn("source_type", squeeze(F.col("source_type")))


def corroborate(org: DataFrame, claims: DataFrame, predicates: Sequence[str] = IDENTITY) -> DataFrame:
    """``(id, n_sources, n_addresses, address_status, verdict, confidence)`` for every organisation.

    Sources are counted over identity predicates; the first address of every source is set against the others'.
    Confidence rises to min(1, 0.6 + 0.2 n) with two and more sources and to at least 0.5 with one.  Claims are
    reduced to one row a subject and source before anything is paired, so pairs are bounded by the kinds of
    source.  The result does not depend on earlier runs: own claims (source "verify") are left out.
    """
    c = _about(claims, "organization").where("source_type <> 'verify'")
    n = c.where(F.col("predicate").isin(*predicates)).groupBy("subject_id").agg(F.count_distinct("source_type").alias("n_sources"))
    first = c.where("predicate = 'address'").groupBy("subject_id", "source_type").agg(F.min_by("object_value", "id").alias("address"))
    pairs = first.alias("a").join(first.alias("b"), "subject_id").where("a.source_type < b.source_type")
    agree = pairs.groupBy("subject_id").agg(F.max(addresses_agree(F.col("a.address"), F.col("b.address"))).alias("agree"))
    count = first.groupBy("subject_id").agg(F.count(F.lit(1)).alias("n_addresses"))
    x = org.select("id", "confidence").join(n, F.col("id") == n["subject_id"], "left").drop("subject_id")
    x = x.join(count, F.col("id") == count["subject_id"], "left").drop("subject_id").join(agree, F.col("id") == agree["subject_id"], "left").drop("subject_id")
    ns, na = F.coalesce("n_sources", F.lit(0)), F.coalesce("n_addresses", F.lit(0))
    return x.select(
        "id",
        ns.alias("n_sources"),
        na.alias("n_addresses"),
        F.when(na < 2, "few").when(F.col("agree"), "verified").otherwise("conflict").alias("address_status"),
        F.when(ns >= 2, "verified").when(ns == 1, "single source").otherwise("unconfirmed").alias("verdict"),
        F.when(ns >= 2, F.least(F.lit(1.0), 0.6 + 0.2 * ns)).when(ns == 1, F.greatest("confidence", F.lit(0.5))).otherwise(F.col("confidence")).alias("confidence"),
    )


def corroboration_stats(result: DataFrame) -> DataFrame:
    """The counters of a corroboration run, one row."""
    s = F.col("address_status")
    return result.agg(
        F.count(F.lit(1)).alias("orgs"),
        F.count_if(F.col("n_addresses") >= 2).alias("two_addresses"),
        F.count_if(s == "verified").alias("address_verified"),
        F.count_if(s == "conflict").alias("address_conflict"),
        F.count_if(F.col("verdict") == "verified").alias("id_verified"),
        F.count_if(F.col("verdict") == "single source").alias("single_source"),
        F.count_if(F.col("verdict") == "unconfirmed").alias("unconfirmed"),
    )


def fill_from_claims(org: DataFrame, claims: DataFrame, columns: Sequence[str] = ("lei", "domain", "address")) -> DataFrame:
    """``org`` with empty columns filled from the first claim (by id) of the predicate of that name."""
    c = _about(claims, "organization").where(F.col("predicate").isin(*columns))
    first = c.groupBy("subject_id").agg(*[F.min_by("object_value", F.when(F.col("predicate") == k, F.col("id"))).alias(f"_f_{k}") for k in columns])
    j = org.join(first, org["id"] == first["subject_id"], "left")
    return j.withColumns({k: F.coalesce(F.nullif(F.col(k), F.lit("")), F.col(f"_f_{k}")) for k in columns}).select(*org.columns)


def first_claims(claims: DataFrame, n: int = 6, name: str = "claims") -> DataFrame:
    """``(subject_id, claims)``: the first ``n`` claims of each organisation as ``pred=val[src]`` joined by "; "."""
    c = claims.where("subject_type = 'organization' and subject_id is not null")
    piece = F.concat(F.col("predicate"), F.lit("="), F.coalesce("object_value", F.lit("")), F.lit("["), F.coalesce("source_type", F.lit("")), F.lit("]"))
    few = top_n(c.select("subject_id", "id", F.coalesce(piece, F.lit("")).alias("p")), ["subject_id"], ["id"], n)
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("id", "p"))), lambda s: s["p"])
    return few.groupBy("subject_id").agg(F.array_join(ordered, "; ").alias(name))


def register_claims(payload: Column, spec: Sequence[tuple[str, str, float]], source: str) -> Column:
    """Array of claim structs out of a JSON payload: for each ``(predicate, JSON path, confidence)`` whose path
    holds something one claim.  Unreadable payloads give an empty array."""
    v = F.try_parse_json(payload)
    one = lambda p, path, c: F.struct(
        F.lit(p).alias("predicate"), F.try_variant_get(v, path, "string").alias("value"), F.lit(source).alias("source_type"), F.lit(c).alias("confidence")
    )
    return F.filter(F.array(*[one(*s) for s in spec]), lambda x: x["value"].isNotNull() & (x["value"] != ""))
