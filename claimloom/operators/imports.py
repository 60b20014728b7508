"""Import of typed rows into the organisations, review decisions, and enrichment from registers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimloom.functions.text import brand_tokens, norm, register_tokens, value_or_null
from claimloom.operators.claims import fill_from_claims
from claimloom.operators.components import connected_components
from claimloom.operators.resolve import batch_names, best_weak, name_matches, token_pairs
from claimloom.session import materialize

FILLED = ("lei", "vat", "hr_number", "domain", "address", "status")


def import_outcomes(rows: DataFrame, org: DataFrame, least: float = 0.34, rules: Sequence[tuple[str, str]] = ()) -> DataFrame:
    """``(ord, outcome, matched, tier, score)`` of rows that are imported in order.

    ``rows(ord, name, country)``, ``org(id, canonical_name, norm_name, country)``.  A row merges into the
    organisation, or the row before it that made one, with the same normal name and a country that does not differ
    (merged-norm).  Else it makes an organisation; if that resembles an older one, the best of those goes to review
    (review), else nothing does (created).  ``matched`` is an organisation's id, or the negative number of a row, less
    one.  Each different name is compared once; of rows that made one name the first stands for it.
    """
    known = name_matches(rows.select(F.col("ord").alias("new_id"), "name", "country"), org)
    known = materialize(known.select(F.col("new_id").alias("ord"), F.col("org_id").alias("matched")), "known")
    fold = materialize(batch_names(rows.join(known, "ord", "left_anti")), "fold")
    made = fold.where("outcome = 'created'").select("ord").join(rows, "ord").select("ord", norm(F.col("name")).alias("ln"), "name")
    own = org.select(F.col("id").alias("r"), F.lit(-1).cast("bigint").alias("since"), F.coalesce("norm_name", norm(F.col("canonical_name"))).alias("rn"), F.col("canonical_name").alias("name"))
    older = own.union(made.select((-F.col("ord") - 1).alias("r"), F.col("ord").cast("bigint").alias("since"), F.col("ln").alias("rn"), "name"))
    older = materialize(older.select("r", "since", "rn", F.array_sort(brand_tokens(F.col("name"))).alias("rt")), "older")
    # the oldest holder of a name or token set stands for it: if that is younger than a row, all are
    mine, o = materialize(made.select(F.col("ord").alias("l"), "ln"), "made"), F.struct("since", "r").alias("o")
    weak = best_weak(mine, older.select("rn", "rt", o), least, rules, F.col("o")["since"] < F.col("l"))
    weak = weak.select(F.col("l").alias("ord"), F.col("o")["r"].alias("matched"), "tier", "score")
    merged = known.select("ord", F.lit("merged-norm").alias("outcome"), "matched", F.lit("norm").alias("tier"), F.lit(1.0).alias("score"))
    again = fold.where("outcome <> 'created'").select("ord", "outcome", (-F.col("target") - 1).alias("matched"), F.lit("norm").alias("tier"), F.lit(1.0).alias("score"))
    new = made.select("ord").join(weak, "ord", "left").select("ord", F.when(F.col("matched").isNull(), "created").otherwise("review").alias("outcome"), "matched", F.coalesce("tier", F.lit("none")).alias("tier"), F.coalesce("score", F.lit(0.0)).alias("score"))
    return merged.union(again).union(new)


def import_counters(outcomes: DataFrame) -> DataFrame:
    """One row: how many rows came to which outcome."""
    n = lambda o: F.count_if(F.col("outcome") == o)
    return outcomes.agg(F.count(F.lit(1)).alias("seeds"), n("merged-norm").alias("merged_norm"), n("review").alias("review_candidates"), n("created").alias("distinct_new"))


def decided_merges(org: DataFrame, decisions: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(map(id, survivor_id), stats)`` of the decisions of a review sheet.

    ``decisions(n, new_name, matched_name, decision)``: for merge the new organisation goes into the matched one, found
    by normal name, else by its own spelling, the smallest id; the first decision on an organisation counts, and
    chains end at the last survivor.  Unknown names are counted as not found, other decisions as kept or skipped.
    """
    names = org.select("id", F.explode(F.array_distinct(F.array(F.struct(F.lit(0).alias("by"), F.col("norm_name").alias("k")), F.struct(F.lit(1).alias("by"), F.trim("canonical_name").alias("k"))))).alias("x"))
    names = names.select("id", "x.*").where("k is not null").groupBy("by", "k").agg(F.min("id").alias("id"))
    d = decisions.select("n", "new_name", "matched_name", norm(F.col("decision")).alias("decision"))

    def found(c: str) -> DataFrame:
        keys = F.array(F.struct(F.lit(0).alias("by"), norm(F.col(c)).alias("k")), F.struct(F.lit(1).alias("by"), F.trim(c).alias("k")))
        return d.select("n", F.explode(keys).alias("x")).select("n", "x.*").join(names, ["by", "k"]).groupBy("n").agg(F.min_by("id", "by").alias(c))

    both = materialize(d.drop("new_name", "matched_name").join(found("new_name"), "n", "left").join(found("matched_name"), "n", "left"), "decided")
    merges = both.where("decision = 'merge' and new_name is not null and matched_name is not null and new_name <> matched_name")
    edges = materialize(merges.groupBy("new_name").agg(F.min_by("matched_name", "n").alias("to")).select(F.col("new_name").alias("src"), F.col("to").alias("dst")), "edges")
    groups = connected_components(edges)
    # every organisation goes into one other at most, so a group has one that stays, or a circle: then its smallest
    stays = groups.join(edges.select(F.col("src").alias("node")), "node", "left_anti").groupBy("component").agg(F.min("node").alias("last"))
    mapping = groups.join(stays, "component", "left").select(F.col("node").alias("id"), F.coalesce("last", "component").alias("survivor_id"))
    merge, separate = F.col("decision") == "merge", F.col("decision").isin("keep-separate", "keep_separate", "getrennt")
    known = F.col("new_name").isNotNull() & F.col("matched_name").isNotNull()
    stats = both.agg(F.count_if(merge & known).alias("merged"), F.count_if(separate).alias("kept_separate"), F.count_if(merge & ~known).alias("not_found"), F.count_if(~merge & ~separate).alias("skipped"))
    return mapping, stats


def merged_into(org: DataFrame, mapping: DataFrame, fill: Sequence[str] = FILLED) -> DataFrame:
    """``org`` without the organisations that went into others; a survivor's empty fields take the first filled value
    of those, by id."""
    m = mapping.where("id <> survivor_id")
    x = org.join(m, "id", "left").withColumn("_s", F.coalesce("survivor_id", "id")).drop("survivor_id")
    own = F.col("id") == F.col("_s")
    kept = [c for c in org.columns if c in fill]
    value = lambda c: F.min_by(value_or_null(F.col(c)), F.when(value_or_null(F.col(c)).isNotNull(), F.struct(~own, "id")))
    return x.groupBy("_s").agg(*[value(c).alias(c) if c in kept else F.max(F.when(own, F.struct(F.col(c)))).getField(c).alias(c) for c in org.columns]).select(*org.columns)


def best_register_hits(names: DataFrame, entries: DataFrame, least: float = 0.6) -> DataFrame:
    """``(id, entry_id, score)``: of the register's entries the one whose name shares most of its words.

    ``names(id, name, country)``, ``entries(entry_id, legal_name, country)``.  Entries of another country are no hits
    where both countries are known; of equal hits the smallest entry.  Different sets of words are compared once.
    """
    l = materialize(names.select("id", F.array_sort(register_tokens(F.col("name"))).alias("lt"), F.col("country").alias("lc")), "names")
    e = entries.select("entry_id", F.array_sort(register_tokens(F.col("legal_name"))).alias("rt"), F.col("country").alias("rc")).groupBy("rt", "rc").agg(F.min("entry_id").alias("entry_id"))
    e = materialize(e, "entries")
    sets = token_pairs(l.select(F.col("lt").alias("l"), "lt").distinct(), e.select(F.col("rt").alias("r"), "rt").distinct(), least)
    met = l.join(sets.withColumnRenamed("l", "lt"), "lt").join(e.withColumnRenamed("rt", "r"), "r").where("lc is null or rc is null or lc = rc")
    best = F.min_by(F.struct("entry_id", "score"), F.struct((-F.col("score")).alias("s"), "entry_id"))
    return met.groupBy("id").agg(best.alias("x")).select("id", "x.*")


def enriched(org: DataFrame, claims: DataFrame, columns: Sequence[str] = ("lei", "domain", "address")) -> tuple[DataFrame, DataFrame]:
    """``(org, stats)``: empty columns filled from the claims of an enrichment run (``fill_from_claims``), and how many
    claims came and which columns they filled."""
    out = materialize(fill_from_claims(org, claims, columns), "enriched")
    before = org.select("id", *[F.coalesce(F.nullif(F.col(c), F.lit("")), F.lit("")).alias(f"_{c}") for c in columns])
    gained = [F.count_if((F.col(f"_{c}") == "") & (F.coalesce(c, F.lit("")) != "")).alias(f"{c}_found") for c in columns]
    stats = out.join(before, "id").agg(F.count(F.lit(1)).alias("processed"), *gained)
    return out, stats.crossJoin(claims.agg(F.count(F.lit(1)).alias("claims")))
