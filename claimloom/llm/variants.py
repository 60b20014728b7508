"""Variant spellings of names typed by people.

A symmetric-delete index finds spellings within a small edit distance: two words within k edits share a key
among what is left of each after up to k deletions.  The candidates' tokens are then aligned by optimal
assignment that permits initials and abbreviations, and the line of business, country and web site decide
between namesakes.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimloom.llm.names import align, business_agrees, distance, lookup_keys, tolerance
from claimloom.llm.parties import entity_parts, prepared
from claimloom.session import materialize


def neighbourhood(strings: DataFrame, column: str, sought: bool) -> DataFrame:
    """``(column, key)``: hashes of the lookup keys of each string."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for at in range(0, len(f), 500):  # the keys of a whole batch would be too many at once
                rows = [(s, k) for s in f[column].iloc[at : at + 500] for k in lookup_keys(s, sought)]
                yield pd.DataFrame(rows, columns=[column, "k"])

    # a small table is read in one task, but the keys are many
    spread = strings.select(column).repartition(strings.sparkSession.sparkContext.defaultParallelism)
    return spread.mapInPandas(run, f"{column} string, k string").select(column, F.xxhash64("k").alias("key"))


def similar_strings(left: DataFrame, right: DataFrame) -> DataFrame:
    """``(a, b, d)``: all pairs of ``left(a)`` and ``right(b)`` within the tolerance of the shorter one's length.

    Both sides hold different strings only, so a string that many rows share costs one lookup.
    """
    # the keys are many times the strings that the planner sees: never broadcast them
    pairs = neighbourhood(left, "a", True).hint("merge").join(neighbourhood(right, "b", False), "key").select("a", "b").distinct()

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            most = [tolerance(min(len(a), len(b))) for a, b in zip(f["a"], f["b"])]
            f = f.assign(d=[distance(a, b, m) for a, b, m in zip(f["a"], f["b"], most)], most=most)
            yield f.loc[f["d"] <= f["most"], ["a", "b", "d"]]

    return pairs.mapInPandas(run, "a string, b string, d int")


def abbreviations(left: DataFrame, right: DataFrame, least: int = 4, most: int = 40) -> DataFrame:
    """``(a, b)``: all pairs of different ``left(a)`` and ``right(b)`` one of which begins with the other, the shorter
    with ``least`` to ``most`` letters (more is no abbreviation).  Joined on the shorter one's hash; a string gives a row for each beginning."""
    heads = lambda c: F.transform(F.sequence(F.lit(least), F.least(F.length(c) - 1, F.lit(most))), lambda n: F.xxhash64(F.substring(F.col(c), F.lit(1), n)))
    long = lambda t, c: t.where(F.length(c) > least).select(c, F.explode(heads(c)).alias("key"))
    own = lambda t, c: t.where(F.length(c) >= least).select(c, F.xxhash64(c).alias("key"))
    both = own(left, "a").join(long(right, "b"), "key").select("a", "b").union(long(left, "a").join(own(right, "b"), "key").select("a", "b"))
    return both.where(F.startswith(F.col("a"), F.col("b")) | F.startswith(F.col("b"), F.col("a")))


def candidates(op: DataFrame, sp: DataFrame, ent: DataFrame) -> DataFrame:
    """``(id, ent, dn, ds, ab)``: least distance of the rows' name to the entity's spellings, of their site's stem,
    and whether one whole name begins with the other.  A single word of under six letters must be equal."""
    name = lambda t: t.select("id", F.posexplode("strings").alias("at", "s")).select("id", "s", F.lit(True).alias("name"), (F.col("at") == 0).alias("whole"))
    site = lambda t: t.select("id", F.explode("stems").alias("s"), F.lit(False).alias("name"), F.lit(False).alias("whole"))
    left = materialize(name(sp).union(site(sp)).where("s <> ''").distinct(), "left")
    right = materialize(name(op).union(site(op)).where("s <> ''").join(ent, "id").groupBy("ent", "s").agg(F.max("whole").alias("rwhole")), "right")
    a, b = left.select(F.col("s").alias("a")).distinct(), right.select(F.col("s").alias("b")).distinct()
    short = abbreviations(left.where("whole").select(F.col("s").alias("a")).distinct(), right.where("rwhole").select(F.col("s").alias("b")).distinct())
    near = materialize(similar_strings(a, b).union(short.select("a", "b", F.lit(None).cast("int"))), "near")
    d, named = F.col("d"), F.col("name")
    return (
        left.join(near, left["s"] == near["a"]).select("id", "name", "whole", "b", "d")
        .join(right, F.col("b") == right["s"]).where("(whole and rwhole) or d = 0 or (d is not null and (not name or length(b) >= 6))").select("id", "ent", "name", "d")
        .groupBy("id", "ent").agg(F.min(F.when(named, d)).alias("dn"), F.min(F.when(~named, d)).alias("ds"), F.max(named & d.isNull()).alias("ab"))
    )


def evidence(cand: DataFrame, sp: DataFrame, ep: DataFrame) -> DataFrame:
    """Candidates with what speaks for and against: ``b`` business and ``c`` country (1 agree, -1 differ, 0
    unknown), ``h`` a common own host, ``hk`` own hosts known on both sides, ``al`` share of the name aligned."""
    x = cand.join(sp.select("id", "business", "country", "hosts", "tokens"), "id").join(
        ep.select("ent", "businesses", "countries", F.col("hosts").alias("ehosts"), F.col("tokens").alias("etokens")), "ent"
    )
    x = x.withColumns(
        {
            "c": F.when(F.col("country").isNull() | (F.size("countries") == 0), 0).when(F.array_contains("countries", F.col("country")), 1).otherwise(-1),
            "h": F.arrays_overlap("hosts", "ehosts"),
            "hk": (F.size("hosts") > 0) & (F.size("ehosts") > 0),
        }
    )

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        memo: dict = {}

        def sets(b) -> list[frozenset[str]]:
            k = tuple(b)
            if k not in memo:
                memo[k] = [frozenset(t.split("|")) for t in k]
            return memo[k]

        for f in frames:
            b, al = [], []
            for mine, theirs, t, et in zip(f["business"], f["businesses"], f["tokens"], f["etokens"]):
                got = [business_agrees(sets(mine), sets(o)) for o in theirs]
                b.append(1 if 1 in got else -1 if -1 in got else 0)
                al.append(max((align(list(t), list(o)) for o in et), default=0.0))
            yield f[["id", "ent", "dn", "ds", "ab", "c", "h", "hk"]].assign(b=b, al=al)[["id", "ent", "dn", "ds", "ab", "b", "c", "h", "hk", "al"]]

    return x.select("id", "ent", "dn", "ds", "ab", "business", "businesses", "tokens", "etokens", "c", "h", "hk").mapInPandas(
        run, "id bigint, ent bigint, dn int, ds int, ab boolean, b int, c int, h boolean, hk boolean, al double"
    )


def link_variants(seed: DataFrame, org: DataFrame, least_aligned: float = 0.6) -> DataFrame:
    """``(org_id, seed_id)`` of every organisation row and seed row that name the same organisation.

    A seed is taken for an organisation whose name its own is a spelling of, if an optimal assignment of its tokens
    explains at least ``least_aligned`` of the shorter name (a common word alone does not), or whose site it gives
    (initials, nicknames), unless both line of business and country, or either with the other unknown, speak for a
    namesake.  A common own site overrules that.  A whole name that the other only begins with (an abbreviation) needs
    an equal business or country, no other business, and nothing better.  If some organisation agrees in business, country or site,
    those that merely do not disagree are dropped; if none does, those whose tokens align best stay.  Blank names
    link by their site only; repeated rows link alike; empty tables give an empty result.
    """
    op, sp, ent = prepared(org, seed, ["oem"], "land", ["domain", "link"], "seed_id")
    ev = materialize(evidence(materialize(candidates(op, sp, ent), "candidates"), sp, entity_parts(op, ent)), "evidence")
    aligned = F.col("al") >= least_aligned
    named = F.col("dn").isNotNull() & aligned
    clash = (F.col("c") == -1) | ((F.col("b") == -1) & (F.col("c") <= 0))
    by_site = F.col("ds").isNotNull() & ~F.col("hk")
    agree = (F.col("b") == 1) | (F.col("c") == 1)
    short = F.coalesce("ab", F.lit(False)) & aligned & agree & (F.col("b") >= 0) & ~(named | by_site)
    same = F.col("h") | (~clash & (named | by_site | short))
    # how strongly: a common site, then business or country, then an abbreviation with either, then nothing against
    strength = F.when(F.col("h"), 3).when(short, 1).when(agree, 2).otherwise(0)
    ok = ev.where(same).select("id", "ent", strength.alias("strength"), "al")
    best = ok.groupBy("id").agg(F.max("strength").alias("best"), F.max("al").alias("best_al"))
    # without any evidence the alignment of the tokens decides
    stays = F.when(F.col("best") >= 2, F.col("strength") >= 2).otherwise((F.col("strength") == F.col("best")) & (F.col("al") >= F.col("best_al")))
    kept = ok.join(best, "id").where(stays).select("id", "ent")
    return kept.join(ent.select(F.col("id").alias("org_id"), "ent"), "ent").select("org_id", F.col("id").alias("seed_id")).distinct()
