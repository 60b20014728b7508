"""Matching of firms against a customer list: a cascade of exact, containment, token and spelling matches."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimloom.functions.similarity import matching_ratio
from claimloom.functions.text import application, brand_tokens, norm
from claimloom.operators.resolve import best_token_sets, containment_pairs
from claimloom.session import materialize


def similar_tokens(left: DataFrame, right: DataFrame, least: float = 0.85, most_longer: int = 2, most_lost: int = 3) -> DataFrame:
    """``(a, b, score)``: all pairs of different words ``left(a)``, ``right(b)`` of that Ratcliff-Obershelp ratio whose
    lengths differ by at most ``most_longer``.

    Exact: the letters that two words of T letters in all have in common under a ratio r are a common subsequence, so
    u deletions and insertions lead from one to the other: the largest number of (1 - r) T at most that is even or odd
    as T is.  The lengths tell how many letters each word may lose.  Where it is ``most_lost`` at most, words meet under
    what is left of them without so many letters.  Else by pieces: cut into u + 1 of them, some piece of ``b`` stands
    unchanged in ``a``, shifted by no more than the letters lost.  The letters in common must then suffice for the
    ratio before it is computed, in Python.
    """
    n = F.length("w")
    lengths = F.filter(F.sequence(n - most_longer, n + most_longer), lambda x: x > 0)

    def edits(total: Column) -> Column:
        most = F.floor((1 - least) * total + 1e-9).cast("int")
        return most - (total - most) % 2

    def pieces(length: Column, total: Column) -> Column:
        """Array of (number, start, length) of the pieces of a word."""
        u = edits(total)
        cut = lambda k: F.floor(length * k / (u + 1)).cast("int")
        return F.transform(F.sequence(F.lit(0), u), lambda k: F.struct(k.alias("k"), cut(k).alias("at"), (cut(k + 1) - cut(k)).alias("size")))

    def stored(la: Column) -> Column:
        return F.transform(pieces(n, la + n), lambda p: F.xxhash64(la, n, p["k"], F.substring("w", p["at"] + 1, p["size"])))

    def sought(lb: Column) -> Column:
        u = edits(lb + n)
        lost, gained = F.shiftright(u - n + lb, 1), F.shiftright(u + n - lb, 1)
        of_piece = lambda p: F.transform(
            F.filter(F.sequence(p["at"] - lost, p["at"] + gained), lambda i: (i >= 0) & (i + p["size"] <= n)), lambda i: F.xxhash64(n, lb, p["k"], F.substring("w", i + 1, p["size"]))
        )
        return F.flatten(F.transform(pieces(lb, lb + n), of_piece))

    def letters(c: Column) -> Column:
        # the same letter again is another one: a common multiset becomes a common set
        s = F.array_sort(F.split(c, ""))
        return F.transform(s, lambda x, i: F.concat(x, (i - F.array_position(s, x)).cast("string")))

    def keyed(df: DataFrame, c: str, keys: Callable[[Column], Column]) -> DataFrame:
        w = df.select(F.col(c).alias("w")).where("w <> ''").repartition(df.sparkSession.sparkContext.defaultParallelism)
        lost = lambda x: F.shiftright(edits(n + x) + n - x, 1)
        other = lambda x: F.shiftright(edits(n + x) - n + x, 1)
        few = lambda x: F.greatest(lost(x), other(x)) <= most_lost
        near = F.filter(lengths, lambda x: edits(n + x) >= F.abs(n - x))
        w = w.withColumn("near", near).withColumn("v0", F.array("w"))
        w = w.withColumn("need", F.coalesce(F.array_max(F.transform(F.filter("near", few), lost)), F.lit(0)))
        for d in range(most_lost):
            one_less = lambda v: F.transform(F.sequence(F.lit(1), F.length(v)), lambda i: F.concat(F.substring(v, F.lit(1), i - 1), F.substring(v, i + 1, F.length(v))))
            less = F.array_distinct(F.flatten(F.transform(F.filter(f"v{d}", lambda v: v != ""), one_less)))
            w = w.withColumn(f"v{d + 1}", F.when(F.col("need") > d, less).otherwise(F.array().cast("array<string>")))
        left_over = F.array(*[F.col(f"v{d}") for d in range(most_lost + 1)])
        pair = (lambda x: (n, x)) if c == "a" else (lambda x: (x, n))
        met = lambda x: F.transform(F.element_at(left_over, lost(x) + 1), lambda v: F.xxhash64(*pair(x), v))
        of = lambda x: F.when(few(x), met(x)).otherwise(keys(x))
        return w.select(F.col("w").alias(c), F.explode(F.array_distinct(F.flatten(F.transform("near", of)))).alias("key"))

    # the keys are many times the words that the planner sees: never broadcast them
    met = keyed(left, "a", sought).hint("merge").join(keyed(right, "b", stored), "key").select("a", "b").distinct()
    total = F.length("a") + F.length("b")
    met = met.where(2 * F.size(F.array_intersect(letters(F.col("a")), letters(F.col("b")))) >= least * total - 1e-9)
    return materialize(met.withColumn("score", matching_ratio(F.col("a"), F.col("b"))).where(F.col("score") >= least), "near")


def firm_matches(cand: DataFrame, firms: DataFrame, least_tokens: float = 0.34, least_ratio: float = 0.85, spelling: bool = True) -> DataFrame:
    """``(cand_id, firm_id, level, score)`` for every candidate; level exact, similar or none.

    ``cand(cand_id, name)``, ``firms(firm_id, name)``.  Stages: equal names (the last firm of a name), containment
    of five letters or more (the first firm, 0.9), best token overlap, best ratio of two tokens.  Each stage sees
    what the earlier ones left; every different name and token is compared once, however many rows hold it.
    """
    # the stages read the names again and again: they are taken apart once
    named = lambda x, key: materialize(x.select(key, norm(F.col("name")).alias("n"), F.array_sort(brand_tokens(F.col("name"))).alias("t")), "named")
    c, f = named(cand, "cand_id"), named(firms, "firm_id")
    c_some = c.where("n <> ''")
    level = lambda x, name: x.select("cand_id", "firm_id", F.lit(name).alias("level"), "score")
    exact = c_some.join(f.groupBy("n").agg(F.max("firm_id").alias("firm_id")), "n").withColumn("score", F.lit(1.0))
    # every stage is written: the later ones would compute the earlier ones again and again
    exact = materialize(exact, "exact")
    out = level(exact, "exact")
    rest = c_some.join(exact.select("cand_id"), "cand_id", "left_anti")
    names = materialize(f.where("n <> ''").groupBy("n").agg(F.min("firm_id").alias("firm_id")), "names")
    mine = rest.select("n").distinct()
    inside = containment_pairs(mine.select(F.col("n").alias("l"), F.col("n").alias("ln")), names.select(F.col("firm_id").alias("r"), F.col("n").alias("rn")))
    inside = inside.groupBy("l").agg(F.min("r").alias("firm_id")).select(F.col("l").alias("n"), "firm_id", F.lit(0.9).alias("score"))
    inside = materialize(rest.join(inside, "n").select("cand_id", "firm_id", "score"), "inside")
    out = out.union(level(inside, "exact"))
    rest = rest.join(inside.select("cand_id"), "cand_id", "left_anti").select("cand_id", "t")
    rest = materialize(rest, "rest")
    no_flags = F.lit("")
    sets = f.where("size(t) > 0").groupBy(F.col("t").alias("rt")).agg(F.min("firm_id").alias("o")).withColumn("rf", no_flags)
    mine = rest.where("size(t) > 0").select(F.col("t").alias("l"), F.col("t").alias("lt"), no_flags.alias("lf")).distinct()
    tok = best_token_sets(mine, materialize(sets, "sets"), least_tokens).select("l", F.struct(F.col("o").alias("r"), "score").alias("x"))
    tok = materialize(rest.join(tok.withColumnRenamed("l", "t"), "t").select("cand_id", F.col("x.r").alias("firm_id"), F.col("x.score").alias("score")), "tokens")
    out = out.union(level(tok, "exact"))
    if spelling:
        rest = materialize(rest.join(tok.select("cand_id"), "cand_id", "left_anti"), "rest")
        b = materialize(f.select("firm_id", F.explode("t").alias("b")).groupBy("b").agg(F.min("firm_id").alias("firm_id")), "tokens")
        # an equal word has the best ratio there is; only the ratio of very long words to themselves may be less
        equal = rest.select("cand_id", F.explode("t").alias("b")).where("length(b) < 200").join(b, "b")
        equal = materialize(equal.groupBy("cand_id").agg(F.min("firm_id").alias("firm_id")).withColumn("score", F.lit(1.0)), "equal")
        odd = rest.join(equal, "cand_id", "left_anti").union(rest.where(F.exists("t", lambda w: F.length(w) >= 200))).distinct()
        odd = materialize(odd, "rest")
        near = similar_tokens(odd.select(F.explode("t").alias("a")).distinct(), b.select("b"), least_ratio)
        pick = F.min_by(F.struct("firm_id", "score"), F.struct((-F.col("score")).alias("s"), "firm_id")).alias("x")
        best = near.join(b, "b").groupBy("a").agg(pick).select("a", "x.*")
        typo = odd.select("cand_id", F.explode("t").alias("a")).join(best, "a").select("cand_id", "firm_id", "score").union(equal.select("cand_id", "firm_id", "score"))
        typo = typo.groupBy("cand_id").agg(pick).select("cand_id", "x.firm_id", "x.score")
        out = out.union(level(materialize(typo, "spelling"), "similar"))
    none = c.join(out.select("cand_id"), "cand_id", "left_anti").select("cand_id", F.lit(None).cast("bigint").alias("firm_id"), F.lit("none").alias("level"), F.lit(0.0).alias("score"))
    return out.union(none)


def known_applications(cand: DataFrame, known: DataFrame, least_ratio: float = 0.8) -> DataFrame:
    """``(cand_id, firm_id)`` whose application the firm already has: equal, contained (four letters or more) or
    of that ratio.  ``cand(cand_id, firm_id, application)``, ``known(firm_id, application)``."""
    k = known.select("firm_id", application(F.col("application")).alias("b")).where("b <> ''").distinct()
    x = cand.select("cand_id", "firm_id", application(F.col("application")).alias("a")).where("a <> ''").join(k, "firm_id")
    long = (F.length("a") >= 4) & (F.length("b") >= 4)
    plain = (F.col("a") == F.col("b")) | (long & (F.contains("a", F.col("b")) | F.contains("b", F.col("a"))))
    # different pairs only: the ratio is computed once for each
    texts = x.where(~plain).select("a", "b").distinct().withColumn("r", matching_ratio(F.col("a"), F.col("b"))).where(F.col("r") >= least_ratio)
    return x.join(texts, ["a", "b"], "left").where(plain | F.col("r").isNotNull()).select("cand_id", "firm_id").distinct()


def contained_pattern(names: DataFrame, patterns: DataFrame, most: int = 1000) -> DataFrame:
    """``(id, code)``: the first pattern (by ``ord``) whose key contains the name or is contained in it.

    ``names(id, name)``, ``patterns(ord, code, key)``.  Up to ``most`` different keys are sent to the names; more are
    joined by the first letters of the shorter text, and only texts of under three letters, of which there are few
    different ones, are sent.  Each different name is compared once.
    """
    n = names.select("id", norm(F.col("name")).alias("n")).where("n <> ''")
    distinct = materialize(n.select("n").distinct(), "names")
    p = patterns.select("ord", "code", norm(F.col("key")).alias("k")).where("k <> ''").groupBy("k").agg(F.min(F.struct("ord", "code")).alias("p"))
    p = materialize(p, "patterns")
    inside = F.contains("n", F.col("k")) | F.contains("k", F.col("n"))
    if p.count() <= most:
        pairs = distinct.join(F.broadcast(p), inside).select("n", "p")
    else:
        short = lambda c: F.length(c) < 3
        long = containment_pairs(distinct.select(F.col("n").alias("l"), F.col("n").alias("ln")), p.select(F.col("k").alias("r"), F.col("k").alias("rn")), 3)
        pairs = long.join(p, long["r"] == p["k"]).select(F.col("l").alias("n"), "p")
        pairs = pairs.union(distinct.join(F.broadcast(p.where(short("k"))), inside).select("n", "p"))
        pairs = pairs.union(p.where(~short("k")).join(F.broadcast(distinct.where(short("n"))), inside).select("n", "p"))
    hit = pairs.groupBy("n").agg(F.min("p").alias("p"))
    return n.join(hit, "n").select("id", F.col("p.code").alias("code"))


def dedup_status(cand: DataFrame, customers: DataFrame, **limits: float) -> DataFrame:
    """``(cand_id, status, firm_id, level, score)`` of candidates against a customer list.

    ``cand(cand_id, name, application, model)``, ``customers(firm_id, name, application)`` with one row for each
    application of a firm.  No firm is new; a firm by spelling only is to be checked; a firm that has the application
    or model is a duplicate, else a new application.
    """
    known = materialize(customers.select("firm_id", norm(F.col("name")).alias("n"), "application").where("n <> ''"), "known")
    firms = known.groupBy("n").agg(F.max("firm_id").alias("firm_id"))
    match = materialize(firm_matches(cand.select("cand_id", "name"), firms.select("firm_id", F.col("n").alias("name")), **limits), "firms")
    asked = cand.select("cand_id", F.explode(F.array("application", "model")).alias("application")).join(match.where("firm_id is not null").select("cand_id", "firm_id"), "cand_id")
    has = known_applications(asked, known.join(firms.withColumnRenamed("firm_id", "first"), "n").select(F.col("first").alias("firm_id"), "application")).select("cand_id", F.lit(True).alias("has")).distinct()
    status = F.when(F.col("level") == "none", "new").when(F.col("level") == "similar", "check").when(F.col("has"), "duplicate").otherwise("new application")
    return match.join(has, "cand_id", "left").select("cand_id", status.alias("status"), "firm_id", "level", "score")
