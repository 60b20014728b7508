"""Conservative entity resolution: strong keys, exact names, and weak candidates that only go to review."""

from __future__ import annotations

import functools
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimloom.functions.text import brand_tokens, jaccard, norm, value_or_null
from claimloom.session import materialize

STRONG_KEYS = ("lei", "vat", "hr_number")


def strong_matches(new: DataFrame, org: DataFrame, keys: Sequence[str] = STRONG_KEYS) -> DataFrame:
    """``(new_id, org_id, key)``: the organisation with an equal strong key, keys tried in order.

    ``new(new_id, *keys)``; of several organisations with the key the smallest id.  Placeholders are no keys.
    """
    tries = []
    for rank, k in enumerate(keys):
        first = org.select(value_or_null(F.col(k)).alias("k"), F.col("id")).where("k is not null").groupBy("k").agg(F.min("id").alias("org_id"))
        n = new.select("new_id", value_or_null(F.col(k)).alias("k"))
        tries.append(n.join(first, "k").select("new_id", "org_id", F.lit(k).alias("key"), F.lit(rank).alias("rank")))
    out = tries[0]
    for t in tries[1:]:
        out = out.union(t)
    return out.groupBy("new_id").agg(F.min_by(F.struct("org_id", "key"), "rank").alias("x")).select("new_id", "x.*")


def name_matches(new: DataFrame, org: DataFrame) -> DataFrame:
    """``(new_id, org_id)``: equal normal names whose countries do not differ (null agrees with all); the smallest id.

    ``new(new_id, name, country)``, ``org(id, norm_name, country)``.  Organisations are reduced to one row for each
    name and country first.
    """
    o = org.groupBy(F.col("norm_name").alias("n"), F.col("country").alias("oc")).agg(F.min("id").alias("org_id"))
    x = new.select("new_id", norm(F.col("name")).alias("n"), "country").join(o, "n")
    return x.where("country is null or oc is null or country = oc").groupBy("new_id").agg(F.min("org_id").alias("org_id"))


def _prefix(tokens: Column, least: float) -> Column:
    """How many of a set's rarest tokens must be looked at so that no pair of that Jaccard similarity is lost."""
    n = F.size(tokens)
    return n - F.ceil(n * least - 1e-9).cast("int") + 1


def token_pairs(left: DataFrame, right: DataFrame, least: float) -> DataFrame:
    """``(l, r, score)``: all pairs of token sets ``left(l, lt)``, ``right(r, rt)`` of Jaccard similarity ``least`` or more.

    Prefix filter: tokens are ranked by their frequency and only the rarest of each set are joined on, so the
    common words of a trade make no pairs by themselves.  Empty sets match nothing.
    """
    freq = left.select(F.explode("lt").alias("t")).union(right.select(F.explode("rt").alias("t"))).groupBy("t").agg(F.count(F.lit(1)).alias("f"))

    def rare(df: DataFrame, key: str, toks: str) -> DataFrame:
        e = df.where(F.size(toks) > 0).select(key, F.explode(toks).alias("t"), _prefix(F.col(toks), least).alias("p")).join(freq, "t")
        w = Window.partitionBy(key).orderBy("f", "t")
        return e.withColumn("i", F.row_number().over(w)).where("i <= p").select(key, "t")

    ids = rare(left, "l", "lt").join(rare(right, "r", "rt"), "t").select("l", "r").distinct()
    return ids.join(left, "l").join(right, "r").select("l", "r", jaccard(F.col("lt"), F.col("rt")).alias("score")).where(F.col("score") >= least)


def best_token_sets(left: DataFrame, right: DataFrame, least: float, valid: Column | None = None, most: int = 8) -> DataFrame:
    """``(l, o, score)``: for each row ``left(l, lt, lf, ...)`` the right set of greatest Jaccard similarity, ``least`` or
    more, and of equals the one of smallest ``o``; ``right(rt, rf, o)``.

    Pairs are not listed: every set stands under each of its subsets, where the sets of one size are one row with the
    smallest ``o``.  A subset of k tokens that sets of sizes a and b share means a similarity of k / (a + b - k) at
    least, and their whole intersection means just that, so the greatest is exact.  ``valid`` may reject a left row
    with an ``o`` (if it rejects an ``o``, it must reject greater ones too) or with the ``rf`` that are kept apart for
    it.  Sets of over ``most`` tokens have too many subsets; their pairs are listed (``token_pairs``).
    """
    score = F.col("k") / (F.col("a") + F.col("b") - F.col("k"))
    n = F.size("t")

    def subsets(df: DataFrame) -> DataFrame:
        masks = F.filter(F.sequence(F.lit(1), (F.pow(F.lit(2), n) - 1).cast("int")), lambda m: F.bit_count(m) >= n * least - 1e-9)
        x = df.where(n.between(1, most)).withColumn("m", F.explode(masks))
        part = F.array_join(F.filter("t", lambda w, i: F.getbit("m", i) == 1), ",")
        return x.withColumn("s", part).withColumn("k", F.bit_count("m")).withColumn("n", n).drop("t", "m")

    at_left = [c for c in left.columns if c != "lt"]
    mine = subsets(left.withColumnRenamed("lt", "t")).withColumnRenamed("n", "a")
    theirs = subsets(right.select(F.col("rt").alias("t"), "rf", "o")).groupBy("s", F.col("n").alias("b"), "rf").agg(F.min("o").alias("o"))
    # the subsets are many times the rows that the planner sees: never broadcast them
    met = mine.hint("merge").join(theirs, "s").where(score >= least).select(*at_left, "rf", "o", score.alias("score"))
    long = left.select(F.size("lt").alias("n")).union(right.select(F.size("rt").alias("n"))).agg(F.max("n")).first()[0]
    if (long or 0) > most:
        sets = right.groupBy("rt", "rf").agg(F.min("o").alias("o"))
        ls, rs = left.select(F.col("lt").alias("l"), "lt").distinct(), sets.select(F.col("rt").alias("r"), "rt").distinct()
        pairs = token_pairs(ls.where(F.size("lt") > most), rs, least).union(token_pairs(ls.where(F.size("lt") <= most), rs.where(F.size("rt") > most), least))
        pairs = pairs.select(F.col("l").alias("lt"), F.col("r").alias("rt"), "score")
        met = met.union(left.join(pairs, "lt").join(sets, "rt").select(*at_left, "rf", "o", "score"))
    met = met.where(valid) if valid is not None else met
    best = F.min_by(F.struct("o", "score"), F.struct((-F.col("score")).alias("s"), "o"))
    return met.groupBy("l").agg(best.alias("x")).select("l", "x.*")


def containment_pairs(left: DataFrame, right: DataFrame, least: int = 5) -> DataFrame:
    """``(l, r, score)``: pairs of texts of ``least`` letters or more one of which contains the other.

    ``left(l, ln)``, ``right(r, rn)``; the score is the ratio of lengths.  Of the pieces of ``least`` letters of the
    shorter text the one that is rarest among the other side's texts must occur in the longer one, which makes an
    equi-join of it; a text with a piece that the other side lacks is in none of them.
    """
    texts = left.select(F.lit(True).alias("own"), F.col("ln").alias("t")).union(right.select(F.lit(False).alias("own"), F.col("rn").alias("t")))
    texts = texts.where(F.length("t") >= least).distinct().withColumn("i", F.monotonically_increasing_id())
    texts = materialize(texts, "texts")
    hashed = lambda c, at: F.xxhash64(F.substring(c, at, F.lit(least)))
    at = F.sequence(F.lit(1), F.length("t") - least + 1)
    # pieces beyond 60000 letters are found but not chosen: place and number go into one bigint
    pieces = texts.select("own", "i", F.posexplode(F.transform(at, lambda p: hashed(F.col("t"), p))).alias("p", "g"))
    held = pieces.groupBy("g").agg(F.count_if("own").alias("n_own"), F.count_if(~F.col("own")).alias("n_other"))
    other = F.least(F.when(F.col("own"), F.col("n_other")).otherwise(F.col("n_own")), F.lit(1 << 40))
    rarest = pieces.where("p < 60000").hint("merge").join(held, "g").groupBy("i").agg(F.min(other * 65536 + F.col("p")).alias("x"))
    rarest = rarest.where("x >= 65536").select("i", (F.col("x") % 65536 + 1).cast("int").alias("p"))
    sought = texts.join(rarest, "i").select("own", F.col("t").alias("short"), hashed(F.col("t"), F.col("p")).alias("g"))
    found = pieces.select((~F.col("own")).alias("own"), "i", "g")
    met = found.hint("merge").join(sought, ["g", "own"]).select("i", "own", "short").distinct().join(texts.select("i", F.col("t").alias("long")), "i")
    met = met.where(F.contains("long", F.col("short"))).select(F.when(F.col("own"), F.col("short")).otherwise(F.col("long")).alias("ln"), F.when(F.col("own"), F.col("long")).otherwise(F.col("short")).alias("rn"))
    out = met.distinct().join(left.select("l", "ln"), "ln").join(right.select("r", "rn"), "rn")
    ln, rn = F.length("ln"), F.length("rn")
    return out.select("l", "r", (F.least(ln, rn) / F.greatest(ln, rn)).alias("score"))


def whitelisted(a: Column, b: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """Whether one of two normal names contains the one text and the other the other text of a rule: known namesakes."""
    both = lambda x, y: F.contains(a, F.lit(x)) & F.contains(b, F.lit(y))
    return functools.reduce(lambda out, r: out | both(*r) | both(*r[::-1]), rules, F.lit(False))


def weak_names(left: DataFrame, right: DataFrame, least: float, rules: Sequence[tuple[str, str]] = ()) -> DataFrame:
    """``(ln, rn, rt, tier, score)``: different names ``left(ln)`` and ``right(rn, rt)`` that are weak candidates.

    ``rt`` are the brand tokens of the right name's own spelling.  Every name is compared once, however many rows
    hold it; equal sets of tokens too.
    """
    ln = left.select("ln").where("ln <> ''").distinct()
    rn = right.select("rn").distinct()
    held = right.select("rn", F.array_sort("rt").alias("rt")).distinct()
    inside = containment_pairs(ln.select(F.col("ln").alias("l"), "ln"), rn.select(F.col("rn").alias("r"), "rn")).select(F.col("l").alias("ln"), F.col("r").alias("rn"), F.lit("substring").alias("tier"), "score").join(held, "rn").select("ln", "rn", "rt", "tier", "score")
    lt = materialize(ln.select("ln", F.array_sort(brand_tokens(F.col("ln"))).alias("lt")).where("size(lt) > 0"), "tokens")
    rt = materialize(held.where("size(rt) > 0"), "tokens")
    sets = token_pairs(lt.select(F.col("lt").alias("l"), "lt").distinct(), rt.select(F.col("rt").alias("r"), "rt").distinct(), least)
    brand = lt.join(sets.withColumnRenamed("l", "lt"), "lt").join(rt.withColumnRenamed("rt", "r"), "r").select("ln", "rn", F.col("r").alias("rt"), F.lit("brand").alias("tier"), "score")
    out = inside.union(brand)
    return out.where(~whitelisted(F.col("ln"), F.col("rn"), rules)) if rules else out


def best_weak(left: DataFrame, right: DataFrame, least: float, rules: Sequence[tuple[str, str]] = (), valid: Column | None = None) -> DataFrame:
    """``(l, o, tier, score)``: the best weak candidate of each row ``left(l, ln)`` among ``right(rn, rt, o)``: by score,
    then the smallest ``o``, then containment before tokens.

    As ``weak_names`` and ``best_token_sets``, but pairs of names that only share tokens are never listed: they grow
    with the square of the rows.  ``valid`` may reject a left row with an ``o`` and all greater ones.
    """
    parts = [x for r in rules for x in r]
    flags = lambda c: F.array(*[F.contains(c, F.lit(x)) for x in parts]) if parts else F.lit("")
    ln, rn = left.select("ln").distinct(), right.groupBy("rn").agg(F.min("o").alias("o"))
    inside = containment_pairs(ln.select(F.col("ln").alias("l"), "ln"), rn.select(F.col("rn").alias("r"), "rn"))
    inside = inside.where(~whitelisted(F.col("l"), F.col("r"), rules)) if rules else inside
    inside = inside.join(rn, inside["r"] == rn["rn"]).select(F.col("l").alias("ln"), "o", "score").join(left, "ln")
    inside = inside.where(valid) if valid is not None else inside
    toks = materialize(left.where("ln <> ''").select("l", F.array_sort(brand_tokens(F.col("ln"))).alias("lt"), flags(F.col("ln")).alias("lf")).where("size(lt) > 0"), "tokens")
    sets = materialize(right.select(F.array_sort("rt").alias("rt"), flags(F.col("rn")).alias("rf"), "o").where("size(rt) > 0").groupBy("rt", "rf").agg(F.min("o").alias("o")), "tokens")
    if parts:
        f = lambda c, i: F.col(c)[i]
        same = functools.reduce(lambda x, y: x | y, [(f("lf", i) & f("rf", i + 1)) | (f("lf", i + 1) & f("rf", i)) for i in range(0, len(parts), 2)])
        valid = ~same if valid is None else valid & ~same
    brand = best_token_sets(toks, sets, least, valid)
    both = inside.select("l", "o", F.lit("substring").alias("tier"), "score").union(brand.select("l", "o", F.lit("brand").alias("tier"), "score"))
    order = F.struct((-F.col("score")).alias("s"), "o", (F.col("tier") != "substring").alias("t"))
    return both.groupBy("l").agg(F.min_by(F.struct("o", "tier", "score"), order).alias("x")).select("l", "x.*")


def weak_matches(new: DataFrame, org: DataFrame, least: float = 0.34, apart: DataFrame | None = None, rules: Sequence[tuple[str, str]] = ()) -> DataFrame:
    """``(new_id, org_id, tier, score)``: the best weak candidate by containment or brand tokens.

    ``new(new_id, name)``, ``org(id, canonical_name, norm_name)``; ``apart(new_id, id)`` holds pairs known to be
    different, ``rules`` texts of namesakes (``whitelisted``).  Ties go to the smallest id and to containment before
    tokens; scores are not rounded.  Names are compared once each, and stand for their smallest id; only for rows
    of ``apart`` all pairs of names are listed.
    """
    l = new.select(F.col("new_id").alias("l"), norm(F.col("name")).alias("ln"))
    r = org.select(F.col("id").alias("r"), F.coalesce("norm_name", norm(F.col("canonical_name"))).alias("rn"), F.array_sort(brand_tokens(F.col("canonical_name"))).alias("rt"))
    names = materialize(r.groupBy("rn", "rt").agg(F.min("r").alias("o")), "names")
    mine = materialize(l.select("ln").where("ln <> ''").distinct(), "names")
    best = best_weak(mine.select(F.col("ln").alias("l"), "ln"), names, least, rules).withColumnRenamed("l", "ln")
    out = l.join(best, "ln").select(F.col("l").alias("new_id"), F.col("o").alias("org_id"), "tier", "score")
    if apart is None:
        return out
    some = apart.select(F.col("new_id").alias("l")).distinct()
    pairs = materialize(weak_names(l.join(some, "l"), names, least, rules), "weak")
    wide = l.join(some, "l").join(pairs, "ln").join(r, ["rn", "rt"]).join(apart.select(F.col("new_id").alias("l"), F.col("id").alias("r")), ["l", "r"], "left_anti")
    order = F.struct((-F.col("score")).alias("s"), "r", (F.col("tier") != "substring").alias("t"))
    wide = wide.groupBy("l").agg(F.min_by(F.struct(F.col("r").alias("org_id"), "tier", "score"), order).alias("x"))
    return out.join(some, out["new_id"] == some["l"], "left_anti").union(wide.select(F.col("l").alias("new_id"), "x.*"))


def classify(new: DataFrame, org: DataFrame, keys: Sequence[str] = (), least: float = 0.34) -> DataFrame:
    """``(new_id, org_id, tier, score)`` for every new row: strong, norm, substring, brand or none.

    The stages are anti-joined, so the weak stage sees only what the exact ones left.
    """
    done = None
    rest = new
    if keys:
        done = strong_matches(new, org, keys).select("new_id", "org_id", F.lit("strong").alias("tier"), F.lit(1.0).alias("score"))
        rest = new.join(done, "new_id", "left_anti")
    exact = materialize(name_matches(rest, org), "exact").select("new_id", "org_id", F.lit("norm").alias("tier"), F.lit(1.0).alias("score"))
    rest = materialize(rest.join(exact, "new_id", "left_anti"), "rest")
    weak = materialize(weak_matches(rest, org, least), "weak")
    none = rest.join(weak, "new_id", "left_anti").select("new_id", F.lit(None).cast("bigint").alias("org_id"), F.lit("none").alias("tier"), F.lit(0.0).alias("score"))
    out = exact.union(weak).union(none)
    return out.union(done) if done is not None else out


def batch_names(rows: DataFrame) -> DataFrame:
    """``(ord, target, outcome)``: names of one run resolved in order against those before them.

    ``rows(ord, name, country)``.  A row merges into the first earlier row of the same normal name whose country
    does not differ; else it creates an organisation.  The fold has a closed form: a name's first row creates; if
    its country is known, the first row of every other country creates too, and nothing else does.
    """
    x = rows.select("ord", norm(F.col("name")).alias("n"), "country")
    first = x.groupBy("n").agg(F.min(F.struct("ord", "country")).alias("f")).select("n", F.col("f.ord").alias("first"), F.col("f.country").alias("fc"))
    per = x.where("country is not null").groupBy("n", "country").agg(F.min("ord").alias("own")).withColumnRenamed("country", "c")
    j = x.join(first, "n").join(per, (x["n"] == per["n"]) & (x["country"] == per["c"]), "left").select("ord", x["country"], "first", "fc", "own")
    target = F.when(F.col("country").isNull() | F.col("fc").isNull(), F.col("first")).otherwise(F.col("own"))
    return j.select("ord", target.alias("target"), F.when(target == F.col("ord"), "created").otherwise("merged-norm").alias("outcome"))


def merge_by_keys(org: DataFrame, keys: Sequence[str] = STRONG_KEYS, fill: Sequence[str] = ("domain", "address", "vat", "hr_number", "lei")) -> tuple[DataFrame, DataFrame]:
    """``(merged organisations, map(id, survivor_id))`` after one pass for each key, in order.

    The smallest id of an equal key survives and takes the first filled value of the fields that it lacks.  The
    passes are sequential on purpose: a survivor keeps its own key, so this is less than connected components.
    """
    cols = org.columns
    cur = org.select(*[value_or_null(F.col(c)).alias(c) if c in fill else F.col(c) for c in cols])
    mapping = org.select("id", F.col("id").alias("survivor_id"))
    for k in keys:
        g = F.coalesce(F.concat(F.lit("k"), F.col(k)), F.concat(F.lit("i"), F.col("id").cast("string")))
        x = cur.withColumn("_g", g)
        step = x.groupBy("_g").agg(
            F.min("id").alias("id"),
            *[F.min_by(c, F.when(F.col(c).isNotNull(), F.col("id"))).alias(c) for c in fill if c in cols],
            *[F.min_by(c, "id").alias(c) for c in cols if c not in fill and c != "id"],
        )
        moved = x.select(F.col("id").alias("survivor_id"), "_g").join(step.select("_g", F.col("id").alias("_new")), "_g").select("survivor_id", "_new")
        mapping = mapping.join(moved, "survivor_id").select("id", F.col("_new").alias("survivor_id"))
        cur = step.select(*cols)
    return cur, mapping


def repoint(facts: DataFrame, column: str, mapping: DataFrame) -> DataFrame:
    """``facts`` with ``column`` moved to the survivor; keys without a mapping stay."""
    m = mapping.where("id <> survivor_id").select(F.col("id").alias("_id"), "survivor_id")
    j = facts.join(m, facts[column] == m["_id"], "left")
    return j.withColumn(column, F.coalesce("survivor_id", F.col(column))).select(*facts.columns)


def apply_review(pending: DataFrame, decisions: DataFrame) -> DataFrame:
    """``pending(new_name, matched_name, ...)`` with the decision of the review sheet; rows without one stay pending.

    ``decisions(new_name, matched_name, decision)``; the last of repeated decisions (by ``n``) counts.
    """
    d = decisions.groupBy("new_name", "matched_name").agg(F.max_by("decision", "n").alias("_d"))
    return pending.join(d, ["new_name", "matched_name"], "left").withColumn("decision", F.coalesce(F.nullif("_d", F.lit("")), F.lit("pending"))).drop("_d")
