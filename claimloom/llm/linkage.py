"""Matching entities across sources without keys.

Name, site and address are encoded as fixed bit vectors of their q-grams.  Pairs whose vectors are close are found
exactly by multi-index Hamming hashing: two vectors within r bits agree in full in ``match`` of ``bands`` stripes
when bands - match >= r.  Two edits of a name change up to 12 bits of its vector, which no stripes find at a
bearable cost; so names and sites are also looked up in the symmetric-delete index, which holds every pair within
the accepted edits.

Candidates get a Dice coefficient for each of the three fields.  How the levels of the Dice coefficients, country
and line of business are spread over matches and other candidates is estimated by expectation maximisation (two
latent classes); a logistic model fitted to it gives each field its weight, and the weighted Dice scores of a pair
its calibrated confidence.  Pairs below the least confidence are dropped; a check of the evidence follows.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimloom.llm.names import distance, fold, tolerance
from claimloom.llm.parties import entity_parts, prepared
from claimloom.llm.variants import evidence, similar_strings
from claimloom.session import materialize

#: Kinds of streets and their short forms; they are left out of the compared street name.
STREET_KINDS = ["strasse", "str", "street", "st", "road", "rd", "lane", "ln", "way", "park", "via", "v", "rue", "r", "nr", "no"]
_KIND = re.compile(rf"\b(?:{'|'.join(STREET_KINDS)})\b\.?")
_ENDING = re.compile(r"(strasse|str)(?=\b|\.)")
_POST = re.compile(r"\b(?:[a-z]{2}[- ])?(\d{4,5}|[a-z]{1,2}\d[a-z\d]? \d[a-z]{2})\b")


def address_parts(*pieces: str | None) -> tuple[str, str, str]:
    """``(street words, house number, postal code)`` of an address given whole or in pieces; empty where missing.

    The street words hold the place's words too: order and layout differ, and both are compared as one set.
    """
    x = " ".join(fold(p) for p in pieces if p and fold(p).strip() not in {"-", "n/a", "k.a.", "none", "null", "?"})
    code = ""
    if m := _POST.search(x):
        code = re.sub(r"\s", "", m.group(1))
        x = x[: m.start()] + " " + x[m.end() :]
        x = _POST.sub(" ", x)
    number = ""
    if m := re.search(r"(?<![\d])(\d{1,4})\s?([a-z])?(?:\s?-\s?\d{1,4})?\b", x):
        number = m.group(1)
        x = x[: m.start()] + " " + x[m.end() :]
    x = _KIND.sub(" ", _ENDING.sub(" ", x))
    return " ".join(dict.fromkeys(t for t in re.findall(r"[a-z]{2,}", x))), number, code


def bit_vector(text: str, q: int = 2, bits: int = 64) -> int:
    """One bit for each q-gram of the padded text."""
    v = 0
    t = f"^{text}$"
    for i in range(len(t) - q + 1):
        v |= 1 << (xxhash.xxh3_64_intdigest(t[i : i + q]) % bits)
    return v


def _signed(v: int) -> int:
    return v - (1 << 64) if v >= 1 << 63 else v


def encoded(rows: DataFrame) -> DataFrame:
    """``rows(id, core, stems, pieces)`` as vectors: name, site, address with postal code, address with place.

    Null where the field is missing, so that missing fields make no candidates.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            out = []
            for r in f.itertuples(index=False):
                street, number, code = address_parts(*r.pieces)
                name = _signed(bit_vector(r.core)) if len(r.core) >= 4 else None
                first = street.split(" ")[0] if street else ""
                by_code = _signed(bit_vector(f"{first}|{number}|{code}", 2)) if first and number and code else None
                by_place = _signed(bit_vector(f"{street}|{number}", 2)) if number and " " in street else None
                sites = [_signed(bit_vector(s)) for s in r.stems]
                out.append((r.id, name, by_code, by_place, sites, street, number, code))
            yield pd.DataFrame(out, columns=["id", "v_name", "v_code", "v_place", "v_sites", "street", "number", "code"]).astype({"v_name": "Int64", "v_code": "Int64", "v_place": "Int64"})

    return rows.mapInPandas(run, "id bigint, v_name bigint, v_code bigint, v_place bigint, v_sites array<bigint>, street string, number string, code string")


@dataclass(frozen=True)
class Channel:
    """A kind of vectors and how they are searched: exactly, for all pairs of one block within ``radius`` bits."""

    column: str
    radius: int
    bands: int
    match: int

    def __post_init__(self):
        if self.bands - self.match < self.radius:
            raise ValueError("the search is exact up to bands - match bits only")

    def keys(self, v: Column) -> Column:
        """Array of bigint: one key for every choice of ``match`` of ``bands`` stripes of a 64-bit vector."""
        edges = [64 * i // self.bands for i in range(self.bands + 1)]
        stripes = [((1 << (b - a)) - 1) << a for a, b in zip(edges, edges[1:])]
        masks = [_signed(sum(stripes[i] for i in c)) for c in combinations(range(self.bands), self.match)]
        # one small expression over a constant array: a list of hashes would be a huge generated method
        return F.transform(F.lit(masks).cast("array<bigint>"), lambda m: F.xxhash64(v.bitwiseAND(m), m))


CHANNELS = (Channel("v_name", 4, 7, 3), Channel("v_code", 4, 8, 4), Channel("v_place", 6, 9, 3))


def close_vectors(left: DataFrame, right: DataFrame, channels: Sequence[Channel]) -> DataFrame:
    """``(channel, block, a, b)``: all pairs of different vectors ``left(channel, block, a)`` and ``right(..., b)`` of
    one channel (its number) and block within the channel's radius, exactly.

    Sparse vectors share stripes without any bit; the blocks split the keys that come of it.
    """

    def pick(values: Callable[[Channel], Column]) -> Column:
        out = F.lit(None)
        for i, c in enumerate(channels):
            out = F.when(F.col("channel") == i, values(c)).otherwise(out)
        return out

    def keyed(t: DataFrame, v: str) -> DataFrame:
        # a small table is read in one task, but the keys are many
        t = t.repartition(t.sparkSession.sparkContext.defaultParallelism)
        return t.select("channel", "block", v, F.explode(pick(lambda c: c.keys(F.col(v)))).alias("key"))

    # the keys are many times the vectors that the planner sees: never broadcast them
    near = keyed(left, "a").hint("merge").join(keyed(right, "b"), ["channel", "block", "key"])
    return near.where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= pick(lambda c: F.lit(c.radius))).select("channel", "block", "a", "b").distinct()


def candidate_pairs(left: DataFrame, right: DataFrame, ent: DataFrame, op: DataFrame, rp: DataFrame) -> DataFrame:
    """``(id, ent)``: rows of ``right`` and entities of ``left`` close in name, site or address.

    ``op`` and ``rp`` are their parts: all pairs whose whole cores (from two letters on) or sites are within the
    accepted edits are among them, and all pairs of names within 4 bits that share a country or a business word
    (a name alone makes no match), and all pairs of addresses with one house number whose vectors are within 4 or 6
    bits.  A single common word of longer cores makes no candidate: at 30000 rows that added 286 pairs, and the 14
    that were read shared a business word only.
    """
    kinds = F.explode(F.concat(F.array(F.struct(F.lit("name").alias("kind"), F.col("core").alias("s"))), F.transform("stems", lambda s: F.struct(F.lit("site").alias("kind"), s.alias("s")))))
    spelled = lambda p: p.select("id", kinds.alias("x")).select("id", "x.kind", "x.s").where("length(s) >= 2")
    a = materialize(spelled(rp).select("id", "kind", F.col("s").alias("a")).distinct(), "spelled")
    b = materialize(spelled(op).join(ent, "id").select("ent", "kind", F.col("s").alias("b")).distinct(), "spelled")
    near = similar_strings(a.select("a").distinct(), b.select("b").distinct())
    by_spelling = a.join(near, "a").select("id", "kind", "b").join(b, ["kind", "b"]).select("id", "ent")

    def vectors(encoded_rows: DataFrame, p: DataFrame, v: str) -> DataFrame:
        business = F.flatten(F.transform("business", lambda w: F.split(w, r"\|")))
        lands = F.coalesce(F.array(F.concat(F.lit("="), "country")), F.array())
        names = p.select("id", F.array_distinct(F.concat(business, lands)).alias("blocks"))
        each = [F.transform("blocks", lambda k: F.struct(F.lit(0).alias("channel"), k.alias("block"), F.col("v_name").alias("v")))]
        each += [F.array(F.struct(F.lit(i).alias("channel"), F.col("number").alias("block"), F.col(c.column).alias("v"))) for i, c in enumerate(CHANNELS) if i]
        return encoded_rows.join(names, "id").select("id", F.explode(F.concat(*each)).alias("x")).where("x.v is not null").select("id", "x.channel", "x.block", F.col("x.v").alias(v))

    a = materialize(vectors(right, rp, "a").distinct(), "vec")
    b = materialize(vectors(left, op, "b").join(ent, "id").select("ent", "channel", "block", "b").distinct(), "vec")
    on = ["channel", "block"]
    near = close_vectors(a.select(*on, "a").distinct(), b.select(*on, "b").distinct(), CHANNELS)
    by_vector = a.join(near, [*on, "a"]).select("id", *on, "b").join(b, [*on, "b"]).select("id", "ent")
    return by_spelling.union(by_vector).distinct()


def dice(a: Column, b: Column) -> Column:
    """Dice coefficient of two bit vectors; null if either is missing."""
    return 2 * F.bit_count(a.bitwiseAND(b)) / (F.bit_count(a) + F.bit_count(b))


#: Fields with a Dice coefficient, and fields that agree (1), differ (-1) or are unknown (0).
DICE_FIELDS, SIGN_FIELDS = ("d_name", "d_site", "d_address"), ("business", "country")
#: Lower bounds of the levels at which Dice coefficients are counted; level 0 is a missing field.
LEVELS = (0.0, 0.4, 0.6, 0.75, 0.85, 0.95)
#: The level from which on a field agrees.
AGREES = 5


def level(d: Column) -> Column:
    """0 for a missing Dice coefficient, else the number of bounds that it reaches."""
    return F.when(d.isNull(), 0).otherwise(sum(((d >= b).cast("int") for b in LEVELS), F.lit(0)))


@dataclass
class Confidence:
    """``1 / (1 + exp(-(intercept + sum of weights x values)))``.

    A Dice field has the weight of every level that its Dice reaches and, within a level, the share of the way to
    the next one of that one's weight, so the score rises steadily with the Dice.  A missing field and one that does
    not agree at all add nothing: a company may be registered under another name.  A sign field's value is its sign.
    Site and address that both agree have a weight of their own.
    """

    intercept: float
    steps: dict[str, list[float]]
    signs: dict[str, float]
    both: float = 0.0

    def column(self) -> Column:
        x = F.lit(self.intercept)
        ends = (*LEVELS[1:], 1.0)
        for f in DICE_FIELDS:
            for low, high, w in zip(LEVELS[1:], ends[1:], self.steps[f]):
                # half the weight on reaching the level, the rest on the way to the next
                way = F.least(F.greatest((F.col(f) - low) / (high - low), F.lit(0.0)), F.lit(1.0))
                x = x + F.coalesce(F.when(F.col(f) >= low, w * (0.5 + 0.5 * way)), F.lit(0.0))
        for f in SIGN_FIELDS:
            x = x + self.signs[f] * F.col(f)
        x = x + F.when((F.col("l_d_site") >= AGREES) & (F.col("l_d_address") >= AGREES), self.both).otherwise(0.0)
        return 1 / (1 + F.exp(-x))


#: The model before anything is counted: a name with a country or business, or site and address, make a match.
PRIOR = Confidence(
    -6.5,
    {"d_name": [0.0, 3.0, 1.5, 1.0, 0.5], "d_site": [0.0, 0.5, 1.0, 1.5, 1.5], "d_address": [0.0, 0.0, 0.5, 1.5, 2.5]},
    {"business": 2.0, "country": 1.5},
    1.0,
)


def _ruled_out(r: dict) -> bool:
    """Whether the problem itself says that such a pair is no match: a shared address, name or site alone, or a
    namesake with another line of business in another country."""
    name, site, address = (r[f"l_{f}"] for f in DICE_FIELDS)
    other = name <= LEVELS.index(0.4) + 1  # two edits of a name leave it a Dice of 0.6, but for short ones
    one_site, one_address = site > LEVELS.index(0.85), address > LEVELS.index(0.75)
    clash = r["business"] == -1 and r["country"] == -1
    return other and not (one_site and one_address) or clash and not one_site and not one_address


def calibrate(counts: list[dict], rounds: int = 200) -> Confidence:
    """The model of confidence from ``counts``: how many candidates (``n``) have each pattern of levels and signs,
    with the sums of their Dice coefficients.

    First two latent classes over the levels by expectation maximisation, a missing field weighing nothing, starting
    from the belief that matches agree; what the problem rules out stays no match (``_ruled_out``).  Then a logistic
    model of the classes with a weight for each field, none below zero.
    """
    fields = (*DICE_FIELDS, *SIGN_FIELDS)
    if not counts:
        return PRIOR
    n = np.array([r["n"] for r in counts], dtype=float)
    at = {f: np.array([r[f"l_{f}"] if f in DICE_FIELDS else (r[f] + 2) % 3 for r in counts]) for f in fields}  # -1, 0, 1 as 1, 2, 0
    none = {f: 0 if f in DICE_FIELDS else 2 for f in fields}
    size = {f: len(LEVELS) + 1 if f in DICE_FIELDS else 3 for f in fields}
    # belief at the start: a Dice level or sign speaks for a match the higher it is
    start = {f: np.linspace(0, 1, size[f]) if f in DICE_FIELDS else np.array([0.9, 0.1, 0.5]) for f in fields}
    g = np.mean([np.where(at[f] == none[f], 0.4, start[f][at[f]]) for f in fields], axis=0)
    out = np.array([_ruled_out(r) for r in counts])
    g = np.where(out, 0.0, 1 / (1 + np.exp(-8 * (g - 0.55))))
    for _ in range(rounds):
        prior = float(np.clip((g * n).sum() / n.sum(), 1e-3, 0.999))
        score = np.full(len(n), math.log(prior / (1 - prior)))
        for f in fields:
            known = at[f] != none[f]
            if not known.any():
                continue
            m, u = (np.bincount(at[f][known], weights=(w * n)[known], minlength=size[f]) for w in (g, 1 - g))
            # ten pseudo cases of the first belief keep every share away from 0 and carry very small tables
            m, u = (c + 10 * b / b.sum() for c, b in ((m, start[f] + 0.02), (u, 1.02 - start[f])))
            m, u = m / m.sum(), u / u.sum()
            # no field by itself rules a match out
            score += np.where(known, np.maximum(np.log(m / u), -1.5)[at[f]], 0.0)
        g = np.where(out, 0.0, 1 / (1 + np.exp(-np.clip(score, -30, 30))))
    ends = (*LEVELS[1:], 1.0)
    cols = []
    for f in DICE_FIELDS:
        mean = np.array([(r[f"s_{f}"] or 0.0) / max(r["n"], 1) for r in counts])
        for low, high in zip(LEVELS[1:], ends[1:]):
            way = np.clip((mean - low) / (high - low), 0.0, 1.0)
            cols.append(np.where((at[f] != none[f]) & (mean >= low), 0.5 + 0.5 * way, 0.0))
    cols += [np.array([r[f] for r in counts], dtype=float) for f in SIGN_FIELDS]
    cols.append(np.where((at["d_site"] >= AGREES) & (at["d_address"] >= AGREES), 1.0, 0.0))
    x = np.column_stack([np.ones(len(n)), *cols])
    first = np.array([PRIOR.intercept, *(w for f in DICE_FIELDS for w in PRIOR.steps[f]), *(PRIOR.signs[f] for f in SIGN_FIELDS), PRIOR.both])
    w = first.copy()
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (n * (g - p)) - 0.5 * (w - first)
        # a weight at zero moves only where agreement speaks for a match
        free = (w > 0) | (slope > 0)
        free[0] = True
        xf = x[:, free]
        step = np.linalg.solve(xf.T @ ((n * np.maximum(p * (1 - p), 1e-6))[:, None] * xf) + 0.5 * np.eye(free.sum()), slope[free])
        step *= min(1.0, 4.0 / np.abs(step).max())
        w[free] += step
        w[1:] = np.maximum(w[1:], 0.0)
        if np.abs(step).max() < 1e-8:
            break
    k = len(LEVELS) - 1
    steps = {f: w[1 + i * k : 1 + (i + 1) * k].tolist() for i, f in enumerate(DICE_FIELDS)}
    rest = w[1 + k * len(DICE_FIELDS) :].tolist()
    return Confidence(float(w[0]), steps, dict(zip(SIGN_FIELDS, rest)), rest[-1])


def _near_host(a: str, b: str) -> float:
    """Share of the letters that two hosts have in common if they are one but for slips, as many as a word of their
    second part's length may have; else 0."""
    n = min(len(x.split(".")[-2]) for x in (a, b))
    d = distance(a, b, tolerance(n))
    return 1 - d / n if d <= tolerance(n) else 0.0


def _compared_address(s1: str, n1: str, c1: str, s2: str, n2: str, c2: str) -> tuple[int, float | None]:
    """Whether two addresses are the same house (1), another (-1) or not comparable (0), and the Dice coefficient of
    their words, number and code, slips allowed.  What is missing on one side does not count."""
    if not s1 or not s2 or not n1 or not n2:
        return 0, None
    a, b = s1.split(" "), s2.split(" ")
    hits = sum(any(distance(x, y, 2) <= tolerance(min(len(x), len(y))) for y in b) for x in a)
    code = bool(c1 and c2 and (c1 == c2 or distance(c1, c2, 1) <= 1))
    coded = bool(c1 and c2)
    share = 2 * (min(hits, len(b)) + (n1 == n2) + code) / (len(a) + len(b) + 2 + 2 * coded)
    if n1 != n2:
        return -1, share
    return 1 if hits >= 2 or (hits >= 1 and (code or min(len(a), len(b)) == 1)) else -1, share


def scored_candidates(org: DataFrame, register: DataFrame) -> tuple[DataFrame, DataFrame, Confidence]:
    """Candidates ``(id, ent)`` with their fields and confidence, the entities, and the model of confidence."""
    op, rp, ent = prepared(org, register, ["legal_name"], "country", ["homepage"], "entry_id")
    both = lambda parts, rows, cols, key: parts.select("id", "core", "stems").join(
        rows.select(F.col(key).cast("bigint").alias("id"), F.array(*cols).alias("pieces")), "id"
    )
    left = materialize(encoded(both(op, org, ["address"], "id")), "left")
    right = materialize(encoded(both(rp, register, ["address_lines", "postal_code", "city"], "entry_id")), "right")
    cand = materialize(candidate_pairs(left, right, ent, op, rp), "pairs")
    # distances of name and site are taken from the best of the entity's rows
    vectors = ("v_name", "v_sites", "v_code", "v_place", "street", "number", "code")
    lrows = left.select(F.col("id").alias("oid"), *[F.col(c).alias(f"o_{c}") for c in vectors]).join(
        op.select(F.col("id").alias("oid"), F.col("strings").alias("o_strings"), F.col("hosts").alias("o_hosts")), "oid"
    ).join(ent.select(F.col("id").alias("oid"), "ent"), "oid")
    lrows = lrows.drop("oid").distinct()
    rrows = right.select("id", *vectors).join(rp.select("id", "strings", "hosts"), "id")
    wide = cand.join(rrows, "id").join(lrows, "ent")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            compared = [_compared_address(*t) for t in zip(f["street"], f["number"], f["code"], f["o_street"], f["o_number"], f["o_code"])]
            addr = [c[0] for c in compared]
            # slips and other layouts lower the Dice of the vectors more than that of the words
            words = pd.Series([np.nan if c[1] is None else c[1] for c in compared], index=f.index, dtype="float64")
            f = f.assign(d_address=pd.concat([f["d_address"].astype("float64"), words], axis=1).max(axis=1))
            dn, spelled = [], []
            for a, b in zip(f["strings"], f["o_strings"]):
                d = [(k, min(len(x), len(y)) - k) for x in a for y in b if (k := distance(x, y, tolerance(min(len(x), len(y))))) <= tolerance(min(len(x), len(y)))]
                dn.append(min(d)[0] if d else None)
                # letters that a spelling explains, of the longer whole name
                spelled.append(max(n for _, n in d) / max(len(a[0]), len(b[0])) if d else np.nan)
            f = f.assign(d_name=pd.concat([f["d_name"].astype("float64"), pd.Series(spelled, index=f.index, dtype="float64")], axis=1).max(axis=1))
            near = pd.Series([max((_near_host(x, y) for x in a for y in b), default=0.0) for a, b in zip(f["hosts"], f["o_hosts"])], index=f.index, dtype="float64")
            f = f.assign(d_site=pd.concat([f["d_site"].astype("float64"), near.where(near > 0)], axis=1).max(axis=1))
            dices = {c: f[c].astype("Float64") for c in DICE_FIELDS}
            yield pd.DataFrame({"id": f["id"], "ent": f["ent"], "dn": pd.array(dn, dtype="Int32"), "a": addr, "near": near > 0, **dices})

    best_site = F.array_max(F.flatten(F.transform("v_sites", lambda a: F.transform("o_v_sites", lambda b: dice(a, b)))))
    address = F.greatest(dice(F.col("v_code"), F.col("o_v_code")), dice(F.col("v_place"), F.col("o_v_place")))
    fields = [dice(F.col("v_name"), F.col("o_v_name")).alias("d_name"), best_site.alias("d_site"), address.alias("d_address")]
    wide = wide.select("id", "ent", "strings", "o_strings", "hosts", "o_hosts", "street", "number", "code", "o_street", "o_number", "o_code", *fields)
    rows = wide.mapInPandas(run, "id bigint, ent bigint, dn int, a int, near boolean, d_name double, d_site double, d_address double")
    per = rows.groupBy("id", "ent").agg(F.min("dn").alias("dn"), F.max("a").alias("best_a"), F.min("a").alias("worst_a"), F.max("near").alias("near"), *[F.max(c).alias(c) for c in DICE_FIELDS])
    per = materialize(per, "fields")
    ev = evidence(per.select("id", "ent", "dn", F.lit(None).cast("int").alias("ds"), F.lit(False).alias("ab")), rp, entity_parts(op, ent))
    ev = ev.select("id", "ent", F.col("b").alias("business"), F.col("c").alias("country"), "h", "hk").join(per, ["id", "ent"])
    scored = materialize(ev.select("*", *[level(F.col(f)).alias(f"l_{f}") for f in DICE_FIELDS]), "scored")
    # at most 7^3 x 3^2 patterns, however many pairs
    grouped = scored.groupBy(*[f"l_{f}" for f in DICE_FIELDS], *SIGN_FIELDS).agg(F.count(F.lit(1)).alias("n"), *[F.sum(f).alias(f"s_{f}") for f in DICE_FIELDS])
    model = calibrate([r.asDict() for r in grouped.orderBy(*[f"l_{f}" for f in DICE_FIELDS], *SIGN_FIELDS).collect()])
    return scored.withColumn("confidence", model.column()), ent, model


def match_companies(org: DataFrame, register: DataFrame, least: float = 0.5) -> DataFrame:
    """``(org_id, entry_id, confidence)`` of every organisation row and register entry that are the same company.

    A pair is accepted by its confidence (``least``).  The check that follows needs its name and one further field,
    or site and address together (a company registered under another name); a related name with another line of
    business in another country is a namesake, another name at the same address a neighbour, another name on the
    same site a dealer.  Missing fields speak neither way; rows without name, site and address match nothing;
    repeated rows match alike.
    """
    scored, ent, _ = scored_candidates(org, register)
    return _accepted(scored, ent, least)


def _accepted(scored: DataFrame, ent: DataFrame, least: float) -> DataFrame:
    name = F.col("dn").isNotNull() | (F.coalesce("d_name", F.lit(0.0)) >= 0.85)
    site, address = F.col("h") | F.col("near"), F.col("best_a") == 1
    business, country = F.col("business"), F.col("country")
    clash = (country == -1) | ((business == -1) & (country <= 0))
    support = (business == 1) | (country == 1) | site | address
    sound = (name & ~clash & support) | (site & address) | (name & site)
    kept = scored.where(sound & (F.col("confidence") >= least)).select("id", "ent", "confidence")
    return kept.join(ent.select(F.col("id").alias("org_id"), "ent"), "ent").groupBy("org_id", F.col("id").alias("entry_id")).agg(F.max("confidence").alias("confidence"))
