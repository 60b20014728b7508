"""Organisation rows and other rows on companies as comparable parts, and the entities behind the rows.

Shared by the linking of typed variants and by the matching across sources.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimloom.functions.text import register_key, words
from claimloom.llm.names import Parser, country_code, host_of
from claimloom.operators.components import connected_components, star_edges
from claimloom.session import materialize

PARTS = "id bigint, core string, strings array<string>, business array<string>, bkey string, country string, hosts array<string>, stems array<string>, tokens array<string>"


def spellings_merged(pairs: DataFrame, group: str, word: str) -> DataFrame:
    """``(group, n, k)``: how many words of ``pairs(group, word, c)`` stand in each group, slips of one word counted as
    one (``n``), and how many as they are spelled (``k``); ``c`` is how often a word occurs.

    Words of up to 40 letters take the most frequent word with which they share a key after one deletion, so the
    slips of a word end at its usual spelling.  Built-in expressions and aggregations, however large a group is.
    """
    w = F.col(word)
    one_less = F.transform(F.sequence(F.lit(1), F.length(w)), lambda i: F.concat(F.substring(w, F.lit(1), i - 1), F.substring(w, i + 1, F.length(w))))
    keys = F.when(F.length(w) <= 40, F.array_append(F.array_distinct(one_less), w)).otherwise(F.array(w))
    keyed = pairs.where(F.length(w) > 0).select(group, word, "c", F.explode(keys).alias("_k"))
    usual = keyed.groupBy(group, "_k").agg(F.min(F.struct((-F.col("c")).alias("c"), w.alias("w"))).alias("_m"))
    label = keyed.join(usual, [group, "_k"]).groupBy(group, word).agg(F.min("_m").alias("_l"))
    return label.groupBy(group).agg(F.count_distinct("_l.w").alias("n"), F.count(F.lit(1)).alias("k"))


def common_words(names: DataFrame, column: str, share: float = 0.003, least: int = 8, ratio: float = 0.1) -> set[str]:
    """Words that stand near many different other words: business words.

    Near is up to three words away.  Slips of one companion count as one, so a firm with very many rows, whose few
    companions are typed in many ways, stays distinctive.  At most ``7 / share`` words times the words of a name.
    """
    w = materialize(names.select(F.array_distinct(words(F.col(column))).alias("w")).where(F.size("w") > 1).distinct(), "words")
    size = F.size("w")
    shifted = F.transform(F.array(*[F.lit(i) for i in (1, 2, 3)]), lambda i: F.arrays_zip(F.slice("w", F.lit(1), F.greatest(size - i, F.lit(0))).alias("t"), F.slice("w", i + 1, size).alias("u")))
    near = w.select(F.explode(F.flatten(shifted)).alias("x")).select("x.t", "x.u")
    near = near.union(near.select("u", "t")).where("length(t) >= 4 and length(u) >= 4")
    near = materialize(near.groupBy("t", "u").agg(F.count(F.lit(1)).alias("c")), "near")
    n = w.select(F.explode("w").alias("t")).groupBy("t").agg(F.count(F.lit(1)).alias("sets"))
    floor = max(least, share * w.count())
    enough = lambda k: (F.col(k) >= floor) & (F.col(k) >= ratio * F.col("sets"))
    often = near.groupBy("t").agg(F.count(F.lit(1)).alias("m")).where(F.col("m") >= floor).join(n, "t").where(enough("m"))
    return {r["t"] for r in spellings_merged(near.join(often.select("t", "sets"), "t").drop("sets"), "t", "u").join(n, "t").where(enough("n")).select("t").collect()}


def parts(rows: DataFrame, common: set[str], names: list[str], country: str, hosts: list[str], id_col: str) -> DataFrame:
    """The comparable parts of each row (columns of ``PARTS``); a null id is left out.

    ``names`` are columns with spellings of the row's name; the first with a core gives it.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        p = Parser(common)
        for f in frames:
            out = []
            for r in f.itertuples(index=False):
                parsed = [p.parse(getattr(r, f"n{i}")) for i in range(len(names))]
                first = next((x for x in parsed if x.core), parsed[0])
                strings: dict[str, None] = {}
                for x in parsed:
                    if x.core:
                        strings["".join(x.core)] = None
                    for t in x.core:
                        if len(t) >= 4:
                            strings[t] = None
                business = next((x.business for x in parsed if x.business), [])
                found = list(dict.fromkeys(h for i in range(len(hosts)) if (h := host_of(getattr(r, f"h{i}")))))
                stems = [p.stem(h) or "" for h in found]
                b = ["|".join(sorted(x)) for x in business]
                out.append((r.id, "".join(first.core), list(strings), b, "+".join(sorted(b)), country_code(r.country), found, stems, list(first.tokens)))
            yield pd.DataFrame(out, columns=["id", "core", "strings", "business", "bkey", "country", "hosts", "stems", "tokens"])

    cols = [F.col(id_col).cast("bigint").alias("id"), F.col(country).alias("country")]
    cols += [F.col(c).alias(f"n{i}") for i, c in enumerate(names)] + [F.col(c).alias(f"h{i}") for i, c in enumerate(hosts)]
    return rows.where(F.col(id_col).isNotNull()).select(*cols).mapInPandas(run, PARTS)


def shared_hosts(org_parts: DataFrame, least: int = 5, share: float = 0.2) -> DataFrame:
    """``(host)`` of the sites that list many different organisations, such as directories.

    Spellings of one name count as one; a site is shared if it lists at least ``least`` names that are at least
    ``share`` of the spellings on it, so a firm's own site stays its own however many rows give it.
    """
    h = org_parts.where("core <> ''").select(F.explode("hosts").alias("host"), "core").groupBy("host", "core").agg(F.count(F.lit(1)).alias("c"))
    many = h.groupBy("host").agg(F.count(F.lit(1)).alias("m")).where(F.col("m") >= least).select("host")
    merged = spellings_merged(h.join(many, "host", "left_semi"), "host", "core")
    return merged.where((F.col("n") >= least) & (F.col("n") >= share * F.col("k"))).select("host")


def without_shared(rows: DataFrame, shared: DataFrame) -> DataFrame:
    """``rows`` with shared hosts (and their stems) taken out of ``hosts`` and ``stems``."""
    h = rows.select("id", F.posexplode(F.arrays_zip("hosts", "stems")).alias("i", "x")).select("id", "i", F.col("x.hosts").alias("host"), F.col("x.stems").alias("stem"))
    kept = h.join(shared, "host", "left_anti").groupBy("id").agg(F.collect_set("host").alias("hosts"), F.collect_set("stem").alias("stems"))
    none = F.array().cast("array<string>")
    return rows.drop("hosts", "stems").join(kept, "id", "left").withColumns(
        {"hosts": F.coalesce("hosts", none), "stems": F.filter(F.coalesce("stems", none), lambda s: F.length(s) >= 4)}
    )


def entities(org: DataFrame, org_parts: DataFrame) -> DataFrame:
    """``(id, ent)``: organisation rows that name one organisation share the smallest id.

    Rows are joined by equal lei or vat, by equal core, business and country, and by equal core on one own host.
    """
    keys = org.select("id", register_key(F.col("lei")).alias("k1"), register_key(F.col("vat")).alias("k2"))
    named = org_parts.where("length(core) >= 5")
    full = named.where("bkey <> '' and country is not null").select("id", F.concat_ws("\n", "core", "bkey", "country").alias("k"))
    own = named.select("id", "core", F.explode("hosts").alias("host")).select("id", F.concat_ws("\n", "core", "host").alias("k"))
    edges = star_edges(keys, "id", "k1").union(star_edges(keys, "id", "k2")).union(star_edges(full, "id", "k")).union(star_edges(own, "id", "k"))
    cc = connected_components(edges)
    return org_parts.select("id").join(cc.select(F.col("node").alias("id"), "component"), "id", "left").select("id", F.coalesce("component", "id").alias("ent"))


def entity_parts(org_parts: DataFrame, ent: DataFrame) -> DataFrame:
    """``(ent, businesses, countries, hosts, tokens)``: the different values of each entity's rows."""
    x = org_parts.join(ent, "id")
    return x.groupBy("ent").agg(
        F.collect_set(F.when(F.size("business") > 0, F.col("business"))).alias("businesses"),
        F.collect_set("country").alias("countries"),
        F.array_distinct(F.flatten(F.collect_set("hosts"))).alias("hosts"),
        F.collect_set("tokens").alias("tokens"),
    )


def prepared(org: DataFrame, other: DataFrame, names: list[str], country: str, hosts: list[str], id_col: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Parts of the organisation rows, of the other rows, and the entities, as written tables."""
    common = common_words(org, "canonical_name")
    op = materialize(parts(org, common, ["canonical_name", "norm_name"], "country", ["domain"], "id"), "org")
    shared = materialize(shared_hosts(op), "shared")
    op = materialize(without_shared(op, shared), "org")
    sp = materialize(without_shared(materialize(parts(other, common, names, country, hosts, id_col), "other"), shared), "other")
    return op, sp, materialize(entities(org, op), "entities")
