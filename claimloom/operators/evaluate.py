"""Labels, confusion metrics, hit rates and balanced examples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimloom.functions.text import code_of, first_rule, norm
from claimloom.operators.ordered import first_by_key, top_n

#: Needles of the label classes, first hit wins.
VERDICT_RULES = [
    (["kein objekt", "unbrauchbar"], "Kein Objekt"),
    (["out", "rad", "raus", "ausser", "außer"], "Out-of-Scope"),
    (["unsicher", "unklar", "?"], "Unsicher"),
    (["in-scope", "in scope", "✓"], "In-Scope"),
]
GOLD_RULES = [
    (["unsicher"], ""),
    (["in-scope", "in scope", "no can", "nocan"], "target"),
    (["funksteuerung", "kein objekt", "unbrauchbar", "out of scope", "out-of-scope", "rad", "autonom"], "other"),
]
SCOPE_RULES = [
    (["ausschluss", "adjacent", "distributor", "exklusion", "umfirmiert"], "exclude"),
    (["crawler-lead"], "lead"),
    (["offen", "prüfen", "pruefen", "dedup"], "open"),
]
OUT_WORDS = [
    "adjacent", "exclusion", "ausschluss", "anti-pattern", "anti pattern", "agv", "spmt", "schreitbagger", "walking excavator", "spider excavator",
    "tbm", "tunnel boring", "sewer", "kanalinspektion", "pipe inspection", "wheeled", "radgetrieben", "radlader",
]


def verdict_class(c: Column) -> Column:
    """One of four classes of a typed verdict, or the empty text."""
    t = norm(c)
    return F.when(t == "ja", "In-Scope").otherwise(first_rule(t, VERDICT_RULES, ""))


def gold_label(c: Column) -> Column:
    """"target", "other", or null for verdicts that do not count."""
    return F.nullif(first_rule(norm(c), GOLD_RULES, ""), F.lit(""))


def predicted_label(c: Column) -> Column:
    t = norm(c)
    return F.when(F.contains(t, F.lit("in-scope")) | F.contains(t, F.lit("in scope")), "target").otherwise("other")


def scope_label(c: Column) -> Column:
    return first_rule(norm(c), SCOPE_RULES, "")


def pattern_class(c: Column) -> Column:
    """A pattern code, one of the fixed classes as it stands, out_scope for known exclusions, else unknown.  Idempotent."""
    t = norm(c)
    out = F.exists(F.array(*[F.lit(w) for w in OUT_WORDS]), lambda w: F.contains(t, w))
    return F.when(t.isin("out_scope", "unknown", "in_scope"), t).otherwise(F.coalesce(code_of(c), F.when(out, "out_scope"), F.lit("unknown")))


def confusion(pairs: DataFrame, gold: Column, predicted: Column) -> DataFrame:
    """One row: tp, fp, fn, tn, ignored, recall, precision, f1; a ratio without a denominator is 0."""
    g, p = gold, predicted
    n = pairs.agg(
        F.count_if((g == "target") & (p == "target")).alias("tp"),
        F.count_if((g == "other") & (p == "target")).alias("fp"),
        F.count_if((g == "target") & (p == "other")).alias("fn"),
        F.count_if((g == "other") & (p == "other")).alias("tn"),
        F.count_if(g.isNull()).alias("ignored"),
    )
    ratio = lambda a, b: F.coalesce(F.try_divide(a, b), F.lit(0.0))
    n = n.withColumns({"recall": ratio(F.col("tp"), F.col("tp") + F.col("fn")), "precision": ratio(F.col("tp"), F.col("tp") + F.col("fp"))})
    return n.withColumn("f1", ratio(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")))


def hit_rates(rows: DataFrame) -> DataFrame:
    """``rows(pattern, human, machine)`` -> hits for each pattern and over all (pattern null), in one pass.

    Unusable objects count as out of scope; rows without either class are left out.
    """
    one = lambda c: F.when(verdict_class(F.col(c)) == "Kein Objekt", "Out-of-Scope").otherwise(verdict_class(F.col(c)))
    x = rows.select(F.coalesce(code_of(F.col("pattern")), F.lit("?")).alias("pattern"), one("human").alias("m"), one("machine").alias("c")).where("m <> '' and c <> ''")
    return x.rollup("pattern").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("m") == F.col("c")).alias("hits")).withColumn("rate", F.col("hits") / F.col("n"))


def confused_pairs(rows: DataFrame) -> DataFrame:
    """``(human, machine, n)`` of the classes that differ."""
    x = rows.select(verdict_class(F.col("human")).alias("human"), verdict_class(F.col("machine")).alias("machine")).where("human <> '' and machine <> '' and human <> machine")
    return x.groupBy("human", "machine").agg(F.count(F.lit(1)).alias("n"))


def balanced_examples(rows: DataFrame, per_class: int = 4) -> DataFrame:
    """``rows(ord, maker, application, verdict)`` -> the first examples of each class, one for each maker and application."""
    x = rows.withColumn("class", verdict_class(F.col("verdict"))).where(F.col("class").isin("In-Scope", "Out-of-Scope", "Unsicher"))
    x = x.withColumn("key", F.concat_ws("|", norm(F.col("maker")), norm(F.col("application")))).where("key <> '|'")
    return top_n(first_by_key(x, ["key"], ["ord"]), ["class"], ["ord"], per_class).select("class", "ord", "key")
