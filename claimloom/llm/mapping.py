"""Mapping values typed freely to the entries of a canonical list, with unmatched values reported.

Values are deduplicated, normalised, and looked up in an inverted index of character n-grams over the list;
candidates are scored by weighted cosine and accepted above a threshold and a margin.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimloom.functions.text import fold
from claimloom.llm.aliases import PREDICATE_ALIASES, VERDIKT_ALIASES
from claimloom.session import materialize

UNMATCHED = "UNMATCHED"


def normal_form(c: Column) -> Column:
    """Folded letters and digits only: case, spacing, punctuation and notes such as "(neu)" do not matter."""
    x = F.regexp_replace(F.replace(fold(c), F.lit("€"), F.lit("eur")), r"\((?:neu|new|alt|old)\)", "")
    return F.regexp_replace(x, "[^0-9a-z]", "")


def char_grams(c: Column) -> Column:
    """N-grams of a normal form between two marks: trigrams, and pairs of letters at distance one and two
    without their order, so that two swapped letters leave most of them in place."""
    ch = F.split(F.concat(F.lit("^"), c, F.lit("$")), "")
    one, two = (F.slice(ch, k, F.size(ch)) for k in (2, 3))

    def pair(mark: str):
        return lambda a, b: F.when(b.isNotNull(), F.concat(F.lit(mark), F.least(a, b), F.greatest(a, b)))

    # shifted arrays and not positions in the text: the work is linear in its length
    threes = F.zip_with(F.zip_with(ch, one, lambda a, b: F.concat(a, b)), two, lambda a, b: F.concat(a, b))
    grams = F.concat(threes, F.zip_with(ch, one, pair("1")), F.zip_with(ch, two, pair("2")))
    return F.when(F.length(c) > 0, F.array_compact(grams)).otherwise(F.array().cast("array<string>"))


def form_id(norm: Column) -> Column:
    """16 bytes that stand for a normal form, so that a very long one is not repeated with each of its grams."""
    return F.unhex(F.md5(norm))


def _weights(entries: DataFrame, keys: list[str]) -> DataFrame:
    return entries.select(*keys, F.explode(char_grams(F.col("norm"))).alias("gram")).groupBy(*keys, "gram").agg(F.count(F.lit(1)).alias("tf"))


def map_values(values: DataFrame, canon: DataFrame, threshold: float = 0.34, margin: float = 0.02) -> DataFrame:
    """``(field_name, form, canon_code, score)``, one row for every distinct normal form of
    ``values(field_name, value)``; ``form`` is its ``form_id``.

    ``canon(field_name, canon_code, text)`` holds the wordings of each entry.  A value takes the entry with the
    highest cosine if that reaches ``threshold`` and leads the next entry by ``margin``; else its code is
    UNMATCHED.  Two entries that tie are no match.  Values without a letter or digit are UNMATCHED.
    """
    forms = values.select("field_name", normal_form(F.col("value")).alias("norm")).distinct()
    forms = materialize(forms.withColumn("form", form_id(F.col("norm"))), "forms")
    entries = canon.select("field_name", "canon_code", normal_form(F.col("text")).alias("norm")).where("norm <> ''").distinct()
    entries = entries.withColumn("entry", form_id(F.col("norm")))
    eg = _weights(entries, ["field_name", "canon_code", "entry"])
    total = entries.select("field_name", "entry").distinct().groupBy("field_name").agg(F.count(F.lit(1)).alias("n"))
    idf = (
        eg.select("field_name", "gram", "entry").distinct().groupBy("field_name", "gram").agg(F.count(F.lit(1)).alias("d"))
        .join(total, "field_name").select("field_name", "gram", F.log(1 + F.col("n") / (F.col("d") + 0.5)).alias("idf"))
    )
    unseen = total.select("field_name", F.log(1 + F.col("n") / 0.5).alias("unseen"))
    eg = materialize(eg.join(idf, ["field_name", "gram"]).select("field_name", "canon_code", "entry", "gram", (F.col("tf") * F.col("idf")).alias("we")), "index")
    enorm = eg.groupBy("field_name", "canon_code", "entry").agg(F.sqrt(F.sum(F.col("we") * F.col("we"))).alias("elen"))
    vg = (
        _weights(forms, ["field_name", "form"]).join(idf, ["field_name", "gram"], "left").join(unseen, "field_name")
        .select("field_name", "form", "gram", (F.col("tf") * F.coalesce("idf", "unseen")).alias("wv"))
    )
    vg = materialize(vg, "grams")
    vlen = vg.groupBy("field_name", "form").agg(F.sqrt(F.sum(F.col("wv") * F.col("wv"))).alias("vlen"))
    # a value's candidates share one of its rarest n-grams: those whose rest is too light to reach the score, so
    # n-grams that are common in a long list make no pairs and no pair above the threshold is lost
    w = Window.partitionBy("field_name", "form").orderBy(F.desc("wv"), "gram")
    square = F.col("wv") * F.col("wv")
    rest = F.sum(square).over(Window.partitionBy("field_name", "form")) - F.coalesce(F.sum(square).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    least = max(threshold - margin, 0.0) ** 2 * 0.999999
    rare = vg.withColumn("rest", rest).withColumn("whole", F.sum(square).over(Window.partitionBy("field_name", "form"))).where(F.col("rest") >= least * F.col("whole"))
    pairs = rare.join(eg, ["field_name", "gram"]).select("field_name", "form", "canon_code", "entry").distinct()
    full = vg.join(pairs, ["field_name", "form"]).join(eg, ["field_name", "canon_code", "entry", "gram"])
    dots = full.groupBy("field_name", "form", "canon_code", "entry").agg(F.sum(F.col("wv") * F.col("we")).alias("dot"))
    scored = (
        dots.join(enorm, ["field_name", "canon_code", "entry"]).join(vlen, ["field_name", "form"])
        .groupBy("field_name", "form", "canon_code").agg(F.max(F.col("dot") / (F.col("elen") * F.col("vlen"))).alias("score"))
    )
    w = Window.partitionBy("field_name", "form").orderBy(F.desc("score"), "canon_code")
    top = scored.withColumn("r", F.row_number().over(w)).where("r <= 2")
    best = top.groupBy("field_name", "form").agg(
        F.max(F.when(F.col("r") == 1, F.col("canon_code"))).alias("code"),
        F.max(F.when(F.col("r") == 1, F.col("score"))).alias("score"),
        F.max(F.when(F.col("r") == 2, F.col("score"))).alias("second"),
    )
    sure = (F.col("score") >= threshold) & (F.col("score") - F.coalesce("second", F.lit(0.0)) >= margin)
    return forms.select("field_name", "form").join(best, ["field_name", "form"], "left").select(
        "field_name", "form", F.when(sure, F.col("code")).otherwise(UNMATCHED).alias("canon_code"), F.coalesce("score", F.lit(0.0)).alias("score")
    )


def mapped_rows(rows: DataFrame, canon: DataFrame, exact: DataFrame, threshold: float = 0.34, margin: float = 0.02) -> DataFrame:
    """``(field_name, row_id, canon_code)`` for every row whose value is not blank and not one of ``exact``
    (field_name, text) character by character.  Null values and values of white space give no row."""
    open_ = rows.where("value is not null").where(~F.col("value").rlike(r"(?U)^[\s​]*$"))
    open_ = open_.join(exact.select("field_name", F.col("text").alias("value")).distinct(), ["field_name", "value"], "left_anti")
    codes = map_values(open_, canon, threshold, margin)
    return open_.select("field_name", "row_id", form_id(normal_form(F.col("value"))).alias("form")).join(codes, ["field_name", "form"]).select("field_name", "row_id", "canon_code")


def _alias_rows(spark, field: str, aliases: dict[str, list[str]]) -> DataFrame:
    rows = [(field, code, text) for code, texts in aliases.items() for text in texts]
    return spark.createDataFrame(rows, "field_name string, canon_code string, text string")


def typed_verdicts_and_predicates(review: DataFrame, claim: DataFrame, verdikt_list: DataFrame, predicate_list: DataFrame, threshold: float = 0.34, margin: float = 0.02, aliases: bool = True) -> DataFrame:
    """``(field_name, row_id, canon_code)`` of the typed verdicts and predicates, UNMATCHED where none is meant.

    An entry's wordings are its own texts (of a hint also the parts between commas) and the common synonyms.
    Synonyms for codes that the lists do not hold are left out, all of them with ``aliases=False``.
    """
    spark = review.sparkSession
    v, p = F.lit("verdikt"), F.lit("predicate")
    texts = F.array_compact(F.concat(F.array("label", "hint"), F.split(F.coalesce("hint", F.lit("")), r"\s*,\s*")))
    verdicts = verdikt_list.select(v.alias("field_name"), F.col("verdikt_code").alias("canon_code"), F.explode(texts).alias("text"))
    predicates = predicate_list.select(p.alias("field_name"), F.col("predicate_code").alias("canon_code"), F.explode(F.array("predicate_code", "label_en", "label_de")).alias("text"))
    own = verdicts.union(predicates)
    extra = _alias_rows(spark, "verdikt", VERDIKT_ALIASES).union(_alias_rows(spark, "predicate", PREDICATE_ALIASES))
    extra = extra.join(own.select("field_name", "canon_code").distinct(), ["field_name", "canon_code"], "left_semi")
    exact = verdikt_list.select(v.alias("field_name"), F.col("label").alias("text")).union(predicate_list.select(p.alias("field_name"), F.col("predicate_code").alias("text")))
    rows = review.select(v.alias("field_name"), F.col("review_id").alias("row_id"), F.col("verdikt").alias("value")).union(
        claim.select(p.alias("field_name"), F.col("id").alias("row_id"), F.col("predicate").alias("value"))
    )
    return mapped_rows(rows, own.unionByName(extra).where("text is not null") if aliases else own.where("text is not null"), exact, threshold, margin)
