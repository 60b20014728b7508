"""Text expressions, all JVM-side."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Texts that stand for "no value" in typed tables, lower case.
PLACEHOLDERS = ["", "-", "--", "?", "n/a", "na", "n.a.", "k.a.", "ka", "none", "null", "nil", "unbekannt", "tbd", "xxx", "keine angabe", "entfällt"]

#: Legal forms, lower case, dots and spaces removed.
LEGAL_FORMS = [
    "ab", "ag", "aktiengesellschaft", "aps", "as", "bv", "co", "cokg", "company", "corp", "corporation", "eg", "ek", "ev",
    "gbr", "gesellschaft", "gesmbh", "gmbh", "gmbhcokg", "inc", "incorporated", "kg", "kgaa", "limited", "llc", "llp", "ltd", "mbh",
    "nv", "ohg", "oy", "oyab", "oyj", "plc", "sa", "sarl", "sas", "se", "sl", "spa", "spzoo", "srl", "ug", "zoo",
]


def squeeze(c: Column) -> Column:
    """Lower case, white space of any kind collapsed to one space and trimmed; null becomes the empty text."""
    return F.trim(F.regexp_replace(F.lower(F.coalesce(c.cast("string"), F.lit(""))), r"(?U)[\s ​﻿]+", " "))


def filled(c: Column) -> Column:
    """Whether a value says anything: not null, not blank, no placeholder text."""
    return ~squeeze(c).isin(PLACEHOLDERS)


def value_or_null(c: Column) -> Column:
    """The trimmed value, or null where ``filled`` is false."""
    return F.when(filled(c), F.trim(c.cast("string")))


def register_key(c: Column) -> Column:
    """A register or tax number without its notation: upper case letters and digits only, null for placeholders."""
    k = F.regexp_replace(F.upper(c.cast("string")), "[^0-9A-Z]", "")
    return F.when(filled(c) & (F.length(k) > 0), k)


def fold(c: Column) -> Column:
    """Lower case without accents: German umlauts as two letters (their usual replacement), others as the base letter."""
    x = F.lower(F.coalesce(c.cast("string"), F.lit("")))
    for a, b in (("ä", "ae"), ("ö", "oe"), ("ü", "ue"), ("ß", "ss"), ("æ", "ae"), ("ø", "o"), ("œ", "oe"), ("ł", "l")):
        x = F.replace(x, F.lit(a), F.lit(b))
    return F.translate(x, "áàâãåéèêëíìîïóòôõúùûýÿñçšžćčńśźżąęőű", "aaaaaeeeeiiiioooouuuyyncszccnszzaeou")


def words(c: Column) -> Column:
    """Words of the folded text as an array (letters and digits; anything else separates)."""
    return F.filter(F.split(fold(c), r"[^0-9a-z]+"), lambda w: F.length(w) > 0)


#: Words of a name that are legal forms or say nothing about the brand, for brand tokens.
BRAND_FORMS = ["gmbh", "ag", "inc", "ltd", "llc", "srl", "spa", r"s\.p\.a", r"s\.r\.l", "co", "kg", "bv", "oy", "ab", "as", "sa", "plc", "corp", "group", "holding"]
#: Noise words of a maker's name, for the entity key.
MAKER_NOISE = ["srl", "spa", "gmbh", "ag", "inc", "llc", "ltd", "co", "corp", "kg", "bv", "oy", "ab", "as", "sa", "sas", "group", "gruppe", "italia", "company", "the", "sro", "kft"]
#: Endings of names in company registers.
REGISTER_FORMS = [
    "gmbh", "ag", "se", "kg", "kgaa", "ohg", "mbh", "ug", "co", "ltd", "limited", "inc", "incorporated", "llc", "corp", "corporation",
    "plc", "srl", "spa", "bv", "nv", "oy", "ab", "as", "sa", "sas", "holding", "group", "company",
]


def norm(c: Column) -> Column:
    """Trimmed, lower case, white space collapsed; null becomes the empty text."""
    return squeeze(c)


def brand_tokens(c: Column) -> Column:
    """Different tokens of three and more ASCII letters or digits, without legal forms and bracketed parts.

    Letters outside a-z separate, as in the comparisons that this serves.
    """
    n = F.regexp_replace(norm(c), rf"(?U)\b({'|'.join(BRAND_FORMS)})\b", "")
    n = F.regexp_replace(n, r"\(.*?\)", "")
    return F.array_distinct(F.filter(F.split(n, "[^a-z0-9]+"), lambda t: F.length(t) >= 3))


def register_tokens(c: Column) -> Column:
    """Different tokens of three and more letters of a register name; umlauts stay letters."""
    s = F.lower(F.replace(F.regexp_replace(F.coalesce(c, F.lit("")), r"\(.*?\)", " "), F.lit("&"), F.lit(" ")))
    s = F.regexp_replace(s, rf"(?U)\b({'|'.join(REGISTER_FORMS)})\b\.?", " ")
    return F.array_distinct(F.filter(F.split(F.regexp_replace(s, "[^a-z0-9äöüß ]+", " "), " +"), lambda t: F.length(t) >= 3))


def maker_name(c: Column) -> Column:
    """A maker's name without dots, punctuation and noise words."""
    toks = F.split(F.replace(F.lower(F.coalesce(c.cast("string"), F.lit(""))), F.lit("."), F.lit("")), "[^a-z0-9]+")
    return F.array_join(F.filter(toks, lambda t: (t != "") & ~t.isin(MAKER_NOISE)), " ")


def plain_token(c: Column) -> Column:
    return F.regexp_replace(F.lower(F.coalesce(c.cast("string"), F.lit(""))), "[^a-z0-9]+", "")


def entity_key(maker: Column, model: Column) -> Column:
    """``struct(k1, k2)``: first word of the maker and the model, or the whole maker, or two empty texts."""
    o, m = maker_name(maker), plain_token(model)
    k1 = F.when(o == "", "").when(m != "", F.split(o, " ")[0]).otherwise(o)
    return F.struct(k1.alias("k1"), F.when(o == "", "").otherwise(m).alias("k2"))


def application(c: Column) -> Column:
    """An application or model name for comparison; umlauts stay, other signs become spaces."""
    return F.trim(F.regexp_replace(F.regexp_replace(norm(c), "[^a-z0-9äöüß ]+", " "), " +", " "))


def number_in(c: Column) -> Column:
    """The first signed decimal number of a text, comma or dot as decimal sign; null without one."""
    n = F.regexp_extract(c.cast("string"), r"[-+]?\d+(?:[.,]\d+)?", 0)
    return F.replace(n, F.lit(","), F.lit(".")).try_cast("double")


def safe_token(c: Column, length: int = 60) -> Column:
    """A text as part of a file name."""
    return F.left(F.regexp_replace(F.coalesce(c.cast("string"), F.lit("")), "[^A-Za-z0-9]+", "_"), F.lit(length))


def html_text(c: Column, length: int | None = None) -> Column:
    """Readable text of a page: scripts, styles and tags removed, white space collapsed; cut only if asked to."""
    t = F.regexp_replace(F.coalesce(c, F.lit("")), r"(?is)<(script|style|noscript).*?</\1>", " ")
    t = F.trim(F.regexp_replace(F.regexp_replace(t, r"(?s)<[^>]+>", " "), r"(?U)\s+", " "))
    return F.left(t, F.lit(length)) if length else t


def jaccard(a: Column, b: Column) -> Column:
    """Share of common elements of two arrays of different elements; 0 if either is empty."""
    return F.when((F.size(a) == 0) | (F.size(b) == 0), 0.0).otherwise(F.size(F.array_intersect(a, b)) / F.size(F.array_union(a, b)))


def json_slice(c: Column) -> Column:
    """What stands from the first { to the last } of a noisy text; null if that is no JSON."""
    s = F.regexp_extract(c, r"(?s)\{.*\}", 0)
    return F.when(F.try_parse_json(s).isNotNull() & (s != ""), s)


def truthy(json: Column, field: str, default: bool) -> Column:
    """Truth of a JSON field as scripting languages see it: a missing field is the default; null, 0, false and the
    empty text are false; everything else, also the text "false", is true."""
    v = F.try_variant_get(F.try_parse_json(json), "$." + field, "variant")
    kind = F.schema_of_variant(v)
    text = v.cast("string")
    return (
        F.when(v.isNull() & kind.isNull(), default)
        .when(F.is_variant_null(v), False)
        .when(kind == "BOOLEAN", text == "true")
        .when(kind.isin("BIGINT", "DOUBLE") | kind.startswith("DECIMAL"), text.try_cast("double") != 0)
        .otherwise(text != "")
    )


def code_of(c: Column) -> Column:
    """Leading code such as P12 of a text; null without one."""
    return F.nullif(F.regexp_extract(c, r"^\s*(P\d+)\b", 1), F.lit(""))


def first_rule(t: Column, rules: list[tuple[list[str], str]], otherwise: Column | str) -> Column:
    """The value of the first rule one of whose needles a text contains."""
    out = None
    for needles, value in rules:
        hit = F.exists(F.array(*[F.lit(n) for n in needles]), lambda n: F.contains(t, n))
        out = F.when(hit, value) if out is None else out.when(hit, value)
    return out.otherwise(otherwise)
