"""Parsers of register payloads into claims.  Fetching is a connector's concern; these read stored payloads.

A connector is anything with ``fetch(spark, names) -> DataFrame(id, payload)``; ``claims_of`` turns its
payloads into claims.  Confidences are fixed values of each register.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimloom.operators.claims import register_claims

#: Fixed values: (predicate, JSON path, confidence) by register.
SPECS: dict[str, list[tuple[str, str, float]]] = {
    "lei_register": [
        ("lei", "$.data[0].attributes.lei", 0.95),
        ("legal_name", "$.data[0].attributes.entity.legalName.name", 0.95),
        ("address", "$.data[0].attributes.entity.legalAddress.addressLines[0]", 0.9),
        ("entity_status", "$.data[0].attributes.entity.status", 0.9),
    ],
    "vat_validator": [("vat_valid", "$.isValid", 0.95), ("legal_name", "$.name", 0.9), ("address", "$.address", 0.85)],
    "uk_register": [
        ("company_number", "$.items[0].company_number", 0.9),
        ("legal_name", "$.items[0].title", 0.9),
        ("entity_status", "$.items[0].company_status", 0.9),
        ("address", "$.items[0].address_snippet", 0.85),
    ],
    "knowledge_base": [("domain", "$.results.bindings[0].website.value", 0.7), ("country", "$.results.bindings[0].countryLabel.value", 0.7)],
    "contractor_register": [("uei", "$.entityData[0].entityRegistration.ueiSAM", 0.9), ("legal_name", "$.entityData[0].entityRegistration.legalBusinessName", 0.9)],
    "patents": [("patent_count", "$.total_hits", 0.7)],
    "radio_approval": [("radio_approval", "$.results[0].id", 0.85), ("product", "$.results[0].product", 0.7)],
}


def claims_of(payloads: DataFrame, register: str) -> DataFrame:
    """``(id, predicate, value, source_type, confidence)`` of ``payloads(id, payload)``."""
    return payloads.select("id", F.explode(register_claims(F.col("payload"), SPECS[register], register)).alias("c")).select("id", "c.*")


def legal_notice(html: Column) -> Column:
    """``struct(vat, director, street, zip, city)`` read from the text of a legal notice; null where not found."""
    from claimloom.functions.text import html_text

    t = html_text(html)
    address = r"([A-ZÄÖÜ][\wäöüß.\- ]{2,40}? \d+\s?[a-z]?),? (?:[A-Z]{1,2}-)?(\d{4,5}) ([A-ZÄÖÜ][\wäöüß\-]+)"
    got = lambda p, i: F.nullif(F.regexp_extract(t, p, i), F.lit(""))
    return F.struct(
        got(r"\b((?:DE|ATU|CHE)[ \-.]?\d[\d .\-]{6,13}\d)\b", 1).alias("vat"),
        got(r"(?:Geschäftsführer(?:in)?|Geschäftsführung|Managing Director)\s*:?\s*([A-ZÄÖÜ][\wäöüß\-]+(?: (?:von|van|de|der))* [A-ZÄÖÜ][\wäöüß\-]+)", 1).alias("director"),
        got(address, 1).alias("street"),
        got(address, 2).alias("zip"),
        got(address, 3).alias("city"),
    )


def cik_of(display_name: Column) -> Column:
    """The ten-digit CIK in a display name such as "Firm Inc (CIK 0001234567)"."""
    return F.nullif(F.regexp_extract(display_name, r"\(CIK (\d{10})\)", 1), F.lit(""))


def joined_address(*parts: Column) -> Column:
    """Address parts joined by ", "; missing parts become empty but keep their place."""
    return F.concat_ws(", ", *[F.coalesce(p, F.lit("")) for p in parts])


def patent_titles(titles: Column, n: int = 3, length: int = 60) -> Column:
    return F.array_join(F.transform(F.slice(titles, 1, n), lambda t: F.left(t, F.lit(length))), "; ")
