"""Scalar functions, table by table, and their idempotence."""

import random
from difflib import SequenceMatcher

import pytest
from pyspark.sql import functions as F

from claimloom.functions import address as A
from claimloom.functions import similarity as S
from claimloom.functions import text as T
from claimloom.functions import url as U
from claimloom.operators import evaluate as E
from claimloom.operators import search


def column(spark, values, f, ddl="string"):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {ddl}").select("i", f(F.col("x")).alias("y")).orderBy("i").collect()
    return [r.y for r in rows]


@pytest.mark.parametrize(
    ("f", "cases"),
    [
        (T.norm, {"  A   b\t": "a b", None: "", "": ""}),
        (lambda c: F.array_join(F.array_sort(T.brand_tokens(c)), " "), {"Rapid Technic AG (CH)": "rapid technic", "Müller & Co. KG": "ller", None: ""}),
        (T.maker_name, {"F.A.E. Group S.p.A.": "fae", "Colmac Italia": "colmac", None: ""}),
        (T.number_in, {"1.500 kg": 1.5, "-3,2": -3.2, "none": None, None: None}),
        (T.safe_token, {"a/b c": "a_b_c", None: ""}),
        (T.html_text, {"<p>a<br>b</p><script>x<1</script>": "a b", None: "", "a < b": "a < b"}),
        (T.code_of, {" P12 Raupe": "P12", "X1": None, None: None}),
        (T.application, {"Über-Last (neu)": "über last neu", None: ""}),
        (T.register_key, {" de 12.3 ": "DE123", "n/a": None, "-": None, None: None}),
        (T.json_slice, {'so: {"a": {"b": 1}} end': '{"a": {"b": 1}}', "{x": None, None: None}),
        (lambda c: T.truthy(c, "keep", True), {'{"keep": "false"}': True, '{"keep": 0}': False, '{"keep": null}': False, "{}": True, '{"keep": false}': False, '{"keep": ""}': False, '{"keep": true}': True}),
        (U.host, {"https://www.A-b.test:8080/x?y": "a-b.test:8080", "a.test/x": "", "https://ü_x.test": "ü_x.test", None: ""}),
        (U.norm_url, {" HTTPS://www.a.test/b-300x200.JPG?x#y": "a.test/b.jpg", "http://a.test/c/": "a.test/c", None: ""}),
        (U.update_key, {"https://A.test/b/?q=1": "https://a.test/b", None: ""}),
        (U.block_reason, {"https://www.ebay.de/x": "marketplace", "x": "no host", "https://ok.test/": "ok", "https://www.youtube.com": "social"}),
        (U.source_score, {"https://www.kubota.test/": 3, "https://ok.test/": 2, "https://ebay.de": 1, None: 1}),
        (U.site_root, {"https://a.test/b/c": "https://a.test/", "a": None, None: None}),
        (A.postal_code, {"Weg 12, 34567 Ort": "34567", "12345678": None, None: None}),
        (E.verdict_class, {"In-Scope ✓": "In-Scope", "Rad": "Out-of-Scope", "kein Objekt": "Kein Objekt", "unklar": "Unsicher", None: "", "ja": "In-Scope"}),
        (E.gold_label, {"no CAN": "target", "Unsicher": None, "Funksteuerung": "other", None: None}),
        (E.scope_label, {"Ausschluss (Triage)": "exclude", "🟡 Crawler-Lead": "lead", "offen": "open", None: ""}),
        (E.pattern_class, {"P3 Arm": "P3", "AGV": "out_scope", "in_scope": "in_scope", "": "unknown", None: "unknown"}),
    ],
)
def test_table(spark, f, cases):
    assert column(spark, list(cases), f) == list(cases.values())


@pytest.mark.parametrize("f", [T.norm, U.norm_url, E.pattern_class, T.application])
def test_idempotent(spark, f):
    v = ["  P12 Raupe", "HTTPS://www.a.test/b.jpg?x", "Über  Last", None, "AGV", ""]
    once = column(spark, v, f)
    assert column(spark, once, f) == once


def test_addresses(spark):
    cases = [("Weg 1, 12345 Ort", "12345 Stadt", True), ("Weg 1, 12345 Ort", "54321 Ort", False), ("Langer Weg Neustadt", "Neustadt", True), (None, "x", False), (None, None, False)]
    df = spark.createDataFrame(cases, "a string, b string, e boolean")
    assert [r.g == r.e for r in df.select("e", A.addresses_agree(df.a, df.b).alias("g")).collect()] == [True] * len(cases)


def test_ratio_and_hamming(spark):
    rng = random.Random(1)
    w = ["".join(rng.choice("abcd") for _ in range(rng.randrange(8))) for _ in range(40)]
    df = spark.createDataFrame([(a, b, float(SequenceMatcher(None, a, b).ratio())) for a in w[:20] for b in w[20:]], "a string, b string, e double")
    assert df.where(F.abs(S.matching_ratio("a", "b") - F.col("e")) > 1e-12).count() == 0
    h = [(f"{rng.getrandbits(64):016x}", f"{rng.getrandbits(64):016X}") for _ in range(30)] + [("0" * 16, "f" * 16), ("x", "f" * 16), (None, "f" * 16)]
    got = spark.createDataFrame(h, "a string, b string").select("a", "b", S.hamming(F.col("a"), F.col("b")).alias("d")).collect()
    for r in got:
        want = (int(r.a, 16) ^ int(r.b, 16)).bit_count() if r.a and len(r.a) == 16 else None
        assert r.d == want


def test_query_guard(spark):
    cases = {("tracked chipper", ""): "ok", ("tracked chip", ""): "bauteil_statt_maschine", ("tracked chip", "chip"): "ok", ("", ""): "empty", ("arm", ""): "no anchor", ("Raupen Modell", None): "ok", ("Raupen Modellbau", None): "spielzeug_privat"}
    df = spark.createDataFrame([(*k, v) for k, v in cases.items()], "q string, n string, e string")
    assert df.where(search.guard(df.q, df.n) != df.e).count() == 0
    q, n = search.split_negative(F.lit("raupe -rov kabel -lego"))
    assert spark.range(1).select(q, n).first() == ("raupe kabel", "rov lego")
    assert spark.range(1).select(search.with_negative(F.lit("raupe"), F.lit("rov lego"))).first()[0] == "raupe -rov -lego"
