"""DataFrame operators against plain loops, with nulls, ties, repeats and empty tables."""

import random
from difflib import SequenceMatcher

import pytest
from pyspark.sql import functions as F

from claimloom.functions.text import norm
from claimloom.operators import claims, firms, gates, harvest, ordered, resolve, search
from claimloom.operators.components import connected_components
from claimloom.sources import registers


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_first_and_marked(spark):
    df = spark.createDataFrame([(1, "a", 2), (2, "a", 1), (3, None, 5), (4, None, 4), (5, "", 1), (6, "", 1)], "id int, k string, v int")
    assert rows(ordered.first_by_key(df, ["k"], ["v", "id"]).select("id")) == [(2,), (4,), (5,)]
    assert rows(ordered.first_by_key(df, ["k"], ["id"], last=True).select("id")) == [(2,), (4,), (6,)]
    got = {r.id: r.is_duplicate for r in ordered.mark_duplicates(df, ["k"], [F.col("v"), F.col("id")]).collect()}
    assert got == {1: True, 2: False, 3: False, 4: False, 5: False, 6: False}
    assert ordered.first_by_key(df.limit(0), ["k"], ["id"]).count() == 0
    assert rows(ordered.top_n(df, ["k"], ["id"], 1).select("id")) == [(1,), (3,), (5,)]
    assert [r.s for r in ordered.cumulative(df.where("k = 'a'"), ["k"], ["id"], "v", "s").orderBy("id").collect()] == [2, 3]


def test_last_update(spark):
    t = spark.createDataFrame([("a", "1"), ("b", "2"), (None, "3")], "k string, v string")
    u = spark.createDataFrame([("a", "x", 1), ("a", None, 2), ("z", "q", 1), (None, "n", 1)], "k string, v string, n int")
    assert rows(ordered.last_update_wins(t, u, "k", ["n"], ["v"])) == [("a", ""), ("b", "2"), (None, "3")]


def weak(names, orgs):
    import re

    from claimloom.functions.text import BRAND_FORMS

    forms = re.compile(r"\b(?:%s)\b" % "|".join(BRAND_FORMS))

    def toks(name):
        plain = re.sub(r"[(].*?[)]", "", forms.sub("", name.lower()))
        return {word for word in re.findall("[a-z0-9]+", plain) if len(word) > 2}

    out = {}
    for i, n in names:
        best = None
        for j, o in orgs:
            a, b = n.lower(), o.lower()
            c = []
            if len(a) >= 5 and len(b) >= 5 and (a in b or b in a):
                c.append((-min(len(a), len(b)) / max(len(a), len(b)), j, False, "substring"))
            ta, tb = toks(n), toks(o)
            if ta and tb and len(ta & tb) / len(ta | tb) >= 0.34:
                c.append((-len(ta & tb) / len(ta | tb), j, True, "brand"))
            for x in c:
                if best is None or x < best:
                    best = x
        if best:
            out[i] = (best[1], best[3])
    return out


def test_weak_matches(spark):
    rng = random.Random(2)
    words = ["rapid", "alpha", "kran", "technik", "nord", "lift", "boden", "gmbh", "co"]
    pick = lambda: " ".join(rng.sample(words, rng.randrange(1, 5)))
    names, orgs = [(i, pick()) for i in range(60)], [(i, pick()) for i in range(40)]
    new = spark.createDataFrame(names + [(99, None), (98, "")], "new_id bigint, name string")
    org = spark.createDataFrame(orgs, "id bigint, canonical_name string").withColumn("norm_name", norm(F.col("canonical_name")))
    got = {r.new_id: (r.org_id, r.tier) for r in resolve.weak_matches(new, org).collect()}
    assert got == weak(names, orgs)
    assert resolve.weak_matches(new.limit(0), org).count() == 0


def test_batch_names_is_the_fold(spark):
    rng = random.Random(3)
    seeds = [(i, rng.choice(["A", "a ", "B", "C"]), rng.choice([None, "DE", "AT", "CH"])) for i in range(60)]
    made, want = [], {}
    for o, n, c in seeds:
        hit = next((m for m in made if m[1] == n.strip().lower() and (c is None or m[2] is None or m[2] == c)), None)
        if hit is None:
            made.append((o, n.strip().lower(), c))
        want[o] = (hit or made[-1])[0]
    got = {r.ord: r.target for r in resolve.batch_names(spark.createDataFrame(seeds, "ord bigint, name string, country string")).collect()}
    assert got == want


def test_staged_merge(spark):
    ddl = "id bigint, canonical_name string, domain string, address string, vat string, hr_number string, lei string"
    org = spark.createDataFrame(
        [(1, "a", None, None, "V1", None, "L1"), (2, "b", "d2", None, "V2", None, "L1"), (3, "c", None, "x", "V2", "H", None), (4, "d", None, None, None, "H", "-"), (5, "e", None, None, None, None, "-")], ddl
    )
    merged, mapping = resolve.merge_by_keys(org)
    # 1 keeps its own vat, so 3 does not follow 2 into it
    assert {r.id: r.survivor_id for r in mapping.collect()} == {1: 1, 2: 1, 3: 3, 4: 3, 5: 5}
    assert {(r.id, r.domain, r.vat) for r in merged.collect()} == {(1, "d2", "V1"), (3, None, "V2"), (5, None, None)}
    facts = spark.createDataFrame([(2, "x"), (4, "y"), (77, "z"), (None, "n")], "subject_id bigint, v string")
    assert rows(resolve.repoint(facts, "subject_id", mapping)) == [(1, "x"), (3, "y"), (77, "z"), (None, "n")]


def test_review_decisions(spark):
    p = spark.createDataFrame([("a", "b"), ("c", "d")], "new_name string, matched_name string")
    dec = spark.createDataFrame([("a", "b", "merge", 1), ("a", "b", "keep-separate", 2), ("q", "q", "merge", 3)], "new_name string, matched_name string, decision string, n int")
    assert rows(resolve.apply_review(p, dec)) == [("a", "b", "keep-separate"), ("c", "d", "pending")]


def test_corroboration_is_repeatable(spark):
    org = spark.createDataFrame([(1, 0.2), (2, 0.2), (3, 0.2), (4, None)], "id bigint, confidence double")
    c = [
        (1, "organization", 1, "address", "Weg 1, 12345 Ort", "gleif"), (2, "organization", 1, "address", "12345 Ort", " VIES"), (3, "organization", 2, "address", "12345 Ort", "gleif"),
        (4, "organization", 2, "address", "99999 Wo", "vies"), (5, "organization", 3, "lei", "L", "gleif"), (6, "organization", 3, "lei", "", "vies"), (7, "organization", 1, "address_verified", "true", "verify"), (8, None, None, None, None, None),
    ]
    cl = spark.createDataFrame(c, "id bigint, subject_type string, subject_id bigint, predicate string, object_value string, source_type string")
    got = {r.id: (r.n_sources, r.address_status, r.verdict, r.confidence) for r in claims.corroborate(org, cl).collect()}
    assert got == {1: (2, "verified", "verified", 1.0), 2: (2, "conflict", "verified", 1.0), 3: (1, "few", "single source", 0.5), 4: (0, "few", "unconfirmed", None)}
    assert claims.corroboration_stats(claims.corroborate(org, cl)).first().address_verified == 1


def test_firm_cascade(spark):
    firmlist = [(1, "Rapid Technic AG"), (2, "Lindner Kranbau"), (3, "Nordlift Bodentechnik GmbH"), (4, "rapid technic ag")]
    cands = [(1, "RAPID TECHNIC AG"), (2, "Lindner Kranbau Nord"), (3, "Bodentechnik Nordlift"), (4, "Lindnar Werk"), (5, "Zzz"), (6, None), (7, "")]
    f, c = spark.createDataFrame(firmlist, "firm_id bigint, name string"), spark.createDataFrame(cands, "cand_id bigint, name string")
    got = {r.cand_id: (r.firm_id, r.level) for r in firms.firm_matches(c, f).collect()}
    assert got == {1: (4, "exact"), 2: (2, "exact"), 3: (3, "exact"), 4: (2, "similar") if SequenceMatcher(None, "lindnar", "lindner").ratio() >= 0.85 else (None, "none"), 5: (None, "none"), 6: (None, "none"), 7: (None, "none")}
    known = spark.createDataFrame([(1, "Mulchraupe"), (1, None), (2, "Kran")], "firm_id bigint, application string")
    cand = spark.createDataFrame([(1, 1, "mulchraupe 2"), (2, 1, "Fräse"), (3, 2, "Kram"), (4, 2, None), (5, 1, "Mulchraupen")], "cand_id bigint, firm_id bigint, application string")
    assert {r.cand_id for r in firms.known_applications(cand, known).collect()} == {1, 5}


def test_similar_tokens_against_all_pairs(spark):
    rng = random.Random(12)
    left = {"".join(rng.choice("abcde") for _ in range(rng.randrange(3, 14))) for _ in range(150)}
    right = set()
    for w in left:
        for _ in range(rng.randrange(3)):
            i = rng.randrange(len(w))
            w = rng.choice([w[:i] + w[i + 1 :], w[:i] + rng.choice("abcde") + w[i:], w[:i] + w[i + 1 : i + 2] + w[i : i + 1] + w[i + 2 :]])
        right.add(w)
    one = lambda ws, c: spark.createDataFrame([(w,) for w in ws], f"{c} string")
    got = {(r.a, r.b) for r in firms.similar_tokens(one(left, "a"), one(right, "b")).collect()}
    want = {(a, b) for a in left for b in right if b and abs(len(a) - len(b)) <= 2 and SequenceMatcher(None, a, b).ratio() >= 0.85}
    assert got == want and len(want) > 60


def test_names_that_many_rows_share(spark):
    new = spark.range(300).select(F.col("id").alias("new_id"), F.lit("Rapid Kran").alias("name"))
    org = spark.range(300).select("id", F.lit("Rapid Kranbau").alias("canonical_name"), F.lit(None).cast("string").alias("norm_name"))
    got = resolve.weak_matches(new, org)
    assert got.count() == 300 and {r.org_id for r in got.collect()} == {0}
    apart = spark.createDataFrame([(5, 0), (5, 1), (6, 7)], "new_id bigint, id bigint")
    got = {r.new_id: r.org_id for r in resolve.weak_matches(new, org, apart=apart).collect()}
    assert got[5] == 2 and got[6] == 0 and len(got) == 300
    assert resolve.weak_matches(new, org, rules=[("rapid kran", "kranbau")]).count() == 0


@pytest.mark.parametrize("most", [0, 1000])
def test_contained_pattern(spark, most):
    rng = random.Random(4)
    text = lambda: "".join(rng.choice("abc ") for _ in range(rng.randrange(8))).strip()
    names, keys = [(i, text()) for i in range(120)] + [(900, None)], [(i, f"P{i}", text()) for i in range(40)]
    got = {r.id: r.code for r in firms.contained_pattern(spark.createDataFrame(names, "id int, name string"), spark.createDataFrame(keys, "ord int, code string, key string"), most).collect()}
    want = {}
    for i, n in names:
        n = " ".join((n or "").split())
        hit = next((c for _, c, k in keys if n and k.strip() and (" ".join(k.split()) in n or n in " ".join(k.split()))), None)
        if hit:
            want[i] = hit
    assert got == want and want


def test_dedup_status(spark):
    customers = spark.createDataFrame([(1, "Rapid Technic AG", "Mulchraupe"), (1, "Rapid Technic AG", None), (2, "Lindner Kranbau", "Kran"), (3, None, "x")], "firm_id bigint, name string, application string")
    rows_ = [(1, "rapid technic ag", "Mulchraupe 2", None), (2, "Rapid Technic AG", "Fräse", "F1"), (3, "Lindnre Werk", "Kran", None), (4, "Zzz", "Kran", None), (5, None, None, None), (6, "Lindner Kranbau", None, "kran")]
    cand = spark.createDataFrame(rows_, "cand_id bigint, name string, application string, model string")
    got = {r.cand_id: r.status for r in firms.dedup_status(cand, customers).collect()}
    similar = SequenceMatcher(None, "lindnre", "lindner").ratio() >= 0.85
    assert got == {1: "duplicate", 2: "new application", 3: "check" if similar else "new", 4: "new", 5: "new", 6: "duplicate"}


def test_tunnel_blocks_only_inspection(spark):
    from claimloom.operators import search

    q = [("tracked tunnel drill", "ok"), ("tunnel kamera raupe", "tunnel inspection"), ("raupe chipper", "ok"), ("raupe chip", "bauteil_statt_maschine"), ("modell raupe", "ok"), ("", "empty"), ("bagger", "no anchor")]
    df = spark.createDataFrame([(a, "") for a, _ in q], "q string, n string")
    assert [r[0] for r in df.select(search.guard(F.col("q"), F.col("n"))).collect()] == [w for _, w in q]


def test_review_decisions_are_carried_out(spark):
    from claimloom.operators import imports

    ddl = "id bigint, canonical_name string, norm_name string, lei string, domain string, note string"
    org = spark.createDataFrame([(1, "Aa", "aa", None, "a.test", None), (2, "Bb", "bb", "L2", "-", "x"), (3, "Cc", None, "L3", None, "y"), (4, "Dd", "dd", None, None, None), (5, "Ee", "ee", None, None, None)], ddl)
    sheet = [(1, "Bb", "Aa", "merge"), (2, "Cc", "bb ", "Merge"), (3, "Dd", "Ee", "getrennt"), (4, "Zz", "Aa", "merge"), (5, "Dd", "Ee", None), (6, "Dd", "Ee", "merge"), (7, "Ee", "Dd", "merge"), (8, "Bb", "Ee", "merge")]
    mapping, stats = imports.decided_merges(org, spark.createDataFrame(sheet, "n int, new_name string, matched_name string, decision string"))
    assert {r.id: r.survivor_id for r in mapping.collect()} == {1: 1, 2: 1, 3: 1, 4: 4, 5: 4}
    assert tuple(stats.first()) == (5, 1, 1, 1)
    assert {(r.id, r.lei, r.domain, r.note) for r in imports.merged_into(org, mapping).collect()} == {(1, "L2", "a.test", None), (4, None, None, None)}
    none = spark.createDataFrame([], "n int, new_name string, matched_name string, decision string")
    assert imports.decided_merges(org, none)[0].count() == 0 and imports.merged_into(org, imports.decided_merges(org, none)[0]).count() == 5


def test_import_in_order(spark):
    from claimloom.operators import imports

    org = spark.createDataFrame([(10, "Rapid Technic AG", "rapid technic ag", "CH")], "id bigint, canonical_name string, norm_name string, country string")
    seeds_ = [(1, "rapid  technic AG", None), (2, "Rapid Technic AG", "DE"), (3, "Zunalib Kran", "AT"), (4, "zunalib kran", None), (5, "Zunalib Kranbau", "AT"), (6, None, None), (7, "", None)]
    out = imports.import_outcomes(spark.createDataFrame(seeds_, "ord bigint, name string, country string"), org)
    got = {r.ord: (r.outcome, r.matched) for r in out.collect()}
    assert got == {1: ("merged-norm", 10), 2: ("review", 10), 3: ("created", None), 4: ("merged-norm", -4), 5: ("review", -4), 6: ("created", None), 7: ("merged-norm", -7)}
    assert tuple(imports.import_counters(out).first()) == (7, 3, 2, 2)
    filled, stats = imports.enriched(org.selectExpr("id", "'' AS lei", "'d' AS domain", "CAST(NULL AS STRING) AS address"), spark.createDataFrame([(1, "organization", 10, "lei", "L", "gleif"), (2, "organization", 10, "domain", "e", "x")], "id bigint, subject_type string, subject_id bigint, predicate string, object_value string, source_type string"))
    assert tuple(filled.first()) == (10, "L", "d", None) and tuple(stats.first()) == (1, 1, 0, 0, 2)


def test_gates(spark):
    s = spark.createDataFrame([(0, 0, 0, None), (10, 2, 8, 1.0)], "found int, new int, junk int, mean_score double")
    assert [r.warnings for r in gates.image_gate(s).collect()] == [0, 3]
    s = spark.createDataFrame([(0, 0, 0, None), (1, 9, 5, 2.5)], "kept int, rejected int, direct int, mean_score double")
    assert [(r.stop, r.direct_share) for r in gates.crawl_gate(s).collect()] == [(True, 0.0), (False, 1.0)]
    s = spark.createDataFrame([(0, 0, 0, 0)], "found int, new int, strong int, score_sum int")
    assert gates.text_gate(s).first().stop
    s = spark.createDataFrame([(0, 0, 0, 0)], "new int, known int, candidates int, rejected int")
    assert gates.discovery_gate(s).first().warnings == 2


def test_harvests(spark):
    res = [(1, "P1", "q", "https://a-track.test/x.jpg", "t"), (2, "P1", "q", "http://www.a-track.test/x.jpg?y", "t"), (3, "P1", "q", "https://ebay.de/z.jpg", "t"), (4, "P2", "q", "https://k.test/k.jpg", "t"), (5, "P2", "q", None, None)]
    r = spark.createDataFrame(res, "ord int, pattern string, query string, url string, title string")
    new, stats = harvest.image_harvest(r, spark.createDataFrame([("https://k.test/k.jpg",)], "url string"))
    assert [x.ord for x in new.collect()] == [1]
    assert {x.pattern: (x.found, x.junk, x.new) for x in stats.collect()} == {"P1": (3, 1, 1), "P2": (2, 1, 0)}
    kept, stats = harvest.text_harvest(r, judge=lambda df: df.where("ord <> 1"))
    assert {x.ord for x in kept.collect()} == {4}  # the rejected first hit hides the second of its domain
    assert [x.name for x in harvest.discover(r, spark.createDataFrame([("zzz",)], "name string")).orderBy("ord").collect()] == ["t", "t"]
    c = spark.createDataFrame([(1, "p"), (2, "p"), (3, "q")], "ord int, page string")
    assert {x.ord for x in harvest.enrich(c, lambda p: p.withColumn("v", F.lit(1)), limit=1).collect()} == {1, 2}
    pages = spark.createDataFrame([("https://a.test/x", "<p>kurz</p>"), ("https://a.test/", "viel " * 60), ("https://b.test/y", None)], "url string, html string")
    assert {x.url: len(x.text) for x in harvest.deep_pages(pages).collect()} == {"https://a.test/x": 299, "https://a.test/": 299, "https://b.test/y": 0}


def test_page_links(spark):
    html = '<meta property="og:image" content="/o.jpg"><img src="b.png"><img data-src="//c.test/d.webp"><img src="/logo.png"><a href="/produkte/1">x</a><a href="https://z.test/produkt">y</a><a href="/a.pdf">p</a><a href="/datenblatt.pdf">p</a>'
    df = spark.createDataFrame([(html, "https://a.test/p/q")], "h string, b string")
    r = df.select(harvest.image_links(df.h, df.b).alias("i"), harvest.product_links(df.h, df.b).alias("p"), harvest.datasheet_link(df.h, df.b).alias("d")).first()
    assert r.i == ["https://a.test/o.jpg", "https://a.test/b.png", "https://c.test/d.webp"] and r.p == ["https://a.test/produkte/1"] and r.d == "https://a.test/datenblatt.pdf"
    s = spark.createDataFrame([(4000, 400, 300), (4000, 2000, 300), (100, 400, 300), (4000, None, 300)], "n int, w int, h int")
    assert [x[0] for x in s.select(harvest.image_size_ok(s.n, s.w, s.h)).collect()] == [True, False, False, False]


def test_registers(spark):
    p = '{"data":[{"attributes":{"lei":"L1","entity":{"legalName":{"name":"Firm"},"status":"ACTIVE"}}}]}'
    df = spark.createDataFrame([(1, p), (2, "no json"), (3, None)], "id int, payload string")
    assert rows(registers.claims_of(df, "lei_register").select("id", "predicate", "value")) == [(1, "entity_status", "ACTIVE"), (1, "legal_name", "Firm"), (1, "lei", "L1")]
    n = spark.createDataFrame([("<p>Geschäftsführer: Max Muster</p> Lange Straße 12, 12345 Ort USt: DE 123456789", "Firm Inc (CIK 0001234567)")], "h string, c string")
    r = n.select(registers.legal_notice(n.h).alias("x"), registers.cik_of(n.c).alias("c")).first()
    assert (r.x.vat, r.x.director, r.x.zip, r.x.city, r.c) == ("DE 123456789", "Max Muster", "12345", "Ort", "0001234567")


def test_seeded_queries(spark):
    p = spark.createDataFrame([("P1", "raupe arm", "kette [segment]", "Bild", ""), ("P2", "Raupe Arm", "kette x", "Beides", None), ("P3", "toy raupe", "raupe b", "Beides", "")], "code string, img_query string, text_terms string, harvest_method string, exclude_terms string")
    k = spark.createDataFrame([("KETTE x",)], "query string")
    assert rows(search.seeded(p, k)) == [("P1", "image", "raupe arm"), ("P3", "text", "raupe b")]
    q = spark.createDataFrame([("raupe", "", True), ("raupe", "", False), ("x", "", True)], "query string, negative string, active boolean")
    assert [r.reason for r in search.repository(q).collect()] == ["ok", "inactive", "no anchor"]


def test_components_of_nothing(spark):
    assert connected_components(spark.createDataFrame([(None, 1), (2, 2)], "src bigint, dst bigint")).count() == 0


def sizes_written(monkeypatch, *modules):
    """The rows of every table that the modules write from now on."""
    from claimloom.session import materialize

    sizes = []

    def counted(df, *name):
        out = materialize(df, *name)
        sizes.append(out.count())
        return out

    for m in modules:
        monkeypatch.setattr(m, "materialize", counted)
    return sizes


def test_common_words_list_no_pairs(spark, monkeypatch):
    sizes = sizes_written(monkeypatch, resolve)
    new = spark.range(300).selectExpr("id AS new_id", "concat('Tracked Vehicles a', lpad(id, 4, '0')) AS name")
    org = spark.range(300).selectExpr("id", "concat('b', lpad(id, 4, '0'), ' Tracked Vehicles') AS canonical_name", "CAST(NULL AS string) AS norm_name")
    got = resolve.weak_matches(new, org).collect()
    assert len(got) == 300 and {(r.org_id, r.tier, r.score) for r in got} == {(0, "brand", 0.5)}
    assert sizes and max(sizes) <= 1200


def test_weak_matches_of_long_names_and_rules(spark):
    rng = random.Random(5)
    words = ["rapid", "alpha", "kran", "technik", "nord", "lift", "boden", "gmbh", "ost", "west", "berg", "tal", "bau", "werk", "rohr"]
    pick = lambda: " ".join(rng.sample(words, rng.choice([1, 2, 3, 4, 9, 11, 14])))
    names, orgs = [(i, pick()) for i in range(60)], [(i, pick()) for i in range(60)]
    new = spark.createDataFrame(names, "new_id bigint, name string")
    org = spark.createDataFrame(orgs, "id bigint, canonical_name string").withColumn("norm_name", norm(F.col("canonical_name")))
    assert {r.new_id: (r.org_id, r.tier) for r in resolve.weak_matches(new, org).collect()} == weak(names, orgs)
    apart = lambda a, b: ("kran" in a and "lift" in b) or ("lift" in a and "kran" in b)
    want = {i: hit for i, n in names for hit in weak([(i, n)], [(j, o) for j, o in orgs if not apart(n, o)]).values()}
    assert {r.new_id: (r.org_id, r.tier) for r in resolve.weak_matches(new, org, rules=[("kran", "lift")]).collect()} == want
    # one normal name, two spellings: each with its own tokens
    org = spark.createDataFrame([(1, "Zzz", "x"), (2, "Rapid Kran", "x")], "id bigint, canonical_name string, norm_name string")
    assert [tuple(r) for r in resolve.weak_matches(spark.createDataFrame([(7, "kran rapid")], "new_id bigint, name string"), org).collect()] == [(7, 2, "brand", 1.0)]


def test_import_lists_no_pairs(spark, monkeypatch):
    from claimloom.operators import imports

    sizes = sizes_written(monkeypatch, resolve, imports)
    org = spark.range(200).selectExpr("id", "concat('b', lpad(id, 4, '0'), ' Tracked Vehicles') AS canonical_name", "CAST(NULL AS string) AS norm_name", "'DE' AS country")
    new = spark.range(200).selectExpr("id AS ord", "concat(if(id < 100, 'Tracked Vehicles a', 'Crawler Cranes a'), lpad(id, 4, '0')) AS name", "'DE' AS country")
    got = {r.ord: (r.outcome, r.matched) for r in imports.import_outcomes(new, org).collect()}
    assert got == {i: ("review", 0) if i < 100 else ("created", None) if i == 100 else ("review", -101) for i in range(200)}
    assert sizes and max(sizes) <= 1200


def test_firms_list_no_pairs(spark, monkeypatch):
    sizes = sizes_written(monkeypatch, resolve, firms)
    tried = []
    monkeypatch.setattr(firms, "similar_tokens", lambda a, b, *x, _f=firms.similar_tokens: (tried.append({r.a for r in a.collect()}), _f(a, b, *x))[1])
    f = spark.range(200).selectExpr("id AS firm_id", "concat('b', lpad(id, 4, '0'), ' Tracked Vehicles') AS name")
    c = spark.range(200).selectExpr("id AS cand_id", "concat(if(id < 100, 'Tracked Vehicles a', 'Tracked a'), lpad(id, 4, '0')) AS name")
    c = c.union(spark.createDataFrame([(900, "Trackd Werk")], "cand_id bigint, name string"))
    got = {r.cand_id: (r.firm_id, r.level, r.score) for r in firms.firm_matches(c, f).collect()}
    near = SequenceMatcher(None, "trackd", "tracked").ratio()
    assert got == {i: (0, "exact", 0.5) if i < 100 else (0, "similar", 1.0) for i in range(200)} | {900: (0, "similar", near)}
    assert max(sizes) <= 1200 and tried == [{"trackd", "werk"}]


@pytest.mark.parametrize("least", [0.85, 0.7])
def test_similar_tokens_of_other_ratios(spark, least):
    rng = random.Random(13)
    left = {"".join(rng.choice("abc") for _ in range(rng.randrange(6, 11))) for _ in range(120)}
    right = {"".join(rng.choice("abc") for _ in range(rng.randrange(6, 11))) for _ in range(120)} | set(list(left)[:20])
    one = lambda ws, c: spark.createDataFrame([(w,) for w in ws], f"{c} string")
    got = {(r.a, r.b) for r in firms.similar_tokens(one(left, "a"), one(right, "b"), least).collect()}
    assert got == {(a, b) for a in left for b in right if abs(len(a) - len(b)) <= 2 and SequenceMatcher(None, a, b).ratio() >= least}


def test_merge_review_lists_no_pairs(spark, monkeypatch, tmp_path):
    from claimloom.plans import resolve_plan

    sizes = sizes_written(monkeypatch, resolve)
    spark.range(150).selectExpr("id AS seed_id", "concat('Tracked Vehicles a', lpad(id, 4, '0')) AS oem").write.parquet(f"{tmp_path}/seed.parquet")
    spark.range(150).selectExpr("id", "concat('b', lpad(id, 4, '0'), ' Tracked Vehicles') AS canonical_name", "CAST(NULL AS string) AS norm_name").write.parquet(f"{tmp_path}/organization.parquet")
    got = [tuple(r) for r in resolve_plan.export_merge_review(spark, str(tmp_path)).collect()]
    assert got == [(f"Tracked Vehicles a{i:04}", "b0000 Tracked Vehicles", "brand", 0.5, i) for i in range(150)]
    assert sizes and max(sizes) <= 600


def test_dedup_status_lists_no_pairs(spark, monkeypatch):
    sizes = sizes_written(monkeypatch, resolve, firms)
    customers = spark.range(120).selectExpr("id AS firm_id", "concat('b', lpad(id, 4, '0'), ' Tracked') AS name", "'Kran' AS application")
    tried = []
    monkeypatch.setattr(firms, "similar_tokens", lambda a, b, *x, _f=firms.similar_tokens: (tried.append(a.count()), _f(a, b, *x))[1])
    cand = spark.range(120).selectExpr("id AS cand_id", "concat('Tracked a', lpad(id, 4, '0')) AS name", "'Kran' AS application", "CAST(NULL AS string) AS model")
    got = firms.dedup_status(cand, customers)
    assert {(r.status, r.firm_id, r.score) for r in got.collect()} == {("check", 0, 1.0)}
    assert tried == [0] and max(sizes) <= 400


def test_merge_review_rounds_as_sql(spark, tmp_path):
    from claimloom.plans import catalog, resolve_plan
    from tests.compare import differences, tables

    # all shares of which the two ways of rounding differ have 23 / 40 in them
    names = [(i, "x" * a, "x" * a + "y" * (b - a)) for i, (a, b) in enumerate([(23, 40), (46, 80), (69, 120), (33, 40), (5, 8), (7, 8)])]
    for at, (key, own, other) in {"seed": ("seed_id", "oem", 1), "organization": ("id", "canonical_name", 2)}.items():
        df = spark.createDataFrame([(n[0], n[other].translate({ord("x"): 97 + n[0], ord("y"): 110 + n[0]})) for n in names], f"{key} bigint, {own} string")
        df.withColumn("norm_name", F.lit(None).cast("string")).coalesce(1).write.parquet(f"{tmp_path}/{at}.parquet")
    got = resolve_plan.export_merge_review(spark, str(tmp_path))
    assert [(r.seed_id, r.score) for r in got.collect()] == [(5, 0.88), (3, 0.83), (4, 0.63), (0, 0.57), (1, 0.57), (2, 0.57)]
    con = tables("nowhere")
    for at in ("seed", "organization"):
        con.execute(f"CREATE VIEW {at} AS SELECT * FROM '{tmp_path}/{at}.parquet/*.parquet'")
    assert differences(got, con, catalog.oracle_sql()["export_merge_review"]) == ""


def test_dedup_status_takes_names_apart_once(spark, monkeypatch):
    from claimloom.session import materialize

    plans = []
    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    for m in (resolve, firms):
        monkeypatch.setattr(m, "materialize", lambda df, *name: (plans.append(plan(df)), materialize(df, *name))[1])
    customers = spark.createDataFrame([(1, "Rapid Technic AG", "Kran"), (2, "Lindner Kranbau", "Bagger")], "firm_id bigint, name string, application string")
    cand = spark.createDataFrame([(1, "rapid technic ag", "Mulcher", "Kran 2"), (2, "Lindnre Werk", "Bagger", None), (3, "Rapid", None, "Baggr")], "cand_id bigint, name string, application string, model string")
    got = firms.dedup_status(cand, customers)
    assert {(r.cand_id, r.status, r.firm_id) for r in got.collect()} == {(1, "duplicate", 1), (2, "check" if SequenceMatcher(None, "lindnre", "lindner").ratio() >= 0.85 else "new", 2), (3, "new application", 1)}
    legal_forms = [p for p in plans if "gmbh" in p]  # a plan that takes names apart has their pattern
    assert len(legal_forms) == 2 and "gmbh" not in plan(got)


def test_words_are_spread_before_their_keys(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(firms, "materialize", lambda df, name: seen.append(df._jdf.queryExecution().optimizedPlan().toString()) or df)
    one = lambda c: spark.createDataFrame([("rapid",)], f"{c} string").coalesce(1)
    assert [r.score for r in firms.similar_tokens(one("a"), one("b")).collect()] == [1.0]
    assert seen[0].count(f"Repartition {spark.sparkContext.defaultParallelism}, true") == 2
