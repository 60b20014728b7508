"""Harvest and enrichment as compositions over stored search results, pages and judges.

Search engines, page fetchers and model judges are injected as functions from DataFrame to DataFrame; offline
they are joins with tables of results, pages and verdicts.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimloom.functions import url as U
from claimloom.functions.text import html_text
from claimloom.operators.ordered import first_by_key

Step = Callable[[DataFrame], DataFrame]


def image_harvest(results: DataFrame, known: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(records, stats)`` of image ``results(ord, pattern, query, url, title)`` against ``known(url)``.

    Low-trust hosts are dropped and counted as junk (they do count as found), then addresses are united over all
    patterns and queries, the first result of each staying, then known ones go.
    """
    x = results.withColumns({"reason": U.block_reason(F.col("url")), "url_key": U.norm_url(F.col("url")), "score": U.source_score(F.col("url"))})
    first = first_by_key(x.where("reason = 'ok'"), ["url_key"], ["ord"])
    new = first.join(known.select(U.norm_url(F.col("url")).alias("url_key")).distinct(), "url_key", "left_anti")
    found = x.groupBy("pattern").agg(F.count(F.lit(1)).alias("found"), F.count_if(F.col("reason") != "ok").alias("junk"))
    kept = new.groupBy("pattern").agg(F.count(F.lit(1)).alias("new"), F.avg("score").alias("mean_score"))
    stats = found.join(kept, "pattern", "left").withColumn("new", F.coalesce("new", F.lit(0)))
    return new, stats


def text_harvest(results: DataFrame, judge: Step | None = None) -> tuple[DataFrame, DataFrame]:
    """``(candidates, stats)`` of text ``results(ord, pattern, url, title, snippet)``.

    Junk hosts do not count as found.  A domain is marked as seen by its first result, before the judge: a
    rejected first hit hides later hits of the domain.
    """
    ok = results.where(~U.low_trust(F.col("url"))).withColumn("domain", U.host(F.col("url")))
    first = first_by_key(ok, ["domain"], ["ord"])
    kept = judge(first) if judge else first
    kept = kept.withColumn("score", U.source_score(F.col("url"), unknown=3))
    stats = ok.groupBy("pattern").agg(F.count(F.lit(1)).alias("found")).join(
        kept.groupBy("pattern").agg(F.count(F.lit(1)).alias("new"), F.sum("score").alias("score_sum")), "pattern", "left"
    )
    return kept, stats.withColumns({"new": F.coalesce("new", F.lit(0)), "score_sum": F.coalesce("score_sum", F.lit(0))})


def candidate_name(title: Column, url: Column) -> Column:
    """A name from a result: the title before " - " or " | ", else the first label of the host; 200 letters at most."""
    t = F.trim(F.split(F.split(F.coalesce(title, F.lit("")), " - ")[0], r" \| ")[0])
    return F.left(F.coalesce(F.nullif(t, F.lit("")), F.split(U.host(url), r"\.")[0]), F.lit(200))


def discover(results: DataFrame, known_names: DataFrame, judge: Step | None = None) -> DataFrame:
    """New candidates: trusted hosts, one for each pattern and domain, not known by normal name, then judged."""
    from claimloom.functions.text import norm

    x = results.where(~U.low_trust(F.col("url"))).withColumns({"domain": U.host(F.col("url")), "name": candidate_name(F.col("title"), F.col("url"))})
    x = first_by_key(x, ["pattern", "domain"], ["ord"])
    x = x.join(known_names.select(norm(F.col("name")).alias("_k")).distinct(), norm(F.col("name")) == F.col("_k"), "left_anti")
    return judge(x) if judge else x


def deep_pages(pages: DataFrame, least: int = 200) -> DataFrame:
    """``pages(url, html)`` as ``(url, text)``; a page with little text takes its site root's text if that is longer."""
    t = pages.select("url", html_text(F.col("html")).alias("text"), U.site_root(F.col("url")).alias("root"))
    roots = t.select(F.col("url").alias("root"), F.col("text").alias("root_text"))
    j = t.join(first_by_key(roots, ["root"], ["root_text"]), "root", "left")
    better = (F.length("text") < least) & (F.length(F.coalesce("root_text", F.lit(""))) > F.length("text"))
    return j.select("url", F.when(better, F.col("root_text")).otherwise(F.col("text")).alias("text"))


def enrich(candidates: DataFrame, judge: Step, limit: int | None = None) -> DataFrame:
    """One judgement for each page, fanned out to all candidates of the page.

    ``candidates(ord, url, page, ...)``; ``limit`` counts pages, and candidates of pages beyond it drop out.
    """
    pages = candidates.groupBy("page").agg(F.min("ord").alias("ord"))
    if limit is not None:
        pages = pages.orderBy("ord").limit(limit)
    return candidates.join(judge(pages.select("page")), "page")


def image_links(html: Column, base: Column, most: int | None = None) -> Column:
    """Image addresses of a page in order, made absolute, og:image first, each once, without icons and logos."""
    og = F.regexp_extract_all(html, F.lit(r'(?i)<meta[^>]+property=["\']og:image["\'][^>]+content=["\']([^"\']+)'), 1)
    img = F.regexp_extract_all(html, F.lit(r'(?i)<img[^>]+?(?:data-src|src)=["\']([^"\']+)'), 1)
    root = U.site_root(base)
    whole = F.transform(
        F.concat(og, img),
        lambda u: F.when(u.rlike("^https?://"), u).when(F.startswith(u, F.lit("//")), F.concat(F.lit("https:"), u)).when(F.startswith(u, F.lit("/")), F.concat(F.regexp_replace(root, "/$", ""), u)).otherwise(F.concat(root, u)),
    )
    plausible = F.filter(whole, lambda u: ~u.rlike("(?i)logo|icon|sprite|avatar|banner|flag") & u.rlike(r"(?i)\.(?:jpe?g|png|webp)(?:$|\?)|product|produkt"))
    out = F.array_distinct(plausible)
    return F.slice(out, 1, most) if most else out


def product_links(html: Column, base: Column, most: int = 5) -> Column:
    """Links to product pages of the same site by their wording, sorted, at most ``most``."""
    links = F.regexp_extract_all(html, F.lit(r'(?i)<a[^>]+href=["\']([^"\'#]+)'), 1)
    root = U.site_root(base)
    whole = F.transform(links, lambda u: F.when(F.startswith(u, F.lit("/")), F.concat(F.regexp_replace(root, "/$", ""), u)).otherwise(u))
    own = F.filter(whole, lambda u: F.startswith(u, root) & u.rlike("(?i)produ|maschine|machine|model|raupe|crawler"))
    return F.slice(F.array_sort(F.array_distinct(own)), 1, most)


def datasheet_link(html: Column, base: Column) -> Column:
    """The first PDF link whose address speaks of a data sheet, else the first PDF link."""
    links = F.regexp_extract_all(html, F.lit(r'(?i)href=["\']([^"\']+\.pdf[^"\']*)'), 1)
    root = F.regexp_replace(U.site_root(base), "/$", "")
    whole = F.transform(links, lambda u: F.when(F.startswith(u, F.lit("/")), F.concat(root, u)).otherwise(u))
    named = F.filter(whole, lambda u: u.rlike("(?i)datenblatt|data-?sheet|spec|brochure|prospekt"))
    return F.coalesce(F.get(named, F.lit(0)), F.get(whole, F.lit(0)))


def image_size_ok(n_bytes: Column, width: Column, height: Column) -> Column:
    """Whether an image is large enough and of a plain shape; unreadable sizes are not."""
    long, short = F.greatest(width, height), F.least(width, height)
    known = width.isNotNull() & height.isNotNull()
    return F.coalesce(known & (n_bytes > 3072) & (short >= 300) & (long <= 6000) & (long / short <= 4), F.lit(False))
