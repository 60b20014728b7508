"""Address expressions and the trust rules on hosts, all JVM-side."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Needles that mark hosts by category, matched as substrings of the host; every function that uses
#: them takes another table as a parameter.
HOST_RULES: dict[str, list[str]] = {
    "social": [
        "pinterest.", "tiktok.", "facebook.", "fb.watch", "instagram.", "youtube.", "youtu.be", "twitter.", "reddit.", "redd.it", "linkedin.", "vk.com", "weibo.", "flickr.",
        "tumblr.", "quora.", "shutterstock.", "istockphoto.", "gettyimages.", "alamy.", "dreamstime.", "123rf.", "depositphotos.", "stock.adobe.", "adobestock.", "wikipedia.", "wikimedia.",
    ],
    "marketplace": [
        "alibaba.", "aliexpress.", "made-in-china.", "indiamart.", "amazon.", "ebay.", "etsy.", "wish.com", "dhgate.", "tradeindia.", "globalsources.", "ec21.", "tradekey.",
        "machinerytrader.", "marketbook.", "mascus.", "machineryzone.", "exapro.", "europages.", "directindustry.", "ironplanet.", "govplanet.", "ritchiespecs.",
        "equipmenttrader.", "trademachines.", "truckpaper.", "forestrytrader.", "mylittlesalesman.", "cranenetwork.", "plantandequipment.", "agriaffaires.",
        "truck1.", "autoline.", "rockanddirt.", "sandhills.", "kijiji.", "gumtree.", "craigslist.", "houseofcontractors.", "masterwholesale.", "trademe.", "olx.",
        "alfagomma", "surplusrecord.",
    ],
    "cdn": [
        "ytimg.", "ggpht.", "pinimg.", "fbcdn.", "twimg.", "i.redd.", "wp.com", "staticflickr.", "cloudfront.", "blogspot.", "wixstatic.", "squarespace-cdn.",
        "cdn.shopify.", "shopifycdn.", "alicdn.", "aliexpress-media.", "hearstapps.", "sanity.io", "lookaside.fbsbx.", "media.sandhills.", "imgur.", "gstatic.",
        "akamaized.", "cdninstagram.",
    ],
    "maker": [
        "liebherr.", "banditchippers.", "toro.", "vermeer.", "rayco.", "carltonsp.", "imergroup.", "ensigneq.", "canycom.", "cormidi.", "hinowa.", "merlo.",
        "takeuchi-us.", "kubota.", "bobcat.", "avant.", "prinoth.", "seppi.",
    ],
}
LOW_TRUST = ("social", "marketplace", "cdn")


def host(c: Column) -> Column:
    """The authority of an address in lower case without a leading www.; empty where there is none.

    Port and user stay, blanks and underscores are allowed: the expression reads what stands between // and
    the next /, ? or #, which is what callers compare, not a validated host name.
    """
    u = F.coalesce(c.cast("string"), F.lit(""))
    return F.regexp_replace(F.lower(F.regexp_extract(u, r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//([^/?#]*)", 1)), r"^www\.", "")


def norm_url(c: Column) -> Column:
    """Key that unites the variants of one picture's address: no scheme, www., query, fragment, closing slash or
    size mark before the extension, lower case.  Null and blank give the empty text."""
    s = F.lower(F.regexp_replace(F.coalesce(c.cast("string"), F.lit("")), r"(?U)^\s+|\s+$", ""))
    for pattern in (r"^https?://", r"(?s)[#?].*$", r"^www\.", r"/+$", r"[-_](?:\d{2,4}x\d{2,4}|thumb|thumbnail|scaled|small|medium|large)(?=\.[a-z]{2,4}$)"):
        s = F.regexp_replace(s, pattern, "")
    return s


def update_key(c: Column) -> Column:
    """The simpler key by which updates find their rows: without query and closing slashes, lower case."""
    return F.lower(F.regexp_replace(F.regexp_replace(F.trim(F.coalesce(c.cast("string"), F.lit(""))), r"(?s)\?.*$", ""), "/+$", ""))


def site_root(c: Column) -> Column:
    """Scheme and authority of an address with a closing slash; null if it has none."""
    root = F.regexp_extract(c, r"^(https?://[^/?#]+)", 1)
    return F.when(root != "", F.concat(root, F.lit("/")))


def _any(h: Column, needles: list[str]) -> Column:
    # one compiled pattern: a higher-order function over the needles would leave the generated code
    return h.rlike("|".join(re.escape(n) for n in needles)) if needles else F.lit(False)


def host_is(c: Column, category: str, rules: dict[str, list[str]] = HOST_RULES) -> Column:
    """Whether the host falls into a category; an address without a host falls into none."""
    h = host(c)
    return (h != "") & _any(h, rules[category])


def block_reason(c: Column, rules: dict[str, list[str]] = HOST_RULES) -> Column:
    """Why a source is not trusted: "no host", a category, or "ok"; the first that holds."""
    h = host(c)
    out = F.when(h == "", "no host")
    for category in LOW_TRUST:
        out = out.when(_any(h, rules[category]), category)
    return out.otherwise("ok")


def low_trust(c: Column, rules: dict[str, list[str]] = HOST_RULES) -> Column:
    return block_reason(c, rules) != "ok"


def source_score(c: Column, rules: dict[str, list[str]] = HOST_RULES, unknown: int = 2) -> Column:
    """1 for low trust, 3 for makers' own sites, ``unknown`` (2 for pictures, 3 for texts) for the rest."""
    return F.when(low_trust(c, rules), 1).when(host_is(c, "maker", rules), 3).otherwise(unknown)
