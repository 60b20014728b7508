"""Parsing of typed organisation names, countries and web addresses into comparable parts.

A name is taken apart into its distinctive core, its line of business and its legal form.  Which words are
common (business words) is learned from the document frequencies of the names themselves; words that only
shorten a common word count as that word.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np

from claimloom.functions.text import LEGAL_FORMS

#: Common ways to write a country, by ISO code.
COUNTRIES = {
    "AT": ["at", "aut", "austria", "oesterreich", "a"],
    "CH": ["ch", "che", "switzerland", "schweiz", "suisse", "svizzera"],
    "DE": ["de", "deu", "brd", "germany", "deutschland", "d", "ger"],
    "DK": ["dk", "dnk", "denmark", "daenemark", "danmark"],
    "FI": ["fi", "fin", "finland", "finnland", "suomi"],
    "FR": ["fr", "fra", "france", "frankreich"],
    "GB": ["gb", "gbr", "uk", "great britain", "united kingdom", "vereinigtes koenigreich", "england", "grossbritannien"],
    "IT": ["it", "ita", "italy", "italia", "italien"],
    "NL": ["nl", "nld", "netherlands", "niederlande", "nederland", "holland"],
    "PL": ["pl", "pol", "poland", "polen", "polska"],
    "US": ["us", "usa", "united states", "u s a", "united states of america", "vereinigte staaten", "amerika"],
}
COUNTRY_CODE = {name: code for code, names in COUNTRIES.items() for name in names}
#: Words around a name that do not tell organisations apart.
FILLERS = {"und", "u", "and", "soehne", "sohn", "sons", "gebr", "gebrueder", "the", "der", "die", "werke", "werk", "gruppe", "group", "international", "company", "firma", "fa"}
#: Words in host names that are no part of the owner's name.
HOST_WORDS = {"www", "shop", "web", "m", "group", "international", "online", "info", "de", "at", "ch", "en", "uk", "it", "fr", "us", "nl", "pl", "fi", "dk", "com"}
#: Words of companies that hold or run others; they tell nothing about the line of business.
HOLDINGS = {"verwaltung", "beteiligung", "beteiligungen", "holding"}
_FORMS = {*LEGAL_FORMS, "kommanditges", "kommanditgesellschaft", "ges", "m", "b", "h", "mbh", "co", "sp", "z", "o", "oo", "s", "p", "a", "r", "l", "g", "k", "v", "n", "i"}
_NO_VALUE = {"", "-", "n/a", "na", "k.a.", "none", "null", "unbekannt", "?"}


def fold(text: str | None) -> str:
    x = (text or "").lower()
    for a, b in (("ä", "ae"), ("ö", "oe"), ("ü", "ue"), ("ß", "ss"), ("ø", "o"), ("å", "a"), ("æ", "ae"), ("é", "e"), ("è", "e"), ("ł", "l"), (" ", " ")):
        x = x.replace(a, b)
    return x


def tokens(text: str | None) -> list[str]:
    return re.findall(r"[a-z0-9]+", fold(text))


def country_code(text: str | None) -> str | None:
    return COUNTRY_CODE.get(" ".join(tokens(text)))


def host_of(text: str | None) -> str | None:
    """Host of an address, URL or e-mail address; null for placeholders."""
    x = fold(text).strip()
    if x in _NO_VALUE:
        return None
    x = re.sub(r"^[a-z][a-z0-9+.\-]*://", "", x)
    x = re.split(r"[/?#]", x)[0].rsplit("@", 1)[-1]
    x = re.sub(r":\d+$", "", x).strip(". ")
    x = re.sub(r"^(?:www\d?|shop|m|web|en|de)\.(?=[^.]+\.)", "", x)
    return x if re.fullmatch(r"[a-z0-9.\-]+\.[a-z]{2,}", x) else None


def distance(a: str, b: str, most: int) -> int:
    """Edit distance with swaps of neighbours; ``most + 1`` as soon as it exceeds ``most``."""
    if a == b:
        return 0
    n, m = len(a), len(b)
    if abs(n - m) > most:
        return most + 1
    two: list[int] = []
    one = list(range(m + 1))
    for i in range(1, n + 1):
        row = [i] + [most + 1] * m
        lo, hi = max(1, i - most), min(m, i + most)
        for j in range(lo, hi + 1):
            c = one[j - 1] + (a[i - 1] != b[j - 1])
            c = min(c, one[j] + 1, row[j - 1] + 1)
            if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                c = min(c, two[j - 2] + 1)
            row[j] = c
        if min(row[lo - 1 : hi + 1]) > most:
            return most + 1
        two, one = one, row
    return min(one[m], most + 1)


def tolerance(n: int) -> int:
    """Edits that two spellings of a word of ``n`` letters may differ by."""
    return 0 if n <= 4 else 1 if n <= 7 else 2


def deletions(word: str, depth: int) -> set[str]:
    """The word and everything left of it after up to ``depth`` deletions: the keys of its neighbourhood."""
    out, layer = {word}, {word}
    for _ in range(depth):
        layer = {w[:i] + w[i + 1 :] for w in layer for i in range(len(w))}
        out |= layer
    return out


#: Words up to this length are looked up by deletions, whose number grows with its square; longer ones by pieces.
LONG_WORD = 40
#: An edit spoils two neighbouring pieces at most (a swap across their border), so two edits leave one of five whole.
PIECES = 5


def lookup_keys(word: str, sought: bool) -> set[str]:
    """Keys by which two words within their tolerance are sure to meet (one stored, one sought).

    Words about ``LONG_WORD`` letters long give both kinds of keys, so that pairs across the border meet too.
    """
    n = len(word)
    out = deletions(word, tolerance(n)) if n <= LONG_WORD + 2 else set()
    if n > LONG_WORD - 2:
        for m in range(n - 2, n + 3) if sought else [n]:
            for k in range(PIECES):
                at, end = m * k // PIECES, m * (k + 1) // PIECES
                out |= {f"{m} {k} {word[i : i + end - at]}" for i in (range(max(at - 2, 0), at + 3) if sought else [at]) if i + end - at <= n}
    return out


@dataclass
class Name:
    core: list[str] = field(default_factory=list)  # distinctive tokens in order
    tokens: list[str] = field(default_factory=list)  # the same with initials and other short tokens
    business: list[frozenset[str]] = field(default_factory=list)  # for each common word the words it may stand for
    forms: set[str] = field(default_factory=set)


class Parser:
    """Takes names apart; ``common`` are the frequent words of the names at hand (business words)."""

    def __init__(self, common: set[str]):
        self.common = {w for w in common if len(w) >= 4 and w not in _FORMS and w not in FILLERS}
        self.heads: dict[str, set[str]] = {}
        for w in self.common:
            for n in range(3, len(w)):
                self.heads.setdefault(w[:n], set()).add(w)
        self.near: dict[str, set[str]] = {}
        for w in self.common:
            for k in deletions(w, 1):
                self.near.setdefault(k, set()).add(w)
        self.memo: dict[str, frozenset[str]] = {}

    def meanings(self, t: str) -> frozenset[str]:
        """The common words that a token may stand for: itself, a slip of it, or its beginning."""
        if t not in self.memo:
            got: set[str] = set()
            if t in self.common:
                got = {t}
            elif len(t) >= 3:
                got = set(self.heads.get(t, ()))
                if not got and len(t) >= 5:
                    got = {w for k in deletions(t, 1) for w in self.near.get(k, ()) if distance(t, w, 1 if len(w) < 8 else 2) <= (1 if len(w) < 8 else 2)}
                if not got and len(t) >= 5:
                    # compounds shortened in both parts (maschfab for maschinenfabrik)
                    got = {w for w in self.heads.get(t[:3], ()) if _both_parts(t, w)}
                if not got and not set(t[1:]) & set("aeiou"):
                    # consonants only (mfg for manufacturing, eqpt for equipment)
                    got = {w for w in self.common if w[0] == t[0] and _in_order(t, w)}
            self.memo[t] = frozenset(got)
        return self.memo[t]

    def parse(self, text: str | None) -> Name:
        x = fold(text)
        if x.strip() in _NO_VALUE:
            return Name()
        x = re.sub(r"\(([^()]*)\)", r" ( \1 ) ", x)
        out = Name()
        # dotted forms first: s.p.a., g.m.b.h., sp. z o.o.
        flat = re.sub(r"\b((?:[a-z]{1,2}\.\s?){2,}[a-z]{0,2}\b\.?|sp\.?\s?z\.?\s?o\.?\s?o\.?|ges\.?\s?m\.?\s?b\.?\s?h\.?|a/s)", lambda m: _form(m.group(0), out), x)
        inside, last = False, ""
        found = re.findall(r"[a-z0-9]+|[()]", flat)
        # single letters that spell a legal form (g m b h, s p a) are one; other short tokens are initials or names
        skip = set()
        for i in range(len(found)):
            for n in (4, 3, 2):
                run = found[i : i + n]
                if i not in skip and len(run) == n and all(len(t) <= 2 and t.isalpha() for t in run) and "".join(run) in LEGAL_FORMS:
                    out.forms.add("".join(run))
                    skip.update(range(i, i + n))
        for i, t in enumerate(found):
            if t in "()":
                inside = t == "("
            elif i in skip:
                continue
            elif t in LEGAL_FORMS:
                out.forms.add(t)
            elif t in FILLERS or t in HOLDINGS or (t in _FORMS and len(t) > 1):
                continue
            elif out.business and last == "business" and (m := {w for w in out.business[-1] if w.find(t, 3) >= 3}) and len(t) >= 3:
                out.business[-1] = frozenset(m)  # the second part of a split compound (kran-tech, masch. fabr.)
            elif m := self.meanings(t):
                out.business.append(m)
                last = "business"
            elif inside:
                continue  # a place or country in brackets
            elif len(t) <= 2:
                out.tokens.append(t)
            else:
                out.core.append(t)
                out.tokens.append(t)
                last = "core"
        if not out.core:
            out.core = list(out.tokens)  # a name of short tokens only
        return out

    def stem(self, host: str | None) -> str | None:
        """The owner's name in a host name, without common words and endings."""
        if not host:
            return None
        label = host.split(".")[-2]
        parts = [p for p in label.split("-") if p and p not in HOST_WORDS]
        kept = [p for p in parts if not self.whole_common(p)] or parts
        w = "".join(kept)
        for f in ("gmbh", "ag", "kg", "group"):
            if w.endswith(f) and len(w) - len(f) >= 5 and f == "gmbh":
                w = w[: -len(f)]
        return w or None

    def whole_common(self, p: str) -> bool:
        if p in self.common:
            return True
        return any(p.startswith(w) and p[len(w) :] in self.common for w in self.heads_of(p))

    def heads_of(self, p: str) -> list[str]:
        return [p[:i] for i in range(4, len(p)) if p[:i] in self.common]


def _form(text: str, out: Name) -> str:
    f = re.sub("[^a-z]", "", text)
    if f in LEGAL_FORMS:
        out.forms.add(f)
        return " "
    return text


def _both_parts(t: str, w: str) -> bool:
    """Whether ``t`` is a head of ``w`` followed by a head of one of ``w``'s later parts."""
    for cut in range(3, len(t) - 1):
        head, tail = t[:cut], t[cut:]
        if w.startswith(head) and w.find(tail, cut) > cut:
            return True
    return False


def _in_order(t: str, w: str) -> bool:
    rest = iter(w)
    return all(c in rest for c in t)


def business_agrees(a: list[frozenset[str]], b: list[frozenset[str]]) -> int:
    """1 if one list of business words is contained in the other, -1 if not, 0 if either is empty."""
    if not a or not b:
        return 0
    left = list(b)
    missing = 0
    for x in a:
        hit = next((y for y in left if x & y), None)
        if hit is None:
            missing += 1
        else:
            left.remove(hit)
    return 1 if missing < len(a) and (missing == 0 or not left) else -1


def token_similarity(a: str, b: str) -> float:
    """1 for equal tokens, less for slips, beginnings and initials, else 0."""
    if a == b:
        return 1.0
    if len(a) > len(b):
        a, b = b, a
    most = tolerance(len(a))
    d = distance(a, b, most)
    if d <= most:
        return 1 - 0.1 * d
    if b.startswith(a):
        return 0.4 if len(a) == 1 else 0.6 if len(a) == 2 else 0.8
    return 0.0


def best_assignment(gain: np.ndarray) -> float:
    """The largest total of one entry a row (rows <= columns), no column twice; gains are not negative.

    Rows are added one by one along a cheapest alternating path; the work grows with rows^2 x columns.
    """
    n, m = gain.shape
    cost = gain.max() - gain
    u, v = np.zeros(n + 1), np.zeros(m + 1)
    owner = np.zeros(m + 1, dtype=np.int64)  # row of each column, 0 for none
    for i in range(1, n + 1):
        owner[0] = i
        at, least, way, used = 0, np.full(m + 1, np.inf), np.zeros(m + 1, dtype=np.int64), np.zeros(m + 1, bool)
        while True:
            used[at] = True
            row = owner[at]
            here = cost[row - 1] - u[row] - v[1:]
            better = ~used[1:] & (here < least[1:])
            least[1:][better] = here[better]
            way[1:][better] = at
            open_ = np.where(used, np.inf, least)
            open_[0] = np.inf
            to = int(open_.argmin())
            step = open_[to]
            u[owner[used]] += step
            v[used] -= step
            least[~used] -= step
            at = to
            if not owner[at]:
                break
        while at:
            owner[at] = owner[way[at]]
            at = way[at]
    return float(sum(gain[owner[j] - 1, j - 1] for j in range(1, m + 1) if owner[j]))


def align(a: Sequence[str], b: Sequence[str]) -> float:
    """Share of the shorter name's letters that an optimal assignment of its tokens to the other's explains.

    A name's repeated tokens count once.  Exact at every length.
    """
    a, b = list(dict.fromkeys(a)), list(dict.fromkeys(b))
    if len(a) > len(b):
        a, b = b, a
    if not a:
        return 0.0
    gain = np.array([[len(x) * token_similarity(x, y) for y in b] for x in a])
    return (float(gain.max()) if len(a) == 1 else best_assignment(gain)) / sum(len(x) for x in a)
