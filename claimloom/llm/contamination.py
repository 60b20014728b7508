"""Evaluation passages inside corpus documents, by size-partitioned MinHash containment search.

Documents are cut into windows of a fixed number of shingles, so that a short passage is always compared with
sets of about its own size, and every window gets a one-permutation MinHash sketch.  Passages are grouped by
size; each group has its own number of sketch matches that stands for the least containment searched for.
The least group (passages of up to 64 shingles) is small enough that its sketch is all its shingles; passages of
fewer words than two shingles are found as a whole.  Candidates are verified exactly: by the contained shingles,
then by two stretches of equal words or by aligning the passage with the windows.

Passages up to a stated size travel to the documents, so the corpus is read once and never shuffled.  Beyond it
the sketches of documents and passages are joined, and only the documents that share enough are looked at again.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimloom.llm.tokens import Words, cleaned, slices
from claimloom.session import materialize

BINS = 256


@dataclass(frozen=True)
class Search:
    """Parameters of the search; ``coverage`` is the share of a passage's words that makes it leaked."""

    shingle: int = 3
    window: int = 128
    coverage: float = 0.5
    contained: float = 0.25  # least share of a passage's shingles, in the sketch and then exactly
    whole: int = 64  # passages of up to so many shingles are sketched by all of them


def _words(texts: pa.Array) -> Words:
    texts = pc.replace_substring_regex(cleaned(texts), r"[-‐]\s*\n\s*|­", "")
    return Words(texts, r"[^\p{L}\p{N}]+", fold=True)


def _hashes(w: Words) -> np.ndarray:
    own = np.fromiter((xxhash.xxh3_64_intdigest(v) for v in w.vocabulary), dtype=np.uint64, count=len(w.vocabulary))
    return own[w.code] if len(w.code) else np.zeros(0, np.uint64)


def _shingles(h: np.ndarray, size: int) -> np.ndarray:
    """Order-dependent hash of each run of ``size`` words."""
    n = len(h) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    x = np.zeros(n, np.uint64)
    with np.errstate(over="ignore"):
        for i in range(size):
            x = (x ^ h[i : i + n]) * np.uint64(0x9E3779B97F4A7C15)
            x ^= x >> np.uint64(29)
    return x


def _sketch(group: np.ndarray, shingle: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One-permutation MinHash: the least hash of each (group, bin); the bin is the hash's top byte."""
    if not len(shingle):
        return group[:0], shingle[:0]
    key = group.astype(np.int64) * BINS + (shingle >> np.uint64(56)).astype(np.int64)
    order = np.lexsort((shingle, key))
    key, val, g = key[order], shingle[order], group[order]
    first = np.ones(len(key), bool)
    first[1:] = key[1:] != key[:-1]
    return g[first], val[first]


class Passages:
    """The query side: word hashes, exact shingles and sketches of a bounded block of passages."""

    def __init__(self, ids: list[int], texts: list[str], search: Search):
        self.ids, self.search = np.array(ids, dtype=np.int64), search
        w = _words(pa.array(texts, pa.string()))
        h, at = _hashes(w), w.starts()
        self.words = [h[at[i] : at[i + 1]] for i in range(len(ids))]
        sh = [_shingles(x, search.shingle) for x in self.words]
        self.n_shingles = np.array([len(x) for x in sh], dtype=np.int64)
        item = np.repeat(np.arange(len(ids)), self.n_shingles)
        flat = np.concatenate(sh) if sh else np.zeros(0, np.uint64)
        self.own: dict[int, tuple[np.ndarray, np.ndarray]] = {}  # different shingles of a passage, made when needed
        small = self.n_shingles <= search.whole
        # a passage of fewer than two shingles' words counts as one shingle of all its words
        self.tiny: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for size in range(1, 2 * search.shingle):
            at_size = [i for i, x in enumerate(self.words) if len(x) == size]
            if at_size:
                v = np.array([_shingles(self.words[i], size)[0] for i in at_size])
                order = np.argsort(v, kind="stable")
                self.tiny[size] = v[order], np.array(at_size)[order]
        is_tiny = np.array([len(x) < 2 * search.shingle for x in self.words], bool)
        keep = (small & ~is_tiny)[item]
        each = np.unique(np.column_stack([item[keep].astype(np.uint64), flat[keep]]), axis=0) if keep.any() else np.zeros((0, 2), np.uint64)
        order = np.argsort(each[:, 1], kind="stable")
        self.flat, self.flat_item = each[order, 1], each[order, 0].astype(np.int64)
        large = (~small & ~is_tiny)[item]
        g, v = _sketch(item[large], flat[large])
        order = np.argsort(v, kind="stable")
        self.sketch, self.sketch_item = v[order], g[order]
        bins = np.bincount(g, minlength=len(ids))
        # size groups: powers of two of the passage's shingles; a window's least hash of a bin is the passage's
        # with a chance that falls with the window's load of the bin
        chance = 1 / (1 + search.window / BINS)
        size_class = np.floor(np.log2(np.maximum(self.n_shingles, 1))).astype(int)
        self.need = np.zeros(len(ids))
        for c in np.unique(size_class[~small]):
            here = (size_class == c) & ~small
            self.need[here] = search.contained * chance * bins[here].min()
        self.need[small] = np.maximum(1, np.ceil(search.contained * np.bincount(self.flat_item, minlength=len(ids))[small]))

    def find(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """``(row, item)`` pairs of the texts that contain a passage."""
        s = self.search
        w = _words(texts)
        h, at = _hashes(w), w.starts()
        found = {(int(r), int(i)) for size, (v, owner) in self.tiny.items() for r, i in zip(*_equal(*_runs(h, w.doc, size), v, owner))}
        shingle, doc, place = _placed(h, w.doc, at, s.shingle)
        per = (np.diff(at) + s.window - 1) // s.window
        base = np.concatenate([[0], np.cumsum(per)])
        window = base[doc] + place // s.window
        pairs = []
        if len(self.sketch):
            pairs.append(_equal(*_sketch(window, shingle), self.sketch, self.sketch_item))
        if len(self.flat):
            pairs.append(_equal(window, shingle, self.flat, self.flat_item))
        pair_w = np.concatenate([np.zeros(0, np.int64), *[p[0] for p in pairs]])
        pair_i = np.concatenate([np.zeros(0, np.int64), *[p[1] for p in pairs]])
        if len(pair_w):
            key, n = np.unique(pair_w.astype(np.int64) * len(self.ids) + pair_i, return_counts=True)
            win, item = key // len(self.ids), key % len(self.ids)
            row = np.searchsorted(base, win, side="right") - 1
            # all windows of each (text, passage), in order
            order = np.lexsort((win, item, row))
            win, item, row = win[order], item[order], row[order]
            new = np.ones(len(row), bool)
            new[1:] = (row[1:] != row[:-1]) | (item[1:] != item[:-1])
            begin = np.flatnonzero(new)
            end = np.append(begin[1:], len(row))
            total = np.add.reduceat(n[order], begin)
            hit = total >= self.need[item[begin]]
            for b, e in zip(begin[hit].tolist(), end[hit].tolist()):
                r, i = int(row[b]), int(item[b])
                near = np.unique(np.clip((win[b:e] - base[r])[:, None] + np.array([-1, 0, 1]), 0, per[r] - 1))
                doc_words = np.concatenate([h[at[r] + k * s.window : min(at[r] + (k + 1) * s.window, at[r + 1])] for k in near])
                if self._contains(i, doc_words):
                    found.add((r, i))
        rows = np.array(sorted(found), dtype=np.int64).reshape(-1, 2)
        return rows[:, 0], self.ids[rows[:, 1]]

    def sketches(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``(value, passage, size)`` of everything that a text is looked up by; size 0 are hashes of the sketch
        of a window, else runs of so many words."""
        parts = [(self.sketch, self.sketch_item, 0), (self.flat, self.flat_item, self.search.shingle), *[(v, i, 100 + size) for size, (v, i) in self.tiny.items()]]
        return (
            np.concatenate([p[0] for p in parts]).astype(np.uint64).view(np.int64),
            np.concatenate([p[1] for p in parts]).astype(np.int64),
            np.concatenate([np.full(len(p[0]), p[2], dtype=np.int64) for p in parts]),
        )

    def _contains(self, i: int, doc: np.ndarray) -> bool:
        s, words = self.search, self.words[i]
        if i not in self.own:
            self.own[i] = np.unique(_shingles(words, s.shingle), return_counts=True)
        mine, often = self.own[i]
        theirs = _shingles(doc, s.shingle)
        place = np.minimum(np.searchsorted(mine, theirs), len(mine) - 1)
        met = np.zeros(len(mine), bool)
        met[place[mine[place] == theirs]] = True
        if often[met].sum() < s.contained * often.sum():
            return False
        need = s.coverage * len(words)
        return two_runs(words, doc, s.shingle) >= need or covered(words, doc, need) >= need


def _placed(h: np.ndarray, doc: np.ndarray, at: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Shingles of a batch that lie within one text, with their text and their place in it."""
    sh = _shingles(h, size)
    d = doc[: len(sh)]
    whole = d == doc[size - 1 :] if len(sh) else np.zeros(0, bool)
    return sh[whole], d[whole], (np.arange(len(sh)) - at[d])[whole]


def _runs(h: np.ndarray, doc: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    sh = _shingles(h, size)
    d = doc[: len(sh)]
    whole = d == doc[size - 1 :] if len(sh) else np.zeros(0, bool)
    return d[whole], sh[whole]


def two_runs(passage: np.ndarray, doc: np.ndarray, size: int) -> int:
    """Words of the passage in its two longest runs of equal words in ``doc`` that stand in order (a lower bound of
    what an alignment covers, and most often enough)."""
    a, b = _shingles(passage, size), _shingles(doc, size)
    order = np.argsort(b, kind="stable")
    i, j = _equal(np.arange(len(a)), a, b[order], order)
    if not len(i):
        return 0
    by = np.lexsort((i, j - i))
    i, j = i[by], j[by]
    start = np.flatnonzero(np.concatenate([[True], (np.diff(i) != 1) | (np.diff(j) != 1)]))
    n = np.diff(np.append(start, len(i))) + size - 1
    i, j = i[start], j[start]
    best = int(n.argmax())
    before = (i + n <= i[best]) & (j + n <= j[best])
    after = (i >= i[best] + n[best]) & (j >= j[best] + n[best])
    return int(n[best] + max(n[before].max(initial=0), n[after].max(initial=0)))


def _equal(g: np.ndarray, v: np.ndarray, sorted_values: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All pairs (g, owner) with equal values."""
    lo, hi = np.searchsorted(sorted_values, v, "left"), np.searchsorted(sorted_values, v, "right")
    n = hi - lo
    some = n > 0
    left = np.repeat(g[some], n[some])
    start = np.repeat(lo[some], n[some])
    step = np.arange(n[some].sum()) - np.repeat(np.cumsum(n[some]) - n[some], n[some])
    return left, owner[start + step]


def _local(a: np.ndarray, b: np.ndarray) -> tuple[int, int, int, int, int]:
    """``(matched words, first and last+1 place in a, the same in b)`` of the best local alignment of two word
    sequences (match 1, anything else -1).

    Two rows of the table are kept, and with each score where its alignment began and how many words it
    matched, so memory grows with ``b`` only.
    """
    n, m = len(a), len(b)
    none = (0, 0, 0, 0, 0)
    if not n or not m:
        return none
    score = np.zeros(m + 1, np.int64)
    cols = np.arange(m + 1, dtype=np.int64)
    # one number holds the matched words and the first place in a and in b
    in_b = (m + 1).bit_length()
    in_a = (n + 1).bit_length()
    one = 1 << in_a + in_b
    origin = cols.copy()
    best, top = none, 0
    for i in range(1, n + 1):
        same = b == a[i - 1]
        here, up = score[:-1] + 2 * same - 1, score[1:] - 1
        tag = np.where(up > here, origin[1:], origin[:-1] + same * one)
        here = np.maximum(here, up)
        fresh = here <= 0
        here[fresh] = 0
        tag[fresh] = (i << in_b) + cols[1:][fresh]
        # gaps in a: the best score to the left, less one a step; its place travels in the low bits, and of equal
        # scores the cell's own stays
        left = np.maximum.accumulate(((here + cols[1:]) << 32) + cols[:-1])
        score[1:] = (left >> 32) - cols[1:]
        origin[0] = i << in_b
        origin[1:] = tag[left & 0xFFFFFFFF]
        at = int(score.argmax())
        if score[at] > top:
            top, t = int(score[at]), int(origin[at])
            best = t >> in_a + in_b, t >> in_b & ((1 << in_a) - 1), i, t & ((1 << in_b) - 1), at
    return best


def covered(passage: np.ndarray, doc: np.ndarray, need: float = float("inf")) -> int:
    """Words of the passage that stand in ``doc`` in order, in one or two stretches (each a local alignment); as soon
    as ``need`` is reached or out of reach, what is known so far."""
    n, i0, i1, j0, j1 = _local(passage, doc)
    second = 0
    for a, b in ((passage[:i0], doc[:j0]), (passage[i1:], doc[j1:])):
        if n and n + second < need and (np.isinf(need) or n + len(a) >= need):
            second = max(second, _local(a, b)[0])
    return n + second


def passages_of(items: DataFrame) -> DataFrame:
    """``(item_id, passage)`` without the standing first line: a first line that several items share."""
    first = F.regexp_extract("passage", r"^([^\n]*)\n", 1)
    shared = items.where("passage is not null").select(first.alias("line")).where("line <> ''").groupBy("line").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    rows = items.where("passage is not null and item_id is not null").select("item_id", "passage", first.alias("line"))
    body = F.when(F.col("n").isNotNull(), F.regexp_replace("passage", r"^[^\n]*\n", "")).otherwise(F.col("passage"))
    return rows.join(shared, "line", "left").select("item_id", body.alias("passage"))


def leaked_items(docs: DataFrame, items: DataFrame, search: Search = Search(), block_bytes: int = 8 << 20) -> DataFrame:
    """``(item_id, doc_id)`` of every document that contains at least ``search.coverage`` of a passage's words, in
    order and in one or two stretches.

    Case, umlaut spelling, markup, hyphenation, spacing and punctuation do not matter, and single replaced words
    only lower the coverage.  A passage of fewer words than two shingles is found only where all its words stand
    together (half of three words is no evidence).  Null and wordless texts and passages give no row; repeated rows
    give one.  Passages of up to ``block_bytes`` of text are sent to the documents; more are joined to them by
    their sketches.
    """
    passages = materialize(passages_of(items).where("passage is not null"), "passages")
    source = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").where("text is not null and doc_id is not null")
    size = passages.agg(F.sum(F.octet_length("passage"))).first()[0]
    if (size or 0) > block_bytes:
        return _leaks_by_join(source, passages, search)
    spark = docs.sparkSession
    rows = passages.orderBy("item_id").collect()
    sent = spark.sparkContext.broadcast(([r["item_id"] for r in rows], [r["passage"] for r in rows]))  # of a checked size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        passages = Passages(*sent.value, search)
        for whole in batches:
            for b in slices(whole, 1):
                row, item = passages.find(b.column(1))
                if len(row):
                    yield pa.RecordBatch.from_arrays([pa.array(item, pa.int64()), b.column(0).take(pa.array(row))], names=["item_id", "doc_id"])

    return source.mapInArrow(run, "item_id bigint, doc_id bigint").distinct()


def _leaks_by_join(source: DataFrame, passages: DataFrame, search: Search) -> DataFrame:
    """The same for any number of passages: sketches are joined by value, then pairs with enough are verified."""

    def of_passages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in slices(whole, 1):
                p = Passages(b.column(0).to_pylist(), b.column(1).to_pylist(), search)
                value, i, size = p.sketches()
                need = np.where(size >= 100, 1.0, p.need[i])
                yield pa.RecordBatch.from_arrays([pa.array(value), pa.array(size), pa.array(p.ids[i]), pa.array(need)], names=["value", "size", "item_id", "need"])

    def of_docs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in slices(whole, 1):
                w = _words(b.column(1))
                h, at = _hashes(w), w.starts()
                shingle, doc, place = _placed(h, w.doc, at, search.shingle)
                windows = (np.diff(at) + search.window - 1) // search.window
                base = np.concatenate([[0], np.cumsum(windows)])
                g, v = _sketch(base[doc] + place // search.window, shingle)
                parts = [(np.searchsorted(base, g, side="right") - 1, v, 0), (doc, shingle, search.shingle)]
                parts += [(*_runs(h, w.doc, n), 100 + n) for n in range(1, 2 * search.shingle)]
                row = np.concatenate([p[0] for p in parts]).astype(np.int64)
                value = np.concatenate([p[1] for p in parts]).astype(np.uint64).view(np.int64)
                size = np.concatenate([np.full(len(p[0]), p[2], dtype=np.int64) for p in parts])
                yield pa.RecordBatch.from_arrays([pa.array(value), pa.array(size), b.column(0).take(pa.array(row))], names=["value", "size", "doc_id"])

    def verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in slices(whole, 1):
                items, docs = b.column(2).to_pylist(), b.column(0).to_pylist()
                passage = dict(zip(items, b.column(3).to_pylist()))
                asked = set(zip(docs, items))
                p = Passages(list(passage), list(passage.values()), search)
                row, item = p.find(b.column(1))
                got = sorted({(int(i), docs[r]) for r, i in zip(row.tolist(), item.tolist()) if (docs[r], i) in asked})
                yield pa.RecordBatch.from_arrays([pa.array([g[0] for g in got], pa.int64()), pa.array([g[1] for g in got], pa.int64())], names=["item_id", "doc_id"])

    keys = materialize(passages.mapInArrow(of_passages, "value bigint, size bigint, item_id bigint, need double"), "keys")
    # what no passage holds is dropped before anything is shuffled, as far as a filter of the keys can tell
    looked_up = source.mapInArrow(of_docs, "value bigint, size bigint, doc_id bigint").join(keys, ["value", "size"])
    pairs = looked_up.groupBy("doc_id", "item_id").agg(F.count(F.lit(1)).alias("n"), F.max("need").alias("need")).where("n >= need").select("doc_id", "item_id")
    pairs = materialize(pairs, "pairs")
    near = source.join(pairs, "doc_id").join(passages, "item_id").select("doc_id", "text", "item_id", "passage")
    return near.mapInArrow(verified, "item_id bigint, doc_id bigint").distinct()
