"""Reading level of each document by a familiar-word formula.

A word is familiar if it stands in the high-frequency list of its language, which is derived from document
frequencies over the whole corpus.  The formula's parts are the share of words outside the list (at several
lengths of the list) and the average sentence length.  On corpora whose rare words are not the hard ones these
two alone are weak, so word length and the difficulty of single words, both learned from rated documents, join
them in one ridge regression; the level is the rounded estimate.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimloom.llm.tokens import BREAK, Words, cleaned, slices
from claimloom.session import materialize

#: Function words that tell the language of a text.
FUNCTION_WORDS = {
    "de": ["der", "die", "das", "und", "ist", "den", "dem", "mit", "auf", "nicht", "ein", "eine", "von", "zu", "im"],
    "en": ["the", "and", "of", "is", "to", "with", "on", "not", "a", "an", "from", "in", "for", "that", "by"],
}
LANGUAGES = [*FUNCTION_WORDS, "other"]
#: Lengths of the familiar-word list at which the share of words outside it is taken.
LIST_SIZES = (300, 1000, 3000)


class _Batch:
    """Words, sentences and language of each text of a batch."""

    def __init__(self, texts: pa.Array):
        marked = pc.replace_substring_regex(cleaned(texts), r"[.!?]+[\"'”“)\]]*(?:\s+|$)|[:;]\s+|\s*\n\s*", f" {BREAK} ")
        w = Words(marked, rf"[^\p{{L}}{BREAK}]+")
        self.n_docs = w.n_docs
        stop = w.vocabulary.index(BREAK) if BREAK in w.vocabulary else -1
        word = w.code != stop
        first = np.ones(len(w.code), dtype=bool)
        first[1:] = ~word[:-1] | (w.doc[1:] != w.doc[:-1])
        self.sentences = np.bincount(w.doc[word & first], minlength=w.n_docs)
        self.code, self.doc, self.vocabulary = w.code[word], w.doc[word], w.vocabulary
        self.n = np.bincount(self.doc, minlength=w.n_docs)
        votes = []
        for lang in FUNCTION_WORDS:
            listed = set(FUNCTION_WORDS[lang])
            votes.append(self.total(np.array([v in listed for v in self.vocabulary], dtype=float)))
        votes.append(np.maximum(self.n * 0.02, 0.5))
        self.lang = np.argmax(np.vstack(votes), axis=0)

    def total(self, of_word: np.ndarray) -> np.ndarray:
        """Sum of a value of each word over each text."""
        return np.bincount(self.doc, weights=of_word[self.code], minlength=self.n_docs) if len(self.code) else np.zeros(self.n_docs)

    def features(self, ranks: list[dict[str, int]]) -> np.ndarray:
        n = np.maximum(self.n, 1)
        length = np.array([len(v) for v in self.vocabulary], dtype=float)
        asl = n / np.maximum(self.sentences, 1)
        cols = [asl, np.log(asl)]
        outside = np.zeros((len(LIST_SIZES), self.n_docs))
        for k, r in enumerate(ranks):
            here = self.lang == k
            if here.any():
                rank = np.array([r.get(v, 1 << 40) for v in self.vocabulary])
                for i, size in enumerate(LIST_SIZES):
                    outside[i, here] = (self.total((rank >= size).astype(float)) / n)[here]
        cols += [*outside, self.total(length) / n, self.total((length >= 8).astype(float)) / n, self.total((length >= 12).astype(float)) / n]
        cols += [(self.lang == k).astype(float) for k in range(len(FUNCTION_WORDS))]
        return np.column_stack(cols)


def document_frequencies(docs: DataFrame) -> DataFrame:
    """``(lang, word, n_docs)`` over all documents; counted within batches first, so the shuffle is small."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in slices(whole, 0):
                x = _Batch(b.column(0))
                if not len(x.code):
                    continue
                v = len(x.vocabulary)
                pairs = np.unique(x.doc * v + x.code)
                lw, n = np.unique(x.lang[pairs // v] * v + pairs % v, return_counts=True)
                words = pa.array(x.vocabulary, pa.string()).take(pa.array(lw % v))
                langs = pa.array(LANGUAGES).take(pa.array(lw // v))
                yield pa.RecordBatch.from_arrays([langs, words, pa.array(n, pa.int64())], names=["lang", "word", "n_docs"])

    counted = docs.select("text").mapInArrow(run, "lang string, word string, n_docs bigint")
    return counted.groupBy("lang", "word").agg(F.sum("n_docs").alias("n_docs"))


def familiar_words(docs: DataFrame, size: int = max(LIST_SIZES)) -> list[dict[str, int]]:
    """For each language its ``size`` most frequent words with their ranks; bounded by ``size``."""
    df = materialize(document_frequencies(docs), "words")
    out = []
    for lang in LANGUAGES:
        top = df.where(F.col("lang") == lang).orderBy(F.desc("n_docs"), "word").limit(size).collect()
        out.append({r["word"]: i for i, r in enumerate(top)})
    return out


@dataclass
class LevelModel:
    ranks: list[dict[str, int]]
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    intercept: float
    lowest: int = 1
    highest: int = 4
    words: dict[str, float] = field(default_factory=dict)
    word_scale: float = 1.0

    def estimate(self, x: _Batch) -> np.ndarray:
        y = self.intercept + ((x.features(self.ranks) - self.mean) / self.scale) @ self.weights
        if self.words:
            y += self.word_scale * x.total(np.array([self.words.get(v, 0.0) for v in x.vocabulary])) / np.maximum(x.n, 1)
        return y


def _rated_texts(docs: DataFrame, labels: DataFrame, max_labels: int) -> list:
    """At most ``max_labels`` rated documents (chosen by a hash of the id) with the mean of their ratings."""
    mean = labels.where("reading_level is not null and doc_id is not null").groupBy("doc_id").agg(F.avg("reading_level").alias("level"))
    rated = docs.select("doc_id", "text").where("text is not null").join(mean, "doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_labels)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in slices(whole, 1):
                x = _Batch(b.column(1))
                v = max(len(x.vocabulary), 1)
                key, n = np.unique(x.doc * v + x.code, return_counts=True)
                at = np.searchsorted(key // v, np.arange(x.n_docs + 1)).astype(np.int32)
                words = pa.array(x.vocabulary, pa.string()).take(pa.array(key % v)) if len(key) else pa.array([], pa.string())
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), b.column(2), pa.ListArray.from_arrays(pa.array(at), words), pa.ListArray.from_arrays(pa.array(at), pa.array(n, pa.int64())), pa.array(x.n), pa.array(x.sentences, pa.int64()), pa.array(x.lang, pa.int64())],
                    names=["doc_id", "level", "words", "counts", "n", "sentences", "lang"],
                )

    schema = "doc_id bigint, level double, words array<string>, counts array<bigint>, n bigint, sentences bigint, lang bigint"
    return rated.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", "level").mapInArrow(run, schema).orderBy("doc_id").collect()


class _Rated(_Batch):
    """The same view of rated documents, from their word counts."""

    def __init__(self, rows: list):
        self.vocabulary = sorted({w for r in rows for w in r["words"]})
        at = {w: i for i, w in enumerate(self.vocabulary)}
        self.n_docs = len(rows)
        self.doc = np.repeat(np.arange(len(rows)), [len(r["words"]) for r in rows]).astype(np.int64)
        self.code = np.array([at[w] for r in rows for w in r["words"]], dtype=np.int64)
        self.count = np.array([c for r in rows for c in r["counts"]], dtype=float)
        self.n = np.array([r["n"] for r in rows], dtype=np.int64)
        self.sentences = np.array([r["sentences"] for r in rows], dtype=np.int64)
        self.lang = np.array([r["lang"] for r in rows], dtype=np.int64)

    def total(self, of_word: np.ndarray) -> np.ndarray:
        return np.bincount(self.doc, weights=of_word[self.code] * self.count, minlength=self.n_docs)

    def shares(self, words: np.ndarray, block: int = 4096) -> Iterator[np.ndarray]:
        """Share of each of ``words`` in each document, in blocks of so many words: the whole is never in memory."""
        order = np.argsort(self.code, kind="stable")
        code, doc = self.code[order], self.doc[order]
        share = (self.count / np.maximum(self.n, 1)[self.doc])[order]
        for at in range(0, len(words), block):
            part = words[at : at + block]
            m = np.zeros((self.n_docs, len(part)), dtype=np.float32)
            lo, hi = np.searchsorted(code, part[0], "left"), np.searchsorted(code, part[-1], "right")
            place = np.searchsorted(part, code[lo:hi])
            ok = part[np.minimum(place, len(part) - 1)] == code[lo:hi]
            m[doc[lo:hi][ok], place[ok]] = share[lo:hi][ok]
            yield m


def fit_level_model(rows: list, ranks: list[dict[str, int]], ridge: float = 0.5, word_weight: float = 8.0, min_docs: int = 3, folds: int = 5, lowest: int = 1, highest: int = 4) -> LevelModel:
    """Ridge regression of the ratings; single ratings far off the fit are taken as slips and weigh less.

    ``rows`` as collected by the rated documents.  Without ratings the middle level is estimated for all.
    """
    if not rows:
        k = len(_Rated([{"words": ["a"], "counts": [1], "n": 1, "sentences": 1, "lang": 0}]).features(ranks)[0])
        return LevelModel(ranks, np.zeros(k), np.ones(k), np.zeros(k), (lowest + highest) / 2, lowest, highest)
    x, y = _Rated(rows), np.array([r["level"] for r in rows])
    f = x.features(ranks)
    mean, scale = f.mean(0), f.std(0) + 1e-9
    seen = np.flatnonzero(np.bincount(x.code, minlength=len(x.vocabulary)) >= min_docs)
    plain = (f - mean) / scale * 0.3
    kernel, means = plain @ plain.T, []
    for m in x.shares(seen):
        m *= np.float32(word_weight)
        means.append(m.mean(0))
        m -= means[-1]
        kernel += m @ m.T

    def solve(tr: np.ndarray) -> tuple[float, np.ndarray]:
        w = np.ones(len(tr))
        k = kernel[np.ix_(tr, tr)]
        for _ in range(4):
            # weighted dual ridge: the size of the system is the number of ratings, not of words
            mu = np.average(y[tr], weights=w)
            dual = np.linalg.solve(k + np.diag(ridge / w), y[tr] - mu)
            left = np.abs(y[tr] - mu - k @ dual)
            w = np.minimum(1.0, 0.5 / np.maximum(left, 1e-9))
        return mu, dual

    everyone = np.arange(len(y))
    slope, shift = 1.0, 0.0
    if len(y) >= 2 * folds:
        # ridge draws estimates to the middle; held-out estimates tell by how much
        held = np.zeros(len(y))
        for i in range(folds):
            te = everyone[i::folds]
            tr = np.setdiff1d(everyone, te)
            mu, dual = solve(tr)
            held[te] = mu + kernel[np.ix_(te, tr)] @ dual
        spread = held - held.mean()
        slope = float(np.clip(spread @ (y - y.mean()) / max(spread @ spread, 1e-9), 1.0, 1.3))
        shift = float(np.median(y - slope * held))
    mu, dual = solve(everyone)
    of_words, shifted = [], 0.0
    for m, middle in zip(x.shares(seen), means):
        m *= np.float32(word_weight)
        m -= middle
        of_words.append(slope * (m.T @ dual))
        shifted += float(middle @ of_words[-1])
    words = dict(zip((x.vocabulary[i] for i in seen), np.concatenate([*of_words, np.zeros(0)]).tolist()))
    return LevelModel(ranks, mean, scale, slope * (plain.T @ dual) * 0.3, float(slope * mu + shift - shifted), lowest, highest, words, word_weight)


def reading_levels(docs: DataFrame, labels: DataFrame, min_words: int = 80, max_labels: int = 2000) -> DataFrame:
    """``(doc_id, reading_level)`` for every document of at least ``min_words`` words split at white space.

    Null and short texts give no row; rows that repeat a doc_id give one, with the highest of their levels.  ``max_labels`` bounds the rated
    documents that the formula is fitted on; list, levels and all counts come from all documents.
    """
    spark = docs.sparkSession
    docs = docs.select("doc_id", "text")
    ranks = familiar_words(docs)
    model = fit_level_model(_rated_texts(docs, labels, max_labels), ranks)
    sent = spark.sparkContext.broadcast(model)  # bounded by the list sizes and the rated documents

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        for whole in batches:
            for b in slices(whole, 1):
                long = pa.array([t is not None and len(t.split()) >= min_words for t in b.column(1).to_pylist()], pa.bool_())
                b = b.filter(long)
                if not b.num_rows:
                    continue
                level = np.clip(np.floor(m.estimate(_Batch(b.column(1))) + 0.5), m.lowest, m.highest).astype(np.int32)
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(level, pa.int32())], names=["doc_id", "reading_level"])

    each = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(run, "doc_id bigint, reading_level int")
    return each.groupBy("doc_id").agg(F.max("reading_level").alias("reading_level"))


def level_profile(levels: DataFrame, docs: DataFrame) -> DataFrame:
    """``(source, reading_level, n_docs)``: how demanding the texts of each source are."""
    return levels.join(docs.select("doc_id", "source"), "doc_id").groupBy("source", "reading_level").agg(F.count(F.lit(1)).alias("n_docs"))
