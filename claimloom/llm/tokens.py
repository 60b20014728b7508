"""Words of whole batches of texts, encoded as integers, by Arrow kernels instead of Python loops."""

from __future__ import annotations

import html
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Marks of UTF-8 text that was read as Latin-1 or Windows-1252.
_DAMAGE = re.compile("Ã.|â€|Â.")
_ENTITY = re.compile(r"&(?:#\d+|#x[0-9a-fA-F]+|[A-Za-z]+);")
BREAK = "\x01"


def repaired(text: str) -> str:
    """Text with entities resolved and UTF-8 damage undone where that is possible."""
    if _ENTITY.search(text):
        text = html.unescape(text)
    if _DAMAGE.search(text):
        for codec in ("cp1252", "latin-1"):
            try:
                return text.encode(codec).decode("utf-8")
            except (UnicodeEncodeError, UnicodeDecodeError):
                continue
        # mixed text: undo it piece by piece
        def piece(m: re.Match) -> str:
            try:
                return m.group(0).encode("cp1252").decode("utf-8")
            except (UnicodeEncodeError, UnicodeDecodeError):
                return m.group(0)

        text = re.sub("[ÃÂ][\x80-\xff‚ƒ„…†‡ˆ‰Š‹ŒŽ‘’“”•–—˜™š›œžŸ]|â(?:€.)", piece, text)
    return text


def cleaned(texts: pa.Array) -> pa.Array:
    """Null as empty text; markup removed (block elements break lines), entities and encoding repaired."""
    texts = pc.fill_null(texts.cast(pa.string()), "")
    odd = pc.match_substring_regex(texts, r"&(?:#\d+|#x[0-9a-fA-F]+|[A-Za-z]+);|Ã|â€|Â")
    if pc.any(odd).as_py():
        flags = odd.to_pylist()
        texts = pa.array([repaired(t) if f else t for t, f in zip(texts.to_pylist(), flags)], pa.string())
    if pc.any(pc.match_substring(texts, "<")).as_py():
        for tag in ("script", "style", "noscript"):
            texts = pc.replace_substring_regex(texts, rf"(?is)<{tag}\b.*?</{tag}\s*>", " ")
        texts = pc.replace_substring_regex(texts, r"(?i)</?(?:p|br|li|ul|ol|tr|td|th|table|div|h[1-6]|section|article)\b[^<>]*>", "\n")
        texts = pc.replace_substring_regex(texts, r"</?[A-Za-z!][^<>]*>", " ")
    return texts


class Words:
    """``code``: all words of the batch in order; ``doc``: the row of each; ``vocabulary``: the words behind the codes."""

    def __init__(self, texts: pa.Array, pattern: str, fold: bool = False):
        lower = pc.utf8_lower(texts)
        if fold:
            for a, b in (("ä", "ae"), ("ö", "oe"), ("ü", "ue"), ("ß", "ss"), ("­", "")):
                lower = pc.replace_substring(lower, a, b)
        spaced = pc.replace_substring_regex(lower, pattern, " ")
        lists = pc.split_pattern(pc.utf8_trim_whitespace(spaced), " ")
        if isinstance(lists, pa.ChunkedArray):
            lists = lists.combine_chunks()
        encoded = lists.flatten().dictionary_encode()
        code = encoded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        doc = np.repeat(np.arange(len(lists), dtype=np.int64), pc.list_value_length(lists).to_numpy(zero_copy_only=False))
        vocabulary = encoded.dictionary.to_pylist()
        if "" in vocabulary:
            keep = code != vocabulary.index("")
            code, doc = code[keep], doc[keep]
        self.code, self.doc, self.vocabulary, self.n_docs = code, doc, vocabulary, len(lists)

    def starts(self) -> np.ndarray:
        """Place of each row's first word, and the number of words at the end."""
        return np.searchsorted(self.doc, np.arange(self.n_docs + 1))


def slices(batch: pa.RecordBatch, column: int, max_bytes: int = 4 << 20):
    """The batch in consecutive pieces of about ``max_bytes`` of text; a single longer text is a piece of its own."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    at, total = 0, 0
    for i, s in enumerate(sizes.tolist()):
        if i > at and total + s > max_bytes:
            yield batch.slice(at, i - at)
            at, total = i, 0
        total += s
    if len(sizes) > at:
        yield batch.slice(at)
