"""Operator 10: quality rules by repetition coverage.

The words of a text become 64-bit values; rolling hashes of several n-gram
lengths are computed over all texts of a slice at once in numpy. An n-gram
met before in its text is a duplicate, and the characters inside duplicate
n-grams (each counted once per length) are measured against all characters in
words; so are the characters of lines met before. A text is kept if its plain
counts are in order and no share passes its limit.

Only windows whose three-word window occurs twice can be duplicates of a
greater length, so one sort covers all windows and the others only those.

Defined results: a null or empty text has no words and is not kept (fewer
than ``MIN_WORDS``); repeated rows are judged alike; an empty table gives an
empty result. Columns of the input that are named like an output are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracelake.llm.common import as_bytes, ship, slices
from tracelake.llm.words import BASE, Numbering, mix64, number_words, sums

MIN_WORDS = 50
#: Largest share of words in three-word windows found twice, in per cent.
MAX_REPEAT_WORDS = 50
#: Largest share of word characters inside duplicate n-grams, in per cent, by length.
LIMITS = {5: 15, 6: 14, 7: 13, 8: 12, 9: 11, 10: 10}
#: Largest share of word characters in lines met before, in per cent.
MAX_DUP_LINE_CHARS = 20
_SYMBOLS = b"#*$%&|<>"
_CONTINUATION = bytes(range(0x80, 0xC0))
_FIELDS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "dup_line_chars",
           *[f"dup_{n}gram_chars" for n in LIMITS]]


def _n_chars(word: bytes) -> int:
    return len(word.translate(None, _CONTINUATION))


def _repeats(keys: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of ``places``, those whose key occurs twice or more, and those whose key occurred before."""
    if not len(keys):
        return places, places
    order = np.argsort(keys, kind="stable")
    same = keys[order][1:] == keys[order][:-1]
    later = np.r_[False, same]
    return np.sort(places[order[later | np.r_[same, False]]]), np.sort(places[order[later]])


def _covered(starts: np.ndarray, n: int, size: int) -> np.ndarray:
    """Words inside windows of ``n`` words."""
    edges = np.bincount(starts, minlength=size + 1)[:size + 1] - np.bincount(starts + n, minlength=size + 1)[:size + 1]
    return np.cumsum(edges)[:size] > 0


def _dup_lines(text: bytes) -> tuple[int, int]:
    """Lines with a word that equal an earlier line, and the characters of their words."""
    seen, count, chars = set(), 0, 0
    for line in text.split(b"\n"):
        if line in seen:
            count, chars = count + 1, chars + sum(map(_n_chars, line.split()))
        elif line.split(None, 1):
            seen.add(line)
    return count, chars


def measure(texts: list[bytes]) -> dict[str, np.ndarray]:
    """The counts of _FIELDS for each text."""
    vocabulary = Numbering()
    words, sizes = number_words(texts, vocabulary)
    chars = np.fromiter(map(_n_chars, vocabulary), np.int64, len(vocabulary))[words]
    lines = np.array([_dup_lines(t) if b"\n" in t else (0, 0) for t in texts], np.int64).reshape(-1, 2)
    out = {"n_words": sizes, "word_chars": sums(chars, sizes), "n_dup_lines": lines[:, 0], "dup_line_chars": lines[:, 1],
           "n_symbols": np.fromiter((len(t) - len(t.translate(None, _SYMBOLS)) for t in texts), np.int64, len(texts))}
    owner = np.repeat(np.arange(len(texts)), sizes)
    stop = np.repeat(np.cumsum(sizes), sizes)
    value, total = mix64(words), len(words)
    rolling, salt = value.copy(), mix64(owner)
    places = np.arange(total)
    for n in range(2, max(LIMITS) + 1):
        # rolling[i] becomes the hash of words i .. i + n - 1.
        rolling = rolling[:max(0, total - n + 1)] * BASE + value[n - 1:]
        if n < 3 or n > 3 and n not in LIMITS:
            continue
        places = places[places + n <= stop[places]] if total else places
        twice, later = _repeats(rolling[places] ^ salt[places], places)
        if n == 3:
            out["n_repeat_words"] = sums(_covered(twice, 3, total).astype(np.int64), sizes)
            places = twice
        if n in LIMITS:
            out[f"dup_{n}gram_chars"] = sums(np.where(_covered(later, n, total), chars, 0), sizes)
    return out


def with_quality(docs: DataFrame, text: str = "text", out: str = "quality") -> DataFrame:
    """``docs`` with a struct of the measured counts in column ``out``."""
    ship(docs.sparkSession)
    kind = pa.struct([(f, pa.int64()) for f in _FIELDS])

    @F.arrow_udf(", ".join(f"{f} long" for f in _FIELDS))
    def quality(values: pa.Array) -> pa.Array:
        parts = [measure(run) for _, _, run in slices(values)]
        return pa.StructArray.from_arrays(
            [pa.array(np.concatenate([np.empty(0, np.int64), *[p[f] for p in parts]])) for f in _FIELDS], fields=list(kind))

    return docs.withColumn(out, quality.asNondeterministic()(as_bytes(text)))


def judge(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, the counts, base_failed and kept."""
    rows = with_quality(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), out="q").select("doc_id", "q.*")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_WORDS * F.col("n_words"))
    excess = 100 * F.col("dup_line_chars") > MAX_DUP_LINE_CHARS * F.col("word_chars")
    for n, limit in LIMITS.items():
        excess |= 100 * F.col(f"dup_{n}gram_chars") > limit * F.col("word_chars")
    return rows.withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & ~excess)
