"""Operator 12: fill-in-middle transformation.

A text is cut into units (a run of ASCII letters, or one other code point) and
two unit boundaries, drawn from a hash of the row's id, split it into prefix,
middle and suffix. The parts are written in one of two orders behind their
marks, or the text is left plain.

The boundaries are found on the UTF-8 bytes of a whole Arrow batch, viewed as
64-bit words: arithmetic on eight bytes at once marks the bytes that end a
unit and those that begin a code point, ``bitwise_count`` counts the marks of
each word, a search in the running counts finds the word that holds a wanted
mark, and the mark's place among the eight bytes is resolved within the word.

Defined results: a null text is an empty one; an empty text has no units and
stays plain; texts of any length are cut whole; a null id draws from the hash of
``1:`` alone; repeated rows get the same result each; other columns of the
input, whatever their names, are not looked at; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracelake.llm.common import as_bytes, ship, slices

#: The marks of prefix, suffix and middle; percentages of plain texts and of suffix-first texts.
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
PLAIN_FROM, SUFFIX_FIRST_BELOW = 90, 20

_HIGH = np.uint64(0x8080808080808080)
_LOW = np.uint64(0x7F7F7F7F7F7F7F7F)
_BYTES = np.uint64(0x0101010101010101)


def _letters(words: np.ndarray) -> np.ndarray:
    """High bit of every byte that is an ASCII letter."""
    small = (words | _BYTES * np.uint64(0x20)) & _LOW
    from_a = small + _BYTES * np.uint64(0x80 - ord("a"))
    past_z = small + _BYTES * np.uint64(0x80 - ord("z") - 1)
    return from_a & ~past_z & ~words & _HIGH


def _inner(words: np.ndarray) -> np.ndarray:
    """High bit of every byte that continues a code point (10xxxxxx)."""
    return words & ~(words << np.uint64(1)) & _HIGH


def _next(marks: np.ndarray) -> np.ndarray:
    """Marks of the bytes one place further on."""
    after = np.append(marks[1:], np.uint64(0))
    return marks >> np.uint64(8) | after << np.uint64(56)


class Marks:
    """Marked bytes of a buffer, counted word by word."""

    def __init__(self, marks: np.ndarray):
        self.marks = marks
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(marks), dtype=np.int64)])

    def rank(self, at: np.ndarray) -> np.ndarray:
        """Marks before the bytes ``at``."""
        word, byte = at >> 3, (at & 7).astype(np.uint64)
        inside = np.append(self.marks, np.uint64(0))[word] & ((np.uint64(1) << (byte * np.uint64(8))) - np.uint64(1))
        return self.before[word] + np.bitwise_count(inside)

    def select(self, k: np.ndarray) -> np.ndarray:
        """Places of the marks number ``k`` (from 0)."""
        word = np.searchsorted(self.before, k, "right") - 1
        left = k - self.before[word]
        flags = self.marks[word][:, None] >> (np.arange(8, dtype=np.uint64) * np.uint64(8) + np.uint64(7)) & np.uint64(1)
        return word * 8 + np.argmax(np.cumsum(flags, axis=1, dtype=np.int64) > left[:, None], axis=1)


def mark_units(buffer: bytes, stops: np.ndarray) -> tuple[Marks, Marks]:
    """Bytes that end a unit and bytes that begin a code point, for texts laid end to end up to ``stops``."""
    padded = np.zeros(-(-max(1, len(buffer)) // 8) * 8, np.uint8)
    padded[:len(buffer)] = np.frombuffer(buffer, np.uint8)
    words = padded.view("<u8")
    letters, inner = _letters(words), _inner(words)
    ends = ~_next(inner) & ~(letters & _next(letters)) & _HIGH
    flags, begins = ends.view(np.uint8), (~inner & _HIGH)
    flags[stops[stops > 0] - 1] = 0x80  # a text ends there, whatever follows
    flags[len(buffer):] = 0
    begins.view(np.uint8)[len(buffer):] = 0
    return Marks(ends), Marks(begins)


def cut_texts(texts: list[bytes], h1: np.ndarray, h2: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Units of every text, byte ends of prefix and middle within it, and their code points."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    stops = np.cumsum(sizes)
    starts = stops - sizes
    units, points = mark_units(b"".join(texts), stops)
    base = units.rank(starts)
    n = units.rank(stops) - base
    low, high = np.sort(np.stack([h1 % (n + 1), h2 % (n + 1)]), axis=0)

    def end_of(k: np.ndarray) -> np.ndarray:
        at = starts.copy()
        some = k > 0
        at[some] = units.select(base[some] + k[some] - 1) + 1
        return at

    p, m = end_of(low), end_of(high)
    first = points.rank(p)
    return n, p - starts, m - starts, first - points.rank(starts), points.rank(m) - first


def _transform(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        h = [batch.column(i).to_numpy() for i in range(2, 6)]
        for a, b, texts in slices(batch.column(1)):
            h1, h2, h3, h4 = (x[a:b] for x in h)
            n, p, m, prefix_chars, middle_chars = cut_texts(texts, h1, h2)
            marked = [PREFIX in t or SUFFIX in t or MIDDLE in t for t in texts]
            plain = (n == 0) | np.array(marked, bool) | (h3 % 100 >= PLAIN_FROM)
            form = np.where(plain, "plain", np.where(h4 % 100 < SUFFIX_FIRST_BELOW, "spm", "psm"))
            out = []
            for text, f, i, j in zip(texts, form.tolist(), p.tolist(), m.tolist()):
                if f == "psm":
                    text = b"".join((PREFIX, text[:i], SUFFIX, text[j:], MIDDLE, text[i:j]))
                elif f == "spm":
                    text = b"".join((SUFFIX, text[j:], PREFIX, text[:i], MIDDLE, text[i:j]))
                out.append(text)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(a, b - a), pa.array(n), pa.array(form.tolist(), pa.string()),
                 pa.array(prefix_chars, mask=plain), pa.array(middle_chars, mask=plain), pa.array(out, pa.binary()).cast(pa.string())],
                names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])


def draws(doc_id: str = "doc_id") -> list[Column]:
    """The four numbers a row draws: 8-digit groups of the hash of ``1:`` and its id."""
    digest = F.sha2(F.concat(F.lit("1:"), F.coalesce(F.col(doc_id).cast("string"), F.lit(""))).cast("binary"), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]


def fill_in_middle(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, n (units), form, prefix_chars, middle_chars, output (the transformed text)."""
    ship(docs.sparkSession)
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), as_bytes(text).alias("text"),
                       *[h.alias(f"h{i}") for i, h in enumerate(draws(doc_id), 1)])
    return rows.mapInArrow(_transform, "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string")


def restored(output: Column, form: Column) -> Column:
    """The text that a transformed text was made from.

    The first mark of each kind is the one written: a text that holds a mark itself is never transformed.
    """
    parts = F.split(output, "<[PSM]>", -1)
    first, second, middle = (F.get(parts, F.lit(i)) for i in (1, 2, 3))
    return (F.when(form == "psm", F.concat(first, middle, second))
            .when(form == "spm", F.concat(second, middle, first)).otherwise(output))
