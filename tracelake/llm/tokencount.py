"""Operator 3: token counts by count-only Viterbi over a unigram vocabulary.

An Aho-Corasick automaton lists, for every position of a word, the vocabulary
pieces that end there; dynamic programming carries the best score and the
number of pieces of the path that has it, and nothing else. Ties are broken
as the tokenizers library breaks them in its unigram model: candidates for an
end come in order of their start and only a strictly better score replaces
what is there; a character without a piece of its own may be unknown, at ten
below the lowest score of the vocabulary, and is written as its UTF-8 bytes
(``byte_fallback``) or, with its unknown neighbours, as one piece.

Words are runs of characters other than ASCII white space, with the
word mark U+2581 put in front; a mark inside a word starts another. A text's
count is the sum of its words' counts, which each worker remembers.

Defined results: a null or empty text has 0 tokens; repeated rows count
alike; an empty table gives an empty result. Whole texts are read, however
long; of the input only the text is read, so other columns don't matter.
"""

from __future__ import annotations

import re
from os.path import commonprefix

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracelake.llm.common import as_bytes, held, ship, slices
from tracelake.llm.words import Numbering, number_words, sums

MARK = "▁"
UNKNOWN_PENALTY = 10.0
#: Words a worker remembers before it starts afresh.
REMEMBERED_WORDS = 600_000
_SEGMENT = re.compile(f"(?s){MARK}[^{MARK}]*|[^{MARK}]+")


def read_vocabulary(path: str) -> list[tuple[str, float]]:
    """Pieces and scores of a sentencepiece model file, in order of id."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return [(model.id_to_piece(i), model.get_score(i)) for i in range(model.get_piece_size())]


class Counter:
    """Pieces of the best segmentation of a word."""

    def __init__(self, vocabulary: list[tuple[str, float]], byte_fallback: bool = True):
        self.automaton = ahocorasick.Automaton()
        for piece, score in vocabulary:
            if piece:
                self.automaton.add_word(piece, (len(piece), score))
        if len(self.automaton):
            self.automaton.make_automaton()
        self.unknown = min((s for _, s in vocabulary), default=0.0) - UNKNOWN_PENALTY
        self.byte_fallback = byte_fallback
        self.forget()

    def forget(self) -> None:
        self.numbers, self.counts = Numbering(), np.empty(0, np.int64)

    def segments(self, texts: list[str]) -> list[int]:
        """Pieces of each segment (no pre-tokenization).

        What the best path to a position is depends on the text before it
        alone, so segments are taken in sorted order and each goes on from
        the positions that it shares with the one before.
        """
        matches = self.automaton.iter if len(self.automaton) else lambda text: ()
        unknown, fallback = self.unknown, self.byte_fallback
        out = [0] * len(texts)
        best, pieces, open_unknown, before = [0.0], [0], [False], ""
        for i in sorted(range(len(texts)), key=texts.__getitem__):
            text = texts[i]
            shared = len(commonprefix((before, text)))
            del best[shared + 1:], pieces[shared + 1:], open_unknown[shared + 1:]
            found = list(matches(text))  # by end; the longest, that is the earliest start, first
            at, n = 0, len(found)
            while at < n and found[at][0] < shared:
                at += 1
            for end in range(shared, len(text)):
                top, count, open_end, length = None, 0, False, 0
                while at < n and found[at][0] == end:
                    length, score = found[at][1]
                    total = best[end + 1 - length] + score
                    if top is None or total > top:
                        top, count = total, pieces[end + 1 - length] + 1
                    at += 1
                if length != 1:  # the last match is the shortest: no piece for this character
                    total = best[end] + unknown
                    if top is None or total > top:
                        top, open_end = total, True
                        if fallback:
                            count = pieces[end] + len(text[end].encode("utf-8", "surrogatepass"))
                        else:
                            count = pieces[end] + (not open_unknown[end])
                best.append(top)
                pieces.append(count)
                open_unknown.append(open_end)
            out[i], before = pieces[-1], text
        return out

    def words(self, words: list[str]) -> list[int]:
        parts = [_SEGMENT.findall(w if w.startswith(MARK) else MARK + w) for w in words]
        counts = iter(self.segments([s for p in parts for s in p]))
        return [sum(next(counts) for _ in p) for p in parts]

    def texts(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Tokens and words of each text."""
        if len(self.numbers) > REMEMBERED_WORDS:
            self.forget()
        words, sizes = number_words(texts, self.numbers)
        known = len(self.counts)
        if len(self.numbers) > known:
            fresh = list(self.numbers)[known:]
            self.counts = np.concatenate([self.counts, np.array(self.words([w.decode() for w in fresh]), np.int64)])
        return sums(self.counts[words], sizes), sizes


def with_token_counts(docs: DataFrame, vocabulary: list[tuple[str, float]], text: str = "text", out: str = "n_tokens",
                      byte_fallback: bool = True) -> DataFrame:
    """``docs`` with the number of tokens of each whole text in column ``out``."""
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)  # one vocabulary file
    key = "counter", hash(tuple(vocabulary)), byte_fallback

    @F.arrow_udf("long")
    def count(values: pa.Array) -> pa.Array:
        counter = held(key, lambda: Counter(shared.value, byte_fallback))
        parts = [counter.texts(run)[0] for _, _, run in slices(values)]
        return pa.array(np.concatenate([np.empty(0, np.int64), *parts]))

    return docs.withColumn(out, count.asNondeterministic()(as_bytes(text)))
