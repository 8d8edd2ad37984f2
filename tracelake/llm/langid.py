"""Operator 2: language identification with Kneser-Ney character models.

Per language an interpolated Kneser-Ney model of ORDER characters over words
with a space on either side: the highest order counts occurrences, lower ones
the distinct characters that come before. All languages share one table per
order, a sorted array of n-gram hashes with one column of log probabilities
(and one of back-off weights) per language; an n-gram is looked up once for
all languages by binary search. A text is given the language of the lowest
cross-entropy per character, and a confidence, the softmax of the
cross-entropies at a temperature fitted on texts kept out of the counts. A
text whose cross-entropy lies beyond what its language's kept-out texts show
(mean and ``REJECT_SD`` standard deviations) is marked rejected.

Words are runs of letters, lower-cased; every worker remembers the scores of
the words it met, so a word's n-grams are looked up once per worker.

The models learn from a bounded sample, about ``SAMPLE_DOCS`` documents per
language, picked by hash of the id; every whole text is classified, and the
text is the only input. The number of languages is taken to be small (codes).

Defined results: a null text and one without a letter are ``und``, with score
0 and not rejected; null languages and ids teach nothing; ties go to the first
language in code-point order; without anything to learn from all texts are
``und``; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from uuid import uuid4

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracelake.llm.common import crc32_of_id, cut, held, ship, slices
from tracelake.llm.words import Numbering, mix64, sums

ORDER = 5
SAMPLE_DOCS = 400
#: Sixteenths of the sample that are counted; the rest calibrates.
COUNT_SHARE = 12
#: A language of fewer counted documents than this calibrates nothing: all of its documents are counted.
FEW_COUNTED = 3
#: Probability floor of a character: uniform over this many.
ALPHABET = 1 << 16
REJECT_SD = 6.0
REMEMBERED_WORDS = 500_000
_LETTERS = re.compile(r"[^\W\d_]+")


@dataclass(frozen=True)
class Model:
    """keys[n]: sorted hashes of n+1-grams; logp[n], backoff[n]: (n-gram, language); NaN where a language lacks it."""

    languages: tuple[str, ...]
    keys: tuple[np.ndarray, ...] = ()
    logp: tuple[np.ndarray, ...] = ()
    backoff: tuple[np.ndarray, ...] = ()
    temperature: float = 1.0
    limits: tuple[float, ...] = ()


def words_of(text: str) -> list[str]:
    return _LETTERS.findall(text.lower())


def grams(words: list[str]) -> tuple[list[np.ndarray], np.ndarray]:
    """Per order, the hash of the n-gram ending at every character (0 where it would leave the word); and word sizes.

    Words are padded with a space on either side; the first space is context only.
    """
    codes = np.frombuffer("".join(f" {w} " for w in words).encode("utf-32-le"), np.uint32).astype(np.uint64)
    sizes = np.fromiter((len(w) + 2 for w in words), np.int64, len(words))
    place = np.arange(len(codes)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    single = mix64(codes)
    out, rolling = [single], single
    for n in range(2, ORDER + 1):
        rolling = mix64(np.concatenate([np.zeros(1, np.uint64), rolling[:-1]]) ^ mix64(single + np.uint64(n)))
        rolling = np.where(place >= n - 1, rolling, np.uint64(0))
        out.append(rolling)
    return out, sizes


def _train(words: list[str], counts: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Per order: n-gram hashes, interpolated log probabilities, and log back-off weights of each as a context."""
    hashes, sizes = grams(words)
    weight = np.repeat(counts, sizes)
    place = np.arange(len(weight)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    levels = []
    for n in range(1, ORDER + 1):
        # N-grams that end behind the leading space. Those that begin a word have nothing before
        # them to be counted by, so they count occurrences at every order, as the highest order does.
        at = np.flatnonzero(place >= max(1, n - 1))
        keys, first, inverse = np.unique(hashes[n - 1][at], return_index=True, return_inverse=True)
        occurrences = np.bincount(inverse, weight[at], len(keys))
        count = occurrences
        if n < ORDER:
            longer = at[place[at] >= n]
            _, one = np.unique(hashes[n][longer], return_index=True)
            kinds = np.bincount(inverse[np.searchsorted(at, longer[one])], minlength=len(keys)).astype(float)
            begins = place[at[first]] == n - 1
            count = np.where(begins & (n > 1), occurrences, np.maximum(kinds, 1))
        context = hashes[n - 2][at[first] - 1] if n > 1 else np.zeros(len(keys), np.uint64)
        levels.append((keys, count, context))
    out, lower = [], None
    for n, (keys, count, context) in enumerate(levels, 1):
        once, twice = (count == 1).sum(), (count == 2).sum()
        discount = min(0.9, max(0.1, once / (once + 2 * twice))) if once + twice else 0.5
        owners, inverse = np.unique(context, return_inverse=True)
        total = np.bincount(inverse, count)
        kinds = np.bincount(inverse)
        spare = discount * kinds / total
        if n == 1:
            p = (count - discount) / total[0] + spare[0] / ALPHABET
            floor = spare[0] / ALPHABET
        else:
            p = (count - discount) / total[inverse] + spare[inverse] * np.exp(lower)
        out.append([keys, np.log(p), np.zeros(len(keys))])
        if n > 1:  # the weight of backing off from a context is stored with the context, one order down
            at = np.searchsorted(out[n - 2][0], owners)
            inside = (at < len(out[n - 2][0])) & (out[n - 2][0][np.minimum(at, len(out[n - 2][0]) - 1)] == owners)
            out[n - 2][2][at[inside]] = np.log(spare[inside])
            if n == 2:
                space = ~inside  # the leading space is no event of order one, but a context
                out[0][0] = np.append(out[0][0], owners[space])
                out[0][1] = np.append(out[0][1], np.full(space.sum(), np.log(floor)))
                out[0][2] = np.append(out[0][2], np.log(spare[space]))
        if n < ORDER:  # log probability, at this order, of the last n characters of each longer n-gram
            longer_keys = levels[n][0]
            lower = _suffix_logp(hashes, place, n, longer_keys, keys, np.log(p))
    result = []
    for keys, logp, backoff in out:
        order = np.argsort(keys, kind="stable")
        result.append((keys[order], logp[order], backoff[order]))
    return result


def _suffix_logp(hashes: list[np.ndarray], place: np.ndarray, n: int, longer: np.ndarray, keys: np.ndarray,
                 logp: np.ndarray) -> np.ndarray:
    at = np.flatnonzero(place >= n)
    found, first = np.unique(hashes[n][at], return_index=True)
    suffix = hashes[n - 1][at[first[np.searchsorted(found, longer)]]]
    return logp[np.searchsorted(keys, suffix)]


def build(counts: dict[str, dict[str, int]]) -> Model:
    """Models from word counts by language; the tables of all languages are merged."""
    languages = tuple(sorted(counts))
    trained = []
    for lang in languages:
        words = sorted(counts[lang])
        trained.append(_train(words, np.array([counts[lang][w] for w in words], float)))
    keys, logp, backoff = [], [], []
    for n in range(ORDER):
        every = np.unique(np.concatenate([t[n][0] for t in trained]))
        p, b = np.full((len(every), len(languages)), np.nan, np.float32), np.zeros((len(every), len(languages)), np.float32)
        for i, t in enumerate(trained):
            at = np.searchsorted(every, t[n][0])
            p[at, i], b[at, i] = t[n][1], t[n][2]
        keys.append(every)
        logp.append(p)
        backoff.append(b)
    return Model(languages, tuple(keys), tuple(logp), tuple(backoff))


def score_words(words: list[str], model: Model) -> np.ndarray:
    """Log probability of each word (its letters and the space behind) in every language."""
    hashes, sizes = grams(words)
    place = np.arange(len(hashes[0])) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    p, context = None, None
    for n in range(ORDER):
        at = np.minimum(np.searchsorted(model.keys[n], hashes[n]), len(model.keys[n]) - 1)
        known = model.keys[n][at] == hashes[n]
        value = np.where(known[:, None], model.logp[n][at], np.nan)
        if n == 0:
            p = np.where(np.isnan(value), np.float32(-np.log(ALPHABET) - 3), value)
        else:
            p = np.where((place >= n)[:, None], np.where(np.isnan(value), p + context, value), p)
        # Back-off weight of the n+1 characters before the next one.
        weight = np.where(known[:, None], model.backoff[n][at], np.float32(0))
        context = np.concatenate([np.zeros((1, weight.shape[1]), np.float32), weight[:-1]])
    p[place == 0] = 0
    return sums(p.astype(np.float64), sizes)


class Classifier:
    """Scores texts with one model, remembering the words it met."""

    def __init__(self, model: Model):
        self.model = model
        self.forget()

    def forget(self) -> None:
        self.numbers = Numbering()
        self.scores = np.empty((0, len(self.model.languages)))
        self.symbols = np.empty(0, np.int64)

    def entropies(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Cross-entropy per symbol in every language (nats), and the number of symbols."""
        if len(self.numbers) > REMEMBERED_WORDS:
            self.forget()
        look, rows = self.numbers.__getitem__, []
        for text in texts:
            words = words_of(text)
            rows.append(np.fromiter(map(look, words), np.int64, len(words)))
        known = len(self.scores)
        if len(self.numbers) > known:
            fresh = list(self.numbers)[known:]
            # \w holds a few signs that are no letters: words without any letter carry nothing.
            symbols = np.array([len(w) + 1 if any(map(str.isalpha, w)) else 0 for w in fresh], np.int64)
            parts = [score_words(fresh[a:a + 20_000], self.model) for a in range(0, len(fresh), 20_000)]
            self.scores = np.concatenate([self.scores, np.concatenate(parts) * (symbols > 0)[:, None]])
            self.symbols = np.concatenate([self.symbols, symbols])
        sizes = np.fromiter(map(len, rows), np.int64, len(rows))
        words = np.concatenate([np.empty(0, np.int64), *rows])
        total = sums(self.symbols[words], sizes)
        ends = np.cumsum(sizes)
        scores = np.array([self.scores[words[e - s:e]].sum(axis=0) for s, e in zip(sizes, ends)]).reshape(len(texts), -1)
        return -scores / np.maximum(total, 1)[:, None], total

    def classify(self, texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language, confidence and rejection of each text."""
        model = self.model
        if not model.languages:
            return ["und"] * len(texts), np.zeros(len(texts)), np.zeros(len(texts), bool)
        entropy, total = self.entropies(texts)
        best = entropy.argmin(axis=1)
        low = entropy[np.arange(len(texts)), best]
        share = np.exp(-(entropy - low[:, None]) * model.temperature)
        score = np.where(total > 0, np.round(1 / share.sum(axis=1), 6), 0.0)
        limits = np.array(model.limits or [np.inf] * len(model.languages))
        return ([model.languages[b] if t else "und" for b, t in zip(best, total)], score, (total > 0) & (low > limits[best]))


def _classifier(key: str, shared: Broadcast) -> Classifier:
    """This worker's classifier of a broadcast model."""
    return held(("classifier", key), lambda: Classifier(shared.value))


def _texts(run: list[bytes]) -> list[str]:
    return [b.decode("utf-8", "replace") for b in run]


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts: dict[tuple[str, str], int] = {}
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            for w in words_of(text.decode("utf-8", "replace")):
                counts[lang, w] = counts.get((lang, w), 0) + 1
        yield pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in counts], pa.string()), pa.array([k[1] for k in counts], pa.string()),
             pa.array(list(counts.values()), pa.int64())], names=["lang", "word", "n"])


def fit(docs: DataFrame, learn: Column, doc_id: str = "doc_id", text: str = "text", lang: str = "lang",
        sample_docs: int = SAMPLE_DOCS) -> Model:
    """Train on the rows of ``docs`` that ``learn`` allows."""
    ship(docs.sparkSession)
    known = docs.where(learn).where(F.col(lang).isNotNull() & F.col(doc_id).isNotNull() & F.col(text).isNotNull())
    sizes = {r["lang"]: r["n"] for r in known.groupBy(F.col(lang).alias("lang")).agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return Model(())
    place = F.pmod(F.xxhash64(F.lit(2), doc_id), F.lit(1 << 30))
    share = F.lit(0)
    for name, n in sizes.items():
        share = F.when(F.col(lang) == name, F.lit(min(1 << 30, (sample_docs << 30) // n))).otherwise(share)
    sample = cut(known.where(place < share).select(
        F.col(lang).alias("lang"), F.col(text).cast("binary").alias("text"),
        (F.pmod(F.xxhash64(F.lit(3), doc_id), F.lit(16)) < COUNT_SHARE).alias("counted")))
    # A language with few counted rows has all of its sample counted, and none left for calibration.
    counted = {r["lang"]: r["n"] for r in sample.groupBy("lang").agg(F.sum(F.col("counted").cast("int")).alias("n")).collect()}
    rare = [name for name, n in counted.items() if n < FEW_COUNTED]
    sample = sample.withColumn("counted", F.col("counted") | F.col("lang").isin(rare))
    # Word counts of the sample, summed by Spark; their number is bounded by the sample's.
    counts: dict[str, dict[str, int]] = {}
    for row in (sample.where("counted").select("lang", "text").mapInArrow(_word_counts, "lang string, word string, n long")
                .groupBy("lang", "word").agg(F.sum("n").alias("n")).toLocalIterator()):
        counts.setdefault(row["lang"], {})[row["word"]] = row["n"]
    if not counts:
        return Model(())
    model = build(counts)
    key, shared = uuid4().hex, docs.sparkSession.sparkContext.broadcast(model)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            entropy, total = _classifier(key, shared).entropies(_texts(batch.column(1).to_pylist()))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(entropy.tolist(), pa.list_(pa.float64())), pa.array(total)],
                                             names=["lang", "h", "n"])

    rows = [r for r in sample.where("not counted").select("lang", "text")
            .mapInArrow(measure, "lang string, h array<double>, n long").collect() if r["n"] and r["lang"] in model.languages]
    if not rows:
        return model
    entropy = np.array([r["h"] for r in rows])
    truth = np.array([model.languages.index(r["lang"]) for r in rows])
    scaled = entropy - entropy.min(axis=1, keepdims=True)

    def loss(t: float) -> float:
        return float((scaled[np.arange(len(rows)), truth] * t + np.log(np.exp(-scaled * t).sum(axis=1))).mean())

    temperature = min((2.0 ** k for k in range(-1, 7)), key=loss)
    own = entropy[np.arange(len(rows)), truth]
    limits = tuple(float(own[truth == i].mean() + REJECT_SD * own[truth == i].std()) if (truth == i).sum() > 1 else float("inf")
                   for i in range(len(model.languages)))
    return Model(model.languages, model.keys, model.logp, model.backoff, temperature, limits)


def with_language(docs: DataFrame, model: Model, text: str = "text", out: str = "language") -> DataFrame:
    """``docs`` with a struct (lang, score, rejected) in column ``out``; lang is the best one even where rejected."""
    ship(docs.sparkSession)
    key, shared = uuid4().hex, docs.sparkSession.sparkContext.broadcast(model)  # bounded by the training sample
    kind = [pa.field("lang", pa.string()), pa.field("score", pa.float64()), pa.field("rejected", pa.bool_())]

    @F.arrow_udf("lang string, score double, rejected boolean")
    def language(values: pa.Array) -> pa.Array:
        parts = [_classifier(key, shared).classify(_texts(run)) for _, _, run in slices(values)]
        return pa.StructArray.from_arrays(
            [pa.array([x for p in parts for x in p[0]], pa.string()),
             pa.array(np.concatenate([np.empty(0), *[p[1] for p in parts]])),
             pa.array(np.concatenate([np.empty(0, bool), *[p[2] for p in parts]]))], fields=kind)

    return docs.withColumn(out, language.asNondeterministic()(F.coalesce(F.col(text), F.lit("")).cast("binary")))


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows that the registered query never learns from (crc32 of the id mod 3 is 1)."""
    return F.coalesce(F.pmod(crc32_of_id(doc_id), F.lit(3)) == 1, F.lit(False))
