"""Operator 4: toxicity by compression distance.

Separate zstandard dictionaries are trained on windows of ordinary and of toxic
text. A text is cut into word-aligned windows; a window that a toxic dictionary
shortens more than the ordinary one speaks for toxicity. The difference in
compressed bytes is weighed by its log-odds in the two classes and a text's
score is a logistic function, calibrated on labelled texts kept out of the
dictionaries, of its windows' weights.

A trained dictionary spends most of its bytes on the ordinary language that
toxic text is made of too, and alone finds few toxic documents (README). A second
toxic dictionary therefore is the ordinary one with a list of at most
``TOXIC_WORDS`` words behind it: ordinary language costs the same under both and
only toxic matter tells them apart. Both differences are features of the score.
Ordinary windows that the list shortens all the same are
added to the ordinary part, in a few rounds. That vocabulary is contrastive: words, and beginnings
of words, that follow significantly more different words in toxic texts than
in ordinary ones (different predecessors, so that a text copied a thousand
times counts once).

Learning uses a bounded sample of labelled rows, ``TOXIC_SAMPLE`` and
``ORDINARY_SAMPLE`` documents at most, picked by hash of the id; scoring
covers every whole text. Only the text is an input of a score.

Defined results: a null or empty text has no window and gets the score of
an empty text; repeated documents and label rows count once in the sample (a
document labelled both ways is toxic); null labels and ids teach nothing;
without labels of both classes every text gets the share of toxic labels (0
without labels); an empty table gives an empty result; very long texts are scored
whole. ``with_score`` replaces a column that is named like its output;
``reject_toxic`` gives all columns back as they were, whatever their names.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import partial

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracelake.llm.common import LOWER, as_bytes, crc32_of_id, cut, held, ship, slices, whole_rows

TOXIC_SAMPLE = 2000
ORDINARY_SAMPLE = 4000
#: Share of the sample, in sixteenths, that builds dictionaries; the rest calibrates.
BUILD_SHARE = 11
WINDOW = 60
LEVEL = 3
DICTIONARY_BYTES = 16384
#: Windows of ordinary text, and words of toxic text, that a dictionary is trained from.
TRAINING_WINDOWS = 30_000
TOXIC_WORDS = 400
MIN_SUPPORT = 5
MIN_LIFT = 6.0
MIN_Z = 5.0
#: Ordinary windows that the toxic dictionary shortens by HARD_GAIN bytes or more
#: join the ordinary part of both: HARD_WINDOWS a round.
HARD_GAIN, HARD_WINDOWS, HARD_ROUNDS = 3, 400, 2
#: Lengths of word beginnings that are looked at beside whole words (bytes).
STEMS = (4, 5, 6)
THRESHOLD = 0.3
#: Differences in compressed bytes are weighed within these bounds.
LOW, HIGH = -8, 12

_WINDOW = re.compile(rb"(?s)\S.{0,%d}(?!\S)|\S{%d}" % (WINDOW - 1, WINDOW))
_WORD = re.compile(rb"[a-z\x80-\xff]+")


@dataclass(frozen=True)
class Model:
    """Dictionaries, weights of the byte differences LOW..HIGH, and the logistic coefficients."""

    ordinary: bytes = b""
    toxic: bytes = b""
    trained: bytes = b""
    weights: tuple[tuple[float, ...], ...] = ()
    coefficients: tuple[float, ...] = ()
    prior: float = 0.0
    words: tuple[bytes, ...] = field(default=(), compare=False)


def text_windows(text: bytes) -> list[bytes]:
    """Word-aligned pieces of at most WINDOW bytes that cover the whole text."""
    return _WINDOW.findall(text.translate(LOWER))


def _compressors(model: Model) -> tuple:
    """``compress`` with the ordinary dictionary, the word list behind it, and the one trained on toxic text."""
    def make(dictionary: bytes):
        d = zstandard.ZstdCompressionDict(dictionary, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        d.precompute_compress(level=LEVEL)
        return zstandard.ZstdCompressor(level=LEVEL, dict_data=d, write_content_size=False, write_checksum=False, write_dict_id=False).compress

    dictionaries = model.ordinary, model.toxic, model.trained
    return held(("compressors", dictionaries), lambda: tuple(make(d or b" " * 8) for d in dictionaries))


def differences(text: bytes, model: Model) -> np.ndarray:
    """Two rows, per window: compressed bytes with the ordinary dictionary less those with the word list behind it,
    and less those with the dictionary trained on toxic text, within LOW..HIGH."""
    plain, listed, trained = _compressors(model)
    ws = text_windows(text)
    out = np.empty((2, len(ws)), np.int64)
    for i, w in enumerate(ws):
        n = len(plain(w))
        out[0, i], out[1, i] = n - len(listed(w)), n - len(trained(w))
    return np.clip(out, LOW, HIGH)


def _features(diffs: np.ndarray, weights: np.ndarray) -> tuple[float, ...]:
    """Of the word list's differences: sum, maximum, number of windows and sum by its root; of the trained dictionary's
    weights by its own row: sum by the root of the number, and maximum."""
    w, v = weights[0][diffs[0] - LOW], weights[1][diffs[1] - LOW]
    total, other, n = float(w.sum()), float(v.sum()), len(w)
    root = math.sqrt(n) if n else 1.0
    return (1.0, min(total, 60.0), float(w.max(initial=0.0)), math.log1p(n), min(total / root, 10.0),
            min(other / root, 10.0), float(v.max(initial=0.0)))


def score_texts(texts: list[bytes], model: Model) -> np.ndarray:
    if not model.coefficients:
        return np.full(len(texts), model.prior)
    weights, beta = np.array(model.weights), np.array(model.coefficients)
    x = np.array([_features(differences(t, model), weights) for t in texts]).reshape(len(texts), len(beta))
    return np.round(1 / (1 + np.exp(-np.clip(x @ beta, -30, 30))), 6)


def _vocabulary(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct (unit, hash of the word before, toxic) of a batch; a unit is `` word`` + space or `` stem``."""
    for batch in batches:
        seen: set[tuple[bytes, int, int]] = set()
        for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            ws = _WORD.findall(text.translate(LOWER))
            for before, w in set(zip([b"", *ws], ws)):
                p = zlib.crc32(before)
                seen.add((b" " + w + b" ", p, toxic))
                seen.update((b" " + w[:n], p, toxic) for n in STEMS if len(w) > n)
        rows = list(seen)
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in rows], pa.binary()), pa.array([r[1] for r in rows], pa.int64()),
             pa.array([r[2] for r in rows], pa.int32())], names=["unit", "before", "toxic"])


def _sample_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for text in batch.column(0).to_pylist():
            yield pa.RecordBatch.from_arrays([pa.array(text_windows(text), pa.binary())], names=["w"])


def _hard_windows(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for text in batch.column(0).to_pylist():
            gains, windows = differences(text, model)[0], text_windows(text)
            at = np.flatnonzero(gains >= HARD_GAIN)
            yield pa.RecordBatch.from_arrays([pa.array([windows[i] for i in at], pa.binary()), pa.array(gains[at], pa.int64())],
                                             names=["w", "gain"])


def training_sample(docs: DataFrame, labels: DataFrame, learn: Column, toxic: int = TOXIC_SAMPLE,
                    ordinary: int = ORDINARY_SAMPLE) -> tuple[DataFrame, dict[int, int]]:
    """(text bytes, toxic, build) of the sampled documents, checkpointed, and the labelled rows of each class.

    ``learn`` says of a label row (by its doc_id) whether it may be learned from.
    """
    known = (labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull()).where(learn)
             .groupBy("doc_id").agg(F.max((F.col("toxic") == 1).cast("int")).alias("toxic")))
    totals = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    picked = None
    for label, most in ((1, toxic), (0, ordinary)):
        part = known.where(F.col("toxic") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
        picked = part if picked is None else picked.unionByName(part)
    picked = cut(picked.select(F.col("doc_id").alias("_id"), "toxic"))  # toxic + ordinary rows at most
    sample = (docs.select("doc_id", "text").where(F.col("text").isNotNull())
              .join(F.broadcast(picked), F.col("doc_id") == F.col("_id"))
              .groupBy("_id", "toxic").agg(F.min("text").alias("text"))
              .select(as_bytes("text").alias("text"), "toxic",
                      (F.pmod(F.xxhash64(F.lit(1), "_id"), F.lit(16)) < BUILD_SHARE).alias("build")))
    return cut(sample.repartition(F.xxhash64("text"))), totals


def fit(docs: DataFrame, labels: DataFrame, learn: Column | None = None, toxic: int = TOXIC_SAMPLE,
        ordinary: int = ORDINARY_SAMPLE) -> Model:
    """Train on ``docs`` (doc_id, text) and ``labels`` (doc_id, toxic)."""
    ship(docs.sparkSession)
    sample, totals = training_sample(docs, labels, F.lit(True) if learn is None else learn, toxic, ordinary)
    total = sum(totals.values())
    prior = round(totals.get(1, 0) / total, 6) if total else 0.0
    build = sample.where("build")
    # Contrastive vocabulary of the toxic texts.
    pairs = build.select("text", "toxic").mapInArrow(_vocabulary, "unit binary, before long, toxic int").distinct()
    units = cut(pairs.groupBy("unit").agg(F.sum("toxic").alias("a"), F.sum(1 - F.col("toxic")).alias("b")))
    n1, n0 = (float(x or 0) for x in units.where(F.substring("unit", -1, 1) == F.lit(b" ")).agg(F.sum("a"), F.sum("b")).first())
    if not n1 or not n0:
        return Model(prior=prior)
    expected = (F.col("a") + F.col("b")) * (n1 / (n1 + n0))
    rated = units.withColumn("z", (F.col("a") - expected) / F.sqrt(expected))
    strong = ((F.col("a") >= MIN_SUPPORT) & (F.col("z") >= MIN_Z)
              & (F.col("a") / n1 >= MIN_LIFT * (F.col("b") + 0.5) / n0))
    marked = cut(rated.where(strong).orderBy(F.desc("z"), "unit").limit(TOXIC_WORDS))
    # Words that carry a marked beginning come along, the most frequent first.
    stems = marked.where(F.substring("unit", -1, 1) != F.lit(b" ")).select(F.col("unit").alias("stem"), F.col("z").alias("stem_z"))
    carried = (rated.where((F.substring("unit", -1, 1) == F.lit(b" ")) & (F.col("b") == 0) & (F.col("a") >= 2))
               .select("unit", "a", F.explode(F.array(*[F.substring("unit", 1, n + 1) for n in STEMS])).alias("stem"))
               .join(F.broadcast(stems), "stem").groupBy("unit").agg(F.max("a").alias("z")))
    chosen = (marked.select("unit", "z").unionByName(carried).groupBy("unit").agg(F.max("z").alias("z"))
              .orderBy(F.desc("z"), "unit").limit(TOXIC_WORDS).collect())
    vocabulary = tuple(bytes(r["unit"]) for r in chosen)
    def trained(label: int) -> bytes:
        windows = [bytes(r["w"]) for r in build.where(F.col("toxic") == label).select("text").mapInArrow(_sample_windows, "w binary")
                   .orderBy(F.xxhash64("w"), "w").limit(TRAINING_WINDOWS).collect()]
        try:
            return zstandard.train_dictionary(DICTIONARY_BYTES, windows).as_bytes()
        except (zstandard.ZstdError, ValueError):  # too few samples for the trainer
            return b" ".join(windows)[-DICTIONARY_BYTES:] or b" " * 8

    plain, harmful = trained(0), trained(1)

    def pair(ordinary: bytes) -> Model:
        # The strongest words come last: nearest to the window, and cheapest to refer to.
        return Model(ordinary, ordinary + b" " + b"".join(reversed(vocabulary)), harmful, prior=prior, words=vocabulary)

    model = pair(plain)
    for _ in range(HARD_ROUNDS):
        hard = (build.where("toxic = 0").select("text").mapInArrow(partial(_hard_windows, model=model), "w binary, gain long")
                .groupBy("w").agg(F.max("gain").alias("gain")).orderBy(F.desc("gain"), "w").limit(HARD_WINDOWS).collect())
        if not hard:
            break
        model = pair(b" ".join(bytes(r["w"]) for r in reversed(hard)) + b" " + model.ordinary)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            wide = HIGH - LOW + 1
            counts = [np.concatenate([np.bincount(d - LOW, minlength=wide) for d in differences(t, model)]) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array([c.tolist() for c in counts], pa.list_(pa.int64())), batch.column(1)],
                                             names=["counts", "toxic"])

    # One short row per document of the calibration part of the bounded sample.
    rows = sample.where("not build").select("text", "toxic").mapInArrow(measure, "counts array<bigint>, toxic int").collect()
    y = np.array([r["toxic"] for r in rows])
    if not len(rows) or y.all() or not y.any():
        return Model(prior=prior)
    counts = np.array([r["counts"] for r in rows], float).reshape(len(rows), 2, -1)
    weights = [gain_weights(counts[:, i], y) for i in range(2)]
    span = np.arange(LOW, HIGH + 1)
    x = np.array([_features(np.stack([np.repeat(span, row.astype(int)) for row in c]), weights) for c in counts])
    # Classes are sampled to different shares; rows weigh what they stand for.
    weight = np.where(y == 1, totals[1] / total / (y == 1).sum(), totals[0] / total / (y == 0).sum()) * len(y)
    beta = logistic_fit(x, y, weight)
    return Model(model.ordinary, model.toxic, harmful, tuple(map(tuple, weights)), tuple(beta), prior, vocabulary)


def gain_weights(counts: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Log-odds of a difference of at least so many bytes in toxic documents; only gains are evidence, and more is never less."""
    one, zero = counts[y == 1].sum(axis=0), counts[y == 0].sum(axis=0)
    tail1, tail0 = one[::-1].cumsum()[::-1] + 1, zero[::-1].cumsum()[::-1] + 1 + one.sum() / max(1.0, zero.sum())
    weights = np.log(tail1 / max(1.0, one.sum())) - np.log(tail0 / max(1.0, zero.sum()))
    weights[:1 - LOW] = 0
    return np.maximum.accumulate(np.maximum(weights, 0))


def logistic_fit(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Coefficients by Newton's method, with a small ridge on all but the first."""
    beta = np.zeros(x.shape[1])
    ridge = 0.1 * np.r_[0, np.ones(x.shape[1] - 1)]
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        step = np.linalg.solve((x * (weight * p * (1 - p))[:, None]).T @ x + np.diag(ridge + 1e-6),
                               x.T @ (weight * (y - p)) - ridge * beta)
        beta += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return beta


def with_score(docs: DataFrame, model: Model, text: str = "text", out: str = "toxicity") -> DataFrame:
    """``docs`` with the score of each whole text (0 to 1) in column ``out``."""
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # two dictionaries of bounded size

    @F.arrow_udf("double")
    def score(values: pa.Array) -> pa.Array:
        parts = [score_texts(run, shared.value) for _, _, run in slices(values)]
        return pa.array(np.concatenate([np.empty(0), *parts]))

    return docs.withColumn(out, score.asNondeterministic()(as_bytes(text)))


def reject_toxic(docs: DataFrame, labels: DataFrame, learn: Column | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that score below ``threshold``, with their own columns."""
    scored = with_score(whole_rows(docs), fit(docs, labels, learn), text="row.text", out="toxicity")
    return scored.where(F.col("toxicity") < threshold).select("row.*")


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows that the registered query never learns from (crc32 of the id mod 4 is 2; a null id is learned from by nobody)."""
    return F.coalesce(F.pmod(crc32_of_id(doc_id), F.lit(4)) == 2, F.lit(False))
