import math
import random
import re

import numpy as np
import pytest
import zstandard
from pyspark.sql import functions as F

from tracelake.llm import toxicity
from tests.llm.conftest import AWKWARD, DOC_SCHEMA

PLAIN = [f"{a}{b}{c}" for a in ("ta", "ro", "mi", "ne", "su") for b in ("la", "ker", "dor", "vin") for c in ("", "s", "tion", "et")]
BAD = ["vilescum", "grottle", "snarkwit", "dunderpate", "blightface"]


def corpus(spark, n=300, seed=3):
    rng = random.Random(seed)
    docs, labels = [], []
    for i in range(n):
        words = [rng.choice(PLAIN) for _ in range(rng.randrange(60, 200))]
        toxic = i % 3 == 0
        for _ in range(5 if toxic else 0):
            words.insert(rng.randrange(len(words)), rng.choice(BAD))
        docs.append((i, " ".join(words), None, "s", 0))
        labels.append((i, 1, int(toxic)))
    return (spark.createDataFrame(docs, DOC_SCHEMA), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))


def test_held_out_documents_are_told_apart(spark):
    docs, labels = corpus(spark)
    model = toxicity.fit(docs, labels, ~toxicity.held_out())
    rows = (toxicity.with_score(docs, model).join(labels, "doc_id").where(toxicity.held_out())
            .select("toxic", "toxicity").collect())
    hits = [r["toxicity"] >= toxicity.THRESHOLD for r in rows if r["toxic"]]
    misses = [r["toxicity"] >= toxicity.THRESHOLD for r in rows if not r["toxic"]]
    assert sum(hits) / len(hits) > 0.9
    assert sum(misses) / len(misses) < 0.1
    kept = toxicity.reject_toxic(docs, labels)
    assert kept.columns == docs.columns
    assert 150 < kept.count() < 250


def test_windows_cover_the_text_and_stay_whole():
    text = "some words, and averyveryverylongwordthatisfarlongerthanawindowcaneverbeandsoiscutintopieces end\n\nlast"
    windows = toxicity.text_windows(text.encode())
    assert b"".join(windows).replace(b" ", b"").replace(b"\n", b"") == text.lower().encode().replace(b" ", b"").replace(b"\n", b"")
    assert max(map(len, windows)) <= toxicity.WINDOW


def test_awkward_documents_and_labels(spark, awkward, empty):
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, 0), (5, None), (None, 1), (99, 1)], "doc_id long, toxic int")
    model = toxicity.fit(awkward, labels)
    rows = toxicity.with_score(awkward, model).select("text", "toxicity").collect()
    assert len(rows) == len(AWKWARD)
    assert all(0 <= r["toxicity"] <= 1 for r in rows)
    assert toxicity.with_score(empty, model).count() == 0
    none = toxicity.fit(awkward, labels.where(F.lit(False)))
    assert {r["toxicity"] for r in toxicity.with_score(awkward, none).collect()} == {0.0}
    fitted = toxicity.fit(*corpus(spark, 120, 4))
    scores = toxicity.with_score(awkward, fitted).select("text", "toxicity").collect()
    assert len({r["toxicity"] for r in scores if not (r["text"] or "").strip()}) == 1


def score_by_hand(text, model):
    """Windows, compressed lengths, weights and the logistic function in plain Python."""
    text = bytes(b + 32 if 65 <= b <= 90 else b for b in text)
    windows, rest = [], text
    while rest := rest.lstrip(b" \t\n\r\x0b\x0c"):
        n = min(len(rest), toxicity.WINDOW)
        if n < len(rest):
            ends = [i for i in range(1, n + 1) if re.match(rb"\s", rest[i:i + 1])]
            n = ends[-1] if ends else n
        windows.append(rest[:n])
        rest = rest[n:]

    def size(dictionary, window):
        d = zstandard.ZstdCompressionDict(dictionary, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        return len(zstandard.ZstdCompressor(level=toxicity.LEVEL, dict_data=d, write_content_size=False, write_checksum=False,
                                            write_dict_id=False).compress(window))

    def weights(dictionary, row):
        return [model.weights[row][max(toxicity.LOW, min(toxicity.HIGH, size(model.ordinary, w) - size(dictionary, w))) - toxicity.LOW]
                for w in windows]

    w, v, n = weights(model.toxic, 0), weights(model.trained, 1), len(windows)
    root = math.sqrt(n or 1)
    x = [1.0, min(sum(w), 60.0), max(w, default=0.0), math.log1p(n), min(sum(w) / root, 10.0), min(sum(v) / root, 10.0), max(v, default=0.0)]
    z = max(-30, min(30, sum(a * b for a, b in zip(x, model.coefficients))))
    return 1 / (1 + math.exp(-z))


def test_scores_equal_a_plain_version(spark):
    docs, labels = corpus(spark, 200, 5)
    model = toxicity.fit(docs, labels, ~toxicity.held_out())
    assert model.trained and model.trained not in (model.ordinary, model.toxic)
    texts = [r["text"] for r in docs.limit(60).collect()] + [a[1] or "" for a in AWKWARD if len(a[1] or "") < 5000]
    frame = spark.createDataFrame([(t,) for t in texts], "text string")
    got = {r["text"]: r["toxicity"] for r in toxicity.with_score(frame, model).collect()}
    for t in texts:
        assert got[t] == pytest.approx(score_by_hand(t.encode(), model), abs=2e-6), t


def test_weights_and_fit_by_hand():
    rng = np.random.default_rng(3)
    y = np.array([1] * 30 + [0] * 90)
    span = toxicity.HIGH - toxicity.LOW + 1
    counts = np.array([np.bincount(np.clip(rng.poisson(3 if t else 1, 20), 0, toxicity.HIGH) - toxicity.LOW, minlength=span) for t in y], float)
    got = toxicity.gain_weights(counts, y)
    one, zero, most = counts[y == 1].sum(axis=0), counts[y == 0].sum(axis=0), 0.0
    for gain in range(toxicity.LOW, toxicity.HIGH + 1):
        if gain > 0:
            up1 = sum(one[gain - toxicity.LOW:]) + 1
            up0 = sum(zero[gain - toxicity.LOW:]) + 1 + sum(one) / sum(zero)
            most = max(most, math.log(up1 / sum(one)) - math.log(up0 / sum(zero)), 0.0)
        assert got[gain - toxicity.LOW] == pytest.approx(most if gain > 0 else 0.0)
    x = np.column_stack([np.ones(120), y + rng.normal(0, 1, 120), rng.normal(0, 1, 120)])
    weight = np.where(y == 1, 0.5, 1.5)
    beta = toxicity.logistic_fit(x, y, weight)
    p = 1 / (1 + np.exp(-(x @ beta)))
    # At the maximum of the penalised likelihood its slope is nought.
    assert x.T @ (weight * (y - p)) - np.array([0, 0.1, 0.1]) * beta == pytest.approx(np.zeros(3), abs=1e-5)
