import numpy as np
import pytest
from pyspark.sql import functions as F

from tracelake.llm import langid
from tests.llm.conftest import AWKWARD, DOC_SCHEMA


def counts(text):
    out = {}
    for w in langid.words_of(text):
        out[w] = out.get(w, 0) + 1
    return out


def brute_force(train: dict, order: int):
    """Interpolated Kneser-Ney by dictionaries: probability of a character after a context within its word."""
    occ = [dict() for _ in range(order + 1)]
    for w, n in train.items():
        s = f" {w} "
        for k in range(1, order + 1):
            for e in range(1, len(s)):
                if e - k + 1 >= 0:
                    g = s[e - k + 1:e + 1]
                    occ[k][g] = occ[k].get(g, 0) + n
    cnt = [dict() for _ in range(order + 1)]
    for k in range(1, order + 1):
        for g, n in occ[k].items():
            if k == order or (k > 1 and g[0] == " "):
                cnt[k][g] = n
            else:
                cnt[k][g] = max(1, len({h[0] for h in occ[k + 1] if h[1:] == g}))
    disc = [0] * (order + 1)
    for k in range(1, order + 1):
        one, two = sum(v == 1 for v in cnt[k].values()), sum(v == 2 for v in cnt[k].values())
        disc[k] = min(0.9, max(0.1, one / (one + 2 * two))) if one + two else 0.5

    def p(context, c):
        k = len(context) + 1
        rows = {g: n for g, n in cnt[k].items() if g[:-1] == context}
        lower = p(context[1:], c) if k > 1 else 1 / langid.ALPHABET
        if not rows:
            return lower
        total = sum(rows.values())
        own = rows.get(context + c, 0)
        return max(0, own - disc[k]) / total + disc[k] * len(rows) / total * lower

    return p


def test_scores_equal_a_dictionary_version():
    train = counts("banana bandana ananas an a nab ban band abba anna anne nanna baba")
    model = langid.build({"xx": train})
    p = brute_force(train, langid.ORDER)
    for word in ("banana", "band", "anab", "a", "bananas", "nnnb"):
        s = f" {word} "
        want = 0.0
        for e in range(1, len(s)):
            want += np.log(p(s[max(0, e - langid.ORDER + 1):e], s[e]))
        if all(ch in "banseda " for ch in s):
            assert langid.score_words([word], model)[0, 0] == pytest.approx(want, abs=1e-3)


def test_distributions_sum_to_one():
    train = counts("banana bandana ananas an a nab ban band")
    p = brute_force(train, langid.ORDER)
    letters = sorted({c for w in train for c in w} | {" "})
    for context in ("", "a", " ban", "nan"):
        total = sum(p(context, c) for c in letters) + (langid.ALPHABET - len(letters)) * p(context, "\uffff")
        assert total == pytest.approx(1, abs=1e-6)


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = langid.fit(docs, ~langid.held_out(), sample_docs=60)
    rows = langid.with_language(docs.select("doc_id", "text", F.col("lang").alias("truth")), model).where(langid.held_out()).select(
        "truth", "language.*").collect()
    assert len(rows) > 200
    assert sum(r["truth"] == r["lang"] for r in rows) / len(rows) > 0.97
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_foreign_text_is_rejected(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = langid.fit(docs, ~langid.held_out(), sample_docs=60)
    odd = spark.createDataFrame([("zxqj kkqx wvvq xxjq zzkq " * 20,)], "text string")
    assert langid.with_language(odd, model).first()["language"]["rejected"]


def test_awkward_documents(awkward, empty, spark):
    model = langid.fit(awkward, F.lit(True))
    rows = langid.with_language(awkward, model).select("doc_id", "text", "language.lang", "language.score").collect()
    assert len(rows) == len(AWKWARD)
    for r in rows:
        if not r["text"] or not any(ch.isalpha() for ch in r["text"]):
            assert (r["lang"], r["score"]) == ("und", 0.0)
        else:
            assert r["lang"] in {"en", "de", "fr"}
    assert langid.with_language(empty, model).count() == 0
    nothing = langid.fit(empty, F.lit(True))
    assert {r["lang"] for r in langid.with_language(awkward, nothing).select("language.lang").collect()} == {"und"}


def test_a_language_of_one_document_is_learned(spark):
    rows = [(i, "the quick brown fox jumps over the lazy dog", "en", "a", 1) for i in range(100, 130)]
    rows += [(i, f"{chr(98 + i) * 3}oru {chr(98 + i) * 2}ami", f"x{i}", "a", 1) for i in range(16)]
    model = langid.fit(spark.createDataFrame(rows, DOC_SCHEMA), F.lit(True))
    assert set(model.languages) == {r[2] for r in rows}
