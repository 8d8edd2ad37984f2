import random

import pytest
from pyspark.sql import functions as F

from tracelake.llm import mixing
from tests.llm.conftest import AWKWARD, DOC_SCHEMA


def targets_by_hand(sizes, weights=(3, 1, 2), share=1.5, most=2.0):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    out, left, free = {}, share * sum(sizes.values()), set(names)
    while free:
        total = sum(w[s] for s in free)
        over = {s for s in free if w[s] * left / total > most * sizes[s]}
        if not over:
            return out | {s: w[s] * left / total for s in free}
        for s in over:
            out[s] = most * sizes[s]
            left -= out[s]
        free -= over
    return out


def check(rows):
    sizes, taken = {}, {}
    for r in rows:
        sizes[r["source"]] = sizes.get(r["source"], 0) + r["size"]
        taken[r["source"]] = taken.get(r["source"], 0) + r["taken"]
    want = targets_by_hand(sizes)
    for r in rows:
        assert r["source_size"] == sizes[r["source"]]
        assert r["target"] == pytest.approx(want[r["source"]])
        assert 0 <= r["taken"] <= 2 * r["size"]
        if r["source_size"]:
            assert abs(r["copies"] - r["target"] / r["source_size"]) < 1
    largest = max(r["size"] for r in rows)
    assert all(abs(taken[s] - want[s]) <= 2 * largest for s in sizes)


def test_targets_and_copies_follow_the_rules(spark):
    rng = random.Random(5)
    docs = [(i, " ".join("x" * rng.randrange(1, 60)), None, rng.choice(["a", "b", "Z", "é", None, "hot", "hot", "hot"]), 0) for i in range(400)]
    df = spark.createDataFrame(docs, DOC_SCHEMA)
    first = mixing.mix_counts(df).collect()
    assert len(first) == 400
    check(first)
    again = mixing.mix_counts(df.repartition(5)).collect()
    assert sorted(map(str, first)) == sorted(map(str, again))


def test_awkward_documents(awkward):
    rows = mixing.mix_counts(awkward).collect()
    assert len(rows) == len(AWKWARD)
    check(rows)


def test_mixture_repeats_documents_whole(awkward):
    want = {}
    for r in mixing.mix_counts(awkward).collect():
        want[r["doc_id"], r["source"]] = want.get((r["doc_id"], r["source"]), 0) + r["copies"]
    mixed = mixing.mix(awkward)
    assert mixed.columns == awkward.columns
    got = {}
    for r in mixed.collect():
        got[r["doc_id"], r["source"]] = got.get((r["doc_id"], r["source"]), 0) + 1
        assert any(r["text"] == a[1] and r["doc_id"] == a[0] for a in AWKWARD)
    assert got == {k: n for k, n in want.items() if n}


def test_empty_table(empty):
    assert mixing.mix_counts(empty).count() == 0
    assert mixing.mix(empty).count() == 0


def test_hot_source_is_spread_over_ranges(spark):
    df = spark.range(2000).select(F.col("id").alias("doc_id"), F.lit("a b c").alias("text"), F.lit("only").alias("source"))
    rows = mixing.mix_counts(df).collect()
    assert sum(r["taken"] for r in rows) == pytest.approx(1.5 * 6000, abs=6)
