import contextlib
import io
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tracelake.llm import topk

SCHEMA = "vec_id long, embedding array<float>, label int"


def whole(vector):
    if vector is None or any(x is None or not math.isfinite(x) for x in vector):
        return None
    return [max(-(2**31 - 1), min(2**31 - 1, math.floor(256 * float(x)))) for x in vector]


def by_hand(rows, k=5, every=50):
    vectors = [(r[0], w) for r in rows if r[0] is not None and (w := whole(r[1])) is not None]
    out = []
    for i, v in vectors:
        if i % every == 0:
            near = sorted((-sum(a * b for a, b in zip(v, w)), j) for j, w in vectors if j != i)[:k]
            out += [(i, rank, j, max(-(2**63), min(2**63 - 1, -s))) for rank, (s, j) in enumerate(near, 1)]
    return sorted(out)


def run(df, k=5, every=50):
    return topk.top_k(topk.whole_vectors(df), F.col("vec_id") % every == 0, k)


def as_rows(df):
    return sorted(tuple(r) for r in df.collect())


def vectors(rng, n, d=8):
    return [(i, [float(np.float32(rng.gauss(0, 0.3))) for _ in range(d)], 0) for i in range(n)]


def test_random_vectors_over_many_cells(spark, monkeypatch):
    monkeypatch.setattr(topk, "QUERY_BLOCK", 3)
    monkeypatch.setattr(topk, "CANDIDATE_GROUP", 40)
    rows = vectors(random.Random(1), 600)
    assert as_rows(run(spark.createDataFrame(rows, SCHEMA).repartition(5))) == by_hand(rows)
    assert as_rows(run(spark.createDataFrame(rows, SCHEMA), k=1, every=100)) == by_hand(rows, 1, 100)


def test_ties_go_to_the_smaller_id(spark):
    """A third of the rows are one vector, so every query has more ties than places."""
    rng = random.Random(2)
    rows = [(i * 7 - 3000, [1.0, 0.5] if i % 3 else [rng.random(), rng.random()], 0) for i in range(2000)]
    rng.shuffle(rows)
    assert as_rows(run(spark.createDataFrame(rows, SCHEMA).repartition(4))) == by_hand(rows)


def test_awkward_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [0.1, -0.2, 0.3], 1), (50, None, 1), (100, [], 1), (150, [0.5, None, 1.0], 1), (200, [nan, 0.0, 1.0], 1),
            (250, [inf, 0.0, 1.0], 1), (None, [9.0, 9.0, 9.0], 1), (1, [0.0, 0.0, 0.0], 1), (2, [-0.001, 0.001, 0.0039], 1),
            (-50, [3.0, -4.0, 5.0, 6.0], 1), (3, [1e30, -1e30, 1e30], 1), (300, [-1e30, 1e30, -1e30, 1e30], 1), (4, [0.1, -0.2, 0.3], 1),
            (0, [0.1, -0.2, 0.3], 1), (5, [2.0], 1), (2**62, [0.2, 0.2, 0.2], 1), (-(2**63), [0.2, 0.2, 0.2], 1)]
    df = spark.createDataFrame(rows, SCHEMA)
    for name in ("v", "q", "norm", "block", "cell", "kind", "step", "score", "rank", "query_id"):
        df = df.withColumn(name, F.lit("x"))
    assert as_rows(run(df)) == by_hand(rows)


@pytest.mark.parametrize("rows", [[], [(0, [1.0], 0)], [(1, [1.0], 0), (2, [2.0], 0)], [(0, [1.0], 0), (2, [2.0], 0)]])
def test_few_rows(spark, rows):
    assert as_rows(run(spark.createDataFrame(rows, SCHEMA))) == by_hand(rows)


def test_all_scores_equal(spark):
    rows = [(i, [0.0, 0.0], 0) for i in range(300)]
    assert as_rows(run(spark.createDataFrame(rows, SCHEMA))) == by_hand(rows)


def test_scores_are_counted_not_joined(spark):
    rows = vectors(random.Random(3), 300)
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        run(spark.createDataFrame(rows, SCHEMA)).explain()
    plan = buf.getvalue()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan and "BroadcastHashJoin" not in plan
