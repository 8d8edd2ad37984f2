import random
import re
from hashlib import sha256

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.llm.conftest import AWKWARD, DOC_SCHEMA
from tracelake.llm import infill

UNIT = re.compile(r"[A-Za-z]+|[^A-Za-z]")


def by_hand(doc_id, text):
    text = text or ""
    units = UNIT.findall(text)
    digest = sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[8 * i:8 * i + 8], 16) for i in range(4))
    n = len(units)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    prefix, middle, suffix = ("".join(units[x:y]) for x, y in ((0, a), (a, b), (b, n)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return str(doc_id), n, "plain", None, None, text, text
    if h4 % 100 < 20:
        return str(doc_id), n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}", text
    return str(doc_id), n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}", text


def as_rows(df):
    df = df.withColumn("restored", infill.restored(F.col("output"), F.col("form")))
    return sorted(((str(r["doc_id"]), *tuple(r)[1:]) for r in df.collect()), key=str)


def test_awkward_and_empty_tables(spark, awkward, empty):
    extra = awkward.withColumn("n", F.lit(1)).withColumn("form", F.lit("x")).withColumn("output", F.lit("y")).withColumn("h1", F.lit(3))
    got = as_rows(infill.fill_in_middle(extra))
    assert got == sorted((by_hand(r[0], r[1]) for r in AWKWARD), key=str)
    assert infill.fill_in_middle(empty).count() == 0


def test_marks_near_marks_and_odd_characters(spark):
    rng = random.Random(4)
    bits = ["<", "P", "S", "M", ">", "<P", "S>", "é", "中国", "🙂", "\n", "\x00", "word", "Zz", "1", " ", "̀", "￿"]
    rows = [(i, "".join(rng.choice(bits) for _ in range(rng.randrange(60))), "en", "a", 0) for i in range(400)]
    rows += [(1000 + i, "a <P> b", "en", "a", 0) for i in range(5)] + [(-7, "negative id", "en", "a", 0)]
    got = as_rows(infill.fill_in_middle(spark.createDataFrame(rows, DOC_SCHEMA).repartition(2)))
    assert got == sorted((by_hand(r[0], r[1]) for r in rows), key=str)
    assert {r[2] for r in got} == {"plain", "psm", "spm"}


def test_very_long_texts(spark):
    rows = [(i, "Straße 中国 naïve " * 200_000 + "z" * 100_000, "en", "a", 0) for i in range(2)]
    got = as_rows(infill.fill_in_middle(spark.createDataFrame(rows, DOC_SCHEMA)))
    assert got == sorted((by_hand(r[0], r[1]) for r in rows), key=str)


@settings(max_examples=200, deadline=None, derandomize=True)
@given(st.lists(st.text(alphabet=st.characters(codec="utf-8"), max_size=40), max_size=6), st.integers(0, 2**32 - 1), st.integers(0, 2**32 - 1))
def test_boundaries_equal_a_scan_by_code_point(texts, h1, h2):
    raw = [t.encode() for t in texts]
    n, p, m, prefix, middle = infill.cut_texts(raw, np.full(len(raw), h1), np.full(len(raw), h2))
    for i, t in enumerate(texts):
        units = UNIT.findall(t)
        a, b = sorted((h1 % (len(units) + 1), h2 % (len(units) + 1)))
        assert n[i] == len(units)
        assert raw[i][:p[i]].decode() == "".join(units[:a]) and raw[i][p[i]:m[i]].decode() == "".join(units[a:b])
        assert (prefix[i], middle[i]) == (len("".join(units[:a])), len("".join(units[a:b])))
