import random
import re

from tracelake.llm import decontaminate
from tests.llm.conftest import AWKWARD, BASE, DOC_SCHEMA, LONG

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def by_hand(text, items):
    w, hit, found = words(text), set(), set()
    for item, t in items:
        v = words(t)
        n = min(10, len(v))
        for i in range(len(v) - n + 1) if n else ():
            for p in range(len(w) - n + 1):
                if w[p:p + n] == v[i:i + n]:
                    hit |= set(range(p, p + n))
                    if item is not None:
                        found.add(str(item))
    return len(w), len(hit), sorted(found)


def compare(spark, docs, items):
    bench = spark.createDataFrame(items, "item_id long, text string")
    for limit in (32 << 20, 0):  # broadcast and shuffled joins
        rows = decontaminate.contamination(docs, bench, broadcast_bytes=limit).collect()
        got = sorted(str((r["doc_id"], r["n_words"], r["n_hit"], r["items"], r["n_items"], r["contaminated"])) for r in rows)
        want = []
        for r in docs.collect():
            n, hit, found = by_hand(r["text"], items)
            want.append(str((r["doc_id"], n, hit, found, len(found), hit > 0)))
        assert got == sorted(want)
    return bench


def test_random_texts_equal_brute_force(spark):
    rng = random.Random(11)
    vocabulary = ["a", "B", "c9", "Äé", "中", "dd"]
    passages = [[rng.choice(vocabulary) for _ in range(rng.randrange(8, 25))] for _ in range(6)]
    items = [(i, " ".join(p)) for i, p in enumerate(passages)] + [(6, "a B"), (6, "c9"), (7, "!!"), (8, None), (None, "dd dd dd"), (9, " ".join(passages[0]))]
    docs = []
    for i in range(60):
        text = [rng.choice(vocabulary) for _ in range(rng.randrange(30))]
        p = rng.choice(passages)
        cut = rng.randrange(len(p))
        docs.append((i, rng.choice([", ", " ", "\n"]).join(text + p[cut:] + p[:cut] + text[:3]), None, None, 0))
    compare(spark, spark.createDataFrame(docs, DOC_SCHEMA), items)


def test_every_span_of_ten_words_is_found(spark):
    """The winnowing guarantee, at every offset."""
    item = " ".join(f"q{i}" for i in range(40))
    docs = [(i, " ".join(["x"] * 7 + [f"q{j}" for j in range(i, i + 10)] + ["y"] * 7), None, None, 0) for i in range(31)]
    docs += [(100 + i, " ".join(["x"] * 7 + [f"q{j}" for j in range(i, i + 9)] + ["y"] * 7), None, None, 0) for i in range(31)]
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    rows = {r["doc_id"]: r["n_hit"] for r in decontaminate.contamination(spark.createDataFrame(docs, DOC_SCHEMA), bench).collect()}
    assert all(rows[i] == 10 for i in range(31))
    assert all(rows[100 + i] == 0 for i in range(31))


def test_awkward_documents(spark, awkward, empty):
    bench = compare(spark, awkward.select("doc_id", "text"), [(1, BASE), (2, "one"), (3, " ".join(LONG.split()[500:520]))])
    kept = decontaminate.remove_contaminated(awkward, bench)
    assert kept.columns == awkward.columns
    assert sorted(str(r["text"]) for r in kept.collect()) == sorted(
        str(a[1]) for a in AWKWARD if not by_hand(a[1], [(1, BASE), (2, "one"), (3, " ".join(LONG.split()[500:520]))])[1])
    assert decontaminate.contamination(empty, bench).count() == 0
    assert decontaminate.contamination(awkward, bench.limit(0)).where("contaminated").count() == 0
    assert decontaminate.remove_contaminated(awkward, bench.limit(0)).count() == len(AWKWARD)


def test_no_python_runs_on_the_executors(spark, awkward):
    bench = spark.createDataFrame([(1, BASE)], "item_id long, text string")
    plan = decontaminate.contamination(awkward, bench)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
    assert "Cartesian" not in plan and "NestedLoop" not in plan
