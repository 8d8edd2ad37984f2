import math
import random
from collections import Counter
from itertools import islice

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tracelake.llm import lmscore
from tests.llm.conftest import AWKWARD, DOC_SCHEMA


def tokens(text):
    return (text or "").encode().translate(bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))).split() + [b""]


def tree_by_hand(train):
    """The same tree with dictionaries of words: a probability of a token after what precedes it."""
    c = Counter(t for d in train for t in d)
    n, v = sum(c.values()), len(c)
    context = max(lmscore.CONTEXT_COUNT, math.ceil(lmscore.CONTEXT_SHARE * n))
    follow = max(lmscore.NEXT_COUNT, math.ceil(lmscore.NEXT_SHARE * n))
    least = max(lmscore.PAIR_COUNT, math.ceil(lmscore.PAIR_SHARE * n))
    one, two = Counter(), Counter()
    for d in train:
        past = [b""] + d
        for i, t in enumerate(d):
            if c[t] >= follow and c[past[i]] >= context:
                one[(past[i],), t] += 1
                if i and c[past[i - 1] if i > 1 else b""] >= context:
                    two[(past[i - 1] if i > 1 else b"", past[i]), t] += 1
    one = {k: x for k, x in one.items() if x >= least}
    two = {k: x for k, x in two.items() if x >= least}

    def root(t):
        return (c[t] + 0.1) / (n + 0.1 * (v + 1))

    states = {}

    def p(ctx, t):
        while ctx and ctx not in states:
            ctx = ctx[1:]
        if not ctx:
            return root(t)
        own, weight = states[ctx]
        return own.get(t, 0) + weight * p(ctx[1:], t)

    for pairs in (one, two):
        grown = {}
        for ctx in {k[0] for k in pairs}:
            total = c[ctx[0]] if len(ctx) == 1 else one.get(((ctx[0],), ctx[1]), 0)
            nxt = {t: x for (k, t), x in pairs.items() if k == ctx}
            if total < context or total < sum(nxt.values()):
                continue
            lower = {t: p(ctx[1:], t) for t in nxt}
            gain = sum(x * math.log(x / total / lower[t]) for t, x in nxt.items())
            rest = total - sum(nxt.values())
            if rest > 0:
                gain += rest * math.log(rest / total / (1 - min(1 - 1e-9, sum(lower.values()))))
            if gain > 0.5 * (len(nxt) + 1) * math.log(max(2, total)):
                own = {t: (x - lmscore.DISCOUNT) / total for t, x in nxt.items()}
                grown[ctx] = own, 1 - sum(own.values())
        states.update(grown)
    return c, n, v, root, p, states


def corpus(seed=1, docs=160):
    rng = random.Random(seed)
    out = []
    for i in range(docs):
        text, w = [], "Start"
        for _ in range(rng.randrange(0, 90)):
            w = rng.choice({"a": ["b", "b", "b", "c"], "b": ["a", "d", "a"], "d": ["E", "a"]}.get(w, ["a", "b", "d", f"rare{rng.randrange(400)}"]))
            text.append(w)
        out.append((i, " ".join(text), None, None, 0))
    return out


def compare(spark, rows, learn):
    df = spark.createDataFrame(rows, DOC_SCHEMA)
    flag = F.col("doc_id").isNotNull() & (F.col("doc_id") % 5 != 0) if learn else F.lit(False)
    got = lmscore.score(df, F.coalesce(flag, F.lit(False))).collect()
    taught = [learn and r[0] is not None and r[0] % 5 != 0 for r in rows]
    c, n, v, root, p, states = tree_by_hand([tokens(r[1]) for r, t in zip(rows, taught) if t])
    want = []
    for r, t in zip(rows, taught):
        d = tokens(r[1])
        past = [b""] + d
        score = base = 0.0
        for i, x in enumerate(d):
            ctx = ((past[i - 1] if i > 1 else b""), past[i]) if i else (past[i],)
            score += math.log10(p(ctx, x))
            base += math.log10(root(x))
        want.append((str(r[0]), not t, len(d), sum(c[x] > 0 for x in d), n, round(base, 6), round(score, 6)))
    have = [(str(r["doc_id"]), r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6),
             round(r["score"], 6)) for r in got]
    for a, b in zip(sorted(have), sorted(want)):
        assert a[:5] == b[:5]
        assert a[5:] == pytest.approx(b[5:], abs=1e-5)
    return states


def test_scores_equal_a_dictionary_version(spark):
    states = compare(spark, corpus(), True)
    assert {len(s) for s in states} == {1, 2}  # contexts of both lengths passed the test


def test_distributions_sum_to_one():
    c, n, v, root, p, states = tree_by_hand([tokens(r[1]) for r in corpus(2)])
    for ctx in list(states)[:20] + [()]:
        assert sum(p(ctx, t) for t in c) + p(ctx, b"never seen") == pytest.approx(1, abs=1e-9)


def test_awkward_documents(spark, awkward, empty):
    rows = [a for a in AWKWARD]
    compare(spark, rows, True)
    compare(spark, rows, False)
    assert lmscore.score(empty, F.lit(True)).count() == 0
    assert lmscore.score(awkward, lmscore.learned()).count() == len(AWKWARD)


def test_held_out_text_gains_from_context(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    r = (lmscore.score(docs, lmscore.learned()).where("held_out")
         .agg(F.sum("score").alias("s"), F.sum("base_score").alias("b"), F.count("*").alias("n")).first())
    assert r["n"] > 5 and r["s"] > r["b"]


def test_chunks_are_cut_by_size(spark, monkeypatch):
    words, texts = lmscore.Numbering(), [b"a b a", b"", b"B c"]
    flat, sizes = lmscore.number_words(texts, words, tail=99)
    assert sizes.tolist() == [4, 1, 3] and flat.tolist() == [0, 1, 0, 99, 99, 2, 3, 99]
    assert np.array_equal(lmscore.sums(flat, sizes), [100, 99, 104])


def test_the_tree_grows_with_the_corpus(spark):
    n = []
    for sf in ("sf0.01", "sf0.1"):
        docs = spark.read.parquet(f"/root/testdata/{sf}/documents.parquet")
        _, _, states = lmscore.train(lmscore.encode(docs, lmscore.learned(), ~lmscore.learned()))
        n.append([s.count() for s in states])
    print(n)
    assert n[1][0] > 2 * n[0][0] and n[1][1] > n[0][1]


def test_longer_contexts_are_a_parameter(spark):
    rng = random.Random(5)
    texts = [" ".join(f"x{k} a b y{k}" for k in (rng.randrange(3) for _ in range(20))) for _ in range(40)]
    df = spark.createDataFrame([(i, t, None, None, 0) for i, t in enumerate(texts)], DOC_SCHEMA)
    total = [lmscore.score(df, F.lit(True), depth=d).agg(F.sum("score")).first()[0] for d in (2, 3)]
    # Two words leave one of three next words open: log10(3) for each of the 800 passages.
    assert total[1] - total[0] > 300


def test_words_rare_behind_the_suffix_are_not_counted_behind_longer_contexts(spark):
    """Every w is frequent, but comes behind b twice at most, so behind "a b" too: neither is it sent there, nor does the answer name it."""
    rng = random.Random(6)
    texts = [f"a b w{i // 2} z w{i // 2} z w{i // 2} a b e" for i in range(60)] + [f"a b {rng.choice('ef')}" for _ in range(60)]
    rows = [(i, t, None, None, 0) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, DOC_SCHEMA)
    encoded, model, _ = lmscore.train(lmscore.encode(df, F.lit(True), F.lit(False)))
    sent = answers = states = 0
    for row in lmscore._rows(encoded.toArrow().to_batches()):
        n, rest, size = lmscore._answers(row["parts_2"], 3)
        order, _ = list(islice(lmscore._orders(row, model, 2), 2))[1]
        sent, answers, states = sent + len(order.next), answers + (n > 0).sum(), states + (size > 0).sum()
        assert (row["c"][order.next] > 20).all()  # a, b, e, f, z and the end; the w occur six times each
    assert sent and answers >= states
    compare(spark, [(r[0], r[1], None, None, 0) for r in rows], True)


def test_counts_behind_contexts_that_are_no_state_say_only_what_is_needed():
    model = lmscore.Model(tokens=100_000, types=50, parts=1)
    words, counts = np.array([2, 3, 4]), np.array([30, 12, 2])
    # The same next words behind context 7, and as likely as without it: no state.
    block = (5, 0, lmscore.narrow(lmscore.near(np.array([7]))), lmscore.narrow(lmscore.near(np.array([100]))), lmscore.narrow(np.array([3])),
             lmscore.narrow(lmscore.climbs(words, np.array([3]))), lmscore.narrow(counts),
             lmscore.narrow(lmscore.near(lmscore.level(np.array([30_000, 12_000, 2_000])))))
    names = ["chunk", "part", "contexts", "totals", "sizes", "next", "n", "lower"]
    for last, want in ((False, [30, lmscore.PAIR_COUNT, 0]), (True, [0, 0, 0])):
        batch = pa.RecordBatch.from_pylist([dict(zip(names, block))])
        out = [r for b in lmscore._counted(iter([batch]), model, 1, last) for r in b.to_pylist()]
        assert [r["context"] for r in out] == [None]
        assert [x.tolist() for x in lmscore._answers(out, 3)] == [want, [0], [0]]


def test_small_chunks_give_the_same_scores(spark):
    """Many chunks, many blocks of a part, and a text longer than a chunk."""
    rows = corpus(3) + [(1000, "a b " * 2000, None, None, 0), (1001, "a b " * 2000, None, None, 0)]
    df = spark.createDataFrame(rows, DOC_SCHEMA).repartition(3)
    want = sorted(map(tuple, lmscore.score(df, F.lit(True)).collect()), key=str)
    encoded = lmscore.encode(df, F.lit(True), F.lit(False), chunk_bytes=400)
    assert encoded.count() > 30
    got = sorted(map(tuple, lmscore.score(df, F.lit(True), chunk_bytes=400).collect()), key=str)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    assert [x for g in got for x in g[5:]] == pytest.approx([x for w in want for x in w[5:]], abs=1e-6)


def test_tables_are_dropped_on_demand(spark, tmp_path):
    import os

    df = spark.createDataFrame(corpus(4, 10), DOC_SCHEMA)
    assert lmscore.score(df, F.lit(True)).count() == 10
    folder = lmscore.shared_dir(spark).removeprefix("file://")
    dropped = lmscore.drop_tables(spark)
    assert len(dropped) >= 4 and not [x for x in os.listdir(folder) if x.startswith(lmscore.TABLES) and x in dropped]
    assert lmscore.drop_tables(spark) == []


def test_narrow_integers():
    for values in ([], [0], [255, 0, 3], [256, 1], [2**40, 7], [2**62]):
        assert lmscore.widen(lmscore.narrow(np.array(values, np.int64))).tolist() == values


def test_steps_between_numbers():
    for values in ([], [5], [3, 3, 900, 2, 7], [2**40, 0, 2**40]):
        steps = lmscore.near(np.array(values, np.int64))
        assert (steps >= 0).all()
        assert lmscore.from_near(lmscore.widen(lmscore.narrow(steps))).tolist() == values
    hashes = np.sort(np.array([1, 2**63 + 5, 2**64 - 1, 2**63], np.uint64))
    packed = lmscore.narrow(np.diff(hashes, prepend=np.uint64(0)))
    assert np.cumsum(lmscore.widen(packed).view(np.uint64)).tolist() == hashes.tolist()
    assert (np.diff(lmscore._part_of(hashes, 844)) >= 0).all() and lmscore._part_of(hashes, 844).max() < 844


def test_context_hashes_follow_the_order_of_words():
    a, b, c = (np.array([x], np.uint64) for x in (7, 11, 13))
    assert lmscore.context_hash(np.stack([c]))[0] == lmscore.one_word(c)[0]
    assert lmscore.context_hash(np.stack([a, b, c]))[0] == lmscore.longer(a, lmscore.longer(b, lmscore.one_word(c)))[0]


def test_blocks_give_back_what_was_sent():
    values, sizes = np.array([4, 9, 9, 1, 2, 300]), np.array([0, 3, 0, 2, 1, 0])
    assert lmscore.climbs(values, sizes).tolist() == [4, 5, 0, 1, 1, 300]
    assert lmscore.from_climbs(lmscore.climbs(values, sizes), sizes).tolist() == values.tolist()
    nothing = np.empty(0, np.int64)
    assert lmscore.from_climbs(lmscore.climbs(nothing, nothing), nothing).tolist() == []
    by = np.array([7, 2, 2, 5])
    sent = np.array([10, 20, 30, 40])[np.argsort(by, kind="stable")]
    assert lmscore.in_order(sent, by).tolist() == [10, 20, 30, 40]


def test_counts_as_levels():
    counts = np.r_[np.arange(3000), 10**6, 10**12]
    levels = lmscore.level(counts)
    assert (np.diff(levels) >= 0).all()
    small = counts <= lmscore.EXACT
    assert np.array_equal(lmscore.count_of(levels)[small], counts[small])
    assert lmscore.count_of(levels)[~small] == pytest.approx(counts[~small], rel=1 / lmscore.LOG_STEPS)


def test_many_integers_are_a_byte_where_they_are_small():
    rng = np.random.default_rng(1)
    values = np.r_[(rng.pareto(0.7, 20_000) * 20).astype(np.int64) % 2**32, 0, 127, 128, 255, 256, 2**15 + 127, 2**15 + 128, 2**32 - 1]
    packed = lmscore.narrow(values)
    assert lmscore.widen(packed).tolist() == values.tolist()
    planes = values.astype("<i8").view(np.uint8).reshape(-1, 8)[:, :4].T.tobytes()
    assert len(packed) < 0.95 * len(lmscore._PRESS.compress(planes))


def test_counts_and_numbers_of_words_come_back():
    """Two chunks, three parts: counts descend with the rank, too rare words share one, and all other numbers differ."""
    rng, parts = np.random.default_rng(2), 3
    hashes = [np.sort(rng.integers(0, 2**64 - 1, 400, np.uint64)) for _ in range(2)]
    hashes[1][::2] = hashes[0][::2]
    hashes[1].sort()
    learned = [(rng.pareto(0.6, 400) * 2).astype(np.int64) for _ in hashes]
    asked = [pa.RecordBatch.from_pylist([{"chunk": i, "hashes": lmscore.narrow(np.diff(h, prepend=np.uint64(0))), "learned": lmscore.narrow(n)}])
             for i, (h, n) in enumerate(zip(hashes, learned))]
    rows = sorted((r for b in lmscore._vocabulary(iter(asked), parts) for r in b.to_pylist()), key=lambda r: r["part"])
    out = [r for b in lmscore._word_counts(iter([pa.RecordBatch.from_pylist(rows)]), parts) for r in b.to_pylist()]
    total = Counter()
    for h, n in zip(hashes, learned):
        total.update(dict(zip(h.tolist(), n.tolist())))
    assert sum(r["types"] for r in out if r["chunk"] is None) == sum(n > 0 for n in total.values())
    number = {}
    for i, h in enumerate(hashes):
        c, numbers = lmscore._numbered([r for r in out if r["chunk"] == i], parts)
        assert c.tolist() == [total[x] for x in h.tolist()]
        for x, n in zip(h.tolist(), numbers.tolist()):
            assert number.setdefault(x, n) == n
    often = [n for x, n in number.items() if total[x] >= lmscore.NEXT_COUNT]
    assert len(set(often)) == len(often) > 100
    assert len({n for x, n in number.items() if total[x] < lmscore.NEXT_COUNT} - set(often)) == parts


@pytest.mark.parametrize("known", [0, 2, 3, 5])
def test_blocks_do_not_say_the_counts_of_frequent_words(known):
    """Words 0 to 4, the first ``known`` of them frequent: what is sent is the others' counts, what comes of it is the same."""
    counts = np.array([900, 500, 300, 200, 100])
    row = {"chunk": 5, "held_out": [False], "sizes": [400], "end": 0, "doc_ids": [1], "parts": 1,
           "learned": lmscore.narrow(np.array([80, 80, 80, 80, 80])), "tokens": lmscore.narrow(np.tile([1, 2, 1, 3, 4, 0, 0, 4], 50)),
           "parts_0": [{"part": 0, "data": lmscore._answer(lmscore.near(counts), np.arange(5))}]}
    model = lmscore.Model(tokens=2000, types=5, parts=1, frequent=lmscore.level(counts[:known]).astype(np.int32))
    whole = lmscore.Model(tokens=2000, types=5, parts=1)
    asked = [pa.RecordBatch.from_pylist([r for b in lmscore._ask(iter([pa.RecordBatch.from_pylist([row])]), m, 1) for r in b.to_pylist()])
             for m in (model, whole)]
    sent, all_ = (lmscore.from_near(lmscore.widen(b.column("lower")[0].as_py())) for b in asked)
    assert len(all_) == 9 and sent.tolist() == [x for x in all_.tolist() if x not in counts[:known]]
    got, want = ([b.to_pylist() for b in lmscore._counted(iter([a]), m, 1, True)] for a, m in zip(asked, (model, whole)))
    assert got == want


def test_hashes_of_words_go_once_they_are_counted(spark):
    import os

    df = spark.createDataFrame(corpus(5, 10), DOC_SCHEMA)
    folder = lmscore.shared_dir(spark).removeprefix("file://")
    before = set(os.listdir(folder))
    assert lmscore.encode(df, F.lit(True), F.lit(False)).count() >= 1
    new = [x for x in set(os.listdir(folder)) - before if x.startswith(lmscore.TABLES)]
    kinds = [k for x in new for k in os.listdir(f"{folder}/{x}") if k.startswith("kind=")]
    assert kinds == ["kind=tokens"]
    assert not [x for x in new if x.startswith(f"{lmscore.TABLES}chunks")]  # no second copy
