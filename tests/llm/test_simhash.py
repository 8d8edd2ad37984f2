import random

import numpy as np
import pytest
import xxhash

from tracelake.llm import simhash
from tracelake.llm.common import LOWER, components
from tests.llm.conftest import AWKWARD, BASE, DOC_SCHEMA


def print_by_hand(text):
    words = (text or "").encode().translate(LOWER).split()
    runs = [b" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(r, 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) if hashes else 0


def groups_by_hand(rows, radius=2):
    ids = [r[0] for r in rows]
    prints = [print_by_hand(r[1]) for r in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if bin(prints[i] ^ prints[j]).count("1") <= radius:
                root[find(i)] = find(j)
    smallest = {}
    for i, d in enumerate(ids):
        if d is not None:
            smallest[find(i)] = min(d, smallest.get(find(i), d))
    return sorted((str(d), f"{prints[i]:016x}", str(smallest.get(find(i)))) for i, d in enumerate(ids))


def as_rows(df):
    return sorted((str(r["doc_id"]), r["fingerprint"], str(r["component_id"])) for r in df.collect())


def test_fingerprints_equal_a_bitwise_version():
    rng = random.Random(2)
    texts = [" ".join(rng.choice("abcdefgh") for _ in range(n)) for n in (0, 1, 2, 3, 4, 50, 254, 257, 258, 600, 1200)] + ["ÄB c  D\t\nE"]
    assert simhash.fingerprints([t.encode() for t in texts]).tolist() == [print_by_hand(t) for t in texts]


@pytest.mark.parametrize("radius", [0, 1, 2, 3])
def test_bit_sliced_blocks_find_every_link(radius):
    rng = np.random.default_rng(radius)
    seeds = rng.integers(0, 1 << 63, 20, dtype=np.uint64)
    fps = np.unique(np.concatenate([seeds, [s ^ np.uint64(sum(1 << int(b) for b in rng.choice(64, k, replace=False)))
                                            for s in seeds for k in (1, 2, 3, 4, 5) for _ in range(3)]]).astype(np.uint64))
    root = simhash.links_in_block(fps, radius, run=17)
    near = np.array([[bin(int(a ^ b)).count("1") <= radius for b in fps] for a in fps])
    reach = near.copy()
    for _ in range(8):
        reach = reach @ reach
    assert all(root[i] == np.flatnonzero(reach[i])[0] for i in range(len(fps)))


@pytest.mark.parametrize("block", [512, 4])
def test_links_over_tables_and_split_keys(spark, block):
    """Small blocks: keys held by more fingerprints than a block are cut into parts."""
    rng = random.Random(7)
    center = rng.getrandbits(64)
    fps = {center} | {center ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) for _ in range(60)} | {rng.getrandbits(64) for _ in range(40)}
    signed = [(f - (1 << 64) if f >> 63 else f,) for f in fps]
    df = spark.createDataFrame(signed, "fp long")
    got = {r["node"]: r["root"] for r in components(simhash.fingerprint_links(df, 2, block=block)).collect()}
    values = [s[0] for s in signed]
    root = {v: v for v in values}

    def find(v):
        while root[v] != v:
            v = root[v]
        return v

    for a in values:
        for b in values:
            if bin((a ^ b) & ((1 << 64) - 1)).count("1") <= 2:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    assert all(got.get(v, v) == find(v) for v in values)


def test_chains_of_components(spark):
    n = 40
    links = spark.createDataFrame([(i, i + 1) for i in range(n)] + [(100, 101), (101, 102), (7, 7)], "a long, b long")
    got = {r["node"]: r["root"] for r in components(links).collect()}
    assert got == {i: 0 for i in range(1, n + 1)} | {101: 100, 102: 100}


def test_awkward_documents(awkward, empty):
    assert as_rows(simhash.near_duplicates(awkward)) == groups_by_hand(AWKWARD)
    kept = simhash.keep_first(awkward)
    assert kept.columns == awkward.columns
    groups = {}
    for d, f, c in groups_by_hand(AWKWARD):
        groups.setdefault(c if c != "None" else ("none", f), d)
    assert kept.count() == len(groups)
    assert simhash.near_duplicates(empty).count() == 0
    assert simhash.keep_first(empty).count() == 0


def test_copies_and_near_copies(spark):
    rng = random.Random(9)
    rows, words = [], [f"{a}{b}" for a in "abcdefghij" for b in "klmnopqrst"]
    for i in range(40):
        base = [rng.choice(words) for _ in range(400)]
        rows.append((i, " ".join(base), None, None, 0))
        rows.append((100 + i, " ".join(base).upper(), None, None, 0))
        base[rng.randrange(400)] = "changed"
        rows.append((200 + i, " ".join(base), None, None, 0))
    rows += [(300, BASE, None, None, 0)] * 3
    got = as_rows(simhash.near_duplicates(spark.createDataFrame(rows, DOC_SCHEMA)))
    assert got == groups_by_hand(rows)


def test_one_id_in_several_groups_stays_in_each(spark):
    other = " ".join(f"word{i} stands{i % 7} here{i % 11}" for i in range(60))
    rows = [(1, BASE, "en", "a", 1), (1, other, "en", "a", 1), (2, other, "en", "a", 1), (3, BASE, "en", "a", 1)]
    kept = simhash.keep_first(spark.createDataFrame(rows, DOC_SCHEMA)).select("doc_id", "text").collect()
    assert sorted(map(tuple, kept)) == sorted([(1, BASE), (1, other)])


def test_a_star_is_split_in_the_joins(spark):
    """One fingerprint linked to very many others: its join partition is split, and the components are right."""
    import contextlib
    import io

    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8k", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k, None) for k in conf}
    plans, checkpoint = [], type(spark.range(0)).checkpoint

    def seen(df, *args, **kwargs):
        out = checkpoint(df, *args, **kwargs)
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            df.explain()
        plans.append(buf.getvalue())
        return out

    links = spark.range(1, 60_000).selectExpr("0L a", "id b").repartition(8)
    for k, v in conf.items():
        spark.conf.set(k, v)
    type(links).checkpoint = seen
    try:
        got = components(links)
        n, roots = got.count(), [r[0] for r in got.select("root").distinct().collect()]
    finally:
        type(links).checkpoint = checkpoint
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert (n, roots) == (59_999, [0])
    assert any("skew=true" in p for p in plans)
