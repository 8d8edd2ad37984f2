import zlib
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import AWKWARD, DOC_SCHEMA
from tracelake.llm import merkle

LOWERED = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def h(*texts):
    return sha256("".join(texts).encode()).hexdigest()


def leaf_by_hand(row):
    doc_id, text, lang, source, n_chars = row[:5]
    values = [doc_id, source, lang, n_chars, text]
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def levels_by_hand(nodes):
    out = [nodes]
    while len(nodes) > 1:
        nodes = [h(*nodes[i:i + 8]) for i in range(0, len(nodes), 8)]
        out.append(nodes)
    return out


def way_up(levels, place, node):
    """Siblings of a node, and the top when it is replaced."""
    proof = []
    for nodes in levels[:-1]:
        a = place // 8 * 8
        run = nodes[a:a + 8]
        proof += [x for i, x in enumerate(run) if a + i != place]
        run[place - a] = node
        node, place = h(*run), place // 8
    return proof, node


def by_hand(rows):
    groups = {}
    for row in rows:
        groups.setdefault(row[2], []).append(row)
    for members in groups.values():
        members.sort(key=lambda r: (r[0] is None, r[0] or 0, leaf_by_hand(r)))
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: levels_by_hand(list(map(leaf_by_hand, groups[g]))) for g in order}
    over = levels_by_hand([trees[g][-1][0] for g in order])
    root, out = over[-1][0] if order else None, []
    for i, g in enumerate(order):
        for place, row in enumerate(groups[g]):
            leaf = new = leaf_by_hand(row)
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 3 == 0 and row[1] is not None:
                new = leaf_by_hand((row[0], row[1].translate(LOWERED), *row[2:]))
            low, node = way_up(trees[g], place, new)
            high, top = way_up(over, i, node)
            out.append((str(row[0]), place, leaf, trees[g][-1][0], root, low + high, top))
    return sorted(out)


def run(df):
    leaves = merkle.leaves(df, merkle.tampered_third(), {"text": merkle.lowered(F.col("text"))})
    return merkle.manifest(leaves)


def as_rows(df):
    return sorted((str(r["doc_id"]), r["pos"], r["leaf"], r["subroot"], r["root"], r["proof"], r["folded_root"]) for r in df.collect())


def test_awkward_and_empty_tables(spark, awkward, empty):
    clashing = awkward
    for name in ("g", "id", "leaf", "pos", "n", "node", "block", "kind", "path", "tampered", "_r", "_tie", "all"):
        clashing = clashing.withColumn(name, F.lit("x"))
    assert as_rows(run(clashing)) == by_hand(AWKWARD)
    assert run(empty).count() == 0


@pytest.mark.parametrize("n", [1, 2, 8, 9, 64, 65, 512, 513])
def test_group_sizes_around_the_levels(spark, n):
    rows = [(i, f"Text {i}", "en", "a", i) for i in range(n)] + [(n + 7, "Other", "de", None, 1)]
    assert as_rows(run(spark.createDataFrame(rows, DOC_SCHEMA))) == by_hand(rows)


def test_a_hot_group_over_many_blocks_and_many_groups(spark):
    rows = [(i, f"Text {i % 50}", None if i % 3 == 0 else "en" if i % 3 == 1 else f"l{i % 23}", "a", i) for i in range(13_000)]
    assert as_rows(run(spark.createDataFrame(rows, DOC_SCHEMA).repartition(7))) == by_hand(rows)


def test_repeated_rows_are_leaves_each(spark):
    rows = [(5, "Same", "en", "a", 4)] * 700 + [(6, "Other", "en", "a", 5)]
    assert as_rows(run(spark.createDataFrame(rows, DOC_SCHEMA))) == by_hand(rows)


def test_a_version_copies_only_the_ancestors(spark):
    rows = [(i, f"Text {i}", "en", "a", i) for i in range(600)] + [(i, "x", "de", "a", i) for i in range(600, 610)]
    got = run(spark.createDataFrame(rows, DOC_SCHEMA)).collect()
    height = merkle.height(600) + merkle.height(2)
    for r in got:
        changed = zlib.crc32(str(r["doc_id"]).encode()) % 3 == 0
        assert (r["tampered"] is not None) == changed == (r["version"] is not None)
        if changed:
            low = r["subroot"] != next(x["subroot"] for x in got if x["doc_id"] == 0)
            assert len(r["version"]) == (merkle.height(10) + merkle.height(2) if low else height)
            assert r["version"][-1] == r["folded_root"]
            # Lower-case texts do not change, the others do.
            assert (r["folded_root"] == r["root"]) == (r["doc_id"] >= 600)


def test_the_work_of_a_large_group_is_spread(spark):
    """No task holds a group: blocks of one group go to several partitions."""
    rows = spark.range(20_000).select(F.lit("s").alias("g"), "id", F.sha2(F.col("id").cast("string").cast("binary"), 256).alias("leaf"))
    nodes = merkle.numbered(rows, "g", ["id"])
    assert [r[0] for r in nodes.orderBy("id").select("pos").collect()] == list(range(20_000))
    dealt = merkle._dealt(nodes.select("g", "pos", "n", F.col("leaf").alias("node")))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sizes = [r[0] for r in dealt.groupBy(F.spark_partition_id()).count().select("count").collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert max(sizes) < 0.4 * 20_000
