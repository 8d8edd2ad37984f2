"""Operator 11: a Merkle manifest of a dataset, with persistent versions of tampered leaves.

Every row is a leaf: the hash of its fields, each with its length. Leaves are
ordered within their group; every 8 consecutive nodes become their hash, level
by level, until one is left (a last run may be shorter, even a single node): the
group's subroot. The subroots, in order of their group, are joined likewise to
the root. Hashes are lowercase hex SHA-256 of the concatenated inputs.

The tree is persistent. A tampered leaf does not change it but makes a version:
only the leaf's ancestors are copied, all other nodes are shared with the
original, so a version is a list of new nodes, one a level. Nodes are dealt to
tasks in aligned blocks of 512 (three levels), however large their group is: a
block holds whole subtrees, so a version's path stays in it. The tops of the
blocks are the nodes of the next three levels, dealt likewise, up to the root;
then every block passes its nodes' siblings down to the blocks below, where each
version continues with them, so no task sees all versions of a group.

What a task holds is bounded by a block; a group that holds most rows is spread
over its blocks, and numbering it goes by ranges. The driver holds the number of
nodes of the largest group, from which it counts levels.

Defined results: a null field is ``-``; null and empty texts differ; a null group
is a group of its own, before all others; rows without an id come last in their
group and are never tampered with; rows of one id are ordered by their hash, and
equal rows are leaves each; texts of any length are hashed whole; an empty table
gives no rows; other columns of the input are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from functools import partial

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tracelake.llm.common import crc32_of_id, cut, ship

#: Nodes that become one, and levels of a block.
ARITY, LEVELS = 8, 3
BLOCK = ARITY**LEVELS
#: Fields of a leaf, in order.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: A node's siblings on one level: those before it and those behind it, joined.
PATH = "array<struct<before: string, behind: string>>"
OUT = ("doc_id long, pos long, leaf string, subroot string, root string, proof array<string>, tampered string, "
       "version array<string>, folded_root string")


def digest(texts: Sequence[str]) -> str:
    return hashlib.sha256("".join(texts).encode()).hexdigest()


def field(value: Column) -> Column:
    """A leaf's field: byte count and value, or ``-``."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_hash(fields: Sequence[Column]) -> Column:
    return F.sha2(F.concat(*map(field, fields)).cast("binary"), 256)


def lowered(text: Column) -> Column:
    """The registered tampering: A-Z to lower case."""
    return F.translate(text, UPPER, LOWER)


def tampered_third(doc_id: str = "doc_id") -> Column:
    """Rows that the registered query tampers with: 3 divides the crc32 of the id."""
    return F.coalesce(F.pmod(crc32_of_id(doc_id), F.lit(3)) == 0, F.lit(False))


def leaves(docs: DataFrame, tamper: Column, change: dict[str, Column], fields: Sequence[str] = FIELDS,
           group: str = "lang", doc_id: str = "doc_id") -> DataFrame:
    """(g, id, leaf, tampered): the hash of every row, and of its changed fields where ``tamper`` holds."""
    changed = leaf_hash([change.get(name, F.col(name)) for name in fields])
    return docs.select(group_key(F.col(group)).alias("g"), F.col(doc_id).cast("long").alias("id"),
                       leaf_hash([F.col(name) for name in fields]).alias("leaf"),
                       F.when(tamper, changed).alias("tampered"))


def group_key(group: Column) -> Column:
    """A text for every group, null included, in the order of the groups."""
    return F.coalesce(F.concat(F.lit("s"), group.cast("string")), F.lit("n"))


def numbered(rows: DataFrame, group: str, order: list[str]) -> DataFrame:
    """Adds pos (from 0, within the group, in ``order``) and n (rows of the group).

    Rows are dealt by range, so a large group is numbered by many tasks.
    """
    by = [F.col(c).asc_nulls_last() for c in (group, *order)]
    ranged = cut(rows.repartitionByRange(*by).withColumn("_r", F.spark_partition_id()))
    within = Window.partitionBy("_r", group).orderBy(*by)
    # One row per range and group.
    totals = ranged.groupBy("_r", group).agg(F.count("*").alias("_rows"))
    before = Window.partitionBy(group).orderBy("_r").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select(F.col("_r").alias("_tr"), F.col(group).alias("_tg"),
                           F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"),
                           F.sum("_rows").over(Window.partitionBy(group)).alias("n"))
    return (ranged.withColumn("_here", F.row_number().over(within))
            .join(totals, (F.col("_r") == F.col("_tr")) & (F.col(group) == F.col("_tg")))
            .withColumn("pos", F.col("_before") + F.col("_here") - 1)
            .drop("_r", "_tr", "_tg", "_here", "_before"))


def height(n: int) -> int:
    """Levels above ``n`` nodes until one is left."""
    levels = 0
    while n > 1:
        n, levels = -(-n // ARITY), levels + 1
    return levels


def climb(nodes: list[str], levels: int) -> list[list[str]]:
    """The nodes of a block and of the levels above them."""
    out = [nodes]
    for _ in range(levels):
        nodes = [digest(nodes[i:i + ARITY]) for i in range(0, len(nodes), ARITY)]
        out.append(nodes)
    return out


def siblings(levels: list[list[str]], place: int) -> list[tuple[list[str], list[str]]]:
    """Siblings of node ``place``, before and behind it, on every level below the top."""
    out = []
    for nodes in levels[:-1]:
        a = place - place % ARITY
        out.append((nodes[a:place], nodes[place + 1:a + ARITY]))
        place //= ARITY
    return out


def copied(node: str, path: Sequence[tuple[str, str]]) -> list[str]:
    """The ancestors of a new node: a version's copies, the last one its top."""
    out = []
    for before, behind in path:
        node = digest((before, node, behind))
        out.append(node)
    return out


def _block_levels(n: int) -> int:
    """Levels that a block of a group of ``n`` nodes climbs."""
    return LEVELS if n > BLOCK else height(n)


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[list[dict]]:
    """Rows sorted by (g, block, kind, pos) as one list per block."""
    rows, key = [], None
    for batch in batches:
        for row in batch.to_pylist():
            if (row["g"], row["block"]) != key:
                if rows:
                    yield rows
                rows, key = [], (row["g"], row["block"])
            rows.append(row)
    if rows:
        yield rows


def _records(rows: Iterator[tuple], schema: pa.Schema, size: int = 4 * BLOCK) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), schema.types)], schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), schema.types)], schema=schema)


def _tops(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("g", pa.string()), ("pos", pa.int64()), ("n", pa.int64()), ("node", pa.string())])
    return _records(((b[0]["g"], b[0]["block"], -(-b[0]["n"] // BLOCK),
                      climb([r["node"] for r in b], _block_levels(b[0]["n"]))[-1][0]) for b in _runs(batches)), schema)


_STEP = pa.struct([("before", pa.string()), ("behind", pa.string())])


def _paths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every node's path to the root: its siblings in the block, then the block's own path (the row of kind 0)."""
    schema = pa.schema([("g", pa.string()), ("pos", pa.int64()), ("path", pa.list_(_STEP)), ("subroot", pa.string()), ("root", pa.string())])

    def rows() -> Iterator[tuple]:
        for above, *block in _runs(batches):
            levels = climb([r["node"] for r in block], _block_levels(block[0]["n"]))
            for i, r in enumerate(block):
                inner = [{"before": "".join(a), "behind": "".join(b)} for a, b in siblings(levels, i)]
                yield r["g"], r["pos"], inner + above["path"], above["subroot"], above["root"]

    return _records(rows(), schema)


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Proofs of a block's leaves, and the versions that its tampered leaves make."""
    schema = pa.schema([("doc_id", pa.int64()), ("pos", pa.int64()), ("leaf", pa.string()), ("subroot", pa.string()),
                        ("root", pa.string()), ("proof", pa.list_(pa.string())), ("tampered", pa.string()),
                        ("version", pa.list_(pa.string())), ("folded_root", pa.string())])
    hexes = 64

    def rows() -> Iterator[tuple]:
        for above, *block in _runs(batches):
            levels = climb([r["node"] for r in block], _block_levels(block[0]["n"]))
            upper = [(s["before"], s["behind"]) for s in above["path"]]
            outside = [text[i:i + hexes] for pair in upper for text in pair for i in range(0, len(text), hexes)]
            for i, r in enumerate(block):
                inner = siblings(levels, i)
                proof = [x for pair in inner for side in pair for x in side] + outside
                path = [("".join(a), "".join(b)) for a, b in inner] + upper
                new = r["node"] if r["tampered"] is None else r["tampered"]
                version = copied(new, path)
                yield (r["id"], r["pos"], r["node"], above["subroot"], above["root"], proof, r["tampered"],
                       None if r["tampered"] is None else version, version[-1] if version else new)

    return _records(rows(), schema)


def _dealt(nodes: DataFrame, paths: DataFrame | None = None) -> DataFrame:
    """Nodes by aligned block, in order; with ``paths``, each block behind the row that says what lies above it."""
    nodes = nodes.withColumn("block", F.floor(F.col("pos") / BLOCK).cast("long"))
    if paths is not None:
        above = paths.select("g", F.col("pos").alias("block"), F.lit(0).alias("kind"), "path", "subroot", "root")
        nodes = nodes.withColumn("kind", F.lit(1)).unionByName(above, allowMissingColumns=True)
    order = ["g", "block", *(["kind"] if paths is not None else []), "pos"]
    return nodes.repartition("g", "block").sortWithinPartitions(*order)


def stages(nodes: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """Tables of nodes (g, pos, n, node), each the tops of the blocks of the one before; and each group's top (g, node)."""
    out = []
    while True:
        out.append(nodes)
        tops = cut(_dealt(nodes.select("g", "pos", "n", "node")).mapInArrow(_tops, "g string, pos long, n long, node string"))
        if (tops.agg(F.max("n")).first()[0] or 1) <= 1:
            return out, tops.select("g", "node")
        nodes = tops


def descend(tables: list[DataFrame], paths: DataFrame) -> DataFrame:
    """Paths of the blocks of the lowest table, from those of the groups' tops (g, pos 0, path, subroot, root)."""
    for nodes in reversed(tables[1:]):
        paths = cut(_dealt(nodes, paths).mapInArrow(_paths, f"g string, pos long, path {PATH}, subroot string, root string"))
    return paths


def manifest(rows: DataFrame) -> DataFrame:
    """One row per leaf of ``leaves``: its place, subroot, root, proof (siblings level by level, left to right),
    tampered hash, version (the new nodes that the tampered leaf makes, up to the root) and folded root.
    """
    ship(rows.sparkSession)
    rows = cut(rows).withColumn("_tie", F.monotonically_increasing_id())
    nodes = numbered(rows, "g", ["id", "leaf", "_tie"]).select("g", "pos", "n", F.col("leaf").alias("node"), "id", "tampered")
    nodes = cut(nodes)
    tables, subroots = stages(nodes)
    # The groups' tops are the leaves of one more tree.
    over = numbered(subroots.withColumn("all", F.lit("")), "all", ["g"])
    over = cut(over.select(F.col("all").alias("g"), "pos", "n", "node", F.col("g").alias("group")))
    upper, root = stages(over.select("g", "pos", "n", "node"))
    path = descend(upper, root.select("g", F.lit(0).cast("long").alias("pos"), F.array().cast(PATH).alias("path"),
                                      F.lit(None).cast("string").alias("subroot"), F.col("node").alias("root")))
    path = _dealt(upper[0], path).mapInArrow(_paths, f"g string, pos long, path {PATH}, subroot string, root string")
    named = over.select(F.col("group").alias("g"), F.col("pos").alias("_p"), F.col("node").alias("_top"))
    path = (path.drop("g").join(named, F.col("pos") == F.col("_p"))
            .select("g", F.lit(0).cast("long").alias("pos"), "path", F.col("_top").alias("subroot"), "root"))
    return _dealt(nodes, descend(tables, cut(path))).mapInArrow(_verified, OUT)
