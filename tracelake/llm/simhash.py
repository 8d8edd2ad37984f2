"""Operator 6: near-duplicates by SimHash, compared bit-sliced.

A document's fingerprint has a bit set where over half of its shingle hashes
have it set; documents whose fingerprints differ in at most ``radius`` bits
are linked, and the links' connected components are the groups.

Only distinct fingerprints are compared, so a group of exact copies is one
fingerprint however many rows it has. Fingerprints within the radius agree on
``BLOCKS - radius`` of ``BLOCKS`` bit fields, so every choice of that many
fields gives a key, and fingerprints that share a key with another are
compared. Rows of equal key are laid side by side in blocks; a block stores
its bit planes vertically (plane b holds bit b of all its fingerprints) and
updates the distances of a run of fingerprints to the whole block with
carry-save counters, one plane at a time, leaving it as soon as every
distance has passed the radius. A key held by more than ``BLOCK`` fingerprints
is cut into parts, and every pair of parts becomes a block of its own.

Defined results: a null or empty text has no shingle and the fingerprint
zero, which links like any other; a text with fewer words than a shingle is
one shingle; repeated rows share a fingerprint; a null ``doc_id`` never
becomes a component's id unless the component has no other; an empty table
gives an empty result. Of the input only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracelake.llm.common import LOWER, as_bytes, components, cut, ship, slices, whole_rows

SEED = 42
BLOCKS = 5
BLOCK = 512
_BYTES = np.uint64(0x0101010101010101)


def shingle_hashes(text: bytes, shingle: int = 3) -> np.ndarray:
    """XXH64 of every run of ``shingle`` words, repeats included."""
    words = text.translate(LOWER).split()
    if not words:
        return np.empty(0, np.uint64)
    runs = map(b" ".join, zip(*(words[i:] for i in range(shingle)))) if len(words) >= shingle else [b" ".join(words)]
    n = max(1, len(words) - shingle + 1)
    return np.fromiter(map(partial(xxhash.xxh64_intdigest, seed=SEED), runs), np.uint64, n)


def fingerprints(texts: list[bytes], shingle: int = 3) -> np.ndarray:
    """One 64-bit fingerprint per text."""
    hashes = [shingle_hashes(t, shingle) for t in texts]
    sizes = np.array([len(h) for h in hashes], np.int64)
    out = np.zeros(len(texts), np.uint64)
    full = np.flatnonzero(sizes)
    if not len(full):
        return out
    flat, sizes = np.concatenate([hashes[i] for i in full]), sizes[full]
    first = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    # Vertical byte counters: eight bits of all hashes at a time, a byte each,
    # over runs of at most 255 hashes of one text.
    runs = -(-sizes // 255)
    owner = np.repeat(np.arange(len(full)), runs)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(runs) - runs, runs)
    starts, group = first[owner] + 255 * nth, np.cumsum(runs) - runs
    bits = np.zeros((len(full), 64), bool)
    for s in range(8):
        counts = np.add.reduceat((flat >> np.uint64(s)) & _BYTES, starts).view(np.uint8).reshape(-1, 8)
        bits[:, s::8] = 2 * np.add.reduceat(counts.astype(np.int64), group, axis=0) > sizes[:, None]
    out[full] = np.packbits(bits, axis=1, bitorder="little").view(np.uint64).ravel()
    return out


def with_fingerprint(docs: DataFrame, text: str = "text", out: str = "fp", shingle: int = 3) -> DataFrame:
    """``docs`` with the fingerprint as a long (its 64 bits) in column ``out``."""
    ship(docs.sparkSession)

    @F.arrow_udf("long")
    def fp(values: pa.Array) -> pa.Array:
        parts = [fingerprints(run, shingle).view(np.int64) for _, _, run in slices(values)]
        return pa.array(np.concatenate([np.empty(0, np.int64), *parts]))

    return docs.withColumn(out, fp.asNondeterministic()(as_bytes(text)))


def _low_bits(planes: np.ndarray, queries: np.ndarray, radius: int) -> np.ndarray:
    """Packed flags: which fingerprints of the block each query is within ``radius`` of.

    planes: (64, words); queries: (64, n) masks, all ones where the bit is set.
    """
    digits = max(1, (radius + 1).bit_length())
    shape = (queries.shape[1], planes.shape[1])
    count = [np.zeros(shape, np.uint64) for _ in range(digits)]
    over = np.zeros(shape, np.uint64)
    for plane, query in zip(planes, queries):
        carry = plane[None, :] ^ query[:, None]
        for d in range(digits):
            count[d], carry = count[d] ^ carry, count[d] & carry
        over |= carry
        past = over.copy()  # counters above the radius
        equal = ~over
        for d in reversed(range(digits)):
            if radius >> d & 1:
                equal &= count[d]
            else:
                past |= equal & count[d]
                equal &= ~count[d]
        over |= past
        if over.all() and (over == ~np.uint64(0)).all():
            break
    return ~over


def links_in_block(fps: np.ndarray, radius: int, run: int = 64) -> np.ndarray:
    """For each fingerprint of a block, the index of its group's smallest member.

    All pairs are compared; only a spanning forest is kept.
    """
    n = len(fps)
    root = np.arange(n)
    if n < 2:
        return root
    bits = np.unpackbits(fps.view(np.uint8).reshape(n, 8), axis=1, bitorder="little")
    wide = np.zeros((-(-n // 64) * 64, 64), np.uint8)
    wide[:n] = bits
    planes = np.ascontiguousarray(np.packbits(wide.T, axis=1, bitorder="little")).view(np.uint64)
    masks = np.where(bits.T == 1, ~np.uint64(0), np.uint64(0))
    # Planes that split the block evenly come first: they end most runs early.
    order = np.argsort(np.abs(bits.mean(axis=0) - 0.5), kind="stable")
    planes, masks = planes[order], masks[order]
    for a in range(0, n, run):
        b = min(n, a + run)
        near = _low_bits(planes[:, a // 64:], masks[:, a:b], radius)
        hit = np.unpackbits(near.view(np.uint8).reshape(b - a, -1), axis=1, bitorder="little")[:, :n - a // 64 * 64]
        hit[np.arange(b - a), np.arange(a, b) - a // 64 * 64] = 0
        for i in np.flatnonzero(hit.any(axis=1)):
            members = np.flatnonzero(hit[i]) + a // 64 * 64
            roots = np.unique(np.append(root[members], root[a + i]))
            if len(roots) > 1:
                root[np.isin(root, roots[1:])] = roots[0]
    return root


def _links(batches: Iterator[pa.RecordBatch], radius: int, block: int) -> Iterator[pa.RecordBatch]:
    """Rows sorted by key in, links (a, b) out; whole keys are packed into blocks."""
    def emit(fps: np.ndarray) -> pa.RecordBatch:
        fps = np.unique(fps)
        root = links_in_block(fps.view(np.uint64), radius)
        far = np.flatnonzero(root != np.arange(len(fps)))
        return pa.RecordBatch.from_arrays([pa.array(fps[far]), pa.array(fps[root[far]])], names=["a", "b"])

    rest, last, held = [], None, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        key = np.stack([batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(4)], axis=1)
        fps = batch.column(4).to_numpy(zero_copy_only=False)
        new = np.flatnonzero(np.r_[last is None or (key[0] != last).any(), (key[1:] != key[:-1]).any(axis=1)])
        cuts = np.r_[new, len(fps)]
        if cuts[0] > 0:
            rest.append(fps[:cuts[0]])
            held += int(cuts[0])
        for a, b in zip(cuts[:-1], cuts[1:]):
            if held >= block:
                yield emit(np.concatenate(rest))
                rest, held = [], 0
            rest.append(fps[a:b])
            held += int(b - a)
        last = key[-1]
    if rest:
        yield emit(np.concatenate(rest))


def fingerprint_links(fps: DataFrame, radius: int = 2, blocks: int = BLOCKS, block: int = BLOCK) -> DataFrame:
    """Links (a, b) between the distinct fingerprints in ``fps`` (column fp) that connect all within ``radius``."""
    ship(fps.sparkSession)
    width = [64 // blocks + (i < 64 % blocks) for i in range(blocks)]
    start = [sum(width[:i]) for i in range(blocks)]
    masks = [sum((1 << width[i]) - 1 << start[i] for i in fields) for fields in combinations(range(blocks), blocks - radius)]
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]
    keyed = fps.select("fp", F.explode(F.array(*[
        F.struct(F.lit(i).alias("t"), F.col("fp").bitwiseAND(F.lit(m).cast("long")).alias("key"))
        for i, m in enumerate(signed)])).alias("k")).select("k.t", "k.key", "fp")
    # Cut, so that both sides of the join arrive by an exchange that adaptive
    # execution can split where one key is hot.
    shared = cut(keyed.groupBy("t", "key").agg(F.count("*").alias("n")).where("n > 1"))
    parts = F.ceil(F.col("n") / F.lit(block)).cast("int")
    part = F.pmod(F.xxhash64("fp"), parts).cast("int")
    pairs = F.when(F.col("n") <= block, F.array(F.struct(F.lit(0).alias("i"), F.lit(0).alias("j")))).otherwise(
        F.transform(F.sequence(F.lit(0), parts - 1),
                    lambda x: F.struct(F.least(part, x).alias("i"), F.greatest(part, x).alias("j"))))
    dealt = (keyed.join(shared, ["t", "key"]).select("t", "key", F.explode(pairs).alias("p"), "fp")
             .select("t", "key", "p.i", "p.j", "fp")
             .repartition("t", "key", "i", "j").sortWithinPartitions("t", "key", "i", "j", "fp"))
    return dealt.mapInArrow(lambda it: _links(it, radius, block), "a long, b long")


def _groups(docs: DataFrame, doc_id: str, text: str, shingle: int, radius: int) -> tuple[DataFrame, DataFrame]:
    """(doc_id, fp) per row, and (label_fp, first, root, component_id) per distinct fingerprint; both checkpointed."""
    prints = cut(with_fingerprint(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")),
                                  "text", "fp", shingle).select("doc_id", "fp"))
    nodes = cut(prints.groupBy("fp").agg(F.min("doc_id").alias("first")))
    groups = components(fingerprint_links(nodes.select("fp"), radius))
    rooted = nodes.join(groups, F.col("fp") == F.col("node"), "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    # Both sides cut: a group may hold most fingerprints, and is split in the join.
    rooted = cut(rooted)
    ids = cut(rooted.groupBy("root").agg(F.min("first").alias("component_id")))
    return prints, cut(rooted.join(ids, "root").select(F.col("fp").alias("label_fp"), "first", "root", "component_id"))


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 3,
                    radius: int = 2) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits), component_id (its group's smallest doc_id)."""
    prints, labels = _groups(docs, doc_id, text, shingle, radius)
    return prints.join(labels, F.col("fp") == F.col("label_fp")).select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def keep_first(docs: DataFrame, shingle: int = 3, radius: int = 2) -> DataFrame:
    """One document of each group stays: the one of smallest doc_id.

    Of several rows of the group with that doc_id one of the smallest
    fingerprint stays; in a group that has no doc_id at all, one of its rows
    stays. A doc_id that lies in several groups can stay in each. All columns
    of ``docs`` come back as they were, whatever their names.
    """
    _, labels = _groups(docs, "doc_id", "text", shingle, radius)
    keep = cut(labels.where("first = component_id").groupBy("root")
               .agg(F.min("component_id").alias("keep"), F.min("label_fp").alias("keep_fp")).drop("root"))
    ids = keep.select("keep").distinct()
    rows = whole_rows(docs)
    kept = rows.join(ids, F.col("row.doc_id") == F.col("keep")).select("row", F.col("row.doc_id").alias("id"))
    named = (with_fingerprint(kept, "row.text", "fp", shingle)
             .join(keep, (F.col("id") == F.col("keep")) & (F.col("fp") == F.col("keep_fp")))
             .dropDuplicates(["id", "fp"]).select("row"))
    free = labels.where("component_id is null").select("label_fp", "root")
    unnamed = (with_fingerprint(rows.where("row.doc_id is null"), "row.text", "fp", shingle)
               .join(free, F.col("fp") == F.col("label_fp")).dropDuplicates(["root"]).select("row"))
    return named.unionByName(unnamed).select("row.*")
