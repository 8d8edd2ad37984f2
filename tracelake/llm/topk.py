"""Operator 13: exact top-k search by distributed histogram selection.

Every query is scored against every candidate, but no score is ever a row.
Queries and candidates are dealt to the cells of a grid (a block of queries, a
group of candidates); a task streams the candidates of a cell past its block of
queries and only counts: one histogram of scores per query over the interval in
which the query's k-th score is known to lie. The histograms are added up over
all cells, the bin that holds the k-th score becomes the next interval, and the
scores are counted again in it, 512 bins a round, until the interval is one
value. Where more candidates have that very score than are needed, the same
selection goes on over their ids, smallest first. At last each query knows the
lowest score and, at that score, the largest id that it takes; one more pass
keeps the rows at or above that mark, about k a query, and ranks them.

Rounds depend on the range of the scores and ids (2 or 3, one more for ties at
each 9 bits of ids), not on the number of rows. What leaves a task in a round is
at most k bins for each query that it has met. The driver holds the number of
rows, the longest vector, the range of ids, and whether a query is still open.

Scores are exact: blocks whose sums stay below 2^53 are multiplied as doubles,
others as whole numbers. Defined results: a vector that is null or holds a null
or non-finite component takes no part, nor does a row without an id; components
of absolute value past 2^31 after scaling are set to that, and a score past a
long to the largest or smallest long; vectors of different length are compared
over the shorter one (an empty vector scores 0); every row whose id equals the
query's is the query's own; repeated rows are candidates each and queries each,
and rows of one id and score are interchangeable; a query with fewer than k
candidates returns them all, and one without any none; an empty table gives no
rows; other columns of the input are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tracelake.llm.common import cut, ship

#: Queries of a block and candidates of a group: both are means of a deal by hash.
QUERY_BLOCK, CANDIDATE_GROUP = 4096, 16384
#: Bits of the histogram of a round.
BITS = 9
#: Scores made at once in a task.
SCORES = 1 << 21
_LIMIT = 2**31 - 1
_LEAST, _MOST = -(2**63), 2**63 - 1
VECTOR = "vec_id long, v array<int>, norm double"
#: A query's state. step 0: k-th score open; 1: ids of ties open; 2: found. The open value lies in [low, low + 2^bits).
STATE = ["q", "block", "vec_id", "v", "step", "score", "low", "bits", "need", "last"]


def _matrix(values: pa.Array) -> np.ndarray:
    """Lists as rows of doubles, shorter ones filled with zeros."""
    sizes = np.diff(values.offsets.to_numpy())
    flat = values.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    width = int(sizes.max(initial=0))
    if (sizes == width).all():
        return flat.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width))
    out[np.arange(width) < sizes[:, None]] = flat
    return out


def _quantize(batches: Iterator[pa.RecordBatch], scale: float) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, vectors = batch.column(0), batch.column(1)
        sizes = np.diff(vectors.offsets.to_numpy())
        flat = vectors.flatten()
        x = flat.to_numpy(zero_copy_only=False).astype(np.float64)  # null as nan
        row = np.repeat(np.arange(len(sizes)), sizes)
        fine = np.bincount(row, ~np.isfinite(x), minlength=len(sizes)) == 0
        with np.errstate(over="ignore", invalid="ignore"):
            x = np.clip(np.nan_to_num(np.floor(scale * x), posinf=_LIMIT, neginf=-_LIMIT), -_LIMIT, _LIMIT)
        norm = np.sqrt(np.bincount(row, x * x, minlength=len(sizes)))
        offsets = np.concatenate([[0], np.cumsum(sizes[fine])]).astype(np.int32)
        lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(x[fine[row]].astype(np.int32)))
        yield pa.RecordBatch.from_arrays([ids.filter(pa.array(fine)), lists, pa.array(norm[fine])], names=["vec_id", "v", "norm"])


def whole_vectors(rows: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", scale: float = 256.0) -> DataFrame:
    """floor(scale * x) of every component, as rows (vec_id, v, norm); rows that take no part are left out."""
    ship(rows.sparkSession)
    known = rows.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("v"))
    return known.where("vec_id is not null and v is not null").mapInArrow(partial(_quantize, scale=scale), VECTOR)


def scores_of(queries: np.ndarray, candidates: np.ndarray) -> np.ndarray:
    """Inner products as whole numbers, over the shorter length."""
    d = min(queries.shape[1], candidates.shape[1])
    a, b = queries[:, :d], candidates[:, :d]
    bound = np.abs(a).max(initial=0) * np.abs(b).max(initial=0) * d
    if bound < 2**53:
        return (a @ b.T).astype(np.int64)
    exact = a.astype(np.int64).astype(object) @ b.astype(np.int64).astype(object).T
    return np.clip(exact, _LEAST, _MOST).astype(np.int64)


class Block:
    """A block of queries in a task: their state, and their histograms so far."""

    def __init__(self, rows: pa.RecordBatch):
        column = {name: rows.column(i) for i, name in enumerate(rows.schema.names)}
        self.matrix = _matrix(column["v"])
        for name in ("q", "vec_id", "step", "score", "low", "bits", "need", "last"):
            setattr(self, name, column[name].to_numpy(zero_copy_only=False).astype(np.int64))
        self.counts = None

    def scored(self, ids: np.ndarray, matrix: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Ids of some candidates, their scores for every query, and which are the query's own."""
        run = max(1, SCORES // max(1, len(self.q)))
        for a in range(0, len(ids), run):
            some = ids[a:a + run]
            yield some, scores_of(self.matrix, matrix[a:a + run]), self.vec_id[:, None] == some

    def count(self, ids: np.ndarray, matrix: np.ndarray) -> None:
        if self.counts is None:
            self.counts = np.zeros(len(self.q) << BITS, np.int64)
        ties = (self.step == 1)[:, None]
        low, shift = self.low.view(np.uint64)[:, None], np.maximum(self.bits - BITS, 0).astype(np.uint64)[:, None]
        half = (self.bits - 1).astype(np.uint64)[:, None]
        rows = (np.arange(len(self.q)) << BITS)[:, None]
        for some, score, own in self.scored(ids, matrix):
            # Both kinds of key grow with preference: the score, or the id turned over.
            key = np.where(ties, ~some, score) if ties.any() else score
            off = key.view(np.uint64) - low
            inside = (key >= self.low[:, None]) & (off >> half <= 1) & ~own
            if ties.any():
                inside &= ~ties | (score == self.score[:, None])
            at = (rows + (off >> shift).astype(np.int64))[inside]
            self.counts += np.bincount(at, minlength=len(self.counts))

    def bins(self) -> pa.RecordBatch:
        """The highest bins of every query (each by its lowest value), as many as can hold the value it looks for."""
        grid = self.counts.reshape(len(self.q), 1 << BITS)[:, ::-1]
        before = np.cumsum(grid, axis=1) - grid
        i, j = np.nonzero((grid > 0) & (before < self.need[:, None]))
        shift = np.maximum(self.bits - BITS, 0).astype(np.uint64)[i]
        start = self.low.view(np.uint64)[i] + (((1 << BITS) - 1 - j).astype(np.uint64) << shift)
        return pa.RecordBatch.from_arrays([pa.array(self.q[i]), pa.array(start.view(np.int64)), pa.array(grid[i, j])], names=["q", "bin", "n"])

    def kept(self, ids: np.ndarray, matrix: np.ndarray) -> Iterator[pa.RecordBatch]:
        for some, score, own in self.scored(ids, matrix):
            mark = self.score[:, None]
            i, j = np.nonzero(((score > mark) | ((score == mark) & (some <= self.last[:, None]))) & ~own)
            if len(i):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(self.q[i]), pa.array(self.vec_id[i]), pa.array(some[j]), pa.array(score[i, j])],
                    names=["q", "query_id", "vec_id", "score"])


def _cells(batches: Iterator[pa.RecordBatch], final: bool) -> Iterator[pa.RecordBatch]:
    """Rows in order of (block, group, kind): a cell's queries (kind 0), then its candidates."""
    waiting: list[pa.RecordBatch] = []
    block, name, cell, fresh = None, None, None, False
    for batch in batches:
        if not batch.num_rows:
            continue
        key = np.stack([batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(3)], axis=1)
        cuts = np.concatenate([[0], np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1, [len(key)]])
        for a, b in zip(cuts[:-1], cuts[1:]):
            rows = batch.slice(a, b - a)
            if key[a, 2] == 0:
                if (key[a, 0], key[a, 1]) != cell:
                    waiting, fresh = [], key[a, 0] != name
                    if fresh and block is not None and not final and block.counts is not None:
                        yield block.bins()
                    if fresh:
                        block = None
                    name, cell = key[a, 0], (key[a, 0], key[a, 1])
                if fresh:
                    waiting.append(rows)
                continue
            if (key[a, 0], key[a, 1]) != cell:
                continue  # candidates of a cell whose block has no open query
            if waiting:
                block, waiting, fresh = Block(pa.Table.from_batches(waiting).combine_chunks().to_batches()[0]), [], False
            ids, matrix = rows.column(batch.schema.get_field_index("vec_id")).to_numpy(), _matrix(rows.column(batch.schema.get_field_index("v")))
            if final:
                yield from block.kept(ids, matrix)
            else:
                block.count(ids, matrix)
    if block is not None and not final and block.counts is not None:
        yield block.bins()


def _over_cells(candidates: DataFrame, state: DataFrame, blocks: int, groups: int, final: bool) -> DataFrame:
    """One pass of all candidates past the queries in ``state``."""
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    queries = state.select("block", every(groups).alias("cell"), F.lit(0).alias("kind"), *[c for c in STATE if c != "block"])
    rest = {f.name: f.dataType for f in state.schema.fields}
    others = candidates.select(every(blocks).alias("block"), F.col("cell"), F.lit(1).alias("kind"), *[
        F.col(c) if c in ("vec_id", "v") else F.lit(None).cast(rest[c]).alias(c) for c in STATE if c != "block"])
    dealt = queries.unionByName(others).repartition("block", "cell").sortWithinPartitions("block", "cell", "kind")
    schema = "q long, query_id long, vec_id long, score long" if final else "q long, bin long, n long"
    return dealt.mapInArrow(partial(_cells, final=final), schema)


def _next_state(state: DataFrame, counted: DataFrame, first_id: int, id_bits: int) -> DataFrame:
    """The interval of every open query narrowed to the bin that holds the value it looks for."""
    down = Window.partitionBy("q").orderBy(F.col("bin").desc()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sums = counted.groupBy("q", "bin").agg(F.sum("n").alias("n")).withColumn("upto", F.sum("n").over(down))
    needs = state.where("step < 2").select(F.col("q").alias("_q"), F.col("need").alias("_need"))
    found = (sums.join(needs, F.col("q") == F.col("_q"))
             .where((F.col("upto") >= F.col("_need")) & (F.col("upto") - F.col("n") < F.col("_need")))
             .select("_q", "bin", "n", (F.col("_need") - F.col("upto") + F.col("n")).alias("left")))
    s = state.join(found, F.col("q") == F.col("_q"), "left")
    bits = F.greatest(F.col("bits") - BITS, F.lit(0))
    low = F.col("bin")
    is_open, few, one = F.col("step") < 2, F.col("bin").isNull(), bits == 0
    score_known = is_open & (F.col("step") == 0) & ~few & one
    tied = score_known & (F.col("n") > F.col("left"))
    ids_known = is_open & (F.col("step") == 1) & one
    return s.select(
        "q", "block", "vec_id", "v",
        F.when(~is_open | few | (score_known & ~tied) | ids_known, 2).when(tied, 1).otherwise(F.col("step")).alias("step"),
        F.when(is_open & few, F.lit(_LEAST)).when(score_known, low).otherwise(F.col("score")).alias("score"),
        F.when(tied, F.lit(first_id)).when(is_open & ~few, low).otherwise(F.col("low")).alias("low"),
        F.when(tied, F.lit(id_bits)).when(is_open & ~few, bits).otherwise(F.col("bits")).alias("bits"),
        F.when(is_open & ~few, F.col("left")).otherwise(F.col("need")).alias("need"),
        F.when(ids_known, F.bitwise_not(low)).otherwise(F.col("last")).alias("last"))


def top_k(vectors: DataFrame, queries: Column, k: int = 5) -> DataFrame:
    """Rows (query_id, rank, vec_id, score): the k highest inner products of every query row, ties to the smaller id.

    ``vectors``: rows (vec_id, v, norm) of ``whole_vectors``; ``queries`` marks the rows that are queries, by vec_id.
    """
    spark = vectors.sparkSession
    ship(spark)
    rows = cut(vectors.withColumn("q", F.monotonically_increasing_id()).withColumn("asks", F.coalesce(queries, F.lit(False))))
    n, asked, norm, least, most = rows.agg(F.count("*"), F.count_if("asks"), F.max("norm"), F.min("vec_id"), F.max("vec_id")).first()
    blocks, groups = max(1, -(-asked // QUERY_BLOCK)), max(1, -(-n // CANDIDATE_GROUP))
    dealt = lambda parts: F.pmod(F.xxhash64("q"), F.lit(parts)).cast("int")
    candidates = rows.select("vec_id", "v", dealt(groups).alias("cell"))
    first_id, id_bits = (~most, max(1, (most - least).bit_length())) if n else (0, 1)
    # No score of a query is larger than its length times that of the longest vector.
    reach = F.ceil(F.least(F.col("norm") * (norm or 0.0) * (1 + 1e-9) + 1, F.lit(2.0**62))).cast("long")
    state = cut(rows.where("asks").select(
        "q", dealt(blocks).alias("block"), "vec_id", "v", F.lit(0).alias("step"), F.lit(0).cast("long").alias("score"),
        F.when(reach >= 2**62, F.lit(_LEAST)).otherwise(-reach).alias("low"),
        F.when(reach >= 2**62, 64).otherwise(F.length(F.bin(2 * reach)).cast("int")).alias("bits"),
        F.lit(k).cast("long").alias("need"), F.lit(_MOST).alias("last")))
    while state.where("step < 2").limit(1).count():
        counted = _over_cells(candidates, state.where("step < 2"), blocks, groups, final=False)
        state = cut(_next_state(state, counted, first_id, id_bits))
    kept = _over_cells(candidates, state, blocks, groups, final=True)
    order = Window.partitionBy("q").orderBy(F.col("score").desc(), "vec_id")
    return (kept.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
