"""Operator 9: language-model scores from a probabilistic suffix tree.

Symbols are words (A-Z lower-cased) and the end of a text. The root of the
tree predicts with additively smoothed counts of all training text. Contexts
of one word to ``depth`` words (two unless told otherwise; a longer one is only
looked at where it occurs often enough) become states if they occur ``CONTEXT_COUNT`` times and
pass a divergence test: the log-likelihood that their
own next-word distribution gains over that of their longest retained suffix
must exceed half the logarithm of their count for each word they tell apart.
A state's distribution is discounted and interpolated with its suffix's, so
every distribution sums to one; a token is scored in the state of the longest
retained suffix of what precedes it. The text before the first word is the
end of the text before.

Scale: a worker turns its documents into chunks of word numbers, written once
to a bucketed table. Each chunk's distinct words go out in blocks, one for each
part of the hashes, to be counted over all chunks (their hashes lie in a
partition of the table, which goes then), and the counts come back to
the chunk, again bucketed, so that counting contexts and scoring read both
without a shuffle. A word that is in every chunk is one entry of a block of
each, so no part is much larger than the others. The tree grows
with the corpus and stays distributed: for each length of context in turn, a
chunk's distinct continuations of contexts that occur often enough go out by
hash of the context (a context of many occurrences to several parts, by hash
of the next word), are counted and tested there, and counts and what makes the weights of
retained states come back to the chunks in a bucketed table. The driver holds the
numbers of training tokens and types, the counts of at most ``FREQUENT`` words and, for each length, the few contexts of
several parts, whose test is an aggregate over them (at most 4 for each part). Words and contexts are known by a 64-bit hash. The tables lie in the
shared folder and are named tracelake_lm_*; ``drop_tables`` removes those of
this session when the result has been read. A chunk makes at most one block for
each part in a round: chunks and parts both grow with the corpus, so a larger
corpus wants larger chunks (``chunk_bytes``), as far as a worker's memory goes.

Defined results: a null or empty text is the end alone; texts of any length are
scored whole (a chunk holds one text at least); repeated rows count and score
each on its own; rows of a null id are scored but not learned from; other columns
of the input are not looked at;
with nothing to learn from every token has probability one (0.1 / 0.1); an
empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field, replace
from functools import partial
from itertools import islice
from operator import itemgetter
from uuid import uuid4

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tracelake.llm.common import LOWER, as_bytes, crc32_of_id, shared_dir, ship
from tracelake.llm.words import Numbering, mix64, number_words, sums

ALPHA = 0.1
DISCOUNT = 0.5
#: A context is a candidate from this count on, a word can follow it from this count on ...
CONTEXT_COUNT, NEXT_COUNT = 20, 3
#: ... and does so from this count of the pair (or triple) on.
PAIR_COUNT = 3
#: No threshold is a share of the corpus, else the tree would stop growing with it.
CONTEXT_SHARE = NEXT_SHARE = PAIR_SHARE = 0.0
#: Words of the longest contexts.
DEPTH = 2
#: Names of the tables in the shared folder begin so.
TABLES = "tracelake_lm_"
#: Parts that continuations are dealt to, for each shuffle partition.
PARTS = 4
#: Words, the most frequent of each part, whose counts every worker knows: blocks do not say them.
FREQUENT = 1 << 17
#: Blocks of continuations that leave a worker at once.
BLOCKS = 64
#: Text of a chunk: what a worker holds in arrays at once is about twenty times that.
CHUNK_BYTES = 4 << 20
END = b""  # no word is empty
_ONE, _TWO = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
#: Two rows of each chunk: of kind "tokens" without hashes, and of kind "hashes" with no more than these and the counts.
CHUNK_SCHEMA = ("chunk long, doc_ids array<bigint>, held_out array<boolean>, sizes array<int>, end int, "
                "tokens binary, hashes binary, learned binary, kind string")
#: Steps of the logarithm (base 2) that a probability is sent in: it only weighs in the divergence test.
LOG_STEPS = 1024
#: Counts up to this one are sent as they are, larger ones in steps of their logarithm, which are no longer than one here.
EXACT = round(LOG_STEPS / np.log(2))
BLOCK_SCHEMA = "chunk long, part int, contexts binary, totals binary, sizes binary, next binary, n binary, lower binary"
#: Answers to a block (chunk to data: columns of integers), a retained context with its weight, or a part's share of the sums of a context of several parts.
COUNTED_SCHEMA = ("chunk long, part int, data binary, context long, weight double, "
                  "gain double, seen long, expected double, size long, total long")


@dataclass(frozen=True)
class Model:
    """Training tokens and types, and the number of parts that continuations are dealt to.

    ``wide``: for every order so far, hashes (sorted) and weights of the retained contexts that are spread over several
    several parts. Such a context has at least the 4 * parts-th share of all tokens, so there are at most 4 * parts of an order.
    ``frequent``: levels of the counts of the words with the smallest numbers, by number.
    """

    tokens: int
    types: int
    parts: int
    wide: tuple[tuple[np.ndarray, np.ndarray], ...] = ()
    frequent: np.ndarray = field(default_factory=partial(np.empty, 0, np.int32))


def one_word(h: np.ndarray) -> np.ndarray:
    return mix64(h ^ _ONE)


def longer(before: np.ndarray, context: np.ndarray) -> np.ndarray:
    """Hash of a context with one more word before it."""
    return mix64(mix64(before ^ _TWO) + context)


def context_hash(words: np.ndarray) -> np.ndarray:
    """Hashes of contexts from the numbers of their words (a row for each place, the first word's first)."""
    out = one_word(words[-1])
    for before in words[-2::-1]:
        out = longer(before, out)
    return out


def followed(context: np.ndarray, h: np.ndarray) -> np.ndarray:
    return mix64(context ^ mix64(h))


def _pieces(total: np.ndarray, model: Model) -> np.ndarray:
    """Parts that a context's continuations are spread over: more than one from a quarter of a part's tokens on."""
    return total * (4 * model.parts) // max(1, model.tokens) + 1


def _chunks(batches: Iterator[pa.RecordBatch], chunk_bytes: int) -> Iterator[pa.RecordBatch]:
    """Rows (doc_id, held_out, learn, text) as chunks: words in order of hash, and so of part, tokens as places of words by frequency."""
    part, number = TaskContext.get().partitionId(), 0
    ids, held, learn, rows, sizes, words, size = [], [], [], [], [], Numbering(), 0
    words[END]

    def flush() -> pa.RecordBatch:
        flat, counts = np.concatenate(rows), np.concatenate(sizes)
        weights = np.repeat(np.array(learn, bool), counts)
        hashes = np.fromiter(map(partial(xxhash.xxh64_intdigest, seed=0), words), np.uint64, len(words))
        by = np.argsort(hashes)
        learned = np.bincount(flat[weights], minlength=len(words))[by]
        rank = np.empty(len(by), np.int64)
        rank[by[_ranked(learned)]] = np.arange(len(by))
        both = {"chunk": part << 24 | number, "learned": narrow(learned)}
        rows_ = [both | {"doc_ids": ids, "held_out": held, "sizes": counts.tolist(), "end": int(np.flatnonzero(by == 0)[0]),
                         "tokens": narrow(rank[flat]), "kind": "tokens"},
                 both | {"hashes": narrow(np.diff(hashes[by], prepend=np.uint64(0))), "kind": "hashes"}]
        return pa.RecordBatch.from_pylist(rows_, schema=pa.schema([
            ("chunk", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("held_out", pa.list_(pa.bool_())),
            ("sizes", pa.list_(pa.int32())), ("end", pa.int32()), ("tokens", pa.binary()), ("hashes", pa.binary()),
            ("learned", pa.binary()), ("kind", pa.string())]))

    for batch in batches:
        names, out, train = (batch.column(i).to_pylist() for i in range(3))
        for i in range(batch.num_rows):
            text = batch.column(3)[i].as_py().translate(LOWER)
            row, n = number_words([text], words, tail=0)
            ids.append(names[i])
            held.append(out[i])
            learn.append(train[i])
            rows.append(row)
            sizes.append(n)
            size += len(text)
            if size >= chunk_bytes:
                yield flush()
                number += 1
                ids, held, learn, rows, sizes, words, size = [], [], [], [], [], Numbering(), 0
                words[END]
    if ids:
        yield flush()


_PRESS, _UNPRESS = zstandard.ZstdCompressor(level=1), zstandard.ZstdDecompressor()


#: Where most numbers are small, those below this one are a byte; so many numbers make it worth while.
SMALL, MANY = 128, 256


def narrow(values: np.ndarray) -> bytes:
    """Non-negative integers in few bytes, compressed.

    In as many bytes each as the largest needs: first all lowest bytes, then all second ones, ... Many numbers of up to four
    bytes go otherwise (a leading 0 says so): a byte each, from ``SMALL`` on by the number's upper bytes, then the lowest
    byte of those from ``SMALL`` on, then what of their upper bytes did not fit.
    """
    values = np.ascontiguousarray(values, "<i8")
    most = int(values.view("<u8").max(initial=0))
    if most >> 32 or most < 256 or len(values) < MANY:
        size = max(1, -(-most.bit_length() // 8))
        return bytes([size]) + _PRESS.compress(values.view(np.uint8).reshape(-1, 8)[:, :size].T.tobytes())
    first, large = values.copy(), np.flatnonzero(values >= SMALL)
    over, last = values[large] - SMALL, 255 - SMALL
    upper = over >> 8
    first[large] = SMALL + np.minimum(upper, last)
    parts = (_PRESS.compress(x.astype(np.uint8).tobytes()) for x in (first, over & 255))
    return bytes([0]) + b"".join(len(x).to_bytes(4, "little") + x for x in parts) + narrow(upper[upper >= last] - last)


def widen(data: bytes) -> np.ndarray:
    size = data[0]
    if not size:
        parts, start = [], 1
        for _ in range(2):
            start, stop = start + 4, start + 4 + int.from_bytes(data[start:start + 4], "little")
            parts.append(np.frombuffer(_UNPRESS.decompress(data[start:stop]), np.uint8).astype(np.int64))
            start = stop
        out, lowest = parts
        large = np.flatnonzero(out >= SMALL)
        upper = out[large] - SMALL
        upper[upper == 255 - SMALL] += widen(data[start:])
        out[large] = SMALL + (upper << 8 | lowest)
        return out
    planes = np.frombuffer(_UNPRESS.decompress(data[1:]), np.uint8).reshape(size, -1)
    out = np.zeros((planes.shape[1], 8), np.uint8)
    out[:, :size] = planes.T
    return out.view("<i8").ravel()


def near(values: np.ndarray) -> np.ndarray:
    """Whole numbers as non-negative steps from one to the next (up: even, down: odd), small where the numbers mostly ascend slowly."""
    step = np.diff(values.astype(np.int64, copy=False), prepend=0)
    return (step << 1) ^ (step >> 63)


def from_near(steps: np.ndarray) -> np.ndarray:
    return np.cumsum((steps >> 1) ^ -(steps & 1))


def climbs(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Runs of ascending numbers as steps, each run from 0."""
    steps, starts = np.diff(values, prepend=0), (np.cumsum(sizes) - sizes)[sizes > 0]
    steps[starts] = values[starts]
    return steps


def from_climbs(steps: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    out, sizes = np.cumsum(steps), sizes[sizes > 0]
    starts = np.cumsum(sizes) - sizes
    return out - np.repeat(out[starts] - steps[starts], sizes)


def level(count: np.ndarray) -> np.ndarray:
    """A count as a number that ascends with it: itself up to ``EXACT``, from there by the logarithm."""
    return np.where(count <= EXACT, count, EXACT + np.round(LOG_STEPS * np.log2(np.maximum(count, 1) / EXACT))).astype(np.int64)


def count_of(level: np.ndarray) -> np.ndarray:
    return np.where(level <= EXACT, level, EXACT * np.exp2((level - EXACT) / LOG_STEPS))


def in_order(values: np.ndarray, by: np.ndarray) -> np.ndarray:
    """Values that come in ascending order of ``by``, put in the order of ``by`` itself."""
    out = np.empty_like(values)
    out[np.argsort(by, kind="stable")] = values
    return out


def _part_of(hashes: np.ndarray, parts: int) -> np.ndarray:
    """The part of each word; ascends with the hash."""
    return ((hashes >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int32)


def _ranked(learned: np.ndarray) -> np.ndarray:
    """Places of a chunk's words, the most frequent first."""
    return np.argsort(-learned, kind="stable")


def _vocabulary(batches: Iterator[pa.RecordBatch], parts: int) -> Iterator[pa.RecordBatch]:
    """A chunk's distinct words, one block for each part: hashes and how often the chunk's learned texts have them."""
    kinds = (pa.int64(), pa.int32(), pa.binary(), pa.binary())
    for batch in batches:
        for i in range(batch.num_rows):
            hashes = np.cumsum(widen(batch.column(1)[i].as_py()).view(np.uint64))
            learned = widen(batch.column(2)[i].as_py())
            part = _part_of(hashes, parts)  # ascending
            cuts = np.r_[0, np.flatnonzero(part[1:] != part[:-1]) + 1, len(part)]
            chunk, blocks = batch.column(0)[i].as_py(), []
            for a, b in zip(cuts[:-1], cuts[1:]):
                blocks.append((chunk, int(part[a]), narrow(np.diff(hashes[a:b], prepend=np.uint64(0))), narrow(learned[a:b])))
                if len(blocks) == BLOCKS or b == len(part):
                    yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*blocks), kinds)],
                                                     names=["chunk", "part", "hashes", "learned"])
                    blocks = []


def _by_part(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
    """Rows (chunk, part, ...) in order of part as one list per part."""
    blocks: list[tuple] = []
    for batch in batches:
        for row in zip(*(column.to_pylist() for column in batch.columns)):
            if blocks and blocks[-1][1] != row[1]:
                yield blocks
                blocks = []
            blocks.append(row)
    if blocks:
        yield blocks


def _word_counts(batches: Iterator[pa.RecordBatch], parts: int) -> Iterator[pa.RecordBatch]:
    """The corpus counts and ranks of every block's words, and, in a row without a chunk, how many learned words the part has
    and the counts of its most frequent ones.

    Words that no block of continuations can hold have the rank behind all others in common. Counts come in order of rank,
    in which they descend.
    """
    kinds = (pa.int64(), pa.int32(), pa.binary(), pa.int64(), pa.binary())
    names = ["chunk", "part", "data", "types", "frequent"]
    for blocks in _by_part(batches):
        hashes = np.concatenate([np.cumsum(widen(x[2]).view(np.uint64)) for x in blocks])
        sizes = [widen(x[3]) for x in blocks]
        learned, sizes = np.concatenate(sizes), [len(x) for x in sizes]
        words, which = np.unique(hashes, return_inverse=True)
        total = np.bincount(which, weights=learned, minlength=len(words)).astype(np.int64)
        by = np.argsort(-total, kind="stable")
        rank = np.empty(len(words), np.int64)
        rank[by] = np.minimum(np.arange(len(words)), (total >= min(NEXT_COUNT, CONTEXT_COUNT)).sum())
        row = (None, blocks[0][1], None, int((total > 0).sum()), narrow(total[by[:FREQUENT // parts]]))
        yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, kinds)], names=names)
        counts, ranks, a = total[which], rank[which], 0
        del hashes, learned, which
        for block, n in zip(blocks, sizes):
            c, r = counts[a:a + n], ranks[a:a + n]
            row = (block[0], block[1], _answer(near(c[np.argsort(r, kind="stable")]), r), None, None)
            yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, kinds)], names=names)
            a += n


def _numbered(answers: list[dict], parts: int) -> tuple[np.ndarray, np.ndarray]:
    """The counts and numbers of a chunk's words: frequent words have small numbers, and no two parts the same."""
    counts, numbers = [], []
    for answer in answers:
        steps, rank = _answers([answer], 2)
        counts.append(in_order(from_near(steps), rank))
        numbers.append(rank * parts + answer["part"])
    return np.concatenate(counts), np.concatenate(numbers)


def _answer(*columns: np.ndarray) -> bytes:
    """A block's answer: columns of non-negative integers, each behind its length in bytes."""
    return b"".join(len(x).to_bytes(4, "little") + x for x in map(narrow, columns))


def _answers(parts: list[dict] | None, columns: int) -> list[np.ndarray]:
    """The columns of the answers that have come back to a chunk, in order of part."""
    out = [[np.empty(0, np.int64)] for _ in range(columns)]
    for data in (x["data"] for x in parts or []):
        start = 0
        for column in out:
            stop = start + 4 + int.from_bytes(data[start:start + 4], "little")
            column.append(widen(data[start + 4:stop]))
            start = stop
    return [np.concatenate(column) for column in out]


def _back(counted: DataFrame, k: int) -> DataFrame:
    """Answers by chunk: parts_k, one entry for each block of the chunk."""
    return (counted.where("chunk is not null").groupBy("chunk")
            .agg(F.sort_array(F.collect_list(F.struct("part", "data"))).alias(f"parts_{k}")))


def _table(df: DataFrame, stem: str, buckets: int = 0, kinds: tuple[str, ...] = ()) -> str:
    """Name of a table of the shared folder that ``df`` was written to, in buckets of the chunk and partitions of ``kinds`` if asked."""
    spark = df.sparkSession
    name = f"{TABLES}{stem}_{uuid4().hex}"
    writer = df.write.bucketBy(buckets, "chunk") if buckets else df.write
    writer = writer.partitionBy(*kinds) if kinds else writer
    writer.option("path", f"{shared_dir(spark).rstrip('/')}/{name}").format("parquet").saveAsTable(name)
    # What was shuffled for the table is not needed again; Spark removes such files when the driver collects garbage.
    spark._jvm.System.gc()
    return name


def _delete(spark: SparkSession, name: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark).rstrip('/')}/{name}")
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def _drop(spark: SparkSession, names: list[str]) -> None:
    for name in names:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        _delete(spark, name)


def drop_tables(spark: SparkSession) -> list[str]:
    """Drop the tables that scores of this session were computed from, files included."""
    names = [t.name for t in spark.catalog.listTables() if t.name.startswith(TABLES)]
    _drop(spark, names)
    return names


def encode(docs: DataFrame, learn: Column, held_out: Column, doc_id: str = "doc_id", text: str = "text",
           chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Chunks of word numbers joined with the corpus counts of their words."""
    spark = docs.sparkSession
    ship(spark)
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), held_out.alias("held_out"), learn.alias("learn"),
                       as_bytes(text).alias("text"))
    parts = PARTS * buckets
    raw = _table(rows.mapInArrow(partial(_chunks, chunk_bytes=chunk_bytes), CHUNK_SCHEMA), "words", buckets, ("kind",))
    words = spark.table(raw).where("kind = 'hashes'").select("chunk", "hashes", "learned").mapInArrow(
        partial(_vocabulary, parts=parts), "chunk long, part int, hashes binary, learned binary")
    dealt = words.repartition(buckets, "part").sortWithinPartitions("part")
    name = _table(dealt.mapInArrow(partial(_word_counts, parts=parts), "chunk long, part int, data binary, types long, frequent binary"), "counted0")
    # From here on a word is known by its number; the hashes go.
    spark.sql(f"ALTER TABLE {raw} DROP IF EXISTS PARTITION (kind = 'hashes')")
    _delete(spark, f"{raw}/kind=hashes")
    types = spark.table(name).agg(F.sum("types")).first()[0] or 0
    frequent = _table(spark.table(name).where("chunk is null").select("part", "frequent"), "frequent")
    level = spark.table(_table(_back(spark.table(name), 0), "order0", buckets)).withColumnRenamed("chunk", "_chunk")
    _drop(spark, [name])
    chunks = spark.table(raw).where("kind = 'tokens'").drop("kind", "hashes")
    return (chunks.join(level, F.col("chunk") == F.col("_chunk")).drop("_chunk")
            .withColumn("types", F.lit(int(types))).withColumn("frequent", F.lit(frequent)).withColumn("parts", F.lit(parts)))


def _frequent(spark: SparkSession, name: str, parts: int) -> np.ndarray:
    """Levels of the counts of the words with the smallest numbers, from the table of each part's."""
    counts = np.zeros((FREQUENT // parts, parts), np.int64)
    for row in spark.table(name).collect():
        of_part = widen(bytes(row["frequent"]))
        counts[:len(of_part), row["part"]] = of_part
    return level(counts.ravel()).astype(np.int32)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """Decoded chunks."""
    for batch in batches:
        for i in range(batch.num_rows):
            row = {name: batch.column(j)[i].as_py() for j, name in enumerate(batch.schema.names)}
            c, h = _numbered(row.pop("parts_0"), row.pop("parts"))
            # Words in order of their number, so that frequent ones come first.
            by = np.argsort(h, kind="stable")
            new = np.empty(len(by), np.int32)
            new[by] = np.arange(len(by))
            words, c, h = new[_ranked(widen(row.pop("learned")))][widen(row.pop("tokens"))], c[by], h[by]
            row["end"] = int(new[row["end"]])
            sizes = np.array(row["sizes"], np.int64)
            starts = np.cumsum(sizes) - sizes
            yield row | {"words": words, "sizes": sizes, "starts": starts, "place": np.arange(len(words), dtype=np.int32) - np.repeat(starts.astype(np.int32), sizes),
                         "h": h.view(np.uint64), "c": c}


def _at(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of ``wanted`` in sorted ``keys``, and which are there."""
    if not len(keys):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return at, keys[at] == wanted


@dataclass
class Order:
    """Continuations of contexts of one length in a chunk: places of the tokens and the distinct (context, next) pairs by part."""

    at: np.ndarray  # tokens that are frequent enough (behind the context's suffix, if it has one), behind a context that occurs often enough
    total: np.ndarray  # of every token: how often its context occurs
    contexts: tuple[np.ndarray, ...]  # numbers of each context's words, the first word's first
    context: np.ndarray  # of every pair: number of its context
    next: np.ndarray  # of every pair: number of the next word
    pair: np.ndarray  # of every token in ``at``: its pair
    first: np.ndarray  # of every pair: a token that has it
    part: np.ndarray  # of every pair, ascending
    entry: np.ndarray  # of every part and context in it, in order of part: number of the context ...
    entry_part: np.ndarray
    entry_size: np.ndarray  # ... and its pairs there; none if only rare words follow it here
    entry_total: np.ndarray


def _dealt(row: dict, model: Model, behind: np.ndarray, often: np.ndarray, name: np.ndarray, contexts: tuple[np.ndarray, ...],
           hashes: np.ndarray, total: np.ndarray) -> Order:
    h = row["h"]
    at = behind[often[behind]]
    present, seen = np.unique(name[behind], return_index=True)
    alone = ~np.isin(present, name[at])
    lone, lone_total = present[alone], total[behind[seen[alone]]]
    del present, seen, alone
    key, first, pair = np.unique(name[at] * np.int64(len(h)) + row["words"][at], return_index=True, return_inverse=True)
    context, following = (key // len(h)).astype(np.int32), (key % len(h)).astype(np.int32)
    salt = mix64(h[following]) % _pieces(total[at[first]], model).astype(np.uint64)
    part = (mix64(hashes[context] + salt) % np.uint64(model.parts)).astype(np.int32)
    by = np.argsort(part, kind="stable")
    back = np.empty(len(by), np.int32)
    back[by] = np.arange(len(by))
    context, following, part, first = context[by], following[by], part[by], at[first][by]
    # One entry per part and context, then the contexts without a pair: they ask the part that a context's first piece goes to.
    new = np.flatnonzero(np.r_[True, (context[1:] != context[:-1]) | (part[1:] != part[:-1])][:len(part)])
    entry = np.concatenate([context[new], lone])
    entry_part = np.concatenate([part[new], (mix64(hashes[lone]) % np.uint64(model.parts)).astype(np.int32)])
    entry_size = np.concatenate([np.diff(np.r_[new, len(part)]), np.zeros(len(lone), np.int64)]).astype(np.int64)
    entry_total = np.concatenate([total[first[new]], lone_total])
    by = np.argsort(entry_part, kind="stable")
    return Order(at, total, contexts, context, following, back[pair], first, part,
                 entry[by], entry_part[by], entry_size[by], entry_total[by])


def of_root(count: np.ndarray, model: Model) -> np.ndarray:
    """Probability of a word without any context."""
    return (count + ALPHA) / (model.tokens + ALPHA * (model.types + 1))


def _orders(row: dict, model: Model, depth: int) -> Iterator[tuple[Order, np.ndarray]]:
    """Orders 1 to ``depth`` of a chunk, each with the tokens' probabilities in the tree of shorter contexts; then None and the last.

    An order is passed once its counts and the weights of its states (parts_k) have come back to the chunk.
    """
    words, place, h, c = row["words"], row["place"], row["h"], row["c"]
    p = of_root(c[words], model)
    end = np.int32(row["end"])
    name = np.r_[end, words[:-1]]  # of every token: number of its context; the end before the first
    name[row["starts"]] = end
    contexts, hashes, total = (h,), one_word(h), c[name]
    often = c[words] >= NEXT_COUNT
    for k in range(1, depth + 1):
        behind = np.flatnonzero(total >= CONTEXT_COUNT)
        if k > 1:
            before = np.where(place[behind] == k - 1, end, words[behind - k])
            met, number = np.unique(name[behind] * np.int64(len(h)) + before, return_inverse=True)
            hashes = longer(h[met % len(h)], hashes[met // len(h)])
            contexts = (h[met % len(h)], *[x[met // len(h)] for x in contexts])
            name = np.full(len(words), -1, np.int32)
            name[behind] = number
            del before, met, number
        order = _dealt(row, model, behind, often, name, contexts, hashes, total)
        yield order, p
        n, rest, size = _answers(row.pop(f"parts_{k}"), 3)
        weight = np.zeros(len(hashes))  # of every context; 0 where it is no state
        weight[order.entry] = np.where(size > 0, (rest + DISCOUNT * size) / order.entry_total, 0.0)
        go, spread = _at(model.wide[k - 1][0], hashes)
        weight[spread] = model.wide[k - 1][1][go[spread]]
        here = np.zeros(len(words), np.int64)
        here[order.at] = n[order.pair]
        tokens = behind[weight[name[behind]] > 0]
        own = np.where(here[tokens] > 0, (here[tokens] - DISCOUNT) / total[tokens], 0.0)
        p = p.copy()
        p[tokens] = own + weight[name[tokens]] * p[tokens]
        # The next longer context of a token occurs as often as this order's pair of the token before.
        del order, n, rest, size, weight, own, tokens, behind
        total = np.r_[0, here[:-1]]
        total[row["starts"]] = 0
        # Behind a longer context a word comes no oftener than behind its suffix: too rare here, it need not be counted there.
        often = here >= PAIR_COUNT
    yield None, p


def _ask(batches: Iterator[pa.RecordBatch], model: Model, k: int) -> Iterator[pa.RecordBatch]:
    """The distinct continuations of order ``k``, one block for each part: contexts with their totals, next words with counts.

    Numbers, counts and logarithms go in as few bytes as they need: contexts, and the words behind each, ascend by
    number, and the probabilities of shorter contexts come in order of the words' numbers, so that steps between neighbours
    are small. Behind one word that is a count, and goes for the words that are not among the frequent ones.
    """
    known = len(model.frequent) if k == 1 else 0
    for row in _rows(batches):
        learn = np.repeat(~np.array(row["held_out"], bool), row["sizes"])
        order, p = next(islice(_orders(row, model, k), k - 1, None))
        n = np.bincount(order.pair, weights=learn[order.at], minlength=len(order.part)).astype(np.int64)
        # Behind a context of one word only the next word's count matters; it varies less from word to word than its logarithm.
        lower = level(row["c"][order.next]) if k == 1 else np.round(-LOG_STEPS * np.log2(p[order.first])).astype(np.int64)
        following = row["h"].view(np.int64)[order.next]
        part, contexts = order.entry_part, np.stack([x[order.entry] for x in order.contexts])
        cuts = np.r_[0, np.flatnonzero(part[1:] != part[:-1]) + 1, len(part)] if len(part) else [0]
        kinds, blocks, stop = (pa.int64(), pa.int32(), *[pa.binary()] * 6), [], 0
        for a, b in zip(cuts[:-1], cuts[1:]):
            sizes = order.entry_size[a:b]
            start, stop = stop, stop + int(sizes.sum())
            by = np.argsort(following[start:stop], kind="stable")
            by = by[np.searchsorted(following[start:stop][by], known):]
            blocks.append((row["chunk"], int(part[a]), narrow(near(contexts[:, a:b].ravel())), narrow(near(np.where(sizes > 0, order.entry_total[a:b], 0))), narrow(sizes),
                           narrow(climbs(following[start:stop], sizes)), narrow(n[start:stop]), narrow(near(lower[start:stop][by]))))
            if len(blocks) == BLOCKS or b == len(part):
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*blocks), kinds)],
                                                 names=["chunk", "part", "contexts", "totals", "sizes", "next", "n", "lower"])
                blocks = []


def weights_of(gain: np.ndarray, seen: np.ndarray, expected: np.ndarray, size: np.ndarray, total: np.ndarray) -> np.ndarray:
    """The weight of the suffix's distribution in every context that passes the divergence test, 0 in the others.

    ``gain``: sum of n log(n / lower) over a context's frequent next words; ``seen``: sum of n; ``expected``: sum of
    lower; ``size``: their number; ``total``: how often the context occurs.
    """
    rest = total - seen
    with np.errstate(divide="ignore", invalid="ignore"):
        other = np.where(rest > 0, rest * np.log(rest / total / (1 - np.minimum(expected, 1 - 1e-9))), 0.0)
    passed = gain - seen * np.log(total) + other > 0.5 * (size + 1) * np.log(total)
    return np.where(passed, 1 - (seen - DISCOUNT * size) / total, 0.0)


def _counted(batches: Iterator[pa.RecordBatch], model: Model, k: int, last: bool) -> Iterator[pa.RecordBatch]:
    """Blocks in order of their part: the corpus counts of every block's pairs, and of each of its contexts that is a state
    how often a rare word follows it and how many frequent ones do (0 where it is none).

    A context of one part is tested here; for one of several parts this part's share of its sums goes on. Behind a context
    that is no state a pair's count makes no probability. It only tells whether the pair is a context of the next order or
    may have continuations there, so counts in between go as the least of them, and as 0 in the ``last`` order.
    """
    kinds = (pa.int64(), pa.int32(), pa.binary(), pa.int64(), pa.float64(), pa.float64(), pa.int64(), pa.float64(),
             pa.int64(), pa.int64())
    names = ["chunk", "part", "data", "context", "weight", "gain", "seen", "expected", "size", "total"]
    frequent = model.frequent if k == 1 else model.frequent[:0]
    for blocks in _by_part(batches):
        columns = list(zip(*blocks))[2:]
        words, totals, sizes, following, n, lower = ([widen(x) for x in column] for column in columns)
        words, totals, lower = ([from_near(x) for x in column] for column in (words, totals, lower))
        following = [from_climbs(x, size) for x, size in zip(following, sizes)]
        lower = [in_order(np.concatenate([frequent[np.sort(by[by < len(frequent)])], x]), by) for x, by in zip(lower, following)]
        contexts = [context_hash(x.view(np.uint64).reshape(k, -1)) for x in words]
        del words
        del columns
        size, each, totals = np.concatenate(sizes), np.concatenate(contexts), np.concatenate(totals)
        context, total = np.repeat(each, size), np.repeat(totals, size)
        lengths = [len(x) for x in following]
        _, first, pair = np.unique(followed(context, np.concatenate(following).view(np.uint64)), return_index=True, return_inverse=True)
        sums_ = np.bincount(pair, weights=np.concatenate(n)).astype(np.int64)
        sums_[sums_ < PAIR_COUNT] = 0
        some = sums_ > 0
        met, place, which = np.unique(context[first[some]], return_index=True, return_inverse=True)
        left, told = np.zeros((2, len(each)), np.int64)
        weighs = np.zeros(len(each), bool)
        if len(met):
            few, expect = sums_[some], np.concatenate(lower)[first[some]]
            expect = of_root(count_of(expect), model) if k == 1 else np.exp2(expect / -LOG_STEPS)
            shares = (np.bincount(which, few * np.log(few / expect)), np.bincount(which, few).astype(np.int64),
                      np.bincount(which, expect), np.bincount(which), total[first[some]][place])
            spread = _pieces(shares[-1], model) > 1
            weight = np.where(spread, 0.0, weights_of(*shares))
            go, known = _at(met, each)
            weighs = known & ((weight > 0) | spread)[go]
            known &= weight[go] > 0
            left = np.where(known, (shares[-1] - shares[1])[go], 0)
            told = np.where(known, shares[3][go], 0)
            for chosen, values in ((weight > 0, (weight, *[None] * 5)), (spread, (None, *shares))):
                if chosen.any():
                    yield pa.RecordBatch.from_arrays(
                        [*[pa.nulls(int(chosen.sum()), t) for t in kinds[:3]], pa.array(met[chosen].view(np.int64)),
                         *[pa.nulls(int(chosen.sum()), t) if x is None else pa.array(x[chosen], t) for x, t in zip(values, kinds[4:])]], names=names)
        answers, a, e = sums_[pair], 0, 0
        idle = ~np.repeat(weighs, size) & (last | (answers < CONTEXT_COUNT))
        answers[idle] = 0 if last else np.minimum(answers[idle], PAIR_COUNT)
        for block, rows, heads in zip(blocks, lengths, map(len, contexts)):
            row = (block[0], block[1], _answer(answers[a:a + rows], left[e:e + heads], told[e:e + heads]))
            a, e = a + rows, e + heads
            yield pa.RecordBatch.from_arrays([*[pa.array([x], t) for x, t in zip(row, kinds)],
                                              *[pa.nulls(1, t) for t in kinds[3:]]], names=names)


def _wide(counted: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Retained contexts of several parts, sorted, and their weights; at most 4 * parts rows come to the driver."""
    rows = (counted.where("total is not null").groupBy("context")
            .agg(*[F.sum(x).alias(x) for x in ("gain", "seen", "expected", "size")], F.max("total").alias("total"))
            .orderBy("context").toPandas())
    context = rows["context"].to_numpy(np.int64).view(np.uint64)
    weight = weights_of(*[rows[x].to_numpy(np.float64) for x in ("gain", "seen", "expected", "size", "total")])
    kept = weight > 0
    by = np.argsort(context[kept])
    return context[kept][by], weight[kept][by]


def train(encoded: DataFrame, depth: int = DEPTH) -> tuple[DataFrame, Model, list[DataFrame]]:
    """Fit the tree on encoded chunks; documents marked held out are not learned from.

    The chunks with the counts and states of every order, the sizes, and the retained contexts of every order.
    """
    spark = encoded.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    types, frequent = encoded.agg(F.max("types"), F.max("frequent")).first()
    ends = encoded.select("held_out", "sizes").select(F.explode(F.arrays_zip("held_out", "sizes")).alias("d"))
    tokens = ends.where(F.col("d.held_out") == F.lit(False)).agg(F.sum("d.sizes")).first()[0] or 0
    parts = PARTS * buckets
    model, states = Model(int(tokens), int(types or 0), parts), []
    if frequent:
        model = replace(model, frequent=_frequent(spark, frequent, parts))
    encoded = encoded.drop("types", "frequent")
    for k in range(1, depth + 1):
        blocks = (encoded.drop("doc_ids").mapInArrow(partial(_ask, model=model, k=k), BLOCK_SCHEMA)
                  .repartition(buckets, "part").sortWithinPartitions("part"))
        name = _table(blocks.mapInArrow(partial(_counted, model=model, k=k, last=k == depth), COUNTED_SCHEMA), f"counted{k}")
        counted = spark.table(name)
        wide = _wide(counted)
        model = replace(model, wide=(*model.wide, wide))
        several = spark.createDataFrame([(int(c), float(w)) for c, w in zip(wide[0].view(np.int64), wide[1])], "context long, weight double")
        states.append(spark.table(_table(counted.where("weight is not null").select("context", "weight").unionByName(several), f"states{k}")))
        level = spark.table(_table(_back(counted, k), f"order{k}", buckets)).withColumnRenamed("chunk", "_chunk")
        _drop(spark, [name])
        encoded = encoded.join(level, F.col("chunk") == F.col("_chunk"), "left").drop("_chunk")
    return encoded, model, states


def _score(batches: Iterator[pa.RecordBatch], model: Model, depth: int) -> Iterator[pa.RecordBatch]:
    for row in _rows(batches):
        sizes, starts, base = row["sizes"], row["starts"], None
        for p in map(itemgetter(1), _orders(row, model, depth)):  # an order is not held on to
            base = np.add.reduceat(np.log10(p), starts) if base is None else base
        yield pa.RecordBatch.from_arrays(
            [pa.array(row["doc_ids"], pa.int64()), pa.array(row["held_out"], pa.bool_()), pa.array(sizes),
             pa.array(sums((row["c"][row["words"]] > 0).astype(np.int64), sizes)),
             pa.array(np.full(len(sizes), model.tokens, np.int64)),
             pa.array(base), pa.array(np.add.reduceat(np.log10(p), starts))],
            names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])


def score(docs: DataFrame, learn: Column, doc_id: str = "doc_id", text: str = "text", depth: int = DEPTH,
          chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """One row per document: doc_id, held_out (not ``learn``), n_tokens, n_known, train_tokens, base_score, score."""
    encoded, model, _ = train(encode(docs, learn, ~learn, doc_id, text, chunk_bytes), depth)
    return encoded.mapInArrow(partial(_score, model=model, depth=depth),
                              "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
                              "base_score double, score double")


def learned(doc_id: str = "doc_id") -> Column:
    """Rows that the registered query learns from (crc32 of the id mod 10 is not 0; never a null id)."""
    return F.coalesce(F.pmod(crc32_of_id(doc_id), F.lit(10)) != 0, F.lit(False))
