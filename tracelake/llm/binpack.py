"""Operator 8: token ids in a fixed-width bit-packed file format.

Documents are tokenized, an end id is appended to each, and the ids are laid
out in ascending order of doc_id, each in the minimum number of bits that the
vocabulary needs. The format is a Parquet table of blocks, written by Spark
itself (so a lost executor leaves no half-written file and any file system
that Spark knows will do):

``part``, ``block``  place of the block: range of ids, and number within it
``start``            ids before the block within its part
``n_ids``, ``bits``  ids in the block and bits of each
``first_id``, ``last_id``  doc_ids of its first and last document
``doc_ids``, ``ends``  its documents and where each ends in the block
``payload``          the ids: 64 ids fill ``bits`` little-endian 64-bit words

A reader that wants one document reads the row groups whose doc_id range
holds it and unpacks only the words its ids lie in; whole blocks are unpacked
with one vectorised numpy pass per id of a group of 64.

Only distinct words are encoded: the tokenizer must split text at ASCII white
space, so that a text's ids are the ids of its words (checked by the tests
against the library on whole texts). A worker remembers a bounded number of
pieces of words. The driver reads the tokenizer's file and sends its text to the
tasks, so executors need no copy.

Defined results: a null or empty text is the end id alone; rows without a
doc_id come first; rows with one doc_id are ordered by a hash of their text
and then the text; an empty table gives an empty file and no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import partial
from itertools import chain
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tracelake.llm.common import held, new_table, ship

#: A block is closed when it holds this many ids (one document at least).
BLOCK_IDS = 1 << 17
#: Pieces of words a worker remembers before it starts afresh (about 200 bytes each).
REMEMBERED_PIECES = 120_000
#: Text encoded at once (bytes).
RUN_BYTES = 2 << 20
BLOCK_SCHEMA = ("part int, block int, start long, n_ids int, bits int, first_id long, last_id long, "
                "doc_ids array<bigint>, ends array<int>, payload binary")


def pack(ids: np.ndarray, bits: int) -> bytes:
    """Fixed-width packing; the last group of 64 ids is filled with zeros."""
    groups = -(-len(ids) // 64)
    grid = np.zeros((groups, 64), np.uint64)
    grid.ravel()[:len(ids)] = ids
    out = np.zeros((groups, bits), np.uint64)
    for j in range(64):
        word, shift = divmod(j * bits, 64)
        out[:, word] |= grid[:, j] << np.uint64(shift)
        if shift + bits > 64:
            out[:, word + 1] |= grid[:, j] >> np.uint64(64 - shift)
    return out.astype("<u8").tobytes()


def unpack(payload: bytes, bits: int, start: int, stop: int) -> np.ndarray:
    """Ids start..stop of a payload; only the groups they lie in are read."""
    first, last = start // 64, -(-stop // 64)
    words = np.frombuffer(payload, "<u8", (last - first) * bits, first * bits * 8).reshape(-1, bits)
    grid = np.empty((len(words), 64), np.uint64)
    mask = np.uint64((1 << bits) - 1)
    for j in range(64):
        word, shift = divmod(j * bits, 64)
        value = words[:, word] >> np.uint64(shift)
        if shift + bits > 64:
            value = value | words[:, word + 1] << np.uint64(64 - shift)
        grid[:, j] = value & mask
    return grid.ravel()[start - first * 64:stop - first * 64].astype(np.uint32)


def _byte_letters() -> list[str]:
    """The byte-level pre-tokenizer's character for every byte: itself where it prints, else one from U+0100 on."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(0x100, 0x200))
    return [chr(b) if b in printable else chr(next(others)) for b in range(256)]


#: Latin letters that the normalizer leaves whole and lower-cases one to one; what follows them may be any ASCII but a letter.
_LETTERS_THEN = r"^(?P<letters>[A-Za-z\x{C0}-\x{D6}\x{D8}-\x{F6}\x{F8}-\x{FF}]+)(?P<rest>[!-@\[-`{-~][!-~]*)?$"


class WordEncoder:
    """Ids of texts, from the ids of their distinct words.

    Arrow splits a run of texts into words and numbers the distinct ones. A
    word of Latin letters, with or without other ASCII characters behind them,
    is two pieces: no token spans the border, so each is encoded by itself and
    remembered, the letters by the model directly. All other words go to the
    tokenizer whole. Python sees distinct pieces alone; the ids are laid out by
    numpy.
    """

    def __init__(self, tokenizer: str, end_id: int):
        """``tokenizer``: the file's path, or its text."""
        self.tokenizer = Tokenizer.from_str(tokenizer) if tokenizer.lstrip()[:1] == "{" else Tokenizer.from_file(tokenizer)
        self.size = max(self.tokenizer.get_vocab_size(with_added_tokens=True), end_id + 1)
        self.byte_letters = _byte_letters()
        self.end_id = end_id
        self.forget()
        # A tokenizer that does not lower-case and split like this one is always asked whole, as a few probes tell.
        probes = ("Word", "\u00c9t\u00e9", "a", "I")
        self.direct = all(list(self._letters(w.lower())) == self._whole(w) for w in probes) and all(
            self._whole(w + r) == self._whole(w) + self._whole(r) for w in probes for r in (".", "'s", "&&a", "12"))

    def forget(self) -> None:
        # Ids of piece n: flat[starts[n]:][:lengths[n]]. Number 0 is no piece, number 1 the end of a document.
        self.index: dict[tuple[bool, str] | str, int] = {}
        self.flat = np.array([self.end_id], np.uint32)
        self.starts, self.lengths = np.array([0, 0], np.int64), np.array([0, 1], np.int64)

    def _letters(self, small: str) -> list[int]:
        spelled = small if small.isascii() else "".join(map(self.byte_letters.__getitem__, small.encode()))
        return [t.id for t in self.tokenizer.model.tokenize(spelled)]

    def _whole(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _pieces(self, texts: pa.Array, letters: bool) -> np.ndarray:
        """Numbers of the pieces of an array, null as 0."""
        coded = texts.dictionary_encode()
        names = coded.dictionary.to_pylist()
        keys = names if letters else [(False, n) for n in names]
        numbers = list(map(self.index.get, keys))
        fresh = [i for i, n in enumerate(numbers) if n is None]
        if fresh:
            ids = list(map(self._letters if letters else self._whole, [names[i] for i in fresh]))
            lengths = np.fromiter(map(len, ids), np.int64, len(ids))
            first = len(self.lengths)
            for n, i in enumerate(fresh, first):
                numbers[i] = self.index[keys[i]] = n
            self.starts = np.concatenate([self.starts, len(self.flat) + np.cumsum(lengths) - lengths])
            self.lengths = np.concatenate([self.lengths, lengths])
            self.flat = np.concatenate([self.flat, np.fromiter(chain.from_iterable(ids), np.uint32, int(lengths.sum()))])
        table = np.append(np.array(numbers, np.int64), 0)  # the last one for null
        return table[coded.indices.fill_null(len(names)).to_numpy()]

    def _laid_out(self, pieces: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of a row of pieces, and how many each has."""
        lengths = self.lengths[pieces]
        return _gather(self.flat, self.starts[pieces], lengths), lengths

    def _words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct words, and how many each has."""
        pieces = np.zeros((len(words), 2), np.int64)
        if self.direct:
            parts = pc.extract_regex(words, _LETTERS_THEN)
            cut = parts.is_valid().to_numpy(zero_copy_only=False)
            letters, rest = (parts.field(i).filter(pa.array(cut)) for i in (0, 1))
            rest = pc.if_else(pc.equal(rest, ""), None, rest)
            pieces[cut, 0] = self._pieces(pc.utf8_lower(letters), letters=True)
            pieces[cut, 1] = self._pieces(rest, letters=False)
        else:
            cut = np.zeros(len(words), bool)
        pieces[~cut, 0] = self._pieces(words.filter(pa.array(~cut)), letters=False)
        ids, lengths = self._laid_out(pieces.ravel())
        return ids, lengths.reshape(-1, 2).sum(axis=1)

    def encode(self, texts: pa.Array | list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, end ids included, and where each text ends."""
        if len(self.index) > REMEMBERED_PIECES:
            self.forget()
        if not isinstance(texts, pa.Array):
            texts = pa.array([t.decode() for t in texts], pa.string())
        words = pc.ascii_split_whitespace(texts)
        coded = words.flatten().dictionary_encode()
        ids, lengths = self._words(coded.dictionary)
        # One more word, the end of a document, behind the words of every text.
        ids, lengths = np.append(ids, np.uint32(self.end_id)), np.append(lengths, 1)
        starts = np.cumsum(lengths) - lengths
        stops = np.diff(words.offsets.to_numpy()).cumsum() + np.arange(1, len(texts) + 1) if len(texts) else np.empty(0, np.int64)
        row = np.full(len(coded) + len(texts), len(lengths) - 1, np.int32)
        inner = np.ones(len(row), bool)
        inner[stops - 1] = False
        row[inner] = coded.indices.to_numpy()
        sizes = lengths[row]
        return _gather(ids, starts[row], sizes), np.cumsum(sizes)[stops - 1]


def _gather(flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """flat[start:start + length] of every row, one behind the other."""
    stops = np.cumsum(lengths)
    total = int(stops[-1]) if len(stops) else 0
    at = np.repeat(starts - stops + lengths, lengths)
    at += np.arange(total)
    return flat[at]


def _runs(texts: pa.Array, limit: int) -> Iterator[tuple[int, int]]:
    """Consecutive texts of about ``limit`` bytes (one at least)."""
    stops, a = np.cumsum(pc.binary_length(texts).to_numpy(), dtype=np.int64), 0
    while a < len(stops):
        b = max(a + 1, int(np.searchsorted(stops, (stops[a - 1] if a else 0) + limit, "right")))
        yield a, b
        a = b


def _blocks(batches: Iterator[pa.RecordBatch], tokenizer: str, end_id: int) -> Iterator[pa.RecordBatch]:
    part, block, before = TaskContext.get().partitionId(), 0, 0
    enc = held(("encoder", zlib.crc32(tokenizer.encode()), end_id), lambda: WordEncoder(tokenizer, end_id))
    bits = max(1, (enc.size - 1).bit_length())
    schema = pa.schema([("part", pa.int32()), ("block", pa.int32()), ("start", pa.int64()), ("n_ids", pa.int32()),
                        ("bits", pa.int32()), ("first_id", pa.int64()), ("last_id", pa.int64()),
                        ("doc_ids", pa.list_(pa.int64())), ("ends", pa.list_(pa.int32())), ("payload", pa.binary())])
    for batch in batches:
        doc_ids = batch.column(0).to_pylist()
        for a, b in _runs(batch.column(1), RUN_BYTES):
            ids, ends = enc.encode(batch.column(1)[a:b])
            first = 0
            while first < b - a:
                base = int(ends[first - 1]) if first else 0
                last = max(first + 1, int(np.searchsorted(ends, base + BLOCK_IDS, "right")))
                stop, names = int(ends[last - 1]), doc_ids[a + first:a + last]
                row = {"part": part, "block": block, "start": before, "n_ids": stop - base, "bits": bits,
                       "first_id": names[0], "last_id": names[-1], "doc_ids": names,
                       "ends": (ends[first:last] - base).tolist(), "payload": pack(ids[base:stop], bits)}
                yield pa.RecordBatch.from_pylist([row], schema=schema)
                block, before, first = block + 1, before + stop - base, last
            del ids, ends
        # A batch's memory goes back before the next one comes.
        del batch, doc_ids
        pa.default_memory_pool().release_unused()


def write_ids(docs: DataFrame, path: str, tokenizer: str, end_id: int, doc_id: str = "doc_id", text: str = "text") -> str:
    """Encode ``docs`` with the tokenizer of the file ``tokenizer`` and write the blocks to ``path``.

    The driver reads the file; its text goes to the tasks.
    """
    ship(docs.sparkSession)
    model = Path(tokenizer).read_text(encoding="utf-8")
    order = [F.col("doc_id").asc_nulls_first(), F.col("h")]
    rows = (docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
            .withColumn("h", F.xxhash64("text"))
            .repartitionByRange(*order).sortWithinPartitions(*order, "text").select("doc_id", "text"))
    rows.mapInArrow(partial(_blocks, tokenizer=model, end_id=end_id), BLOCK_SCHEMA).write.mode("error").parquet(path)
    return path


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            ids = unpack(row["payload"], row["bits"], 0, row["n_ids"]).astype("<u4")
            ends = np.array(row["ends"], np.int64)
            starts = np.r_[0, ends[:-1]]
            raw = memoryview(ids.tobytes())
            yield pa.RecordBatch.from_arrays(
                [pa.array(row["doc_ids"], pa.int64()), pa.array(row["base"] + row["start"] + starts), pa.array(ends - starts),
                 pa.array([zlib.crc32(raw[4 * s:4 * e]) for s, e in zip(starts, ends)], pa.int64())],
                names=["doc_id", "start", "n_tokens", "ids_crc32"])


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """One row per document, from the files: doc_id, start, n_tokens, ids_crc32."""
    ship(spark)
    blocks = spark.read.schema(BLOCK_SCHEMA).parquet(path)
    # One row per part, however many blocks: as many as the writing job had tasks.
    parts = blocks.groupBy("part").agg(F.sum("n_ids").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = parts.select(F.col("part").alias("_part"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    return (blocks.select("part", "start", "n_ids", "bits", "doc_ids", "ends", "payload")
            .join(F.broadcast(bases), F.col("part") == F.col("_part"))
            .select("base", "start", "n_ids", "bits", "doc_ids", "ends", "payload")
            .mapInArrow(_documents, "doc_id long, start long, n_tokens long, ids_crc32 long"))


def read_document(spark: SparkSession, path: str, doc_id: int) -> list[np.ndarray]:
    """Random access: the ids of every document of that id (the scan skips blocks by their id range).

    All rows of that one id come to the caller; ``read_index`` is the way to read many.
    """
    rows = (spark.read.schema(BLOCK_SCHEMA).parquet(path).where((F.col("first_id") <= doc_id) & (F.col("last_id") >= doc_id))
            .orderBy("part", "block").collect())
    out = []
    for row in rows:
        starts = [0, *row["ends"][:-1]]
        out += [unpack(bytes(row["payload"]), row["bits"], s, e)
                for d, s, e in zip(row["doc_ids"], starts, row["ends"]) if d == doc_id]
    return out


def write_and_index(docs: DataFrame, tokenizer: str, end_id: int, path: str | None = None) -> DataFrame:
    """Write the ids of ``docs`` to a fresh table and read it back."""
    spark = docs.sparkSession
    return read_index(spark, write_ids(docs, path or new_table(spark, "ids"), tokenizer, end_id))
