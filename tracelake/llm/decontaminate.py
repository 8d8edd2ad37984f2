"""Operator 5: benchmark decontamination by winnowing, in DataFrame functions only.

Texts are cut into words (runs of ASCII letters and digits and of all
characters beyond ASCII, A-Z lower-cased). A winnowed text keeps the smallest
hash of every ``SPAN - GRAM + 1`` consecutive ``GRAM``-word hashes, so any
``SPAN`` words that two texts share leave a common hash. The hashes of the
training texts are joined to those of the benchmark; texts with a common hash
are candidates, and only their windows of ``SPAN`` words are compared with the
windows of the benchmark items, by a 128-bit hash. The words inside matching
windows, which overlap and so extend each other, are the hits.

Results depend on a text alone: every row's text is winnowed, but candidates are
extended once per distinct text (identified by a 128-bit hash), so thousands of
copies of a hit cost one.

Defined results: null and empty texts have no words and no hits; an item of
fewer than ``SPAN`` words, but not none, is one window of its own length (such
short windows cannot be winnowed; their lengths are looked up at every
position); items that share a window all count; repeated item rows count once;
an item of null id makes hits but is not counted or listed; empty tables give
no hits. ``items_sha256`` of no items is the digest of the empty text. Very long
texts are compared whole. Other columns, whatever their names, come back from
``remove_contaminated`` as they were; ``contamination`` does not look at them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tracelake.llm.common import cut, whole_rows

SPAN = 10
GRAM = 5
#: A side of at most this many bytes is broadcast; above it the join is shuffled.
BROADCAST_BYTES = 32 << 20
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: The same words before lower-casing.
ANY_CASE_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words(text: Column) -> Column:
    """Words of a text. ``lower`` does for pure ASCII; ``translate`` is slower but leaves other letters alone."""
    ascii_only = F.octet_length(text) == F.length(text)
    small = F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, _UPPER, _LOWER))
    return F.regexp_extract_all(small, F.lit(WORD), F.lit(0))


def text_key(text: Column) -> Column:
    """128-bit identity of a text."""
    return F.struct(F.xxhash64(text).alias("k1"), F.xxhash64(F.lit(7), text).alias("k2"))


def _grams(hashes: str, size: int, *salt: Column) -> Column:
    """Hash of every run of ``size`` elements of a hash array."""
    h = F.col(hashes)
    return F.transform(F.slice(h, F.lit(1), F.greatest(F.size(h) - F.lit(size - 1), F.lit(0))),
                       lambda x, i: F.xxhash64(*salt, x, *[F.get(h, i + F.lit(j)) for j in range(1, size)]))


def _winnowed(grams: str, width: int) -> Column:
    """Distinct minima of every ``width`` consecutive elements."""
    g = F.col(grams)
    least = (lambda x, i: F.least(x, *[F.get(g, i + F.lit(j)) for j in range(1, width)])) if width > 1 else (lambda x, i: x)
    return F.array_distinct(F.transform(
        F.slice(g, F.lit(1), F.greatest(F.size(g) - F.lit(width - 1), F.lit(0))), least))


def fingerprints(texts: DataFrame, keep: list[str], lengths: list[int], span: int, gram: int) -> DataFrame:
    """Rows (keep..., len, fp): winnowed hashes under ``len`` = span, all hashes of ``len`` words for short windows.

    ``texts`` has an array column ``w`` of words.
    """
    hashed = texts.select(*keep, F.transform("w", lambda x: F.xxhash64(x)).alias("h"))
    gridded = hashed.select("*", _grams("h", gram).alias("g"))
    lists = [F.struct(F.lit(span).alias("len"), _winnowed("g", span - gram + 1).alias("fps"))]
    lists += [F.struct(F.lit(n).alias("len"), F.array_distinct(_grams("h", n)).alias("fps")) for n in lengths if n < span]
    if len(lists) == 1:
        return gridded.select(*keep, F.lit(span).alias("len"), F.explode(_winnowed("g", span - gram + 1)).alias("fp"))
    return (gridded.select(*keep, F.explode(F.array(*lists)).alias("l"))
            .select(*keep, F.col("l.len").alias("len"), F.explode("l.fps").alias("fp")))


def windows(texts: DataFrame, keep: list[str], lengths: list[int]) -> DataFrame:
    """Rows (keep..., len, pos, g1, g2): every window of the given lengths, as a 128-bit hash."""
    hashed = texts.select(*keep, F.transform("w", lambda x: F.xxhash64(x)).alias("h"),
                          F.transform("w", lambda x: F.xxhash64(F.lit(7), x)).alias("h7"))
    lists = F.array(*[F.struct(F.lit(n).alias("len"), F.arrays_zip(
        _grams("h", n).alias("g1"), _grams("h7", n, F.lit(7)).alias("g2")).alias("gs")) for n in lengths])
    return (hashed.select(*keep, F.explode(lists).alias("l"))
            .select(*keep, F.col("l.len").alias("len"), F.posexplode("l.gs").alias("pos", "g"))
            .select(*keep, "len", "pos", F.col("g.g1").alias("g1"), F.col("g.g2").alias("g2")))


def _small(df: DataFrame, row_bytes: int, limit: int) -> DataFrame:
    """A checkpointed table of fixed-width rows, marked for broadcast if its size allows."""
    return F.broadcast(df) if df.count() * row_bytes <= limit else df


def hits(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text",
         span: int = SPAN, gram: int = GRAM, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """One row per distinct contaminated text: k1, k2, n_hit, n_items, items (sorted ids as text), checkpointed."""
    items = benchmark.select(F.col(item_id).alias("item_id"), F.coalesce(words(F.col(item_text)), F.array()).alias("w"))
    items = cut(items.where(F.size("w") > 0).select("item_id", "w", F.least(F.size("w"), F.lit(span)).alias("len")))
    lengths = sorted(r[0] for r in items.select("len").distinct().collect())  # at most ``span`` values
    short = [n for n in lengths if n < span]
    marks = cut(fingerprints(items, [], [], span, gram)
                .unionByName(_own_windows(items.where(F.col("len") < span), short)).distinct())
    texts = docs.select(F.col(text).alias("t")).where(F.col("t").isNotNull())
    keyed = texts.select(text_key(F.col("t")).alias("k"), words(F.col("t")).alias("w")).select("k.k1", "k.k2", "w")
    shared = (fingerprints(keyed, ["k1", "k2"], short, span, gram)
              .join(_small(marks, 24, broadcast_bytes), ["len", "fp"], "left_semi"))
    found = cut(shared.select("k1", "k2").distinct())
    # Whole texts of the candidates, one of each.
    whole = (texts.select(text_key(F.col("t")).alias("k"), "t").select("k.k1", "k.k2", "t")
             .join(_small(found, 32, broadcast_bytes), ["k1", "k2"], "left_semi")
             .groupBy("k1", "k2").agg(F.first("t").alias("t")))
    spans = windows(whole.select("k1", "k2", words(F.col("t")).alias("w")), ["k1", "k2"], lengths or [span])
    grams = cut(windows(items.withColumnRenamed("len", "own"), ["item_id", "own"], lengths or [span])
                .where("len = own").select("item_id", "len", "g1", "g2").distinct())
    # One row per window that is in the benchmark, whatever the number of its items.
    known = cut(grams.select("len", "g1", "g2").distinct())
    hit = cut(spans.join(_small(known, 40, broadcast_bytes), ["len", "g1", "g2"], "left_semi"))
    before = Window.partitionBy("k1", "k2").orderBy("pos", "len").rowsBetween(Window.unboundedPreceding, -1)
    covered = (hit.groupBy("k1", "k2", "pos").agg(F.max("len").alias("len"))
               .withColumn("from", F.greatest(F.col("pos"), F.coalesce(F.max(F.col("pos") + F.col("len")).over(before), F.lit(0))))
               .groupBy("k1", "k2").agg(F.sum(F.greatest(F.col("pos") + F.col("len") - F.col("from"), F.lit(0))).alias("n_hit")))
    listed = (hit.select("k1", "k2", "len", "g1", "g2").distinct().join(grams.where("item_id is not null"), ["len", "g1", "g2"])
              .select("k1", "k2", F.col("item_id").cast("string").alias("item_id")).distinct()
              .groupBy("k1", "k2").agg(F.array_sort(F.collect_list("item_id")).alias("items")))
    return cut(covered.join(listed, ["k1", "k2"], "left").select(
        "k1", "k2", F.col("n_hit").cast("long").alias("n_hit"),
        F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items")))


def _own_windows(items: DataFrame, lengths: list[int]) -> DataFrame:
    """(len, fp) of items shorter than the span: the hash of the whole item."""
    hashed = items.select("len", F.transform("w", lambda x: F.xxhash64(x)).alias("h"))
    whole = F.lit(None).cast("long")
    for n in lengths:
        whole = F.when(F.col("len") == n, F.get(_grams("h", n), F.lit(0))).otherwise(whole)
    return hashed.select("len", whole.alias("fp"))


def contamination(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, n_items, items, contaminated."""
    found = hits(docs, benchmark, text, **options)
    slim = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("t")).select(
        "doc_id", text_key(F.col("t")).alias("k"), F.coalesce(F.regexp_count("t", F.lit(ANY_CASE_WORD)), F.lit(0)).cast("long").alias("n_words"))
    return slim.select("doc_id", "k.k1", "k.k2", "n_words").join(found, ["k1", "k2"], "left").select(
        "doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"))


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text",
                        broadcast_bytes: int = BROADCAST_BYTES, **options) -> DataFrame:
    """The documents without a hit, with their own columns."""
    found = hits(docs, benchmark, text, broadcast_bytes=broadcast_bytes, **options).select(
        F.struct("k1", "k2").alias("hit"))
    rows = whole_rows(docs).join(_small(found, 48, broadcast_bytes), text_key(F.col(f"row.{text}")) == F.col("hit"), "left_anti")
    return rows.select("row.*")
