"""Phrase collocations per language from sorted count streams.

Counting goes level by level: a window of m words is counted only if both windows of m - 1 words in it are
frequent, as a phrase is never more frequent than its parts. Which windows those are, tasks read from a bit
table of fixed size that holds hashes of the frequent ones of the level below: a clash lets a window be
counted in vain, it never loses or changes a count. Pairs, most of which are rare, pass a sieve first that
sums under 64-bit hashes instead of words; what it lets through is counted by its words.

The frequent phrases of all lengths are then kept as streams in two orders. Every cut of a phrase names a
prefix and a rest: the stream of cuts in prefix order is merge-joined with the phrases for the left counts,
in suffix order for the right counts, and the cuts next to either end, merged by what they extend, give the
largest extension of each phrase. All three are sort-merge joins on whole words; no hash tables of phrases.

Null text is empty and counts nothing, null languages are ``und``; ids are not read, so repeated or null ones
and repeated rows all count; ties are settled by the phrase, so every result is the only one. An empty table
gives an empty result. Other columns are not read. Texts are read in blocks of some 8 MB that end where a
piece ends, so a text of any length takes a block's memory (a single piece longer than that: its own).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import stage

MIN_COUNT = 100
LONGEST = 5
PER_LANG = 2_000
#: log2 of the bits in the table of frequent windows: 8 MiB whatever the corpus.
TABLE_BITS = 26
BLOCK = 8 << 20
#: Parts that a language's ranking is made in before the last one.
SALTS = 64
#: How bytes read: A-Z small; what ends a piece as a line feed; a tab as a space. A separator never lies inside a character.
_READ = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ\t.,;:!?\x0b\x0c\r", b"abcdefghijklmnopqrstuvwxyz \n\n\n\n\n\n\n\n\n")
_SPACE, _END = 32, 10
COUNTS = T.StructType([T.StructField("lang", T.StringType()), T.StructField("phrase", T.StringType()), T.StructField("a", T.LongType())])
SIEVED = T.StructType([T.StructField("h", T.LongType()), T.StructField("a", T.LongType())])
MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


def _blocks(batch: pa.RecordBatch) -> Iterator[tuple[str, bytes]]:
    """``(language, text as read)`` in blocks that end with a piece."""
    langs, texts = batch.column(0).dictionary_encode(), batch.column(1).cast(pa.binary())
    for code, lang in enumerate(langs.dictionary.to_pylist()):
        held, size = [], 0
        for text in texts.filter(pc.equal(langs.indices, code)):
            text = text.as_py().translate(_READ)
            start = 0
            while len(text) - start > BLOCK:
                end = text.find(b"\n", start + BLOCK)
                if end < 0:
                    break
                yield lang, text[start:end]
                start = end
            held.append(text[start:] if start else text)
            size += len(held[-1])
            if size > BLOCK:
                yield lang, b"\n".join(held)
                held, size = [], 0
        if size:
            yield lang, b"\n".join(held)


def _words(block: bytes) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """Codes of the words in order, the distinct words, and the number of the piece of each."""
    raw = np.frombuffer(block, dtype=np.uint8)
    inside = np.zeros(len(raw) + 2, dtype=np.int8)
    inside[1:-1] = (raw != _SPACE) & (raw != _END)
    edges = np.flatnonzero(np.diff(inside)).astype(np.int64 if len(raw) >> 31 else np.int32)
    if not len(edges):
        return np.zeros(0, np.int64), pa.array([], pa.binary()), np.zeros(0, np.int64)
    kind = pa.large_binary() if edges.dtype == np.int64 else pa.binary()
    # Words and the gaps between them in turn; every other one is a word.
    both = pa.Array.from_buffers(kind, len(edges) - 1, [None, pa.py_buffer(edges), pa.py_buffer(block)])
    coded = both.take(pa.array(np.arange(0, len(both), 2))).dictionary_encode()
    piece = np.searchsorted(np.flatnonzero(raw == _END), edges[::2])
    return coded.indices.to_numpy().astype(np.int64), coded.dictionary, piece


def _hash_words(lang: str, words: pa.Array) -> np.ndarray:
    seed = xxhash.xxh64_intdigest(lang.encode())
    return np.array([xxhash.xxh64_intdigest(w, seed) for w in words.to_pylist()], dtype=np.uint64)


def _grow(h: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Hashes of windows that grow by one word."""
    h = (h ^ (h >> np.uint64(31))) * MIX[0] + word
    return (h ^ (h >> np.uint64(29))) * MIX[1]


def _place(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(64 - TABLE_BITS)).astype(np.int64)


def _table_of(places: DataFrame) -> np.ndarray:
    """Bit table of the ``place`` column: at most ``2^TABLE_BITS / 32768`` rows of 4 KiB come to the driver."""
    bit = F.col("place") + 1
    rows = places.groupBy(F.bitmap_bucket_number(bit).alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(bit)).alias("bits"))
    table = np.zeros((1 << TABLE_BITS) // 8, dtype=np.uint8)
    for r in rows.collect():
        table[(r.bucket - 1) * 4096 : r.bucket * 4096] = np.frombuffer(r.bits, dtype=np.uint8)
    return table


def _held(table: np.ndarray, h: np.ndarray) -> np.ndarray:
    at = _place(h)
    return (table[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1


def _places(counts: DataFrame, m: int) -> DataFrame:
    """Where phrases of ``m`` words stand in the bit table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = batch.column(0).dictionary_encode()
            for code, lang in enumerate(langs.dictionary.to_pylist()):
                phrases = batch.column(1).filter(pc.equal(langs.indices, code)).cast(pa.binary())
                coded = pc.split_pattern(phrases, b" ").flatten().dictionary_encode()
                h = _hash_words(lang, coded.dictionary)[coded.indices.to_numpy()].reshape(-1, m)
                grown = h[:, 0]
                for k in range(1, m):
                    grown = _grow(grown, h[:, k])
                if m == 1:
                    grown = _grow(grown, np.zeros(len(grown), np.uint64))
                yield pa.RecordBatch.from_arrays([pa.array(_place(grown))], names=["place"])

    return counts.select("lang", "phrase").mapInArrow(run, "place long")


def _windows(ids: np.ndarray, piece: np.ndarray, m: int) -> np.ndarray:
    """Starts of the windows of ``m`` words inside one piece."""
    if len(ids) < m:
        return np.zeros(0, np.int64)
    return np.flatnonzero(piece[: len(piece) - m + 1] == piece[m - 1 :])


def _passing(h: np.ndarray, starts: np.ndarray, m: int, below: np.ndarray) -> np.ndarray:
    """Of the windows of ``m`` words those whose two windows of ``m - 1`` are in the table."""
    if m == 2:
        ok = _held(below, _grow(h, np.zeros(len(h), np.uint64)))
        return starts[ok[starts] & ok[starts + 1]]
    left, right = h[starts], h[starts + 1]
    for k in range(1, m - 1):
        left, right = _grow(left, h[starts + k]), _grow(right, h[starts + k + 1])
    return starts[_held(below, left) & _held(below, right)]


def _sieve(rows: DataFrame, words: np.ndarray, min_count: int) -> DataFrame:
    """``place`` of every pair that may be frequent: sums under 64-bit hashes, one row per pair and block."""
    shared = rows.sparkSession.sparkContext.broadcast(words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang, block in _blocks(batch):
                ids, distinct, piece = _words(block)
                h = _hash_words(lang, distinct)[ids]
                starts = _passing(h, _windows(ids, piece, 2), 2, shared.value)
                pairs, n = np.unique(_grow(h[starts], h[starts + 1]), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(pairs.view(np.int64)), pa.array(n.astype(np.int64))], names=["h", "a"])

    sums = rows.mapInArrow(run, SIEVED).groupBy("h").agg(F.sum("a").alias("a")).filter(F.col("a") >= min_count)
    return sums.select(F.shiftrightunsigned("h", 64 - TABLE_BITS).alias("place"))


def _count(rows: DataFrame, m: int, below: np.ndarray | None, own: np.ndarray | None = None) -> DataFrame:
    """``(lang, phrase, a)`` of the windows of ``m`` words: all words, or what the tables let pass."""
    spark = rows.sparkSession
    shared, sieve = spark.sparkContext.broadcast(below), spark.sparkContext.broadcast(own)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang, block in _blocks(batch):
                ids, distinct, piece = _words(block)
                if m == 1:
                    phrases, n = distinct, np.bincount(ids, minlength=len(distinct))
                else:
                    h = _hash_words(lang, distinct)[ids]
                    starts = _passing(h, _windows(ids, piece, m), m, shared.value)
                    if sieve.value is not None:
                        starts = starts[_held(sieve.value, _grow(h[starts], h[starts + 1]))]
                    key = ids[starts]
                    for k in range(1, m):
                        key, first, back, n = np.unique(
                            key * len(distinct) + ids[starts + k], return_index=True, return_inverse=True, return_counts=True
                        )
                        key = back if k < m - 1 else key
                    parts = [distinct.take(pa.array(ids[starts[first] + k])) for k in range(m)]
                    phrases = pc.binary_join_element_wise(*parts, pa.scalar(b" ", parts[0].type))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(phrases), pa.string()), phrases.cast(pa.string()), pa.array(n, pa.int64())], names=COUNTS.names
                )

    return rows.mapInArrow(run, COUNTS).groupBy("lang", "phrase").agg(F.sum("a").alias("a"))


def frequent_phrases(
    docs: DataFrame, min_count: int = MIN_COUNT, longest: int = LONGEST, text_col: str = "text", lang_col: str = "lang"
) -> tuple[DataFrame, DataFrame]:
    """``(lang, n)`` of all words, and ``(lang, words, phrase, a)`` of every phrase of up to ``longest`` words found
    ``min_count`` times or more, single words included; both written to the shared folder."""
    rows = docs.select(
        F.coalesce(F.col(lang_col), F.lit("und")).alias("lang"), F.coalesce(F.col(text_col), F.lit("")).alias("text")
    )
    counts = stage(_count(rows, 1, None))
    totals = stage(counts.groupBy("lang").agg(F.sum("a").alias("n")))
    enough = F.col("a") >= min_count
    words = counts.filter(enough)
    levels, below = [words.withColumn("words", F.lit(1))], _table_of(_places(words, 1))
    for m in range(2, longest + 1):
        if not below.any():
            break
        own = _table_of(_sieve(rows, below, min_count)) if m == 2 else None
        found = stage(_count(rows, m, below, own).filter(enough))
        levels.append(found.withColumn("words", F.lit(m)))
        below = _table_of(_places(found, m))
    phrases = levels[0]
    for level in levels[1:]:
        phrases = phrases.unionByName(level)
    return totals, phrases.select("lang", "words", "phrase", "a")


def _cuts(phrases: DataFrame) -> DataFrame:
    """A row per phrase and cut: what stands before it and after it."""
    cut = F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k")
    first = F.expr("substring_index(phrase, ' ', k)")
    rest = F.expr("substring_index(phrase, ' ', k - words)")
    return phrases.filter("words > 1").select("lang", "phrase", "words", "a", cut).withColumns({"first": first, "rest": rest})


def _with_count(stream: DataFrame, phrases: DataFrame, key: str, count: str) -> DataFrame:
    """Lockstep merge of a stream, in the order of ``key``, with the phrases in their own."""
    own = phrases.select("lang", F.col("phrase").alias(key), F.col("a").alias(count))
    return stream.join(own.hint("merge"), ["lang", key])


def collocations(
    docs: DataFrame, min_count: int = MIN_COUNT, longest: int = LONGEST, per_lang: int = PER_LANG, share: int = 100,
    text_col: str = "text", lang_col: str = "lang",
) -> DataFrame:
    """``(lang, rank, phrase, a, l, r, n, score)``: each language's ``per_lang`` best phrases.

    share  a phrase goes if a longer one that holds it has at least this many hundredths of its count
    """
    totals, phrases = frequent_phrases(docs, min_count, longest, text_col, lang_col)
    cuts = _cuts(phrases)
    prefix_order = _with_count(cuts, phrases, "first", "l")
    both = _with_count(prefix_order, phrases, "rest", "r").join(totals, "lang")
    score = F.expr("cast(1000 as decimal(38,0)) * a * n div (cast(l as decimal(38,0)) * r)")
    worst = both.groupBy("lang", "phrase").agg(
        F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut"), F.first("a").alias("a"), F.first("n").alias("n")
    )
    # A phrase inside a longer one is inside one that is longer by a word and at least as frequent as that one.
    at_left, at_right = F.col("k") == F.col("words") - 1, F.col("k") == 1
    ends = cuts.filter(at_left).select("lang", F.col("first").alias("phrase"), "a").unionByName(
        cuts.filter(at_right).select("lang", F.col("rest").alias("phrase"), "a")
    )
    longer = ends.groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    kept = worst.join(longer.hint("merge"), ["lang", "phrase"], "left").filter(
        F.col("longer").isNull() | (100 * F.col("longer") < share * F.col("a"))
    )
    flat = kept.select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")
    best = [F.col("score").desc(), F.col("a").desc(), "phrase"]
    salted = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(SALTS))).orderBy(*best)
    few = flat.withColumn("__nth", F.row_number().over(salted)).filter(F.col("__nth") <= per_lang).drop("__nth")
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*best)).cast("long")
    return few.withColumn("rank", rank).filter(F.col("rank") <= per_lang).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
