"""Vocabularies: word counts, byte-pair merges, id tables."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import fixed
from ..functions.arrays import TEXT_RUN, small_parts
from ..functions.text import normalize_nfc
from ..session import stage
from .merges import LOOK, bytes_of, learn_merges, weighed
from .sample import top_k

WORDS = T.StructType([T.StructField("word", T.StringType()), T.StructField("n", T.LongType())])


#: Pre-tokens of the text layout: a word with the space before it, a run of spaces but that one, any other blank by
#: itself, and a word mark that the text holds.
TEXT_UNITS = re.compile(f" ?[^\\s{fixed.WORD_MARK}]+| +(?= [^\\s{fixed.WORD_MARK}])| +|\\s|{fixed.WORD_MARK}")


def pad_specials(c: Column, specials: Sequence[str], pretok: str = "word") -> Column:
    """Set special strings apart: by spaces between words, by line breaks between lines."""
    gap = " " if pretok == "word" else "\n"
    for special in specials:
        c = F.replace(c, F.lit(special), F.lit(gap + special + gap))
    return c


def split_pretokens(texts: pa.Array, pretok: str, specials: Sequence[str] = ()) -> pa.Array:
    """Units inside which pieces form, a list per text: words between white space, whole lines, or the units of
    ``TEXT_UNITS`` around the specials, which keep every character. Lists may hold empty strings, which name no unit."""
    if pretok != "text":
        return pc.utf8_split_whitespace(texts) if pretok == "word" else pc.split_pattern(texts, "\n")
    apart = re.compile("(" + "|".join(map(re.escape, specials)) + ")") if specials else None
    known = set(specials)

    def units(text: str) -> list[str]:
        if apart is None:
            return TEXT_UNITS.findall(text)
        return [u for part in apart.split(text) for u in ((part,) if part in known else TEXT_UNITS.findall(part))]

    return pa.array([units(t or "") for t in texts.to_pylist()], pa.list_(pa.string()))


def prepared(c: Column, pretok: str, specials: Sequence[str]) -> Column:
    """Text ready for ``split_pretokens``.

    The line layout is normalized to NFC. In the text layout a line break reads as a space and one more space stands
    for the start of the text, so that its first word is like any other.
    """
    c = F.replace(F.coalesce(c, F.lit("")), F.lit("\r\n"), F.lit("\n"))
    if pretok == "text":
        return F.when(c != "", F.concat(F.lit(" "), F.replace(c, F.lit("\n"), F.lit(" ")))).otherwise(c)
    return pad_specials(normalize_nfc(c) if pretok == "line" else c, specials, pretok)


def word_counts(
    df: DataFrame, text: str = "text", pretok: str = "word", specials: Sequence[str] = ()
) -> DataFrame:
    """``(word, n)``: the one pass over the corpus.

    Texts are split and counted some megabytes at a time, so that what reaches the shuffle is one
    row per word and run of texts, further combined per task.
    """
    outside = pa.array(["", *specials, *[fixed.WORD_MARK] * (pretok == "text")], pa.string())

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for texts in small_parts(batch.column(0), (1 if pretok == "text" else 4) * TEXT_RUN):
                counted = split_pretokens(texts, pretok, specials).flatten().value_counts()
                words, n = counted.field("values"), counted.field("counts")
                keep = pc.invert(pc.is_in(words, value_set=outside))
                yield pa.RecordBatch.from_arrays([words.filter(keep), n.filter(keep)], names=["word", "n"])

    texts = df.select(prepared(F.col(text), pretok, specials).alias("text"))
    return texts.mapInArrow(count, WORDS).groupBy("word").agg(F.sum("n").alias("n"))


def word_vocab(
    counts: DataFrame, size: int = fixed.VOCAB_SIZE, specials: Sequence[str] = tuple(fixed.WORD_SPECIALS[:3])
) -> DataFrame:
    """Ids 0, 1, 2 … for the specials, then the most frequent words by ``(n desc, word)``."""
    if size > fixed.MAX_VOCAB:
        raise ValueError("ids are 16 bits wide; at most 65,536 pieces")
    spark = counts.sparkSession
    k = len(specials)
    top = top_k(counts, size - k, "n", ["word"])  # at most 65,536 rows from here on
    ranked = top.select(
        (F.row_number().over(Window.orderBy(F.col("n").desc(), "word")) - 1 + k).alias("id"),
        F.col("word").alias("piece"), F.lit("word").alias("kind"),
    )
    head = spark.createDataFrame(
        [(i, s, "special") for i, s in enumerate(specials)], "id int, piece string, kind string"
    )
    return head.unionByName(ranked)


def collect_pieces(vocab: DataFrame) -> list[str]:
    """Pieces by id. A vocabulary is bounded by 16-bit ids; anything larger is refused."""
    rows = vocab.select("id", "piece").orderBy("id").limit(fixed.MAX_VOCAB + 1).collect()
    if len(rows) > fixed.MAX_VOCAB or [r.id for r in rows] != list(range(len(rows))):
        raise ValueError("a vocabulary needs the ids 0 … n-1, at most 65,536 of them")
    return [r.piece for r in rows]


def learn_bpe(
    counts: DataFrame,
    n_merges: int,
    *,
    pretok: str = "word",
    min_freq: int = fixed.MIN_PAIR_FREQ,
    max_piece: int = fixed.MAX_PIECE_CHARS,
    look: int = LOOK,
    exact: bool = True,
) -> DataFrame:
    """Byte-pair merges ``(rank, left, right)`` from word counts, best pair by ``(count desc, left, right)``.

    ``exact`` gives the merges of a one-by-one loop; ``exact=False`` takes many per round by the rule of
    ``merges.rule_of_a_round``, in far fewer rounds.
    """
    merges = learn_merges(counts, n_merges, pretok, min_freq, max_piece, look, exact)
    return counts.sparkSession.createDataFrame(
        [(rank, left, right) for rank, (left, right) in enumerate(merges)], "rank int, left string, right string"
    )


def _line_bytes(counts: DataFrame) -> DataFrame:
    """``(piece, n)``: how often each byte occurs in the lines, in hex; a row per byte and task."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(256, "i8")
        for batch in batches:
            n, at = np.asarray(batch.column(1)), 0
            for lines in small_parts(batch.column(0), 4 * TEXT_RUN):
                data, ends = bytes_of(lines)
                total += weighed(data, np.repeat(n[at : at + len(lines)], np.diff(ends)), 256)
                at += len(lines)
        some = np.flatnonzero(total).tolist()
        yield pa.RecordBatch.from_arrays([pa.array([f"{b:02X}" for b in some], pa.string()), pa.array(total[some])], names=["piece", "n"])

    return counts.select("word", F.col("n").cast("bigint")).mapInArrow(count, "piece string, n bigint")


def characters(counts: DataFrame, pretok: str = "word", limit: int = fixed.MAX_VOCAB) -> DataFrame:
    """Single symbols of the corpus, most frequent first: ``(piece, n)``. More than ``limit`` are refused."""
    if pretok == "word":
        split = F.split(F.concat(F.lit(fixed.WORD_MARK), "word"), "")
    elif pretok == "text":
        split = F.split(F.replace("word", F.lit(" "), F.lit(fixed.WORD_MARK)), "")
    else:
        split = None
    each = _line_bytes(counts) if split is None else counts.select(F.explode(split).alias("piece"), "n").filter("piece != ''")
    singles = each.groupBy("piece").agg(F.sum("n").alias("n"))
    kept = stage(top_k(singles, limit + 1, "n", ["piece"]))
    if kept.count() > limit:
        raise ValueError(f"the corpus has more than {limit} different characters; a vocabulary covers them all")
    return kept


def build_vocab(merges: DataFrame, chars: DataFrame, pretok: str = "word", size: int = fixed.VOCAB_SIZE) -> DataFrame:
    """Id table of a layout, ``size`` pieces at most. What does not fit is refused, never cut off.

    word, text: unk, bos, eos, user symbols, byte pieces, then merged pieces, then characters.
    line: the chat specials, then byte pieces (hex), then merged pieces.
    """
    if size > fixed.MAX_VOCAB:
        raise ValueError("ids are 16 bits wide; at most 65,536 pieces")
    spark = merges.sparkSession
    specials = fixed.LINE_SPECIALS if pretok == "line" else fixed.WORD_SPECIALS
    byte = "{:02X}" if pretok == "line" else "<0x{:02X}>"
    head = [(0, i, s, "special") for i, s in enumerate(specials)]
    head += [(1, b, byte.format(b), "byte") for b in range(256)]
    parts = spark.createDataFrame(head, "part int, nth int, piece string, kind string").unionByName(
        merges.select(
            F.lit(2).alias("part"), F.col("rank").alias("nth"),
            F.concat("left", "right").alias("piece"), F.lit("merge").alias("kind"),
        )
    )
    if pretok != "line":
        by_count = Window.orderBy(F.col("n").desc(), "piece")  # at most 65,536 rows
        parts = parts.unionByName(
            chars.select(
                F.lit(3).alias("part"), F.row_number().over(by_count).alias("nth"), "piece", F.lit("char").alias("kind")
            )
        )
    # Two merges may spell the same piece; the first keeps the id.
    once = parts.groupBy("piece").agg(F.min(F.struct("part", "nth", "kind")).alias("at"))
    order = Window.orderBy("at.part", "at.nth")
    ranked = once.select((F.row_number().over(order) - 1).alias("id"), "piece", F.col("at.kind").alias("kind"))
    ranked = stage(ranked)
    if (n := ranked.count()) > size:
        raise ValueError(f"{n} specials, bytes, merges and characters do not fit a vocabulary of {size} pieces")
    return ranked
