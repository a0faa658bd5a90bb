"""Greedy paragraph chunks of line-oriented text.

A blank line ends the chunk when more than ``min_chars`` have gathered, otherwise it adds a
newline to it. What matters of the past is one number, the characters gathered so far, and
beyond ``min_chars`` not even that. So a file of any length is cut in blocks of lines; a block is a
function from the number at its begin to the number at its end, tabulated only up to the first
paragraph over ``min_chars`` (a sync point: from there on the begin does not matter). Neighbours'
functions compose in a tree, which fixes every block's true begin, and the blocks then mark their
chunk ends independently. All of it are array expressions inside the JVM.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import fixed
from ..functions.predicates import not_blank
from ..session import stage
from .order import prefix_sum

BLOCK_LINES = 1024
#: Tables that meet in one group while functions are composed.
FAN = 256
BLANK = -1


def _gathered(so_far: Column, chars: Column, min_chars: int) -> Column:
    """Characters gathered after a line of ``chars``; everything over ``min_chars`` counts as one more than it."""
    over = F.lit(min_chars + 1)
    ended = F.when(so_far > min_chars, F.lit(0)).otherwise(so_far + 1)
    return F.when(chars == BLANK, ended).otherwise(F.least(so_far + F.least(chars, over), over))


def chunk_text(c: Column, min_chars: int = fixed.MIN_TEXT_CHARS) -> Column:
    """Chunks of one document's text, as an array: a fold over its lines' lengths inside the JVM."""
    text = F.regexp_replace(c, "\r\n?", "\n")
    # Every line carries its newline; what follows the last newline is a line without one.
    lines = F.filter(F.split(text, r"(?<=\n)"), lambda line: line != "")
    pieces = F.transform(lines, lambda line: F.when(not_blank(line), line).otherwise(F.lit("\n")))
    chars = F.transform(lines, lambda line: F.when(not_blank(line), F.length(line)).otherwise(F.lit(BLANK)))
    empty = F.struct(
        F.lit(0).alias("gathered"), F.lit(1).alias("first"), F.lit(1).alias("at"),
        F.array().cast("array<struct<first:int,n:int>>").alias("done"),
    )

    def step(acc: Column, length: Column) -> Column:
        full = (length == BLANK) & (acc["gathered"] > min_chars)
        span = F.array(F.struct(acc["first"].alias("first"), (acc["at"] - acc["first"]).alias("n")))
        return F.struct(
            _gathered(acc["gathered"], length, min_chars).alias("gathered"),
            F.when(full, acc["at"] + 1).otherwise(acc["first"]).alias("first"), (acc["at"] + 1).alias("at"),
            F.when(full, F.concat(acc["done"], span)).otherwise(acc["done"]).alias("done"),
        )

    def finish(acc: Column) -> Column:
        span = F.array(F.struct(acc["first"].alias("first"), (acc["at"] - acc["first"]).alias("n")))
        return F.when(acc["gathered"] > min_chars, F.concat(acc["done"], span)).otherwise(acc["done"])

    spans = F.aggregate(chars, empty, step, finish)
    return F.transform(spans, lambda s: F.array_join(F.slice(pieces, s["first"], s["n"]), ""))


def chunk_docs(df: DataFrame, text: str = "text", min_chars: int = fixed.MIN_TEXT_CHARS) -> DataFrame:
    """One row per chunk of a document (narrow): adds ``chunk_no`` from 0 and ``chunk``."""
    rest = [c for c in df.columns if c != text]
    return df.select(*rest, F.posexplode(chunk_text(F.col(text), min_chars)).alias("chunk_no", "chunk"))


def _leads_to(chars: Column, first: Column, min_chars: int) -> Column:
    """Where each begin of a block leads; one entry if all lead to the same, as from the first block's only begin."""
    over = F.lit(min_chars + 1)
    begins = F.when(first, F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), over))

    def step(acc: Column, length: Column) -> Column:
        paragraph = F.when(length == BLANK, F.lit(0)).otherwise(F.least(acc["paragraph"] + F.least(length, over), over))
        sync = (paragraph > min_chars) & (F.size(acc["ends"]) > 1)
        return F.struct(
            paragraph.alias("paragraph"),
            F.when(sync, F.array(over)).otherwise(F.transform(acc["ends"], lambda s: _gathered(s, length, min_chars))).alias("ends"),
        )

    return F.aggregate(chars, F.struct(F.lit(0).alias("paragraph"), begins.alias("ends")), step, lambda acc: acc["ends"])


def _led(table: Column, begin: Column) -> Column:
    return F.when(F.size(table) == 1, table[0]).otherwise(F.element_at(table, begin + 1))


def _begins(tables: DataFrame, blocks: int, min_chars: int, fan: int) -> DataFrame:
    """``(file, block, gathered)``: what has gathered where each block begins, from ``(file, block, leads_to)``."""
    group = F.floor(F.col("block") / fan).cast("bigint").alias("group")
    lists = tables.groupBy("file", group).agg(F.array_sort(F.collect_list(F.struct("block", "leads_to"))).alias("tables"))
    start = F.lit(0)
    if blocks > fan:
        everything = F.sequence(F.lit(0), F.lit(min_chars + 1))
        whole = F.aggregate(
            "tables", everything,
            lambda acc, t: F.when(F.size(t["leads_to"]) == 1, t["leads_to"]).otherwise(F.transform(acc, lambda s: _led(t["leads_to"], s))),
        )
        above = lists.select("file", F.col("group").alias("block"), whole.alias("leads_to"))
        above = _begins(above, math.ceil(blocks / fan), min_chars, fan)
        lists = lists.join(above.select("file", F.col("block").alias("group"), "gathered"), ["file", "group"])
        start = F.col("gathered")
    none = F.array().cast("array<struct<block:bigint,gathered:int>>")

    def step(acc: Column, t: Column) -> Column:
        here = F.struct(t["block"].alias("block"), acc["at"].alias("gathered"))
        return F.struct(_led(t["leads_to"], acc["at"]).alias("at"), F.concat(acc["out"], F.array(here)).alias("out"))

    along = F.aggregate("tables", F.struct(start.alias("at"), none.alias("out")), step, lambda acc: acc["out"])
    return lists.select("file", F.inline(along))


def _marks(min_chars: int) -> Column:
    """Per line twice the chunk ends before it, and one more if it is an end itself."""
    none = F.struct(F.col("gathered").alias("at"), F.lit(0).alias("no"), F.array().cast("array<int>").alias("out"))

    def step(acc: Column, length: Column) -> Column:
        full = ((length == BLANK) & (acc["at"] > min_chars)).cast("int")
        return F.struct(
            _gathered(acc["at"], length, min_chars).alias("at"), (acc["no"] + full).alias("no"),
            F.concat(acc["out"], F.array(2 * acc["no"] + full)).alias("out"),
        )

    return F.aggregate("chars", none, step, lambda acc: acc["out"])


def chunk_paragraphs(
    lines: DataFrame, min_chars: int = fixed.MIN_TEXT_CHARS, block_lines: int = BLOCK_LINES, fan: int = FAN
) -> DataFrame:
    """``(file, line_no, line)`` to ``(file, chunk_no, chunk)``, files of any size.

    A line holds its text without the newline; all lines of a file but the last end with one,
    and the last does too unless the table marks it with a false ``newline`` column. Line numbers
    rise within a file, from 0 or more.
    """
    newline = F.col("newline") if "newline" in lines.columns else F.lit(True)
    filled = not_blank(F.col("line"))
    # What a line adds to its chunk: itself, or a newline if it is blank and ends none.
    piece = F.when(filled, F.concat("line", F.when(newline, F.lit("\n")).otherwise(F.lit("")))).otherwise(F.lit("\n"))
    rows = lines.select(
        "file", "line_no", F.floor(F.col("line_no") / block_lines).cast("bigint").alias("block"), piece.alias("piece"),
        F.when(filled, F.length(piece)).otherwise(F.lit(BLANK)).alias("chars"),
    )
    listed = rows.groupBy("file", "block").agg(F.array_sort(F.collect_list(F.struct("line_no", "chars", "piece"))).alias("ls"))
    blocks = stage(listed.select("file", "block", F.col("ls.chars").alias("chars"), F.col("ls.piece").alias("pieces")))
    most = blocks.agg(F.max("block")).first()[0]
    tables = blocks.select("file", "block", _leads_to(F.col("chars"), F.col("block") == 0, min_chars).alias("leads_to"))
    begins = _begins(tables, 1 + (most or 0), min_chars, fan)
    ends = blocks.select("file", "block", "chars").join(begins, ["file", "block"]).withColumn("marks", _marks(min_chars))
    ended = F.aggregate("marks", F.lit(0), lambda n, m: n + m % 2)
    numbered = prefix_sum(
        stage(ends.select("file", "block", "gathered", ended.alias("ends"))), ["block"], "ends", by=["file"],
        bucket=F.floor(F.col("block") / fan), out="first_no",
    ).select("file", "block", "gathered", "first_no")
    marked = blocks.join(numbered, ["file", "block"]).select(
        "file", "block", "first_no", F.posexplode(F.arrays_zip(_marks(min_chars).alias("mark"), F.col("pieces").alias("piece")))
    )
    kept = marked.filter("col.mark % 2 = 0").select(
        "file", (F.col("first_no") + F.floor(F.col("col.mark") / 2)).cast("bigint").alias("chunk_no"),
        F.struct("block", "pos", F.col("col.piece").alias("piece")).alias("part"),
    )
    whole = F.array_join(F.transform(F.array_sort(F.collect_list("part")), lambda x: x["piece"]), "")
    chunks = kept.groupBy("file", "chunk_no").agg(whole.alias("chunk"))
    # Only what is left at the end of a file can be shorter; it is dropped.
    return chunks.filter(F.length("chunk") > min_chars)
