"""Corpus build: source tables to one mixed, formatted corpus."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace
from itertools import groupby

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import fixed
from ..functions.layout import fixed_system, format_instruct, format_pretrain, join_prompt
from ..functions.predicates import length_between, letter_profile, min_length
from ..operators.chunk import chunk_docs, chunk_paragraphs
from ..operators.mix import mix, union_sources
from ..operators.sample import cap_per_source, upsample
from ..schemas import SourceSpec
from ..session import stage
from ..sources.text import read_text_lines

IDS = ("source", "doc_id", "chunk_no", "copy_no")


def _admitted(kind: str, required: str, forbidden: str) -> Column | None:
    """The raw filter of a kind, before cleaning."""
    text = F.col("text")
    if kind == "code":
        return length_between(F.coalesce("output", F.lit("")))
    if kind in ("wiki", "web"):
        return min_length(text, strict=kind == "wiki") & letter_profile(text, required, forbidden)
    return None


def format_kind(
    df: DataFrame, spec: SourceSpec, required: str = fixed.REQUIRED_LETTERS, forbidden: str = fixed.FORBIDDEN_LETTERS
) -> DataFrame:
    """``(source, doc_id, chunk_no, formatted)`` for sources that share their settings.

    Instruction kinds read ``(source, rec_id, instruction, input, output)``, the others
    ``(source, doc_id, text)``. Rows whose layout comes out empty stay, except for chat: they
    count against caps and are left out by the sink.
    """
    instruct = spec.kind in ("chat", "code")
    rows = df.withColumnRenamed("rec_id", "doc_id") if instruct else df
    ok = _admitted(spec.kind, required, forbidden)
    if spec.cap is not None:
        eligible = spec.cap_on == "eligible"
        rows = cap_per_source(rows, spec.cap, eligible=ok if eligible else None)
        ok = None if eligible else ok
    if ok is not None:
        rows = rows.filter(ok)
    if "chunk_no" in rows.columns:
        pass  # book files come as chunks
    elif spec.kind == "book":
        rows = chunk_docs(rows.select("source", "doc_id", "text")).withColumnRenamed("chunk", "text")
    else:
        rows = rows.withColumn("chunk_no", F.lit(0))
    if instruct:
        prompt = join_prompt(F.col("instruction"), F.col("input"), " " if spec.kind == "chat" else "\n")
        formatted = format_instruct(fixed_system(spec.kind), prompt, F.coalesce("output", F.lit("")))
    else:
        formatted = format_pretrain(F.col("text"))
    out = rows.select("source", "doc_id", "chunk_no", formatted.alias("formatted"))
    return out.filter(F.col("formatted") != "") if spec.kind == "chat" else out


def book_files(spark: SparkSession, path: str | list[str], source: Column, doc_id: Column | None = None) -> DataFrame:
    """``(source, doc_id, chunk_no, text)``: text files as paragraph chunks, files of any size.

    ``source`` and ``doc_id`` are of the column ``file``; a file's number is a hash of its path if not given.
    """
    chunks = chunk_paragraphs(read_text_lines(spark, path))
    number = F.xxhash64("file") if doc_id is None else doc_id
    return chunks.select(
        source.alias("source"), number.cast("bigint").alias("doc_id"), F.col("chunk_no").cast("int").alias("chunk_no"),
        F.col("chunk").alias("text"),
    )


def format_sources(
    docs: DataFrame, instruct: DataFrame, specs: Sequence[SourceSpec], books: DataFrame | None = None, **letters: str
) -> DataFrame:
    """All sources formatted, one narrow branch per kind and setting; ``books`` are chunks of ``book_files``, if the book
    sources are files."""

    def settings(spec: SourceSpec):
        return replace(spec, source="")

    parts = []
    for shared, group in groupby(sorted(specs, key=lambda s: str(settings(s))), key=settings):
        names = [s.source for s in group]
        table = instruct if shared.kind in ("chat", "code") else docs
        table = books if shared.kind == "book" and books is not None else table
        parts.append(format_kind(table.filter(F.col("source").isin(names)), shared, **letters))
    return union_sources(parts)


def build_corpus(
    docs: DataFrame, instruct: DataFrame, specs: Sequence[SourceSpec], seed: int, buffer: int = fixed.MIX_BUFFER,
    books: DataFrame | None = None, **letters: str,
) -> DataFrame:
    """Formatted, upsampled, interleaved and window-shuffled documents.

    Gives ``(source, doc_id, chunk_no, copy_no, block, rank, formatted)``. The order is worked
    out on ids alone; the texts join it once and are sorted once, by the sink.
    """
    formatted = format_sources(docs, instruct, specs, books, **letters)
    times = F.coalesce(*[F.when(F.col("source") == s.source, F.lit(s.upsample)) for s in specs])
    copies = upsample(stage(formatted.select("source", "doc_id", "chunk_no")), times)
    order = mix(copies, seed, len(specs), buffer=buffer, ids=IDS).select(*IDS, "block", "rank")
    return order.join(formatted, ["source", "doc_id", "chunk_no"])
