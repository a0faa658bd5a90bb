"""Data preparation: text files to a shuffled token stream, stage tables in between."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import fixed
from ..functions.arrays import drop_unknown_ids
from ..functions.keys import order_key
from ..operators.encode import encode_bpe
from ..operators.order import prefix_sum, quantile_bucket
from ..operators.sample import bernoulli_by_bytes, head_by_bytes
from ..operators.tokens import split_at_eos
from ..operators.vocab import build_vocab, characters, learn_bpe, word_counts
from ..session import stage
from ..sources.tables import read_vocab, write_vocab
from ..sources.text import read_text_lines
from ..sources.tokenbin import read_token_shards, write_token_shards


def train_tokenizer(
    lines: DataFrame, path: str, *, size: int = fixed.VOCAB_SIZE, pretok: str = "word", sample: str = "head",
    seed: int = 0, exact: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """Sample lines, count, learn merges, number the pieces, store both tables; returns
    ``(vocab, merges)``."""
    spark = lines.sparkSession
    taken = head_by_bytes(lines) if sample == "head" else bernoulli_by_bytes(lines, seed)
    specials = fixed.LINE_SPECIALS if pretok == "line" else fixed.WORD_SPECIALS
    word_counts(taken, "line", pretok, specials).write.mode("overwrite").parquet(f"{path}/word_counts")
    counts = spark.read.parquet(f"{path}/word_counts")
    chars = characters(counts, pretok)
    fixed_pieces = len(specials) + 256 + (0 if pretok == "line" else chars.count())
    merges = learn_bpe(counts, max(0, size - fixed_pieces), pretok=pretok, exact=exact)
    write_vocab(build_vocab(merges, chars, pretok, size), merges, path)
    return read_vocab(spark, path)


def encode_lines(lines: DataFrame, vocab: DataFrame, merges: DataFrame, pretok: str = "word") -> DataFrame:
    """Ids per line in file order, the unknown id left out. Only lines of no characters at all are skipped."""
    ids = encode_bpe(F.col("line"), merges, vocab, pretok)
    ids = ids if pretok == "line" else drop_unknown_ids(ids)
    return lines.filter(F.length("line") > 0).select("file", "line_no", ids.alias("ids"))


PLACE = ["file", "line_no", "seq_no"]


def document_parts(encoded: DataFrame, eos_id: int = fixed.EOS_ID) -> DataFrame:
    """Documents cut from encoded lines, as parts ``(doc_id, file, line_no, seq_no, ids)``.

    Each end marker closes one, wherever lines and files end. ``doc_id`` counts end markers, by
    running totals over line blocks. A part is what one line holds of a document, so text without
    any marker is one document of many rows.
    """
    # Written once: the passes over the order would each encode and cut the lines again.
    closed = (F.element_at("ids", -1) == eos_id).cast("int").alias("__closed")
    parts = stage(split_at_eos(encoded, eos_id=eos_id).select(*PLACE, "ids", closed))
    return prefix_sum(
        quantile_bucket(parts, "line_no"), ["line_no", "seq_no"], "__closed", by=["file"], then=[F.col("file")],
        bucket="__bucket", out="doc_id",
    ).select("doc_id", *PLACE, "ids")


def cut_documents(encoded: DataFrame, eos_id: int = fixed.EOS_ID) -> DataFrame:
    """``(doc_id, ids)``: the parts of each document in one row, for documents known to be short."""
    pieces = F.array_sort(F.collect_list(F.struct(*PLACE, "ids")))
    parts = document_parts(encoded, eos_id).groupBy("doc_id")
    return parts.agg(F.flatten(F.transform(pieces, lambda x: x["ids"])).alias("ids"))


def prepare_tokens(
    spark: SparkSession, source: str, work: str, *, seed: int, size: int = fixed.VOCAB_SIZE,
    eos_id: int = fixed.EOS_ID, pretok: str = "text",
) -> DataFrame:
    """Read text, learn a tokenizer when ``work`` holds none, encode, cut at end markers, shuffle
    whole documents, store token shards; returns them as documents."""
    lines = read_text_lines(spark, source)
    try:
        vocab, merges = read_vocab(spark, f"{work}/tokenizer")
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        vocab, merges = train_tokenizer(lines, f"{work}/tokenizer", size=size, pretok=pretok)
    encode_lines(lines, vocab, merges, pretok).write.mode("overwrite").parquet(f"{work}/lines")
    parts = document_parts(spark.read.parquet(f"{work}/lines"), eos_id).withColumn("key", order_key(seed, "doc_id"))
    write_token_shards(
        parts, f"{work}/shuffled", order=["key", "doc_id", *PLACE], document=True, eos_id=eos_id
    )
    return read_token_shards(spark, f"{work}/shuffled", eos_id)
