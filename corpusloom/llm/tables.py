"""What the operators of this folder share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def texts(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and ``text`` alone, under these names, so that no other column can clash; null text is empty."""
    return df.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def ascii_lower(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


#: ASCII white space; the words of most contracts are what stands between.
BLANK = r"[\x20\x09-\x0D]+"


def blank_words(text: Column) -> Column:
    """Words between ASCII white space, as an array; none for blank text."""
    return F.filter(F.split(text, BLANK), lambda w: w != "")


#: ASCII characters other than letters and digits.
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def plain_words(text: Column) -> Column:
    """Lower-case words of letters, digits and everything beyond ASCII, as an array."""
    return F.filter(F.split(ascii_lower(text), NOT_WORD), lambda w: w != "")


def in_learning_part(id_col: str = "doc_id") -> Column:
    """Rows that may be learnt from: crc32 of the id as text, modulo 4, is not 2."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 != 2
