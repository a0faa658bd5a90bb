"""Text files as ordered lines, and formatted documents as text files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import fixed
from ..functions.text import drop_invalid_utf8
from ..operators.order import prefix_sum


def skip_unreadable(reader):
    """Broken and vanished files are passed over; the job goes on."""
    return reader.option("ignoreCorruptFiles", True).option("ignoreMissingFiles", True)


def read_text_lines(
    spark: SparkSession, path: str | list[str], extensions: Sequence[str] | None = tuple(fixed.TEXT_EXTENSIONS)
) -> DataFrame:
    """``(file, line_no, line, newline)`` of one file, several, or a folder tree.

    ``extensions`` selects files in a folder; None takes every file given. All kinds are plain
    text. ``\\n``, ``\\r\\n`` and a lone ``\\r`` end a line, undecodable bytes are dropped, and
    ``newline`` is false for a last line without one. Line numbers are running totals over the
    file's read blocks, so one huge file is read and numbered in parallel.
    """
    reader = skip_unreadable(spark.read).option("recursiveFileLookup", True).option("lineSep", "\n")
    if extensions is not None:
        reader = reader.option("pathGlobFilter", "*.{" + ",".join(extensions) + "}")
    raw = reader.text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("__size"),
        F.col("_metadata.file_block_start").alias("__block"), F.monotonically_increasing_id().alias("__nth"),
        F.octet_length("value").cast("bigint").alias("__bytes"), F.col("value").endswith("\r").alias("__cr"),
        F.split(F.regexp_replace(drop_invalid_utf8(F.col("value")), r"\r\z", ""), "\r").alias("__lines"),
    )
    laid = prefix_sum(
        raw, ["__nth"], {"__offset": F.col("__bytes") + 1, "__before": F.size("__lines")},
        by=["file"], bucket="__block",
    )
    # The last line runs past the end of the file by the newline it does not have.
    whole = F.col("__cr") | (F.col("__offset") + F.col("__bytes") + 1 <= F.col("__size"))
    lines = laid.select(
        "file", "__before", F.size("__lines").alias("__n"), whole.alias("__whole"),
        F.posexplode("__lines").alias("__k", "line"),
    )
    return lines.select(
        "file", (F.col("__before") + F.col("__k")).alias("line_no"), "line",
        (F.col("__whole") | (F.col("__k") < F.col("__n") - 1)).alias("newline"),
    )


def write_mixed_text(
    df: DataFrame, path: str, order: Sequence[str] = ("block", "rank"), text: str = "formatted"
) -> None:
    """Documents as UTF-8 text in global order, part files in name order, empties left out.

    The text sink ends every record with a newline, so the one each document ends with is
    taken off first; newlines inside stay.
    """
    (
        df.filter(F.col(text) != "")
        .orderBy(*order)
        .select(F.regexp_replace(F.col(text), r"\n\z", "").alias("value"))
        .write.mode("overwrite").text(path, lineSep="\n")
    )
