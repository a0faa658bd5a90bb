"""Table-level filters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def drop_empty_formatted(df: DataFrame, column: str = "formatted") -> DataFrame:
    return df.filter(F.col(column) != "")


def drop_nulls(df: DataFrame, column: str = "text") -> DataFrame:
    return df.filter(F.col(column).isNotNull())


def quarantine(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Add ``reason``: the name of the first rule a row breaks, null for a good row.

    Each rule is a condition a good row meets; a null verdict counts as broken. Bad rows are
    set aside with their reason, where the reference gives up the rest of the source.
    """
    reason = F.lit(None).cast("string")
    for name, ok in reversed(rules.items()):
        reason = F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)).otherwise(reason)
    return df.withColumn("reason", reason)


def write_quarantine(df: DataFrame, path: str) -> None:
    """Store good and rejected rows side by side, in one pass, one folder per reason."""
    df.withColumn("reason", F.coalesce("reason", F.lit("ok"))).write.mode("overwrite").partitionBy(
        "reason"
    ).parquet(path)
