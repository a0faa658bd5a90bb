"""Corpus counts and run telemetry."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import fixed
from .order import running

MIB = 1024 * 1024


def source_report(df: DataFrame, text: str = "formatted") -> DataFrame:
    """Documents, non-empty documents, characters and bytes per source and in all."""
    return (
        df.rollup("source")
        .agg(
            F.grouping("source").alias("is_total"),
            F.count("*").alias("n_selected"),
            F.count_if(F.col(text) != "").alias("n_nonempty"),
            F.sum(F.length(text)).alias("chars"),
            F.sum(F.octet_length(text)).alias("bytes"),
        )
        .withColumn("source", F.when(F.col("is_total") == 1, F.lit("TOTAL")).otherwise(F.col("source")))
        .drop("is_total")
    )


def token_report(df: DataFrame, ids: str = "ids") -> DataFrame:
    """Documents, tokens, and bytes of the 16-bit stream."""
    tokens = F.coalesce(F.sum(F.size(ids)), F.lit(0))
    return df.agg(F.count("*").alias("docs"), tokens.alias("tokens"), (tokens * 2).alias("bytes"))


def sample_report(df: DataFrame, by: str = "source", ids: str = "ids") -> DataFrame:
    """Sequences and their lengths. The median comes from counts per length, not from a sort."""
    n = F.size(ids)
    return df.groupBy(by).agg(
        F.count("*").alias("sequences"),
        F.min(n).alias("shortest"),
        F.max(n).alias("longest"),
        F.sum(n).alias("tokens"),
        F.percentile(n, 0.5).alias("median"),
    )


def _seconds(start: Column, ts: Column) -> Column:
    return F.timestamp_diff("MICROSECOND", start, ts) / 1e6


def _with_run_start(df: DataFrame) -> DataFrame:
    """Each row with its run's first step and time: one small row per run, joined back."""
    starts = df.groupBy("run_id").agg(F.min("step").alias("start_step"), F.min("ts").alias("t0"))
    return df.join(starts, "run_id")


def cumulative_rate(df: DataFrame, size: str = "tokens") -> DataFrame:
    """Average speed since the run began, in MiB/s: history rows ``(time, speed)``.

    Rows within a tenth of a second of the start are left out.
    """
    summed = running(df, "step", size, by=["run_id"], out="__before")
    timed = _with_run_start(summed).withColumn("time", _seconds(F.col("t0"), F.col("ts")))
    done = F.col("__before") + F.col(size)
    return timed.filter(F.col("time") >= 0.1).select(
        "run_id", "step", "time", (done / MIB / F.col("time")).alias("speed")
    )


def tail_n(df: DataFrame, n: int = fixed.HISTORY_ROWS) -> DataFrame:
    """The latest ``n`` rows of each run; every task keeps at most ``n`` of a run before the shuffle."""
    latest = Window.partitionBy("run_id").orderBy(F.col("step").desc())
    return df.withColumn("__nth", F.row_number().over(latest)).filter(F.col("__nth") <= n).drop("__nth")


def ema(df: DataFrame, alpha: float = fixed.EMA_ALPHA, value: str = "loss", out: str = "avg_loss") -> DataFrame:
    """Exponential moving average per run in step order; the first value starts it.

    A run is cut in blocks of steps. Inside a block the average is a scaled running sum; what
    a block takes over from the one before decays by (1 - alpha)^steps. Blocks are so long
    that anything older than one whole block has decayed below double precision, so one
    neighbour suffices and no run is scanned in sequence.
    """
    decay = 1 - alpha
    steps = math.ceil(46 / -math.log(decay))
    laid = running(df, "step", 1, by=["run_id"], out="__i").withColumns(
        {"__block": F.floor(F.col("__i") / steps).cast("bigint"), "__j": F.col("__i") % steps}
    )
    share = F.when(F.col("__i") == 0, F.col(value)).otherwise(F.col(value) * alpha)
    laid = laid.withColumn("__w", share * F.pow(F.lit(decay), -F.col("__j")))
    inside = Window.partitionBy("run_id", "__block").orderBy("__i").rowsBetween(Window.unboundedPreceding, 0)
    local = F.pow(F.lit(decay), F.col("__j")) * F.sum("__w").over(inside)
    carry = laid.groupBy("run_id", (F.col("__block") + 1).alias("__block")).agg(
        (F.pow(F.lit(decay), F.max("__j")) * F.sum("__w")).alias("__carry")
    )
    inherited = F.coalesce(F.col("__carry") * F.pow(F.lit(decay), F.col("__j") + 1), F.lit(0.0))
    return (
        laid.withColumn("__local", local)
        .join(carry, ["run_id", "__block"], "left")
        .select(*df.columns, (F.col("__local") + inherited).alias(out))
    )


def downsample(df: DataFrame, every: int = fixed.REPORT_EVERY) -> DataFrame:
    return df.filter(F.col("step") % every == 0)


def throughput_eta(df: DataFrame, batch_size: int, accumulate: int, ctx: int, max_steps: int) -> DataFrame:
    """Average tokens per second since the run began, and whole seconds left."""
    timed = _with_run_start(df)
    seconds = _seconds(F.col("t0"), F.col("ts"))
    dt = F.when(seconds == 0, F.lit(0.001)).otherwise(seconds)
    done = (F.col("step") - F.col("start_step") + 1).cast("bigint")
    per_step = batch_size * accumulate * ctx
    return timed.select(
        "run_id", "step", done.alias("steps_done"),
        (done * per_step / dt).cast("bigint").alias("tokens_per_sec"),
        ((max_steps - F.col("step")) / (done / dt)).cast("bigint").alias("eta_sec"),
    )
