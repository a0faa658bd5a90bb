"""Corpus reports and run telemetry."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.layout import format_pretrain
from ..operators.report import (
    cumulative_rate, downsample, ema, sample_report, source_report, tail_n, throughput_eta, token_report,
)
from . import query
from .inputs import RUN_LOG, TOKENS_SQL, docs, run_log, sql_pretrain
from .tokens import token_docs


@query(
    "source_report",
    f"""WITH f AS (SELECT source, {sql_pretrain('text')} AS formatted FROM documents)
    SELECT CASE WHEN grouping(source) = 1 THEN 'TOTAL' ELSE source END AS source, count(*) AS n_selected,
        count(*) FILTER (formatted <> '') AS n_nonempty, sum(length(formatted))::BIGINT AS chars,
        sum(strlen(formatted))::BIGINT AS bytes FROM f GROUP BY ROLLUP (source)""",
)
def per_source(spark, folder):
    return source_report(docs(spark, folder).select("source", format_pretrain(F.col("text")).alias("formatted")))


@query(
    "token_report",
    f"WITH {TOKENS_SQL} SELECT count(DISTINCT doc_id) AS docs, count(*) AS tokens, 2 * count(*) AS bytes FROM known",
)
def token_totals(spark, folder):
    return token_report(token_docs(spark, folder))


@query(
    "sample_report",
    f"""WITH {TOKENS_SQL}, sizes AS (SELECT source, doc_id, count(*) AS n FROM known GROUP BY source, doc_id)
    SELECT source, count(*) AS sequences, min(n) AS shortest, max(n) AS longest, sum(n)::BIGINT AS tokens,
        quantile_cont(n, 0.5)::DOUBLE AS median FROM sizes GROUP BY source""",
)
def sample_totals(spark, folder):
    report = sample_report(token_docs(spark, folder))
    return report.withColumns({c: F.col(c).cast("bigint") for c in ("shortest", "longest")})


@query(
    "rate",
    f"""WITH {RUN_LOG}, timed AS (SELECT run_id, step,
        (epoch_us(ts) - min(epoch_us(ts)) OVER (PARTITION BY run_id)) / 1e6::DOUBLE AS time,
        (sum(tokens) OVER (PARTITION BY run_id ORDER BY step))::BIGINT AS done FROM run_log)
    SELECT run_id, step, time, round(done / 1048576::DOUBLE / time * 1e6::DOUBLE, 6) AS speed FROM timed WHERE time >= 0.1""",
)
def rates(spark, folder):
    rows = cumulative_rate(run_log(spark, folder))
    # Shown in bytes per million seconds, where six digits tell the rows apart.
    return rows.withColumn("speed", F.round(F.col("speed") * 1e6, 6))


@query(
    "tail_n",
    f"""WITH {RUN_LOG}, late AS (SELECT *, row_number() OVER (PARTITION BY run_id ORDER BY step DESC) AS nth FROM run_log)
    SELECT run_id, step, loss, tokens FROM late WHERE nth <= 20""",
)
def latest(spark, folder):
    return tail_n(run_log(spark, folder), 20).select("run_id", "step", "loss", "tokens")


@query(
    "ema",
    f"""WITH {RUN_LOG}, listed AS (SELECT run_id, list(loss ORDER BY step) AS xs FROM run_log GROUP BY run_id),
    folded AS (SELECT run_id, list_reduce(xs[2:], lambda acc, x: list_append(acc, 0.95::DOUBLE * acc[-1] + 0.05::DOUBLE * x),
        [xs[1]]) AS avgs FROM listed)
    SELECT run_id, step - 1 AS step, round(a + 1.23e-8::DOUBLE, 6) AS avg_loss FROM (
        SELECT run_id, unnest(avgs) AS a, generate_subscripts(avgs, 1) AS step FROM folded)""",
)
def averages(spark, folder):
    # Losses have two decimals, so averages can end in an exact half; the shift moves all off it.
    shown = F.round(F.col("avg_loss") + 1.23e-8, 6)
    return ema(run_log(spark, folder)).select("run_id", "step", shown.alias("avg_loss"))


@query("downsample", f"WITH {RUN_LOG} SELECT run_id, step, loss FROM run_log WHERE step % 10 = 0")
def sparse(spark, folder):
    return downsample(run_log(spark, folder)).select("run_id", "step", "loss")


@query(
    "eta",
    f"""WITH {RUN_LOG}, timed AS (SELECT run_id, step, step - min(step) OVER (PARTITION BY run_id) + 1 AS steps_done,
        (epoch_us(ts) - min(epoch_us(ts)) OVER (PARTITION BY run_id)) / 1e6::DOUBLE AS sec FROM run_log),
    safe AS (SELECT *, CASE WHEN sec = 0 THEN 0.001::DOUBLE ELSE sec END AS dt FROM timed)
    SELECT run_id, step, steps_done, trunc(steps_done * 32768 / dt)::BIGINT AS tokens_per_sec,
        trunc((1000 - step) / (steps_done / dt))::BIGINT AS eta_sec FROM safe""",
)
def etas(spark, folder):
    return throughput_eta(run_log(spark, folder), 8, 4, 1024, 1000)
