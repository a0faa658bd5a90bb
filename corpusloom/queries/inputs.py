"""Inputs shaped like the engine's sources, derived from the given tables by expression.

Each exists twice: as a DataFrame and as SQL for the checks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import fixed
from ..operators.order import prefix_sum, quantile_bucket
from ..sources.tables import spread_small


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def docs(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "documents").select("doc_id", "source", "text")
    return spread_small(rows, f"{folder}/documents.parquet", "doc_id")


# --- documents with markers, by doc_id --------------------------------------
def marked_docs(spark: SparkSession, folder: str) -> DataFrame:
    text, case = F.col("text"), F.col("doc_id") % 7
    padding = F.lit("\u00a0\u3000")
    marked = (
        F.when(case == 0, F.concat(F.lit("<|im_start|>user\n"), text, F.lit("<|im_end|>")))
        .when(case == 1, F.concat(text, F.lit("<|endoftext|>")))
        .when(case == 2, F.concat(F.lit("<|begin_of_<|im_end|>text|>"), text))
        .when(case == 3, F.concat(text, F.lit("<|im_start|>user")))
        .when(case == 4, F.concat(padding, text, padding))
        .when(case == 5, F.concat(F.lit("<|start_header_id|>user<|end_header_id|>\n\n"), text, F.lit("<|eot_id|>")))
        .otherwise(text)
    )
    return docs(spark, folder).select("doc_id", "source", marked.alias("text"))


MARKED_DOCS = """
marked AS (SELECT doc_id, source, CASE doc_id % 7
    WHEN 0 THEN '<|im_start|>user' || chr(10) || text || '<|im_end|>'
    WHEN 1 THEN text || '<|endoftext|>'
    WHEN 2 THEN '<|begin_of_<|im_end|>text|>' || text
    WHEN 3 THEN text || '<|im_start|>user'
    WHEN 4 THEN chr(160) || chr(12288) || text || chr(160) || chr(12288)
    WHEN 5 THEN '<|start_header_id|>user<|end_header_id|>' || chr(10) || chr(10) || text || '<|eot_id|>'
    ELSE text END AS text FROM documents)
"""


# --- lines: one file per source, a blank line after every third line ---------
def text_lines(spark: SparkSession, folder: str) -> DataFrame:
    rows = docs(spark, folder).select("source", "doc_id", F.posexplode(F.split("text", "\n")).alias("k", "line"))
    spaced = rows.select(
        F.col("source").alias("file"), "doc_id", "k",
        F.explode(F.when(F.col("k") % 3 == 2, F.array(F.col("line"), F.lit(" "))).otherwise(F.array("line"))).alias("line"),
    )
    # Places inside a document stay far below a million.
    place = F.col("doc_id") * 2_000_000 + F.col("k") * 2 + F.when(F.col("line") == " ", 1).otherwise(0)
    return spaced.select("file", place.alias("line_no"), "line")


TEXT_LINES = """
text_lines AS (SELECT file, doc_id * 2000000 + k * 2 + b AS line_no, line FROM (
    SELECT source AS file, doc_id, k, line, 0 AS b FROM split_lines
    UNION ALL SELECT source, doc_id, k, ' ', 1 FROM split_lines WHERE k % 3 = 2))
"""
SPLIT_LINES = """
split_lines AS (SELECT source, doc_id, unnest(string_split(text, chr(10))) AS line,
    generate_subscripts(string_split(text, chr(10)), 1) - 1 AS k FROM documents)
"""
LINES_SQL = f"{SPLIT_LINES}, {TEXT_LINES}"


# --- instruction records: a user turn with the assistant turn after it -------
def instruct(spark: SparkSession, folder: str) -> DataFrame:
    turns = table(spark, folder, "conversations")
    user = turns.filter(F.col("role") == "user").select("conv_id", "turn", F.col("text").alias("instruction"))
    answer = turns.filter(F.col("role") == "assistant").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("output")
    )
    extra = F.when(F.col("conv_id") % 10 == 3, F.lit(None)).when(
        F.col("conv_id") % 2 == 1, F.substring("instruction", 1, 40)
    ).otherwise(F.lit(""))
    return user.join(answer, ["conv_id", "turn"]).select(
        (F.col("conv_id") * 1000 + F.col("turn")).alias("rec_id"),
        F.when(F.col("conv_id") % 2 == 0, F.lit("chat")).otherwise(F.lit("code")).alias("source"),
        "instruction", extra.cast("string").alias("input"), "output",
    )


INSTRUCT = """
instruct AS (SELECT u.conv_id * 1000 + u.turn AS rec_id,
    CASE WHEN u.conv_id % 2 = 0 THEN 'chat' ELSE 'code' END AS source, u.text AS instruction,
    CASE WHEN u.conv_id % 10 = 3 THEN NULL WHEN u.conv_id % 2 = 1 THEN substr(u.text, 1, 40) ELSE '' END AS input,
    a.text AS output
    FROM conversations u JOIN conversations a ON a.conv_id = u.conv_id AND a.turn = u.turn + 1
    WHERE u.role = 'user' AND a.role = 'assistant')
"""


# --- telemetry: one run per user ---------------------------------------------
def run_log(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events")
    ranked = prefix_sum(
        quantile_bucket(events.withColumn("__at", F.col("ts").cast("timestamp")), "__at"), ["ts", "event_id"], 1,
        by=["user_id"], bucket="__bucket", out="step",
    )
    return ranked.select(
        F.col("user_id").alias("run_id"), "step", "ts", F.col("value").alias("loss"),
        (F.col("event_id") % 1000).alias("tokens"),
    )


RUN_LOG = """
run_log AS (SELECT user_id AS run_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS step,
    ts, value AS loss, event_id % 1000 AS tokens FROM events)
"""


# --- SQL twins of the scalar rules ---------------------------------------------
def sql_text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


WS_CHARS = " || ".join(f"chr({ord(c)})" for c in fixed.WHITESPACE)


def sql_strip(c: str) -> str:
    return f"trim({c}, {WS_CHARS})"


def sql_headers(c: str) -> str:
    return f"regexp_replace({c}, '<\\|im_start\\|>[^\\n]*\\n', '', 'g')"


def sql_markers(c: str) -> str:
    for marker in fixed.MARKERS:
        c = f"replace({c}, '{marker}', '')"
    return c


def sql_sanitize(c: str) -> str:
    return f"coalesce({sql_strip(sql_markers(sql_headers(c)))}, '')"


def sql_pretrain(c: str) -> str:
    return (
        f"CASE WHEN length({sql_sanitize(c)}) < 300 THEN '' "
        f"ELSE '<s>' || {sql_sanitize(c)} || '</s>' || chr(10) END"
    )


def sql_instruct(system: str, user: str, assistant: str) -> str:
    s, u, a = sql_sanitize(system), sql_sanitize(user), sql_sanitize(assistant)
    nl = "chr(10) || chr(10)"
    return (
        f"CASE WHEN {u} = '' OR {a} = '' THEN '' ELSE '<s>System: ' || "
        f"CASE WHEN {s} = '' THEN '{fixed.DEFAULT_SYSTEM}' ELSE {s} END || {nl} || '### User: ' || {u} || {nl} || "
        f"'### Assistant: ' || {a} || '</s>' || chr(10) END"
    )


def sql_profile(c: str, required: str, forbidden: str) -> str:
    return (
        f"coalesce(length({c}) >= 50 AND regexp_matches(lower({c}), '[{required}]') AND "
        f"len(regexp_extract_all(lower({c}), '[{forbidden}]'))::DOUBLE / length({c}) <= 0.01::DOUBLE, false)"
    )


def sql_key(seed, *parts: str) -> str:
    return "md5(concat_ws(':', " + ", ".join([f"'{seed}'", *[f"({p})::VARCHAR" for p in parts]]) + "))"


def sql_word(key: str) -> str:
    return f"('0x' || substr({key}, 1, 8))::BIGINT"


def sql_chunks(lines: str, min_chars: int = 300) -> str:
    """Chunks of a list of lines, newlines included, by the greedy rule."""
    blank = sql_strip("x") + " = ''"
    full = f"length(acc.cur) > {min_chars}"
    fold = (
        f"list_reduce({lines}, lambda acc, x: {{'cur': CASE WHEN {blank} AND {full} THEN '' "
        f"WHEN {blank} THEN acc.cur || chr(10) ELSE acc.cur || x END, "
        f"'done': CASE WHEN {blank} AND {full} THEN list_append(acc.done, acc.cur) ELSE acc.done END}}, "
        f"{{'cur': '', 'done': []::VARCHAR[]}})"
    )
    return fold


# --- word ids ---------------------------------------------------------------------
WORDS = f"""
words AS MATERIALIZED (SELECT doc_id, source, unnest(ws) AS word, generate_subscripts(ws, 1) AS i FROM (
    SELECT doc_id, source,
        list_filter(string_split_regex(text, '{fixed.WHITESPACE_CLASS}+'), lambda x: x <> '') AS ws FROM documents))
"""
VOCAB_WORDS = fixed.VOCAB_SIZE
VOCAB = f"""
counts AS (SELECT word, count(*) AS n FROM words GROUP BY word),
vocab AS MATERIALIZED (
    SELECT word, id FROM (SELECT word, row_number() OVER (ORDER BY n DESC, word) + 2 AS id FROM counts)
    WHERE id < {VOCAB_WORDS}
    UNION ALL VALUES ('<unk>', 0), ('<s>', 1), ('</s>', 2))
"""
TOKENS = """
tokens AS MATERIALIZED (SELECT doc_id, source, i, coalesce(id, 0) AS id FROM words LEFT JOIN vocab USING (word)
    UNION ALL SELECT doc_id, source, 1000000000, 2 FROM documents)
"""
# Unknown words left out, an end marker after every document.
KNOWN = "known AS MATERIALIZED (SELECT doc_id, source, i, id FROM tokens WHERE id <> 0)"
TOKENS_SQL = f"{WORDS}, {VOCAB}, {TOKENS}, {KNOWN}"
