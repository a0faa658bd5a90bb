"""Cleaning, layouts, predicates, chunks."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import fixed
from ..functions.layout import (
    extract_answer, fixed_system, format_instruct, format_pretrain, join_prompt, render_chat_prompt,
)
from ..functions.predicates import length_between, letter_profile, min_length, not_blank
from ..functions.text import (
    drop_invalid_utf8, normalize_nfc, sanitize_text, split_lines, strip_markers, strip_role_headers, utf8_bytes,
)
from ..operators.chunk import chunk_docs, chunk_paragraphs
from ..operators.filters import drop_empty_formatted, drop_nulls, quarantine
from ..sources.tables import instruct_source
from . import query
from .inputs import (
    INSTRUCT, LINES_SQL, MARKED_DOCS, docs, instruct, marked_docs, sql_chunks, sql_headers, sql_instruct,
    sql_markers, sql_pretrain, sql_profile, sql_sanitize, sql_strip, table, text_lines,
)


@query("sanitize", f"WITH {MARKED_DOCS} SELECT doc_id, {sql_sanitize('text')} AS clean FROM marked")
def sanitize(spark, folder):
    return marked_docs(spark, folder).select("doc_id", sanitize_text(F.col("text")).alias("clean"))


@query("role_headers", f"WITH {MARKED_DOCS} SELECT doc_id, {sql_headers('text')} AS text FROM marked")
def role_headers(spark, folder):
    return marked_docs(spark, folder).select("doc_id", strip_role_headers(F.col("text")).alias("text"))


@query("markers", f"WITH {MARKED_DOCS} SELECT doc_id, {sql_markers('text')} AS text FROM marked")
def markers(spark, folder):
    return marked_docs(spark, folder).select("doc_id", strip_markers(F.col("text")).alias("text"))


CHAT = sql_instruct("''", "instruction || ' ' || coalesce(input, '')", "output")
CODE = sql_instruct(f"'{fixed.CODE_SYSTEM}'", "instruction || chr(10) || coalesce(input, '')", "output")


@query("instruct_format", f"WITH {INSTRUCT} SELECT rec_id, {CHAT} AS chat, {CODE} AS code FROM instruct")
def instruct_format(spark, folder):
    rows = instruct_source(instruct(spark, folder), "conversations")

    def laid_out(kind, sep):
        prompt = join_prompt(F.col("instruction"), F.col("input"), sep)
        return format_instruct(fixed_system(kind), prompt, F.col("output")).alias(kind)

    return rows.select("rec_id", laid_out("chat", " "), laid_out("code", "\n"))


@query("pretrain_format", f"WITH {MARKED_DOCS} SELECT doc_id, {sql_pretrain('text')} AS formatted FROM marked")
def pretrain_format(spark, folder):
    return marked_docs(spark, folder).select("doc_id", format_pretrain(F.col("text")).alias("formatted"))


PROMPT = (
    "'<|begin_of_text|><|start_header_id|>user<|end_header_id|>' || chr(10) || chr(10) || {} || "
    "'<|eot_id|><|start_header_id|>assistant<|end_header_id|>' || chr(10) || chr(10)"
)


@query("chat_prompt", f"SELECT conv_id, turn, {PROMPT.format('text')} AS prompt FROM conversations WHERE role = 'user'")
def chat_prompt(spark, folder):
    user = table(spark, folder, "conversations").filter(F.col("role") == "user")
    return user.select("conv_id", "turn", render_chat_prompt(F.col("text")).alias("prompt"))


@query(
    "extract_answer",
    f"""WITH {INSTRUCT}, said AS (SELECT rec_id, {PROMPT.format('instruction')} || output || '<|eot_id|>'
        || CASE WHEN rec_id % 2 = 0 THEN '<|end_of_text|>' ELSE '' END AS text FROM instruct)
    SELECT rec_id, replace(replace(string_split(text, 'assistant<|end_header_id|>' || chr(10) || chr(10))[-1],
        '<|eot_id|>', ''), '<|end_of_text|>', '') AS answer FROM said""",
)
def answers(spark, folder):
    end = F.when(F.col("rec_id") % 2 == 0, F.lit("<|end_of_text|>")).otherwise(F.lit(""))
    said = F.concat(render_chat_prompt(F.col("instruction")), F.col("output"), F.lit("<|eot_id|>"), end)
    return instruct(spark, folder).select("rec_id", extract_answer(said).alias("answer"))


def _profile(name, required, forbidden, text, sql):
    @query(f"letter_profile_{name}", f"SELECT doc_id, {sql_profile(sql, required, forbidden)} AS kept FROM documents")
    def run(spark, folder):
        return docs(spark, folder).select("doc_id", letter_profile(text(), required, forbidden).alias("kept"))


def _plain_text():
    return F.col("text")


def _cyrillic_text():
    return F.when(F.col("doc_id") % 2 == 0, F.translate(F.lower("text"), "iu", "іў")).when(
        F.col("doc_id") % 4 == 1, F.translate(F.lower("text"), "iue", "іўи")
    ).otherwise(F.col("text"))


_profile("de", "äöüß", "çèêñ", _plain_text, "text")
_profile("es", "íñó", "äßçè", _plain_text, "text")
_profile(
    "be", fixed.REQUIRED_LETTERS, fixed.FORBIDDEN_LETTERS, _cyrillic_text,
    "(CASE WHEN doc_id % 2 = 0 THEN translate(lower(text), 'iu', 'іў') "
    "WHEN doc_id % 4 = 1 THEN translate(lower(text), 'iue', 'іўи') ELSE text END)",
)


@query(
    "length_filters",
    """SELECT doc_id, length(text) > 300 AS book, length(text) >= 300 AS web,
       length(text) > 20 AND length(text) < 8000 AS code FROM documents""",
)
def length_filters(spark, folder):
    text = F.col("text")
    return docs(spark, folder).select(
        "doc_id", min_length(text, strict=True).alias("book"), min_length(text).alias("web"),
        length_between(text).alias("code"),
    )


@query(
    "not_blank",
    f"WITH {LINES_SQL} SELECT file, line_no, line FROM text_lines WHERE {sql_strip('line')} <> ''",
)
def not_blank_lines(spark, folder):
    return text_lines(spark, folder).filter(not_blank(F.col("line")))


@query(
    "line_split",
    """SELECT doc_id, k - 1 AS line_no, line FROM (
        SELECT doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS k FROM (
            SELECT doc_id, list_filter(string_split_regex(
                replace(text, chr(10), CASE WHEN doc_id % 2 = 0 THEN chr(13) || chr(10) || chr(10) || ' ' || chr(10)
                ELSE chr(10) END), '\\r?\\n'), lambda x: x <> '') AS ls FROM documents))""",
)
def line_split(spark, folder):
    breaks = F.when(F.col("doc_id") % 2 == 0, F.lit("\r\n\n \n")).otherwise(F.lit("\n"))
    text = F.replace("text", F.lit("\n"), breaks)
    rows = docs(spark, folder).select("doc_id", F.posexplode(split_lines(text)).alias("line_no", "line"))
    return rows.withColumn("line_no", F.col("line_no").cast("bigint"))


@query("utf8_bytes", "SELECT doc_id, strlen(text) AS bytes, strlen(text) + 1 AS line_bytes FROM documents")
def byte_lengths(spark, folder):
    text = F.col("text")
    return docs(spark, folder).select(
        "doc_id", utf8_bytes(text).alias("bytes"), utf8_bytes(text, newline=True).alias("line_bytes")
    )


@query(
    "nfc",
    """SELECT doc_id, replace(nfc_normalize(replace(replace(text, chr(233), 'e' || chr(769)), chr(252), 'u' || chr(776))
        || '\\s+  x'), '\\s+', ' ') AS text FROM documents""",
)
def nfc(spark, folder):
    apart = F.replace("text", F.lit("\u00e9"), F.lit("e\u0301"))
    apart = F.replace(apart, F.lit("\u00fc"), F.lit("u\u0308"))
    return docs(spark, folder).select("doc_id", normalize_nfc(F.concat(apart, F.lit(r"\s+  x"))).alias("text"))


@query(
    "valid_utf8",
    "SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN text ELSE replace(text, 'e', '') END AS text FROM documents",
)
def valid_utf8(spark, folder):
    # Every 'e' of two documents in three becomes a byte that cannot be decoded.
    broken = F.array_join(F.transform(F.split("text", "e"), lambda part: F.hex(part)), "FF")
    raw = F.when(F.col("doc_id") % 3 == 0, F.col("text")).otherwise(F.unhex(broken).cast("string"))
    return docs(spark, folder).select("doc_id", drop_invalid_utf8(raw).alias("text"))


@query(
    "quarantine",
    f"""WITH given AS (SELECT doc_id, CASE WHEN doc_id % 11 = 0 THEN NULL ELSE text END AS text FROM documents)
    SELECT doc_id, CASE WHEN text IS NULL THEN 'no_text' WHEN NOT length(text) >= 300 THEN 'too_short'
        WHEN NOT {sql_profile('text', 'éü', 'ñ')} THEN 'letters' END AS reason FROM given""",
)
def quarantined(spark, folder):
    text = F.when(F.col("doc_id") % 11 != 0, F.col("text"))
    given = docs(spark, folder).select("doc_id", text.alias("text"))
    rules = {
        "no_text": F.col("text").isNotNull(),
        "too_short": min_length(F.col("text")),
        "letters": letter_profile(F.col("text"), "éü", "ñ"),
    }
    return quarantine(given, rules).select("doc_id", "reason")


@query(
    "drop_empty",
    f"""SELECT doc_id, formatted FROM (SELECT doc_id, {sql_pretrain('text')} AS formatted FROM documents
        WHERE doc_id % 11 <> 0) WHERE formatted <> ''""",
)
def drop_empty(spark, folder):
    text = F.when(F.col("doc_id") % 11 != 0, F.col("text"))
    present = drop_nulls(docs(spark, folder).select("doc_id", text.alias("text")))
    return drop_empty_formatted(present.select("doc_id", format_pretrain(F.col("text")).alias("formatted")))


# A blank line after every third line of a document.
SPACED_SQL = """spaced AS (SELECT doc_id, list_transform(string_split(text, chr(10)),
    lambda x, i: x || chr(10) || CASE WHEN i % 3 = 0 THEN ' ' || chr(10) ELSE '' END) AS parts FROM documents),
    lined AS (SELECT doc_id, list_filter(string_split_regex(array_to_string(parts, ''), '\\n'),
        lambda x: true) AS ls FROM spaced),
    lines AS (SELECT doc_id, list_transform(ls[:len(ls) - 1], lambda x: x || chr(10)) AS ls FROM lined)"""


def chunk_sql(key: str, source: str) -> str:
    return f"""folded AS (SELECT {key}, {sql_chunks('ls')} AS acc FROM {source}),
    chunks AS (SELECT {key}, CASE WHEN length(acc.cur) > 300 THEN list_append(acc.done, acc.cur) ELSE acc.done END
        AS cs FROM folded)
    SELECT {key}, chunk, k - 1 AS chunk_no FROM (
        SELECT {key}, unnest(cs) AS chunk, generate_subscripts(cs, 1) AS k FROM chunks)"""


@query("chunk_docs", f"WITH {SPACED_SQL}, {chunk_sql('doc_id', 'lines')}")
def document_chunks(spark, folder):
    spaced = F.array_join(
        F.transform(
            F.split("text", "\n"),
            lambda x, i: F.concat(x, F.lit("\n"), F.when(i % 3 == 2, F.lit(" \n")).otherwise(F.lit(""))),
        ), "",
    )
    chunks = chunk_docs(docs(spark, folder).select("doc_id", spaced.alias("text")))
    return chunks.select("doc_id", "chunk", F.col("chunk_no").cast("bigint").alias("chunk_no"))


@query(
    "chunk_paragraphs",
    f"""WITH {LINES_SQL}, lines AS (SELECT file, list(line || chr(10) ORDER BY line_no) AS ls
        FROM text_lines GROUP BY file), {chunk_sql('file', 'lines')}""",
)
def file_chunks(spark, folder):
    # These lines are numbered by document, two million places each: a block is what 16 documents hold.
    return chunk_paragraphs(text_lines(spark, folder), block_lines=32_000_000).select("file", "chunk", "chunk_no")
