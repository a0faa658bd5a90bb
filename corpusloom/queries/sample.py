"""Upsampling, caps, byte samples, unions."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.layout import format_pretrain
from ..functions.predicates import min_length
from ..operators.mix import union_sources
from ..operators.sample import bernoulli_by_bytes, cap_per_source, cluster_sample_files, head_by_bytes, upsample
from ..session import scratch_dir
from ..sources.tables import doc_source, read_cluster_sample, read_docs_parquet, unreadable_files
from . import query
from .inputs import INSTRUCT, LINES_SQL, docs, instruct, sql_key, sql_strip, sql_word, table, text_lines

HEAD_LIMIT, TARGET, SLACK, FILE_ROWS = 600_000, 300_000, 20_000, 333


@query("upsample", "SELECT doc_id, source, c::INTEGER AS copy_no FROM documents, range(1, 4) t(c)")
def upsampled(spark, folder):
    return upsample(docs(spark, folder).select("doc_id", "source"), 3)


RANK = "row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS nth"


@query("cap_input", f"SELECT * FROM (SELECT doc_id, source, {RANK} FROM documents) WHERE nth < 30")
def cap_input(spark, folder):
    return cap_per_source(docs(spark, folder).select("doc_id", "source"), 30)


@query(
    "cap_eligible",
    f"SELECT * FROM (SELECT doc_id, source, {RANK} FROM documents WHERE length(text) >= 300) WHERE nth < 30",
)
def cap_eligible(spark, folder):
    capped = cap_per_source(docs(spark, folder), 30, eligible=min_length(F.col("text")))
    return capped.select("doc_id", "source", "nth")


@query(
    "cluster_sample",
    f"""SELECT * FROM (SELECT source, doc_id, row_number() OVER (
        ORDER BY {sql_key(5, 'source')}, source, doc_id) - 1 AS nth FROM documents) WHERE nth < {FILE_ROWS}""",
)
def cluster_sample(spark, folder):
    rows = docs(spark, folder).select("source", "doc_id")
    return cluster_sample_files(rows, FILE_ROWS, 5, file="source", order="doc_id")


@query(
    "head_by_bytes",
    f"""WITH {LINES_SQL}, kept AS (SELECT *, strlen(line) + 1 AS b FROM text_lines WHERE {sql_strip('line')} <> ''),
    summed AS (SELECT *, (sum(b) OVER (ORDER BY file, line_no) - b)::BIGINT AS bytes_before FROM kept)
    SELECT file, line_no, line, bytes_before FROM summed WHERE bytes_before <= {HEAD_LIMIT}""",
)
def head_bytes(spark, folder):
    return head_by_bytes(text_lines(spark, folder), HEAD_LIMIT)


@query(
    "bernoulli_bytes",
    f"""WITH {LINES_SQL}, total AS (SELECT sum(strlen(line) + 1) AS t FROM text_lines),
    passing AS (SELECT file, line_no, line, strlen(line) AS b FROM text_lines, total
        WHERE t < {TARGET} OR ({sql_strip('line')} <> '' AND
            {sql_word(sql_key(9, 'file', 'line_no'))} / 4294967296::DOUBLE < {TARGET}::DOUBLE / t)),
    summed AS (SELECT *, (sum(b) OVER (ORDER BY file, line_no) - b)::BIGINT AS bytes_before,
        row_number() OVER (PARTITION BY file ORDER BY line_no) AS nth FROM passing)
    SELECT file, line_no, line, bytes_before FROM summed, total
    WHERE t < {TARGET} OR bytes_before < {TARGET + SLACK} OR nth = 1""",
)
def bernoulli_bytes(spark, folder):
    return bernoulli_by_bytes(text_lines(spark, folder), 9, TARGET, SLACK)


@query(
    "union_sources",
    f"""WITH {INSTRUCT}
    SELECT doc_id, source, text FROM documents
    UNION ALL SELECT rec_id, source, output FROM instruct
    UNION ALL SELECT page_id, 'pages', html FROM pages""",
)
def unions(spark, folder):
    answers = instruct(spark, folder).select(F.col("rec_id").alias("doc_id"), "source", F.col("output").alias("text"))
    pages = doc_source(table(spark, folder, "pages"), "pages", text="html", doc_id="page_id")
    return union_sources([docs(spark, folder), None, answers, pages])


@query(
    "sample_then_format",
    f"""SELECT source, count(*) AS n_selected, count(*) FILTER (length(text) >= 300) AS n_nonempty FROM (
        SELECT source, text, {RANK} FROM documents) WHERE nth < 30 GROUP BY source""",
)
def capped_formats(spark, folder):
    """Empty layouts count against a cap: both counts side by side."""
    capped = cap_per_source(docs(spark, folder), 30)
    formatted = capped.withColumn("formatted", format_pretrain(F.col("text")))
    return formatted.groupBy("source").agg(
        F.count("*").alias("n_selected"), F.count_if(F.col("formatted") != "").alias("n_nonempty")
    )


def by_source(spark, folder) -> str:
    """Documents as real files, one for each source, rows by id."""
    path = scratch_dir(spark, "files")
    rows = docs(spark, folder).select("source", "doc_id", "text").repartition("source").sortWithinPartitions("source", "doc_id")
    rows.write.partitionBy("source").parquet(path)
    return path


@query(
    "cluster_sample_read",
    f"""WITH files AS (SELECT source, count(*) AS n, {sql_key(19, 'source')} AS k FROM documents GROUP BY source),
    laid AS (SELECT source, sum(n) OVER (ORDER BY k) - n AS before FROM files)
    SELECT * FROM (SELECT source, doc_id, (before + row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1)::BIGINT AS nth
        FROM documents JOIN laid USING (source)) WHERE nth < {FILE_ROWS}""",
)
def sampled_files(spark, folder):
    name = F.regexp_extract("file", "/source=([^/]*)/", 1)
    return read_cluster_sample(spark, by_source(spark, folder), FILE_ROWS, 19, name).select("source", "doc_id", "nth")


@query(
    "unreadable_files",
    """SELECT 'unreadable' AS reason, count(DISTINCT source) AS n_files, count(*) AS n_rows
    FROM documents""",
)
def unreadable(spark, folder):
    """A folder of Parquet files with as many others between them: the good are read, the others listed."""
    path = by_source(spark, folder)
    broken = docs(spark, folder).select("source", F.lit("this is not a table").alias("value")).distinct().repartition("source")
    broken.write.mode("append").partitionBy("source").text(path)
    rows = doc_source(read_docs_parquet(spark, path).withColumn("doc_id", F.lit(0)), "files").count()
    names = unreadable_files(spark, path).filter(~F.col("file").rlike("/[_.][^/]*$"))
    return names.groupBy("reason").agg(F.count("*").alias("n_files")).withColumn("n_rows", F.lit(rows).cast("bigint"))
