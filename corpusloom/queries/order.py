"""Running totals, shuffles, interleave, clusters, epochs."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.mix import GAP_UNITS, interleave_uniform, mix
from ..operators.order import (
    cluster_greedy, cluster_grid, cluster_order_columns, epoch_key, epochs, hex_bucket, prefix_sum, running,
    window_shuffle, with_shuffled_position,
)
from . import query
from .inputs import docs, sql_key, sql_word, table

CLUSTER = 100_000
BUFFER = 150


@query(
    "prefix_sum",
    f"""SELECT doc_id, source, (sum(n_chars) OVER (ORDER BY doc_id) - n_chars)::BIGINT AS before,
        (sum(n_chars) OVER (PARTITION BY source ORDER BY doc_id) - n_chars)::BIGINT AS in_source,
        (sum(n_chars) OVER (ORDER BY {sql_key(3, 'doc_id')}, doc_id) - n_chars)::BIGINT AS shuffled FROM documents""",
)
def prefix_sums(spark, folder):
    rows = table(spark, folder, "documents").select("doc_id", "source", "n_chars")
    rows = running(rows, "doc_id", "n_chars")
    rows = running(rows, "doc_id", "n_chars", by=["source"], out="in_source")
    rows = with_shuffled_position(rows, 3, value="n_chars", out="shuffled")
    return rows.select("doc_id", "source", "before", "in_source", "shuffled")


@query(
    "window_shuffle",
    f"""WITH laid AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS pos FROM documents)
    SELECT doc_id, pos // {BUFFER} AS block,
        row_number() OVER (PARTITION BY pos // {BUFFER} ORDER BY {sql_key(4, 'doc_id')}, doc_id) - 1 AS rank FROM laid""",
)
def windows(spark, folder):
    laid = running(docs(spark, folder).select("doc_id"), "doc_id", 1, out="pos")
    return window_shuffle(laid, 4, "pos", ["doc_id"], BUFFER).select("doc_id", "block", "rank")


@query(
    "shuffle_docs",
    f"SELECT doc_id, row_number() OVER (ORDER BY {sql_key(6, 'doc_id')}, doc_id) - 1 AS pos FROM documents",
)
def shuffled(spark, folder):
    return with_shuffled_position(docs(spark, folder).select("doc_id"), 6).select("doc_id", "pos")


GAP = f"floor(-ln(({sql_word(sql_key(8, 'source', 'doc_id'))} + 1)::DOUBLE / 4294967297::DOUBLE) * {GAP_UNITS})::BIGINT"
INTERLEAVED = f"""laid AS (SELECT source, doc_id, (sum(g) OVER (PARTITION BY source ORDER BY doc_id))::BIGINT AS arrival
    FROM (SELECT source, doc_id, {GAP} AS g FROM documents))"""


@query("interleave_uniform", f"WITH {INTERLEAVED} SELECT * FROM laid")
def interleaved(spark, folder):
    return interleave_uniform(docs(spark, folder).select("source", "doc_id"), 8)


@query(
    "interleave_mix",
    f"""WITH {INTERLEAVED}, placed AS (SELECT *, row_number() OVER (ORDER BY arrival, source, doc_id) - 1 AS position FROM laid)
    SELECT source, doc_id, position, position // {BUFFER} AS block, row_number() OVER (
        PARTITION BY position // {BUFFER} ORDER BY {sql_key(8, 'source', 'doc_id')}, source, doc_id) - 1 AS rank FROM placed""",
)
def mixed(spark, folder):
    rows = docs(spark, folder).select("source", "doc_id")
    return mix(rows, 8, 20, buffer=BUFFER).select("source", "doc_id", "position", "block", "rank")


BYTES = "(2 * n_chars)"
GRID = f"""laid AS (SELECT doc_id, source, n_chars, (sum({BYTES}) OVER (ORDER BY doc_id) - {BYTES})::BIGINT AS b
    FROM documents), grid AS (SELECT doc_id, b AS bytes_before, b // {CLUSTER} AS cluster FROM laid)"""


@query(
    "cluster_grid",
    f"""WITH {GRID} SELECT *, row_number() OVER (
        ORDER BY {sql_key(2, '0', 'cluster')}, cluster, {sql_key(2, '0', 'doc_id')}, doc_id) - 1 AS pos FROM grid""",
)
def grid_clusters(spark, folder):
    rows = table(spark, folder, "documents").select("doc_id", "n_chars")
    grid = cluster_grid(rows, "n_chars", limit_bytes=CLUSTER).select("doc_id", "bytes_before", "cluster")
    keyed = grid.withColumns(cluster_order_columns(2, "doc_id"))
    laid = prefix_sum(
        keyed, ["cluster_key", "cluster", "doc_key", "doc_id"], 1, bucket=hex_bucket(keyed, "cluster_key"), out="pos"
    )
    return laid.select("doc_id", "bytes_before", "cluster", "pos")


@query(
    "cluster_greedy",
    f"""WITH sizes AS (SELECT list(n_chars ORDER BY doc_id) AS ns, list(doc_id ORDER BY doc_id) AS ids FROM documents),
    folded AS (SELECT ids, list_reduce(ns, lambda acc, n: {{
        'size': CASE WHEN acc.size + 2 * n >= {CLUSTER} THEN 0 ELSE acc.size + 2 * n END,
        'no': CASE WHEN acc.size + 2 * n >= {CLUSTER} THEN acc.no + 1 ELSE acc.no END,
        'out': list_append(acc.out, acc.no)}},
        {{'size': 0::BIGINT, 'no': 0::BIGINT, 'out': []::BIGINT[]}}) AS acc FROM sizes)
    SELECT unnest(ids) AS doc_id, unnest(acc.out) AS cluster FROM folded""",
)
def greedy_clusters(spark, folder):
    sizes = table(spark, folder, "documents").select("doc_id", F.col("n_chars").alias("n_tokens"))
    return cluster_greedy(sizes, limit_bytes=CLUSTER, segment_clusters=3).select("doc_id", "cluster")


@query(
    "epochs",
    f"""SELECT doc_id, e::INTEGER AS epoch, row_number() OVER (
        PARTITION BY e ORDER BY {sql_key(7, 'e', 'doc_id')}, doc_id) - 1 AS pos FROM documents, range(3) t(e)""",
)
def epoch_orders(spark, folder):
    rows = epochs(docs(spark, folder).select("doc_id"), 3).withColumn("key", epoch_key(7, "doc_id"))
    laid = prefix_sum(rows, ["key", "doc_id"], 1, by=["epoch"], bucket=hex_bucket(rows, "key"), out="pos")
    return laid.select("doc_id", "epoch", "pos")
