"""Fixed-length rows from token documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.pack import pack_across_epochs, pack_linear, pack_rows
from ..session import stage
from . import query
from .inputs import TOKENS_SQL, sql_key
from .tokens import listed, token_docs

CTX, BATCH, EPOCHS = 64, 4, 2
L = CTX + 1

SHUFFLED = f"""keyed AS (SELECT *, {sql_key(11, 'doc_id')} AS k FROM known),
flat AS (SELECT id, row_number() OVER (ORDER BY k, doc_id, i) - 1 AS pos FROM keyed)"""
IN_ORDER = "flat AS (SELECT id, row_number() OVER (ORDER BY doc_id, i) - 1 AS pos FROM known)"
ENDLESS = f"""keyed AS (SELECT doc_id, i, id, e, {sql_key(12, 'e', 'doc_id')} AS k FROM known, range({EPOCHS}) t(e)),
flat AS (SELECT id, row_number() OVER (ORDER BY e, k, doc_id, i) - 1 AS pos FROM keyed)"""


def rows_sql(flat: str, row: str, used: str = "true", whole: str = "true") -> str:
    return f"""WITH {TOKENS_SQL}, {flat},
    placed AS (SELECT {row} AS row_id, pos, id FROM flat WHERE {used}),
    packed AS (SELECT row_id, list(id ORDER BY pos) AS t FROM placed GROUP BY row_id HAVING count(*) = {L})
    SELECT row_id, row_id // {BATCH} AS batch_id, array_to_string(t[:{CTX}], ' ') AS input_ids,
        array_to_string(t[2:], ' ') AS labels FROM packed WHERE {whole}"""


def shown(rows, *more):
    return rows.select(*more, "row_id", "batch_id", listed(F.col("input_ids")).alias("input_ids"), listed(F.col("labels")).alias("labels"))


@query("pack_rows", rows_sql(IN_ORDER, f"pos // {L}"))
def packed(spark, folder):
    return shown(pack_rows(token_docs(spark, folder), CTX, BATCH))


@query("pack_shuffled", rows_sql(SHUFFLED, f"pos // {L}"))
def packed_shuffled(spark, folder):
    return shown(pack_rows(token_docs(spark, folder), CTX, BATCH, seed=11))


PERIOD, KEEP = BATCH * (CTX + 2), BATCH * L


@query(
    "pack_discard",
    rows_sql(IN_ORDER, f"(pos // {PERIOD}) * {BATCH} + (pos % {PERIOD}) // {L}", f"pos % {PERIOD} < {KEEP}"),
)
def packed_discarding(spark, folder):
    return shown(pack_rows(token_docs(spark, folder), CTX, BATCH, discard_per_batch=True))


@query(
    "pack_linear",
    rows_sql(IN_ORDER, f"pos // {L}", whole=f"row_id < {BATCH} * ((SELECT count(*) FROM flat) // {BATCH * L})"),
)
def packed_linear(spark, folder):
    return shown(pack_linear(token_docs(spark, folder), CTX, BATCH))


REWOUND = 3
WHOLE = f"((SELECT count(*) FROM flat) // {BATCH * L} * {BATCH})"


@query(
    "pack_rewound",
    f"""WITH {TOKENS_SQL}, {IN_ORDER},
    packed AS (SELECT pos // {L} AS nth, list(id ORDER BY pos) AS t FROM flat GROUP BY 1 HAVING count(*) = {L}),
    again AS (SELECT nth + r * {WHOLE} AS row_id, t FROM packed, range({REWOUND}) x(r) WHERE nth < {WHOLE})
    SELECT row_id, row_id // {BATCH} AS batch_id, array_to_string(t[:{CTX}], ' ') AS input_ids,
        array_to_string(t[2:], ' ') AS labels FROM again
    WHERE row_id < {BATCH} * (({WHOLE} * {REWOUND} - {BATCH}) // {BATCH})""",
)
def packed_rewound(spark, folder):
    """Nearly three passes in file order: one batch less than three times the whole batches of one pass."""
    docs = stage(token_docs(spark, folder))
    tokens = docs.agg(F.sum(F.size("ids"))).first()[0]
    return shown(pack_linear(docs, CTX, BATCH, n_batches=REWOUND * (tokens // (BATCH * L)) - 1))


@query("pack_epochs", rows_sql(ENDLESS, f"pos // {L}"))
def packed_epochs(spark, folder):
    return shown(pack_across_epochs(token_docs(spark, folder), EPOCHS, CTX, BATCH, seed=12))


@query(
    "shift_labels",
    f"""WITH {TOKENS_SQL}, rows_ AS (SELECT doc_id, list(id ORDER BY i) AS t FROM known GROUP BY doc_id)
    SELECT doc_id, array_to_string(t[:len(t) - 1], ' ') AS input_ids, array_to_string(t[2:], ' ') AS labels FROM rows_""",
)
def shifted(spark, folder):
    from ..functions.arrays import shift_inputs, shift_labels

    rows = token_docs(spark, folder)
    return rows.select(
        "doc_id", listed(shift_inputs(F.col("ids"))).alias("input_ids"), listed(shift_labels(F.col("ids"))).alias("labels")
    )
