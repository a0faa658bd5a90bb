"""Word counts, vocabularies, ids, pieces."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import fixed
from ..functions.arrays import clamp_ids, drop_unknown_ids, pack_u16, unpack_u16
from ..operators.encode import decode_bpe, decode_words, encode_bpe, encode_words
from ..operators.order import prefix_sum, quantile_bucket
from ..operators.sample import top_k
from ..operators.tokens import flatten_tokens, number_flat_sequences, peek_tokens, split_at_eos
from ..operators.vocab import build_vocab, characters, learn_bpe, word_counts, word_vocab
from ..session import scratch_dir, stage
from ..sources.tokenbin import peek_shards, write_token_shards
from . import query
from .inputs import TOKENS, TOKENS_SQL, VOCAB, VOCAB_WORDS, WORDS, docs, sql_strip

CLAMP = 500
#: Merges of the queries whose SQL twin unrolls the one-by-one loop, a pair of statements a merge.
N_MERGES = 20
LINE_MERGES, TEXT_MERGES, LOOP_MERGES = 60, 1_000, 200


def vocab(spark, folder):
    return word_vocab(word_counts(docs(spark, folder)), VOCAB_WORDS)


def raw_ids(spark, folder):
    """Word ids with unknown words as 0, an end marker after every document."""
    ids = encode_words(F.col("text"), vocab(spark, folder), drop_unknown=False)
    return docs(spark, folder).select("doc_id", "source", F.concat(ids, F.array(F.lit(fixed.EOS_ID))).alias("ids"))


def token_docs(spark, folder):
    """Word ids, unknown words left out, an end marker after every document."""
    ids = encode_words(F.col("text"), vocab(spark, folder))
    return docs(spark, folder).select("doc_id", "source", F.concat(ids, F.array(F.lit(fixed.EOS_ID))).alias("ids"))


def listed(ids):
    return F.array_join(F.transform(ids, lambda x: x.cast("string")), " ")


@query("word_counts", f"WITH {WORDS} SELECT word, count(*) AS n FROM words GROUP BY word")
def counts(spark, folder):
    return word_counts(docs(spark, folder))


@query("top_words", f"WITH {WORDS} SELECT word, count(*) AS n FROM words GROUP BY word ORDER BY n DESC, word LIMIT 50")
def frequent(spark, folder):
    return top_k(word_counts(docs(spark, folder)), 50, "n", ["word"])


@query("word_vocab", f"WITH {WORDS}, {VOCAB} SELECT word AS piece, id FROM vocab")
def vocabulary(spark, folder):
    return vocab(spark, folder).select("piece", F.col("id").cast("bigint").alias("id"))


@query(
    "encode_words",
    f"WITH {WORDS}, {VOCAB}, {TOKENS} SELECT doc_id, string_agg(id::VARCHAR, ' ' ORDER BY i) AS ids FROM tokens GROUP BY doc_id",
)
def encoded(spark, folder):
    return raw_ids(spark, folder).select("doc_id", listed(F.col("ids")).alias("ids"))


@query(
    "drop_unknown",
    f"WITH {TOKENS_SQL} SELECT doc_id, string_agg(id::VARCHAR, ' ' ORDER BY i) AS ids FROM known GROUP BY doc_id",
)
def without_unknown(spark, folder):
    return raw_ids(spark, folder).select("doc_id", listed(drop_unknown_ids(F.col("ids"))).alias("ids"))


@query(
    "clamp",
    f"""WITH {TOKENS_SQL} SELECT doc_id, string_agg(least(id, {CLAMP - 1})::VARCHAR, ' ' ORDER BY i) AS ids
    FROM known GROUP BY doc_id""",
)
def clamped(spark, folder):
    return token_docs(spark, folder).select("doc_id", listed(clamp_ids(F.col("ids"), CLAMP)).alias("ids"))


# A frequent word plays the end marker, so that documents hold many sequences and a remainder.
MARK = 5


@query(
    "split_eos",
    f"""WITH {TOKENS_SQL}, inner_ids AS (SELECT doc_id, i, id FROM known WHERE id <> 2),
    cut AS (SELECT *, coalesce(sum((id = {MARK})::INT) OVER (PARTITION BY doc_id ORDER BY i
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS seq_no FROM inner_ids)
    SELECT doc_id, seq_no, string_agg(id::VARCHAR, ' ' ORDER BY i) AS ids FROM cut GROUP BY doc_id, seq_no""",
)
def sequences(spark, folder):
    inner = token_docs(spark, folder).select("doc_id", F.filter("ids", lambda x: x != fixed.EOS_ID).alias("ids"))
    parts = split_at_eos(inner, eos_id=MARK)
    return parts.select("doc_id", F.col("seq_no").cast("bigint").alias("seq_no"), listed(F.col("ids")).alias("ids"))


FLAT = f"""flat AS (SELECT source AS shard, id,
    row_number() OVER (PARTITION BY source ORDER BY doc_id, i) - 1 AS pos FROM known)"""


@query(
    "flat_sequences",
    f"""WITH {TOKENS_SQL}, {FLAT}, cut AS (SELECT *, coalesce(sum((id = 2)::INT) OVER (PARTITION BY shard ORDER BY pos
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS seq_no FROM flat)
    SELECT shard, seq_no, count(*) AS n_tokens, min(pos) AS start FROM cut GROUP BY shard, seq_no""",
)
def flat_sequences(spark, folder):
    laid = prefix_sum(
        quantile_bucket(token_docs(spark, folder), "doc_id"), ["doc_id"], F.size("ids"), by=["source"],
        bucket="__bucket", out="start",
    )
    flat = laid.select("source", F.posexplode("ids").alias("k", "id"), "start").select(
        F.col("source").alias("shard"), (F.col("start") + F.col("k")).alias("pos"), "id"
    )
    return number_flat_sequences(flat).groupBy("shard", "seq_no").agg(
        F.count("*").alias("n_tokens"), F.min("pos").alias("start")
    )


@query(
    "flat_tokens",
    f"""WITH {TOKENS_SQL} SELECT row_number() OVER (ORDER BY doc_id, i) - 1 AS pos, id FROM known""",
)
def flat(spark, folder):
    laid = prefix_sum(
        quantile_bucket(token_docs(spark, folder), "doc_id"), ["doc_id"], F.size("ids"), bucket="__bucket", out="start"
    )
    return flatten_tokens(laid).select("pos", F.col("id").cast("bigint").alias("id"))


@query(
    "decode",
    f"""WITH {TOKENS_SQL} SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS text
    FROM known JOIN vocab USING (id) GROUP BY doc_id""",
)
def decoded(spark, folder):
    text = decode_words(F.col("ids"), vocab(spark, folder))
    return token_docs(spark, folder).select("doc_id", text.alias("text"))


PEEK_AT, PEEK = 5_000, 500


@query(
    "peek",
    f"""WITH {TOKENS_SQL}, flat AS (SELECT doc_id, id, row_number() OVER (ORDER BY doc_id, i) - 1 AS pos FROM known)
    SELECT doc_id, min(pos) AS start, string_agg(id::VARCHAR, ' ' ORDER BY pos) AS ids FROM flat
    WHERE pos >= {PEEK_AT} AND pos < {PEEK_AT + PEEK} GROUP BY doc_id""",
)
def peeked(spark, folder):
    return peek_tokens(token_docs(spark, folder), PEEK_AT, PEEK).select("doc_id", "start", listed(F.col("ids")).alias("ids"))


@query(
    "peek_shards",
    f"""WITH {TOKENS_SQL}, flat AS (SELECT doc_id, i, id, row_number() OVER (ORDER BY doc_id, i) - 1 AS pos FROM known)
    SELECT min(pos)::BIGINT AS start, string_agg(id::VARCHAR, ' ' ORDER BY pos) AS ids FROM flat
    WHERE pos >= {PEEK_AT} AND pos < {PEEK_AT + PEEK} GROUP BY doc_id""",
)
def peeked_shards(spark, folder):
    """The same stretch out of stored shards, of which only those that hold it are opened."""
    path = scratch_dir(spark, "peek")
    write_token_shards(token_docs(spark, folder), path, order=["doc_id"], shard_bytes=1 << 12)
    return peek_shards(spark, path, PEEK_AT, PEEK).select("start", listed(F.col("ids")).alias("ids"))


@query(
    "u16_roundtrip",
    f"""WITH {TOKENS_SQL} SELECT doc_id, string_agg(id::VARCHAR, ' ' ORDER BY i) AS ids, (2 * count(*))::BIGINT AS bytes
    FROM known GROUP BY doc_id""",
)
def roundtrip(spark, folder):
    packed = token_docs(spark, folder).select("doc_id", pack_u16(F.col("ids")).alias("packed"))
    return packed.select(
        "doc_id", listed(unpack_u16(F.col("packed"))).alias("ids"), F.octet_length("packed").cast("bigint").alias("bytes")
    )


# --- byte-pair encoding ------------------------------------------------------------
def tokenizer(spark, folder):
    types = stage(word_counts(docs(spark, folder)))
    merges = learn_bpe(types, N_MERGES)
    return merges, build_vocab(merges, characters(types))


def merge_steps(n: int) -> str:
    """The one-by-one loop, unrolled: count pairs, take the best, replace it in all words."""
    o, c = "chr(64976)", "chr(64977)"
    steps = [
        f"""t0 AS MATERIALIZED (SELECT word, regexp_replace('▁' || word, '(.)', {o} || '\\1' || {c}, 'gs') AS s,
            count(*) AS n FROM words GROUP BY word)"""
    ]
    for k in range(n):
        steps.append(
            f"""b{k} AS MATERIALIZED (SELECT l, r FROM (SELECT p[j] AS l, p[j + 1] AS r, n FROM (
                SELECT p, n, unnest(range(1, len(p))) AS j FROM (
                    SELECT string_split(s[2:length(s) - 1], {c} || {o}) AS p, n FROM t{k})))
                WHERE length(l) + length(r) <= 32
                GROUP BY l, r HAVING sum(n) >= 2 ORDER BY sum(n) DESC, l, r LIMIT 1)"""
        )
        steps.append(
            f"""t{k + 1} AS MATERIALIZED (SELECT word, replace(s, {o} || l || {c} || {o} || r || {c},
                {o} || l || r || {c}) AS s, n FROM t{k}, b{k})"""
        )
    taken = " UNION ALL ".join(f'SELECT {k} AS rank, l AS "left", r AS "right" FROM b{k}' for k in range(n))
    return f"{WORDS}, {', '.join(steps)}, merges AS MATERIALIZED ({taken})"


def symbols_sql(step: str) -> str:
    return f"string_split(s[2:length(s) - 1], chr(64977) || chr(64976)) FROM {step}"


# Specials, byte pieces, merged pieces, then characters by count.
PIECES = f"""specials AS (SELECT unnest(range({len(fixed.WORD_SPECIALS)})) AS id, unnest({fixed.WORD_SPECIALS!r}) AS piece),
chars AS (SELECT piece, sum(n) AS n FROM (SELECT n, unnest(p) AS piece FROM (SELECT n, {symbols_sql('t0').replace(' FROM', ' AS p FROM')}))
    GROUP BY piece),
pieces AS MATERIALIZED (
    SELECT id, piece, 'special' AS kind FROM specials
    UNION ALL SELECT {len(fixed.WORD_SPECIALS)} + b, printf('<0x%02X>', b), 'byte' FROM range(256) t(b)
    UNION ALL SELECT {len(fixed.WORD_SPECIALS) + 256} + rank, "left" || "right", 'merge' FROM merges
    UNION ALL SELECT {len(fixed.WORD_SPECIALS) + 255} + (SELECT count(*) FROM merges)
        + row_number() OVER (ORDER BY n DESC, piece), piece, 'char' FROM chars)"""
CODED = f"""parts AS (SELECT word, unnest(p) AS piece, generate_subscripts(p, 1) AS j FROM (
    SELECT word, {symbols_sql(f't{N_MERGES}').replace(' FROM', ' AS p FROM')})),
coded AS MATERIALIZED (SELECT doc_id, i, j, id, piece FROM words JOIN parts USING (word) JOIN pieces USING (piece))"""
BPE = f"{merge_steps(N_MERGES)}, {PIECES}, {CODED}"


@query("learn_bpe", f"WITH {merge_steps(N_MERGES)} SELECT * FROM merges")
def bpe_merges(spark, folder):
    return learn_bpe(word_counts(docs(spark, folder)), N_MERGES)


@query("learn_bpe_loop")
def bpe_merges_loop(spark, folder):
    """The loop itself, far beyond what SQL can unroll; tests hold it against plain lists."""
    return learn_bpe(stage(word_counts(docs(spark, folder))), LOOP_MERGES)


@query("learn_bpe_batched")
def bpe_merges_batched(spark, folder):
    return learn_bpe(word_counts(docs(spark, folder)), fixed.VOCAB_SIZE, exact=False)


@query("build_vocab", f"WITH {merge_steps(N_MERGES)}, {PIECES} SELECT id::BIGINT AS id, piece, kind FROM pieces")
def pieces(spark, folder):
    return tokenizer(spark, folder)[1].withColumn("id", F.col("id").cast("bigint"))


@query("encode_bpe", f"WITH {BPE} SELECT doc_id, string_agg(id::VARCHAR, ' ' ORDER BY i, j) AS ids FROM coded GROUP BY doc_id")
def bpe_ids(spark, folder):
    merges, ids = tokenizer(spark, folder)
    return docs(spark, folder).select("doc_id", listed(encode_bpe(F.col("text"), merges, ids)).alias("ids"))


@query(
    "bpe_roundtrip",
    f"""SELECT doc_id, regexp_replace({sql_strip('text')}, '{fixed.WHITESPACE_CLASS}+', ' ', 'g') AS text FROM documents""",
)
def bpe_roundtrip(spark, folder):
    merges, ids = tokenizer(spark, folder)
    coded = docs(spark, folder).select("doc_id", encode_bpe(F.col("text"), merges, ids).alias("ids"))
    return coded.select("doc_id", decode_bpe(F.col("ids"), ids).alias("text"))


ODD_TAIL = "chr(9) || '  end ' || chr(9) || 'e' || chr(769) || ' ' || chr(233) || ' ' || chr(29483) || '  '"


@query(
    "bpe_text_roundtrip",
    f"""SELECT doc_id, replace('    ' || text || {ODD_TAIL}, chr(10), ' ') AS text FROM documents WHERE text IS NOT NULL""",
)
def text_roundtrip(spark, folder):
    """The text layout keeps every character: indentation, tabs, decomposed and composed letters, and one never learnt."""
    types = stage(word_counts(docs(spark, folder), pretok="text"))
    merges = learn_bpe(types, TEXT_MERGES, pretok="text", exact=False)
    ids = build_vocab(merges, characters(types, "text"), "text")
    odd = docs(spark, folder).filter("text is not null").select(
        "doc_id", F.concat(F.lit("    "), "text", F.lit("\t  end \te\u0301 \u00e9 \u732b  ")).alias("text")
    )
    coded = odd.select("doc_id", encode_bpe(F.col("text"), merges, ids, "text").alias("ids"))
    return coded.select("doc_id", decode_bpe(F.col("ids"), ids, "text").alias("text"))


@query(
    "bpe_lines_roundtrip",
    """SELECT doc_id, replace(replace(nfc_normalize(replace(text, 'e', 'e' || chr(769))), '\\s+', ' '), chr(10), '') AS text
    FROM documents""",
)
def line_roundtrip(spark, folder):
    """The line layout keeps every byte of a line after NFC; only newlines give no token."""
    apart = docs(spark, folder).withColumn("text", F.replace("text", F.lit("e"), F.lit("e\u0301")))
    types = stage(word_counts(apart, pretok="line"))
    merges = learn_bpe(types, LINE_MERGES, pretok="line", exact=False)
    ids = build_vocab(merges, characters(types, "line"), "line")
    coded = apart.select("doc_id", encode_bpe(F.col("text"), merges, ids, "line").alias("ids"))
    return coded.select("doc_id", decode_bpe(F.col("ids"), ids, "line").alias("text"))
