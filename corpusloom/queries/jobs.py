"""Whole jobs: corpus build, files written and read back, training rows."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import fixed
from ..functions.keys import order_key
from ..operators.order import shuffle_docs
from ..operators.encode import decode_bpe, encode_bpe, encode_words
from ..operators.report import source_report
from ..operators.vocab import word_counts, word_vocab
from ..plans.corpus import book_files, build_corpus, format_sources
from ..plans.prepare import cut_documents, prepare_tokens
from ..plans.training import clustered_stream, inspect_tokens, training_rows
from ..schemas import SourceSpec
from ..session import scratch_dir
from ..sources.tables import read_cluster_sample, read_docs_parquet, read_vocab, write_packed, write_vocab
from ..sources.text import read_text_lines, write_mixed_text
from ..sources.tokenbin import read_token_shards, write_token_shards
from . import query
from .inputs import (
    INSTRUCT, TOKENS_SQL, VOCAB_WORDS, docs, instruct, sql_chunks, sql_instruct, sql_key, sql_pretrain, sql_profile,
    sql_word, table,
)
from .order import GAP_UNITS
from .packing import shown
from .tokens import BPE, listed, token_docs, tokenizer

KINDS = {
    "book": ["src0", "src1", "src2", "src3"],
    "wiki": ["src4", "src5", "src6", "src7", "src8", "src9"],
    "synthetic": ["src10", "src11", "src12", "src13", "src14"],
    "web": ["src15", "src16", "src17", "src18", "src19"],
}
# Caps grow with the table, so that a larger one is not cut to the size of a small one.
CAPS = {"synthetic": 40, "web": 25, "code": 70}  # per thousand documents
SYNTHETIC_CAP, WEB_CAP, CODE_CAP = (f"((SELECT count(*) FROM documents) * {n} // 1000)" for n in CAPS.values())
LETTERS = {"required": "eé", "forbidden": "ßñ"}


def specs(spark, folder):
    documents = table(spark, folder, "documents").count()  # from the file's footer
    caps = {kind: documents * n // 1000 for kind, n in CAPS.items()}
    return (
        [SourceSpec(s, "book", upsample=fixed.UPSAMPLE_BOOK) for s in KINDS["book"]]
        + [SourceSpec(s, "wiki") for s in KINDS["wiki"]]
        + [SourceSpec(s, "synthetic", cap=caps["synthetic"]) for s in KINDS["synthetic"]]
        + [SourceSpec(s, "web", cap=caps["web"], cap_on="eligible") for s in KINDS["web"]]
        + [SourceSpec("chat", "chat", upsample=fixed.UPSAMPLE_CHAT)]
        + [SourceSpec("code", "code", cap=caps["code"], cap_on="eligible")]
    )


SEED, BUFFER = 21, 200
PREPARED_PIECES = 1_000


def _among(kind: str) -> str:
    return "source IN (" + ", ".join(f"'{s}'" for s in KINDS[kind]) + ")"


PROFILE = sql_profile("text", **LETTERS)
CHAT = sql_instruct("''", "instruction || ' ' || coalesce(input, '')", "output")
CODE = sql_instruct(f"'{fixed.CODE_SYSTEM}'", "instruction || chr(10) || coalesce(input, '')", "output")
NTH = "row_number() OVER (PARTITION BY source ORDER BY {}) AS nth"
FORMATTED = f"""{INSTRUCT},
book_lines AS (SELECT source, doc_id, string_split(text, chr(10)) AS ls FROM documents WHERE {_among('book')}),
book_fold AS (SELECT source, doc_id, {sql_chunks("list_filter(list_transform(ls, lambda x, i: CASE WHEN i < len(ls) THEN x || chr(10) ELSE x END), lambda x: x <> '')")} AS acc
    FROM book_lines),
book_chunks AS (SELECT source, doc_id, CASE WHEN length(acc.cur) > 300 THEN list_append(acc.done, acc.cur)
    ELSE acc.done END AS cs FROM book_fold),
books AS (SELECT source, doc_id, unnest(cs) AS text, generate_subscripts(cs, 1) - 1 AS chunk_no FROM book_chunks),
formatted AS (
    SELECT source, doc_id, chunk_no, {sql_pretrain('text')} AS formatted, 3 AS times FROM books
    UNION ALL SELECT source, doc_id, 0, {sql_pretrain('text')}, 1 FROM documents
        WHERE {_among('wiki')} AND length(text) > 300 AND {PROFILE}
    UNION ALL SELECT source, doc_id, 0, {sql_pretrain('text')}, 1 FROM (
        SELECT *, {NTH.format('doc_id')} FROM documents WHERE {_among('synthetic')}) WHERE nth <= {SYNTHETIC_CAP}
    UNION ALL SELECT source, doc_id, 0, {sql_pretrain('text')}, 1 FROM (
        SELECT *, {NTH.format('doc_id')} FROM documents WHERE {_among('web')} AND length(text) >= 300 AND {PROFILE})
        WHERE nth <= {WEB_CAP}
    UNION ALL SELECT source, rec_id, 0, {CHAT}, 5 FROM instruct WHERE source = 'chat' AND {CHAT} <> ''
    UNION ALL SELECT source, rec_id, 0, {CODE}, 1 FROM (
        SELECT *, {NTH.format('rec_id')} FROM instruct WHERE source = 'code' AND length(output) > 20
        AND length(output) < 8000) WHERE nth <= {CODE_CAP})"""


def formatted(spark, folder):
    return format_sources(docs(spark, folder), instruct(spark, folder), specs(spark, folder), **LETTERS)


@query(
    "format_report",
    f"""WITH {FORMATTED}
    SELECT CASE WHEN grouping(source) = 1 THEN 'TOTAL' ELSE source END AS source, count(*) AS n_selected,
        count(*) FILTER (formatted <> '') AS n_nonempty, sum(length(formatted))::BIGINT AS chars,
        sum(strlen(formatted))::BIGINT AS bytes FROM formatted GROUP BY ROLLUP (source)""",
)
def format_report(spark, folder):
    return source_report(formatted(spark, folder))


IDS = "source, doc_id, chunk_no, copy_no"
KEY = sql_key(SEED, "source", "doc_id", "chunk_no", "copy_no")
GAP = f"floor(-ln(({sql_word('key')} + 1)::DOUBLE / 4294967297::DOUBLE) * {GAP_UNITS})::BIGINT"
CORPUS = f"""{FORMATTED},
copies AS (SELECT *, {KEY} AS key FROM (SELECT source, doc_id, chunk_no, formatted, unnest(range(1, times + 1)) AS copy_no
    FROM formatted)),
arrivals AS (SELECT *, sum({GAP}) OVER (PARTITION BY source ORDER BY doc_id, chunk_no, copy_no) AS arrival FROM copies),
placed AS (SELECT *, row_number() OVER (ORDER BY arrival, {IDS}) - 1 AS position FROM arrivals)"""


@query(
    "corpus_build",
    f"""WITH {CORPUS} SELECT source, doc_id, chunk_no, copy_no::BIGINT AS copy_no, position // {BUFFER} AS block,
        row_number() OVER (PARTITION BY position // {BUFFER} ORDER BY key, {IDS}) - 1 AS rank, formatted FROM placed""",
)
def corpus_build(spark, folder):
    corpus = build_corpus(docs(spark, folder), instruct(spark, folder), specs(spark, folder), SEED, BUFFER, **LETTERS)
    return corpus.withColumns({c: F.col(c).cast("bigint") for c in ("chunk_no", "copy_no")})


@query(
    "mixed_text",
    f"""WITH {CORPUS} SELECT trim(line, chr(10)) AS line, count(*) AS n FROM (
        SELECT unnest(string_split(formatted[:length(formatted) - 1], chr(10))) AS line FROM placed WHERE formatted <> '')
    GROUP BY 1""",
)
def mixed_text(spark, folder):
    """The corpus written as text files and read back line by line."""
    path = scratch_dir(spark, "mixed")
    corpus = build_corpus(docs(spark, folder), instruct(spark, folder), specs(spark, folder), SEED, BUFFER, **LETTERS)
    write_mixed_text(corpus, path)
    return read_text_lines(spark, path).groupBy("line").agg(F.count("*").alias("n"))


@query(
    "text_lines",
    """WITH parts AS (SELECT string_split(text, chr(10)) AS ls FROM documents),
    lines AS (SELECT unnest(ls) AS line FROM parts)
    SELECT line, count(*) AS n FROM lines GROUP BY line""",
)
def text_files(spark, folder):
    """Documents written as text files, then read with file, number and text of each line."""
    path = scratch_dir(spark, "lines")
    docs(spark, folder).select("text").write.text(path)
    lines = read_text_lines(spark, path)
    return lines.groupBy("line").agg(F.count("*").alias("n"))


@query("docs_parquet", "SELECT text FROM documents")
def parquet_docs(spark, folder):
    return read_docs_parquet(spark, f"{folder}/documents.parquet").select("text")


@query(
    "token_shards",
    f"""WITH {TOKENS_SQL} SELECT string_agg(id::VARCHAR, ' ' ORDER BY i) AS ids, count(*) AS n FROM known GROUP BY doc_id""",
)
def token_shards(spark, folder):
    """Shuffled documents written as 16-bit shards, read back cut at their end markers."""
    path = scratch_dir(spark, "shards")
    write_token_shards(shuffle_docs(token_docs(spark, folder), 31), path, shard_bytes=1 << 18)
    back = read_token_shards(spark, path, range_bytes=1 << 16)
    return back.select(listed(F.col("ids")).alias("ids"), F.size("ids").cast("bigint").alias("n"))


@query(
    "cut_documents",
    f"""WITH {TOKENS_SQL}, numbered AS (SELECT *, dense_rank() OVER (ORDER BY source, doc_id) - 1 AS nth FROM known)
    SELECT nth AS doc_id, string_agg(id::VARCHAR, ' ' ORDER BY i) AS ids FROM numbered GROUP BY nth""",
)
def documents_from_lines(spark, folder):
    """Documents cut from lines of ids: the end marker of a document stands on its last line."""
    lines = docs(spark, folder).select(
        F.col("source").alias("file"), "doc_id", F.posexplode(F.split("text", "\n")).alias("k", "line"),
        F.size(F.split("text", "\n")).alias("n"),
    )
    vocab = word_vocab(word_counts(docs(spark, folder)), VOCAB_WORDS)
    marked = F.when(F.col("k") == F.col("n") - 1, F.concat("line", F.lit("</s>"))).otherwise(F.col("line"))
    encoded = lines.select(
        "file", (F.col("doc_id") * 1_000_000 + F.col("k")).alias("line_no"), encode_words(marked, vocab).alias("ids")
    )
    return cut_documents(encoded).select("doc_id", listed(F.col("ids")).alias("ids"))


WEB_ROWS = "((SELECT count(*) FROM documents) // 10)"
FILES_CORPUS = (
    CORPUS.replace(
        "list_filter(list_transform(ls, lambda x, i: CASE WHEN i < len(ls) THEN x || chr(10) ELSE x END), lambda x: x <> '')",
        "list_transform(ls, lambda x: x || chr(10))",
    )
    .replace(NTH.format("doc_id") + f" FROM documents WHERE {_among('web')} AND", "0 AS nth FROM web_read WHERE")
    .replace(f"{INSTRUCT},", f"""{INSTRUCT},
web_files AS (SELECT source, sum(n) OVER (ORDER BY k) - n AS before FROM (
    SELECT source, count(*) AS n, {sql_key(19, 'source')} AS k FROM documents WHERE {_among('web')} GROUP BY source)),
web_read AS (SELECT * FROM (SELECT d.*, before + row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS place
    FROM documents d JOIN web_files USING (source)) WHERE place < {WEB_ROWS}),""", 1)
)


@query(
    "corpus_from_files",
    f"""WITH {FILES_CORPUS} SELECT source, doc_id, chunk_no, copy_no::BIGINT AS copy_no, position // {BUFFER} AS block,
        row_number() OVER (PARTITION BY position // {BUFFER} ORDER BY key, {IDS}) - 1 AS rank, formatted FROM placed""",
)
def corpus_from_files(spark, folder):
    """Books out of text files, web pages out of Parquet files chosen whole until a tenth of the documents is read."""
    texts, pages = scratch_dir(spark, "books"), scratch_dir(spark, "web")
    rows = docs(spark, folder).select("source", "doc_id", "text")
    books = rows.filter(F.col("source").isin(KINDS["book"])).select("source", "doc_id", F.col("text").alias("value"))
    # A file per book; books of one source are written by many tasks.
    books.repartition("source", "doc_id").write.partitionBy("source", "doc_id").text(texts)
    web = rows.filter(F.col("source").isin(KINDS["web"])).repartition("source").sortWithinPartitions("source", "doc_id")
    web.write.partitionBy("source").parquet(pages)

    def named(part: str) -> Column:
        return F.regexp_extract("file", f"/{part}=([^/]*)/", 1)

    limit = table(spark, folder, "documents").count() // 10
    sample = read_cluster_sample(spark, pages, limit, 19, named("source")).select("source", "doc_id", "text")
    others = rows.filter(~F.col("source").isin(KINDS["web"]))
    settings = [replace(s, cap=None) if s.kind == "web" else s for s in specs(spark, folder)]
    corpus = build_corpus(
        others.unionByName(sample), instruct(spark, folder), settings, SEED, BUFFER,
        books=book_files(spark, texts, named("source"), named("doc_id")), **LETTERS,
    )
    return corpus.withColumns({c: F.col(c).cast("bigint") for c in ("chunk_no", "copy_no")})


CTX, BATCH, EPOCHS, CLUSTER, CLAMP = 64, 4, 2, 20_000, 1500
STREAM = f"""sizes AS (SELECT doc_id, count(*) AS n FROM known GROUP BY doc_id),
laid AS (SELECT doc_id, (sum(2 * n) OVER (ORDER BY doc_id) - 2 * n) // {CLUSTER} AS cluster FROM sizes),
keyed AS (SELECT doc_id, e, cluster, {sql_key(41, 'e', 'cluster::BIGINT')} AS ck, {sql_key(41, 'e', 'doc_id')} AS dk
    FROM laid, range({EPOCHS}) t(e)),
flat AS (SELECT least(id, {CLAMP - 1}) AS id, row_number() OVER (ORDER BY e, ck, cluster, dk, doc_id, i) - 1 AS pos
    FROM known JOIN keyed USING (doc_id))"""


@query(
    "training_rows",
    f"""WITH {TOKENS_SQL}, {STREAM},
    packed AS (SELECT pos // {CTX + 1} AS row_id, list(id ORDER BY pos) AS t FROM flat GROUP BY 1 HAVING count(*) = {CTX + 1})
    SELECT row_id, row_id // {BATCH} AS batch_id, array_to_string(t[:{CTX}], ' ') AS input_ids,
        array_to_string(t[2:], ' ') AS labels FROM packed""",
)
def packed_training(spark, folder):
    """Clean documents to packed rows over two epochs, clusters and documents shuffled per epoch."""
    rows = training_rows(token_docs(spark, folder), EPOCHS, CTX, BATCH, CLAMP, 41, limit_bytes=CLUSTER)
    return shown(rows)


@query(
    "packed_table",
    f"""WITH {TOKENS_SQL}, {STREAM.replace("AS pos", "AS pos, e")},
    firsts AS (SELECT pos // {CTX + 1} AS row_id, min(e) AS epoch FROM flat GROUP BY 1 HAVING count(*) = {CTX + 1})
    SELECT epoch::BIGINT AS epoch, count(*) AS n_rows, (count(*) * {CTX})::BIGINT AS n_inputs,
        sum(row_id)::BIGINT AS row_ids FROM firsts GROUP BY epoch""",
)
def packed_table(spark, folder):
    """Packed rows stored by the epoch they start in, and counted from the table."""
    path = scratch_dir(spark, "packed")
    write_packed(training_rows(token_docs(spark, folder), EPOCHS, CTX, BATCH, CLAMP, 41, limit_bytes=CLUSTER), path)
    stored = spark.read.parquet(path)
    return stored.groupBy(F.col("epoch").cast("bigint").alias("epoch")).agg(
        F.count("*").alias("n_rows"), F.sum(F.size("input_ids")).alias("n_inputs"), F.sum("row_id").alias("row_ids")
    )


@query(
    "training_from_shards",
    f"""WITH {TOKENS_SQL}, sizes AS (SELECT doc_id, {sql_key(31, 'doc_id')} AS k, count(*) AS n FROM known GROUP BY doc_id),
    flat AS (SELECT e, least(id, {CLAMP - 1}) AS id,
        row_number() OVER (ORDER BY e, k, doc_id, i) - 1 AS pos FROM known JOIN sizes USING (doc_id), range({EPOCHS}) t(e)),
    packed AS (SELECT pos // {CTX + 1} AS row_id, min(e) AS epoch, list(id ORDER BY pos) AS t FROM flat GROUP BY 1
        HAVING count(*) = {CTX + 1})
    SELECT row_id, epoch::BIGINT AS epoch, row_id // {BATCH} AS batch_id, array_to_string(t[:{CTX}], ' ') AS input_ids,
        array_to_string(t[2:], ' ') AS labels FROM packed""",
)
def training_from_shards(spark, folder):
    """Shuffled shards on disk straight to packed rows, in the order of the shards, over two epochs."""
    path = scratch_dir(spark, "shards")
    keyed = token_docs(spark, folder).withColumn("key", order_key(31, "doc_id"))
    write_token_shards(keyed, path, order=["key", "doc_id"], shard_bytes=1 << 18)
    rows = training_rows(
        read_token_shards(spark, path, range_bytes=1 << 16), EPOCHS, CTX, BATCH, CLAMP, 41, order=("shard", "start"),
        shuffle=False,
    )
    return shown(rows, F.col("epoch").cast("bigint").alias("epoch"))


@query(
    "cluster_shuffle",
    f"""WITH {TOKENS_SQL}, {STREAM}, spans AS (SELECT e, ck, cluster, dk, doc_id, n FROM keyed JOIN sizes USING (doc_id))
    SELECT e::INTEGER AS epoch, doc_id, cluster::BIGINT AS cluster,
        (sum(n) OVER (ORDER BY e, ck, cluster, dk, doc_id) - n)::BIGINT AS start FROM spans""",
)
def cluster_order(spark, folder):
    sizes = token_docs(spark, folder).select("doc_id", F.size("ids").alias("n_tokens"))
    laid = clustered_stream(sizes, EPOCHS, 41, limit_bytes=CLUSTER)
    return laid.select("epoch", "doc_id", "cluster", "start")


@query(
    "prepare_tokens",
    """SELECT regexp_replace('<s>' || text || '</s>', '\n+', ' ', 'g') AS text, count(*) AS n FROM documents
    WHERE text IS NOT NULL GROUP BY 1""",
)
def prepared(spark, folder):
    """Text files to shuffled token shards: every document comes back, whole, as often as it was there. Empty lines give
    no token, and a line break reads as a space."""
    work = scratch_dir(spark, "prepare")
    text = F.concat(F.lit("<s>"), F.col("text"), F.lit("</s>"))
    docs(spark, folder).filter("text is not null").select(text.alias("value")).write.text(f"{work}/text")
    stored = prepare_tokens(spark, f"{work}/text", f"{work}/out", seed=51, size=PREPARED_PIECES)
    vocab, _ = read_vocab(spark, f"{work}/out/tokenizer")
    back = stored.select(decode_bpe(F.col("ids"), vocab, "text").alias("text"))
    return back.groupBy("text").agg(F.count("*").alias("n"))


@query(
    "inspect_tokens",
    f"""WITH {BPE}, flat AS (SELECT doc_id, id, piece, row_number() OVER (ORDER BY doc_id, i, j) - 1 AS pos FROM coded)
    SELECT doc_id, min(pos) AS start, string_agg(id::VARCHAR, ' ' ORDER BY pos) AS ids,
        regexp_replace(replace(string_agg(piece, '' ORDER BY pos), '▁', ' '), '^ ', '') AS text FROM flat
    WHERE pos >= 5000 AND pos < 5500 GROUP BY doc_id""",
)
def inspected(spark, folder):
    """A stretch of the piece stream with its text."""
    merges, vocab = tokenizer(spark, folder)
    coded = docs(spark, folder).select("doc_id", encode_bpe(F.col("text"), merges, vocab).alias("ids"))
    shown_part = inspect_tokens(coded, vocab, 5_000, 500)
    return shown_part.select("doc_id", "start", listed(F.col("ids")).alias("ids"), "text")


@query(
    "vocab_table",
    f"WITH {TOKENS_SQL} SELECT id, word AS piece FROM vocab",
)
def vocab_table(spark, folder):
    """A vocabulary stored and read back."""
    path = scratch_dir(spark, "vocab")
    vocab = word_vocab(word_counts(docs(spark, folder)), VOCAB_WORDS)
    write_vocab(vocab, None, path)
    return spark.read.parquet(f"{path}/vocab").select(F.col("id").cast("bigint").alias("id"), "piece")
