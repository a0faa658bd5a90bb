"""The registered queries of this folder, each over its whole tables, and their SQL twins where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_dir
from . import (
    decontaminate, language_mix, license_scan, line_dedup, line_rules, oracles, packing, phrases, quality_gam, shards,
    simhash, token_codes, trie_bpe, whitening,
)
from .tables import in_learning_part, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = dict(oracles.ORACLES)


def query(run: Callable[[SparkSession, str], DataFrame]):
    QUERIES[run.__name__] = run
    return run


def vocabulary(name: str) -> str:
    """Path of a public tokenizer's file; the same on every machine of the cluster."""
    import public_tokenizers

    return public_tokenizers.path(name)


@query
def op1_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return license_scan.scan(table(spark, folder, "documents")).drop("matches")


@query
def op2_spaced_seeds(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.leaks(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query
def op3_token_codes(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_dir(spark, "token-files")
    token_codes.write_token_files(table(spark, folder, "documents"), path, vocabulary("byte_bpe_50k.json"), 2)
    return token_codes.read_documents(spark, path, with_ids=False)


@query
def op5_tree_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(table(spark, folder, "documents"), vocabulary("word_bpe_49k.json"), 1, with_ids=False)


@query
def op6_line_rules(spark: SparkSession, folder: str) -> DataFrame:
    return line_rules.clean_lines(table(spark, folder, "documents")).drop("clean_text")


@query
def op7_hypergeometric_shards(spark: SparkSession, folder: str) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    rows = table(spark, folder, "documents").select(
        "doc_id", (F.octet_length(text) + 8).cast("bigint").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32")
    )
    placed = shards.shuffle_into_shards(rows, 24, keys=["doc_id", "size", "text_crc32"])
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query
def op8_line_suffixes(spark: SparkSession, folder: str) -> DataFrame:
    done = line_dedup.deduplicate(table(spark, folder, "documents"))
    return done.select(
        "doc_id", F.size("removed_lines").cast("bigint").alias("n_removed"),
        F.array_join("removed_lines", ",").alias("removed"),
        F.md5(F.coalesce("text", F.lit(""))).alias("text_md5"),
    )


@query
def op4_pairwise_gam(spark: SparkSession, folder: str) -> DataFrame:
    return quality_gam.classify(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query
def op9_ball_simhash(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, folder, "documents"))
    digits = F.lpad(F.lower(F.hex("print")), 16, "0")
    return found.select("doc_id", digits.alias("fingerprint"), "component_id")


@query
def op10_language_mixture(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = language_mix.learn(docs.filter(in_learning_part()))
    held_out = F.coalesce(~in_learning_part(), F.lit(False)).alias("held_out")
    return language_mix.identify(docs, model).select("doc_id", held_out, "lang_pred", "score")


@query
def op11_trie_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return trie_bpe.encode(table(spark, folder, "documents"), vocabulary("word_bpe_49k.json"), with_ids=False, with_text=False)


@query
def op12_exact_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whitening.whiten(table(spark, folder, "embeddings"))


@query
def op13_count_streams(spark: SparkSession, folder: str) -> DataFrame:
    return phrases.collocations(table(spark, folder, "documents"))
