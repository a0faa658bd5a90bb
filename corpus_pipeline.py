"""Corpus pipeline: language ID, line dedup, near-dedup, benchmark decontamination, packing.

Each stage takes ``(spark, docs, sf_dir)`` and works on all rows its predecessor kept; ``run`` writes every stage as
Parquet below ``spark.checkpoint.dir`` and reads it again. All stages but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm import decontaminate, language_mix, line_dedup, near_sets, packing
from corpusloom.llm.queries import vocabulary
from corpusloom.llm.tables import in_learning_part, table
from corpusloom.session import scratch_dir

#: Text pieces that a packing worker remembers, as workers of several stages lie side by side.
REMEMBERED = 350_000
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the model knows, each row by its own text; texts without a letter go."""
    model = language_mix.learn(docs.filter(in_learning_part()))
    return language_mix.known(docs, model).select(*COLUMNS)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without later copies of repeated runs of lines, every line of them; a document of which nothing is left goes."""
    done = line_dedup.deduplicate(docs, whole_runs=True)
    emptied = (F.size("removed_lines") > 0) & (F.trim(F.translate("text", "\t\n\x0b\x0c\r", "     ")) == "")
    n_chars = F.when(F.size("removed_lines") > 0, F.length("text").cast("bigint")).otherwise(F.col("n_chars"))
    return done.filter(~emptied).withColumn("n_chars", n_chars).select(*COLUMNS)


def dedup_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of every group of near-duplicates: 5-word shingles, Jaccard 0.8 or more.

    Pairs in one SimHash ball (the step of ``op9``, over these shingles) are compared first, then what it misses."""
    return near_sets.keep_one(docs).select(*COLUMNS)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark passage."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark")).select(*COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of packed sequences, as ``op5`` returns them."""
    return packing.pack(docs, vocabulary("word_bpe_49k.json"), 1, with_ids=False, remembered=REMEMBERED)


STAGES = [
    ("language_id", language_id), ("dedup_lines", dedup_lines), ("dedup_near", dedup_near), ("drop_leaks", drop_leaks),
    ("pack", pack),
]

#: Fingerprints, mixtures and tokenizers are beyond SQL; tests hold ``run`` against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_dir(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
