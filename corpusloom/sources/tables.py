"""Table sources brought to the engine's layouts, and table sinks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.keys import order_key
from ..operators.order import hex_bucket, prefix_sum
from ..session import shuffle_partitions, stage
from .text import skip_unreadable

#: Fewer bytes cannot be a file of the kind: a Parquet file's two marks and footer length.
LEAST_BYTES = {"parquet": 12}
#: A Parquet file without rows is its schema; only files below this many bytes are looked into.
BARE_BYTES = 1 << 16


def read_docs_parquet(spark: SparkSession, path: str, text: str = "text") -> DataFrame:
    """``(file, text)`` of every readable Parquet file; one column is read, nulls are dropped."""
    # The layout is given, so that a broken file cannot spoil its inference.
    layout = T.StructType([T.StructField(text, T.StringType())])
    reader = skip_unreadable(spark.read).schema(layout).option("pathGlobFilter", "*.parquet")
    rows = reader.parquet(path).select(F.col("_metadata.file_path").alias("file"), F.col(text).alias("text"))
    return rows.filter(F.col("text").isNotNull())  # reaches the scan, where na.drop does not


def spread_small(df: DataFrame, path: str, key: str, limit: int = 1 << 28) -> DataFrame:
    """Spread a small table over the tasks of a shuffle; leave a large one as it is.

    A small file is often one row group and so one task, whatever the number of cores. Above
    ``limit`` bytes the files give tasks enough and nothing is moved.
    """
    files = df.sparkSession.read.format("binaryFile").load(path).select("length")  # lists, reads nothing
    if files.agg(F.sum("length")).first()[0] > limit:
        return df
    return df.repartition(shuffle_partitions(df.sparkSession), key)


def file_rows(spark: SparkSession, path: str) -> DataFrame:
    """``(file, rows)`` of every Parquet file: no column is read, so only footers are."""
    rows = skip_unreadable(spark.read).option("recursiveFileLookup", True).parquet(path)
    return rows.select(F.col("_metadata.file_path").alias("file")).groupBy("file").agg(F.count("*").alias("rows"))


def read_cluster_sample(
    spark: SparkSession, path: str, limit: int, seed: int, name: Column | None = None, out: str = "nth"
) -> DataFrame:
    """Rows of whole Parquet files in a seeded file order until ``limit`` rows are reached; ``out`` counts from 0.

    The table of files, from their footers, is ordered and cut first, so files past the cap are never opened. What
    comes to the driver are the names of the files that are read, ``limit`` at most. ``name`` is what a file is called
    in its key, of the column ``file``; the whole path if not given.
    """
    named = file_rows(spark, path).withColumn("__name", F.col("file") if name is None else name)
    keyed = stage(named.withColumn("__key", order_key(seed, "__name")))
    placed = prefix_sum(keyed, ["__key", "__name"], "rows", bucket=hex_bucket(keyed, "__key"), stop=limit, out="__before")
    chosen = placed.select("file", "__before").orderBy("__before").limit(limit).collect()
    if not chosen:
        return spark.read.option("recursiveFileLookup", True).parquet(path).limit(0).withColumn(out, F.lit(0).cast("bigint"))
    rows = spark.read.option("basePath", path).parquet(*[r.file for r in chosen])  # columns that folders name stay
    starts = spark.createDataFrame([(r.file, r["__before"]) for r in chosen], "__file string, __before bigint")
    laid = rows.select("*", F.col("_metadata.file_path").alias("__file"), F.col("_metadata.row_index").alias("__index"))
    laid = laid.join(F.broadcast(starts), "__file").withColumn(out, F.col("__before") + F.col("__index"))
    return laid.filter(F.col(out) < limit).drop("__file", "__index", "__before")


def unreadable_files(spark: SparkSession, path: str, kind: str = "parquet") -> DataFrame:
    """``(file, bytes, reason)`` of the files that ``skip_unreadable`` passes over: the record beside the data.

    The listing, which reads nothing, less the files that gave a row. A file of no bytes holds nothing to lose, and a
    small Parquet file with both its marks is taken for one without rows.
    """
    listing = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    lost = listing.select("path", "length")
    layout = T.StructType([T.StructField("value", T.StringType())])
    reader = skip_unreadable(spark.read).option("recursiveFileLookup", True).format(kind)
    read = (reader if kind == "text" else reader.schema(layout)).load(path)

    def plain(c: Column) -> Column:
        return F.regexp_replace(c, "^file:/+", "file:/")

    seen = read.select(plain(F.col("_metadata.file_path")).alias("path")).distinct()
    reason = F.when(F.col("length") < LEAST_BYTES.get(kind, 1), "cut short").otherwise("unreadable")
    missing = lost.withColumn("path", plain(F.col("path"))).filter("length > 0").join(seen, "path", "left_anti")
    if kind == "parquet":
        bare = listing.filter((F.col("length") >= LEAST_BYTES[kind]) & (F.col("length") < BARE_BYTES))
        marked = F.expr("decode(substring(content, 1, 4), 'ISO-8859-1') = 'PAR1' and decode(substring(content, -4, 4), 'ISO-8859-1') = 'PAR1'")
        missing = missing.join(bare.filter(marked).select(plain(F.col("path")).alias("path")), "path", "left_anti")
    return missing.select(F.col("path").alias("file"), F.col("length").alias("bytes"), reason.alias("reason"))


def instruct_source(df: DataFrame, source: str, rec_id: str = "rec_id") -> DataFrame:
    """Instruction records; absent columns and nulls are empty text."""

    def part(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit("")) if name in df.columns else F.lit("")

    return df.select(
        F.col(rec_id).cast("bigint").alias("rec_id"), F.lit(source).alias("source"),
        *[part(n).alias(n) for n in ("instruction", "input", "output")],
    )


def doc_source(df: DataFrame, source: str | None = None, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    return df.select(
        F.col(doc_id).cast("bigint").alias("doc_id"),
        (F.col("source") if source is None else F.lit(source)).alias("source"), F.col(text).alias("text"),
    )


def stream_docs(
    spark: SparkSession, path: str, schema: T.StructType, format: str = "parquet", max_files: int | None = None
) -> DataFrame:
    """The same tables as a stream of files."""
    reader = spark.readStream.schema(schema).format(format)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path)


def write_packed(df: DataFrame, path: str) -> None:
    """Packed rows, one folder per epoch."""
    rows = df if "epoch" in df.columns else df.withColumn("epoch", F.lit(0))
    rows.write.mode("overwrite").partitionBy("epoch").parquet(path)


def write_vocab(vocab: DataFrame, merges: DataFrame | None, path: str) -> None:
    """A vocabulary (at most 65,536 rows) and its merges, one file each."""
    vocab.orderBy("id").coalesce(1).write.mode("overwrite").parquet(f"{path}/vocab")
    if merges is not None:
        merges.orderBy("rank").coalesce(1).write.mode("overwrite").parquet(f"{path}/merges")


def read_vocab(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    return spark.read.parquet(f"{path}/vocab"), spark.read.parquet(f"{path}/merges")
