"""Token ids as directly addressable codes (DAC): any token of a file is read without decoding its neighbours.

A file holds consecutive documents. The ids, end marks included, are cut in chunks of ``widths`` bits, the
lowest first. Level 0 holds the first chunk of every id, level 1 the second chunk of those ids that need
one, and so on. A bitmap per level says which ids go on, and a rank directory holds the number of ones
before every 512 bits: the place of an id on the next level is its directory entry plus a few bits counted.

Layout, all little-endian: the magic word; u64 counts of tokens, documents and levels; the documents' ids
(i64), one byte each that is 1 for a null id, and their starts (u64, one more than documents); then per level
u64 width and entries, the chunks (8-bit, or two 4-bit chunks a byte), the bitmap, the u64 directory. Every
part starts at a multiple of 8. A line feed that is not part of it ends each file.

Files are written by Spark's text writer, one per row, so tasks that are lost or repeated leave no trace and
any file system that Spark knows will do. File names sort as (partition, number), which is the order of ids.
"""

from __future__ import annotations

import functools
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .pieces import REMEMBERED, PieceEncoder

MAGIC = b"DACTOK01"
WIDTHS = (8, 4, 4)
BLOCK = 512
#: Tokens after which a file is closed; a file holds whole documents, so the last one may go beyond.
TOKENS_PER_FILE = 2_000_000
#: Width of the cells by which positions find their file.
CELL = 1 << 20
_TEXTS_AT_ONCE = 4_500_000


@functools.cache
def encoder(path: str, remembered: int = REMEMBERED) -> PieceEncoder:
    """One encoder a worker process and vocabulary."""
    return PieceEncoder(path, remembered)


def small_runs(texts: pa.Array) -> Iterator[tuple[int, pa.Array]]:
    """Consecutive texts that have some four million bytes together, with the place of the first."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    run = (np.cumsum(sizes) - sizes) // _TEXTS_AT_ONCE
    cuts = [0, *(np.flatnonzero(np.diff(run)) + 1).tolist(), len(texts)]
    for a, b in zip(cuts[:-1], cuts[1:]):
        if a < b:
            yield a, texts.slice(a, b - a)


def _padded(part: bytes) -> bytes:
    return part + b"\0" * (-len(part) % 8)


def to_file(doc_ids: Sequence[int | None], codes: Sequence[np.ndarray], widths: Sequence[int] = WIDTHS) -> bytes:
    """One file's bytes: ``codes`` are the documents' ids in order, end marks included."""
    ids = np.concatenate([np.zeros(0, "<u2"), *codes])
    if len(ids) and int(ids.max()) >> sum(widths):
        raise ValueError("an id needs more bits than the levels have")
    starts = np.concatenate([[0], np.cumsum([len(c) for c in codes])]).astype("<u8")
    parts = [
        MAGIC, np.array([len(ids), len(codes), len(widths)], "<u8").tobytes(),
        np.array([d or 0 for d in doc_ids], "<i8").tobytes(),
        _padded(np.array([d is None for d in doc_ids], "u1").tobytes()), starts.tobytes(),
    ]
    rest = ids
    for width in widths:
        chunk, rest = (rest & ((1 << width) - 1)).astype("u1"), rest >> width
        goes_on = rest > 0
        if width == 4:
            chunk = np.append(chunk, np.zeros(len(chunk) % 2, "u1"))
            chunk = chunk[::2] | chunk[1::2] << 4
        bits = np.packbits(goes_on, bitorder="little").tobytes()
        bits += b"\0" * (-len(bits) % (BLOCK // 8))
        ones = np.bitwise_count(np.frombuffer(bits, "<u8")).reshape(-1, BLOCK // 64).sum(1, dtype="u8")
        directory = np.concatenate([[0], np.cumsum(ones)]).astype("<u8")
        parts += [np.array([width, len(goes_on)], "<u8").tobytes(), _padded(chunk.tobytes()), bits, directory.tobytes()]
        rest = rest[goes_on]
    return b"".join(parts)


class TokenFile:
    """A file's parts, as views of its bytes."""

    def __init__(self, raw: bytes):
        if raw[:8] != MAGIC:
            raise ValueError("not a token file")
        self.raw, self.at = raw, 8
        self.n_tokens, self.n_docs, n_levels = (int(x) for x in self._take("<u8", 3))
        ids, nulls = self._take("<i8", self.n_docs), self._take("u1", self.n_docs)
        self.doc_ids = [None if null else int(d) for d, null in zip(ids, nulls)]
        self.starts = self._take("<u8", self.n_docs + 1)
        self.levels = []
        for _ in range(n_levels):
            width, n = (int(x) for x in self._take("<u8", 2))
            chunk = self._take("u1", (n * width + 7) // 8)
            blocks = -(-n // BLOCK)
            self.levels.append((width, n, chunk, self._take("u1", blocks * BLOCK // 8), self._take("<u8", blocks + 1)))

    def _take(self, kind: str, n: int) -> np.ndarray:
        out = np.frombuffer(self.raw, kind, n, self.at)
        self.at += -(-out.nbytes // 8) * 8
        return out

    def at_positions(self, positions: np.ndarray) -> np.ndarray:
        """The ids at these places, each by one look-up a level and a count within one block."""
        place = np.asarray(positions, dtype="i8")
        value, live, shift = np.zeros(len(place), "<u4"), np.arange(len(place)), 0
        for width, _, chunk, bits, directory in self.levels:
            got = chunk[place] if width == 8 else chunk[place >> 1] >> (4 * (place & 1)).astype("u1") & 15
            value[live] |= got.astype("<u4") << shift
            shift += width
            on = (bits[place >> 3] >> (place & 7).astype("u1") & 1).astype(bool)
            place, live = place[on], live[on]
            if not len(place):
                break
            block, within = place // BLOCK, place % BLOCK
            rows = bits.reshape(-1, BLOCK // 8)[block]
            whole = np.arange(BLOCK // 8)[None, :] < (within >> 3)[:, None]
            last = rows[np.arange(len(rows)), within >> 3] & ((1 << (within & 7)) - 1).astype("u1")
            ones = (np.bitwise_count(rows) * whole).sum(1) + np.bitwise_count(last)
            place = directory[block].astype("i8") + ones.astype("i8")
        return value

    def all(self) -> np.ndarray:
        """All ids, level by level."""
        value = np.zeros(0, "<u4")
        for width, n, chunk, bits, _ in reversed(self.levels):
            if width == 4:
                chunk = np.stack([chunk & 15, chunk >> 4], 1).ravel()[:n]
            here = np.zeros(n, "<u4")
            here[np.unpackbits(bits, count=n, bitorder="little").view(bool)] = value << width
            here |= chunk
            value = here
        return value


def write_token_files(
    df: DataFrame, path: str, tokenizer: str, end_id: int, *, id_col: str = "doc_id", text_col: str = "text",
    tokens_per_file: int = TOKENS_PER_FILE, widths: Sequence[int] = WIDTHS,
) -> None:
    """Encode ``df``'s texts and write their ids under ``path`` in ascending order of ``id_col`` (an integer).

    Null or empty text: only the end id. Null ids come first; rows that tie are ordered by text; repeated rows
    are all written. Other columns are ignored. An empty table gives no token file.

    The texts move once, to ranges of ids; ids are cut out there and never move.
    """
    rows = df.select(F.col(id_col).cast("bigint").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    ordered = rows.repartitionByRange("id", F.xxhash64("text")).sortWithinPartitions("id", F.xxhash64("text"), "text")

    def files(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list[int | None] = []
        codes: list[np.ndarray] = []
        size, end = 0, np.array([end_id], "<u2")

        def close() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array([to_file(ids, codes, widths)], pa.binary())], ["file"])
            ids.clear()
            codes.clear()
            return out

        for batch in batches:
            names = batch.column(0).to_pylist()
            for a, texts in small_runs(batch.column(1)):
                for name, code in zip(names[a:], encoder(tokenizer).encode(texts)):
                    ids.append(name)
                    codes.append(np.concatenate([code, end]))
                    size += len(code) + 1
                    if size >= tokens_per_file:
                        yield close()
                        size = 0
        if ids:
            yield close()

    written = ordered.mapInArrow(files, "file binary").select(F.col("file").cast("string").alias("value"))
    written.write.option("maxRecordsPerFile", 1).text(path)


def _file_key(path):
    """(partition, number) in a file's name, as one number."""
    part, number = F.regexp_extract(path, r"/part-(\d+)-[^/]*$", 1), F.regexp_extract(path, r"-c(\d+)\.[^/]*$", 1)
    return part.cast("bigint") * F.lit(1 << 32) + number.cast("bigint")


def _files(spark: SparkSession, path: str) -> DataFrame:
    raw = spark.read.format("binaryFile").load(path)
    return raw.filter("length > 8").select(_file_key(F.col("path")).alias("file"), "content")


def _sizes(files: DataFrame) -> DataFrame:
    """(file, content) -> (file, number of tokens), which stands behind the magic word; contents go to no Python."""
    digits = F.hex(F.substring("content", 9, 8))
    rising = F.concat(*[F.substring(digits, k, 2) for k in range(15, 0, -2)])
    return files.select("file", F.conv(rising, 16, 10).cast("bigint").alias("n"))


def _with_starts(sizes: DataFrame) -> DataFrame:
    """(file, n) -> the tokens before each file, in two steps so that no task sums up all files."""
    bucket = F.shiftright("file", 42)  # 1,024 partitions
    per = sizes.groupBy(bucket.alias("bucket")).agg(F.sum("n").alias("in_bucket"))
    before = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    per = per.select("bucket", F.coalesce(F.sum("in_bucket").over(before), F.lit(0)).alias("before_bucket"))
    inside = Window.partitionBy("bucket").orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    return sizes.withColumn("bucket", bucket).join(per, "bucket").select(
        "file", "n", (F.col("before_bucket") + F.coalesce(F.sum("n").over(inside), F.lit(0))).alias("file_start")
    )


def read_documents(spark: SparkSession, path: str, with_ids: bool = True) -> DataFrame:
    """Documents of the files: ``doc_id``, ``start`` (ids of all documents before it), ``n_tokens``, ``ids_crc32``
    of the ids as little-endian unsigned 32-bit integers, and ``ids`` if wanted. No files: no rows."""
    schema = "file bigint, doc_id bigint, within bigint, n_tokens bigint, ids_crc32 bigint"
    schema += ", ids array<bigint>" if with_ids else ""

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                part = TokenFile(batch.column(1)[i].as_py())
                ids, starts = part.all(), part.starts.astype("i8")
                raw = memoryview(ids.tobytes())
                crc = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(starts[:-1].tolist(), starts[1:].tolist())]
                columns = [
                    pa.array([batch.column(0)[i].as_py()] * part.n_docs, pa.int64()), pa.array(part.doc_ids, pa.int64()),
                    pa.array(starts[:-1]), pa.array(np.diff(starts)), pa.array(crc, pa.int64()),
                ]
                names = ["file", "doc_id", "within", "n_tokens", "ids_crc32"]
                if with_ids:
                    columns.append(pa.ListArray.from_arrays(pa.array(starts.astype("i4")), pa.array(ids.astype("i8"))))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names)

    files = _files(spark, path)
    starts = _with_starts(_sizes(files)).select("file", "file_start")
    placed = files.mapInArrow(documents, schema).join(starts, "file")
    return placed.select(
        "doc_id", (F.col("file_start") + F.col("within")).alias("start"), "n_tokens", "ids_crc32", *["ids"] * with_ids
    )


def read_tokens_at(spark: SparkSession, path: str, positions: DataFrame, column: str = "position") -> DataFrame:
    """The ids at places of the whole stream: ``position``, ``token``; places outside it and nulls give no row.

    A file is opened by one task for all places asked of it, and no other token of it is decoded.
    """
    files = _files(spark, path)
    starts = _with_starts(_sizes(files))
    last = F.greatest(F.col("file_start"), F.col("file_start") + F.col("n") - 1)
    cells = starts.withColumn(
        "cell", F.explode(F.sequence(F.floor(F.col("file_start") / CELL), F.floor(last / CELL)))
    )
    asked = positions.select(F.col(column).cast("bigint").alias("position")).na.drop().distinct()
    found = asked.withColumn("cell", F.floor(F.col("position") / CELL)).join(cells, "cell").filter(
        (F.col("position") >= F.col("file_start")) & (F.col("position") < F.col("file_start") + F.col("n"))
    )
    wanted = found.groupBy("file").agg(
        F.first("file_start").alias("file_start"), F.collect_list("position").alias("positions")
    )

    def tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, places, raw in zip(*(batch.column(i) for i in range(3))):
                at = np.array(places.as_py(), "i8")
                got = TokenFile(raw.as_py()).at_positions(at - start.as_py())
                yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(got.astype("i8"))], ["position", "token"])

    return wanted.join(files, "file").select("file_start", "positions", "content").mapInArrow(
        tokens, "position bigint, token bigint"
    )
