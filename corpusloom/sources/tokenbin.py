"""Flat 16-bit token files as a Spark data source (format ``tokenbin``).

Shards are one stream of tokens cut into files. Where a document goes on from one into the next, a manifest beside
them names all in order, with their sizes, and says of each whether it begins inside a document; without one every
file stands for itself. Reading cuts the
stream in ranges. A document belongs to the range it starts in, which reads on beyond its end, also into the next
shards; one that does not end within ``PIECE_TOKENS`` after a range's end is cut there, and the next range goes on
with it. Both ranges see this by looking at the same tokens, so a stream without any end marker is read in parallel
too. ``opens`` is false for a row that goes on with a document.

Writing gives numbered shards, moved into place when the job commits; a shard goes when its successor is there. A
shard ends with a document, or anywhere if a document goes on and on.
"""

from __future__ import annotations

import io
import json
import os
import uuid
from collections.abc import Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

from .. import fixed

SHARD_BYTES = 256 * 1024 * 1024
CHUNK_BYTES = 4 * 1024 * 1024
PIECE_TOKENS = 16 * 1024 * 1024
MOVES_AT_ONCE = 32
SCHEMA = "shard string, start bigint, ids array<int>, opens boolean"
MANIFEST = "_shards.json"


def _open_fs(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path)


def _uri(path: str) -> str:
    """Spark's ways to name a local file that ``_open_fs`` does not take: ``file:/…`` and relative paths."""
    if path.startswith("file:/") and not path.startswith("file://"):
        return "file://" + path[len("file:"):]
    return path if "://" in path else os.path.abspath(path)


@dataclass
class TokenRange(InputPartition):
    path: str
    first: int  # in tokens
    limit: int
    size: int
    opens: bool = True  # whether a document begins with the file
    after: tuple[tuple[str, int], ...] = ()  # the shards that go on with the stream, as far as a piece reaches
    before: int | None = None  # tokens of the stream before the file, if a stretch of it is read


class _Stream:
    """Tokens of a file and of those that go on with it, by their place from the file's begin."""

    def __init__(self, parts: Sequence[tuple[io.IOBase, int]]):
        self.parts = parts
        self.size = sum(n for _, n in parts)

    def read(self, at: int, limit: int) -> np.ndarray:
        """Tokens from ``at`` on, as many as one read gives; none at ``limit`` or the end."""
        for file, n in self.parts:
            if at < n:
                file.seek(2 * at)
                return np.frombuffer(file.read(min(CHUNK_BYTES, 2 * (min(limit, n) - at))), dtype="<u2")
            at, limit = at - n, limit - n
        return np.zeros(0, "<u2")

    def end_after(self, at: int, eos_id: int, piece: int) -> int | None:
        """Where the document at ``at`` ends, if it does within a piece; the end of the stream ends all."""
        limit = min(at + piece, self.size)
        while at < limit:
            chunk = self.read(at, limit)
            ends = np.flatnonzero(chunk == eos_id)
            if len(ends):
                return at + int(ends[0]) + 1
            at += len(chunk)
        return at if at == self.size else None


def _documents(
    stream: _Stream, first: int, limit: int, eos_id: int, piece: int = PIECE_TOKENS, opens: bool = True
) -> Iterator[tuple[int, list[np.ndarray], bool]]:
    """Batches of ``(start of the first, documents, whether the first begins there)`` of the range [first, limit)."""

    def border(at: int) -> tuple[int, bool]:
        """Where the range from ``at`` begins, and whether with a document."""
        fresh = opens if not at else int(stream.read(at - 1, at)[0]) == eos_id
        end = None if fresh else stream.end_after(at, eos_id, piece)
        return (at, fresh) if end is None else (end, True)

    start, fresh = border(first)
    stop = min(border(limit)[0], stream.size) if limit < stream.size else stream.size
    held: list[np.ndarray] = []
    at = start
    while at < stop:
        chunk = stream.read(at, stop)
        ends = (np.flatnonzero(chunk == eos_id) + 1).tolist()
        docs, begin = [], 0
        for end in ends:
            docs.append(np.concatenate([*held, chunk[begin:end]]) if held else chunk[begin:end])
            held, begin = [], end
        if begin < len(chunk):
            held.append(chunk[begin:])
        at += len(chunk)
        if docs:
            yield start, docs, fresh
            start, fresh = at - sum(map(len, held)), True
        if sum(map(len, held)) >= piece:
            yield start, [np.concatenate(held)], fresh
            start, fresh, held = at, False, []
    if held:
        yield start, [np.concatenate(held)], fresh


def _stretch(
    stream: _Stream, first: int, limit: int, eos_id: int, piece: int, opens: bool
) -> Iterator[tuple[int, list[np.ndarray], bool]]:
    """Exactly the tokens [first, limit), cut at end markers; nothing beyond them is read but one token before."""
    fresh = opens if not first else int(stream.read(first - 1, first)[0]) == eos_id
    at = first
    while at < limit:
        chunk = stream.read(at, limit)
        ends = (np.flatnonzero(chunk == eos_id) + 1).tolist()
        bounds = [0, *ends, *[len(chunk)] * (not ends or ends[-1] < len(chunk))]
        yield at, [chunk[a:b] for a, b in zip(bounds, bounds[1:])], fresh
        fresh = bool(ends) and ends[-1] == len(chunk)
        at += len(chunk)


class TokenReader(DataSourceReader):
    def __init__(self, options):
        self.path = options["path"]
        self.eos_id = int(options.get("eos_id", fixed.EOS_ID))
        self.range_tokens = int(options.get("range_bytes", SHARD_BYTES)) // 2
        self.piece = int(options.get("piece_tokens", PIECE_TOKENS))
        # A stretch of the whole stream: ranges are cut to it, and ``start`` counts from the stream's begin.
        self.stretch = (int(options["peek_from"]), int(options["peek_to"])) if "peek_from" in options else None

    def shards(self) -> list[tuple[str, int, bool]]:
        """``(path, tokens, whether a document begins with it)`` in the order of the stream."""
        where, path = _open_fs(self.path)
        info = where.get_file_info(path)
        if info.type == fs.FileType.File:
            return [(info.path, info.size // 2, True)]
        if where.get_file_info(f"{path}/{MANIFEST}").type == fs.FileType.File:
            with where.open_input_file(f"{path}/{MANIFEST}") as file:
                return [(f"{path}/{s['name']}", s["tokens"], s["opens"]) for s in json.loads(file.read())]
        listed = where.get_file_info(fs.FileSelector(path))
        return sorted((f.path, f.size // 2, True) for f in listed if f.path.endswith(".bin"))

    def partitions(self):
        shards = self.shards()
        out = []
        if self.stretch:
            before = 0
            for path, size, opens in shards:
                first, limit = max(0, self.stretch[0] - before), min(size, self.stretch[1] - before)
                out += [
                    TokenRange(path, at, min(at + self.range_tokens, limit), size, opens, before=before)
                    for at in range(first, limit, self.range_tokens)
                ]
                before += size
            return out
        for k, (path, size, opens) in enumerate(shards):
            after, reach = [], 0
            for j in range(k + 1, len(shards)):
                name, n, fresh = shards[j]
                if fresh or reach > self.piece:
                    break
                after.append((name, n))
                reach += n
            out += [
                TokenRange(path, at, min(at + self.range_tokens, size), size, opens, tuple(after))
                for at in range(0, size, self.range_tokens)
            ]
        return out

    def read(self, partition):
        if partition is None:  # Spark's stand-in when a folder holds no shard
            return
        where, _ = _open_fs(self.path)
        name = partition.path.rsplit("/", 1)[-1]
        files = [(partition.path, partition.size), *partition.after]
        opened = [where.open_input_file(path) for path, _ in files]
        stream = _Stream([(file, n) for file, (_, n) in zip(opened, files)])
        here = (stream, partition.first, partition.limit, self.eos_id, self.piece, partition.opens)
        for start, docs, fresh in _documents(*here) if partition.before is None else _stretch(*here):
            start += partition.before or 0
            bounds = np.cumsum([0] + [len(d) for d in docs])
            ids = pa.ListArray.from_arrays(
                pa.array(bounds.astype(np.int32)), pa.array(np.concatenate(docs).astype(np.int32))
            )
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(docs)), pa.array(start + bounds[:-1], pa.int64()), ids, pa.array([fresh] + [True] * (len(docs) - 1))],
                names=["shard", "start", "ids", "opens"],
            )
        for file in opened:
            file.close()


@dataclass
class Written(WriterCommitMessage):
    files: list[tuple[str, str, int, bool]]  # temporary and final path, tokens, whether it ends with a document


class TokenWriter(DataSourceArrowWriter):
    def __init__(self, options, overwrite: bool):
        self.uri, self.overwrite = options["path"], overwrite
        self.shard_bytes = int(options.get("shard_bytes", SHARD_BYTES))
        # With an end marker given, rows are parts of documents, and only a row that ends in one closes a document.
        # A document that goes on for another shard's size is cut at any row.
        self.eos_id = int(options.get("eos_id", -1))

    def write(self, iterator):
        where, path = _open_fs(self.uri)
        part = TaskContext.get().partitionId()
        attempt = uuid.uuid4().hex
        where.create_dir(f"{path}/_temporary", recursive=True)
        out, size, files, closed = None, 0, [], True

        def finish() -> None:
            nonlocal out, size
            out.close()
            files[-1] = (*files[-1], size // 2, closed)
            out, size = None, 0

        for batch in iterator:
            lists = batch.column("ids")
            flat = lists.flatten().to_numpy(zero_copy_only=False)
            if flat.size and (flat.min() < 0 or flat.max() >= fixed.MAX_VOCAB):
                raise ValueError("token id does not fit 16 bits")
            data, bounds = flat.astype("<u2"), lists.offsets.to_numpy() - lists.offsets[0].as_py()
            closes = np.ones(len(lists), bool)
            if self.eos_id >= 0:
                closes = (np.diff(bounds) > 0) & (data[np.maximum(bounds[1:] - 1, 0)] == self.eos_id) if len(data) else ~closes
            first = 0
            while first < len(lists):
                if out is None:
                    name = f"part-{part:06d}-{len(files):05d}.bin"
                    files.append((f"{path}/_temporary/{attempt}-{name}", f"{path}/{name}"))
                    out = where.open_output_stream(files[-1][0])
                room = bounds[first] + max(0, self.shard_bytes - size) // 2
                # Whole documents up to the shard size, and at least one row.
                last = max(first + 1, int(np.searchsorted(bounds, room, side="right")) - 1)
                later = np.flatnonzero(closes[last - 1:])
                end = last + int(later[0]) if len(later) else len(lists)
                # One that would take as much again is cut.
                most = bounds[first] + max(0, 2 * self.shard_bytes - size) // 2
                last = min(end, max(last, int(np.searchsorted(bounds, most, side="right")) - 1))
                out.write(data[bounds[first]:bounds[last]].tobytes())
                size += 2 * int(bounds[last] - bounds[first])
                if bounds[last] > bounds[first]:
                    closed = bool(closes[first:last][np.diff(bounds[first : last + 1]) > 0][-1])
                first = last
                full = size >= (self.shard_bytes if closed else 2 * self.shard_bytes)
                if full or closed and last < len(lists):
                    finish()
        if out is not None:
            finish()
        return Written(files)

    def commit(self, messages):
        where, path = _open_fs(self.uri)
        where.create_dir(path, recursive=True)
        old = [f.path for f in where.get_file_info(fs.FileSelector(path)) if f.path.endswith(".bin")]
        if old and not self.overwrite:
            self.abort(messages)
            raise ValueError(f"{self.uri} already holds token shards; use mode overwrite")
        # Each new shard takes the place of an old one in one step; only what is left of the old ones goes, last.
        written = [shard for message in messages for shard in (message.files if message else [])]
        moves = [shard[:2] for shard in written]
        rest = set(old) - {final for _, final in moves}
        listed, opens = [], True
        for _, final, tokens, closed in sorted(written, key=lambda shard: shard[1]):
            listed.append({"name": final.rsplit("/", 1)[-1], "tokens": tokens, "opens": opens})
            opens = closed if tokens else opens
        if where.get_file_info(f"{path}/{MANIFEST}").type == fs.FileType.File:
            where.delete_file(f"{path}/{MANIFEST}")
        with ThreadPoolExecutor(MOVES_AT_ONCE) as pool:
            for done in [pool.submit(self._replace, where, *pair) for pair in moves]:
                done.result()
            for done in [pool.submit(where.delete_file, name) for name in rest]:
                done.result()
        if not all(shard["opens"] for shard in listed):
            with where.open_output_stream(f"{path}/{MANIFEST}") as file:
                file.write(json.dumps(listed).encode())
        self._clean(where, path)

    @staticmethod
    def _replace(where, temporary, final):
        try:
            where.move(temporary, final)
        except OSError:  # stores that refuse to move onto a file
            where.delete_file(final)
            where.move(temporary, final)

    def abort(self, messages):
        self._clean(*_open_fs(self.uri))

    @staticmethod
    def _clean(where, path):
        if where.get_file_info(f"{path}/_temporary").type == fs.FileType.Directory:
            where.delete_dir(f"{path}/_temporary")


class TokenBinSource(DataSource):
    @classmethod
    def name(cls):
        return "tokenbin"

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return TokenReader(self.options)

    def writer(self, schema, overwrite):
        return TokenWriter(self.options, overwrite)


def read_token_shards(
    spark: SparkSession, path: str, eos_id: int = fixed.EOS_ID, range_bytes: int = SHARD_BYTES,
    piece_tokens: int = PIECE_TOKENS,
) -> DataFrame:
    """Documents ``(shard, start, ids, opens)`` of one token file or a folder of shards, very long ones in pieces."""
    spark.dataSource.register(TokenBinSource)
    reader = spark.read.format("tokenbin").option("eos_id", eos_id).option("range_bytes", range_bytes)
    return reader.option("piece_tokens", piece_tokens).load(_uri(path))


def peek_shards(
    spark: SparkSession, path: str, start: int = 0, n: int = 200, eos_id: int = fixed.EOS_ID, range_bytes: int = SHARD_BYTES
) -> DataFrame:
    """Ids ``start`` … ``start + n - 1`` of the stream, a slice per document they touch: ``(shard, start, ids, opens)``.

    The shards' sizes say where the stretch lies: only shards that hold a part of it are opened, and of these only
    that part is read. A byte offset in a 16-bit stream is twice the token offset.
    """
    spark.dataSource.register(TokenBinSource)
    reader = spark.read.format("tokenbin").option("eos_id", eos_id).option("range_bytes", range_bytes)
    return reader.option("peek_from", start).option("peek_to", start + n).load(_uri(path))


def write_token_shards(
    df: DataFrame, path: str, order: Sequence[str] | None = None, ids: str = "ids", shard_bytes: int = SHARD_BYTES,
    document: bool = False, eos_id: int = fixed.EOS_ID,
) -> None:
    """Ids as 16-bit little-endian, no header; with ``order`` the shard names follow it.

    ``document``: the rows are parts, ``order`` puts them in place, and a part that ends with ``eos_id`` closes a
    document. Tasks take ranges of parts, so a document of any length is written by as many as it needs, and may go on
    in the next shard.
    """
    df.sparkSession.dataSource.register(TokenBinSource)
    if document:
        rows = df.repartitionByRange(*order).sortWithinPartitions(*order)
    else:
        rows = df.orderBy(*order) if order else df
    # The writer takes the layout of the reader; shard and start are given by the place itself.
    rows = rows.select(F.lit("").alias("shard"), F.lit(0).cast("bigint").alias("start"), F.col(ids).alias("ids"), F.lit(True).alias("opens"))
    writer = rows.write.format("tokenbin").option("shard_bytes", shard_bytes).option("eos_id", eos_id if document else -1)
    writer.mode("overwrite").save(_uri(path))
