"""Packing into fixed-length sequences: first-fit decreasing with a tournament tree, in random groups of documents.

Documents are dealt to tasks by a seeded hash and cut, in hash order, into groups of ``GROUP_DOCS``: each group
is a random sample, so it has short documents to go with its long ones, and is packed on its own. Only texts
move, once; nothing depends on how many documents share a source or a text.

Inside a group whole sequences are cut off long documents first. The rests are placed in falling order of size,
each in the first bin with room, found by descending a tournament tree whose inner nodes hold the largest
room below. The room left over is then closed by cutting the emptiest bins' pieces into it, so at
most one sequence of a group needs padding.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .pieces import REMEMBERED
from .token_codes import encoder, small_runs

CAPACITY = 2048
GROUP_DOCS = 8192
GROUP_TOKENS = 16_000_000
SEED = 17

PIECES = (
    "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint"
)


class RoomTree:
    """Rooms of a row of bins; the leftmost bin with at least so much room, in logarithmic time."""

    def __init__(self, bins: int, capacity: int):
        self.leaves = 1 << max(0, bins - 1).bit_length()
        self.room = [capacity] * (2 * self.leaves)

    def place(self, size: int) -> int:
        room, node = self.room, 1
        while node < self.leaves:
            node *= 2
            if room[node] < size:
                node += 1
        bin_ = node - self.leaves
        room[node] -= size
        while node > 1:
            node //= 2
            room[node] = max(room[2 * node], room[2 * node + 1])
        return bin_


@dataclass
class Bin:
    used: int = 0
    pieces: list[tuple[int, int, int]] = field(default_factory=list)  # document, start, length

    def add(self, doc: int, start: int, length: int) -> None:
        self.pieces.append((doc, start, length))
        self.used += length


def pack_group(sizes: list[int], capacity: int = CAPACITY, least_piece: int = 1) -> list[Bin]:
    """Bins of pieces that cover each document of ``sizes`` tokens exactly once.

    Documents without tokens have no piece. ``least_piece``: rooms smaller than this are left as padding.
    """
    whole, rests = [], []
    for doc, size in enumerate(sizes):
        full = size - size % capacity
        for start in range(0, full, capacity):
            whole.append(Bin())
            whole[-1].add(doc, start, capacity)
        if size > full:
            rests.append((size - full, doc, full))
    rests.sort(key=lambda r: (-r[0], r[1]))
    tree, bins = RoomTree(len(rests), capacity), []
    for size, doc, start in rests:
        at = tree.place(size)
        if at == len(bins):
            bins.append(Bin())
        bins[at].add(doc, start, size)
    # Bins that are full, or need no padding as they are, stay; the emptiest others fill up the fullest.
    is_open = [b for b in bins if b.used < capacity]
    is_open.sort(key=lambda b: -b.used)
    first, last = 0, len(is_open) - 1
    while first < last:
        taker, giver = is_open[first], is_open[last]
        room = capacity - taker.used
        if room < least_piece or not room:
            first += 1
            continue
        doc, start, length = giver.pieces.pop()
        take = min(room, length)
        giver.used -= length
        if take < length:
            giver.add(doc, start, length - take)
        taker.add(doc, start + length - take, take)
        if not giver.pieces:
            last -= 1
    return whole + [b for b in bins if b.pieces]


def pack(
    df: DataFrame, tokenizer: str, end_id: int, *, id_col: str = "doc_id", text_col: str = "text",
    capacity: int = CAPACITY, group_docs: int = GROUP_DOCS, group_tokens: int = GROUP_TOKENS, seed: int = SEED,
    least_piece: int = 1, with_ids: bool = True, remembered: int = REMEMBERED,
) -> DataFrame:
    """Pieces of all documents of ``df``: columns ``PIECES`` and, if wanted, the ``ids`` of the piece.

    A document is its ids and ``end_id``; null or empty text is the end id alone. ``sequence_id`` is unique, and
    offsets inside a sequence have no gap. Rows that tie or repeat are packed each for itself; null ids stay
    null; other columns are ignored. An empty table gives no rows. ``remembered``: text pieces that a worker keeps.
    """
    schema = PIECES + (", ids array<bigint>" if with_ids else "")
    rows = df.select(F.col(id_col).cast("bigint").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    keyed = rows.withColumn("key", F.xxhash64(F.lit(seed), "id", F.xxhash64("text")))
    dealt = keyed.repartition("key").sortWithinPartitions("key", "id", "text").select("id", "text")

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sequence = TaskContext.get().partitionId() << 40
        ids: list[int | None] = []
        codes: list[np.ndarray] = []
        tokens, end = 0, np.array([end_id], "<u4")

        def close() -> pa.RecordBatch:
            nonlocal sequence
            raws = [memoryview(c.tobytes()) for c in codes]
            out: list[tuple] = []
            for one in pack_group([len(c) for c in codes], capacity, least_piece):
                at = 0
                for doc, start, length in one.pieces:
                    crc = zlib.crc32(raws[doc][4 * start : 4 * (start + length)])
                    row = (ids[doc], start, length, crc, len(codes[doc]), sequence, at)
                    out.append(row + ((codes[doc][start : start + length].astype("i8"),) if with_ids else ()))
                    at += length
                sequence += 1
            names = [part.split()[0] for part in schema.split(", ")]
            kinds = [pa.int64()] * 7 + [pa.list_(pa.int64())] * with_ids
            columns = list(zip(*out)) or [()] * len(names)
            ids.clear()
            codes.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

        for batch in batches:
            names = batch.column(0).to_pylist()
            for a, texts in small_runs(batch.column(1)):
                for name, code in zip(names[a:], encoder(tokenizer, remembered).encode(texts)):
                    ids.append(name)
                    codes.append(np.concatenate([code, end]).astype("<u4"))
                    tokens += len(codes[-1])
                    if len(ids) >= group_docs or tokens >= group_tokens:
                        yield close()
                        tokens = 0
        if ids:
            yield close()

    return dealt.mapInArrow(packed, schema)


def sequences(pieces: DataFrame, capacity: int = CAPACITY, pad_id: int = 0) -> DataFrame:
    """``sequence_id``, ``input_ids`` and ``doc_ids`` (one a piece) from pieces with ids.

    A sequence is padded to ``capacity`` unless its length is a power of two. At most ``capacity`` pieces meet.
    """
    parts = F.array_sort(F.collect_list(F.struct("offset", "doc_id", "ids")))
    rows = pieces.groupBy("sequence_id").agg(parts.alias("parts")).select(
        "sequence_id", F.flatten("parts.ids").alias("ids"), F.col("parts.doc_id").alias("doc_ids")
    )
    n = F.size("ids")
    missing = F.when(F.bit_count(n) == 1, 0).otherwise(F.lit(capacity) - n)
    return rows.select(
        "sequence_id", F.concat("ids", F.array_repeat(F.lit(pad_id).cast("bigint"), missing)).alias("input_ids"), "doc_ids"
    )
