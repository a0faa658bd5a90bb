"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Two 64-bit fingerprints differ in at most ``RADIUS`` bits exactly if some value lies within half that distance of
both. So every fingerprint stands for all values in its ball of half the radius (2,081 for two bits), these variants are
shuffled, and fingerprints that share one are linked. Sharing one proves the distance, so a group at one value
is linked as a star; no pairs inside a group are listed.

The variants are shuffled in blocks: a linear hash (exclusive or of a word per bit) says which block a variant lies
in, and because it is linear, the blocks that a fingerprint's ball meets, and the bit flips that lead there, are
known without listing the ball. A fingerprint travels once to each block it meets; the block's task makes the
variants that lie in it, a part at a time, sorts them, and keeps those that two fingerprints share. Memory is bounded
by the size of a part. Equal fingerprints are one from the start.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stage
from .components import components, first_rows, forest, numbered_rows

SHINGLE = 4
RADIUS = 4
#: Fingerprints per block task, and variants made at once inside it.
BLOCK_PRINTS = 1 << 17
PART_VARIANTS = 1 << 22
LEAST_BLOCKS = 64
_MASK = (1 << 64) - 1


def fingerprint(text: str | None, words: int = SHINGLE) -> int:
    """SimHash of a text's word shingles, repeats included; zero without a word."""
    from xxhash import xxh64_intdigest

    parts = (text or "").encode().lower().split()  # ASCII case and ASCII white space only
    if not parts:
        return 0
    line = b" ".join(parts)
    if len(parts) <= words:
        hashes = [xxh64_intdigest(line, 42)]
    else:
        size = np.fromiter(map(len, parts), "i8", len(parts)) + 1
        ends = np.cumsum(size) - 1
        starts = ends + 1 - size
        hashes = [xxh64_intdigest(line[a:b], 42) for a, b in zip(starts[: 1 - words].tolist(), ends[words - 1 :].tolist())]
    votes = np.zeros(64, "i8")
    for i in range(0, len(hashes), 1 << 16):  # a long text's bits are counted in pieces
        part = np.array(hashes[i : i + (1 << 16)], "<u8")
        votes += np.unpackbits(part.view("u1").reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype="i8")
    return int(np.packbits(2 * votes > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", words: int = SHINGLE) -> DataFrame:
    """``doc_id`` and ``print`` (the fingerprint as a signed 64-bit integer) for every row; texts do not move."""
    rows = df.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = np.fromiter((fingerprint(t.as_py(), words) for t in batch.column(1)), "u8", batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(prints.view("i8"))], ["doc_id", "print"])

    return rows.mapInArrow(hashed, "doc_id bigint, print bigint")


class LinearHash:
    """Sixteen linear hash bits of a fingerprint, and the flips of at most ``flips`` bits by their hash."""

    BITS = 16

    def __init__(self, flips: int = RADIUS // 2):
        words = np.random.default_rng(64).integers(0, 1 << self.BITS, 64, dtype="u8")
        tables = np.zeros((8, 256), "u8")
        for byte in range(8):
            for value in range(256):
                for bit in range(8):
                    if value >> bit & 1:
                        tables[byte, value] ^= words[8 * byte + bit]
        self.tables = tables
        masks = [sum(1 << b for b in bits) for k in range(flips + 1) for bits in combinations(range(64), k)]
        self.masks = np.array(masks, "u8")
        self.mask_hash = self(self.masks)

    def __call__(self, prints: np.ndarray) -> np.ndarray:
        by_byte = prints.astype("<u8").view("u1").reshape(-1, 8)
        return np.bitwise_xor.reduce([self.tables[k][by_byte[:, k]] for k in range(8)])


def _links_in_part(prints: np.ndarray, hashes: np.ndarray, linear: LinearHash, part: int, bits: int):
    """Links between fingerprints whose variants with hash prefix ``part`` (of ``bits`` bits) agree."""
    shift = np.uint64(linear.BITS - bits)
    mine, flips = hashes >> shift, linear.mask_hash >> shift
    by_hash, by_flip = np.argsort(mine, kind="stable"), np.argsort(flips, kind="stable")
    sorted_mine, sorted_flips = mine[by_hash], flips[by_flip]
    variants, groups = [], []
    for value in np.unique(sorted_mine):
        a, b = np.searchsorted(sorted_mine, [value, value + np.uint64(1)])
        c, d = np.searchsorted(sorted_flips, [value ^ np.uint64(part), (value ^ np.uint64(part)) + np.uint64(1)])
        own, masks = prints[by_hash[a:b]], linear.masks[by_flip[c:d]]
        if len(masks):
            variants.append((own[:, None] ^ masks[None, :]).ravel())
            groups.append((own, len(masks)))
    if not variants:
        return
    everything = np.concatenate(variants)
    ranked = np.sort(everything)
    shared = np.unique(ranked[1:][ranked[1:] == ranked[:-1]])
    del ranked
    if not len(shared):
        return
    # A table of one byte per hash of a shared value rules nearly all other variants out before the exact look-up.
    table = np.zeros(1 << 20, bool)
    table[(shared * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(44)] = True
    found_value, found_print = [], []
    for (own, n), some in zip(groups, variants):
        at = np.flatnonzero(table[(some * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(44)])
        values = some[at]
        place = np.minimum(np.searchsorted(shared, values), len(shared) - 1)
        hit = shared[place] == values
        found_value.append(place[hit])
        found_print.append(own[at[hit] // n])
    value, owner = np.concatenate(found_value), np.concatenate(found_print)
    order = np.lexsort((owner, value))
    value, owner = value[order], owner[order]
    first = np.concatenate([[True], value[1:] != value[:-1]])
    head = owner[np.maximum.accumulate(np.where(first, np.arange(len(owner)), 0))]
    near = (head != owner) & (np.bitwise_count(head ^ owner) <= RADIUS)
    yield np.unique(np.stack([owner[near], head[near]], 1), axis=0)


def near_links(prints: DataFrame) -> DataFrame:
    """Links ``a``, ``b`` between distinct fingerprints of column ``print`` that span all pairs within ``RADIUS``
    bits: whatever such pairs connect, these links connect. Each is itself within the radius or follows from a chain."""
    spark = prints.sparkSession
    total = prints.count()
    bits = max(LEAST_BLOCKS.bit_length() - 1, (-(-total // BLOCK_PRINTS) - 1).bit_length())
    if bits > LinearHash.BITS:
        raise ValueError("more fingerprints than the block hash can spread")

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        linear = LinearHash()
        shift = np.uint64(linear.BITS - bits)
        jumps = np.unique(linear.mask_hash >> shift)
        for batch in batches:
            own = np.asarray(batch.column(0)).view("u8")
            mine = linear(own) >> shift
            step = max(1, 4_000_000 // len(jumps))
            for i in range(0, len(own), step):
                blocks = (mine[i : i + step, None] ^ jumps[None, :]).ravel().astype("i4")
                copies = np.repeat(own[i : i + step], len(jumps)).view("i8")
                yield pa.RecordBatch.from_arrays([pa.array(blocks), pa.array(copies)], ["block", "print"])

    def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        linear = LinearHash()
        block, own = None, []

        def close() -> Iterator[pa.RecordBatch]:
            prints = np.concatenate(own).view("u8")
            hashes = linear(prints)
            more = max(0, (len(prints) * len(linear.masks) // (1 << bits) // PART_VARIANTS).bit_length())
            more = min(more, linear.BITS - bits)
            links = [x for j in range(1 << more) for x in _links_in_part(prints, hashes, linear, (block << more) + j, bits + more)]
            if links:
                joined = forest(np.concatenate(links)).view("i8")
                yield pa.RecordBatch.from_arrays([pa.array(joined[:, 0]), pa.array(joined[:, 1])], ["a", "b"])

        for batch in batches:
            blocks, prints = np.asarray(batch.column(0)), np.asarray(batch.column(1))
            cuts = [0, *(np.flatnonzero(np.diff(blocks)) + 1).tolist(), len(blocks)]
            for a, b in zip(cuts[:-1], cuts[1:]):
                if a == b:
                    continue
                if own and blocks[a] != block:
                    yield from close()
                    own = []
                block = int(blocks[a])
                own.append(prints[a:b].copy())
        if own:
            yield from close()

    sent = prints.select("print").mapInArrow(spread, "block int, print bigint")
    met = sent.repartition(1 << bits, "block").sortWithinPartitions("block")
    return met.mapInArrow(linked, "a bigint, b bigint")


def near_pairs(rows: DataFrame, *, words: int = SHINGLE) -> DataFrame:
    """Pairs ``a`` < ``b`` of ``row`` for rows ``row`` (different non-null numbers), ``text``: one row per fingerprint
    stands for those with the same one, links span what ``RADIUS`` bits connect. Nothing else is said of the texts."""
    docs = stage(fingerprints(rows, id_col="row", text_col="text", words=words))
    per_print = stage(docs.groupBy("print").agg(F.min("doc_id").alias("least")))
    same = docs.join(per_print, "print").filter("doc_id <> least").select(F.col("least").alias("a"), F.col("doc_id").alias("b"))
    ends = [per_print.select(F.col("print").alias(c), F.col("least").alias(f"row_{c}")) for c in "ab"]
    near = near_links(per_print).join(ends[0], "a").join(ends[1], "b")
    return same.union(near.select(F.least("row_a", "row_b").alias("a"), F.greatest("row_a", "row_b").alias("b")))


def near_duplicates(
    df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", words: int = SHINGLE
) -> DataFrame:
    """One row per row of ``df``: ``doc_id``, ``print`` and ``component_id``, the smallest id among all documents
    reachable over links of at most ``RADIUS`` bits, itself included.

    Null and empty texts have fingerprint zero and are linked like others. Rows with the same id are looked at each
    for itself; null ids get the component's smallest id, null if no member has one. Other columns are ignored.
    An empty table gives no rows.
    """
    docs = stage(fingerprints(df, id_col=id_col, text_col=text_col, words=words))
    per_print = stage(docs.groupBy("print").agg(F.min("doc_id").alias("least")))
    roots = components(near_links(per_print))
    named = per_print.join(roots.withColumnRenamed("node", "print"), "print", "left").select(
        "print", "least", F.coalesce("root", "print").alias("root")
    )
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    labels = named.join(least, "root").select("print", "component_id")
    return docs.join(labels, "print").select("doc_id", "print", "component_id")


def keep_one(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of ``df`` of every component, all columns kept: the one with the smallest id.

    Every row is decided for itself. A row without an id stays only where no member has one, and of rows with the
    same id one stays.
    """
    rows = numbered_rows(df)
    found = near_duplicates(rows.select(F.col("nth").alias("doc_id"), F.col("given")[text_col].alias("text")))
    roots = found.select(F.col("doc_id").alias("row"), F.col("component_id").alias("root"))
    return first_rows(rows, roots, id_col, text_col)
