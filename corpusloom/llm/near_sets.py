"""Near-duplicates by the Jaccard similarity of word shingles, without a miss.

Two sets with a similarity of at least 4/5 share one of the first ``size // 5 + 1`` members of each, in any order
that all sets follow (prefix filtering). So only these members are shuffled; two documents at one member, whose
sizes and places leave room for enough common members, are compared by their whole sets. The order puts members
that a sample finds often last, which keeps common passages out of the prefixes; it decides the work, never the result.

Pairs that lie in one SimHash ball are compared first, so that close copies are joined before any member is looked at.
Only what is connected matters, so a group at one member is first compared with one of its documents, again with
others while that connects much, and groups that lie in one component drop out. Pairs are listed only between
documents of different components.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import forget, stage
from .components import components, first_rows, numbered_rows
from .simhash import near_pairs

SHINGLE = 5
#: The least similarity, as a fraction.
SAME, OF = 4, 5
#: One text in so many is looked at for common shingles; those in so many sampled texts go last, at most so many.
SAMPLE, COMMON, MOST_COMMON = 16, 4, 1_000_000
#: Comparisons with single documents of a group before the pairs left are listed.
STARS = 3
#: Pairs per row of a group up to which they are listed at once.
FEW = 8
#: Bits of a sketch.
SKETCH = 2048
_MIX = np.random.default_rng(5).integers(1 << 62, 1 << 63, 64, dtype="u8") * np.uint64(2) + np.uint64(1)


def shingle_set(text: str | None, words: int = SHINGLE) -> np.ndarray:
    """Sorted 64-bit hashes of a text's word shingles; a shorter text is one shingle, one without a word has none."""
    from xxhash import xxh64_intdigest

    parts = (text or "").encode().lower().split()  # ASCII case and ASCII white space only
    if not parts:
        return np.zeros(0, "u8")
    hashes = np.fromiter(map(xxh64_intdigest, parts), "u8", len(parts))
    wide = min(words, len(parts))
    n = len(parts) - wide + 1
    mixed = np.full(n, wide, "u8")
    for k in range(wide):
        mixed += hashes[k : k + n] * _MIX[k]
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB), (31, 1)):
        mixed = (mixed ^ mixed >> np.uint64(shift)) * np.uint64(factor)
    return np.unique(mixed)


def similar(a: np.ndarray, b: np.ndarray) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return (SAME + OF) * both >= SAME * (len(a) + len(b))


def _lists(sets: list[np.ndarray]) -> pa.Array:
    offsets = np.cumsum([0, *map(len, sets)]).astype("i4")
    values = np.concatenate(sets).view("i8") if sets else np.zeros(0, "i8")
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))


def _sets(rows: DataFrame, words: int) -> DataFrame:
    """``row`` and ``members`` of ``row``, ``text``."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from .token_codes import small_runs

        for batch in batches:
            for a, texts in small_runs(batch.column(1)):
                sets = _lists([shingle_set(t.as_py(), words) for t in texts])
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, len(texts)), sets], ["row", "members"])

    return rows.select("row", "text").mapInArrow(made, "row bigint, members array<bigint>")


def _common(rows: DataFrame, words: int) -> np.ndarray:
    """Sorted shingles that many sampled texts hold."""
    sample = rows.filter(F.pmod(F.xxhash64("text"), F.lit(SAMPLE)) == 0)
    counts = _sets(sample, words).select(F.explode("members").alias("h")).groupBy("h").agg(F.count("*").alias("n"))
    top = counts.filter(F.col("n") >= COMMON).orderBy(F.col("n").desc(), "h").limit(MOST_COMMON).select("h")
    return np.sort(np.asarray(top.toArrow().column("h").to_numpy()).view("u8"))


def _prefixes(rows: DataFrame, words: int) -> DataFrame:
    """``row``, ``same`` (equal for equal sets), ``size``, ``prefix``, the first members in the common order, and ``sketch``,
    a bit per part of the hash range: whether an odd number of members lies there. Sketches differ in no more bits than
    sets in members."""
    sent = rows.sparkSession.sparkContext.broadcast(_common(rows, words))

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common = sent.value
        for batch in batches:
            same, sizes, firsts, odd = [], [], [], []
            for text in batch.column(1):
                members = shingle_set(text.as_py(), words)
                same.append(hashlib.md5(members.tobytes()).digest())
                sizes.append(len(members))
                part = (members >> np.uint64(65 - SKETCH.bit_length())).astype("i8")
                odd.append(np.packbits(np.bincount(part, minlength=SKETCH) & 1).tobytes())
                often = np.zeros(len(members), bool)
                if len(common):
                    often = common[np.minimum(np.searchsorted(common, members), len(common) - 1)] == members
                firsts.append(np.concatenate([members[~often], members[often]])[: len(members) * (OF - SAME) // OF + 1])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(same, pa.binary()), pa.array(sizes, pa.int32()), _lists(firsts), pa.array(odd, pa.binary())],
                ["row", "same", "size", "prefix", "sketch"],
            )

    return rows.select("row", "text").mapInArrow(made, "row bigint, same binary, size int, prefix array<bigint>, sketch binary")


def _shared(tokens: DataFrame) -> DataFrame:
    """``tokens`` (``h``, ``row``, ``room``) whose ``h`` another row has too, besides a few at the ends of partitions."""

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, before = None, None  # the last row seen, and what stood before it
        for batch in batches:
            if not batch.num_rows:
                continue
            table = batch if held is None else pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
            h = np.asarray(table.column(0))
            equal = h[1:] == h[:-1]
            alike = np.concatenate([[before is None or before == h[0]], equal]) | np.concatenate([equal, [False]])
            yield table.slice(0, len(h) - 1).filter(pa.array(alike[:-1]))
            held, before = table.slice(len(h) - 1), h[-2] if len(h) > 1 else before
        if held is not None:
            yield held

    ordered = tokens.repartitionByRange("h", "row").sortWithinPartitions("h", "row")
    return ordered.mapInArrow(kept, "h bigint, row bigint, room int")


def _linked(pairs: DataFrame, rows: DataFrame, made: DataFrame, words: int) -> DataFrame:
    """Those of the pairs ``a``, ``b`` of rows that are similar enough."""

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = (np.frombuffer(b"".join(batch.column(k).to_pylist()), "u8").reshape(-1, SKETCH // 64) for k in (2, 3))
            differ = np.bitwise_count(x ^ y).sum(1, dtype="i8")
            sizes = np.asarray(batch.column(4)).astype("i8") + np.asarray(batch.column(5))
            yield batch.select(["a", "b"]).filter(pa.array((OF + SAME) * differ <= (OF - SAME) * sizes))

    told = made.select(F.col("row").alias("a"), F.col("sketch").alias("p"), F.col("size").alias("m"))
    other = made.select(F.col("row").alias("b"), F.col("sketch").alias("q"), F.col("size").alias("n"))
    sketched = pairs.distinct().join(told, "a").join(other, "b").select("a", "b", "p", "q", "m", "n")
    pairs = stage(sketched.mapInArrow(near, "a bigint, b bigint"))
    if pairs.isEmpty():
        return pairs
    asked = pairs.select(F.col("a").alias("row")).union(pairs.select(F.col("b").alias("row"))).distinct()
    sets = stage(_sets(rows.join(asked, "row", "left_semi"), words))
    both = pairs.join(sets.select(F.col("row").alias("a"), F.col("members").alias("left")), "a").join(
        sets.select(F.col("row").alias("b"), F.col("members").alias("right")), "b"
    ).select("a", "b", "left", "right")

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = batch.column(2), batch.column(3)
            alike = [
                similar(np.asarray(left[i].values).view("u8"), np.asarray(right[i].values).view("u8"))
                for i in range(batch.num_rows)
            ]
            yield batch.select(["a", "b"]).filter(pa.array(alike, pa.bool_()))

    out = stage(both.mapInArrow(compared, "a bigint, b bigint"))
    forget(pairs)
    forget(sets)
    return out


def _star(nth: int):
    """Orders the rows of a group; the first is the one that the group is compared with in this turn."""
    return F.struct(F.xxhash64(F.lit(nth), "row"), "row")


def _unsettled(left: DataFrame, roots: DataFrame, nth: int | None = None) -> DataFrame:
    """``left`` with its rows' present roots, without groups that lie in one component, and without the rows that their
    groups were compared with in turn ``nth``: whatever such a row is like in its group is known."""
    named = left.drop("root").join(roots.withColumnRenamed("node", "row"), "row", "left").withColumn(
        "root", F.coalesce("root", "row")
    )
    done = F.lit(None).cast("bigint") if nth is None else F.min_by("row", _star(nth))
    mixed = named.groupBy("h").agg(F.min("root").alias("p"), F.max("root").alias("q"), done.alias("done")).filter("p < q")
    open_ = named.join(mixed.select("h", "done"), "h").filter(~F.col("row").eqNullSafe(F.col("done")))
    out = stage(open_.select("h", "row", "size", "room", "root"))
    forget(left)
    return out


def near_rows(rows: DataFrame, words: int = SHINGLE) -> DataFrame:
    """``row`` and ``root`` for all rows of ``row`` (different non-null numbers) and ``text``: rows have one root if links
    of similarity at least ``SAME / OF`` connect them. Texts without a word are alike. An empty table gives no rows."""
    made = stage(_prefixes(rows, words))
    heads = stage(made.groupBy("same").agg(F.min("row").alias("row")))
    # Room from a member on: two sets can reach the similarity only with that many members left in both.
    tokens = made.select(F.posexplode("prefix").alias("at", "h"), "row", "size").select(
        "h", "row", (F.col("size") - F.col("at")).cast("int").alias("room")
    )
    sizes = made.select("row", "size").join(heads.select("row"), "row", "left_semi")
    shared = stage(_shared(tokens))
    left = stage(shared.join(sizes, "row").withColumn("root", F.col("row")))
    forget(shared)
    # Different sets in one SimHash ball first; what the ball misses is left to the shared members.
    texts = rows.join(heads.select("row"), "row", "left_semi")
    links = _linked(near_pairs(texts, words=words), rows, made, words)
    roots = stage(components(links))
    forget(links)
    left = _unsettled(left, roots)

    def fits(x: str, y: str):
        room = F.least(f"{x}.room", f"{y}.room")
        return (SAME + OF) * room >= SAME * (F.col(f"{x}.size") + F.col(f"{y}.size"))

    def ends(x: str, y: str):
        return F.least(f"{x}.row", f"{y}.row").alias("a"), F.greatest(f"{x}.row", f"{y}.row").alias("b")

    for nth in range(STARS + 1):
        per_root = left.groupBy("h", "root").agg(F.count("*").alias("n"))
        sums = per_root.groupBy("h").agg(F.sum("n").alias("s"), F.sum(F.col("n") * F.col("n")).alias("q"))
        total = sums.agg(F.sum("s").alias("rows"), (F.sum(F.col("s") * F.col("s") - F.col("q")) / 2).alias("pairs")).first()
        if not total["pairs"]:
            break
        last = nth == STARS or total["pairs"] <= FEW * total["rows"]
        if last:
            pairs = left.alias("x").join(left.alias("y"), "h").filter(F.col("x.root") < F.col("y.root"))
        else:
            chosen = F.min_by(F.struct("row", "size", "room", "root"), _star(nth)).alias("y")
            star = left.groupBy("h").agg(chosen).select("h", "y.*")
            pairs = left.alias("x").join(star.alias("y"), "h").filter(F.col("x.root") != F.col("y.root"))
        found = _linked(pairs.filter(fits("x", "y")).select(*ends("x", "y")), rows, made, words)
        if not found.isEmpty():
            # What was connected before is a star a component, however many links told so.
            before, known = roots, roots.select(F.col("node").alias("a"), F.col("root").alias("b")).filter("a <> b")
            roots = stage(components(known.union(found)))
            forget(before)
        forget(found)
        if last:
            break
        left = _unsettled(left, roots, nth)
    labelled = made.select("row", "same").join(heads.withColumnRenamed("row", "head"), "same")
    return labelled.join(roots.withColumnRenamed("node", "head"), "head", "left").select("row", F.coalesce("root", "head").alias("root"))


def keep_one(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", words: int = SHINGLE) -> DataFrame:
    """One row of ``df`` of every group of near-duplicates, all columns kept: the one with the smallest id.

    Every row is decided for itself. A row without an id stays only where no member has one, and of rows with the
    same id one stays. Null and empty texts are alike. An empty table gives no rows.
    """
    rows = numbered_rows(df)
    roots = near_rows(rows.select(F.col("nth").alias("row"), F.col("given")[text_col].alias("text")), words)
    return first_rows(rows, roots, id_col, text_col)
