"""Connected components of a graph given by its edges, as repeated shuffles (large star, small star).

Every round links each node's larger neighbours to the smallest node around it, then its smaller ones, until
nothing changes: logarithmically many rounds, each with counts and minima that are pre-aggregated per task. A node
with a third of all edges is a skewed join side that Spark splits; its edges never meet in one row. Before each
round tasks put what ``TOGETHER`` edges connect as stars, so most graphs need one round or none.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import forget, stage


#: Edges that one task looks at together. More are dealt over more tasks and joined by rounds of shuffles.
TOGETHER = 1 << 18


def forest(links: np.ndarray) -> np.ndarray:
    """Links that join the same nodes, at most one per node: each to the smallest one it is connected to."""
    nodes, ends = np.unique(links, return_inverse=True)
    ends = ends.reshape(-1, 2)
    root = np.arange(len(nodes))
    while True:
        low = np.minimum(root[ends[:, 0]], root[ends[:, 1]])
        before = root.copy()
        for side in (0, 1):
            np.minimum.at(root, root[ends[:, side]], low)
            np.minimum.at(root, ends[:, side], low)
        while not np.array_equal(root, root[root]):
            root = root[root]
        if np.array_equal(root, before):
            break
    away = root != np.arange(len(nodes))
    return np.stack([nodes[away], nodes[root[away]]], 1)


def _as_stars(edges: DataFrame) -> DataFrame:
    """Edges ``u`` > ``v`` that connect the same nodes, put as stars by tasks that see at most ``TOGETHER`` at once."""

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def close() -> pa.RecordBatch:
            links = forest(np.concatenate(held))
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(links[:, 0]), pa.array(links[:, 1])], ["u", "v"])

        for batch in batches:
            if held and sum(map(len, held)) + batch.num_rows > TOGETHER:
                yield close()
            held.append(np.stack([np.asarray(batch.column(0)), np.asarray(batch.column(1))], 1))
        if held:
            yield close()

    return edges.mapInArrow(joined, "u bigint, v bigint")


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node`` and ``root``, the smallest node it is connected to (itself included), for all nodes of ``edges``.

    Edges may repeat or point to themselves; null ends are ignored. No edges: no rows. Every round is written to
    the shared folder, which cuts the lineage and outlives lost executors.
    """
    pairs = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).na.drop()
    first = stage(pairs.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    state, rounds = first.filter("u <> v"), 0
    numbers = all(kind == "bigint" for _, kind in pairs.dtypes)
    while True:
        if numbers:
            parts = max(1, -(-state.count() // TOGETHER))
            before, state = state, stage(_as_stars(state.coalesce(parts)))
            if rounds:
                forget(before)
            if parts == 1:
                break
        if _are_stars(state):
            break
        before, state, rounds = state, stage(_small_star(_large_star(state))), rounds + 1
        if numbers or rounds > 1:
            forget(before)
    ends = state.select(F.col("u").alias("node"), F.col("v").alias("root"))
    roots = state.select(F.col("v").alias("node"), F.col("v").alias("root"))
    loops = first.filter("u = v").select(F.col("u").alias("node"), F.col("v").alias("root"))
    known = ends.union(roots).union(loops)
    return known.groupBy("node").agg(F.min("root").alias("root"))


def _are_stars(edges: DataFrame) -> bool:
    """Whether every node has one smaller neighbour at most, and that one has none: then the edges are the answer."""
    kind = edges.schema["v"].dataType
    roles = edges.select(F.col("u").alias("node"), F.col("v").alias("next"), F.lit(0).alias("above")).union(
        edges.select("v", F.lit(None).cast(kind), F.lit(1))
    )
    per = roles.groupBy("node").agg(F.min("next").alias("p"), F.max("next").alias("q"), F.max("above").alias("above"))
    return per.filter("p < q or p is not null and above = 1").isEmpty()


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the smallest node among the node and its neighbours."""
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    linked = both.filter("v > u").join(least, "u")
    return linked.select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the smallest of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    others = down.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return others.union(least.select("u", F.col("m").alias("v"))).filter("u <> v").distinct()


def numbered_rows(df: DataFrame) -> DataFrame:
    """``(nth, given)``: a number per row beside all its columns in one struct, so that none can clash; written once."""
    return stage(df.select(F.monotonically_increasing_id().alias("nth"), F.struct("*").alias("given")))


def first_rows(rows: DataFrame, roots: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The columns of one of ``numbered_rows`` for each ``root`` of ``roots`` (``row``, ``root``): the smallest
    id, null ids last, ties by a hash of the text."""
    known = rows.select(F.col("nth").alias("row"), F.col("given")[id_col].alias("id"), F.xxhash64(F.col("given")[text_col]).alias("twin"))
    order = F.struct(F.col("id").isNull().alias("without"), "id", "twin", "row")
    first = roots.join(known, "row").groupBy("root").agg(F.min(order).alias("first"))
    stays = first.select(F.col("first.row").alias("nth")).hint("merge")  # nearly all rows: one plan at every size
    return rows.join(stays, "nth", "left_semi").select("given.*")
