"""Uniform shuffle into shards of exact sizes by a hypergeometric communication matrix.

Rows fall in blocks by a seeded hash. How many rows of each block go to each shard is drawn before anything moves:
the counts of a uniform permutation are multivariate hypergeometric, and their column sums are the shard
sizes, exact to the row. Each block permutes its rows and deals them out by its line of the matrix; each shard
permutes what it got. Only block and cell counts meet in one place: rows of a shard are ranked in cells of a
second hash, so no task holds a shard.
"""

from __future__ import annotations

import math
import random
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Rows of a block or cell on average, and the most blocks (a block grows beyond that, the matrix does not).
BLOCK_ROWS = 4096
MOST_BLOCKS = 16_384


def hypergeometric(draw: random.Random, good: int, bad: int, n: int) -> int:
    """How many of ``n`` draws without replacement are good. Exact inversion from the mode for narrow
    distributions, ratio of uniforms (Stadlober) for wide ones, at any size."""
    total = good + bad
    low, high = max(0, n - bad), min(n, good)
    if low == high:
        return low

    def log_weight(k: int) -> float:
        return -sum(math.lgamma(x + 1) for x in (k, good - k, n - k, bad - n + k))

    mode = min(high, max(low, (n + 1) * (good + 1) // (total + 2)))
    mean, peak = n * good / total, log_weight(mode)
    spread = math.sqrt(max(0.0, mean * (bad / total) * (total - n) / max(1, total - 1)))
    if spread < 20:
        norm = math.lgamma(good + 1) + math.lgamma(bad + 1) + math.lgamma(n + 1) + math.lgamma(total - n + 1)
        at_mode = math.exp(peak + norm - math.lgamma(total + 1))
        left = draw.random() - at_mode
        up = down = mode
        p_up = p_down = at_mode
        while left > 0 and (up < high or down > low):
            if up < high:
                p_up *= (good - up) * (n - up) / ((up + 1) * (bad - n + up + 1))
                up += 1
                left -= p_up
                if left <= 0:
                    return up
            if down > low:
                p_down *= down * (bad - n + down) / ((good - down + 1) * (n - down + 1))
                down -= 1
                left -= p_down
                if left <= 0:
                    return down
        return mode
    width = 2 * math.sqrt(2 / math.e) * math.sqrt(spread * spread + 0.5) + 3 - 2 * math.sqrt(3 / math.e)
    while True:
        u, v = 1 - draw.random(), draw.random()
        k = math.floor(mean + 0.5 + width * (v - 0.5) / u)
        if low <= k <= high and 2 * math.log(u) <= log_weight(k) - peak:
            return k


def communication_matrix(draw: random.Random, blocks: Sequence[int], shards: Sequence[int]) -> list[list[int]]:
    """Counts by block and shard with the law of a uniform permutation; rows and columns sum up to the given sizes."""
    room, out = list(shards), []
    for size in blocks:
        line, rest = [], sum(room)
        for s, here in enumerate(room):
            k = hypergeometric(draw, here, rest - here, size)
            rest -= here
            size -= k
            room[s] -= k
            line.append(k)
        out.append(line)
    return out


def shuffle_into_shards(
    df: DataFrame, shards: int, *, keys: Sequence[str] = ("doc_id",), seed: int = 29, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """Add ``shard`` (0 … shards-1, row counts at most one apart) and ``slot`` (gapless from 0 in each shard).

    keys  columns that tell rows apart; rows equal in all of them are interchangeable, and each gets a slot

    The first ``rows mod shards`` shards have one row more. Nulls in ``keys`` are values like others. Fewer rows
    than shards leave the last shards empty; an empty table gives no rows. The frame must be repeatable: it is
    read once to count blocks and once to deal rows. Columns named ``shard`` or ``slot`` are replaced.
    """
    spark, names = df.sparkSession, [c for c in df.columns if c not in ("shard", "slot")]
    told = [F.coalesce(F.col(c).cast("string"), F.lit("\0null")) for c in keys]
    # The caller's columns travel in one struct, so that none can clash with a helper.
    rows = df.select(
        F.struct(*names).alias("given"), F.struct(*keys).alias("told"),
        F.xxhash64(F.lit(seed), *told).alias("__k1"), F.xxhash64(F.lit(seed + 1), *told).alias("__k2"),
    )
    # Counted over the most blocks there can be; neighbours are joined until blocks have the wanted size.
    fine = F.shiftrightunsigned("__k1", 64 - MOST_BLOCKS.bit_length() + 1).cast("int")
    counted = {r["b"]: r["n"] for r in rows.groupBy(fine.alias("b")).agg(F.count("*").alias("n")).collect()}
    total = sum(counted.values())
    step = 1
    while step < MOST_BLOCKS and total / (MOST_BLOCKS // step) < block_rows:
        step *= 2
    blocks = [0] * (MOST_BLOCKS // step)
    for b, n in counted.items():
        blocks[b // step] += n
    matrix = communication_matrix(random.Random(seed), blocks, [(total + shards - 1 - s) // shards for s in range(shards)])
    ends = []
    for b, line in enumerate(matrix):
        at, line_ends = 0, []
        for k in line:
            at += k
            line_ends.append(at)
        ends.append((b, line_ends))
    deal = spark.createDataFrame(ends, "__block int, __ends array<bigint>")

    # Local permutation, then the exchange: row r of a block goes to the first shard whose end lies beyond r.
    in_block = Window.partitionBy("__block").orderBy("__k2", "told")
    placed = rows.withColumn("__block", F.floor(fine / step).cast("int"))
    ranked = placed.withColumn("__r", F.row_number().over(in_block) - 1).join(F.broadcast(deal), "__block")
    dealt = ranked.withColumn("shard", F.size(F.filter("__ends", lambda e: e <= F.col("__r"))))

    # Second permutation, by a hash of the place in the first: cells of a shard are summed up, rows ranked in cells.
    cells = max(1, len(blocks) // shards)
    again = dealt.withColumn("__k3", F.xxhash64(F.lit(seed + 2), "__block", "__r"))
    again = again.withColumn("__cell", F.pmod("__k3", F.lit(cells)).cast("int"))
    per = again.groupBy("shard", "__cell").agg(F.count("*").alias("__n"))
    before = Window.partitionBy("shard").orderBy("__cell").rowsBetween(Window.unboundedPreceding, -1)
    per = per.select("shard", "__cell", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    in_cell = Window.partitionBy("shard", "__cell").orderBy("__k3", "__block", "__r")
    slots = again.withColumn("__rank", F.row_number().over(in_cell) - 1).join(F.broadcast(per), ["shard", "__cell"])
    return slots.select("given.*", "shard", (F.col("__before") + F.col("__rank")).cast("bigint").alias("slot"))
