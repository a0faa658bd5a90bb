"""Quality classifier: a generalised additive model with pairwise interactions, by cyclic boosting.

Every text gives a row of plain numbers. Each feature, and each of a few pairs of features, has a look-up table over
bins; a score is the logistic function of the sum of one entry per table. The tables are learnt in turns: round
after round, every table gets a small step of a shallow tree fitted to the current errors, so no feature can take
all the credit of its neighbours. Features are computed where the texts lie; learning uses a bounded sample of labelled
rows, and scoring is vectorised addition of table entries.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import combinations
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import in_learning_part

#: Labelled rows that are learnt from: all of them up to this many, else a hash sample of about as many.
SAMPLE_ROWS = 50_000
BINS = 32
PAIR_BINS = 8
PAIRS = 6
ROUNDS = 120
PAIR_ROUNDS = 40
STEP = 0.15
LEAVES = 3
LEAST_WEIGHT = 5.0

FEATURES = (
    "log_words", "word_length", "upper", "symbols", "digits", "shouts", "bars", "punctuation", "letters", "non_ascii",
    "stutter", "distinct_words", "top_word", "line_words", "ended_lines", "repeated_lines", "marked_words",
    "single_words",
)


def _bytes_in(chars: str | bytes) -> np.ndarray:
    table = np.zeros(256)
    table[list(chars.encode() if isinstance(chars, str) else chars)] = 1
    return table


_KINDS = np.stack([
    _bytes_in("ABCDEFGHIJKLMNOPQRSTUVWXYZ"), _bytes_in("#*$%&<>=_~^"), _bytes_in("0123456789"), _bytes_in("!?"),
    _bytes_in("|"), _bytes_in(".,;:'\"()-"),
    _bytes_in("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"), _bytes_in(bytes(range(128, 256))),
], 1)


def features(text: str | None) -> list[float]:
    """The text's row of numbers, in the order of ``FEATURES``; all zero without a word."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    words = raw.split()
    n = len(words)
    if not n:
        return [0.0] * len(FEATURES)
    chars = np.bincount(np.frombuffer(raw, "u1"), minlength=256)
    solid = sum(map(len, words))
    upper, symbols, digits, shouts, bars, points, letters, wide = (chars @ _KINDS).tolist()
    counts = Counter(words)
    lines = [line for line in raw.split(b"\n") if line.strip()]
    ended = sum(line.rstrip()[-1:] in b".!?\"':;" for line in lines)
    marked = sum(w[-2:] in (b"!!", b"##", b"$$", b"%%", b"&&", b"**") for w in counts)
    return [
        math.log(n), solid / n, upper / max(1.0, letters), symbols / solid, digits / solid, shouts / solid, bars / n,
        points / n, letters / solid, wide / solid, sum(map(eq, words, words[1:])) / n, len(counts) / n,
        max(counts.values()) / n, n / len(lines), ended / len(lines), 1 - len(set(lines)) / len(lines),
        marked / len(counts), sum(v == 1 for v in counts.values()) / len(counts),
    ]


def text_features(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and ``x`` (array of doubles) for every row."""
    rows = df.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = [features(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(x, pa.list_(pa.float64()))], ["doc_id", "x"])

    return rows.mapInArrow(made, "doc_id bigint, x array<double>")


@dataclass
class Gam:
    """Cuts and tables; a pair's table is indexed by the bins of its two features."""

    base: float
    cuts: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int]] = field(default_factory=list)
    pair_cuts: list[np.ndarray] = field(default_factory=list)
    pair_tables: list[np.ndarray] = field(default_factory=list)

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        for j, (cuts, table) in enumerate(zip(self.cuts, self.tables)):
            total += table[np.searchsorted(cuts, x[:, j], "right")]
        for (i, j), table in zip(self.pairs, self.pair_tables):
            a = np.searchsorted(self.pair_cuts[i], x[:, i], "right")
            b = np.searchsorted(self.pair_cuts[j], x[:, j], "right")
            total += table[a, b]
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def _cuts(values: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(values, np.linspace(0, 1, bins + 1)[1:-1], method="higher"))


def _tree(g: np.ndarray, h: np.ndarray, leaves: int) -> np.ndarray:
    """Values of a shallow regression tree over ordered bins with gradient and weight sums ``g`` and ``h``."""
    parts = [(0, len(g))]

    def best(a: int, b: int) -> tuple[float, int]:
        left_g, left_h = np.cumsum(g[a:b])[:-1], np.cumsum(h[a:b])[:-1]
        all_g, all_h = g[a:b].sum(), h[a:b].sum()
        ok = (left_h >= LEAST_WEIGHT) & (all_h - left_h >= LEAST_WEIGHT)
        if not ok.any():
            return 0.0, -1
        gain = np.where(ok, left_g**2 / (left_h + 1) + (all_g - left_g) ** 2 / (all_h - left_h + 1), 0)
        at = int(gain.argmax())
        return float(gain[at] - all_g**2 / (all_h + 1)), a + at + 1

    while len(parts) < leaves:
        choices = [(*best(a, b), k) for k, (a, b) in enumerate(parts)]
        gain, at, k = max(choices)
        if at < 0 or gain <= 0:
            break
        a, b = parts[k]
        parts[k : k + 1] = [(a, at), (at, b)]
    out = np.zeros(len(g))
    for a, b in parts:
        out[a:b] = g[a:b].sum() / (h[a:b].sum() + 1)
    return out


def _quadrants(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """Best tree with one cut on either axis of a grid: its gain and its values."""
    best, out = 0.0, np.zeros(g.shape)
    sum_g, sum_h = g.cumsum(0).cumsum(1), h.cumsum(0).cumsum(1)
    for a in range(g.shape[0] - 1):
        for b in range(g.shape[1] - 1):
            gs, hs = [], []
            for s, into in ((sum_g, gs), (sum_h, hs)):
                ll, lr, rl = s[a, b], s[a, -1] - s[a, b], s[-1, b] - s[a, b]
                into += [ll, lr, rl, s[-1, -1] - ll - lr - rl]
            gain = sum(x * x / (w + 1) for x, w in zip(gs, hs) if w >= LEAST_WEIGHT)
            if gain > best:
                best = gain
                values = [x / (w + 1) if w >= LEAST_WEIGHT else 0.0 for x, w in zip(gs, hs)]
                out = np.zeros(g.shape)
                out[: a + 1, : b + 1], out[: a + 1, b + 1 :], out[a + 1 :, : b + 1], out[a + 1 :, b + 1 :] = values
    return best, out


def fit(x: np.ndarray, y: np.ndarray) -> Gam:
    """Tables from features ``x`` and labels ``y`` (0 or 1). Without rows, or with one label only: the base rate."""
    rate = (y.sum() + 1) / (len(y) + 2)
    model = Gam(math.log(rate / (1 - rate)))
    if not len(y) or y.min() == y.max():
        return model
    n = x.shape[1]
    model.cuts = [_cuts(x[:, j], BINS) for j in range(n)]
    binned = [np.searchsorted(c, x[:, j], "right") for j, c in enumerate(model.cuts)]
    model.tables = [np.zeros(len(c) + 1) for c in model.cuts]
    total = np.full(len(y), model.base)

    def errors() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-total))
        return y - p, p * (1 - p)

    for _ in range(ROUNDS):
        for j in range(n):
            e, w = errors()
            size = len(model.tables[j])
            step = STEP * _tree(np.bincount(binned[j], e, size), np.bincount(binned[j], w, size), LEAVES)
            model.tables[j] += step
            total += step[binned[j]]

    model.pair_cuts = [_cuts(x[:, j], PAIR_BINS) for j in range(n)]
    coarse = [np.searchsorted(c, x[:, j], "right") for j, c in enumerate(model.pair_cuts)]
    sizes = [len(c) + 1 for c in model.pair_cuts]
    cell = {(i, j): coarse[i] * sizes[j] + coarse[j] for i, j in combinations(range(n), 2)}

    def grids(i: int, j: int) -> tuple[np.ndarray, np.ndarray]:
        e, w = errors()
        shape = (sizes[i], sizes[j])
        return tuple(np.bincount(cell[i, j], v, sizes[i] * sizes[j]).reshape(shape) for v in (e, w))

    gains = sorted(((_quadrants(*grids(i, j))[0], i, j) for i, j in cell), reverse=True)
    model.pairs = [(i, j) for gain, i, j in gains[:PAIRS] if gain > 0]
    model.pair_tables = [np.zeros((sizes[i], sizes[j])) for i, j in model.pairs]
    for _ in range(PAIR_ROUNDS):
        for k, (i, j) in enumerate(model.pairs):
            step = STEP * _quadrants(*grids(i, j))[1]
            model.pair_tables[k] += step
            total += step.ravel()[cell[i, j]]
    return model


def learn(
    rows: DataFrame, labels: DataFrame, *, label_col: str = "quality", id_col: str = "doc_id",
    sample_rows: int = SAMPLE_ROWS,
) -> Gam:
    """Fit to the features ``rows`` of the documents that ``labels`` marks 0 or 1 and that may be learnt from.

    A document labelled several times counts as often; labels that are null, or of unknown documents, do not count.
    """
    marks = labels.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(label_col).cast("double").alias("y"))
    known = rows.join(marks.filter("y in (0, 1)"), "doc_id").filter(in_learning_part())
    total = known.count()
    if total > sample_rows:
        share = int(sample_rows / total * 1_000_000)
        known = known.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < share)
    seen = known.select("doc_id", "x", "y").orderBy("doc_id", "y").toArrow()
    x = np.asarray(seen["x"].combine_chunks().flatten()).reshape(-1, len(FEATURES))
    return fit(x, np.asarray(seen["y"]))


def scored(rows: DataFrame, model: Gam, threshold: float = 0.7) -> DataFrame:
    """``doc_id``, ``score`` and ``predicted`` for rows of features."""
    sent = rows.sparkSession.sparkContext.broadcast(model)

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = sent.value.score(np.asarray(batch.column(1).flatten()).reshape(-1, len(FEATURES)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(score)], ["doc_id", "score"])

    scores = rows.select("doc_id", "x").mapInArrow(added, "doc_id bigint, score double")
    return scores.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def classify(
    df: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
    threshold: float = 0.7, sample_rows: int = SAMPLE_ROWS,
) -> DataFrame:
    """One row per row of ``df``: ``doc_id``, ``held_out``, ``score`` and ``predicted``.

    Held out are rows whose crc32 of the id as text is 2 modulo 4; they are never learnt from. Null and empty texts are
    scored like others, by features that are all zero. Rows that repeat are scored each for itself; rows without an
    id are scored, not learnt from, and not held out. An empty table gives no rows; no usable label, the base rate.
    """
    from ..session import stage

    rows = stage(text_features(df, id_col=id_col, text_col=text_col))
    model = learn(rows, labels, label_col=label_col, id_col=id_col, sample_rows=sample_rows)
    held_out = F.coalesce(~in_learning_part(), F.lit(False)).alias("held_out")
    return scored(rows, model, threshold).select("doc_id", held_out, "score", "predicted")
