"""Benchmark decontamination by spaced-seed hashing.

A leak is a whole benchmark item, or a stretch of ``WINDOW`` consecutive words of one, of which at least
``SIMILARITY`` stand in a document at the same distance from each other. Words may be replaced, so the
seeds are masks over five positions with one left out, or over four in a row: any five aligned words with at
most one difference match one of the four masks, and a stretch at 0.8 always holds five such words (or four words
without a difference). No leak can be missed.

Seeds of items and documents are joined by hash. A hit that only continues its neighbour (the word before it, or the
left-out word, agrees too) is not made, so a copied passage has one hit, however long, and each replaced word adds
a few. Around every hit the stretch is then compared word by word.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stage
from .tables import plain_words, texts

#: Places that a mask compares, and the place whose agreement makes the hit superfluous.
MASKS = (((0, 1, 2, 3), -1), ((0, 2, 3, 4), 1), ((0, 1, 3, 4), 2), ((0, 1, 2, 4), 3))
WINDOW = 13
SIMILARITY = 0.8
#: Up to so many benchmark seeds (some 50 MB) their table goes to every executor; a longer one is joined by shuffle.
BROADCAST_SEEDS = 1_000_000
#: Up to so many words of items to compare (8 bytes each) they are sent to the texts; otherwise texts move to them.
BROADCAST_WORDS = 4_000_000
#: Words of items, summed over places, that a document is compared with at once.
WORDS_AT_ONCE = 500_000


def _seeds(h: str) -> Column:
    """All seeds of an array of word hashes, as an array of (``key``, ``other``, ``at``)."""

    def of_mask(number: int, places: tuple[int, ...], left_out: int) -> Column:
        starts = F.when(F.size(h) > places[-1], F.sequence(F.lit(0), F.size(h) - places[-1] - 1))
        return F.transform(
            F.coalesce(starts, F.array().cast("array<int>")),
            lambda at: F.struct(
                F.xxhash64(F.lit(number), *[F.get(h, at + p) for p in places]).alias("key"),
                F.get(h, at + left_out).alias("other"), at.alias("at"),
            ),
        )

    return F.flatten(F.array(*[of_mask(k, p, o) for k, (p, o) in enumerate(MASKS)]))


def leaks(
    docs: DataFrame, bench: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
    item_text_col: str = "text", window: int = WINDOW, similarity: float = SIMILARITY,
    words_at_once: int = WORDS_AT_ONCE,
) -> DataFrame:
    """One row per document and benchmark item it leaks: ``doc_id``, ``item_id``, ``doc_words``, ``item_words``, ``same_words``
    (most equal words at one shift) and ``best_window`` (share of equal words in the best stretch, or in the whole item).

    Words are lower-case letters, digits and everything beyond ASCII. Null and empty texts leak nothing, and items of
    fewer than four words cannot be told from chance and are never leaked. Rows with the same id are one document or
    item in the result; null ids stay null and are joined like others. Empty tables give no rows. Extra columns
    are ignored.
    """

    def hashed(text: Column) -> Column:
        return F.transform(plain_words(text), lambda w: F.xxhash64(w))

    d = texts(docs, id_col, text_col)
    items = texts(bench, item_col, item_text_col).select(F.col("doc_id").alias("item_id"), hashed(F.col("text")).alias("item"))
    wanted = items.select("item_id", F.inline(_seeds("item"))).select(
        "key", F.col("other").alias("item_other"), "item_id", F.col("at").alias("item_at")
    )
    if wanted.limit(BROADCAST_SEEDS + 1).count() <= BROADCAST_SEEDS:
        wanted = F.broadcast(wanted)
    seeds = d.select("doc_id", hashed(F.col("text")).alias("h")).select("doc_id", F.inline(_seeds("h")))
    hits = seeds.join(wanted, "key").filter(
        F.col("other").isNull() | F.col("item_other").isNull() | (F.col("other") != F.col("item_other"))
    )
    places = stage(hits.select("doc_id", "item_id", (F.col("at") - F.col("item_at")).alias("shift")).distinct())
    # The places of a document go back to its text in parts of bounded size, each compared with its items at once.
    weighed = places.join(
        items.select(F.col("item_id").alias("of_item"), "item", F.size("item").cast("bigint").alias("n")),
        F.col("item_id").eqNullSafe(F.col("of_item")),
    )
    per_doc = weighed.groupBy("doc_id").agg(F.sum("n").alias("words"))
    total = per_doc.agg(F.sum("words")).first()[0] or 0
    parts = per_doc.select(F.col("doc_id").alias("of_doc"), F.ceil(F.col("words") / words_at_once).alias("parts"))
    part = F.pmod(F.xxhash64("item_id", "shift"), F.col("parts")).alias("part")
    asked = weighed.join(parts, F.col("doc_id").eqNullSafe(F.col("of_doc"))).groupBy("doc_id", part).agg(
        F.collect_list(F.struct("item_id", "shift", "item")).alias("asked")
    )
    if total <= BROADCAST_WORDS:
        asked = F.broadcast(asked)
    asked = asked.select(F.col("doc_id").alias("asked_id"), "asked")
    found = d.join(asked, F.col("doc_id").eqNullSafe(F.col("asked_id")))

    def compared(h: Column, x: Column) -> Column:
        same = F.transform(x["item"], lambda w, j: F.coalesce(F.get(h, x["shift"] + j) == w, F.lit(False)))
        return F.struct(x["item_id"].alias("item_id"), same.alias("same"))

    def judged(x: Column) -> Column:
        n = F.size(x["same"])
        width = F.least(n, F.lit(window))
        count = F.size(F.filter(x["same"], lambda y: y))
        stretches = F.transform(
            F.sequence(F.lit(0), n - width), lambda s: F.size(F.filter(F.slice(x["same"], s + 1, width), lambda y: y)) / width
        )
        return F.struct(
            x["item_id"].alias("item_id"), n.alias("n"), count.alias("same_words"),
            F.greatest(F.array_max(stretches), count / n).alias("best_window"),
        )

    # The hashes are bound as a variable: the text is cut and hashed once, whatever columns are asked for in the end.
    marks = F.transform(
        F.array(hashed(F.col("text"))),
        lambda h: F.struct(F.size(h).alias("doc_words"), F.transform("asked", lambda x: compared(h, x)).alias("marks")),
    )[0]
    marked = found.select("doc_id", marks.alias("m")).select("doc_id", "m.doc_words", "m.marks")
    judged_rows = marked.select("doc_id", "doc_words", F.inline(F.transform("marks", judged)))
    rows = judged_rows.filter(F.col("best_window") >= similarity)
    return rows.groupBy("doc_id", "item_id").agg(
        F.max("doc_words").cast("bigint").alias("doc_words"), F.max("n").cast("bigint").alias("item_words"),
        F.max("same_words").cast("bigint").alias("same_words"),
        F.round(F.max("best_window"), 6).alias("best_window"),
    )


def clean(
    docs: DataFrame, bench: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **options
) -> DataFrame:
    """The rows of ``docs`` that leak nothing, with all their columns. Every row is judged by its own text, so rows
    with a null or repeated id go only if they leak themselves."""

    def key(df: DataFrame) -> Column:
        return F.struct(df[id_col].alias("id"), F.xxhash64(df[text_col]).alias("a"), F.xxhash64(F.lit("second"), df[text_col]).alias("b"))

    keyed = docs.select(key(docs).alias("doc_id"), docs[text_col].alias("text"))
    bad = leaks(keyed, bench, **options).select(F.col("doc_id").alias("leaks")).distinct()
    # The caller's columns travel in one struct, so that none can clash with a helper.
    rows = docs.select(F.struct("*").alias("row"), key(docs).alias("key"))
    return rows.join(bad, F.col("key").eqNullSafe(F.col("leaks")), "left_anti").select("row.*")
