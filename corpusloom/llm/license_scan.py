"""License scan by a positional index of rare licence words.

Licence notices are known as word sequences (templates) with a mandatory key phrase each. The index has, for every
template, the key phrase's ``RARE_WORDS`` words of highest IDF in the corpus with their places: its postings. In a file,
every place of such a word says where a template that lists it would start; the starts of a template's postings
are intersected, so only places where all its rare words stand at the right distances are left. There the key
phrase is verified, word by word, and the score is the IDF-weighted share of the template's words at their places.

A key phrase cannot occur without its rare words at their distances, so no place is missed. Two narrow passes over the
texts: one counts document frequencies of the licence words (a table as long as the word list), one scans. Texts never
move.
"""

from __future__ import annotations

import math
import re
from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tables import plain_words, texts


class Template(NamedTuple):
    label: str
    text: str
    key: str
    base: bool = False


# The base phrases with their labels.
BASE = (
    Template("mit", "mit license", "mit license", True),
    Template("apache", "apache license", "apache license", True),
    Template("gpl", "general public license", "general public license", True),
)
# Openings of well-known notices and the phrase each cannot do without.
NOTICES = (
    Template("mit-notice", "released under the mit license", "under the mit license"),
    Template("mit-text", "permission is hereby granted free of charge to any person obtaining a copy of this software "
             "and associated documentation files", "permission is hereby granted free of charge"),
    Template("apache-2.0", "licensed under the apache license version 2 0", "apache license version 2 0"),
    Template("gpl-notice", "this work is licensed under the gnu general public license version", "gnu general public license"),
    Template("gpl-2.0", "the gnu general public license version 2", "general public license version 2"),
    Template("gpl-3.0", "the gnu general public license version 3", "general public license version 3"),
    Template("lgpl", "the gnu lesser general public license", "lesser general public license"),
    Template("agpl", "the gnu affero general public license", "affero general public license"),
    Template("mpl-2.0", "subject to the terms of the mozilla public license v 2 0", "mozilla public license"),
    Template("bsd-text", "redistribution and use in source and binary forms with or without modification are permitted "
             "provided that the following conditions are met", "redistribution and use in source and binary forms"),
    Template("isc-text", "permission to use copy modify and or distribute this software for any purpose with or without "
             "fee is hereby granted", "permission to use copy modify and or distribute this software"),
    Template("cc-by", "licensed under cc by 4 0", "cc by 4 0"),
    Template("cc-by-sa", "licensed under cc by sa 4 0", "cc by sa"),
    Template("cc-by-nc", "licensed under cc by nc 4 0", "cc by nc"),
    Template("creative-commons", "licensed under a creative commons attribution license", "creative commons attribution"),
    Template("all-rights-reserved", "all rights reserved", "all rights reserved"),
)
TEMPLATES = BASE + NOTICES
#: Words of a key phrase that are looked up and intersected.
RARE_WORDS = 3


def document_frequencies(words: DataFrame, vocabulary: Sequence[str]) -> tuple[int, dict[str, int]]:
    """Rows, and rows that hold each word; counts are summed per task before they move."""
    found = words.select(F.array_distinct(F.filter("words", lambda w: w.isin(*vocabulary))).alias("found"))
    # The empty word stands for the row itself, so one pass counts both.
    each = found.select(F.explode(F.concat(F.array(F.lit("")), "found")).alias("word"))
    counts = {r["word"]: r["n"] for r in each.groupBy("word").agg(F.count("*").alias("n")).collect()}
    return counts.pop("", 0), counts


def rarity(rows: int, counts: Mapping[str, int], vocabulary: Sequence[str]) -> dict[str, float]:
    """Smoothed inverse document frequency, rounded so that sums do not depend on the order of addition."""
    return {w: round(math.log((rows + 1) / (counts.get(w, 0) + 1)) + 1, 6) for w in vocabulary}


def postings(template: Template, idf: Mapping[str, float], most: int = RARE_WORDS) -> tuple[list[tuple[str, int]], int]:
    """The key phrase's rarest words (of equals the first), each with its first place in the template, and the key
    phrase's place."""
    words, key = template.text.split(), template.key.split()
    at = next(i for i in range(len(words)) if words[i : i + len(key)] == key)
    rarest = sorted(dict.fromkeys(key), key=lambda w: (-idf[w], key.index(w)))[:most]
    return [(w, at + key.index(w)) for w in rarest], at


def scan(
    df: DataFrame, templates: Sequence[Template] = TEMPLATES, *, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per row of ``df``: ``doc_id``, ``n_words``, ``n_base``, ``first_word``, ``last_word``, ``base_labels``,
    ``labels``, ``score`` and ``matches``, an array of (``start``, ``label``, ``base``, ``score``) in order.

    Null or empty text: no words, no matches, null places, empty labels, score 0. The score of a row is its best
    match's. Rows that repeat are scanned each for itself, null ids stay null, other columns are ignored, an
    empty table gives no rows.
    """
    words = texts(df, id_col, text_col).select("doc_id", plain_words(F.col("text")).alias("words"))
    vocabulary = sorted({w for t in templates for w in t.text.split()})
    idf = rarity(*document_frequencies(words, vocabulary), vocabulary)
    index = [(t, *postings(t, idf)) for t in templates]
    rare = sorted({word for _, listed, _ in index for word, _ in listed})

    places = F.filter(
        F.when(F.size("words") > 0, F.sequence(F.lit(0), F.size("words") - 1)).otherwise(F.array().cast("array<int>")),
        lambda i: F.get("words", i).isin(*rare),
    )
    placed = words.withColumn("places", places)

    def matches_of(t: Template, listed: Sequence[tuple[str, int]], key_at: int) -> Column:
        key = t.key.split()

        def starts_by(word: str, at: int) -> Column:
            return F.transform(F.filter("places", lambda i: F.get("words", i) == word), lambda i: i - at)

        starts = starts_by(*listed[0])
        for posting in listed[1:]:
            starts = F.array_intersect(starts, starts_by(*posting))

        def verified(start: Column) -> Column:
            return _all([F.coalesce(F.get("words", start + key_at + j) == w, F.lit(False)) for j, w in enumerate(key)])

        def match(start: Column) -> Column:
            sum_, whole = F.lit(0.0), 0.0
            for j, w in enumerate(t.text.split()):
                sum_ += F.when(F.coalesce(F.get("words", start + j) == w, F.lit(False)), idf[w]).otherwise(0.0)
                whole += idf[w]
            share = F.round(F.least(sum_ / whole, F.lit(1.0)), 6)
            first = start + (key_at if not t.base else 0)
            return F.struct(
                first.cast("bigint").alias("start"), F.lit(t.label).alias("label"), F.lit(t.base).alias("base"),
                share.alias("score"),
            )

        return F.transform(F.filter(starts, verified), match)

    kind = "array<struct<start:bigint,label:string,base:boolean,score:double>>"
    all_ = F.sort_array(F.concat(*[matches_of(*p) for p in index]))
    found = placed.withColumn("matches", F.when(F.size("places") > 0, all_).otherwise(F.array().cast(kind)))
    base = found.withColumn("base", F.filter("matches", lambda m: m["base"]))
    return base.select(
        "doc_id", F.size("words").cast("bigint").alias("n_words"), F.size("base").cast("bigint").alias("n_base"),
        F.array_min(F.transform("base", lambda m: m["start"])).alias("first_word"),
        F.array_max(F.transform("base", lambda m: m["start"])).alias("last_word"),
        _joined("base").alias("base_labels"), _joined("matches").alias("labels"),
        F.coalesce(F.array_max(F.transform("matches", lambda m: m["score"])), F.lit(0.0)).alias("score"), "matches",
    )


def _all(conditions: Sequence[Column]) -> Column:
    out = conditions[0]
    for c in conditions[1:]:
        out &= c
    return out


def _joined(column: str) -> Column:
    return F.array_join(F.array_sort(F.array_distinct(F.transform(column, lambda m: m["label"]))), ",")


def plain_word_list(text: str | None) -> list[str]:
    """The words of one text, for tests and tools."""
    lower = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)
