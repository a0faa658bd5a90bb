"""Line-first cleaning: rules drop single lines, and a text that loses too much goes as a whole.

Everything is a narrow projection over one row: nothing is shuffled, however skewed the table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tables import blank_words

BLANKS = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
#: A line may hold at most one bar or other menu mark for so many words.
WORDS_PER_BAR = 8
#: Share of a line's words that may carry symbols, or end in doubled exclamation or question marks.
MARKED_SHARE = 0.3
#: Share of a line's words that may repeat the word before.
STUTTER_SHARE = 0.3
#: Share of the word characters that the kept lines must hold.
LEAST_KEPT = 0.5
# Fixed phrases of page furniture and legal notices, found anywhere in a lower-case line.
BOILERPLATE = (
    "all rights reserved", "licensed under", "released under the", "terms of use", "terms of service",
    "privacy policy", "cookie policy", "accept cookies", "click here", "sign up", "log in", "subscribe to",
    "skip to content", "enable javascript", "back to top", "share this", "read more",
)


def squeezed(text: Column) -> Column:
    """The text without ASCII white space."""
    return F.translate(text, BLANKS, "")


def counts(df: DataFrame, text_col: str = "text") -> DataFrame:
    """Add ``words``, ``n_words``, ``word_chars``, ``n_symbols``, ``n_dup_lines`` and ``n_repeat_words``.

    Windows of five words are compared by 64-bit hashes of their words.
    """
    lines = F.filter(F.split(text_col, "\n"), lambda x: squeezed(x) != "")
    base = df.withColumns({"words": blank_words(F.col(text_col)), "lines": lines}).withColumns({
        "n_words": F.size("words").cast("bigint"),
        "word_chars": F.length(squeezed(F.col(text_col))).cast("bigint"),
        "n_symbols": (F.length(text_col) - F.length(F.translate(text_col, SYMBOLS, ""))).cast("bigint"),
        "n_dup_lines": (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint"),
        "__w": F.transform("words", lambda w: F.xxhash64(w)),
    })
    starts = F.when(F.size("__w") >= 5, F.sequence(F.lit(0), F.size("__w") - 5)).otherwise(F.array().cast("array<int>"))
    windows = base.withColumn("__h", F.transform(starts, lambda i: F.xxhash64(*[F.get("__w", i + k) for k in range(5)])))
    # Only texts with a repeated window sort their windows.
    keyed = F.sort_array(F.transform("__h", lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
    nothing = F.array().cast("array<struct<h:bigint,i:int>>")
    ranked = windows.withColumn("__s", F.when(F.size(F.array_distinct("__h")) < F.size("__h"), keyed).otherwise(nothing))

    def twin(x: Column, k: Column) -> Column:
        same = [F.coalesce(F.get("__s", at)["h"] == x["h"], F.lit(False)) for at in (k - 1, k + 1)]
        return same[0] | same[1]

    twins = ranked.withColumn("__p", F.sort_array(F.transform(F.filter("__s", twin), lambda x: x["i"])))
    covered = F.transform("__p", lambda p, k: F.least(F.lit(5), F.coalesce(F.get("__p", k + 1) - p, F.lit(5))))
    total = F.aggregate(covered, F.lit(0).cast("bigint"), lambda a, x: a + x)
    return twins.withColumn("n_repeat_words", total).drop("lines", "__w", "__h", "__s", "__p")


def judged_lines(text: Column) -> Column:
    """The text's lines as an array of (``line``, ``bad``).

    Lines without a word are never bad. Navigation: menu bars between few words. Punctuation: words that carry runs
    of symbols, or doubled exclamation or question marks. Boilerplate: notices and page furniture. Stutter: one word
    over and over.
    """

    def parts(line: Column) -> Column:
        return F.struct(line.alias("line"), F.lower(line).alias("lower"), blank_words(line).alias("words"))

    def verdict(x: Column) -> Column:
        words, n = x["words"], F.size(x["words"])
        bars = F.length(x["line"]) - F.length(F.translate(x["line"], "|»›•·", ""))
        marked = F.regexp_count(x["line"], F.lit(r"[#*$%&<>=_~^]{2,}|[!?]{2,}"))
        stutter = F.size(F.filter(words, lambda w, k: F.coalesce(F.get(words, k - 1) == w, F.lit(False))))
        notice = F.lit(False)
        for phrase in BOILERPLATE:
            notice |= x["lower"].contains(phrase)
        wrong = (bars * WORDS_PER_BAR > n) | (marked > n * MARKED_SHARE) | (stutter > n * STUTTER_SHARE) | notice
        return F.struct(x["line"].alias("line"), ((n > 0) & wrong).alias("bad"))

    return F.transform(F.transform(F.split(text, "\n"), parts), verdict)


def clean_lines(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_kept: float = LEAST_KEPT
) -> DataFrame:
    """One row per row of ``df``: ``doc_id``, the base counts, ``base_failed``, ``n_lines``, ``n_bad_lines``,
    ``kept_chars`` (code points in words of the lines that stay), ``kept`` and ``clean_text``.

    Null or empty text: no words, fails the base rule, clean text empty. Rows that repeat are judged each for
    itself, a null id stays null, other columns are ignored, an empty table gives no rows. A text that keeps all
    its lines comes back unchanged.
    """
    rows = df.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    counted = counts(rows).drop("words")
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    good = F.transform(F.filter("__lines", lambda x: ~x["bad"]), lambda x: x["line"])
    cleaned = counted.withColumn("__lines", judged_lines(F.col("text"))).withColumns({
        "n_lines": F.size("__lines").cast("bigint"),
        "n_bad_lines": F.size(F.filter("__lines", lambda x: x["bad"])).cast("bigint"),
        "clean_text": F.array_join(good, "\n"),
        "base_failed": failed,
    })
    kept_chars = F.length(squeezed(F.col("clean_text"))).cast("bigint")
    return cleaned.withColumn("kept_chars", kept_chars).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & (F.col("kept_chars") >= least_kept * F.col("word_chars"))).alias("kept"),
        "n_lines", "n_bad_lines", "kept_chars", "clean_text",
    )
