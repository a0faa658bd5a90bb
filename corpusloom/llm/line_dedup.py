"""Line dedup: repeated runs of lines found by prefix doubling over line ids, later copies deleted.

The corpus is read as sequences of line ids. A run of consecutive lines counts once it holds ``MIN_WORDS`` words; a
line is deleted if it lies in a run whose exact lines stand somewhere earlier (by document id, then place).

Lines that occur once are in no repeated run and drop out at once. What is left gets suffix ranks by prefix
doubling: round k sorts the pairs (rank at p, rank 2^(k-1) lines on) and numbers them in order, so ranks
order the suffixes by their first 2^k lines and are equal only for equal lines. Pairs are counted before they are
sorted, so a line that fills a third of the corpus is one row of the sort. For every place the shortest run with
enough words is known beforehand, which bounds the rounds by log2(MIN_WORDS). The suffixes that agree over that run form
an interval of the suffix array (their longest common prefix is at least as long); its first place in corpus
order stays, the run is deleted at the others. Overlapping runs add up, but for short lines at the end of a repeated
run: a line with fewer than ``MIN_WORDS`` words from it to the run's end begins no such run. With ``whole_runs`` the
shortest runs are also followed backwards from every line, and both together are exactly the maximal repeated runs:
what has too few words on either side within a run lies in the shortest run from that run's first line.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import stage
from .tables import BLANK, texts

MIN_WORDS = 50
_DOC = ["doc_id", "twin"]


def _word_lines(df: DataFrame) -> DataFrame:
    """Lines with a word: document, ``pos`` among them, ``line_no`` among all, two hashes, number of words."""
    lines = F.transform(F.split("text", "\n"), lambda x, i: F.struct(i.alias("line_no"), x.alias("line")))
    worded = F.filter(lines, lambda x: F.translate(x["line"], " \t\n\x0b\x0c\r", "") != "")
    each = df.select("doc_id", F.xxhash64("text").alias("twin"), F.posexplode(worded).alias("pos", "x"))
    line = F.col("x.line")
    # Line ids are 128 bits wide: at a trillion lines 64 would collide.
    rows = each.select(
        *_DOC, "pos", "x.line_no", F.xxhash64(line).alias("a"), F.xxhash64(F.lit("second"), line).alias("b"),
        F.size(F.filter(F.split(line, BLANK), lambda w: w != "")).alias("words"),
    )
    return rows.dropDuplicates([*_DOC, "pos"])


def _numbered(pairs: DataFrame, left: str, right: str) -> DataFrame:
    """Pairs that occur at least twice, numbered in sorted order; numbers rise across range partitions."""
    often = pairs.groupBy(left, right).agg(F.count("*").alias("n")).filter("n > 1").drop("n")
    ordered = often.repartitionByRange(left, right).sortWithinPartitions(left, right)
    return stage(ordered.withColumn("rank", F.monotonically_increasing_id()))


def _ranked_lines(df: DataFrame) -> DataFrame:
    """Lines that occur at least twice, each with its ``rank``."""
    lines = stage(_word_lines(df))
    named = _numbered(lines.select("a", "b"), "a", "b")
    return lines.join(named, ["a", "b"]).drop("a", "b")


def suffix_intervals(df: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """For ``doc_id``/``text`` rows: every place from which a run of at least ``min_words`` words is made of repeated
    lines, as ``doc_id``, ``twin``, ``pos``, ``line_no``, and of the shortest such run ``lines``, ``end_line`` and its
    ranks ``left`` and ``right``. Places with equal (``lines``, ``left``, ``right``) form one interval of the suffix array."""
    return _intervals(_ranked_lines(df), min_words)


def _intervals(repeated: DataFrame, min_words: int) -> DataFrame:
    in_doc = Window.partitionBy(*_DOC).orderBy("pos")
    stretches = repeated.withColumns({
        "stretch": F.col("pos") - F.row_number().over(in_doc),
        "start": F.sum("words").over(in_doc) - F.col("words"),
    })
    along = Window.partitionBy(*_DOC, "stretch").orderBy("start")
    reach = along.rangeBetween(Window.currentRow, min_words - 1)
    last = F.last(F.struct("pos", "line_no", "start", "words")).over(reach)
    enough = F.col("last.start") + F.col("last.words") - F.col("start") >= min_words
    runs = stretches.withColumn("last", last).withColumns({
        "lines": F.when(enough, F.col("last.pos") - F.col("pos") + 1), "end_line": F.col("last.line_no"),
    })
    whole = Window.partitionBy(*_DOC, "stretch")
    state = runs.withColumn("longest", F.max("lines").over(whole)).filter("longest is not null").select(
        *_DOC, "stretch", "pos", "line_no", "end_line", "lines", "longest", "rank"
    )
    done, k = [], 0
    while True:
        state = stage(state)
        # 2^k <= lines < 2^(k+1): the run is two overlapping pieces of 2^k lines.
        half = 1 << k
        ahead = Window.partitionBy(*_DOC, "stretch").orderBy("pos").rowsBetween(Window.currentRow, half - 1)
        pieces = F.collect_list(F.struct("rank")).over(ahead)
        ends = state.withColumn("right", F.get(pieces, F.col("lines") - half)["rank"]).filter(
            (F.col("lines") >= half) & (F.col("lines") < 2 * half)
        )
        done.append(ends.filter("rank is not null and right is not null").select(
            *_DOC, "pos", "line_no", "end_line", "lines", F.col("rank").alias("left"), "right"
        ))
        k += 1
        rest = state.filter(F.col("longest") >= 2 * half)
        if rest.isEmpty():
            break
        next_ = F.lead("rank", half).over(Window.partitionBy(*_DOC, "stretch").orderBy("pos"))
        pairs = stage(rest.withColumn("there", next_).withColumnRenamed("rank", "here"))
        named = _numbered(pairs.filter("here is not null and there is not null"), "here", "there")
        state = pairs.join(named, ["here", "there"], "left").drop("here", "there")
    out = done[0]
    for more in done[1:]:
        out = out.union(more)
    return out


def _later(runs: DataFrame) -> DataFrame:
    """The runs whose lines stand somewhere earlier."""
    interval, place = ["lines", "left", "right"], F.struct(*_DOC, "pos")
    firsts = runs.groupBy(*interval).agg(F.min(place).alias("first"), F.count("*").alias("n")).filter("n > 1").drop("n")
    return runs.join(firsts, interval).filter(~place.eqNullSafe(F.col("first")))


def repeated_lines(df: DataFrame, min_words: int = MIN_WORDS, whole_runs: bool = False) -> DataFrame:
    """``doc_id``, ``twin`` and ``removed``, the sorted numbers of the lines to delete; documents without are absent."""
    if whole_runs:
        lines = stage(_ranked_lines(df))
        # Places are told apart and ordered as before; only the way along a document is turned round.
        back = _intervals(lines.withColumn("pos", -F.col("pos")), min_words).withColumn("pos", -F.col("pos"))
        later = _later(_intervals(lines, min_words)).unionByName(_later(back))
    else:
        later = _later(suffix_intervals(df, min_words))
    covered = later.select(*_DOC, F.explode(F.sequence("line_no", "end_line")).alias("line_no"))
    return covered.groupBy(*_DOC).agg(F.sort_array(F.collect_set("line_no")).alias("removed"))


def deduplicate(
    df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS, whole_runs: bool = False
) -> DataFrame:
    """``df`` with all its columns, the text without its repeated lines, and ``removed_lines`` (an array, empty if none).

    Lines are what line feeds separate. A line without a word goes only inside a deleted run. Null text stays null.
    Rows that agree in id and text are one document: none is a copy of the other. Ties between different texts of
    one id are broken by a hash of the text; null ids come first. An empty table gives no rows. Other columns pass
    through; columns named like the helpers do not clash. ``whole_runs``: every line of a repeated run goes, also short
    ones at its end.
    """
    removed = stage(repeated_lines(texts(df, id_col, text_col), min_words, whole_runs))
    marks = removed.hint("merge")  # the marks grow with the texts: one plan at every size
    # The caller's columns travel in one struct, so that none can clash with a helper.
    given = F.col("given")
    rows = df.select(F.struct("*").alias("given")).withColumn("of", F.xxhash64(F.coalesce(given[text_col], F.lit(""))))
    joined = rows.join(marks, given[id_col].eqNullSafe(F.col("doc_id")) & (F.col("of") == F.col("twin")), "left")
    gone = F.coalesce("removed", F.array().cast("array<int>"))
    kept = F.filter(F.split(given[text_col], "\n"), lambda x, i: ~F.array_contains(gone, i))
    text = F.when(F.size(gone) == 0, given[text_col]).otherwise(F.array_join(kept, "\n"))
    columns = [(text if c == text_col else given[c]).alias(c) for c in df.columns if c != "removed_lines"]
    return joined.select(*columns, gone.alias("removed_lines"))
