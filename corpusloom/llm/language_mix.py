"""Language identification of texts that may mix languages.

Learning counts byte trigrams per language over all labelled documents; counts are summed inside each task before
they move, and the model has one line per hash bin whatever the corpus. A word's likelihood under a language is
the product over the trigrams around its letters. Expectation-maximisation then estimates the share of each
language among a document's words; nested sets of its likeliest languages, up to all of them, are compared by
likelihood less a penalty per language, and the prediction is the largest share of the best set.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BINS = 1 << 15
#: Added to every count, so that no trigram rules a language out.
SMOOTHING = 0.5
ROUNDS = 6
#: Languages a model may have; more are an error, not a cut.
MODEL_LIMIT = 1000
UNKNOWN = "und"
_AT_ONCE = 4_000_000

_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True
_ASCII_LETTER = _LETTER & (np.arange(256) < 128)
_SMALL = np.where(_LETTER, np.arange(256), 32).astype("u4")
_ANY_LETTER = re.compile(r"[^\W\d_]")


def _trigrams(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of letter bytes and the bin of the trigram around each. ``raw`` begins and ends with a separator."""
    small = _SMALL[raw]
    at = np.flatnonzero(_LETTER[raw])
    gram = small[at - 1] << 16 | small[at] << 8 | small[at + 1]
    return at, (gram * np.uint32(2654435761)) >> np.uint32(32 - BINS.bit_length() + 1)


def _pieces(raw: bytes, size: int) -> Iterator[tuple[int, int]]:
    """Bounds of pieces of about ``size`` bytes that cut no word, except words longer than that."""
    begin = 0
    while begin < len(raw):
        end = min(len(raw), begin + size)
        if end < len(raw):
            cut = max(raw.rfind(b" ", begin, end), raw.rfind(b"\n", begin, end))
            end = cut + 1 if cut > begin else end
        yield begin, end
        begin = end


def _lowered(texts: Sequence[str | None]) -> list[bytes]:
    return [(t or "").lower().encode("utf-8", "surrogatepass") for t in texts]


def count_trigrams(df: DataFrame, lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """``lang``, ``bin``, ``n`` over all rows with a language."""
    rows = df.select(F.col(lang_col).alias("lang"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            langs = batch.column(0).to_pylist()
            texts = _lowered(batch.column(1).to_pylist())
            for lang in set(langs):
                raw = b"\n".join(t for t, own in zip(texts, langs) if own == lang)
                total = sums.setdefault(lang, np.zeros(BINS, "i8"))
                for a, b in _pieces(raw, _AT_ONCE):
                    total += np.bincount(_trigrams(np.frombuffer(b"\n" + raw[a:b] + b"\n", "u1"))[1], minlength=BINS)
        for lang, total in sums.items():
            bins = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(bins), pa.string()), pa.array(bins.astype("i4")), pa.array(total[bins])],
                ["lang", "bin", "n"],
            )

    parts = rows.filter("lang is not null").mapInArrow(counted, "lang string, bin int, n bigint")
    return parts.groupBy("lang", "bin").agg(F.sum("n").alias("n"))


@dataclass
class Model:
    languages: list[str]
    log_p: np.ndarray  # bin, language


def learn(df: DataFrame, lang_col: str = "lang", text_col: str = "text") -> Model:
    """Model of all rows with a language; what reaches the driver is at most ``BINS`` counts a language."""
    counts = count_trigrams(df, lang_col, text_col)
    rows = counts.groupBy("lang").agg(F.collect_list(F.struct("bin", "n")).alias("counts"))
    languages, columns = [], []
    for row in rows.orderBy("lang").toLocalIterator():
        if len(languages) == MODEL_LIMIT:
            raise ValueError(f"more than {MODEL_LIMIT} languages")
        total = np.full(BINS, SMOOTHING)
        for bin_, n in row["counts"]:
            total[bin_] += n
        languages.append(row["lang"])
        columns.append(np.log(total / total.sum()).astype("f4"))
    return Model(languages, np.stack(columns, 1) if columns else np.zeros((BINS, 0), "f4"))


def _word_likelihoods(raw: bytes, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """Where words start, and their log-likelihoods by language."""
    starts, found = [], []
    k = max(1, len(model.languages))
    for a, b in _pieces(raw, max(1 << 16, _AT_ONCE // k)):
        at, bins = _trigrams(np.frombuffer(b"\n" + raw[a:b] + b"\n", "u1"))
        if len(at):
            first = np.concatenate([[0], np.flatnonzero(np.diff(at) > 1) + 1])
            starts.append(at[first] - 1 + a)
            found.append(np.add.reduceat(model.log_p[bins], first, axis=0))
    return (np.concatenate(starts), np.concatenate(found)) if starts else (np.zeros(0, "i8"), np.zeros((0, k), "f4"))


def _shares(likely: np.ndarray, owner: np.ndarray, first: np.ndarray, n: np.ndarray, share: np.ndarray, rounds: int):
    """Expectation-maximisation from ``share`` (document, language); also the words' summed log-likelihood."""
    for _ in range(rounds):
        weight = likely * share[owner]
        weight /= weight.sum(1, keepdims=True)
        share = np.add.reduceat(weight, first, axis=0) / n[:, None]
    fit = np.log(np.maximum((likely * share[owner]).sum(1), 1e-30))
    return share, np.add.reduceat(fit, first)


def mixtures(texts: Sequence[str | None], model: Model) -> tuple[np.ndarray, np.ndarray]:
    """For each text the shares of all languages (0 outside its set) and whether it has a letter."""
    raws = _lowered(texts)
    raw = b"\n".join(raws)
    begins = np.concatenate([[0], np.cumsum([len(r) + 1 for r in raws])])[:-1]
    share = np.zeros((len(raws), len(model.languages)))
    plain = np.concatenate([[0], np.cumsum(_ASCII_LETTER[np.frombuffer(raw + b"\n", "u1")])])
    ends = np.minimum(begins + [len(r) for r in raws], len(raw))
    lettered = plain[ends] > plain[begins]
    for i in np.flatnonzero(~lettered):
        lettered[i] = bool(_ANY_LETTER.search(texts[i] or ""))
    starts, found = _word_likelihoods(raw, model)
    if not len(starts) or not model.languages:
        return share, lettered
    document = np.searchsorted(begins, starts, "right") - 1
    first = np.concatenate([[0], np.flatnonzero(np.diff(document)) + 1])
    rows = document[first]
    n = np.diff(np.concatenate([first, [len(starts)]]))
    owner = np.repeat(np.arange(len(rows)), n)
    top = found.max(1, keepdims=True)
    likely = np.exp(np.maximum(found - top, -60)).astype("f4")
    k = len(model.languages)
    full, _ = _shares(likely, owner, first, n, np.full((len(rows), k), 1 / k, "f4"), ROUNDS)
    order = np.argsort(-full, axis=1, kind="stable")
    # No set is likelier than this: by concavity, no mixture gains more than n log(largest mean ratio) on a given one.
    mixed = np.maximum((likely * full[owner]).sum(1, dtype="f8"), 1e-30)
    ratio = np.add.reduceat(likely / mixed[:, None], first, axis=0).max(1) / n
    bound = np.add.reduceat(np.log(mixed), first) + n * np.log(np.maximum(ratio, 1)) + 1e-4 * n + 0.01
    penalty = 0.5 * np.log(n + 1.0)
    best, best_fit, open_ = np.zeros_like(full), np.full(len(rows), -np.inf), np.arange(len(rows))
    for m in range(1, k + 1):
        # A document is done once no larger set can reach its best one.
        open_ = open_[bound[open_] - (m - 1) * penalty[open_] > best_fit[open_]] if m > 1 else open_
        if not len(open_):
            break
        some, own = n[open_], np.repeat(np.arange(len(open_)), n[open_])
        begin = np.cumsum(some) - some
        words = np.arange(len(own)) + (first[open_] - begin)[own]
        languages = order[open_, :m]
        start = np.maximum(np.take_along_axis(full[open_], languages, 1), 1e-6)
        start /= start.sum(1, keepdims=True)
        shares, fit = _shares(
            np.take_along_axis(likely[words], languages[own], 1), own, begin, some, start, 0 if m == 1 else ROUNDS // 2
        )
        fit = fit - (m - 1) * penalty[open_]
        better = fit > best_fit[open_]
        best_fit[open_[better]] = fit[better]
        chosen = np.zeros_like(best[open_[better]])
        np.put_along_axis(chosen, languages[better], shares[better], 1)
        best[open_[better]] = chosen
    share[rows] = best
    return share, lettered


def identify(df: DataFrame, model: Model, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``df``: ``doc_id``, ``lang_pred``, ``score`` (that language's share of the words) and
    ``languages``, the selected set as an array of (``lang``, ``share``), largest first.

    Null text, a text without a letter, or a model without languages: ``und``, score 0, no languages. Equal shares
    go to the first language by name. Repeated rows are judged each for itself, null ids stay null, other
    columns are ignored, an empty table gives no rows.
    """
    rows = df.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    sent = df.sparkSession.sparkContext.broadcast(model)

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from .token_codes import small_runs

        known = sent.value
        for batch in batches:
            ids = batch.column(0)
            for a, texts in small_runs(batch.column(1)):
                share, lettered = mixtures(texts.to_pylist(), known)
                lettered &= share.sum(1) > 0
                names, scores, sets = [], [], []
                for row, ok in zip(share, lettered):
                    chosen = [i for i in np.argsort(-row, kind="stable") if row[i] > 0] if ok else []
                    names.append(known.languages[chosen[0]] if chosen else UNKNOWN)
                    scores.append(min(1.0, float(row[chosen[0]])) if chosen else 0.0)
                    sets.append([{"lang": known.languages[i], "share": float(row[i])} for i in chosen])
                kind = pa.list_(pa.struct([("lang", pa.string()), ("share", pa.float64())]))
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(a, len(texts)), pa.array(names, pa.string()), pa.array(scores, pa.float64()), pa.array(sets, kind)],
                    ["doc_id", "lang_pred", "score", "languages"],
                )

    return rows.mapInArrow(
        judged, "doc_id bigint, lang_pred string, score double, languages array<struct<lang:string,share:double>>"
    )


def known(df: DataFrame, model: Model, *, text_col: str = "text") -> DataFrame:
    """The rows of ``df`` that ``identify`` gives a language, all columns kept. Every row is judged by its own text,
    whatever its id; rows do not move."""
    place = df.columns.index(text_col)
    sent = df.sparkSession.sparkContext.broadcast(model)

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from .token_codes import small_runs

        for batch in batches:
            for a, texts in small_runs(batch.column(place)):
                share, lettered = mixtures(texts.to_pylist(), sent.value)
                yield batch.slice(a, len(texts)).filter(pa.array(lettered & (share.sum(1) > 0)))

    return df.mapInArrow(judged, df.schema)
