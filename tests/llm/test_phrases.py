"""Collocations against a plain restatement: random texts, ties, nulls, odd white space, block borders."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from corpusloom.llm import phrases
from corpusloom.llm.queries import QUERIES

SMALL = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
LAYOUT = "doc_id bigint, text string, lang string, phrase string, a int, words string"


def brute(rows, least=100, best=2_000, longest=5):
    f, n, out = defaultdict(Counter), Counter(), []
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(SMALL)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for m in range(1, longest + 1):
                f[lang].update(tuple(words[i : i + m]) for i in range(len(words) - m + 1))
    for lang, counts in f.items():
        found = {p: a for p, a in counts.items() if a >= least and len(p) > 1}
        inside = {
            p[i : i + m] for p, a in found.items() for m in range(2, len(p)) for i in range(len(p) - m + 1)
            if 100 * a >= 100 * counts[p[i : i + m]]
        }
        scored = []
        for p, a in found.items():
            if p not in inside:
                score, k = min((1000 * a * n[lang] // (counts[p[:k]] * counts[p[k:]]), k) for k in range(1, len(p)))
                scored.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(scored)[:best], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


def mined(spark, rows, **more):
    docs = spark.createDataFrame([(k, t, lang, "x", 1, "y") for k, (lang, t) in enumerate(rows)], LAYOUT).repartition(3)
    return sorted(map(tuple, phrases.collocations(docs, **more).collect()))


def test_query_against_brute_force(spark):
    folder = "/root/testdata/sf0.01"
    rows = [(r.lang, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    got = sorted(map(tuple, QUERIES["op13_count_streams"](spark, folder).collect()))
    assert got and got == brute(rows)


def test_random_texts_ties_and_nulls(spark):
    draw = random.Random(4)
    words = ["a", "B", "b", "É", "é", "x\x01", "漢字", "of", "the", " ", "\x00", "the of"]
    gaps = [" ", " ", " ", "  ", "\t", " \t ", ". ", "\n", "\r\n", ",", "!", "\x0b"]
    text = lambda: "".join(draw.choice(words) + draw.choice(gaps) for _ in range(draw.randint(0, 60)))
    rows = [(draw.choice([None, "und", "en", "de"]), draw.choice([None, "", " .\n ", *[text() for _ in range(9)]])) for _ in range(250)]
    for least in (1, 2, 5):
        assert mined(spark, rows, min_count=least) == brute(rows, least)
    assert mined(spark, rows, min_count=2, per_lang=7) == brute(rows, 2, 7)
    assert mined(spark, rows, min_count=2, longest=3) == brute(rows, 2, longest=3)


def test_repeated_rows_and_one_very_long_text(spark, monkeypatch):
    draw = random.Random(8)
    long = "".join(draw.choice(["one", "two", "three", "four"]) + draw.choice([" ", " ", " ", ". "]) for _ in range(60_000))
    rows = [("en", long)] + [("en", "New York is New York.")] * 150 + [(None, "alone")]
    assert mined(spark, rows) == brute(rows)
    monkeypatch.setattr(phrases, "BLOCK", 500)
    batch = pa.RecordBatch.from_arrays([["en"] * 2, [long, "x " * 2_000]], names=["lang", "text"])
    blocks = list(phrases._blocks(batch))
    assert len(blocks) > 100
    count = lambda t: len([w for w in re.split(rb"[ \n]+", t) if w])
    assert sum(count(b) for _, b in blocks) == 62_000


def test_a_full_bit_table_changes_nothing(spark, monkeypatch):
    # Every bit set: all windows are counted by their words.
    rows = [("en", "a b c d e f g a b c d e f g. a b c")] * 3
    monkeypatch.setattr(phrases, "_held", lambda table, h: h == h)
    want = brute(rows, 3)
    docs = spark.createDataFrame(rows, "lang string, text string")
    everything = np.full((1 << phrases.TABLE_BITS) // 8, 255, np.uint8)
    monkeypatch.setattr(phrases, "_table_of", lambda places: everything)
    assert sorted(map(tuple, phrases.collocations(docs, min_count=3).collect())) == want


def test_nothing(spark):
    for rows in ([], [(None, None)], [("en", ""), ("en", " .,\n")], [("en", "once only")]):
        assert mined(spark, rows) == []


@pytest.mark.parametrize("share", [50, 80])
def test_shorter_phrases_go_by_share(spark, share):
    rows = [("en", "big red dog")] * 8 + [("en", "big red")] * 2 + [("en", "red dog")] * 9
    got = {r[2] for r in mined(spark, rows, min_count=2, share=share)}
    want = {"big red dog"} | ({"red dog"} if 8 * 100 < share * 17 else set())
    assert got == want
