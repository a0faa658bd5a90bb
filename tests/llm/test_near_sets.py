"""Near-dedup of the pipeline against brute-force Jaccard over all pairs, and rows with null or repeated ids."""

import random
from itertools import combinations

import pytest

import corpus_pipeline as pipeline
from corpusloom.llm import near_sets

from . import brute


def shingles(text, size=5):
    words = brute.blank_words(brute.low(text))
    return {tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))} if words else set()


def groups(docs):
    sets, root = [shingles(t) for _, t in docs], list(range(len(docs)))
    for i, j in combinations(range(len(docs)), 2):
        both = len(sets[i] & sets[j])
        if sets[i] == sets[j] or both and 9 * both >= 4 * (len(sets[i]) + len(sets[j])):
            a, b = root[i], root[j]
            root = [min(a, b) if r in (a, b) else r for r in root]
    return root


@pytest.mark.parametrize("scale", ["sf0.001", "sf0.01"])
def test_stage_keeps_one_of_every_jaccard_group(spark, scale):
    rows = spark.read.parquet(f"/root/testdata/{scale}/documents.parquet")
    docs = sorted((r.doc_id, r.text) for r in rows.collect())
    root = groups(docs)
    got = sorted(r.doc_id for r in pipeline.dedup_near(spark, rows, f"/root/testdata/{scale}").collect())
    assert got == [d for k, (d, _) in enumerate(docs) if root[k] == k]


@pytest.mark.parametrize("stars", [0, 3])
def test_groups_of_edited_copies(spark, monkeypatch, stars):
    monkeypatch.setattr(near_sets, "STARS", stars)
    monkeypatch.setattr(near_sets, "FEW", 0)
    monkeypatch.setattr(near_sets, "SAMPLE", 1)
    draw = random.Random(3)
    passage = [f"p{k}" for k in range(30)]
    docs = []
    for c in range(6):
        base = [f"w{draw.randint(0, 5000)}" for _ in range(draw.choice([8, 40, 90, 150]))] + passage
        for _ in range(15):
            text = [w if draw.random() > 0.025 else f"x{draw.randint(0, 99)}" for w in base]
            docs.append((len(docs), " ".join(text)))
    docs += [(900, ""), (901, None), (902, "a"), (903, "A "), (904, "a b c"), (905, "a b c d")]
    df = spark.createDataFrame(docs, "row long, text string").repartition(5)
    got = {r.row: r.root for r in near_sets.near_rows(df).collect()}
    want, names = groups(docs), {}
    assert len(set(want)) > 10
    for k, (d, _) in enumerate(docs):
        assert names.setdefault(want[k], got[d]) == got[d]
    assert len(set(names.values())) == len(names)


def test_rows_without_or_with_repeated_ids_are_decided_each(spark):
    texts = [" ".join(f"{c}{k}" for k in range(40)) for c in "abcd"]
    data = [(None, texts[0]), (None, texts[0]), (None, texts[1]), (5, texts[1]), (6, texts[2]), (6, texts[2]),
            (6, texts[3]), (7, texts[2])]
    df = spark.createDataFrame(data, "doc_id long, text string")
    got = sorted(((r.doc_id, r.text) for r in near_sets.keep_one(df).collect()), key=repr)
    assert got == sorted([(None, texts[0]), (5, texts[1]), (6, texts[2]), (6, texts[3])], key=repr)
    assert near_sets.keep_one(df.limit(0)).count() == 0


def test_simhash_ball_joins_close_copies_before_members_are_shared(spark, monkeypatch):
    draw = random.Random(9)
    base = [f"w{draw.randint(0, 10**6)}" for _ in range(600)]
    close = [*base[:300], "other", *base[301:]]
    docs = [(1, " ".join(base)), (2, " ".join(close)), (3, " ".join(f"v{k}" for k in range(600)))]
    df = spark.createDataFrame(docs, "row long, text string")
    monkeypatch.setattr(near_sets, "_shared", lambda tokens: tokens.limit(0))  # leaves the ball alone
    got = {r.row: r.root for r in near_sets.near_rows(df).collect()}
    assert got[1] == got[2] != got[3]
