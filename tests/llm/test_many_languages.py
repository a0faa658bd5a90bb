"""Texts that mix more than three languages."""

import numpy as np

from corpusloom.llm import language_mix

LETTERS = ["abcde", "fghij", "klmno", "pqrst", "uvwxy"]


def words(k, n, seed):
    draw = np.random.default_rng(seed)
    return " ".join("".join(draw.choice(list(LETTERS[k]), 5)) for _ in range(n))


def test_shares_of_all_languages(spark):
    train = spark.createDataFrame([(f"l{k}", words(k, 400, k)) for k in range(5)], "lang string, text string")
    model = language_mix.learn(train)
    for m in range(1, 6):
        text = " ".join(words(k, 60, 10 + k) for k in range(m))
        docs = spark.createDataFrame([(1, text), (2, words(4, 30, 9)), (3, None)], "doc_id long, text string")
        row, alone, none = language_mix.identify(docs, model).orderBy("doc_id").collect()
        assert sorted(x.lang for x in row.languages) == [f"l{k}" for k in range(m)]
        assert all(abs(x.share - 1 / m) < 0.02 for x in row.languages) and abs(row.score - 1 / m) < 0.02
        assert [x.lang for x in alone.languages] == ["l4"] and none.languages == []
