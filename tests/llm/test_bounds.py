"""Work and groups that must not grow out of hand: decontamination, licence postings."""

import time


from corpusloom.llm import decontaminate, license_scan

from . import brute


def test_texts_are_cut_once_however_many_places(spark):
    """A document of 10,000 words, an item of 200: the text must not be hashed per word of the item."""
    words = " ".join(f"w{k % 997}x{k % 13}" for k in range(10_000))
    item = " ".join(words.split()[500:700])
    docs = spark.createDataFrame([(k, f"{words} {k}") for k in range(20)], "doc_id bigint, text string").repartition(4)
    bench = spark.createDataFrame([(1, item)], "item_id bigint, text string")
    decontaminate.clean(docs, bench).count()
    began = time.time()
    found = decontaminate.leaks(docs, bench).count()
    middle = time.time()
    assert found == 20 and decontaminate.clean(docs, bench).count() == 0
    assert time.time() - middle < 2 * (middle - began) + 2


def test_a_phrase_of_many_items_in_one_long_document(spark):
    """Places are compared in parts of bounded size, whatever one document and one phrase bring together."""
    phrase = "one two three four"
    items = [(k, f"{phrase} a{k} b{k} c{k} d{k} e{k} f{k} g{k} h{k} i{k} j{k} k{k}") for k in range(1_000)]
    text = " ".join(f"{phrase} x{k}" for k in range(40)) + " " + items[77][1]
    docs = [(1, text), (2, "clean " * 30)]
    made = spark.createDataFrame(docs, "doc_id bigint, text string")
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    parts = decontaminate.leaks(made, bench, words_at_once=20_000)
    assert [(r.doc_id, r.item_id, r.best_window) for r in parts.collect()] == [(1, 77, 1.0)]
    assert parts.collect() == decontaminate.leaks(made, bench).collect()
    assert brute.leaks(docs, items[70:80]) == {(1, 77): 1.0}


def test_one_rare_word_alone_would_mislead(spark):
    texts = [
        "mit mit mit license general public works license of the public",
        "general public license of general the license public apache mit license",
        "permission to use copy modify and or distribute this software permission is hereby granted free of charge",
        "affero general public license affero public general license gnu lesser general public license",
        "the mozilla public mozilla public license", "license mit", "cc by sa 4 0 cc by nc cc by 4 0",
    ] + ["plain text without any"] * 20
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r.doc_id: r for r in license_scan.scan(rows).collect()}
    for k, text in enumerate(texts):
        base = (got[k].n_words, got[k].n_base, got[k].first_word, got[k].last_word, got[k].base_labels)
        assert base == brute.license_base(text) and got[k].labels == brute.labels_of(text, license_scan.TEMPLATES)


def test_postings_are_the_rarest_words_of_the_key(spark):
    idf = {"general": 2.0, "public": 1.0, "license": 3.0, "gnu": 9.0, "the": 0.1, "version": 1.0, "2": 1.0}
    t = license_scan.Template("x", "the gnu general public license version 2", "general public license version 2")
    assert license_scan.postings(t, idf) == ([("license", 4), ("general", 2), ("public", 3)], 2)
    plan = license_scan.scan(spark.createDataFrame([(1, "a")], "doc_id bigint, text string"))
    assert "array_intersect" in plan._jdf.queryExecution().optimizedPlan().toString()
