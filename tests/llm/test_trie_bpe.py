"""Encoding over the trie against the vocabulary's own library: fixed and random texts, odd characters, odd rows."""

import hashlib
import random

import pytest
from tokenizers import Tokenizer

from corpusloom.llm import trie_bpe
from corpusloom.llm.queries import QUERIES, vocabulary

PATH = vocabulary("word_bpe_49k.json")
ODD = [
    "a", "b", "e", "th", "s", "n", "1", "2", "'", "'s", "'ll", "!", ".", " ", "  ", "\n", "\x1c", "\x85", " ", " ", "É", "é",
    "́", "ß", "Σ", "ς", "İ", "漢", "ก", "\U0001f600", "<|endoftext|>", "<|startoftext|>", "<|", "​", "﻿",
    "ﬁ", "Ǆ", "the", "ing", "tion", "aaaa", "----", "\x00", "᠎", "ͅ", "</w>", "w>", "क्",
]


@pytest.fixture(scope="module")
def library():
    model = Tokenizer.from_file(PATH)
    model.no_padding()
    model.no_truncation()
    return model


@pytest.fixture(scope="module")
def encoder():
    return trie_bpe.TrieEncoder(PATH)


def ids_of(encoder, text):
    return [int(i) for part in encoder.parts(text) for found in part for i in found[1].split()]


def random_texts():
    draw = random.Random(11)
    odd = ["".join(draw.choice(ODD) for _ in range(draw.randint(0, 60))) for _ in range(4_000)]
    long = ["".join(draw.choice("abcdefghijklmnopqrstuvwxyzeettaa") for _ in range(draw.randint(1, 200))) for _ in range(2_000)]
    runs = [c * k for c in ("a", "-", "=", "é", "漢") for k in (*range(1, 40), 63, 64, 65, 66, 300)]
    return [*odd, *long, *runs, "x" * 20_000, "ab1" * 9_000]


def test_ids_and_decoding_as_the_library(encoder, library):
    for text, code in zip(cases := random_texts(), library.encode_batch(cases, add_special_tokens=False)):
        got = ids_of(encoder, text)
        assert got == code.ids, repr(text)
        assert trie_bpe.decode(got, encoder.merges.text) == library.decode(code.ids, skip_special_tokens=False)


def test_every_character_below_the_first_that_composes(encoder, library):
    for c in map(chr, range(0x300)):
        for text in (c, f"a{c}", f"{c}b", f"A{c}'s1{c}{c}", f"x {c} y"):
            assert ids_of(encoder, text) == library.encode(text, add_special_tokens=False).ids, repr(text)


def test_every_token_before_every_kind_of_token(encoder, library):
    draw, vocab = random.Random(5), sorted(library.get_vocab())
    words = [a.replace("</w>", "") + draw.choice(vocab).replace("</w>", "") for a in vocab[::3]]
    for word, code in zip(words, library.encode_batch(words, add_special_tokens=False)):
        assert ids_of(encoder, word) == code.ids


def test_a_shared_prefix_is_encoded_once(encoder):
    fresh = trie_bpe.TrieEncoder(PATH)
    fresh.encode_words({"overlook"})
    before = len(fresh.last)
    fresh.encode_words({"overlooking"})
    # "overloo" is shared; "k" inside a word is another symbol than at its end.
    assert len(fresh.last) - before == len("king")


def test_parts_and_small_memories_change_nothing(library, monkeypatch):
    monkeypatch.setattr(trie_bpe, "PART", 50)
    small = trie_bpe.TrieEncoder(PATH, remembered=5, nodes=20)
    text = " ".join(random_texts()[:300]) + " " + "q7" * 400 + " é́ end"
    assert ids_of(small, text) == library.encode(text, add_special_tokens=False).ids


def test_rows(spark, library):
    rows = [(1, "Two words"), (1, "Two words"), (None, None), (2, ""), (3, " \n "), (4, "long text, " * 30_000), (None, "x<|endoftext|>y")]
    docs = spark.createDataFrame([(*r, "c", 5) for r in rows], "doc_id bigint, text string, ids string, n_tokens int").repartition(3)
    got = trie_bpe.encode(docs, PATH)
    assert got.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids", "decoded"]
    want = []
    for i, text in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        said = library.decode(ids, skip_special_tokens=False)
        want.append((i, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(said.encode()).hexdigest(), ids, said))
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)
    back = {(r.doc_id, r.text) for r in trie_bpe.decode_ids(got, PATH).collect()}
    assert back == {(w[0], w[5]) for w in want}
    slim = trie_bpe.encode(docs, PATH, with_ids=False, with_text=False)
    assert sorted(map(tuple, slim.collect()), key=repr) == sorted((w[:4] for w in want), key=repr)
    assert trie_bpe.encode(docs.limit(0), PATH).count() == 0


def test_query(spark, library):
    folder = "/root/testdata/sf0.001"
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    got = QUERIES["op11_trie_bpe"](spark, folder).collect()
    assert len(got) == len(docs)
    for r in got:
        ids = library.encode(docs[r.doc_id], add_special_tokens=False).ids
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()
