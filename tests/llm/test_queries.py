"""The registered queries over their whole tables against plain restatements, at the smallest scale."""

import hashlib
import zlib
from collections import defaultdict

import numpy as np
import pytest

import __spark_entry__ as job
from corpusloom.llm.license_scan import TEMPLATES

from . import brute

FOLDER = "/root/testdata/sf0.001"
QUERIES = job.queries()


@pytest.fixture(scope="module")
def docs(spark):
    rows = spark.read.parquet(f"{FOLDER}/documents.parquet").orderBy("doc_id").collect()
    return {r.doc_id: r for r in rows}


def run(spark, name):
    return QUERIES[name](spark, FOLDER).collect()


def tokenizer(name):
    import public_tokenizers
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(public_tokenizers.path(name))
    return model


def crc_of(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_license_scan(spark, docs):
    got = run(spark, "op1_license_scan")
    assert len(got) == len(docs)
    for r in got:
        text = docs[r.doc_id].text
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == brute.license_base(text)
        assert r.labels == brute.labels_of(text, TEMPLATES)
        assert 0 <= r.score <= 1 and (r.score > 0) == (r.labels != "")


def test_spaced_seeds(spark, docs):
    bench = [(r.item_id, r.text) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    got = {(r.doc_id, r.item_id): r.best_window for r in run(spark, "op2_spaced_seeds")}
    assert got == brute.leaks([(d, r.text) for d, r in docs.items()], bench)


def test_token_codes(spark, docs):
    model, start = tokenizer("byte_bpe_50k.json"), 0
    got = {r.doc_id: r for r in run(spark, "op3_token_codes")}
    assert set(got) == set(docs)
    for doc, row in docs.items():
        ids = model.encode(row.text, add_special_tokens=False).ids + [2]
        assert (got[doc].start, got[doc].n_tokens, got[doc].ids_crc32) == (start, len(ids), crc_of(ids))
        start += len(ids)


def test_gam_held_out(spark):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    got = run(spark, "op4_pairwise_gam")
    assert all(r.held_out == (not brute.learnt(r.doc_id)) for r in got)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in got)
    right = [r.predicted == labels[r.doc_id] for r in got if r.held_out and r.doc_id in labels]
    assert sum(right) / len(right) > 0.85


def test_packing(spark, docs):
    model = tokenizer("word_bpe_49k.json")
    ids = {d: model.encode(r.text, add_special_tokens=False).ids + [1] for d, r in docs.items()}
    pieces, rooms = defaultdict(list), defaultdict(list)
    for r in run(spark, "op5_tree_packing"):
        part = ids[r.doc_id][r.start : r.start + r.length]
        assert len(part) == r.length > 0 and r.ids_crc32 == crc_of(part) and r.doc_tokens == len(ids[r.doc_id])
        pieces[r.doc_id].append((r.start, r.length))
        rooms[r.sequence_id].append((r.offset, r.length))

    def gapless(parts):
        at = 0
        for start, length in sorted(parts):
            assert start == at
            at += length
        return at

    assert {d: gapless(p) for d, p in pieces.items()} == {d: len(x) for d, x in ids.items()}
    fill = [gapless(p) for p in rooms.values()]
    assert max(fill) <= 2048
    padding = sum(2048 - n for n in fill if n & (n - 1))
    assert padding <= 0.02 * sum(fill)


def test_line_rules(spark, docs):
    for r in run(spark, "op6_line_rules"):
        counts = brute.line_counts(docs[r.doc_id].text)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == counts
        assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words)
        assert not (r.base_failed and r.kept)


def test_line_rules_keep_good_documents(spark):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    judged = [(r, labels[r.doc_id]) for r in run(spark, "op6_line_rules") if r.doc_id in labels and not r.base_failed]
    assert all(r.kept for r, good in judged if good) and not all(r.kept for r, _ in judged)


def test_shards(spark, docs):
    shards = defaultdict(list)
    for r in run(spark, "op7_hypergeometric_shards"):
        raw = docs[r.doc_id].text.encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(raw) + 8, zlib.crc32(raw), "rows", None)
        shards[r.shard].append(r.slot)
    assert set(shards) == set(range(24))
    sizes = [len(s) for s in shards.values()]
    assert max(sizes) - min(sizes) <= 1 and sum(sizes) == len(docs)
    assert all(sorted(s) == list(range(len(s))) for s in shards.values())


def test_line_suffixes(spark, docs):
    want = brute.deleted_lines([(d, r.text) for d, r in docs.items()])
    assert want
    for r in run(spark, "op8_line_suffixes"):
        gone = want.get(r.doc_id, [])
        left = "\n".join(x for i, x in enumerate(docs[r.doc_id].text.split("\n")) if i not in gone)
        assert (r.removed, r.text_md5) == (",".join(map(str, gone)), hashlib.md5(left.encode()).hexdigest())


def test_ball_simhash(spark, docs):
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in run(spark, "op9_ball_simhash")}
    assert got == brute.near_components([(d, r.text) for d, r in docs.items()])


def test_language_mixture(spark, docs):
    got = run(spark, "op10_language_mixture")
    assert all(r.held_out == (not brute.learnt(r.doc_id)) and 0 <= r.score <= 1 for r in got)
    right = [r.lang_pred == docs[r.doc_id].lang for r in got if r.held_out]
    assert sum(right) / len(right) > 0.97
