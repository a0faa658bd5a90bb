"""Whole operators against plain restatements on random input."""

import random
import re
from collections import Counter

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from corpusloom import fixed
from corpusloom.operators.chunk import chunk_paragraphs
from corpusloom.operators.encode import decode_bpe, encode_bpe, merge_symbols
from corpusloom.operators.mix import interleave_uniform, mix
from corpusloom.operators.merges import replay, rule_of_a_round
from corpusloom.operators.order import cluster_greedy, compose_steps, epochs, hex_bucket, prefix_sum, running, shuffle_docs
from corpusloom.operators.sample import bernoulli_by_bytes, cap_per_source, upsample
from corpusloom.operators.vocab import build_vocab, characters, learn_bpe, word_counts
from corpusloom.functions.keys import order_key
from corpusloom.sources.tokenbin import _documents, _Stream


def chunks_of(text, limit):
    out, cur = [], ""
    for line in re.findall(r"[^\n]*\n|[^\n]+", text):
        if line.strip():
            cur += line
        elif len(cur) > limit:
            out.append(cur)
            cur = ""
        else:
            cur += "\n"
    return out + [cur] if len(cur) > limit else out


@pytest.mark.parametrize("block_lines,fan", [(2, 2), (3, 4), (100, 256)])
def test_chunk_paragraphs(spark, block_lines, fan):
    draw = random.Random(3)
    texts = ["".join(draw.choice(["a", "bb", "\n", "\n\n", " "]) for _ in range(draw.randint(0, 60))) for _ in range(150)]
    rows = [
        (str(i), k, line.rstrip("\n"), line.endswith("\n"))
        for i, text in enumerate(texts) for k, line in enumerate(re.findall(r"[^\n]*\n|[^\n]+", text))
    ]
    lines = spark.createDataFrame(rows, "file string, line_no long, line string, newline boolean")
    got = {}
    for r in chunk_paragraphs(lines, 4, block_lines, fan).orderBy("file", "chunk_no").collect():
        got.setdefault(int(r.file), []).append(r.chunk)
    assert [got.get(i, []) for i in range(len(texts))] == [chunks_of(t, 4) for t in texts]


def hot_rows(n=600):
    """A third of the rows in one source; a null source; ids far apart and close together."""
    draw = random.Random(5)
    return [
        (i if i % 2 else 10**12 + i, "hot" if i % 3 == 0 else None if i % 50 == 1 else f"s{i % 7}", draw.randint(0, 9))
        for i in range(n)
    ]


@pytest.mark.parametrize("partitions", [1, 8])
def test_running_totals(spark, partitions):
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        rows = hot_rows()
        df = spark.createDataFrame(rows, "doc_id long, source string, n long")
        got = {r.doc_id: (r.before, r.mine) for r in running(
            running(df, "doc_id", "n"), "doc_id", "n", by=["source"], out="mine").collect()}
        total, mine = 0, Counter()
        assert len(got) == len(rows)
        for doc_id, source, n in sorted(rows):
            assert got[doc_id] == (total, mine[source])
            total, mine[source] = total + n, mine[source] + n
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 8)


def test_caps_are_exact(spark):
    rows = hot_rows()
    df = spark.createDataFrame(rows, "doc_id long, source string, n long")
    got = {r.doc_id for r in cap_per_source(df, 20).collect()}
    seen, want = Counter(), set()
    for doc_id, source, _ in sorted(rows):
        if seen[source] < 20:
            want.add(doc_id)
        seen[source] += 1
    assert got == want


def test_bernoulli_sample_is_the_loop(spark):
    draw = random.Random(8)
    rows = [(f"f{i // 40}", i, draw.choice(["x" * draw.randint(1, 30), " ", ""])) for i in range(400)]
    df = spark.createDataFrame(rows, "file string, line_no long, line string")
    keys = {(r.file, r.line_no): int(r.k[:8], 16) / 2**32 for r in df.select(
        "file", "line_no", order_key(4, "file", "line_no").alias("k")).collect()}
    total = sum(len(line) + 1 for _, _, line in rows)
    for target, slack in ((1500, 100), (10**6, 100), (300, 10)):
        want, written = set(), 0
        for name in sorted({f for f, _, _ in rows}):
            for f, i, line in rows:
                if f != name:
                    continue
                if total < target:
                    want.add(i)
                elif line.strip() and keys[f, i] < target / total:
                    want.add(i)
                    written += len(line)
                    if written >= target + slack:
                        break
        assert {r.line_no for r in bernoulli_by_bytes(df, 4, target, slack).collect()} == want


def test_greedy_clusters_are_the_loop(spark):
    draw = random.Random(2)
    sizes = [draw.choice([0, 1, 5, 40, 200 if draw.random() < 0.1 else 3]) for _ in range(900)]
    want, cluster, size = [], 0, 0
    for n in sizes:
        want.append(cluster)
        size += 2 * n
        if size >= 300:
            cluster, size = cluster + 1, 0
    df = spark.createDataFrame(list(enumerate(sizes)), "doc_id long, n_tokens long")
    for segment in (1, 2, 7, 1000):
        got = cluster_greedy(df, limit_bytes=300, segment_clusters=segment).orderBy("doc_id")
        assert [r.cluster for r in got.collect()] == want


def test_shuffles_are_permutations(spark):
    df = spark.createDataFrame([(i,) for i in range(500)], "doc_id long")
    first = [r.doc_id for r in shuffle_docs(df, 1).collect()]
    assert sorted(first) == list(range(500)) and first != list(range(500))
    assert first == [r.doc_id for r in shuffle_docs(df.repartition(3), 1).collect()]
    assert first != [r.doc_id for r in shuffle_docs(df, 2).collect()]
    assert epochs(df, 3).groupBy("epoch").count().collect()[0]["count"] == 500
    assert upsample(df, 4).count() == 2000


def test_interleave_draws_uniformly(spark):
    sizes = {"a": 300, "b": 900, "c": 2700}
    rows = [(i, s) for s, n in sizes.items() for i in range(n)]
    df = spark.createDataFrame(rows, "doc_id long, source string")
    hits, draws = Counter(), 0
    for seed in range(4):
        laid = interleave_uniform(df, seed).orderBy("arrival", "source", "doc_id").collect()
        last = {}
        for r in laid:  # order inside a source is kept
            assert last.get(r.source, -1) < r.doc_id
            last[r.source] = r.doc_id
        hits.update(r.source for r in laid[:600])  # all three sources are still active
        draws += 600
    for source in sizes:
        assert abs(hits[source] - draws / 3) < 4 * (draws * 2 / 9) ** 0.5


def test_mix_stays_in_blocks(spark):
    df = spark.createDataFrame([(i, f"s{i % 3}") for i in range(500)], "doc_id long, source string")
    rows = mix(df, 3, 3, buffer=64).collect()
    assert sorted(r.position for r in rows) == list(range(500))
    assert sorted(r.block * 64 + r["rank"] for r in rows) == list(range(500))
    assert all(r.position // 64 == r.block for r in rows)


# --- byte-pair encoding -------------------------------------------------------------
def one_by_one(words, n_merges, min_freq=2, max_piece=32):
    types = {tuple(fixed.WORD_MARK + w): n for w, n in words.items()}
    merges = []
    while len(merges) < n_merges:
        pairs = Counter()
        for symbols, n in types.items():
            for pair in zip(symbols, symbols[1:]):
                if len(pair[0]) + len(pair[1]) <= max_piece:
                    pairs[pair] += n
        left = [(-c, p) for p, c in pairs.items() if c >= min_freq]
        if not left:
            break
        best = min(left)[1]
        merges.append(best)
        merged = Counter()
        for symbols, n in types.items():
            out, i = [], 0
            while i < len(symbols):
                if symbols[i:i + 2] == best:
                    out.append(symbols[i] + symbols[i + 1])
                    i += 2
                else:
                    out.append(symbols[i])
                    i += 1
            merged[tuple(out)] += n
        types = merged
    return merges


WORD_LISTS = [
    ["aaaa"] * 3 + ["aaab", "abab", "baba", "cab"] * 2 + ["aa", "b", "abc"],
    [random.Random(6).choice("abc") * random.Random(i).randint(1, 5) + random.Random(i * 3).choice(["xy", "yx", "z"]) for i in range(60)],
]


@pytest.mark.parametrize("words", WORD_LISTS)
def test_learn_bpe_is_the_loop(spark, words):
    df = spark.createDataFrame([(" ".join(words),)], "text string")
    got = [(r.left, r.right) for r in learn_bpe(word_counts(df), 25).orderBy("rank").collect()]
    assert got == one_by_one(Counter(words), 25)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text("abc", min_size=1, max_size=8), min_size=1, max_size=12), st.text("abc", max_size=12))
def test_merging_by_heap_is_merging_by_scan(words, word):
    merges = one_by_one(Counter(words + words), 12)
    ranks = {pair: i for i, pair in enumerate(merges)}
    symbols = list(word)
    while True:
        known = [(ranks[p], p) for p in zip(symbols, symbols[1:]) if p in ranks]
        if not known:
            break
        best, out, i = min(known)[1], [], 0
        while i < len(symbols):
            if tuple(symbols[i:i + 2]) == best:
                out.append(symbols[i] + symbols[i + 1])
                i += 2
            else:
                out.append(symbols[i])
                i += 1
        symbols = out
    assert merge_symbols(list(word), ranks) == symbols


@settings(max_examples=120, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=90), st.integers(1, 20), st.integers(1, 12), st.lists(st.integers(0, 90), max_size=4))
def test_ranges_across_shards_with_cut_documents(tokens, step, piece, cuts):
    """However a stream is cut into shards and ranges, and however short a piece is, all tokens come back in order,
    rows that open a document open the right ones, and only documents beyond a piece are cut."""
    import io

    data = np.array(tokens, dtype="<u2")
    bounds = sorted({0, len(tokens), *(min(c, len(tokens)) for c in cuts)})
    shards = [data[a:b] for a, b in zip(bounds, bounds[1:])]
    opens = [a == 0 or tokens[a - 1] == 2 for a in bounds[:-1]]
    got = []
    for k, shard in enumerate(shards):
        after, reach = [], 0
        for j in range(k + 1, len(shards)):
            if opens[j] or reach > piece:
                break
            after.append(shards[j])
            reach += len(shards[j])
        for first in range(0, len(shard), step):
            stream = _Stream([(io.BytesIO(s.tobytes()), len(s)) for s in (shard, *after)])
            limit = min(first + step, len(shard))
            for start, docs, fresh in _documents(stream, first, limit, 2, piece, opens[k]):
                for i, doc in enumerate(docs):
                    got.append((bounds[k] + start, fresh or i > 0, doc.tolist()))
                    start += len(doc)
    assert [t for _, _, doc in got for t in doc] == tokens
    assert [s for s, _, _ in got] == list(np.cumsum([0] + [len(d) for _, _, d in got])[:-1])
    assert all(fresh == (start == 0 or tokens[start - 1] == 2) for start, fresh, _ in got)
    assert all(fresh or len(doc) for _, fresh, doc in got)
    ends = [i + 1 for i, t in enumerate(tokens) if t == 2]
    whole = [b - a for a, b in zip([0, *ends], [*ends, len(tokens)]) if b > a]
    if all(n < piece for n in whole):
        assert [len(doc) for _, _, doc in got] == whole


def batched_rule(words, n, look, min_freq=2):
    """The rounds of the batched mode on plain lists."""
    types = Counter({tuple("▁" + w): c for w, c in Counter(words).items()})
    merges = []
    while len(merges) < n:
        pairs = Counter()
        for symbols, c in types.items():
            for p in zip(symbols, symbols[1:]):
                pairs[p] += c
        ordered = sorted((p for p, c in pairs.items() if c >= min_freq and len(p[0] + p[1]) <= 32), key=lambda p: (-pairs[p], p))
        taken, lefts, rights, passed = [], set(), set(), 0
        for p in ordered[:look]:
            if len(taken) == n - len(merges) or 2 * pairs[p] < passed:
                break
            if p[0] not in rights and p[1] not in lefts:
                taken.append(p)
                lefts.add(p[0])
                rights.add(p[1])
            else:
                passed = passed or pairs[p]
        if not taken:
            break
        merges += taken
        for pair in taken:
            merged = Counter()
            for symbols, c in types.items():
                out, i = [], 0
                while i < len(symbols):
                    if symbols[i:i + 2] == pair:
                        out.append(symbols[i] + symbols[i + 1])
                        i += 2
                    else:
                        out.append(symbols[i])
                        i += 1
                merged[tuple(out)] += c
            types = merged
    return merges


def syllables(seed, n):
    draw = random.Random(seed)
    return ["".join(draw.choice(["th", "e", "ing", "an", "a", "aa", "on"]) for _ in range(draw.randint(1, 5))) for _ in range(n)]


@pytest.mark.parametrize("look", [3, 40, 4096])
def test_many_merges_are_the_loop_whatever_the_driver_follows(spark, look):
    words = syllables(2, 600)
    counts = word_counts(spark.createDataFrame([(" ".join(words),)], "text string"))
    got = [(r.left, r.right) for r in learn_bpe(counts, 400, look=look).orderBy("rank").collect()]
    assert len(got) > 100 and got == one_by_one(Counter(words), 400)


@pytest.mark.parametrize("look", [3, 40, 4096])
def test_batched_merges_are_the_rule(spark, look):
    words = syllables(3, 600)
    counts = word_counts(spark.createDataFrame([(" ".join(words),)], "text string"))
    got = [(r.left, r.right) for r in learn_bpe(counts, 300, look=look, exact=False).orderBy("rank").collect()]
    assert got == batched_rule(words, 300, look)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from("ab"), max_size=12), st.lists(st.tuples(st.sampled_from(["a", "b", "ab", "aa"]), st.sampled_from(["a", "b", "ab"])), max_size=5))
def test_changes_of_a_replay_are_the_difference(symbols, batch):
    changes = Counter()
    steps = {}
    for k, pair in enumerate(batch):
        steps.setdefault(pair, []).append(k)
    end = replay(symbols, steps, lambda step, pair, by: changes.update({pair: by}))
    want = Counter(zip(end, end[1:]))
    want.subtract(Counter(zip(symbols, symbols[1:])))
    assert {p: n for p, n in changes.items() if n} == {p: n for p, n in want.items() if n}


def test_text_layout_keeps_every_character(spark):
    """Indentation, tabs, composed and decomposed characters, unseen ones, and strings that look like pieces."""
    train = spark.createDataFrame([("def low(x):\n    return  lower\n" * 3,), ("    low lowest  low",)], "text string")
    counts = word_counts(train, pretok="text")
    merges = learn_bpe(counts, 25, pretok="text")
    vocab = build_vocab(merges, characters(counts, "text"), "text")
    texts = [
        "def low(x):\n\treturn\t \t lower  ", "  e\u0301 é ▁ low▁er ▁▁", "<0x41> <unk>x <s>low</s>low </s> ", " ", "\n\n", "",
        "猫\u00a0\u2003 x\x0b", "\r\n a\r", "    deep\n        deeper",
    ]
    rows = spark.createDataFrame(list(enumerate(texts)), "k int, text string")
    coded = rows.select("k", encode_bpe(F.col("text"), merges, vocab, "text").alias("ids"))
    back = {r.k: r.text for r in coded.select("k", decode_bpe(F.col("ids"), vocab, "text").alias("text")).collect()}
    assert [back[k] for k in range(len(texts))] == [t.replace("\r\n", "\n").replace("\n", " ") for t in texts]
    ids = {r.k: r.ids for r in coded.collect()}
    assert fixed.BOS_ID in ids[2] and fixed.EOS_ID in ids[2] and ids[5] == []
    assert all(0 not in i for i in ids.values())
    # A run of spaces is one piece where it was learnt as one.
    pieces = [r.piece for r in vocab.orderBy("id").collect()]
    assert any(set(pieces[i]) == {fixed.WORD_MARK} and len(pieces[i]) > 1 for i in ids[8])


def test_line_layout_is_normalized(spark):
    train = spark.createDataFrame([("caf\u00e9 caf\u00e9",)], "text string")
    counts = word_counts(train, pretok="line")
    merges = learn_bpe(counts, 4, pretok="line")
    vocab = build_vocab(merges, characters(counts, "line"), "line")
    rows = spark.createDataFrame([("caf\u00e9",), ("cafe\u0301",)], "text string")
    coded = rows.select(encode_bpe(F.col("text"), merges, vocab, "line").alias("ids")).collect()
    assert coded[0].ids == coded[1].ids
    assert [r.piece for r in characters(counts, "line").collect()] and all(len(r.piece) == 2 for r in characters(counts, "line").collect())


def test_greedy_clusters_of_equal_documents_stay_in_bounded_tasks(spark):
    """Equal documents never fall in step; composed tables hold no more steps than a segment has."""
    n, size, limit = 6_000, 7, 300
    df = spark.range(n).select(F.col("id").alias("doc_id"), F.lit(size).alias("n_tokens"))
    got = [r.cluster for r in cluster_greedy(df, limit_bytes=limit, segment_clusters=2, together=3).orderBy("doc_id").collect()]
    per = -(-limit // (2 * size))
    assert got == [i // per for i in range(n)]


def test_composed_steps_hold_no_more_than_the_first_segment():
    draw = np.random.default_rng(5)
    tables = []
    for segment in range(9):
        upto = np.sort(draw.choice(1000, 40, replace=False)) + 1000 * segment
        nxt = np.sort(draw.choice(1000, 40)) + 1000 * (segment + 1) - 500
        tables.append(pd.DataFrame({"segment": segment, "upto": upto, "opened": nxt, "closed": draw.integers(1, 4, 40)}))
    whole = compose_steps(pd.concat(tables).sample(frac=1, random_state=1))
    assert len(whole) <= sum(len(t) for t in tables)
    for state in [0, 1, 500, 900, 999]:
        at, number = state, 0
        for t in tables:
            k = int(np.searchsorted(t["upto"], at))
            if k < len(t):
                number += int(t["closed"].iloc[k])
                at = int(t["opened"].iloc[k])
        k = int(np.searchsorted(whole["upto"], state))
        assert (int(whole["opened"].iloc[k]), int(whole["closed"].iloc[k])) == (at, number)


def test_bytes_stand_in_for_unknown_characters(spark):
    train = spark.createDataFrame([("low lower lowest low",)], "text string")
    counts = word_counts(train)
    merges = learn_bpe(counts, 5)
    vocab = build_vocab(merges, characters(counts))
    new = spark.createDataFrame([("<s>low 猫 zz</s>\nlow",), ("",), (None,)], "text string")
    coded = new.select(encode_bpe(F.col("text"), merges, vocab).alias("ids"))
    first = coded.collect()[0].ids
    assert first[0] == fixed.BOS_ID and first.count(fixed.EOS_ID) == 1 and 0 not in first
    back = [r[0] for r in coded.select(decode_bpe(F.col("ids"), vocab)).collect()]
    assert back == ["<s> low 猫 zz</s> low", "", ""]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(0, 4), max_size=80), st.integers(1, 30), st.integers(1, 9))
def test_ranges_of_a_token_file(tokens, step, chunk):
    import io

    import corpusloom.sources.tokenbin as tokenbin

    data = np.array(tokens, dtype="<u2").tobytes()
    whole, docs = [], []
    for t in tokens:
        whole.append(t)
        if t == 2:
            docs.append(whole)
            whole = []
    docs += [whole] if whole else []
    before = tokenbin.CHUNK_BYTES
    tokenbin.CHUNK_BYTES = 2 * chunk
    try:
        got = []
        for first in range(0, len(tokens), step):
            stream = _Stream([(io.BytesIO(data), len(tokens))])
            for start, batch, fresh in _documents(stream, first, min(first + step, len(tokens)), 2):
                assert fresh
                for doc in batch:
                    got.append((start, doc.tolist()))
                    start += len(doc)
    finally:
        tokenbin.CHUNK_BYTES = before
    assert [d for _, d in got] == docs
    assert [s for s, _ in got] == list(np.cumsum([0] + [len(d) for d in docs])[:-1])


def test_batched_merges_encode_and_decode(spark):
    """The batched order may differ, but it starts with the best pair and gives usable merges."""
    draw = random.Random(12)
    words = ["".join(draw.choice("abcdefgh") for _ in range(draw.randint(1, 7))) for _ in range(200)]
    df = spark.createDataFrame([(" ".join(words),)], "text string")
    counts = word_counts(df)
    merges = learn_bpe(counts, 30, exact=False)
    got = [(r.left, r.right) for r in merges.orderBy("rank").collect()]
    assert len(got) == len(set(got)) == 30 and got[0] == one_by_one(Counter(words), 1)[0]
    vocab = build_vocab(merges, characters(counts))
    coded = df.select(encode_bpe(F.col("text"), merges, vocab).alias("ids"))
    assert coded.select(decode_bpe(F.col("ids"), vocab)).first()[0] == " ".join(words)
    assert len(coded.first().ids) < sum(len(w) + 1 for w in words)


@settings(max_examples=200, deadline=None)
@given(
    st.lists(st.text("abc", min_size=1, max_size=9), min_size=1, max_size=6),
    st.lists(st.tuples(st.sampled_from(["a", "b", "ab", "aa", "c"]), st.sampled_from(["a", "b", "ab", "bc"])), max_size=6),
)
def test_words_laid_end_to_end_are_merged_as_single_ones(words, batch):
    """Whole groups of merges in one pass leave what the replay of each word leaves, and tell the same changes."""
    from corpusloom.operators import merges as m

    pieces, numbered = m._Pieces("text"), {}
    for k, pair in enumerate(batch):
        numbered.setdefault(pair, []).append(k)
    n = list(range(1, len(words) + 1))
    want = [replay(list(w), numbered) for w in words]
    diff = Counter()
    for w, end, times in zip(words, want, n):
        diff.update({p: times * c for p, c in Counter(zip(end, end[1:])).items()})
        diff.subtract({p: times * c for p, c in Counter(zip(w, w[1:])).items()})
    steps = pieces.steps(batch)
    for groups in ([[s] for s in steps], m.at_once(steps)):
        laid = m.Words(np.array([ord(c) for w in words for c in w], "i4"), np.array([len(w) for w in words]), np.array(n))
        told = Counter()
        for group in groups:
            for key, by in zip(*(laid.apply(group, told=True) or ((), ()))):
                told[int(key)] += int(by)
        piece = m._spelling("text", pieces.merged)
        low = (1 << m.WIDTH) - 1
        assert {p: c for p, c in diff.items() if c} == {(piece(k >> m.WIDTH), piece(k & low)): c for k, c in told.items() if c}
        rows, times = laid.rows()
        got = [[piece(int(x)) for x in np.frombuffer(r, "<i4")] for r in rows.to_pylist()]
        assert (got, times.tolist()) == ([w for w in want if len(w) > 1], [t for w, t in zip(want, n) if len(w) > 1])


def test_parts_of_a_batch_give_what_the_batch_gives():
    """Functions of Arrow columns see no more than so many bytes or ids at a time, and nothing changes by it."""
    import pyarrow as pa

    from corpusloom.functions.arrays import by_parts, small_parts

    texts = pa.array(["a" * 30, None, "", "b" * 5, "c" * 100, "d"])
    assert [len(p) for p in small_parts(texts, 10)] == [1, 4, 1]
    lists = pa.array([[1] * 7, None, [], [2] * 3, [4]], pa.list_(pa.int32()))
    seen = []
    whole = by_parts(5)(lambda column: seen.append(len(column)) or column)
    assert whole(lists).equals(lists) and seen == [1, 3, 1]
    assert whole(lists.slice(5)).equals(lists.slice(5))


@pytest.mark.parametrize("pretok", ["word", "text", "line"])
def test_words_merged_together_have_the_ids_of_single_ones(spark, monkeypatch, pretok):
    from corpusloom.operators import encode

    words = syllables(4, 300)
    df = spark.createDataFrame([(" ".join(words) + "\n ▁ <s> café 猫ab",), (None,), ("",), ("aaaa aaa \t x",)], "text string")
    train = word_counts(df.limit(1), pretok=pretok)
    merges = learn_bpe(train, 60, pretok=pretok)
    vocab = build_vocab(merges, characters(train.filter("word not like '%猫%'"), pretok), pretok)
    got = {}
    for passes in (0, 1000):
        monkeypatch.setattr(encode, "PASSES", passes)
        got[passes] = [r.ids for r in df.select(encode_bpe(F.col("text"), merges, vocab, pretok).alias("ids")).collect()]
    assert got[0] == got[1000] and len(got[0][0]) > 100


def test_results_of_a_part_leave_a_task_before_the_next_part_is_read(spark):
    """Iterator UDFs: a task never holds the ids of a whole batch of Spark's; rows keep their ids, nulls and empties too."""
    import pyarrow as pa
    from pyspark.util import PythonEvalType

    from corpusloom.functions.arrays import in_parts, pack_u16, unpack_u16
    from corpusloom.operators.encode import decode_words, encode_words
    from corpusloom.operators.vocab import word_vocab

    seen = []
    parts = in_parts(10)(lambda column: seen.append(len(column)) or column)(iter([pa.array(["a" * 30, "b", None, "c" * 12, "d"])]))
    assert len(next(parts)) == 1 and seen == [1]
    assert [len(p) for p in parts] == [3, 1]

    texts = [(k, None if k % 7 == 3 else " ".join(f"ab{k % 5} c{j % 3}" for j in range(k % 11))) for k in range(300)]
    df = spark.createDataFrame(texts, "doc_id int, text string").coalesce(1)
    types = word_counts(df).cache()
    words = word_vocab(types)
    merges = learn_bpe(types, 8)
    ids = build_vocab(merges, characters(types))
    coded = df.select("doc_id", encode_words(F.col("text"), words).alias("w"), encode_bpe(F.col("text"), merges, ids).alias("b"))
    coded = coded.withColumn("w", unpack_u16(pack_u16(F.col("w"))))
    back = coded.select("doc_id", decode_words(F.col("w"), words).alias("w"), decode_bpe(F.col("b"), ids).alias("b"))
    plan = back._jdf.queryExecution().executedPlan().toString()
    assert plan.count(f", {PythonEvalType.SQL_SCALAR_ARROW_ITER_UDF}") and f", {PythonEvalType.SQL_SCALAR_ARROW_UDF}" not in plan
    assert [tuple(r) for r in back.orderBy("doc_id").collect()] == [(k, t or "", t or "") for k, t in texts]


def test_lines_are_encoded_once_for_the_documents_cut_from_them(spark):
    """Running totals read the cut lines more than once; what makes them runs once. One span a row or many, results stay."""
    from corpusloom.plans.prepare import cut_documents

    rows = [("f", 0, [5, 6]), ("f", 1, [7, 2, 8, 2, 9]), ("f", 2, []), ("f", 3, None), ("g", 0, [2]), ("g", 1, [None, 2]), ("g", 2, [3])]
    looked = spark.sparkContext.accumulator(0)

    @F.udf("array<int>")
    def made(ids):
        looked.add(1)
        return ids

    lines = spark.createDataFrame(rows, "file string, line_no long, ids array<int>")
    got = cut_documents(lines.withColumn("ids", made.asNondeterministic()("ids"))).orderBy("doc_id").collect()
    assert [r.ids for r in got] == [[5, 6, 7, 2], [8, 2], [9, 2], [None, 2], [3]]
    assert looked.value == len(rows)


def line_rule(lines, n, look, exact, min_freq=2, longest=64):
    """Merges of whole lines of bytes in hex on plain lists: one by one, or by the rounds of the batched mode."""
    types = [([f"{b:02X}" for b in line.encode()], c) for line, c in Counter(lines).items()]
    merges = []
    while len(merges) < n:
        pairs = Counter()
        for symbols, c in types:
            for p in zip(symbols, symbols[1:]):
                pairs[p] += c
        ordered = sorted((p for p, c in pairs.items() if c >= min_freq and len(p[0] + p[1]) <= longest), key=lambda p: (-pairs[p], p))
        taken = ordered[:1] if exact else rule_of_a_round(ordered[:look], pairs, n - len(merges))
        if not taken:
            break
        merges += taken
        for pair in taken:
            types = [(replay(symbols, {pair: [0]}), c) for symbols, c in types]
    return merges


@pytest.mark.parametrize("exact", [True, False])
@pytest.mark.parametrize("look, n", [(3, 30), (4096, 12), (4096, 150)])
def test_lines_cut_at_rare_pairs_of_bytes_give_the_merges_of_whole_lines(spark, look, n, exact):
    words = syllables(6, 400)
    lines = [" ".join(words[i:i + 8]) + " é!" * (i % 3) for i in range(0, 400, 8)] + ["aaaaaaaaa", "", "x", "猫"]
    texts = ["\n".join(lines), "\n".join(lines[:7]), None, ""]
    counts = word_counts(spark.createDataFrame([(t,) for t in texts], "text string"), pretok="line")
    got = [(r.left, r.right) for r in learn_bpe(counts, n, pretok="line", look=look, exact=exact).orderBy("rank").collect()]
    assert len(got) == n and got == line_rule([x for t in texts if t for x in t.split("\n") if x], n, look, exact)


def test_rounds_over_lines_read_parts_that_repeat(spark, monkeypatch):
    """Lines that never repeat: what a round reads does not grow with them."""
    from corpusloom.operators import merges

    sizes, changes = [], merges._changes

    def seen(state, *rest):
        sizes.append(state.agg(F.sum(F.octet_length(state.columns[0]))).first()[0])
        return changes(state, *rest)

    monkeypatch.setattr(merges, "_changes", seen)
    lines = [f"the {i:05d} end" for i in range(3_000)]
    counts = word_counts(spark.createDataFrame([("\n".join(lines),)], "text string"), pretok="line")
    got = [(r.left, r.right) for r in learn_bpe(counts, 6, pretok="line", exact=False).orderBy("rank").collect()]
    assert got == line_rule(lines, 6, 4096, False)
    assert sizes and max(sizes) < len(lines)


def test_bytes_of_lines_are_counted_without_a_row_per_byte(spark, monkeypatch):
    from corpusloom.operators import vocab

    plans, stage = [], vocab.stage
    monkeypatch.setattr(vocab, "stage", lambda df: plans.append(df._jdf.queryExecution().toString()) or stage(df))
    texts = ["café\n\nx", "café", "aaa\n猫", None, ""]
    counts = word_counts(spark.createDataFrame([(t,) for t in texts], "text string"), pretok="line")
    got = [(r.piece, r.n) for r in characters(counts, "line").collect()]
    want = Counter(f"{b:02X}" for t in texts if t for line in t.split("\n") for b in line.encode())
    assert dict(got) == want and [p for p, _ in got] == sorted(want, key=lambda p: (-want[p], p))
    assert len(plans) == 1 and "Generate" not in plans[0]
