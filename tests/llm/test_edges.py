"""Nulls, empty and very long texts, ties, repeated rows, empty tables and clashing columns, operator by operator."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusloom.llm import (
    components, decontaminate, language_mix, license_scan, line_dedup, line_rules, packing, quality_gam, shards, simhash,
    token_codes,
)
from corpusloom.llm.pieces import MARK, PieceEncoder
from corpusloom.llm.queries import vocabulary

from . import brute

WORDS = "the of and to in was river stone house garden light under over seven maybe walking slowly".split()


def prose(seed, n):
    draw = random.Random(seed)
    words = [draw.choice(WORDS) + draw.choice(["", "", "a", "en", "ing"]) for _ in range(n)]
    return "".join(w + ("\n" if i % 9 == 8 else " ") for i, w in enumerate(words)).strip()


LONG = prose(1, 30_000)
PASSAGE = "\n".join(f"line {k} of a passage that many documents share word for word" for k in range(8))
ROWS = [
    (1, "Released under the MIT License.\nGeneral Public License, Apache License."), (2, None), (3, ""), (4, " \n\t \n"),
    (5, LONG), (6, prose(2, 80)), (7, prose(2, 80)), (7, prose(2, 80)), (8, prose(3, 40) + "\n" + PASSAGE),
    (9, PASSAGE + "\n\n" + prose(4, 60)), (None, prose(5, 50)), (None, None), (10, "a"), (11, "!!! ???"),
    (12, "  two  blanks 　 and others\n\n\nend "), (13, f"{MARK} stands {MARK}here <|endoftext|> 's 12"),
]
CLASHING = "doc_id bigint, text string, words string, rank int, shard int, slot int, h string, at int, print int, x int"


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame([(*r, "w", 1, 2, 3, "h", 4, 5, 6) for r in ROWS], CLASHING).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], CLASHING)


def by_id(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)


def test_license_scan(rows, none):
    got = license_scan.scan(rows)
    want = [(i, *brute.license_base(t), brute.labels_of(t, license_scan.TEMPLATES)) for i, t in ROWS]
    columns = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels"]
    assert by_id(got, *columns) == sorted(want, key=repr)
    assert license_scan.scan(none).count() == 0


def test_leaks_with_replaced_words(spark, rows, none):
    item = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen".split()
    changed = [w if i % 5 != 2 else "other" for i, w in enumerate(item)]
    half = item[:6] + ["x"] * 20
    many = [(20, " ".join(["before", *changed, "after"])), (21, " ".join(half)), (22, " ".join(item).upper()),
            (23, " ".join(item[1:])), (24, None), (22, "again")]
    bench = spark.createDataFrame([(1, " ".join(item), "z"), (2, None, "z"), (3, "too short", "z"), (4, "a b c d e", "z")],
                                  "item_id long, text string, h string")
    docs = spark.createDataFrame([*many, (25, "x a b z d e y"), (26, "a b c")], "doc_id long, text string")
    pairs = [(1, " ".join(item)), (3, "too short"), (4, "a b c d e")]
    want = brute.leaks([(d, t) for d, t in many if t != "again"] + [(25, "x a b z d e y"), (26, "a b c")], pairs)
    assert {(20, 1), (22, 1), (25, 4)} <= set(want) and (21, 1) not in want
    got = decontaminate.leaks(docs, bench)
    assert {(r.doc_id, r.item_id): r.best_window for r in got.collect()} == want
    # Every row is judged by its own text: the other row of 22 stays.
    assert {r.doc_id for r in decontaminate.clean(docs, bench).collect()} == {21, 22, 24, 26}
    assert decontaminate.leaks(rows, none.withColumn("item_id", F.col("doc_id"))).count() == 0
    assert decontaminate.leaks(none, bench).count() == 0


def test_pieces_are_exact():
    from tokenizers import Tokenizer

    odd = [t for _, t in ROWS if t] + ["", " ", "a  b", " a b ", "a\n b", "a ́b c", "x\x1cy \x85 z", "Ι ΣΣ a"]
    draw = random.Random(3)
    odd += ["".join(draw.choice("ab' .\n\té　 1s") for _ in range(40)) for _ in range(200)]
    for name in ("byte_bpe_50k.json", "word_bpe_49k.json"):
        model = Tokenizer.from_file(vocabulary(name))
        encoder = PieceEncoder(vocabulary(name), remembered=50)
        for _ in range(2):
            got = encoder.encode([*odd, None])
            assert [list(x) for x in got] == [model.encode(t, add_special_tokens=False).ids for t in [*odd, ""]]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_words_of_letters_go_to_the_model_as_they_are(name):
    """Every Latin-1 letter in both cases, with others that look like them; what was met again outlives the rest."""
    draw = random.Random(5)
    encoder = PieceEncoder(vocabulary(name), remembered=40)
    merged, merge = [], encoder.merge
    encoder.merge = lambda word: merged.append(word) or merge(word)
    letters = [chr(c) for c in [*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0xAA, 0x180), 0x301, 0x331, 0x130, 0x1E9E, 0x3A3]]
    for _ in range(6):
        texts = [" ".join("".join(draw.choices(letters[k:], k=draw.randint(1, 6))) for _ in range(40)) for k in (0, 20, 40)]
        texts += ["the same words, Every time.\nAgain  twice", " ".join(f"a{x} H{x}h. {x}\n{x}" for x in letters)]
        got = encoder.encode(texts)
        assert [c.tolist() for c in got] == [encoder.model.encode(t, add_special_tokens=False).ids for t in texts]
    assert merged and all(word.isalpha() for word in merged if word.isascii())
    encoder.encode(["the same words"])
    assert {"same", "words"} <= set(encoder.names.to_pylist()) and len(encoder.names) <= 23


def test_token_files(spark, rows, none, tmp_path):
    from tokenizers import Tokenizer

    path, name = str(tmp_path / "codes"), vocabulary("byte_bpe_50k.json")
    token_codes.write_token_files(rows, path, name, 2, tokens_per_file=300)
    model = Tokenizer.from_file(name)
    want = sorted((repr(i), [*model.encode(t or "", add_special_tokens=False).ids, 2]) for i, t in ROWS)
    got = token_codes.read_documents(spark, path).orderBy("start").collect()
    assert sorted((repr(r.doc_id), r.ids) for r in got) == want
    assert [r.doc_id for r in got] == sorted((i for i, _ in ROWS), key=lambda i: (i is not None, i))
    stream = [x for r in got for x in r.ids]
    assert [r.start for r in got] == np.cumsum([0, *(r.n_tokens for r in got)])[:-1].tolist()
    asked = spark.createDataFrame([(p,) for p in [*range(0, len(stream), 7), -1, len(stream), None]], "position long")
    found = token_codes.read_tokens_at(spark, path, asked)
    assert {r.position: r.token for r in found.collect()} == {p: stream[p] for p in range(0, len(stream), 7)}
    token_codes.write_token_files(none, str(tmp_path / "none"), name, 2)
    assert token_codes.read_documents(spark, str(tmp_path / "none")).count() == 0


def test_file_names_sort_by_partition_and_number(spark):
    names = ["part-00001-0c1f6f8e-c001-4c12-c234-c0123456789a-c000.txt", "part-00001-0c1f6f8e-c001-4c12-c234-c0123456789a-c012.txt",
             "part-100002-0c1f6f8e-c001-4c12-c234-c0123456789a-c1000.txt"]
    df = spark.createDataFrame([(f"file:/x/part-7-c9.d/{n}",) for n in names], "path string")
    keys = [r.k for r in df.select(token_codes._file_key(F.col("path")).alias("k")).collect()]
    assert keys == [1 << 32, (1 << 32) + 12, (100002 << 32) + 1000]


@pytest.mark.parametrize("widths", [(8, 4, 4), (4, 4, 8), (8, 8, 8, 8)])
def test_codes_round_trip(widths):
    draw = np.random.default_rng(5)
    codes = [draw.integers(0, 1 << draw.integers(1, 17), n) % 65_536 for n in (0, 1, 511, 512, 513, 4000)]
    part = token_codes.TokenFile(token_codes.to_file([None, *range(5)], codes, widths) + b"\n")
    flat = np.concatenate(codes)
    assert part.doc_ids == [None, 0, 1, 2, 3, 4] and np.array_equal(part.all(), flat)
    places = draw.integers(0, len(flat), 500)
    assert np.array_equal(part.at_positions(places), flat[places])
    with pytest.raises(ValueError):
        token_codes.to_file([1], [np.array([1 << sum(widths)], "u8")], widths) if sum(widths) < 32 else token_codes.TokenFile(b"x" * 8)


def test_gam(spark, rows, none):
    labels = spark.createDataFrame([(i, i % 2, 9) for i in range(1, 12)] + [(None, 1, 9), (5, None, 9), (6, 0, 9)],
                                   "doc_id long, quality int, x int")
    got = quality_gam.classify(rows, labels).collect()
    assert len(got) == len(ROWS) and all(0 <= r.score <= 1 for r in got)
    assert quality_gam.classify(none, labels).count() == 0
    bare = quality_gam.classify(rows, labels.limit(0)).collect()
    assert {r.score for r in bare} == {0.5}
    sampled = quality_gam.classify(rows, labels, sample_rows=2).collect()
    assert len(sampled) == len(ROWS)


def test_gam_learns_an_interaction():
    draw = np.random.default_rng(1)
    x = draw.random((4000, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    model = quality_gam.fit(x, y)
    assert (0, 1) in model.pairs and ((model.score(x) > 0.5) == y).mean() > 0.95


def test_packing(rows, none):
    got = packing.pack(rows, vocabulary("word_bpe_49k.json"), 1, capacity=64, group_docs=3)
    whole = packing.sequences(got, 64).collect()
    lengths = [len(r.input_ids) for r in whole]
    assert all(n == 64 or n & (n - 1) == 0 for n in lengths)
    pieces = got.collect()
    assert sum(r.length for r in pieces if r.start == 0) > 0 and sum(r.start == 0 for r in pieces) == len(ROWS)
    assert packing.pack(none, vocabulary("word_bpe_49k.json"), 1).count() == 0


def test_pack_group_wastes_at_most_one_sequence():
    draw = random.Random(2)
    for _ in range(50):
        sizes = [draw.choice([0, 1, 3, 60, 64, 65, 200]) for _ in range(draw.randint(0, 30))]
        bins = packing.pack_group(sizes, 64)
        seen = sorted((d, s, n) for b in bins for d, s, n in b.pieces)
        cover = {d: sum(n for e, _, n in seen if e == d) for d in range(len(sizes))}
        assert all(cover[d] == n for d, n in enumerate(sizes)) and all(b.used == sum(p[2] for p in b.pieces) for b in bins)
        assert sum(b.used < 64 for b in bins) <= 1 and max((b.used for b in bins), default=0) <= 64


def test_line_rules(rows, none):
    got = line_rules.clean_lines(rows)
    columns = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    assert by_id(got, *columns) == sorted(((i, *brute.line_counts(t)) for i, t in ROWS), key=repr)
    assert line_rules.clean_lines(none).count() == 0


def test_bad_lines(spark):
    good = "It was a plain sentence, with a name and a date (1999) in it."
    bad = ["Home | About | Contact | Help", "buy!! now!! it!! is!! cheap!!", "to%%% the&&& of*** and###", "Accept cookies to go on",
           "echo echo echo echo echo"]
    other = "Nothing else here resembles what the first line says, nor is any of it a notice of some kind."
    text = "\n".join([good, *bad, "", other])
    row = line_rules.clean_lines(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert row.clean_text == "\n".join([good, "", other]) and row.n_bad_lines == len(bad) and row.kept
    row = line_rules.clean_lines(spark.createDataFrame([(1, "\n".join([good, *bad, "ONE!! MORE!! SHOUT!!", "a$$$ b%%% c&&& d***"]))], "doc_id long, text string")).first()
    assert not row.kept


def test_shards(rows, none):
    got = shards.shuffle_into_shards(rows, 5, keys=["doc_id", "text"], block_rows=2).collect()
    sizes = {s: [r.slot for r in got if r.shard == s] for s in range(5)}
    assert sorted(len(x) for x in sizes.values()) == [3, 3, 3, 3, 4]
    assert all(sorted(x) == list(range(len(x))) for x in sizes.values())
    assert sorted(((r.doc_id, r.text) for r in got), key=repr) == sorted(ROWS, key=repr)
    assert shards.shuffle_into_shards(none, 5).count() == 0


def test_communication_matrix_law():
    draw = random.Random(4)
    sizes = [2000, 0, 7, 993]
    total = np.zeros((4, 3))
    for _ in range(300):
        m = shards.communication_matrix(draw, sizes, [1000, 1000, 1000])
        assert [sum(line) for line in m] == sizes and [sum(c) for c in zip(*m)] == [1000] * 3
        total += m
    assert np.allclose(total / 300, np.outer(sizes, [1000] * 3) / 3000, atol=6)
    wide = [shards.hypergeometric(draw, 10**10, 3 * 10**10, 4 * 10**8) for _ in range(400)]
    mean, spread = 10**8, (4 * 10**8 * 0.25 * 0.75 * (1 - 0.01)) ** 0.5
    assert abs(np.mean(wide) - mean) < 5 * spread / 20 and 0.85 < np.std(wide) / spread < 1.15


def test_line_dedup(spark, rows, none):
    got = line_dedup.deduplicate(rows)
    assert got.columns == [*rows.columns, "removed_lines"]
    # Rows with the same id and text are one document; the empty table and null texts change nothing.
    known = [(i, t) for i, t in ROWS if i is not None]
    order = [*{(i, t): None for i, t in known}]
    want = brute.deleted_lines(order)
    for r in got.collect():
        if r.doc_id is not None:
            assert list(r.removed_lines) == want.get(r.doc_id, [])
    assert 9 in want and 7 in want
    assert line_dedup.deduplicate(none).count() == 0


def test_line_dedup_random(spark):
    draw = random.Random(8)
    lines = [" ".join(draw.choices("abcdefg", k=draw.randint(0, 4))) for _ in range(6)]
    docs = [(i, "\n".join(draw.choices(lines, k=draw.randint(0, 60)))) for i in range(25)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    for least in (3, 11, 50):
        got = {r.doc_id: list(r.removed_lines) for r in line_dedup.deduplicate(df, min_words=least).collect()}
        want = brute.deleted_lines(docs, least)
        assert got == {i: want.get(i, []) for i, _ in docs}


def test_line_dedup_whole_runs(spark):
    draw = random.Random(9)
    lines = [" ".join(draw.choices("abcdefg", k=draw.choice((1, 2, 3, 4, 12)))) for _ in range(9)]
    run = draw.choices(lines, k=7)
    docs = [(i, "\n".join([*draw.choices(lines, k=draw.randint(0, 9)), *run[draw.randint(0, 3):]])) for i in range(12)]
    # A line with enough words by itself, then a short one that ends the repeated run.
    docs += [(100, f"{'x ' * 60}\nshort end\nonly here"), (101, f"new\n{'x ' * 60}\nshort end\n\nother")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    for least in (3, 11, 50):
        seen, want = set(), {i: set() for i, _ in docs}
        for i, text in docs:
            worded = [(n, x) for n, x in enumerate(text.split("\n")) if x.split()]
            for a in range(len(worded)):
                for b in range(a + 1, len(worded) + 1):
                    key = tuple(x for _, x in worded[a:b])
                    if sum(len(x.split()) for x in key) >= least:
                        want[i].update({*range(worded[a][0], worded[b - 1][0] + 1)} if key in seen else ())
                        seen.add(key)
        got = line_dedup.deduplicate(df, min_words=least, whole_runs=True).collect()
        assert {r.doc_id: set(r.removed_lines) for r in got} == want
        assert want[101] >= {1, 2}


def test_simhash(rows, none):
    got = simhash.near_duplicates(rows)
    named = {i: t for i, t in ROWS if i is not None}
    prints = {i: f"{brute.simhash(t):016x}" for i, t in named.items()}
    for r in got.collect():
        if r.doc_id is not None:
            assert f"{r.print & (1 << 64) - 1:016x}" == prints[r.doc_id]
        if r.print == 0:
            assert r.component_id == 2
    assert got.count() == len(ROWS)
    assert simhash.near_duplicates(none).count() == 0
    kept = [r.doc_id for r in simhash.keep_one(rows).collect()]
    assert 2 in kept and 3 not in kept and kept.count(6) == 1 and 7 not in kept


@pytest.mark.parametrize("part", [1 << 22, 1 << 8])
def test_near_links_find_every_pair(spark, monkeypatch, part):
    monkeypatch.setattr(simhash, "PART_VARIANTS", part)
    draw = random.Random(6)
    centres = [draw.getrandbits(64) for _ in range(12)]
    prints = {c ^ sum(1 << b for b in draw.sample(range(64), draw.randint(0, 9))) for c in centres for _ in range(12)}
    df = spark.createDataFrame([(p - (1 << 64) if p >> 63 else p,) for p in sorted(prints)], "print long")
    links = simhash.near_links(df)
    got = {r.node % (1 << 64): r.root % (1 << 64) for r in components.components(links).collect()}
    group = {p: p for p in prints}
    changed = True
    while changed:
        changed = False
        for a in prints:
            for b in prints:
                if (a ^ b).bit_count() <= 4 and group[a] != group[b]:
                    group[a] = group[b] = min(group[a], group[b])
                    changed = True
    classes = {}
    for p in prints:
        assert classes.setdefault(group[p], got.get(p, p)) == got.get(p, p)
    assert len(set(classes.values())) == len(classes)


def test_components(spark):
    draw = random.Random(7)
    edges = [(k, k + 1) for k in range(40)] + [(100, k) for k in range(101, 140)] + [(200, 200), (7, 7), (None, 3)]
    edges += [(draw.randint(300, 340), draw.randint(300, 340)) for _ in range(30)]
    got = {r.node: r.root for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert {got[k] for k in range(41)} == {0} and {got[k] for k in range(100, 140)} == {100} and got[200] == 200
    for a, b in edges[-30:]:
        assert got[a] == got[b] <= min(a, b)
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_language(spark, rows, none):
    train = spark.createDataFrame(
        [("en", "the house of the river and the garden"), ("de", "das haus an dem fluss und der garten"), (None, "x"),
         ("en", None)], "lang string, text string",
    )
    model = language_mix.learn(train)
    assert model.languages == ["de", "en"]
    got = language_mix.identify(rows, model).collect()
    assert len(got) == len(ROWS)
    for r in got:
        if r.doc_id in (2, 3, 4, 11):
            assert (r.lang_pred, r.score, r.languages) == ("und", 0.0, [])
        if r.doc_id in (5, 6):
            assert r.lang_pred == "en" and 0.5 < r.score <= 1
    mixed = spark.createDataFrame([(1, "the house of the river and the garden " * 9 + "das haus an dem fluss und der garten " * 6)],
                                  "doc_id long, text string")
    row = language_mix.identify(mixed, model).first()
    assert row.lang_pred == "en" and [x.lang for x in row.languages] == ["en", "de"] and abs(row.score - 0.6) < 0.1
    assert language_mix.identify(none, model).count() == 0
    empty = language_mix.learn(train.limit(0))
    assert {r.lang_pred for r in language_mix.identify(rows, empty).collect()} == {"und"}


def test_components_of_small_graphs_need_no_round_of_shuffles(spark, monkeypatch):
    """A graph that one task can see is put as stars there; a larger one takes rounds, with the same result."""
    chain = [(k, k + 1) for k in range(1, 300)] + [(500, 500), (700, 600), (None, 3)]
    want = {k: 1 for k in range(1, 301)} | {500: 500, 600: 600, 700: 600}
    edges = spark.createDataFrame(chain, "a long, b long").repartition(5)
    rounds, large = [], components._large_star
    monkeypatch.setattr(components, "_large_star", lambda x: rounds.append(1) or large(x))
    assert {r.node: r.root for r in components.components(edges).collect()} == want
    assert not rounds
    monkeypatch.setattr(components, "TOGETHER", 50)
    monkeypatch.setattr(components, "_as_stars", lambda x: x)
    assert {r.node: r.root for r in components.components(edges).collect()} == want
    assert rounds


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_white_space_met_at_a_text_end_is_still_odd_inside_a_later_text(name):
    """A last piece that ends in a tab is remembered; inside another text no cut may follow it."""
    encoder = PieceEncoder(vocabulary(name))
    for texts in (["x foo\t"], ["x foo\t y", "", None, " ", "a  b", "x foo\t\n y"], ["plain text.", "x foo\t   y z"]):
        want = [encoder.model.encode(t or "", add_special_tokens=False).ids for t in texts]
        assert [c.tolist() for c in encoder.encode(texts)] == want
