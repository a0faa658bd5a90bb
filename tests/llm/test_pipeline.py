"""The pipeline against plain restatements of its stages, and on rows with nulls, repeats and nothing at all."""

import random
import shutil

import corpus_pipeline as pipeline

from . import brute
from .test_queries import tokenizer

FOLDER = "/root/testdata/sf0.001"


def plain_run(docs, bench):
    kept = [(i, t) for i, t in docs if t and any(c.isalpha() for c in t)]
    gone = brute.deleted_lines(kept)
    cut = []
    for i, t in kept:
        left = "\n".join(x for k, x in enumerate(t.split("\n")) if k not in set(gone.get(i, [])))
        if i not in gone or brute.blank_words(left):
            cut.append((i, left))
    groups = brute.similar_groups(cut)
    one = [(i, t) for i, t in cut if groups[i] == i]
    leaked = {d for d, _ in brute.leaks(one, bench)}
    return [(i, t) for i, t in one if i not in leaked]


def test_pipeline_against_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").orderBy("doc_id").collect()]
    bench = [(r.item_id, r.text) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    want = plain_run(docs, bench)
    assert len(want) < len(docs)
    model = tokenizer("word_bpe_49k.json")
    tokens = {i: len(model.encode(t, add_special_tokens=False).ids) + 1 for i, t in want}
    got = pipeline.run(spark, FOLDER).collect()
    assert {r.doc_id: r.doc_tokens for r in got} == tokens
    assert sum(r.length for r in got) == sum(tokens.values())


def test_stages_keep_columns_and_take_odd_rows(spark, tmp_path):
    shutil.copy(f"{FOLDER}/benchmark.parquet", tmp_path)
    rows = [(1, "one two three four\nfive", "en", "a", 23), (1, "one two three four\nfive", "en", "a", 23), (2, None, None, None, None),
            (3, "", "de", "a", 0), (None, "some text without an id", "en", "b", 23), (4, "12 34 !!", "fr", "b", 8)]
    layout = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    for data, least in ((rows, 1), ([], 0)):
        docs = spark.createDataFrame(data, layout)
        for name, stage in pipeline.STAGES:
            path = str(tmp_path / f"{name}-{least}")
            stage(spark, docs, str(tmp_path)).write.parquet(path)
            docs = spark.read.parquet(path)
            assert name == "pack" or docs.columns == pipeline.COLUMNS
        assert docs.count() >= least


def lines_of_repeated_runs(docs, least=50):
    """docs: (id, text) in order of id. Every line of every run of ``least`` words or more whose lines stand earlier."""
    seen, gone = set(), {i: set() for i, _ in docs}
    for i, text in docs:
        worded = [(n, x) for n, x in enumerate(text.split("\n")) if brute.blank_words(x)]
        for a in range(len(worded)):
            for b in range(a + 1, len(worded) + 1):
                run = tuple(x for _, x in worded[a:b])
                if sum(len(brute.blank_words(x)) for x in run) >= least:
                    if run in seen:
                        gone[i] |= {*range(worded[a][0], worded[b - 1][0] + 1)}
                    seen.add(run)
    return gone


def test_line_stage_deletes_every_line_of_a_repeated_run(spark):
    """Also short lines at its end, where the line before them has enough words by itself."""
    draw = random.Random(11)
    lines = [" ".join(draw.choices("abcdefg", k=draw.choice((1, 3, 20, 30, 55)))) for _ in range(14)]
    run = draw.choices(lines, k=8)
    docs = [(i, "\n".join([*draw.choices(lines, k=draw.randint(0, 6)), *run[draw.randint(0, 4):], f"own line {i}"])) for i in range(14)]
    docs += [(100, f"{'x ' * 60}\nshort end\nonly here"), (101, f"new\n{'x ' * 60}\nshort end\n\nother"), (102, f"{'x ' * 60}\nshort end")]
    df = spark.createDataFrame([(i, t, "en", "a", len(t)) for i, t in docs], "doc_id long, text string, lang string, source string, n_chars long")
    got = {r.doc_id: (r.text, r.n_chars) for r in pipeline.dedup_lines(spark, df, "").collect()}
    gone = lines_of_repeated_runs(docs)
    left = {i: "\n".join(x for n, x in enumerate(t.split("\n")) if n not in gone[i]) for i, t in docs}
    assert got == {i: (t, len(t)) for i, t in left.items() if not gone[i] or brute.blank_words(t)}
    assert left[101] == "new\n\nother" and 102 not in got
