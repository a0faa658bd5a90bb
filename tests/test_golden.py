"""Edge cases of the scalar rules, row by row."""

import pytest
from pyspark.sql import functions as F

from corpusloom import fixed
from corpusloom.functions import arrays, layout, predicates, text
from corpusloom.operators.chunk import chunk_text
from corpusloom.operators.pack import pack_rows
from corpusloom.operators.report import ema
from corpusloom.operators.sample import head_by_bytes
from corpusloom.operators.order import cluster_greedy, cluster_grid


def apply(spark, rule, values, kind="string"):
    df = spark.createDataFrame(list(enumerate(values)), f"i int, v {kind}")
    return [r.out for r in df.select("i", rule(F.col("v")).alias("out")).orderBy("i").collect()]


SANITIZE = {
    None: "", "": "", "  a \n": "a", " a　\u001c": "a",
    "<|im_start|>user\nhi<|im_end|>": "hi",
    "<|im_start|>user hi": "<|im_start|>user hi",
    "a<|im_start|>x\r y\nb": "ab",
    "<|begin_of_<|im_end|>text|>z": "z",
    "<|endof<|begin_of_text|>text|>z": "<|endoftext|>z",
    "<s>k</s>": "<s>k</s>",
    "<|start_header_id|>user<|end_header_id|>\n\nq<|eot_id|>": "user\n\nq",
}


def test_sanitize(spark):
    assert apply(spark, text.sanitize_text, list(SANITIZE)) == list(SANITIZE.values())


def test_strip_is_pythons(spark):
    values = [f"{c} x {c}" for c in fixed.WHITESPACE] + ["​x​", "﻿x"]
    assert apply(spark, text.py_strip, values) == [v.strip() for v in values]
    assert set(fixed.WHITESPACE) == {chr(i) for i in range(0x11000) if chr(i).isspace()}


def test_letter_profile(spark):
    values = {
        "і" * 49: False, "і" * 50: True, "І" * 50: True, "a" * 50: False, "і" * 99 + "и": True,
        "і" * 98 + "ии": False, "і" * 49 + "и": False, None: False, "": False,
    }
    assert apply(spark, predicates.letter_profile, list(values)) == list(values.values())


def test_layouts(spark):
    assert apply(spark, layout.format_pretrain, ["x" * 299, "x" * 300, None]) == ["", f"<s>{'x' * 300}</s>\n", ""]
    df = spark.createDataFrame([("", "u", ""), ("", "u", "a"), ("S", " u\n", "a")], "s string, u string, a string")
    got = [r[0] for r in df.select(layout.format_instruct(F.col("s"), F.col("u"), F.col("a"))).collect()]
    assert got == [
        "", "<s>System: Ты разумны памочнік.\n\n### User: u\n\n### Assistant: a</s>\n",
        "<s>System: S\n\n### User: u\n\n### Assistant: a</s>\n",
    ]
    df = spark.createDataFrame([("i", None), (None, "x")], "i string, x string")
    assert [r[0] for r in df.select(layout.join_prompt(F.col("i"), F.col("x"), "\n")).collect()] == ["i\n", "\nx"]


def test_answer_is_the_last(spark):
    end = "assistant<|end_header_id|>\n\n"
    said = ["no header<|eot_id|>", f"a{end}b{end}c<|eot_id|><|end_of_text|>"]
    assert apply(spark, layout.extract_answer, said) == ["no header", "c"]


def test_utf8_and_lines(spark):
    raw = [b"a\xffb", "ok � é".encode(), b"\xe2\x82x", b"\xf0\x9f\x98\x80"]
    want = ["ab", "ok � é", "x", "😀"]
    assert apply(spark, lambda c: text.drop_invalid_utf8(c.cast("string")), raw, "binary") == want
    assert apply(spark, text.split_lines, ["a\r\n\n b\rc\n \n"]) == [["a", " b\rc", " "]]
    assert apply(spark, text.normalize_nfc, ["é a  b", r"a\s+b", None, "plain"]) == ["é a  b", "a b", None, "plain"]


CHUNKS = {
    "aaa\n\nb\n": ["aaa\n\nb\n"],
    "aaaaa\n\nb\n\ncccc\n": ["aaaaa\n", "b\n\ncccc\n"],
    "\n\naaaa": ["\n\naaaa"],
    "aaaa\n  \nbb\n\n\ncccc\n": ["aaaa\n", "bb\n\n\ncccc\n"],
    "ab\n\n\n\ncd": ["ab\n\n\n"],
    "aaaaa\r\n\rb": ["aaaaa\n"],
    "": [],
}


def test_chunks(spark):
    assert apply(spark, lambda c: chunk_text(c, 4), list(CHUNKS)) == list(CHUNKS.values())


def test_head_by_bytes(spark):
    def head(lines, limit):
        df = spark.createDataFrame([("f", i, v) for i, v in enumerate(lines)], "file string, line_no long, line string")
        return [r.line for r in head_by_bytes(df, limit).orderBy("line_no").collect()]

    assert head(["aaa", " ", "bbb", "é", "c"], 8) == ["aaa", "bbb", "é"]
    assert head(["aaa", "bbb", "é", "c"], 7) == ["aaa", "bbb"]


def test_token_arrays(spark):
    ids = [[5, 6, 2, 2, 7, 2, 9], [2], [], None]
    spans = apply(spark, arrays.eos_spans, ids, "array<int>")
    assert [[(s[0], s[1]) for s in row or []] for row in spans] == [[(1, 3), (4, 4), (5, 6), (7, 7)], [(1, 1)], [], []]
    assert apply(spark, arrays.pack_u16, [[1, 65535], []], "array<int>") == [b"\x01\x00\xff\xff", b""]
    assert apply(spark, arrays.unpack_u16, [b"\x01\x00\xff\xff\x07", b""], "binary") == [[1, 65535], []]
    with pytest.raises(Exception, match="16 bits"):
        apply(spark, arrays.pack_u16, [[65536]], "array<int>")


def test_clusters(spark):
    sizes = spark.createDataFrame([(i, 3) for i in range(6)], "doc_id long, n_tokens long")
    greedy = cluster_greedy(sizes, limit_bytes=10).orderBy("doc_id").collect()
    assert [r.cluster for r in greedy] == [0, 0, 1, 1, 2, 2]
    grid = cluster_grid(sizes, "n_tokens", limit_bytes=10).orderBy("doc_id").collect()
    assert [r.cluster for r in grid] == [0, 0, 1, 1, 2, 3]


def test_packing(spark):
    docs = spark.createDataFrame([(0, list(range(1, 6))), (1, []), (2, list(range(6, 23)))], "doc_id long, ids array<int>")

    def rows(**options):
        return [(r.batch_id, r.input_ids, r.labels) for r in pack_rows(docs, 3, 2, **options).orderBy("row_id").collect()]

    starts = [(1, 0), (5, 0), (9, 1), (13, 1), (17, 2)]
    assert rows() == [(b, [s, s + 1, s + 2], [s + 1, s + 2, s + 3]) for s, b in starts]
    starts = [(1, 0), (5, 0), (11, 1), (15, 1)]
    assert rows(discard_per_batch=True) == [(b, [s, s + 1, s + 2], [s + 1, s + 2, s + 3]) for s, b in starts]
    nothing = docs.filter("doc_id > 9")
    assert pack_rows(nothing, 3, 2).count() == 0


def test_ema(spark):
    rows = [(1, i, float(x)) for i, x in enumerate([4, 3, 2, 1])]
    got = ema(spark.createDataFrame(rows, "run_id long, step long, loss double")).orderBy("step").collect()
    assert [round(r.avg_loss, 6) for r in got] == [4, 3.95, 3.8525, 3.709875]
    # A run of many blocks against the plain loop.
    values = [((i * 7919) % 1000) / 10 for i in range(5000)]
    want, avg = [], values[0]
    for i, x in enumerate(values):
        avg = x if i == 0 else 0.95 * avg + 0.05 * x
        want.append(avg)
    df = spark.createDataFrame([(1, i, x) for i, x in enumerate(values)], "run_id long, step long, loss double")
    got = [r.avg_loss for r in ema(df).orderBy("step").collect()]
    assert max(abs(a - b) for a, b in zip(got, want)) < 1e-9
