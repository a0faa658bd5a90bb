"""Files in and out."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusloom.plans.prepare import PLACE, document_parts, prepare_tokens
from corpusloom.plans.training import inspect_tokens
from corpusloom.operators.filters import write_quarantine
from corpusloom.sources.tables import read_cluster_sample, read_docs_parquet, read_vocab, spread_small, unreadable_files
from corpusloom.sources.text import read_text_lines, write_mixed_text
from corpusloom.sources.tokenbin import read_token_shards, write_token_shards


def test_text_lines(spark, tmp_path):
    (tmp_path / "deep").mkdir()
    (tmp_path / "a.txt").write_bytes("é\r\nb\rc\n\n d".encode())
    (tmp_path / "deep" / "b.md").write_bytes(b"x\xff\xfey\nlast\n")
    (tmp_path / "deep" / "c.bin").write_bytes(b"not text")
    (tmp_path / "empty.csv").write_bytes(b"")
    (tmp_path / "cr.py").write_bytes(b"p\rq\r")
    got = {}
    for r in read_text_lines(spark, str(tmp_path)).orderBy("file", "line_no").collect():
        got.setdefault(r.file.rsplit("/", 1)[-1], []).append((r.line_no, r.line, r.newline))
    assert got == {
        "a.txt": [(0, "é", True), (1, "b", True), (2, "c", True), (3, "", True), (4, " d", False)],
        "b.md": [(0, "xy", True), (1, "last", True)],
        "cr.py": [(0, "p", True), (1, "q", True)],
    }
    one = read_text_lines(spark, str(tmp_path / "deep" / "c.bin"), extensions=None).collect()
    assert [(r.line, r.newline) for r in one] == [("not text", False)]


def test_line_numbers_across_read_blocks(spark, tmp_path):
    lines = [f"line {i}" * (i % 5 + 1) for i in range(3000)]
    (tmp_path / "big.txt").write_text("\n".join(lines) + "\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "5000")
    try:
        rows = read_text_lines(spark, str(tmp_path)).orderBy("line_no").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert [r.line for r in rows] == lines and [r.line_no for r in rows] == list(range(3000))
    assert all(r.newline for r in rows)


def test_mixed_text_keeps_order_and_newlines(spark, tmp_path):
    rows = [(0, 1, "<s>b\n\nc</s>\n"), (0, 0, "<s>a</s>\n"), (1, 0, ""), (1, 1, "<s>d\n</s>\n")]
    write_mixed_text(spark.createDataFrame(rows, "block int, rank int, formatted string"), str(tmp_path / "out"))
    parts = sorted((tmp_path / "out").glob("part-*"))
    assert "".join(p.read_text() for p in parts) == "<s>a</s>\n<s>b\n\nc</s>\n<s>d\n</s>\n"


def test_broken_parquet_is_skipped(spark, tmp_path):
    spark.createDataFrame([("a",), (None,)], "text string").write.parquet(str(tmp_path / "d"))
    good = next((tmp_path / "d").glob("part-*.parquet"))
    (tmp_path / "d" / "broken.parquet").write_bytes(good.read_bytes()[:20])
    (tmp_path / "d" / "note.txt").write_text("not a table")
    assert [r.text for r in read_docs_parquet(spark, str(tmp_path / "d")).collect()] == ["a"]


def test_token_shards(spark, tmp_path):
    path = str(tmp_path / "shards")
    rows = [(i, [3 + i % 5] * (i % 9) + [65535, 2]) for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, ids array<int>")
    for _ in range(2):  # the second write replaces the first
        write_token_shards(docs, path, order=["doc_id"], shard_bytes=256)
    files = sorted((tmp_path / "shards").iterdir())
    assert len(files) > 8 and all(f.suffix == ".bin" for f in files)
    flat = np.concatenate([np.frombuffer(f.read_bytes(), "<u2") for f in files])
    assert flat.tolist() == [t for _, ids in rows for t in ids]
    back = read_token_shards(spark, path, range_bytes=100).orderBy("shard", "start").collect()
    assert [r.ids for r in back] == [ids for _, ids in rows]
    single = tmp_path / "one.bin"
    single.write_bytes(flat[:-1].tobytes() + b"x")  # no end marker at the end, and an odd byte
    back = read_token_shards(spark, str(single), range_bytes=64).orderBy("start").collect()
    assert [r.ids for r in back] == [ids for _, ids in rows[:-1]] + [rows[-1][1][:-1]]
    assert read_token_shards(spark, str(single)).select(F.sum(F.size("ids"))).first()[0] == len(flat) - 1
    (tmp_path / "none").mkdir()
    assert read_token_shards(spark, str(tmp_path / "none")).count() == 0
    with pytest.raises(Exception, match="16 bits"):
        write_token_shards(spark.createDataFrame([([70000],)], "ids array<int>"), path)


def test_prepare_keeps_every_document(spark, tmp_path):
    texts = [f"<s>doc {i} low lower\nlowest {i * 7}</s>" for i in range(40)]
    (tmp_path / "text").mkdir()
    (tmp_path / "text" / "a.txt").write_text("\n".join(texts[:25]) + "\n")
    (tmp_path / "text" / "b.txt").write_text("\n".join(texts[25:]))
    work = str(tmp_path / "work")
    docs = prepare_tokens(spark, str(tmp_path / "text"), work, seed=1, size=330)
    vocab, merges = read_vocab(spark, f"{work}/tokenizer")
    assert vocab.count() <= 330 and merges.count() > 0
    named = docs.withColumn("doc_id", F.monotonically_increasing_id())
    shown = inspect_tokens(named, vocab, 0, 10**6).collect()
    want = sorted(t.replace("\n", " ") for t in texts)
    assert sorted(r.text for r in shown) == want
    # A second run finds the tokenizer and gives the same shards.
    again = prepare_tokens(spark, str(tmp_path / "text"), work, seed=1, size=330)
    assert sorted(map(tuple, (r.ids for r in again.collect()))) == sorted(map(tuple, (r.ids for r in docs.collect())))


def test_quarantine_table(spark, tmp_path):
    df = spark.createDataFrame([(1, None), (2, "short")], "doc_id long, reason string")
    write_quarantine(df, str(tmp_path / "q"))
    assert {(r.doc_id, r.reason) for r in spark.read.parquet(str(tmp_path / "q")).collect()} == {(1, "ok"), (2, "short")}


def test_only_small_tables_are_spread(spark, tmp_path):
    spark.range(100).write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    assert spread_small(df, str(tmp_path / "t"), "id", limit=1) is df
    assert spread_small(df, str(tmp_path / "t"), "id").rdd.getNumPartitions() > 0


def test_text_without_end_markers_is_written_and_read_by_many(spark, tmp_path):
    lines = [f"word {i} low lower lowest" for i in range(300)]
    (tmp_path / "text").mkdir()
    (tmp_path / "text" / "a.txt").write_text("\n".join(lines))
    work = str(tmp_path / "work")
    whole = prepare_tokens(spark, str(tmp_path / "text"), work, seed=3, size=330).collect()
    assert len(whole) == 1 and whole[0].start == 0
    # A small table makes one task; with its ranges kept apart it is written as a large one is.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        parts = document_parts(spark.read.parquet(f"{work}/lines"))
        write_token_shards(parts, f"{work}/spread", order=["doc_id", *PLACE], document=True, shard_bytes=300)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    names = sorted(p.name for p in (tmp_path / "work" / "spread").glob("*.bin"))
    assert len({n.split("-")[1] for n in names}) > 2 and len(names) >= 8
    assert [list(r.ids) for r in read_token_shards(spark, f"{work}/spread").collect()] == [list(whole[0].ids)]
    cut = read_token_shards(spark, f"{work}/spread", piece_tokens=100, range_bytes=150).orderBy("shard", "start").collect()
    assert [t for r in cut for t in r.ids] == list(whole[0].ids)
    assert [r.opens for r in cut] == [True] + [False] * (len(cut) - 1) and max(len(r.ids) for r in cut) <= 200
    vocab, _ = read_vocab(spark, f"{work}/tokenizer")
    text = inspect_tokens(spark.createDataFrame([(1, list(whole[0].ids))], "doc_id long, ids array<int>"), vocab, 0, 10**6)
    assert text.first().text == " ".join(lines)


def test_one_long_document_among_short_ones_crosses_shards(spark, tmp_path):
    path = str(tmp_path / "shards")
    rows = [(0, k, [7, 2]) for k in range(5)] + [(1, k, [9] * 40) for k in range(200)] + [(1, 200, [2])]
    rows += [(2, k, [5, 2]) for k in range(5)]
    parts = spark.createDataFrame(rows, "doc_id long, k int, ids array<int>").repartition(4)
    write_token_shards(parts, path, order=["doc_id", "k"], document=True, shard_bytes=1000)
    files = sorted((tmp_path / "shards").glob("*.bin"))
    assert len(files) > 5 and max(f.stat().st_size for f in files) <= 2_200
    back = read_token_shards(spark, path, range_bytes=300).orderBy("shard", "start").collect()
    assert [list(r.ids) for r in back] == [[7, 2]] * 5 + [[9] * 8_000 + [2]] + [[5, 2]] * 5
    assert all(r.opens for r in back)
    pieces = read_token_shards(spark, path, range_bytes=300, piece_tokens=50).orderBy("shard", "start").collect()
    assert [t for r in pieces for t in r.ids] == [t for r in back for t in r.ids]
    assert sum(r.opens for r in pieces) == 11 and max(len(r.ids) for r in pieces) < 300


@pytest.mark.parametrize("form", ["file:{}", "file://{}", "relative"])
def test_paths_as_other_readers_take_them(spark, tmp_path, monkeypatch, form):
    monkeypatch.chdir(tmp_path)
    path = "shards" if form == "relative" else form.format(tmp_path / "shards")
    write_token_shards(spark.createDataFrame([(1, [3, 2])], "doc_id long, ids array<int>"), path, ["doc_id"])
    assert [list(r.ids) for r in read_token_shards(spark, path).collect()] == [[3, 2]]
    assert list((tmp_path / "shards").glob("*.bin"))


def test_long_documents_are_read_in_pieces():
    import io

    from corpusloom.sources import tokenbin

    flat = np.array([7] * 50 + [2] + [8] * 400 + [2, 9, 2] + [5] * 90, "<u2")
    chunk, tokenbin.CHUNK_BYTES = tokenbin.CHUNK_BYTES, 64
    try:
        got = []
        for first, limit in ((0, 100), (100, 460), (460, len(flat))):
            stream = tokenbin._Stream([(io.BytesIO(flat.tobytes()), len(flat))])
            for start, docs, fresh in tokenbin._documents(stream, first, limit, 2, 100):
                for doc in docs:
                    got.append((start, doc.tolist()))
                    start += len(doc)
    finally:
        tokenbin.CHUNK_BYTES = chunk
    assert [t for _, doc in sorted(got) for t in doc] == flat.tolist()
    assert max(len(doc) for _, doc in got) < 140 and all(flat[a : a + len(d)].tolist() == d for a, d in got)


def test_interrupted_overwrite_keeps_the_old_shards(spark, tmp_path):
    path = str(tmp_path / "shards")
    write_token_shards(spark.createDataFrame([(i, [3, 2]) for i in range(9)], "doc_id long, ids array<int>"), path, ["doc_id"])
    before = sorted(p.name for p in (tmp_path / "shards").iterdir())
    with pytest.raises(Exception, match="16 bits"):
        write_token_shards(spark.createDataFrame([(1, [70000])], "doc_id long, ids array<int>"), path, ["doc_id"])
    assert sorted(p.name for p in (tmp_path / "shards").iterdir() if p.name.endswith(".bin")) == before


def test_only_shards_of_the_stretch_are_opened(spark, tmp_path):
    from corpusloom.sources.tokenbin import TokenReader, peek_shards

    path = str(tmp_path / "shards")
    rows = [(i, [3 + i % 5] * (i % 9) + [2]) for i in range(300)]
    write_token_shards(spark.createDataFrame(rows, "doc_id long, ids array<int>"), path, ["doc_id"], shard_bytes=200)
    flat = [t for _, ids in rows for t in ids]
    for start, n in ((0, 10), (431, 200), (len(flat) - 5, 50), (len(flat) + 3, 4), (90, 0)):
        got = peek_shards(spark, path, start, n, range_bytes=60).orderBy("start").collect()
        assert [t for r in got for t in r.ids] == flat[start : start + n]
        assert all(flat[r.start : r.start + len(r.ids)] == list(r.ids) for r in got)
        assert all(r.opens == (r.start == 0 or flat[r.start - 1] == 2) for r in got)
    reader = TokenReader({"path": f"file://{path}", "peek_from": "431", "peek_to": "631"})
    assert len({p.path for p in reader.partitions()}) <= 4 and len(list((tmp_path / "shards").iterdir())) > 12
    (tmp_path / "shards" / "part-999999-00000.bin").write_bytes(b"")  # an empty file holds no part of any stretch
    assert [t for r in peek_shards(spark, path, 431, 200).orderBy("start").collect() for t in r.ids] == flat[431:631]


def test_files_past_the_cap_are_not_read(spark, tmp_path):
    path = tmp_path / "d"
    for k in range(8):
        spark.range(k * 100, k * 100 + 50, numPartitions=1).withColumn("k", F.lit(k)).write.parquet(str(path / f"f{k}"))
    name = F.regexp_extract("file", "/(f[0-9])/", 1)
    rows = read_cluster_sample(spark, str(path), 120, 5, name)
    got = sorted((r.nth, r.id) for r in rows.collect())
    assert [n for n, _ in got] == list(range(120))
    order = [i // 100 for _, i in got]
    files = list(dict.fromkeys(order))
    assert order == [files[0]] * 50 + [files[1]] * 50 + [files[2]] * 20
    assert {i % 100 for _, i in got[:50]} == set(range(50))
    assert {f.split("/")[-2] for f in rows.inputFiles()} == {f"f{k}" for k in files}
    assert read_cluster_sample(spark, str(path), 10_000, 5, name).count() == 400
    import hashlib

    keys = sorted(range(8), key=lambda k: hashlib.md5(f"5:f{k}".encode()).hexdigest())
    assert files == keys[:3]


def test_skipped_files_are_listed(spark, tmp_path):
    spark.createDataFrame([("a",), (None,)], "text string").write.parquet(str(tmp_path / "d"))
    good = next((tmp_path / "d").glob("part-*.parquet"))
    (tmp_path / "d" / "broken.parquet").write_bytes(good.read_bytes()[:40])
    (tmp_path / "d" / "tiny.parquet").write_bytes(b"PAR1")
    (tmp_path / "d" / "empty.parquet").write_bytes(b"")
    lost = {r.file.rsplit("/", 1)[-1]: (r.bytes, r.reason) for r in unreadable_files(spark, str(tmp_path / "d")).collect()}
    assert lost == {"broken.parquet": (40, "unreadable"), "tiny.parquet": (4, "cut short")}
    import gzip

    (tmp_path / "t").mkdir()
    (tmp_path / "t" / "a.txt").write_text("one\n")
    (tmp_path / "t" / "b.txt.gz").write_bytes(gzip.compress(b"two\n"))
    (tmp_path / "t" / "c.txt.gz").write_bytes(b"not compressed at all")
    lost = unreadable_files(spark, str(tmp_path / "t"), "text").collect()
    assert [r.file.rsplit("/", 1)[-1] for r in lost] == ["c.txt.gz"]
