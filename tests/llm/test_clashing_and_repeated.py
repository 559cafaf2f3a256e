"""Columns whose names clash with inner ones, repeated ids, long runs: what the
operators must not stumble over."""

import time

from pyspark.sql import functions as F

from gridspark.llm import bpe, chat, linededup, mixing, quality, simhash, warc

A, B = "<p>one</p>" * 150, "<p>two</p>" * 150


def test_warc_ids_repeated_with_several_payloads(spark):
    pages = spark.createDataFrame([(5, A), (5, B), (6, A), (7, B), (None, A), (None, B), (5, A)], "page_id long, html string").withColumn("url", F.lit("u")).withColumn("digest", F.lit("x"))
    got = sorted((r.page_id or -1, r.record_type, r.refers_to or -1) for r in warc.round_trip(pages).collect())
    assert got == sorted([(5, "revisit", 6), (5, "revisit", 6), (5, "revisit", 7), (6, "response", -1), (7, "response", -1), (-1, "revisit", 6), (-1, "revisit", 7)])


def clashing(spark, rows, *names):
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    return df.select("*", *[F.lit(k).alias(n) for k, n in enumerate(names)])


ROWS = [(1, "some words are here to be read", "a"), (2, "some words are here to be read", "b"), (3, "quite another text stands in this row", "b"), (None, None, None)]


def test_mixing_columns(spark):
    df = clashing(spark, ROWS, "__size", "__target", "__copy", "__source", "__SIZE_")
    assert mixing.mix(df).columns == df.columns
    assert {r.doc_id: r.taken for r in mixing.mixed(df).collect()} == {r.doc_id: r.taken for r in mixing.mixed(df.select("doc_id", "text", "source")).collect()}


def test_mixing_long_text(spark):
    df = clashing(spark, [(1, "word " * 400_000, "a"), (2, "a b", "b")])
    got = {r.doc_id: r["size"] for r in mixing.mixed(df).collect()}
    assert got == {1: 400_000, 2: 2}


def test_line_dedup_columns(spark):
    line = "a line that is longer than twenty characters"
    df = clashing(spark, [(1, line, "a"), (2, line + "\nx", "b"), (None, None, None)], "__d", "__key", "__keep", "lines_removed")
    out = linededup.dedup_lines(df)
    assert out.columns == df.columns
    assert {r.doc_id: (r.text, r.lines_removed) for r in out.collect()} == {1: (line, 0), 2: ("x", 1), None: (None, 0)}


def test_line_dedup_long_text(spark):
    long = "\n".join(f"line number {k} of a long text" for k in range(30_000))
    df = clashing(spark, [(1, long, "a"), (2, "own\n" + long, "b"), (3, "line number 7 of a long text\n" * 20_000, "c")])
    assert {r.doc_id: (r.text, r.lines_removed) for r in linededup.dedup_lines(df).select("doc_id", "text", "lines_removed").where("doc_id > 1").collect()} == {2: ("own", 30_000), 3: ("", 20_000)}


def test_nothing_goes_without_alignment(monkeypatch):
    a, b = ["one line that is long enough", "x"], ["y", "one line that is long enough"]
    assert linededup.blocks(a, b) == [1]
    monkeypatch.setattr(linededup, "patience", lambda a, b: [])
    assert linededup.blocks(a, b) == []


def test_simhash_and_quality_columns(spark):
    df = clashing(spark, ROWS, "__kept", "__kept_")
    out = simhash.dedup(df)
    assert out.columns == df.columns and {r.doc_id for r in out.collect()} == {1, 3, None}
    labels = spark.createDataFrame([(1, 1, 0), (3, 0, 0)], "doc_id long, quality int, toxic int")
    out = quality.select(df, labels)
    assert out.columns == df.columns and out.count() <= 4


def test_chat_runs_of_backslashes():
    for text in ("\\" * 1_000_000, "\\" * 500_000 + "</s>" + "\\" * 500_000, "\\</s>" * 100_000):
        began = time.time()
        s, spans = chat.format_turns([("assistant", text)])
        assert chat.parse(s)[0] == [("assistant", text)] and len(spans) == 1
        assert time.time() - began < 20


def test_words_kept_are_short():
    words = bpe._Words(lambda x: b"1234")
    assert words["a" * bpe.LONGEST] == words["b" * 1000] == b"1234" and set(words) == {"a" * bpe.LONGEST}
