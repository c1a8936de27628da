import json

import pytest
from pyspark.sql import functions as F

from textkiln.operators import merge
from textkiln.sources import jsonl, providers
from textkiln.streaming import resume


def lines(path, *rows):
    path.write_text("\n".join(rows) + "\n")
    return str(path)


def test_tolerant_scan(spark, tmp_path):
    path = lines(tmp_path / "a.jsonl", '{"chapter_num":7}', '{"chapter_num":"A"}', "not json", "", "[1,2]", '{"other":1}')
    assert sorted(r[0] or "" for r in jsonl.tolerant_scan(spark, path, "chapter_num string").collect()) == ["", "7", "A"]
    with pytest.raises(Exception, match="(?i)malformed"):
        jsonl.strict_scan(spark, path, "chapter_num string").collect()


def test_shards_and_merge(spark, tmp_path):
    row = lambda v: json.dumps({"k": "x", "v": v})
    lines(tmp_path / "seeds_spark.jsonl", row("s"), '{"k": "y", "v": "t"}')
    lines(tmp_path / "seeds_mac.jsonl", row("m1"), row("m2"))
    rows = jsonl.shards(spark, str(tmp_path / "seeds_*.jsonl"), "k string, v string")
    out = merge.merge([rows], ["k"], ["file_path", "line_no"])
    assert sorted((r["k"], r["v"], r["qa_id"]) for r in out.collect()) == [("x", "m1", "qa_00001"), ("y", "t", "qa_00002")]


def test_file_facts(spark, tmp_path):
    path = lines(tmp_path / "a.jsonl", '{"a":1}', " ", '{"a":2}')
    assert jsonl.count_lines(spark, path) == 2
    assert jsonl.newest(spark, str(tmp_path / "*.jsonl")).endswith("a.jsonl")
    assert jsonl.file_sizes(spark, path).count() == 1
    doc = tmp_path / "q.json"
    doc.write_text('[{"id": "F-01",\n "keywords": ["a"]}]')
    assert jsonl.document(spark, str(doc), "id string, keywords array<string>").first()["id"] == "F-01"


def test_report_sink(spark, tmp_path):
    summary = spark.createDataFrame([(0.5,)], "ft_avg double")
    questions = spark.createDataFrame([("b", 1.0), ("a", 0.2)], "id string, score double")
    jsonl.write_report(summary, questions, str(tmp_path / "r"))
    row = spark.read.json(str(tmp_path / "r")).first()
    assert row["ft_avg"] == 0.5 and [q["id"] for q in row["questions"]] == ["a", "b"]


def test_projection_of_nothing_is_an_error(spark):
    with pytest.raises(ValueError, match="no row"):
        jsonl.text_projection(spark.createDataFrame([(None,)], "text string"))


def test_pages(spark):
    df = spark.createDataFrame([(1, 2, "b"), (1, 1, "a"), (1, 3, None)], "d int, n int, text string")
    assert jsonl.join_pages(df, "d", "n").first()["text"] == "a\nb\n"


def test_providers(spark):
    df = spark.createDataFrame([("p",), (None,)], "prompt string")
    assert [r["reply"] for r in providers.generate(df, providers.provider("stub", answer="x")).collect()] == ["x", "x"]
    assert providers.ChatServer("http://127.0.0.1:9/x", "m", 0.2).generate("a", "b", 0.1) == ""
    with pytest.raises(ValueError, match="no provider"):
        providers.provider("other")


def test_binary_as_base64(spark):
    assert spark.range(1).select(jsonl.binary_as_base64(F.lit(b"ab")).alias("b")).first()["b"] == "YWI="


def test_pdf_texts_take_any_extractor(spark, tmp_path):
    from textkiln.sources import pdf

    (tmp_path / "a.pdf").write_bytes(b"%PDF words")
    row = pdf.pdf_texts(spark, str(tmp_path / "*.pdf"), lambda c: c.decode().lower()).first()
    assert row["text"] == "%pdf words" and row["path"].endswith("a.pdf")


def test_write_modes(spark, tmp_path):
    path = str(tmp_path / "out")
    one, two = (spark.createDataFrame([(v,)], "v string") for v in "ab")
    read = lambda: sorted(r["v"] for r in spark.read.schema("v string").json(path).collect())
    for rows, mode, want in ((one, "overwrite", "a"), (two, "ignore", "a"), (two, "append", "ab"), (two, "overwrite", "b")):
        jsonl.write(rows, path, mode)
        assert read() == list(want)


def test_live_counts(spark, tmp_path):
    source = str(tmp_path / "in")
    spark.createDataFrame([("x",), ("y",), ("x",)], "k string").write.parquet(source)
    query = resume.live_counts(resume.read_stream(spark, source, "k string"), "k", "live_counts_test", every="0 seconds")
    try:
        query.processAllAvailable()
        assert sorted(map(tuple, spark.table("live_counts_test").collect())) == [("x", 2), ("y", 1)]
    finally:
        query.stop()
