"""Streams: keys written once, tokens split as they come."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from textkiln.functions import text as T
from textkiln.streaming import resume, tokens


def written(spark, path):
    return sorted(((r["k"], r["v"]) for r in spark.read.parquet(path).collect()), key=str)


def add(spark, rows, path):
    spark.createDataFrame(rows, "k int, v string").coalesce(1).write.mode("append").parquet(path)


def test_each_key_is_written_once_whatever_is_restarted(spark, tmp_path):
    src, out = str(tmp_path / "src"), str(tmp_path / "out")
    add(spark, [(1, "b"), (1, "a"), (2, "b"), (None, "n"), (None, "m")], src)
    for state in ("one", "one", "two"):  # a restart, then a query that knows nothing of the first
        stream = resume.read_stream(spark, src, "k int, v string", max_files=1)
        resume.append_once(stream, ["k"], out, str(tmp_path / state)).awaitTermination()
        add(spark, [(2, "late"), (3, state)], src)
    assert written(spark, out) == [(1, "a"), (2, "b"), (3, "one"), (None, "m")]


def test_a_batch_that_runs_again_replaces_itself(spark, tmp_path):
    out = str(tmp_path / "out")
    rows = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    for number in (0, 0):
        resume.not_written(rows, ["k"], out, number).write.mode("overwrite").parquet(f"{out}/batch={number}")
    assert written(spark, out) == [(1, "a"), (2, "b")]
    assert resume.not_written(rows, ["k"], out, 1).count() == 0


def minutes(spark, path, n):
    """A file a minute of 25 keys, five of which come again in the next."""
    rows = spark.range(n).select(F.col("id").alias("n"), F.timestamp_seconds(F.col("id") * 60).alias("at"))
    rows = rows.select("n", "at", F.explode(F.sequence(F.col("n") * 20, F.col("n") * 20 + 24)).alias("k"))
    rows.repartitionByRange(n, "n").write.parquet(path)
    return resume.read_stream(spark, path, "n long, at timestamp, k long", max_files=1)


def test_the_sink_holds_no_state(spark, tmp_path):
    out = str(tmp_path / "out")
    query = resume.append_once(minutes(spark, str(tmp_path / "src"), 8).select("k", "n"), ["k"], out, str(tmp_path / "state"))
    query.awaitTermination()
    assert len(query.recentProgress) >= 7 and all(not p["stateOperators"] for p in query.recentProgress)
    assert spark.read.parquet(out).count() == spark.read.parquet(out).select("k").distinct().count() == 165


def test_a_watermark_bounds_the_state_over_many_batches(spark, tmp_path):
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        stream = resume.keyed_once(minutes(spark, str(tmp_path / "src"), 100), ["k"], "at", "5 minutes")
        query = stream.writeStream.format("noop").option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start()
        query.awaitTermination()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    sizes = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]]
    assert len(sizes) >= 95 and max(sizes) <= 25 * 12  # of 2,500 rows


# --- tokens -------------------------------------------------------------------

TEXTS = [
    "<think>a\nb</think>so", "x<channel|>y<channel|>z", "", "no marks", "<think>1</think>m<think>2</think>n", "<think>open", "a</think>b", "<think>a<think>b</think>c", "<<think>x</think>>", "<think></think>",
    " <think> a </think> b ", "<channel|>", "<think>x<channel|>y", "<thin<think>q</think>k>", "a<think>b</think>c<think>d", "t<channel|><think>u</think>", "<think>a</think></think><", "\u2003x\u2003<channel|>\x1cy\x85",
]


def split(pieces, order=None, native=None):
    s = tokens.Splitter()
    for i in order or range(len(pieces)):
        s = tokens.Splitter(s.state())
        s.put(i, (native or {}).get(i, ""), pieces[i], i == len(pieces) - 1)
    assert s.ended()
    return s.result()


@pytest.fixture(scope="module")
def parsed(spark):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "i int, t string").select("i", T.parse_thinking(F.col("t")).alias("p")).collect()
    return {TEXTS[r["i"]]: (r["p"]["thinking"], r["p"]["content"]) for r in rows}


def test_every_cut_gives_what_the_whole_text_gives(parsed):
    for text, want in parsed.items():
        assert split([text]) == want
        assert split(list(text) or [""]) == want
        for a, b in itertools.combinations(range(len(text) + 1), 2):
            assert split([text[:a], text[a:b], text[b:]]) == want


def test_tokens_may_come_in_any_order_and_twice(parsed):
    rng = random.Random(1)
    for text, want in parsed.items():
        pieces = [text[i : i + 3] for i in range(0, len(text), 3)] or [""]
        order = list(range(len(pieces))) + rng.choices(range(len(pieces)), k=2)
        rng.shuffle(order)
        assert split(pieces, order) == want


def test_thinking_that_comes_apart_is_not_parsed():
    assert split(["<think>x</think>y<channel|>", "z<think>q"], native={0: "hm", 1: "!"}) == ("hm!", "<think>x</think>y<channel|>z<think>q")


def test_a_stream_of_tokens(spark, tmp_path, parsed):
    rows = [(c, i, None, text[i : i + 2], i + 2 >= len(text)) for c, text in enumerate(TEXTS) for i in range(0, max(len(text), 1), 2)]
    rows = [(c, i // 2, t, x, d) for c, i, t, x, d in rows]
    src, out = str(tmp_path / "src"), str(tmp_path / "out")
    spark.createDataFrame(rows, "c int, seq int, thinking string, content string, done boolean").repartition(3, "seq").write.parquet(src)
    stream = resume.read_stream(spark, src, "c int, seq int, thinking string, content string, done boolean", max_files=1)
    tokens.final_rows(tokens.split_stream(stream, ["c"]), out, str(tmp_path / "state")).awaitTermination()
    got = spark.read.parquet(out).collect()
    assert {TEXTS[r["c"]]: (r["thinking"], r["content"]) for r in got} == parsed and len(got) == len(TEXTS)
