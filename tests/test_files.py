"""Numbered lines and published folders."""

import gzip
import json
import random

import pytest
from pyspark.sql import functions as F

from textkiln.operators import merge
from textkiln.sources import jsonl, lines, manifest


def plain(path, policy="skip"):
    """``(line, row)`` of a file read from its start."""
    out = []
    for i, line in enumerate(path.read_bytes().split(b"\n"), 1):
        text = line.decode("utf-8", "replace").strip()
        if text and (policy == "keep" or lines.is_object(text)):
            out.append((i, text))
    return out


def make(path, n, seed, end="\n"):
    rng = random.Random(seed)
    some = ['{"k": 1}', "not json", "", "   ", "[1]", '{"k": "é\\n"}', '{"k": NaN}', '{"k": 2}\r', "{" * 5000, '{"t": "' + "x" * 3000 + '"}']
    path.write_bytes(("\n".join(rng.choice(some) for _ in range(n)) + end).encode())
    return path


@pytest.mark.parametrize("size", [1, 2, 7, 64, 5000, 1 << 20])
def test_every_cut_of_a_file_has_the_same_lines(tmp_path, size):
    rng = random.Random(size)
    for end in ("\n", "", "\n\n"):
        path = tmp_path / f"f{len(end)}"
        path.write_bytes(("\n".join("x" * rng.choice([0, 1, 3, 20]) for _ in range(40)) + end).encode())
        got = [line for r in lines.ranges(str(path), size) for line in lines.range_lines(r)]
        want = path.read_bytes().split(b"\n")
        assert got == want[:-1] + ([want[-1]] if want[-1] else [])


@pytest.mark.parametrize("policy", ["skip", "keep"])
def test_lines_have_their_numbers(spark, tmp_path, policy):
    files = [make(tmp_path / f"part{i}.jsonl", 60 + i, i, "\n" if i else "") for i in range(3)]
    (tmp_path / "empty.jsonl").write_text("")
    (tmp_path / "other.txt").write_text('{"k": 0}\n')
    for size in (3000, 1 << 20):
        got = lines.numbered_lines(spark, str(tmp_path / "*.jsonl"), policy, size).collect()
        assert sorted((r["file"], r["line"], r["row"]) for r in got) == sorted((str(f), *x) for f in files for x in plain(f, policy))


def test_bad_lines_can_fail_and_a_compressed_file_is_one_range(spark, tmp_path):
    make(tmp_path / "a.jsonl", 30, 1)
    with pytest.raises(Exception, match="not a JSON object"):
        lines.numbered_lines(spark, str(tmp_path / "a.jsonl"), "fail", 200).collect()
    with pytest.raises(Exception, match="badLines is one of"):
        lines.numbered_lines(spark, str(tmp_path / "a.jsonl"), "guess").collect()
    with gzip.open(tmp_path / "b.jsonl.gz", "wb") as out:
        out.write((tmp_path / "a.jsonl").read_bytes())
    got = lines.numbered_lines(spark, str(tmp_path / "b.jsonl.gz"), "skip", 10).collect()
    assert sorted((r["line"], r["row"]) for r in got) == plain(tmp_path / "a.jsonl")
    without = spark.read.format("textkiln_lines").load(str(tmp_path / "a.jsonl")).collect()
    assert sorted((r["line"], r["row"]) for r in without) == plain(tmp_path / "a.jsonl")


def test_shards_merge_in_the_order_of_paths_and_lines(spark, tmp_path):
    row = lambda k, v: json.dumps({"k": k, "v": v})
    (tmp_path / "s2.jsonl").write_text("\n".join([row("b", "2.1"), row("a", "2.2"), row("c", "2.3")]))
    (tmp_path / "s1.jsonl").write_text("\n".join(["broken", row("a", "1.2"), row("a", "1.3")]))
    rows = jsonl.shards(spark, str(tmp_path / "s*.jsonl"), "k string, v string")
    out = merge.merge([rows], ["k"], ["file_path", "line_no"])
    assert [(r["v"], r["line_no"], r["qa_id"]) for r in out.orderBy("qa_id").collect()] == [("1.2", 2, "qa_00001"), ("2.1", 1, "qa_00002"), ("2.3", 3, "qa_00003")]


ROW = "id long, text string"


def ids(spark, path):
    return sorted(r["id"] for r in manifest.published(spark, str(path), ROW).collect())


def some(spark, a, b):
    return spark.range(a, b, 1, 3).select("id", F.when(F.col("id") % 3 != 0, F.lit("x\ny")).alias("text"))


def test_append_overwrite_and_skip(spark, tmp_path):
    path = tmp_path / "out"
    manifest.publish(some(spark, 0, 5), str(path))
    manifest.publish(some(spark, 5, 9), str(path))
    assert ids(spark, path) == list(range(9))
    manifest.publish(some(spark, 100, 103), str(path), "skip")
    assert ids(spark, path) == list(range(9))
    manifest.publish(some(spark, 20, 22), str(path), "overwrite")
    assert ids(spark, path) == [20, 21]
    assert len([f for f in path.iterdir() if f.suffix == ".jsonl"]) == 2  # the old files are gone
    rows = {r["id"]: r["text"] for r in manifest.published(spark, str(path), ROW).collect()}
    assert rows == {20: "x\ny", 21: None}
    manifest.publish(some(spark, 0, 0), str(path), "overwrite")
    assert ids(spark, path) == []
    with pytest.raises(ValueError, match="mode is one of"):
        manifest.publish(some(spark, 0, 1), str(path), "ignore")


def test_a_batch_counts_once(spark, tmp_path):
    path = tmp_path / "out"
    for number in (0, 1, 1, 0, 2):
        manifest.publish(some(spark, 10 * number, 10 * number + 4), str(path), batch="run", number=number)
    manifest.publish(some(spark, 90, 91), str(path), batch="other")
    assert ids(spark, path) == [0, 1, 2, 3, 10, 11, 12, 13, 20, 21, 22, 23, 90]
    assert len(list((path / manifest.MANIFESTS).glob("*.json"))) <= 2


def test_a_failed_write_leaves_nothing(spark, tmp_path):
    path = tmp_path / "out"
    manifest.publish(some(spark, 0, 5), str(path))
    broken = some(spark, 5, 3000).withColumn("text", F.when(F.col("id") == 2999, F.raise_error(F.lit("killed"))).otherwise(F.col("text")))
    for mode in ("append", "overwrite"):
        with pytest.raises(Exception, match="killed"):
            manifest.publish(broken, str(path), mode)
        assert ids(spark, path) == list(range(5))
        assert len([f for f in path.iterdir() if f.suffix == ".jsonl"]) <= 3


def test_what_a_killed_task_staged_is_not_read(spark, tmp_path):
    path = tmp_path / "out"
    manifest.publish(some(spark, 0, 5), str(path))
    (path / manifest.STAGING / "lost").mkdir(parents=True)
    (path / manifest.STAGING / "lost" / "part-x.jsonl").write_text('{"id": 77, "te')
    (path / "part-unlisted.jsonl").write_text('{"id": 78}\n')  # moved, but its manifest never came
    assert ids(spark, path) == list(range(5))
    writer = manifest._Writer({"path": str(path)}, overwrite=False)
    staged = writer.write(iter(some(spark, 50, 52).selectExpr("to_json(struct(*)) AS row").toArrow().to_batches()))
    assert ids(spark, path) == list(range(5))  # not yet committed
    writer.commit([staged, None])
    assert ids(spark, path) == [*range(5), 50, 51]
