"""Queries that go through files: shards read with their line numbers, and the
sink that publishes whole batches."""

from __future__ import annotations

from pyspark.sql import functions as F

from textkiln.operators import merge
from textkiln.sources import jsonl, manifest
from textkiln.sources.folders import scratch

from . import inputs as I
from .seed_queries import _FIRST

QUERIES, ORACLES = {}, {}
_ROW = "para_id string, question_type string, shard int, conv_id long, turn long, key string"
_COLUMNS = [c.split()[0] for c in _ROW.split(", ")]


def query(sql: str):
    def keep(fn):
        QUERIES[fn.__name__], ORACLES[fn.__name__] = fn, sql
        return fn

    return keep


def _shard_files(spark, sf_dir) -> str:
    """Seeds as files of lines, in the order of their shards; some lines are bad."""
    rows = I.seeds(spark, sf_dir).select(*_COLUMNS)
    rows = rows.repartitionByRange(5, "shard", "conv_id", "turn").sortWithinPartitions("shard", "conv_id", "turn")
    good = F.to_json(F.struct(*_COLUMNS))
    bad = F.array(F.lit("not json"), F.lit(""), F.lit("[1, 2]"), good)
    path = scratch(spark, "shards")
    rows.select(F.explode(F.when(F.col("conv_id") % 10 == 0, bad).otherwise(F.array(good))).alias("value")).write.text(path)
    return path


@query(f"WITH {I.SQL_SEEDS}, {_FIRST} SELECT key, printf('qa_%05d', row_number() OVER (ORDER BY shard, conv_id, turn)) AS qa_id FROM f")
def merge_files(spark, sf_dir):
    """Shard files, by path and line: the first row of each key, numbered."""
    rows = jsonl.shards(spark, _shard_files(spark, sf_dir), _ROW)
    return merge.merge([rows], ["para_id", "question_type"], ["file_path", "line_no"]).select("key", "qa_id")


@query(f"""WITH {I.SQL_SEEDS}, n AS (SELECT conv_id, turn, CASE WHEN conv_id % 10 = 0 THEN 4 ELSE 1 END AS lines FROM seeds)
SELECT count(*) AS n_rows, CAST(sum(lines) AS BIGINT) AS n_lines FROM n""")
def file_lines(spark, sf_dir):
    """Rows that the scan keeps, and lines that it numbers: the last line of each
    file holds a row."""
    rows = jsonl.shards(spark, _shard_files(spark, sf_dir), "key string")
    last = rows.groupBy("file_path").agg(F.count("*").alias("n"), F.max("line_no").alias("last"))
    return last.agg(F.sum("n").alias("n_rows"), F.sum("last").alias("n_lines"))


@query(f"WITH {I.SQL_SEEDS} SELECT key, shard, question FROM seeds WHERE shard <> 4")
def publish_batches(spark, sf_dir):
    """Shards appended one by one, the second twice under its number; the fifth
    is overwritten by the first before the others come."""
    rows, path = I.seeds(spark, sf_dir).select("key", "shard", "question"), scratch(spark, "published")
    manifest.publish(rows.where("shard = 4"), path)
    manifest.publish(rows.where("shard = 0"), path, "overwrite", "shards", 0)
    for number in (1, 2, 1, 3):
        manifest.publish(rows.where(F.col("shard") == number), path, "append", "shards", number)
    manifest.publish(rows, path, "skip")
    return manifest.published(spark, path, "key string, shard int, question string").select("key", "shard", "question")
