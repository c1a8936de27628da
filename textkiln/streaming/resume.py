"""Resumable ingestion: a stream that writes each key once.

No keyed state is held. A micro-batch is reduced to one row a key and asked
against what the sink has already: only the key columns of the written files are
read, and only the keys of the batch move. A batch is written into a folder of
its own number, so one that is run again after a crash replaces itself. Where
repeats are known to come within a delay, a watermark does the same inside the
stream, with the state of one delay.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Most keys of a micro-batch that are broadcast to the written files.
BROADCAST_KEYS = 500_000


def keyed_once(stream: DataFrame, key: list[str], event_time: str | None = None, delay: str | None = None) -> DataFrame:
    """The first row of each key: within ``delay`` of ``event_time`` with state
    for that long, else with state for ever."""
    if event_time and delay:
        return stream.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(key)
    return stream.dropDuplicates(key)


def not_written(batch: DataFrame, key: list[str], path: str, number: int) -> DataFrame:
    """The rows of a micro-batch whose keys no other batch under ``path`` has.

    Keys are compared by a token that tells nulls apart from values. Of the
    written files only key columns are read, where they lie; what comes back is
    at most the batch's own keys.
    """
    spark = batch.sparkSession
    token = F.xxhash64(F.to_json(F.struct(*[F.col(k) for k in key]), {"ignoreNullFields": "false"})).alias("__token")
    names = [F.col(k).alias(f"__k{i}") for i, k in enumerate(key)]
    try:
        written = spark.read.option("basePath", path).parquet(f"{path}/batch=*").where(F.col("batch") != number)
    except Exception as error:  # nothing is there yet
        if "PATH_NOT_FOUND" not in str(error):
            raise
        return batch
    asked = batch.select(token, *names).distinct()
    asked = F.broadcast(asked) if asked.count() <= BROADCAST_KEYS else asked
    same = lambda a, b: a.eqNullSafe(b)
    held = written.select(token.alias("__held"), *[F.col(k).alias(f"__w{i}") for i, k in enumerate(key)])
    on = F.col("__held") == F.col("__token")
    for i in range(len(key)):
        on = on & same(F.col(f"__w{i}"), F.col(f"__k{i}"))
    known = held.join(asked, on).select(*[f"__k{i}" for i in range(len(key))]).distinct()
    on = None
    for i, k in enumerate(key):
        each = same(batch[k], known[f"__k{i}"])
        on = each if on is None else on & each
    return batch.join(known, on, "left_anti")


def append_once(stream: DataFrame, key: list[str], path: str, checkpoint: str, event_time: str | None = None, delay: str | None = None, available_now: bool = True):
    """Start the append-only sink of Parquet under ``path/batch=<number>``; with
    ``available_now`` it ends when all files that are there have been read.

    A key is written once, however late it comes again and however often the
    query is restarted. Of a micro-batch's rows of one key the least is kept.
    With ``event_time`` and ``delay`` repeats within the delay are dropped before
    they get here, by state that a watermark bounds.
    """
    columns = [c for c in stream.columns if c not in key]

    def put(batch: DataFrame, number: int) -> None:
        first = F.min(F.struct(*columns)).alias("__row") if columns else F.count("*").alias("__row")
        rows = batch.groupBy(*key).agg(first)
        rows = rows.select(*key, *[F.col(f"__row.{c}").alias(c) for c in columns]).select(*stream.columns)
        not_written(rows, key, path, number).write.mode("overwrite").parquet(f"{path}/batch={number}")

    source = keyed_once(stream, key, event_time, delay) if event_time and delay else stream
    writer = source.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).outputMode("append")
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def read_stream(spark: SparkSession, path: str, schema, max_files: int = 100) -> DataFrame:
    """A folder as a stream, some files a batch: the bound on what is in flight."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).parquet(path)


def live_counts(stream: DataFrame, column: str, name: str, every: str = "30 seconds"):
    """The polling dashboard: complete counts in memory, renewed on a timer."""
    counts = stream.groupBy(column).agg(F.count("*").alias("n"))
    return counts.writeStream.outputMode("complete").format("memory").queryName(name).trigger(processingTime=every).start()
