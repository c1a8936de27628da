"""Queries that run as streams; a batch of SQL states their results."""

from __future__ import annotations

from pyspark.sql import functions as F

from textkiln.sources.folders import scratch
from textkiln.streaming import resume, tokens

from . import inputs as I
from .seed_queries import ORACLES as SEED_ORACLES
from .seed_queries import _decorated

QUERIES, ORACLES = {}, {}


def query(sql: str):
    def keep(fn):
        QUERIES[fn.__name__], ORACLES[fn.__name__] = fn, sql
        return fn

    return keep


@query("SELECT event_id, user_id, event_type FROM events")
def stream_resume(spark, sf_dir):
    """Beyond the surveyed operators: events fed twice through the resumable
    sink; each key is written once."""
    out, source = scratch(spark, "resume"), f"{sf_dir}/events.parquet"
    schema = I.table(spark, sf_dir, "events").schema
    for state in ("state", "state", "other"):  # a restart adds nothing, nor does a new query over the same sink
        stream = spark.readStream.schema(schema).parquet(source if source.endswith("/") else f"{source}*")
        resume.append_once(stream.select("event_id", "user_id", "event_type"), ["event_id"], f"{out}/data", f"{out}/{state}").awaitTermination()
    return spark.read.parquet(f"{out}/data").select("event_id", "user_id", "event_type")


@query(SEED_ORACLES["parse_thinking"])
def token_stream(spark, sf_dir):
    """Decorated turns cut into tokens of five characters, streamed file by file."""
    text = _decorated(spark, sf_dir)
    at = F.posexplode(F.sequence(F.lit(1), F.greatest(F.length("t"), F.lit(1)), F.lit(5))).alias("seq", "at")
    cut = text.select("conv_id", "turn", "t", at).select(
        "conv_id", "turn", "seq", F.lit(None).cast("string").alias("thinking"), F.substring("t", F.col("at"), F.lit(5)).alias("content"), (F.col("at") + 5 > F.length("t")).alias("done")
    )
    source, out = scratch(spark, "tokens"), scratch(spark, "finished")
    cut.repartitionByRange(3, "seq").write.parquet(source)
    stream = resume.read_stream(spark, source, cut.schema, max_files=1)
    tokens.final_rows(tokens.split_stream(stream, ["conv_id", "turn"]), f"{out}/data", f"{out}/state").awaitTermination()
    return spark.read.parquet(f"{out}/data").select("conv_id", "turn", "thinking", "content")
