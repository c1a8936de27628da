"""Stages that are counted while they are written, and how long they took."""

from __future__ import annotations

import time
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .reports import progress

_REPORT = "place int, stage string, n_rows long, seconds double"


@dataclass
class StageLog:
    """Writes stages and keeps, for each, its rows, its other counts and its
    seconds. The counts come from the write itself: nothing is read again."""

    spark: SparkSession
    stages: list[tuple[str, dict, float]] = field(default_factory=list)

    def write(self, name: str, rows: DataFrame, path: str, **counts: Column) -> DataFrame:
        """``rows`` as Parquet, read again. ``counts`` are further aggregates."""
        seen = Observation(f"{name}-{len(self.stages)}")
        began = time.perf_counter()
        columns = [F.count(F.lit(1)).alias("n_rows"), *[c.alias(n) for n, c in counts.items()]]
        rows.observe(seen, *columns).write.mode("overwrite").parquet(path)
        self.stages.append((name, seen.get, time.perf_counter() - began))
        return self.spark.read.parquet(path)

    def counts(self, name: str) -> dict:
        return next(found for stage, found, _ in reversed(self.stages) if stage == name)

    def report(self) -> DataFrame:
        """A row for each stage in order, with its share of the first one's rows."""
        rows = [(i, name, found["n_rows"], took) for i, (name, found, took) in enumerate(self.stages)]
        df = self.spark.createDataFrame(rows, _REPORT)
        first = F.lit(rows[0][2] if rows else 0)
        return df.withColumn("percent", progress(F.col("n_rows"), first))


def clock(seconds: float) -> str:
    """Elapsed time as hours, minutes and seconds."""
    whole = int(seconds)
    return f"{whole // 3600}h {whole // 60 % 60:02d}m {whole % 60:02d}s"
