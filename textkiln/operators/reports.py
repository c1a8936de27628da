"""Reports over stages, types and runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textkiln import schemas as S


def distribution(rows: DataFrame, column: str) -> DataFrame:
    return rows.groupBy(column).agg(F.count("*").alias("n"))


def natural_order(column: str) -> list[Column]:
    """'1' to '8' before 'A' to 'D', and '10' after '9'."""
    return [F.length(column), F.col(column)]


def type_gap(rows: DataFrame, column: str = "question_type") -> DataFrame:
    """Per type: count, share in percent, wanted share, and the difference."""
    spark = rows.sparkSession
    wanted = spark.createDataFrame([(k, v[1]) for k, v in S.QUESTION_TYPES.items()], f"{column} string, target int")
    counts = distribution(rows, column)
    total = counts.agg(F.sum("n").alias("total"))
    share = F.bround(100.0 * F.coalesce("n", F.lit(0)) / F.greatest(F.coalesce("total", F.lit(0)), F.lit(1)), 4)
    out = F.broadcast(wanted).join(counts, column, "left").crossJoin(F.broadcast(total))
    return out.select(column, F.coalesce("n", F.lit(0)).cast("long").alias("n"), "target", share.alias("share"), F.bround(share - F.col("target"), 4).alias("gap"))


def progress(n: Column, m: Column) -> Column:
    """Whole percent, cut off."""
    return F.floor(100 * n / F.greatest(m, F.lit(1))).cast("int")


def last_loss(log: DataFrame, key: str, loss: Column, step: Column, evaluated: Column) -> DataFrame:
    """Per run the last loss and the last evaluation loss."""
    at = F.when(loss.isNotNull(), step)
    return log.groupBy(key).agg(F.max_by(F.when(~evaluated, loss), F.when(~evaluated, at)).alias("last_loss"), F.max_by(F.when(evaluated, loss), F.when(evaluated, at)).alias("last_eval_loss"))


def weak_and_strong(rows: DataFrame, key: str = "id", score: str = "score", top: int = 3) -> DataFrame:
    """All weak rows and the ``top`` strong ones, ranked from either end."""
    weak = rows.where(F.col(score) < S.WEAK_SCORE).select(F.lit("weak").alias("side"), key, score)
    strong = rows.where(F.col(score) >= S.WEAK_SCORE).orderBy(F.desc(score), key).limit(top).select(F.lit("strong").alias("side"), key, score)
    return weak.unionByName(strong)


STAGES = ("chunk", "enrich", "generate", "format", "train", "eval", "dpo")


def stages_to_run(start: str | None = None, stop: str | None = None, skip: tuple[str, ...] = (), with_dpo: bool = False) -> list[str]:
    """Stages between start and stop that are not skipped; the last one is
    opt-in."""
    first = STAGES.index(start) if start else 0
    last = STAGES.index(stop) if stop else len(STAGES) - 1
    return [s for i, s in enumerate(STAGES) if first <= i <= last and s not in skip and (s != "dpo" or with_dpo)]
