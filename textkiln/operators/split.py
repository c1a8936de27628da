"""Deterministic train and validation split."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textkiln import schemas as S

from .ranking import dense_row_number
from .schedule import shuffle_key


def validation_rows(n: int, ratio: float = 0.1) -> int:
    return max(1, int(n * ratio))


def pair_validation_rows(n: int, ratio: float = 0.1) -> int:
    """Of preference pairs the held part is rounded up."""
    return math.ceil(n * ratio)


def train_val_split(rows: DataFrame, key: str, ratio: float = 0.1, seed: int = S.SEED_NUMBER, held=validation_rows) -> DataFrame:
    """``rows`` with ``place`` in the shuffled order and ``part``: the last
    ``held(n, ratio)`` places are ``val``. No rows give no rows."""
    n = rows.count()
    hashed = rows.withColumn("__h", shuffle_key(F.col(key), seed))
    placed = dense_row_number(hashed, [F.col("__h"), F.col(key)], "place").drop("__h")
    return placed.withColumn("part", F.when(F.col("place") > n - held(n, ratio), F.lit("val")).otherwise(F.lit("train")))
