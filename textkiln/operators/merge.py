"""Merging of shards: keep the first row of each key, number what is left."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .ranking import dense_row_number, numbered


def keep_first(rows: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """One row a key, the first by ``order``. The minimum of a struct combines
    before the shuffle, so a key with very many copies is no hot key."""
    rest = [c for c in rows.columns if c not in key and c not in order]
    first = F.min_by(F.struct(*rest), F.struct(*order)) if rest else None
    aggs = [F.min(F.struct(*order)).alias("__first")] + ([first.alias("__row")] if rest else [])
    out = rows.groupBy(*key).agg(*aggs)
    return out.select(*key, *[F.col(f"__first.{c}").alias(c) for c in order], *[F.col(f"__row.{c}").alias(c) for c in rest])


def join_by_place(left: DataFrame, right: DataFrame, left_order: list[str], right_order: list[str]) -> DataFrame:
    """The rows of two tables side by side, the first with the first. Both must
    have as many rows; the columns of ``right`` must have names of their own."""
    a, n = numbered(left, [F.col(c) for c in left_order], "place")
    b, m = numbered(right, [F.col(c) for c in right_order], "place")
    if n != m:
        raise ValueError(f"{n} rows on the left, {m} on the right")
    return a.join(b, "place")


def renumber(rows: DataFrame, order: list[str], pattern: str = "qa_%05d", name: str = "qa_id") -> DataFrame:
    """Dense ids from 1 in the order given."""
    numbered = dense_row_number(rows, [F.col(c) for c in order], "__number")
    return numbered.withColumn(name, F.format_string(pattern, "__number")).drop("__number")


def contribution(rows: DataFrame, key: list[str], file: str, order: list[str]) -> DataFrame:
    """Per file: rows read, first rows that it gave, duplicates removed."""
    firsts = keep_first(rows, key, order).groupBy(file).agg(F.count("*").alias("n_unique"))
    read = rows.groupBy(file).agg(F.count("*").alias("n_read"))
    unique = F.coalesce("n_unique", F.lit(0))
    return read.join(firsts, file, "left").select(file, "n_read", unique.alias("n_unique"), (F.col("n_read") - unique).alias("n_removed"))


def merge(shards: list[DataFrame], key: list[str], order: list[str], pattern: str = "qa_%05d") -> DataFrame:
    rows = shards[0]
    for s in shards[1:]:
        rows = rows.unionByName(s)
    return renumber(keep_first(rows, key, order), order, pattern)
