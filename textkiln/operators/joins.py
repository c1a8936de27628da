"""Joins that a frequent key does not slow down."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A key with more rows than this, and more than one in so many, is hot.
HOT_ROWS, HOT_SHARE = 10_000, 1000


def token(value: Column) -> Column:
    """A join key that is never null: '' for null, else '=' and the value."""
    return F.coalesce(F.concat(F.lit("="), value.cast("string")), F.lit(""))


def join_per_key(rows: DataFrame, per_key: DataFrame, on: list[str], n: str, total: int) -> DataFrame:
    """Inner join of ``rows`` with one row a key, that holds in ``n`` how many of
    the ``total`` rows have the key; ``n`` itself is left out.

    At most ``HOT_SHARE`` keys can be hot: they are broadcast and their rows stay
    where they are. The others are dealt by the key.
    """
    rest = [c for c in per_key.columns if c not in on and c != n]
    limit = max(HOT_ROWS, total // HOT_SHARE)
    if total <= limit:
        return rows.join(per_key.drop(n), on).select(*rows.columns, *rest)
    hot = per_key.where(F.col(n) > limit).select(*on, F.struct(F.lit(True), *rest).alias("__hot"))
    tagged = rows.join(F.broadcast(hot), on, "left")
    met = tagged.where("__hot IS NOT NULL").select(*rows.columns, *[F.col(f"__hot.{c}").alias(c) for c in rest])
    other = tagged.where("__hot IS NULL").drop("__hot").join(per_key.where(F.col(n) <= limit).drop(n), on)
    return met.union(other.select(*rows.columns, *rest))
