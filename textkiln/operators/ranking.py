"""Global row numbers that scale: no window over the whole table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textkiln.sources.folders import kept


def dense_row_number(df: DataFrame, order: list[Column], name: str, start: int = 1) -> DataFrame:
    """``df`` with ``name`` numbering its rows by ``order`` (a total order)."""
    return numbered(df, order, name, start)[0]


def numbered(df: DataFrame, order: list[Column], name: str, start: int = 1) -> tuple[DataFrame, int]:
    """The same and the number of rows.

    Rows are cut into ranges of the order, numbered inside each range, and moved
    up by the rows of the ranges before: a sum over as many rows as ranges.
    """
    spark = df.sparkSession
    width = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    keyed = df.withColumns({f"__o{i}": c for i, c in enumerate(order)})
    keys = [F.col(f"__o{i}") for i in range(len(order))]
    dealt = keyed.repartitionByRange(width, *keys).withColumn("__part", F.spark_partition_id())
    # the ranges come from a sample: both uses below must see the same cut, also
    # after an executor is lost
    dealt = kept(dealt)
    sizes = {r["__part"]: r["count"] for r in dealt.groupBy("__part").count().collect()}  # a number for each range
    total, before = 0, []
    for part in sorted(sizes):
        before.append((part, total))
        total += sizes[part]
    moved = F.broadcast(spark.createDataFrame(before, "__part int, __before long"))
    inside = F.row_number().over(Window.partitionBy("__part").orderBy(*keys))
    out = dealt.withColumn("__in", inside).join(moved, "__part")
    return out.withColumn(name, (F.col("__in") + F.col("__before") + F.lit(start - 1)).cast("long")).select(*df.columns, name), total
