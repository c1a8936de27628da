"""Line-delimited JSON: tolerant and strict scans, shards, sinks, file facts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textkiln.functions import text as T
from textkiln.functions.ladders import is_json

from .lines import numbered_rows


def tolerant_scan(spark: SparkSession, path: str | list[str], schema: str) -> DataFrame:
    """Rows of the lines that are JSON objects; others are skipped. An object
    that has none of the wanted fields is a row of nulls."""
    return tolerant_parse(spark.read.text(path), "value", schema)


def tolerant_parse(lines: DataFrame, column: str, schema: str) -> DataFrame:
    """The same for lines that are already a column; other columns stay."""
    good = is_json(F.col(column)) & T.strip(F.col(column)).startswith("{")
    parsed = lines.where(good).withColumn("__row", F.from_json(column, schema))
    return parsed.select(*[c for c in lines.columns if c != column], "__row.*")


def strict_scan(spark: SparkSession, path: str | list[str], schema: str) -> DataFrame:
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def text_projection(rows: DataFrame, column: str = "text") -> DataFrame:
    """Only the texts there are; an error where there is none."""
    out = rows.select(column).where(F.col(column).isNotNull())
    if out.isEmpty():
        raise ValueError(f"no row has a {column}")
    return out


def document(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A file that is one JSON array or object."""
    return spark.read.schema(schema).option("multiLine", True).json(path)


def shards(spark: SparkSession, pattern: str, schema: str) -> DataFrame:
    """All files of a pattern with ``file_path`` and ``line_no``, the order in
    which keep-first merging reads them; lines that are no objects are skipped."""
    return numbered_rows(spark, pattern, schema).withColumnsRenamed({"file": "file_path", "line": "line_no"})


def newest(spark: SparkSession, pattern: str) -> str | None:
    """Path of the file changed last."""
    files = spark.read.format("binaryFile").load(pattern).select("path", "modificationTime")
    row = files.orderBy(F.desc("modificationTime"), "path").first()
    return row["path"] if row else None


def count_lines(spark: SparkSession, path: str) -> int:
    """Lines that are not blank."""
    return spark.read.text(path).where(T.strip(F.col("value")) != "").count()


def sample(rows: DataFrame, n: int = 3) -> DataFrame:
    return rows.limit(n)


def file_sizes(spark: SparkSession, pattern: str) -> DataFrame:
    files = spark.read.format("binaryFile").load(pattern)
    return files.select("path", F.bround(F.col("length") / 1024, 1).alias("kb"))


def write(rows: DataFrame, path: str, mode: str = "overwrite") -> None:
    """``overwrite`` for whole results, ``append`` for resumed ones, ``ignore``
    to skip what is there."""
    rows.write.mode(mode).json(path)


def write_report(summary: DataFrame, questions: DataFrame, path: str, order: str = "id") -> None:
    """One nested object: the summary's columns and the ordered questions."""
    listed = questions.agg(F.array_sort(F.collect_list(F.struct(order, *[c for c in questions.columns if c != order]))).alias("questions"))
    summary.crossJoin(listed).coalesce(1).write.mode("overwrite").json(path)


def binary_as_base64(content: Column) -> Column:
    return F.base64(content)


def whole_texts(spark: SparkSession, pattern: str) -> DataFrame:
    """Extracted texts, one row a file: ``path, text``."""
    return spark.read.text(pattern, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"))


def join_pages(pages: DataFrame, key: str, number: str, text: str = "text") -> DataFrame:
    """Page texts of a document joined by line breaks, in page order."""
    ordered = F.array_sort(F.collect_list(F.struct(number, F.coalesce(text, F.lit("")).alias("t"))))
    return pages.groupBy(key).agg(F.array_join(F.transform(ordered, lambda p: p["t"]), "\n").alias("text"))
