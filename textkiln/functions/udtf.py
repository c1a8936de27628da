"""Table and scalar functions for use from SQL alone."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.functions import udtf
from pyspark.sql.types import IntegerType, StringType, StructType
from pyspark.sql.udtf import AnalyzeArgument, AnalyzeResult, OrderingColumn, PartitioningColumn

from textkiln import schemas as S

#: Built-in expressions that SQL gets by name.
SCALARS = {
    "word_count": ("c STRING", "INT", r"CAST(size(regexp_extract_all(c, r'[^\s\x0b\p{Z}\x1c-\x1f\x85]+', 0)) AS INT)"),
    "chapter_title": ("c STRING", "STRING", "CASE c " + " ".join(f"WHEN '{k}' THEN '{v[0]}'" for k, v in S.CHAPTERS.items()) + " END"),
    "chapter_weight": ("c STRING", "DOUBLE", "CASE c " + " ".join(f"WHEN '{k}' THEN {v[2]}D" for k, v in S.CHAPTERS.items()) + " ELSE 1.5D END"),
}


@udtf
class PackLines:
    """Packs a document's lines, one row each in order, into chunks.

    ``pack_lines(TABLE(lines) PARTITION BY doc_id ORDER BY line_no, max_words)``:
    ``analyze`` asks for a document's rows together and in order, whatever the
    call says, and names the result's key like the table's. A chunk ends with
    the line that takes it over ``max_words``; only its counts are held.
    """

    @staticmethod
    def analyze(rows: AnalyzeArgument, key: AnalyzeArgument, order: AnalyzeArgument, words: AnalyzeArgument, max_words: AnalyzeArgument) -> AnalyzeResult:
        if not rows.isTable:
            raise ValueError("the first argument is a table")
        names = {f.name: f.dataType for f in rows.dataType.fields}
        for arg in (key, order, words):
            if not arg.isConstantExpression or arg.value not in names:
                raise ValueError(f"name a column of the table, not {arg.value}: {', '.join(names)}")
        if not max_words.isConstantExpression or not max_words.value or max_words.value < 1:
            raise ValueError("max_words is a number over 0")
        out = StructType().add(key.value, names[key.value]).add("chunk_no", IntegerType()).add("first_line", names[order.value]).add("last_line", names[order.value]).add("n_words", IntegerType())
        return AnalyzeResult(schema=out, partitionBy=[PartitioningColumn(key.value)], orderBy=[OrderingColumn(order.value)])

    def __init__(self):
        self.key, self.no, self.first, self.last, self.n = None, 0, None, None, 0

    def eval(self, row, key: str, order: str, words: str, max_words: int):
        self.key, self.last = row[key], row[order]
        self.first = self.last if self.first is None else self.first
        self.n += row[words] or 0
        if self.n > max_words:
            yield self.key, self.no, self.first, self.last, self.n
            self.no, self.first, self.n = self.no + 1, None, 0

    def terminate(self):
        if self.first is not None:
            yield self.key, self.no, self.first, self.last, self.n


def register(spark: SparkSession) -> None:
    """Make ``pack_lines`` and the scalar functions known to SQL."""
    spark.udtf.register("pack_lines", PackLines)
    for name, (takes, gives, body) in SCALARS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({takes}) RETURNS {gives} RETURN {body}")
