"""Queries written in SQL alone, and stages that are counted as they write."""

from __future__ import annotations

from pyspark.sql import functions as F

from textkiln.functions import text as T
from textkiln.functions import udtf
from textkiln.operators import observed, packing_lines, schedule
from textkiln.sources.folders import scratch

from . import inputs as I

QUERIES, ORACLES = {}, {}
PACKED_WORDS = 60


def query(sql: str):
    def keep(fn):
        QUERIES[fn.__name__], ORACLES[fn.__name__] = fn, sql
        return fn

    return keep


@query(f"""WITH RECURSIVE {I.SQL_LINES}, n AS (SELECT doc_id, i, {I.sql_words('line')} AS w FROM lines),
r AS (SELECT doc_id, i, w AS total, 0 AS chunk_no, i AS first FROM n WHERE i = 0
  UNION ALL SELECT n.doc_id, n.i, CASE WHEN r.total > {PACKED_WORDS} THEN n.w ELSE r.total + n.w END, CASE WHEN r.total > {PACKED_WORDS} THEN r.chunk_no + 1 ELSE r.chunk_no END,
    CASE WHEN r.total > {PACKED_WORDS} THEN n.i ELSE r.first END FROM r JOIN n ON n.doc_id = r.doc_id AND n.i = r.i + 1),
c AS (SELECT doc_id, chunk_no, CAST(first AS INT) AS first_line, CAST(max(i) AS INT) AS last_line, CAST(max(total) AS INT) AS n_words FROM r GROUP BY doc_id, chunk_no, first),
t AS (SELECT *, {I.sql_pick(I.NAMES, 'doc_id')} AS chapter FROM c)
SELECT doc_id, chunk_no, first_line, last_line, n_words, {I.sql_map('chapter', I.TITLES, 'VARCHAR')} AS title, n_words * {I.sql_map('chapter', I.WEIGHTS, 'DOUBLE')} AS weighted FROM t""")
def pack_lines_sql(spark, sf_dir):
    """Lines packed by the table function, in SQL."""
    udtf.register(spark)
    names = ", ".join(f"'{n}'" for n in I.NAMES)
    return spark.sql(
        f"""
        WITH lines AS (SELECT doc_id, pos AS line_no, word_count(col) AS n FROM parquet.`{sf_dir}/documents.parquet` LATERAL VIEW posexplode(split(text, '\\n', -1)) l),
        chunks AS (SELECT *, element_at(array({names}), CAST(doc_id % {len(I.NAMES)} AS INT) + 1) AS chapter
          FROM pack_lines(TABLE(SELECT * FROM lines), 'doc_id', 'line_no', 'n', {PACKED_WORDS}))
        SELECT doc_id, chunk_no, first_line, last_line, n_words, chapter_title(chapter) AS title, n_words * chapter_weight(chapter) AS weighted FROM chunks"""
    )


@query(f"""WITH {I.SQL_DOCUMENTS}, {{pool}}, s AS (SELECT 0 AS place, 'documents' AS stage, count(*) AS n FROM docs UNION ALL SELECT 1, 'long enough', count(*) FILTER ({I.sql_words('text')} >= 30) FROM docs
  UNION ALL SELECT 2, 'pool', count(*) FROM pool) SELECT CAST(place AS INT) AS place, stage, n AS n_rows, CAST(floor(100.0 * n / (SELECT count(*) FROM docs)) AS INT) AS percent FROM s""")
def stage_log(spark, sf_dir):
    """Three stages, counted by their own writes."""
    log, path = observed.StageLog(spark), scratch(spark, "stages")
    docs = log.write("documents", I.documents(spark, sf_dir), f"{path}/0")
    long = log.write("long enough", schedule.long_enough(docs), f"{path}/1")
    log.write("pool", schedule.weighted_pool(long.drop("text")), f"{path}/2")
    return log.report().select("place", "stage", "n_rows", "percent")


@query(f"""WITH RECURSIVE {I.SQL_LINES}, n AS (SELECT doc_id, i, {I.sql_words('line')} AS w, i % 17 = 5 AS starts FROM lines),
r AS (SELECT doc_id, i, w AS total, i AS first FROM n WHERE i = 0
  UNION ALL SELECT n.doc_id, n.i, CASE WHEN n.starts OR r.total > {PACKED_WORDS} THEN n.w ELSE r.total + n.w END, CASE WHEN n.starts OR r.total > {PACKED_WORDS} THEN n.i ELSE r.first END FROM r JOIN n ON n.doc_id = r.doc_id AND n.i = r.i + 1)
SELECT doc_id, CAST(i AS BIGINT) AS line_no, CAST(first AS BIGINT) AS chunk FROM r""")
def pack_lines_rows(spark, sf_dir):
    """Lines that are rows, packed in segments of sixteen lines each."""
    lines = I.table(spark, sf_dir, "documents").select("doc_id", F.posexplode(F.split("text", "\n", -1)).alias("line", "said"))
    lines = lines.select(F.col("doc_id").alias("doc"), "line", T.word_count(F.col("said")).alias("words"), (F.col("line") % 17 == 5).alias("starts"))
    return packing_lines.pack_lines(lines, PACKED_WORDS, segment=16).select(F.col("doc").alias("doc_id"), F.col("line").alias("line_no"), "chunk")


def _pool_sql() -> str:
    weight = f"coalesce({I.sql_map('chapter_num', I.WEIGHTS, 'DOUBLE')}, 1.5)"
    return f"pool AS (SELECT doc_id, unnest(range(1, CAST(greatest(1, round_even({weight}, 0)) AS INT) + 1)) AS copy FROM docs WHERE {I.sql_words('text')} >= 30)"


ORACLES["stage_log"] = ORACLES["stage_log"].replace("{pool}", _pool_sql())
