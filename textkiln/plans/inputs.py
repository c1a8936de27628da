"""Inputs derived from the generic tables, as DataFrames and as SQL.

The generic tables hold no numbered paragraphs and no citations; queries derive
what they need from ids, the same way on either side.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from textkiln import schemas as S
from textkiln.functions.text import SPACE, WORD
from textkiln.operators.schedule import draw_type

NAMES = list(S.CHAPTERS)
ECHELONS = list(S.VOCABULARY["echelon"][0])
DOMAINS = list(S.VOCABULARY["domain"][0])
#: Every such line begins a paragraph.
LINES_PER_PARAGRAPH = 3
MAX_WORDS, MIN_WORDS = 100, 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pick(values: list[str], number: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, values)), (number % len(values)).cast("int") + 1)


def chapter(ident: Column) -> Column:
    return pick(NAMES, ident)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as chunks: id, text, chapter, echelon (null for one in five)
    and paragraph id."""
    d = table(spark, sf_dir, "documents").select("doc_id", "text")
    number = F.col("doc_id")
    return d.select(
        "doc_id", "text", chapter(number).alias("chapter_num"), F.when(number % 5 != 4, pick(ECHELONS, number % 5)).alias("echelon"),
        F.concat_ws("-", chapter(number), (number % 50 + 1).cast("string")).alias("para_id"),
    )


def seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User turns with the assistant turn that follows."""
    w = Window.partitionBy("conv_id").orderBy("turn")
    c = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    c = c.withColumns({"next_role": F.lead("role").over(w), "answer": F.lead("text").over(w)})
    c = c.where("role = 'user' AND next_role = 'assistant'")
    key = F.concat_ws("|", F.col("conv_id").cast("string"), F.col("turn").cast("string"))
    cited = F.concat(F.col("answer"), F.when(F.col("conv_id") % 5 != 0, F.concat(F.lit(" [Reference: ATP 2-01.3, para 3-"), F.col("turn").cast("string"), F.lit("]"))).otherwise(F.lit("")))
    cited = F.concat(F.when(F.col("conv_id") % 11 == 0, F.lit("According to ATP ")).otherwise(F.lit("")), cited)
    trace = F.concat(F.split_part("answer", F.lit("."), F.lit(1)), F.when(F.col("turn") % 4 != 3, F.lit(" para 3-1")).otherwise(F.lit("")))
    number = F.col("conv_id")
    return c.select(
        "conv_id", "turn", key.alias("key"), F.col("text").alias("question"), "answer", cited.alias("answer_c"), trace.alias("trace"),
        draw_type(key).alias("question_type"), chapter(number).alias("chapter_num"), pick(ECHELONS, number).alias("echelon"), pick(DOMAINS, F.col("turn")).alias("domain"),
        F.concat_ws("-", chapter(number), (number % 7 + 1).cast("string")).alias("para_id"), (number % 5).cast("int").alias("shard"),
    )


# --- the same in SQL --------------------------------------------------------


def sql_list(values) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


def sql_pick(values, number: str) -> str:
    return f"{sql_list(values)}[CAST(({number}) % {len(values)} AS INT) + 1]"


def sql_map(key: str, table_: dict, kind: str) -> str:
    def lit(v):
        return "'" + v.replace("'", "''") + "'" if isinstance(v, str) else str(v)

    whens = " ".join(f"WHEN {lit(k)} THEN {lit(v)}" for k, v in table_.items() if v is not None)
    return f"CAST(CASE {key} {whens} END AS {kind})"


def sql_draw(key: str) -> str:
    halves = [round(2 * w) for w, _, _ in S.QUESTION_TYPES.values()]
    number = f"CAST('0x' || substr(md5('{S.SEED_NUMBER}|' || {key}), 1, 8) AS BIGINT) % {sum(halves)}"
    below, whens = 0, []
    for name, h in zip(S.QUESTION_TYPES, halves):
        below += h
        whens.append(f"WHEN {number} < {below} THEN '{name}'")
    return f"CASE {' '.join(whens)} END"


def sql_words(c: str) -> str:
    return f"CAST(len(regexp_extract_all({c}, '{WORD}')) AS INT)"


def sql_strip(c: str) -> str:
    return f"regexp_replace({c}, '^{SPACE}+|{SPACE}+$', '', 'g')"


STEPS = {k: v[1] for k, v in S.CHAPTERS.items()}
WEIGHTS = {k: v[2] for k, v in S.CHAPTERS.items()}
TITLES = {k: v[0] for k, v in S.CHAPTERS.items()}

SQL_DOCUMENTS = f"""docs AS (
  SELECT doc_id, text, {sql_pick(NAMES, 'doc_id')} AS chapter_num, CASE WHEN doc_id % 5 <> 4 THEN {sql_pick(ECHELONS, 'doc_id % 5')} END AS echelon,
    {sql_pick(NAMES, 'doc_id')} || '-' || (doc_id % 50 + 1) AS para_id FROM documents)"""

SQL_LINES = """lines AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS i FROM documents)"""

SQL_SEEDS = f"""turns AS (
  SELECT *, lead(role) OVER w AS next_role, lead(text) OVER w AS answer FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)),
seeds AS (
  SELECT conv_id, turn, conv_id || '|' || turn AS key, text AS question, answer,
    (CASE WHEN conv_id % 11 = 0 THEN 'According to ATP ' ELSE '' END) || answer
      || (CASE WHEN conv_id % 5 <> 0 THEN ' [Reference: ATP 2-01.3, para 3-' || turn || ']' ELSE '' END) AS answer_c,
    split_part(answer, '.', 1) || (CASE WHEN turn % 4 <> 3 THEN ' para 3-1' ELSE '' END) AS trace,
    {sql_draw("(conv_id || '|' || turn)")} AS question_type, {sql_pick(NAMES, 'conv_id')} AS chapter_num,
    {sql_pick(ECHELONS, 'conv_id')} AS echelon, {sql_pick(DOMAINS, 'turn')} AS domain,
    {sql_pick(NAMES, 'conv_id')} || '-' || (conv_id % 7 + 1) AS para_id, CAST(conv_id % 5 AS INT) AS shard
  FROM turns WHERE role = 'user' AND next_role = 'assistant')"""
