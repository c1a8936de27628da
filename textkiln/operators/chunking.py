"""Paragraph chunks of long structured documents.

The whole segmentation is one fold over a document's lines, so a corpus is cut
without a shuffle and without a window: documents are independent rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textkiln import schemas as S
from textkiln.functions import text as T

_PIECE = "array<struct<para_id:string,chapter:string,section:string,start:int,from:int,to:int,word_count:int>>"


def para_prefix(line: Column) -> Column:
    """Digits or appendix letter of a paragraph start, null for other lines."""
    number = F.regexp_extract(line, S.PARA_START_PATTERN, 1)
    letter = F.regexp_extract(line, S.APPENDIX_START_PATTERN, 1)
    return F.when(number != "", number).when(letter != "", letter)


def para_id(line: Column) -> Column:
    number = F.coalesce(F.nullif(F.regexp_extract(line, S.PARA_START_PATTERN, 2), F.lit("")), F.regexp_extract(line, S.APPENDIX_START_PATTERN, 2))
    return F.when(para_prefix(line).isNotNull(), F.concat_ws("-", para_prefix(line), number))


def chapter_of_prefix(prefix: Column) -> Column:
    """Chapters 1 to 8 and appendices A to D; other numbers have none, and
    leading zeros do not matter."""
    plain = F.regexp_replace(prefix, r"^0+(?=\d)", "")
    return F.when(plain.isin(*S.CHAPTERS), plain)


def default_start(line: Column, number: Column) -> tuple[Column, Column, Column]:
    """(is a start, paragraph id, chapter) of a line by its own text."""
    return para_prefix(line).isNotNull(), para_id(line), chapter_of_prefix(para_prefix(line))


Start = Callable[[Column, Column], tuple[Column, Column, Column]]


def describe(lines: Column, start: Start = default_start) -> Column:
    """What the fold needs to know of each line, in one pass over the lines."""

    def one(line, i):
        is_start, pid, chapter = start(line, i)
        heading = F.when(T.is_heading(line), T.strip(line))
        return F.struct(i.alias("i"), T.word_count(line).alias("wc"), is_start.alias("start"), pid.alias("para_id"), chapter.alias("chapter"), heading.alias("heading"))

    return F.transform(lines, one)


def pieces(described: Column, max_words: int = S.MAX_CHUNK_WORDS, min_words: int = S.MIN_CHUNK_WORDS, lookback: int = S.LOOKBACK_LINES) -> Column:
    """The chunks of one text as an array, from its described lines.

    ``described`` should be a column of its own: the fold looks back into it.

    Lines before the first start are lost. A chunk ends before the next start,
    or after the line that takes it over ``max_words``; the rest goes on under
    the same id. A chunk under ``min_words`` or without a chapter is lost. Its
    section is the last heading from ``lookback`` lines before the paragraph's
    start to the chunk's end, else "General".
    """

    def last_heading(rows: Column) -> Column:
        found = F.filter(rows, lambda r: r["heading"].isNotNull())
        return F.try_element_at(F.transform(found, lambda r: r["heading"]), F.lit(-1))

    def piece(state: Column, to: Column, section: Column, words: Column) -> Column:
        return F.struct(
            state["para_id"].alias("para_id"), state["chapter"].alias("chapter"), F.coalesce(section, F.lit("General")).alias("section"),
            state["start"].alias("start"), state["from"].alias("from"), to.alias("to"), words.alias("word_count"),
        )

    def emitted(state: Column, to: Column, section: Column, words: Column) -> Column:
        good = state["chapter"].isNotNull() & (words >= min_words)
        return F.when(good, F.concat(state["out"], F.array(piece(state, to, section, words)))).otherwise(state["out"])

    def state_of(para, chapter, section, begin, at, words, out):
        return F.struct(para.alias("para_id"), chapter.alias("chapter"), section.alias("section"), begin.alias("start"), at.alias("from"), words.alias("words"), out.alias("out"))

    none = F.lit(None).cast("string")
    empty = state_of(none, none, none, F.lit(-1), F.lit(0), F.lit(0), F.array().cast(_PIECE))

    def step(state, x):
        before = F.slice(described, F.greatest(x["i"] - lookback, F.lit(0)) + 1, F.least(x["i"], F.lit(lookback)))
        fresh = x["start"]
        flushed = F.when(fresh & (state["start"] >= 0), emitted(state, x["i"] - 1, state["section"], state["words"])).otherwise(state["out"])
        para = F.when(fresh, x["para_id"]).otherwise(state["para_id"])
        chapter = F.when(fresh, x["chapter"]).otherwise(state["chapter"])
        section = F.coalesce(x["heading"], F.when(fresh, last_heading(before)).otherwise(state["section"]))
        begin = F.when(fresh, x["i"]).otherwise(state["start"])
        at = F.when(fresh, x["i"]).otherwise(state["from"])
        words = F.when(begin < 0, F.lit(0)).otherwise(F.when(fresh, F.lit(0)).otherwise(state["words"]) + x["wc"])
        now = state_of(para, chapter, section, begin, at, words, flushed)
        over = words > max_words
        return F.when(over, state_of(para, chapter, section, begin, x["i"] + 1, F.lit(0), emitted(now, x["i"], section, words))).otherwise(now)

    def finish(state):
        return F.when(state["start"] >= 0, emitted(state, F.size(described) - 1, state["section"], state["words"])).otherwise(state["out"])

    return F.aggregate(described, empty, step, finish)


def chunk(docs: DataFrame, text: str = "text", start: Start = default_start, **options) -> DataFrame:
    """The columns of ``docs`` but the text, then one row per chunk."""
    lines = F.col("__lines")
    rows = docs.withColumn("__lines", F.split(F.col(text), "\n", -1)).withColumn("__described", describe(lines, start))
    rows = rows.withColumn("piece", F.explode(pieces(F.col("__described"), **options)))
    body = T.strip(F.array_join(F.slice(lines, F.col("piece.from") + 1, F.col("piece.to") - F.col("piece.from") + 1), "\n"))
    others = [c for c in docs.columns if c != text]
    return rows.select(
        *others,
        F.col("piece.para_id").alias("para_id"),
        body.alias("text"),
        F.col("piece.chapter").alias("chapter_num"),
        T.lookup(F.col("piece.chapter"), {k: v[0] for k, v in S.CHAPTERS.items()}, "string").alias("chapter_title"),
        F.col("piece.section").alias("section"),
        F.col("piece.from").alias("from_line"),
        F.col("piece.to").alias("to_line"),
        F.col("piece.word_count").alias("word_count"),
        T.has_figure(body).alias("has_figure_reference"),
        T.cross_references(body).alias("cross_references"),
    )


def split_lookahead(docs: DataFrame, min_words: int = 10, start: str = r"(?:\d+-\d+|[A-D]-\d+)\.\s") -> DataFrame:
    """The simpler cut: at every line that begins like ``start``; parts under
    ``min_words`` go; a part without an id gets ``unk-n`` by its number."""
    parts = F.split(F.col("text"), rf"(?m)(?=^{start})", -1)
    kept = F.filter(F.transform(parts, T.strip), lambda p: T.word_count(p) >= min_words)
    rows = docs.select("doc_id", F.posexplode(kept).alias("n", "part"))
    found = F.regexp_extract("part", r"^(\d+-\d+|[A-D]-\d+)\.\s+", 1)
    number = F.regexp_extract("part", r"^(\d+)-\d+\.\s+", 1)
    title = F.coalesce(T.lookup(number, {k: v[0] for k, v in S.CHAPTERS.items() if k.isdigit()}, "string"), F.concat(F.lit("Chapter "), number))
    return rows.select(
        "doc_id",
        F.format_string("chunk_%04d", "n").alias("chunk_id"),
        F.when(found != "", found).otherwise(F.format_string("unk-%d", "n")).alias("para_id"),
        F.when(number != "", number.cast("int")).alias("chapter_num"),
        F.when(number != "", title).otherwise(F.lit("Appendix")).alias("chapter_title"),
        T.word_count(F.col("part")).alias("word_count"),
        F.md5("part").alias("part_md5"),
    )


def chunk_report(chunks: DataFrame) -> DataFrame:
    """One row: chunks, words, floor of the average, chunks naming a figure."""
    n, total = F.count("*"), F.coalesce(F.sum("word_count"), F.lit(0)).cast("long")
    return chunks.agg(
        n.alias("n_chunks"), total.alias("n_words"), F.floor(total / F.greatest(n, F.lit(1))).cast("long").alias("avg_words"),
        F.count_if("has_figure_reference").alias("n_figures"),
    )


def number_chunks(chunks: DataFrame, *order: str) -> DataFrame:
    """``chunk_id`` 0, 1, 2... in document order without one task for all rows.

    Rows are range-partitioned in order; a partition's first number is the sum
    of the counts before it, which are as many as there are partitions.
    """
    from textkiln.operators.ranking import dense_row_number

    return dense_row_number(chunks, [F.col(c) for c in order], "chunk_id", start=0)
