"""Validation of question and answer records: ordered rules, first failure."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textkiln import schemas as S
from textkiln.functions import text as T


@dataclass(frozen=True)
class Record:
    """Stripped texts and their word counts, each computed once per row."""

    question: Column
    answer: Column
    trace: Column
    citations: Column


@dataclass(frozen=True)
class Rule:
    reason: str
    fails: Callable[[Record], Column]


def _leaks(r: Record) -> Column:
    low = F.lower(r.question)  # not upper: it would change the length of ß
    return F.contains(low, F.lit("source text")) | F.contains(low, F.lit("source a"))


BASE = (
    Rule("empty question", lambda r: r.question == ""),
    Rule("empty answer", lambda r: r.answer == ""),
    Rule("question too short", lambda r: T.word_count(r.question) < S.MIN_QUESTION_WORDS),
    Rule("answer too short", lambda r: T.word_count(r.answer) < S.MIN_ANSWER_WORDS),
    Rule("trace too long", lambda r: T.word_count(r.trace) > S.MAX_TRACE_WORDS),
    Rule("bad opening", lambda r: r.answer.rlike(S.BAD_OPENING_PATTERN)),
    Rule("missing citation", lambda r: ~r.answer.rlike(S.CITATION_PATTERN)),
    Rule("trace without paragraph", lambda r: ~r.trace.rlike(S.PARA_REFERENCE_PATTERN)),
    Rule("prompt leak", _leaks),
)
#: Appendix paragraphs have no numbers that the trace rule could find.
APPENDIX = tuple(r for r in BASE if r.reason != "trace without paragraph")
STRICT = (
    Rule("question too short", lambda r: T.word_count(r.question) < S.MIN_QUESTION_WORDS),
    Rule("answer too short", lambda r: T.word_count(r.answer) < S.MIN_ANSWER_WORDS),
    Rule("trace too short", lambda r: T.word_count(r.trace) < 30),
    Rule("missing citation", lambda r: ~F.contains(r.answer, F.lit("[Reference:"))),
    Rule("bad opening", lambda r: F.startswith(r.answer, F.lit("According to"))),
    Rule("trace without paragraph", lambda r: ~r.trace.rlike(r"para\s+\d+-\d+")),
    Rule("trace too long", lambda r: T.word_count(r.trace) > 400),
    Rule("bad citation id", lambda r: F.exists(F.coalesce(r.citations, F.array().cast("array<string>")), lambda p: ~p.rlike(r"^[A-D]?-?\d+-?\d+$"))),
)
PROFILES = {"base": BASE, "appendix": APPENDIX, "strict": STRICT}


def reason(profile: str, question: Column, answer: Column, trace: Column, citations: Column | None = None) -> Column:
    """``ok`` or the first rule that fails. Nulls count as empty."""
    q, a, t = (T.strip(F.coalesce(c, F.lit(""))) for c in (question, answer, trace))
    record = Record(q, a, t, citations if citations is not None else F.lit(None).cast("array<string>"))
    out = F
    for rule in PROFILES[profile]:
        out = out.when(rule.fails(record), F.lit(rule.reason))
    return out.otherwise(F.lit("ok"))


def reject_reasons(judged: DataFrame, column: str = "reason") -> DataFrame:
    return judged.groupBy(F.col(column).alias("reason")).agg(F.count("*").alias("n"))
