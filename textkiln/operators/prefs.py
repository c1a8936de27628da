"""Preference pairs from weak spots."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textkiln import schemas as S
from textkiln.functions import text as T

from .schedule import shuffle_key

_PREFIXES = {prefix: name for name, (_, _, prefix) in S.QUESTION_TYPES.items()}


def weak_types(weak: DataFrame, column: str = "id") -> DataFrame:
    """Question types of weak ids, by the part before the first hyphen."""
    found = T.lookup(F.split_part(F.col(column), F.lit("-"), F.lit(1)), _PREFIXES, "string")
    return weak.select(found.alias("question_type")).where("question_type IS NOT NULL").distinct()


def matching_seeds(seeds: DataFrame, types: DataFrame) -> DataFrame:
    """Seeds of the weak types; all seeds where no type or no seed matches."""
    hit = seeds.join(F.broadcast(types), "question_type", "left_semi")
    any_hit = hit.limit(1).agg(F.count("*").alias("__any"))
    return hit.unionByName(seeds.join(F.broadcast(any_hit.where("__any = 0")), how="inner").drop("__any"))


def preference_pairs(seeds: DataFrame, rejected: str, key: str, max_pairs: int = 200, seed: int = S.SEED_NUMBER) -> DataFrame:
    """``key, prompt, chosen, rejected`` of the first ``max_pairs`` seeds in
    shuffled order; a rejected text that is missing or has under 10 words is
    replaced; seeds without question or answer go."""
    first = seeds.orderBy(shuffle_key(F.col(key), seed), key).limit(max_pairs)
    q, a, r = T.strip(F.col("question")), T.strip(F.col("answer")), F.coalesce(F.col(rejected), F.lit(""))
    short = T.word_count(r) < S.MIN_REJECTED_WORDS
    rows = first.select(key, q.alias("prompt"), a.alias("chosen"), F.when(short, F.lit(S.FIXED_REJECTED)).otherwise(r).alias("rejected"))
    return rows.where("prompt <> '' AND chosen <> ''")


def rejected_from_answers(seeds: DataFrame, answers: DataFrame, question: str = "question") -> DataFrame:
    """``seeds`` with ``rejected``: the model's own weakest answer to the same
    question (``response`` of least ``score`` below the weak threshold), or null."""
    weak = answers.where(F.col("score") < S.WEAK_SCORE).groupBy(question)
    worst = weak.agg(F.min_by("response", F.struct("score", "response")).alias("rejected"))
    return seeds.join(worst, question, "left")
