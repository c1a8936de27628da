"""Scoring of responses: keyword coverage, penalties, reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textkiln import schemas as S


def coverage(response: Column, keywords: Column) -> Column:
    """Share of keywords found in the response, to 3 digits half to even; 0 for
    no keywords."""
    low = F.lower(response)
    hits = F.size(F.filter(keywords, lambda k: F.contains(low, F.lower(k)))).cast("double")
    return F.when(F.size(keywords) > 0, F.bround(hits / F.size(keywords), 3)).otherwise(F.lit(0.0))


def scored(rows: DataFrame, response: str, keywords: str) -> DataFrame:
    """Adds ``kw_score, has_citation, ok_opening, score, needs_dpo``. Each flaw
    costs a tenth, never below 0; the flag looks at the unrounded value."""
    text = F.coalesce(F.col(response), F.lit(""))
    rows = rows.withColumn("kw_score", coverage(text, F.col(keywords)))
    rows = rows.withColumn("has_citation", text.rlike(S.CITATION_PATTERN)).withColumn("ok_opening", ~text.rlike(S.BAD_OPENING_LOOSE_PATTERN))
    zero, cost = F.lit(0.0), F.lit(S.PENALTY)
    exact = F.when(F.col("has_citation"), F.col("kw_score")).otherwise(F.greatest(zero, F.col("kw_score") - cost))
    exact = F.when(F.col("ok_opening"), exact).otherwise(F.greatest(zero, exact - cost))
    return rows.withColumn("score", F.bround(exact, 3)).withColumn("needs_dpo", exact < S.WEAK_SCORE)


def marker(delta: Column, step: float = 0.05) -> Column:
    return F.when(delta > step, F.lit("↑")).when(delta < -step, F.lit("↓")).otherwise(F.lit("="))


def compare(base: DataFrame, tuned: DataFrame, key: str = "id") -> DataFrame:
    """Base and tuned scores of the same questions, joined by id."""
    rows = tuned.select(key, F.col("score").alias("ft_score")).join(base.select(key, F.col("score").alias("base_score")), key)
    delta = F.bround(F.col("ft_score") - F.col("base_score"), 4)
    return rows.select(key, "base_score", "ft_score", delta.alias("delta"), marker(delta).alias("marker"))


def run_summary(base: DataFrame, tuned: DataFrame, key: str = "id") -> DataFrame:
    """Averages of either model, their difference, and the weak ids in order."""
    weak = F.array_join(F.array_sort(F.collect_list(F.when(F.col("needs_dpo"), F.col(key)))), ",")
    a = tuned.agg(F.avg("score").alias("ft"), weak.alias("dpo_ids"), F.count("*").alias("n"))
    b = base.agg(F.avg("score").alias("base"))
    return a.crossJoin(b).select(
        F.bround("ft", 4).alias("ft_avg"), F.bround("base", 4).alias("base_avg"), F.bround(F.col("ft") - F.col("base"), 4).alias("delta"), F.lit(S.WEAK_SCORE).alias("dpo_threshold"), "dpo_ids", "n"
    )


def rouge_report(rows: DataFrame) -> DataFrame:
    """Micro averages over ``base_rouge`` and ``ft_rouge``, macro ones over
    types, percent change of either, rows improved."""
    by_type = rows.groupBy("question_type").agg(F.avg("base_rouge").alias("b"), F.avg("ft_rouge").alias("f"))
    macro = by_type.agg(F.avg("b").alias("macro_base"), F.avg("f").alias("macro_ft"))
    micro = rows.agg(F.avg("base_rouge").alias("micro_base"), F.avg("ft_rouge").alias("micro_ft"), F.count_if(F.col("ft_rouge") > F.col("base_rouge")).alias("n_improved"), F.count("*").alias("n"))
    change = lambda b, f: (F.col(f) - F.col(b)) / F.greatest(F.col(b), F.lit(1e-9)) * 100
    out = micro.crossJoin(macro)
    return out.select(*[F.bround(c, 6).alias(c) for c in ("micro_base", "micro_ft", "macro_base", "macro_ft")], F.bround(change("micro_base", "micro_ft"), 3).alias("micro_change"), F.bround(change("macro_base", "macro_ft"), 3).alias("macro_change"), "n_improved", "n")
