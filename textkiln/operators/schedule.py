"""Scheduling of generation tasks: a weighted pool, drawn types, partners.

All draws are hashes of a row's own key: the same on any cluster and for any
partitioning, where a seeded generator would depend on row order.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textkiln import schemas as S
from textkiln.functions import text as T
from textkiln.sources.folders import kept

from .enrich import weight_of
from .joins import join_per_key, token
from .ranking import numbered


def shuffle_key(key: Column, seed: int = S.SEED_NUMBER) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}|"), key.cast("string")))


def draw_type(key: Column, seed: int = S.SEED_NUMBER) -> Column:
    """One of the question types, with probability by weight."""
    halves = [round(2 * w) for w, _, _ in S.QUESTION_TYPES.values()]
    number = F.conv(F.substring(shuffle_key(key, seed), 1, 8), 16, 10).cast("long") % sum(halves)
    out, below = F, 0
    for name, h in zip(S.QUESTION_TYPES, halves):
        below += h
        out = out.when(number < below, F.lit(name))
    return out


def copies(weight: Column) -> Column:
    """Weight rounded half to even, once at least."""
    return F.greatest(F.lit(1), F.bround(weight).cast("int"))


def weighted_pool(chunks: DataFrame, chapter: str = "chapter_num") -> DataFrame:
    return chunks.withColumn("copy", F.explode(F.sequence(F.lit(1), copies(weight_of(F.col(chapter))))))


def schedule(chunks: DataFrame, target: int, key: str = "doc_id", seed: int = S.SEED_NUMBER) -> DataFrame:
    """The first ``target`` tasks: the shuffled pool gone through again and
    again, each task with its drawn type. ``task_no`` counts from 1.

    A round has the order of the one before, so the pool is numbered once and a
    round only moves its numbers up; no more rounds are made than needed.
    """
    pool = weighted_pool(chunks).select(key, "chapter_num", "copy")
    ident = F.concat_ws("|", F.col(key).cast("string"), F.col("copy").cast("string"))
    pool, n = numbered(pool, [shuffle_key(ident, seed), F.col(key), F.col("copy")], "place")
    rounds = math.ceil(max(target, 0) / n) if n else 0
    tasks = pool.withColumn("round", F.explode(F.sequence(F.lit(1), F.lit(rounds)) if rounds else F.expr("CAST(array() AS ARRAY<INT>)")))
    tasks = tasks.withColumn("task_no", (F.col("round") - 1) * n + F.col("place")).where(F.col("task_no") <= target)
    drawn = draw_type(F.concat_ws("|", ident, F.col("round").cast("string")), seed)
    return tasks.select(key, "chapter_num", "copy", "round", drawn.alias("question_type"), "task_no")


def contrastive_pairs(chunks: DataFrame, key: str = "doc_id", seed: int = S.SEED_NUMBER) -> DataFrame:
    """Each chunk with a partner drawn evenly from all chunks of its chapter that
    have another echelon and another paragraph, or without one. Nulls are values
    of their own; ``key`` is unique.

    An order-statistic join: chunks are numbered by chapter, echelon, paragraph
    and hash, so what a chunk may not have (its echelon, and its paragraph in
    each other echelon) are a few ranges of numbers. A number is drawn among
    those left, moved over the ranges, and joined: no pair is ever listed.
    """
    parts = {"__c": token(F.col("chapter_num")), "__e": token(F.col("echelon")), "__p": token(F.col("para_id"))}
    rows = chunks.select(key, "chapter_num", "echelon", "para_id").withColumns(parts)
    order = ["__c", "__e", "__p"]
    placed, total = numbered(rows.select(key, *order), [*map(F.col, order), shuffle_key(F.col(key), seed), F.col(key)], "place", start=0)
    blocks = kept(placed.groupBy(*order).agg(F.min("place").alias("start"), F.count("*").alias("n")))
    span = F.struct(F.min("start").alias("start"), F.sum("n").alias("n"))
    # a chapter's and an echelon's range, and the ranges of a paragraph by echelon
    # (there are as many as echelons at most)
    chapter = blocks.groupBy("__c").agg(span.alias("chapter"))
    echelon = blocks.groupBy("__c", "__e").agg(span.alias("echelon"))
    paragraph = blocks.groupBy("__c", "__p").agg(F.collect_list(F.struct("start", "n", "__e")).alias("ranges"))
    blocks = blocks.join(chapter, ["__c"]).join(echelon, ["__c", "__e"]).join(paragraph, ["__c", "__p"])
    others = F.transform(F.filter("ranges", lambda r: r["__e"] != F.col("__e")), lambda r: F.struct(r["start"].alias("start"), r["n"].alias("n")))
    barred = F.array_sort(F.concat(F.array("echelon"), others))
    left = F.col("chapter.n") - F.aggregate(barred, F.lit(0).cast("long"), lambda a, r: a + r["n"])
    rules = blocks.select(*order, "n", F.col("chapter.start").alias("__first"), barred.alias("__barred"), left.alias("__left"))
    drawn = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}|partner|"), F.col(key).cast("string"))), 1, 15), 16, 10).cast("long")
    rows = join_per_key(rows, rules, order, "n", total)
    number = F.when(F.col("__left") > 0, F.aggregate("__barred", F.col("__first") + F.pmod(drawn, F.col("__left")), lambda at, r: F.when(r["start"] <= at, at + r["n"]).otherwise(at)))
    rows = kept(rows.select(key, "chapter_num", "echelon", "para_id", number.alias("place")))
    # a rare echelon's chunk may be the only partner of very many
    asked = rows.where("place IS NOT NULL").groupBy("place").agg(F.count("*").alias("n"))
    partners = placed.select("place", F.col(key).alias("partner_id")).join(asked, "place")
    found = join_per_key(rows.where("place IS NOT NULL"), partners, ["place"], "n", total)
    alone = rows.where("place IS NULL").withColumn("partner_id", F.lit(None).cast(dict(found.dtypes)["partner_id"]))
    return found.union(alone.select(found.columns)).drop("place")


def retype_without_partner(tasks: DataFrame, partner: str = "partner_id") -> DataFrame:
    """Contrastive tasks without a partner become echelon-specific ones."""
    alone = (F.col("question_type") == "contrastive") & F.col(partner).isNull()
    return tasks.withColumn("question_type", F.when(alone, F.lit("echelon_specific")).otherwise(F.col("question_type")))


def long_enough(chunks: DataFrame, text: str = "text", words: int = 30) -> DataFrame:
    """Chunks with words enough to ask about."""
    return chunks.where(T.word_count(F.col(text)) >= words)


def quota_per_chunk(chunks: DataFrame, target: int, low: int = 3, high: int = 12) -> DataFrame:
    """Questions a chunk: the target by share of weight, split over the chunks
    of its chapter, clamped. Totals come from one row per chapter."""
    weight = weight_of(F.col("chapter_num"), default=1.0)
    sizes = chunks.groupBy("chapter_num").agg(F.count("*").alias("n"))
    total = sizes.agg(F.sum(F.col("n") * weight).alias("total"))
    quota = F.floor(F.lit(target) * (weight / F.col("total")) / F.col("n")).cast("int")
    quotas = sizes.crossJoin(F.broadcast(total)).select("chapter_num", F.greatest(F.lit(low), F.least(quota, F.lit(high))).alias("quota"))
    return chunks.join(F.broadcast(quotas), "chapter_num")


def pending(tasks: DataFrame, done: DataFrame, on: list[str]) -> DataFrame:
    """Tasks whose typed key is not done yet; with duplicates, as they came."""
    return tasks.join(done.select(*on).distinct(), on, "left_anti")


def take_valid(rows: DataFrame, target: int, *order: str) -> DataFrame:
    """Stop at the target: the first valid rows by task order."""
    return rows.orderBy(*order).limit(target)


def over_provision(target: int, factor: float = 1.3) -> int:
    return round(target * factor)


@dataclass(frozen=True)
class Generated:
    """The valid rows up to the target, and the tasks that were judged for them."""

    rows: DataFrame
    judged: int
    rounds: int


def generate_until(tasks: DataFrame, target: int, judge: Callable[[DataFrame], DataFrame], task_no: str = "task_no", ok: str = "ok", factor: float = 1.3, floor: float = 0.01) -> Generated:
    """Judge tasks in order until ``target`` of them are valid.

    ``tasks`` are numbered from 1 without gaps, and ``judge`` adds the column
    ``ok``. The first round issues a part of what the target would need at the
    expected rate of 1 in ``factor``; each next one issues what is missing at
    the rate seen so far, and no round more than that. A rate under ``floor`` is
    taken as ``floor``. Rounds are written, so nothing is judged twice.
    """
    total = tasks.agg(F.max(task_no)).first()[0] or 0
    parts, judged, valid, rate = [], 0, 0, 1 / factor
    while valid < target and judged < total:
        # the first look is a tenth: a wrong guess of the rate then costs little
        missing = math.ceil(target / 10) if not judged else target - valid
        n = min(total - judged, math.ceil(missing / rate))
        part = kept(judge(tasks.where((F.col(task_no) > judged) & (F.col(task_no) <= judged + n))))
        parts.append(part.where(ok).drop(ok))
        valid, judged = valid + parts[-1].count(), judged + n
        rate = max(valid / judged, floor)
    if not parts:
        return Generated(judge(tasks.limit(0)).where(ok).drop(ok), 0, 0)
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.union(part)
    if valid > target:  # only the last round can have more than is missing
        last, _ = numbered(parts[-1], [F.col(task_no)], "__place")
        room = target - (valid - parts[-1].count())
        rows = last.where(F.col("__place") <= room).drop("__place")
        for part in parts[:-1]:
            rows = rows.union(part)
    return Generated(rows, judged, len(parts))
