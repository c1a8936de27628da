"""Metadata of chunks: lookups, clamps, keyword rules, and the fallback."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textkiln import schemas as S
from textkiln.functions import text as T


def step_of(chapter: Column) -> Column:
    return T.lookup(chapter, {k: v[1] for k, v in S.CHAPTERS.items()}, "int")


def weight_of(chapter: Column, default: float = S.DEFAULT_WEIGHT) -> Column:
    return F.coalesce(T.lookup(chapter, {k: v[2] for k, v in S.CHAPTERS.items()}, "double"), F.lit(default))


def title_of(chapter: Column) -> Column:
    return T.lookup(chapter, {k: v[0] for k, v in S.CHAPTERS.items()}, "string")


def clamp(value: Column, allowed, default: str) -> Column:
    """The trimmed, lower-cased value if allowed, else the default."""
    v = F.lower(T.strip(value.cast("string")))
    return F.when(v.isin(*allowed), v).otherwise(F.lit(default))


def clamp_metadata(read: Column, chapter: Column) -> Column:
    """Metadata with every field in its vocabulary; step and weight are the
    chapter's, whatever was read."""
    fields = [clamp(read[name], *S.VOCABULARY[name]).alias(name) for name in S.VOCABULARY]
    return F.struct(step_of(chapter).alias("ipb_step"), *fields, weight_of(chapter).alias("doctrinal_weight")).cast(S.METADATA)


def classify(text: Column, chapter: Column) -> Column:
    """Metadata by keyword rules, for when nothing was read."""
    low = F.lower(text)
    found = {k: T.first_keyword(low, pairs, "general") for k, pairs in S.KEYWORDS.items()}
    fields = [found.get(k, F.lit(default)).alias(k) for k, (_, default) in S.VOCABULARY.items()]
    return F.struct(step_of(chapter).alias("ipb_step"), *fields, weight_of(chapter).alias("doctrinal_weight")).cast(S.METADATA)


def enrich(chunks: DataFrame, reply: str) -> DataFrame:
    """``metadata`` from the JSON in the column ``reply``; where there is none,
    or an empty object, by rules. ``from_reply`` says which."""
    from textkiln.functions.ladders import first_json, is_object_with_keys

    json = first_json(F.col(reply))
    read = F.from_json(json, ", ".join(f"{k} STRING" for k in S.VOCABULARY))
    good = F.coalesce(is_object_with_keys(json), F.lit(False))
    chapter = F.col("chapter_num")
    meta = F.when(good, clamp_metadata(read, chapter)).otherwise(classify(F.col("text"), chapter))
    return chunks.withColumn("metadata", meta).withColumn("from_reply", good)


def metadata_accepted(chapter: Column, step: Column, content_type: Column, weight: Column, allowed) -> Column:
    """The stricter gate: steps 1 to 4 must be those of chapters 3 to 6."""
    wanted = T.lookup(chapter, {"3": 1, "4": 2, "5": 3, "6": 4}, "int")
    return (wanted.isNull() | step.eqNullSafe(wanted)) & F.coalesce(content_type.isin(*allowed), F.lit(False)) & F.coalesce(weight.between(1.0, 3.0), F.lit(False))


def chapters_in_filter(spec: str) -> list[str]:
    """``"2,3,D"`` as a list; empty entries go, letters are capitals."""
    return [p.strip().upper() for p in spec.split(",") if p.strip()]


def filter_chapters(df: DataFrame, spec: str, chapter: str = "chapter_num") -> DataFrame:
    wanted = chapters_in_filter(spec)
    return df.where(F.col(chapter).isin(*wanted)) if wanted else df
