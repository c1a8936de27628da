"""Prompts for generation: a profile's templates filled from chunk columns."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F

from textkiln import schemas as S

#: What each question type asks for.
INSTRUCTIONS = {
    "factual": "Write one question about a single fact that the source states, and answer it from the source alone.",
    "procedural": "Write one question about how something is carried out, and answer it with the steps in their order.",
    "comparative": "Write one question that sets two things of the source side by side, and answer with what they share and where they part.",
    "echelon_specific": "Write one question that only makes sense at the echelon named above, and answer it for that echelon.",
    "applied_reasoning": "Invent a short situation, ask what follows from the source in it, and give the reasoning with the answer.",
    "product_generation": "Ask for one finished product that the source describes, and answer with that product filled in.",
    "cross_step": "Write one question that links this step to an earlier or later one, and answer how the one feeds the other.",
    "multi_domain": "Write one question that touches more than one domain, and answer for each domain by itself.",
    "contrastive": "Write one question that both sources bear on but treat differently, and answer with that difference.",
}


@dataclass(frozen=True)
class Profile:
    """Templates take: unit, title, id, echelon, text (twice for pairs), task."""

    unit: str = "Chapter"
    single: str = S.SINGLE_PROMPT
    pair: str = S.PAIR_PROMPT
    single_chars: int = 800
    pair_chars: int = 600
    instructions: dict = field(default_factory=lambda: dict(INSTRUCTIONS))


CHAPTERS = Profile()
APPENDICES = Profile(unit="Appendix")


def _source(profile: Profile, c: dict[str, Column], chars: int) -> list[Column]:
    title = F.coalesce(c["chapter_title"], F.concat(F.lit(f"{profile.unit} "), c["chapter_num"]))
    return [F.lit(profile.unit), c["chapter_num"], title, c["para_id"], F.coalesce(c["echelon"], F.lit("general")), F.left(F.coalesce(c["text"], F.lit("")), F.lit(chars))]


def _task(profile: Profile, question_type: Column) -> Column:
    pairs = [F.lit(x) for kv in profile.instructions.items() for x in kv]
    return F.element_at(F.create_map(*pairs), question_type)


def single(a: dict[str, Column], question_type: Column, profile: Profile = CHAPTERS) -> Column:
    return F.format_string(profile.single, *_source(profile, a, profile.single_chars), _task(profile, question_type))


def contrastive(a: dict[str, Column], b: dict[str, Column], profile: Profile = CHAPTERS) -> Column:
    return F.format_string(profile.pair, *_source(profile, a, profile.pair_chars), *_source(profile, b, profile.pair_chars), _task(profile, F.lit("contrastive")))
