"""Text functions, Column to Column, with Python's notion of white space."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from textkiln import schemas as S

#: White space as ``str.split`` and ``str.strip`` see it.
SPACE = r"[\s\x0b\p{Z}\x1c-\x1f\x85]"
WORD = r"[^\s\x0b\p{Z}\x1c-\x1f\x85]+"


def strip(c: Column) -> Column:
    return F.regexp_replace(c, rf"^{SPACE}+|{SPACE}+$", "")


def words(c: Column) -> Column:
    return F.regexp_extract_all(c, F.lit(WORD), F.lit(0))


def word_count(c: Column) -> Column:
    return F.size(words(c))


def strip_noise(c: Column) -> Column:
    """Running heads, captions and references to figures go, in fixed order;
    then runs of blank lines shrink and the ends are stripped."""
    clean = reduce(lambda x, p: F.regexp_replace(x, p, ""), S.NOISE_PATTERNS, c)
    return strip(F.regexp_replace(clean, r"\n{3,}", "\n\n"))


def is_heading(line: Column) -> Column:
    """All capitals (a cased letter, none lower-case), over 5 characters, no
    number and not the manual's running head."""
    s = strip(line)
    upper = ~s.rlike(r"\p{Ll}") & (s != F.lower(s))
    return (F.length(s) > 5) & upper & ~s.rlike(r"^ATP\s+2-01") & ~s.rlike(r"^\d+$")


def cross_references(c: Column) -> Column:
    return F.regexp_extract_all(c, F.lit(S.CROSS_REFERENCE_PATTERN), F.lit(1))


def has_figure(c: Column) -> Column:
    return c.rlike(S.FIGURE_PATTERN)


def lookup(key: Column, table: dict, kind: str) -> Column:
    """A literal map; unknown keys and None values are null."""
    pairs = [F.lit(x) for k, v in table.items() if v is not None for x in (k, v)]
    return F.element_at(F.create_map(*pairs), key).cast(kind)


def first_keyword(lowered: Column, pairs, default: str) -> Column:
    """Value of the first keyword, in list order, that the text contains."""
    out = F
    for word, value in pairs:
        out = out.when(F.contains(lowered, F.lit(word)), F.lit(value))
    return out.otherwise(F.lit(default))


def title_case(c: Column) -> Column:
    return F.initcap(F.replace(c, F.lit("_"), F.lit(" ")))


def strip_thinking(c: Column) -> Column:
    """Without <think> blocks and "Thinking... done thinking." passages."""
    c = F.regexp_replace(c, r"(?s)<think>.*?</think>", "")
    return strip(F.regexp_replace(c, r"(?s)Thinking\.\.\..*?done thinking\.", ""))


def strip_channel(c: Column) -> Column:
    """Without a thought channel, as it is before scoring."""
    return strip(F.regexp_replace(c, r"(?s)<\|channel>thought.*?<channel\|>", ""))


def parse_thinking(c: Column) -> Column:
    """``STRUCT<thinking, content>``: <think> parts, else what stands before the
    last channel mark, else nothing."""
    parts = F.regexp_extract_all(c, F.lit(r"(?s)<think>(.*?)</think>"), F.lit(1))
    segments = F.split(c, r"<channel\|>", -1)
    n = F.size(segments)
    thinking = (
        F.when(F.size(parts) > 0, F.array_join(parts, "\n"))
        .when(n > 1, F.array_join(F.slice(segments, F.lit(1), F.greatest(n - 1, F.lit(1))), "<channel|>"))
        .otherwise(F.lit(""))
    )
    content = F.when(F.size(parts) > 0, F.regexp_replace(c, r"(?s)<think>.*?</think>", "")).otherwise(F.element_at(segments, -1))
    return F.struct(strip(thinking).alias("thinking"), strip(content).alias("content"))


def coerce_string(c: Column, kind: str) -> Column:
    """Any value as text: arrays joined by spaces, structs and maps as JSON."""
    if kind.startswith("array"):
        return F.array_join(F.transform(c, lambda x: x.cast("string")), " ")
    if kind.startswith(("struct", "map")):
        return F.to_json(c)
    return c.cast("string")


def parse_labelled_qa(c: Column) -> Column:
    """``STRUCT<question, answer>`` of QUESTION: and ANSWER: labels, or null where
    either is missing or too short (5 and 10 words)."""
    plain = F.regexp_replace(c, r"\*+", "")
    found = plain.rlike(r"(?is)QUESTION\s*:\s*.+") & plain.rlike(r"(?is)ANSWER\s*:\s*.+")
    body = F.regexp_extract(plain, r"(?is)QUESTION\s*:\s*(.+?)(?:ANSWER\s*:|$)", 1)
    question = strip(F.split_part(strip(body), F.lit("\n"), F.lit(1)))
    answer = strip(F.regexp_extract(plain, r"(?is)ANSWER\s*:\s*(.+)", 1))
    good = found & (word_count(question) >= 5) & (word_count(answer) >= 10)
    return F.when(good, F.struct(question.alias("question"), answer.alias("answer")))


def resolve_model_name(c: Column) -> Column:
    """A model's name without the suffixes of its quantised builds."""
    return F.regexp_replace(c, r"(-unsloth)?-bnb-4bit$", "")


def model_candidates(base: Column, override: Column) -> Column:
    """Names under which a full-precision base may be found, in the order in which
    they are tried: the override, the name without its build, the name itself.
    Null and empty names are none, and no name stands twice."""
    names = F.array(override, resolve_model_name(base), base)
    return F.array_distinct(F.filter(names, lambda n: n.isNotNull() & (n != "")))
