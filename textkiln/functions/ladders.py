"""JSON out of free text: rungs tried in order, the first that parses counts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from textkiln import schemas as S

from .text import strip, strip_thinking

def is_json(c: Column) -> Column:
    """True for a text that is one JSON value and nothing more.

    Parsers stop behind the first value; inside brackets and inside braces what
    follows it would have to fit as well.
    """
    listed = F.json_array_length(F.concat(F.lit("["), c, F.lit("]"))) == 1
    named = F.size(F.json_object_keys(F.concat(F.lit('{"x":'), c, F.lit("}")))) == 1
    return F.coalesce(F.try_parse_json(c).isNotNull() & listed & named, F.lit(False))


def _parsed(c: Column) -> Column:
    """The text itself where it is valid JSON, else null."""
    return F.when(is_json(c), c)


def _match(c: Column, pattern: str, group: int) -> Column:
    """First match; null, not '', without one."""
    return F.when(c.rlike(pattern), F.regexp_extract(c, pattern, group))


def first_json(c: Column) -> Column:
    """Whole text, fenced block, first flat object; null if none parses."""
    return F.coalesce(_parsed(strip(c)), _parsed(_match(c, S.JSON_FENCE, 1)), _parsed(_match(c, S.JSON_FLAT, 0)))


def longest_json(c: Column) -> Column:
    """Reasoning stripped; whole text, fenced block, then the objects of up to
    two levels, longest first (the earlier of equals)."""
    t = strip_thinking(c)
    blocks = F.regexp_extract_all(t, F.lit(S.JSON_NESTED), F.lit(0))
    ranked = F.array_sort(F.transform(blocks, lambda b, i: F.struct((-F.length(b)).alias("rank"), i.alias("at"), b.alias("block"))))
    good = F.filter(ranked, lambda r: is_json(r["block"]))
    return F.coalesce(_parsed(strip(t)), _parsed(_match(t, S.JSON_FENCE, 1)), F.get(good, F.lit(0))["block"])


def is_object_with_keys(json: Column) -> Column:
    """True for a JSON object that is not empty."""
    return F.coalesce(F.size(F.json_object_keys(json)) > 0, F.lit(False))
