"""Chat templates: rendering, and reading question and answer back."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from textkiln import schemas as S

from .text import lookup, strip, title_case

# Fixed marks of the two chat formats.
BOS, SYSTEM, USER, ASSISTANT, END = "<bos>", "<|system|>", "<|user|>", "<|assistant|>", "<|end|>"
THOUGHT, CHANNEL = "<|channel>thought", "<channel|>"
TURN_USER, TURN_MODEL, TURN_END = "<start_of_turn>user\n", "<start_of_turn>model\n", "<end_of_turn>"

SYSTEM_TEXT = "Answer from the manual only. Context: %s. Echelon: %s. Domain: %s. Cite paragraphs at the end."
TURN_SYSTEM_TEXT = "Answer from the manual only and cite paragraphs at the end."


def system_prompt(step: Column, echelon: Column, domain: Column, template: str = SYSTEM_TEXT) -> Column:
    label = F.coalesce(lookup(step, S.STEP_LABELS, "string"), F.lit(S.NO_STEP_LABEL))
    return F.format_string(template, label, title_case(F.coalesce(echelon, F.lit("general"))), title_case(F.coalesce(domain, F.lit("general"))))


def render(question: Column, trace: Column, answer: Column, system: Column) -> Column:
    """The chat text, null where question or answer is blank. The thought
    channel is there only with a trace."""
    q, t, a = (strip(F.coalesce(c, F.lit(""))) for c in (question, trace, answer))
    reply = F.when(t != "", F.concat(F.lit(f"{THOUGHT}\n"), t, F.lit(f"\n{CHANNEL}\n"), a)).otherwise(a)
    text = F.concat(F.lit(f"{BOS}{SYSTEM}\n"), system, F.lit(f"\n{END}\n{USER}\n"), q, F.lit(f"\n{END}\n{ASSISTANT}\n"), reply, F.lit(f"\n{END}"))
    return F.when((q != "") & (a != ""), text)


def render_turns(question: Column, answer: Column, system: str = TURN_SYSTEM_TEXT) -> Column:
    q, a = (strip(F.coalesce(c, F.lit(""))) for c in (question, answer))
    text = F.concat(F.lit(TURN_USER + system + "\n\n"), q, F.lit(f"{TURN_END}\n{TURN_MODEL}"), a, F.lit(TURN_END))
    return F.when((q != "") & (a != ""), text)


def _before_last(c: Column, mark: str) -> Column:
    parts = F.size(F.split(c, _quoted(mark), -1))
    return F.when(parts > 1, F.call_function("substring_index", c, F.lit(mark), parts - 1)).otherwise(c)


def _quoted(mark: str) -> str:
    return "".join("\\" + ch if ch in "|.*+?()[]{}^$\\" else ch for ch in mark)


def _after(c: Column, mark: str) -> Column:
    """What follows the first mark; null without one."""
    at = F.instr(c, mark)
    return F.when(at > 0, F.substring(c, at + len(mark), F.length(c)))


def parse(c: Column) -> Column:
    """``STRUCT<question, answer>`` of a rendered chat text; '' where missing."""
    user = _after(c, USER)
    question = F.when(F.instr(user, END) > 0, strip(F.substring_index(user, END, 1)))
    channel = strip(_after(c, CHANNEL))
    reply = _after(c, ASSISTANT)
    answer = F.when(channel.isNotNull(), strip(_before_last(channel, END))).when(F.instr(reply, END) > 0, strip(_before_last(reply, END)))
    return F.struct(F.coalesce(question, F.lit("")).alias("question"), F.coalesce(answer, F.lit("")).alias("answer"))


def parse_turns(c: Column) -> Column:
    """The same for the turn format; the question follows the first blank line."""
    block = F.when(F.instr(c, TURN_END) > 0, F.substring_index(_after(c, TURN_USER), TURN_END, 1))
    question = strip(F.coalesce(_after(block, "\n\n"), block))
    model = _after(c, TURN_MODEL)
    answer = F.when(F.instr(model, TURN_END) > 0, strip(_before_last(model, TURN_END)))
    return F.struct(F.coalesce(question, F.lit("")).alias("question"), F.coalesce(answer, F.lit("")).alias("answer"))
