"""Token streams of many conversations, split into thinking and answer as they come.

A token brings a piece of thinking, a piece of content, or both. Where a model
keeps its thinking apart, the two buffers are just filled. Where it does not, an
automaton reads the marks out of the content; a mark may be cut between tokens
anywhere, so the longest end of the content that may still become a mark is held
back. The result at the end is that of ``functions.text.parse_thinking``.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

# Fixed marks around thinking.
OPEN, CLOSE, CHANNEL = "<think>", "</think>", "<channel|>"


def held_back(text: str, mark: str) -> int:
    """Length of the longest end of ``text`` that begins ``mark``."""
    return next((n for n in range(min(len(text), len(mark) - 1), 0, -1) if text.endswith(mark[:n])), 0)


class Splitter:
    """The buffers of one conversation. ``pieces`` are content and thoughts in
    turn; the last one is open."""

    def __init__(self, state: dict | None = None):
        s = state or {}
        self.native: str = s.get("native", "")  # thinking that came as such
        self.pieces: list[str] = s.get("pieces", [""])
        self.tail: str = s.get("tail", "")  # what may become a mark
        self.next: int = s.get("next", 0)
        self.early: dict[str, list] = s.get("early", {})  # tokens before their turn
        self.last: int | None = s.get("last")

    def state(self) -> dict:
        return self.__dict__

    def put(self, seq: int, thinking: str, content: str, done: bool) -> None:
        """Take a token; tokens count from 0 and may come in any order, twice too."""
        if seq >= self.next:
            self.early[str(seq)] = [thinking, content]
        if done:
            self.last = seq
        while (token := self.early.pop(str(self.next), None)) is not None:
            self.native += token[0]
            self._feed(token[1])
            self.next += 1

    def _mark(self) -> str:
        return OPEN if len(self.pieces) % 2 else CLOSE

    def _feed(self, piece: str) -> None:
        rest = self.tail + piece
        while True:
            before, found, after = rest.partition(self._mark())
            if not found:
                break
            self.pieces[-1] += before
            self.pieces.append("")
            rest = after
        cut = len(rest) - held_back(rest, self._mark())
        self.pieces[-1] += rest[:cut]
        self.tail = rest[cut:]

    def ended(self) -> bool:
        return self.last is not None and self.next > self.last

    def result(self) -> tuple[str, str]:
        """Thinking and answer of what has come so far; a thought that was never
        closed is none."""
        *closed, still = self.pieces if len(self.pieces) % 2 else [*self.pieces[:-2], f"{self.pieces[-2]}{OPEN}{self.pieces[-1]}"]
        contents, thoughts = [*closed[::2], still + self.tail], closed[1::2]
        if self.native:
            marked = [c + f"{OPEN}{t}{CLOSE}" for c, t in zip(contents, thoughts)]
            return self.native, "".join([*marked, contents[-1]])
        if thoughts:
            return "\n".join(thoughts).strip(), "".join(contents).strip()
        thinking, _, answer = contents[0].rpartition(CHANNEL)
        return thinking.strip(), answer.strip()


_OUT = "n_tokens long, thinking string, content string, done boolean"


def split_stream(tokens: DataFrame, key: list[str], idle: int | None = None) -> DataFrame:
    """Follow a stream of ``key..., seq, thinking, content, done`` rows: per
    micro-batch and conversation one row, updated, of the buffers so far.

    Nulls are empty pieces. The state of a conversation is its own text; it goes
    with the last token, or when nothing came for ``idle`` milliseconds, which
    ends it as it is. (A query with ``idle`` looks at its clock for ever, so it
    needs a trigger that is not ``availableNow``.)
    """
    fields = dict(tokens.dtypes)
    keys = ", ".join(f"{k} {fields[k]}" for k in key)
    names = [*key, "n_tokens", "thinking", "content", "done"]

    def follow(name: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        splitter = Splitter(json.loads(state.get[0]) if state.exists else None)
        for batch in batches:
            for seq, thinking, content, done in zip(batch["seq"], batch["thinking"], batch["content"], batch["done"]):
                splitter.put(int(seq), thinking or "", content or "", bool(done))
        done = splitter.ended() or state.hasTimedOut
        if done and state.exists:
            state.remove()
        elif not done:
            state.update((json.dumps(splitter.state()),))
            if idle:
                state.setTimeoutDuration(idle)
        yield pd.DataFrame([(*name, splitter.next, *splitter.result(), done)], columns=names)

    rows = tokens.select(*key, "seq", "thinking", "content", F.coalesce("done", F.lit(False)).alias("done"))
    return rows.groupBy(*key).applyInPandasWithState(follow, f"{keys}, {_OUT}", "state string", "update", GroupStateTimeout.ProcessingTimeTimeout if idle else GroupStateTimeout.NoTimeout)


def final_rows(updates: DataFrame, path: str, checkpoint: str):
    """Start the sink of finished conversations, a folder a micro-batch; it ends
    when all tokens that are there have been read."""

    def put(batch: DataFrame, number: int) -> None:
        batch.where("done").drop("done").write.mode("overwrite").parquet(f"{path}/batch={number}")

    return updates.writeStream.outputMode("update").foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
