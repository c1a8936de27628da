"""Quality rules as a short-circuit cascade.

The base measures decide first. The further rules run one after another on
what is left of a batch, and a document rejected by one is seen by none after
it. Their order is by rejections per unit of cost, both estimated on a bounded
sample; the verdict is the same for any order, only the time differs.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from .frames import bound_batches, give_back, map_texts, need_columns, slices
from .shingles import mix64

# Fixed values of the base measures.
BLANKS = " \t\n\v\f\r"
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50

#: Rows whose cost and rejections order the cascade.
SAMPLE_ROWS = 512


class Text:
    """A text with the parts that several rules need, made when first asked for."""

    def __init__(self, text: str | None):
        self.text = text or ""
        self.words = self.text.encode("utf-8", "replace").split()

    def __len__(self) -> int:
        return len(self.words)

    def word_chars(self) -> int:
        return len(self.text) - sum(map(self.text.count, BLANKS))

    def symbols(self) -> int:
        return sum(map(self.text.count, SYMBOLS))

    def dup_lines(self) -> int:
        lines = [x for x in self.text.split("\n") if x.strip(BLANKS)]
        return len(lines) - len(set(lines))

    def repeat_words(self) -> int:
        """Words inside a 3-word window that the text has twice or more."""
        n = len(self.words)
        if n < 4:
            return 0
        h = np.fromiter(map(xxh3_64_intdigest, self.words), np.uint64, n)
        w = mix64(mix64(h[:-2]) + h[1:-1])
        w = mix64(w + h[2:])
        order = np.argsort(w)
        ordered = w[order]
        same = ordered[1:] == ordered[:-1]
        again = np.zeros(len(w), bool)
        again[order[1:][same]] = True
        again[order[:-1][same]] = True
        cover = np.zeros(n, bool)
        for i in range(3):
            cover[i : i + len(w)] |= again
        return int(cover.sum())


@dataclass(frozen=True)
class Rule:
    name: str
    rejects: Callable[[Text], bool]


def _letters(t: Text) -> tuple[int, int]:
    up = sum(map(str.isupper, t.text))
    return up, up + sum(map(str.islower, t.text))


def _caps(t: Text) -> bool:
    up, cased = _letters(t)
    return cased > 0 and 2 * up > cased


#: Thresholds far from ordinary prose, so that clean documents pass all of them.
RULES = (
    Rule("symbols", lambda t: 10 * t.symbols() > 3 * len(t)),
    Rule("exclamations", lambda t: 10 * t.text.count("!") > 3 * len(t)),
    Rule("stutter", lambda t: 10 * sum(a == b for a, b in zip(t.words, t.words[1:])) > 3 * len(t)),
    Rule("word_length", lambda t: not 2 * len(t) <= t.word_chars() <= 25 * len(t)),
    Rule("no_letters", lambda t: 2 * sum(1 for w in t.words if w.isdigit()) > len(t)),
    Rule("capitals", _caps),
)


def base_failed(n_words: int, n_repeat_words: int) -> bool:
    return n_words < MIN_WORDS or 100 * n_repeat_words > MAX_REPEAT_PERCENT * n_words


def first_failure(t: Text, rules) -> str | None:
    """Name of the first rule that rejects, in the given order."""
    return next((r.name for r in rules if r.rejects(t)), None)


def _trial(rules):
    def run(batches):
        for batch in batches:
            spent, hits, n = [0] * len(rules), [0] * len(rules), 0
            for text in batch.column(0).to_pylist():
                t = Text(text)
                n += 1
                for i, rule in enumerate(rules):
                    began = time.perf_counter_ns()
                    hits[i] += bool(len(t)) and rule.rejects(t)
                    spent[i] += time.perf_counter_ns() - began
            yield pa.RecordBatch.from_pydict({"rule": [r.name for r in rules], "ns": spent, "rejected": hits, "n": [n] * len(rules)})

    return run


def order_rules(docs: DataFrame, rules=RULES, sample_rows: int = SAMPLE_ROWS) -> list[Rule]:
    """Rules by rejections per nanosecond on the ``sample_rows`` documents whose
    hashed id is least. An empty table keeps the given order."""
    texts = need_columns(docs, doc_id="long", text="string")
    chosen = texts.select("doc_id").where("doc_id IS NOT NULL").orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows)
    sample = texts.join(F.broadcast(chosen), "doc_id", "left_semi").select("text")
    seen = sample.mapInArrow(_trial(rules), "rule string, ns long, rejected long, n long")
    rows = {r["rule"]: r for r in seen.groupBy("rule").agg(F.sum("ns").alias("ns"), F.sum("rejected").alias("rejected")).collect()}
    # a little added to both: of rules that rejected nothing the cheapest comes first
    rate = {r.name: (rows[r.name]["rejected"] + 1e-3) / (rows[r.name]["ns"] + 1) for r in rules if r.name in rows}
    return sorted(rules, key=lambda r: -rate.get(r.name, 0))


_OUT = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, failed_rule string"


def assess(docs: DataFrame, rules=None) -> DataFrame:
    """Base measures and verdict of every row of ``docs``.

    Null, empty and blank texts have no words and fail the base rule. Each row
    is judged by itself, so repeated rows and ids get equal verdicts; a null
    ``doc_id`` stays null; an empty table gives no rows; other columns are
    ignored. ``failed_rule`` is ``base``, the rule of the cascade, or null.
    """
    rules = rules or order_rules(docs)

    def fn(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = []
        for text in batch.column(1).to_pylist():
            t = Text(text)
            n, again = len(t), t.repeat_words()
            base = base_failed(n, again)
            why = "base" if base else first_failure(t, rules)
            rows.append((n, t.word_chars(), t.symbols(), t.dup_lines(), again, base, why is None, why))
        cols = list(zip(*rows))
        kinds = [pa.int64()] * 5 + [pa.bool_(), pa.bool_(), pa.string()]
        names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "failed_rule"]
        return pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(c, k) for c, k in zip(cols, kinds)]], names=["doc_id", *names])

    return map_texts(need_columns(docs, doc_id="long", text="string"), "text", fn, _OUT)


def keep_good(docs: DataFrame, rules=None) -> DataFrame:
    """The rows that pass, with all their columns as they came."""
    rules = rules or order_rules(docs)
    bound_batches(docs.sparkSession)

    def run(batches):
        for batch in batches:
            for piece in slices(batch, "text"):
                mask = []
                for text in piece.column(piece.schema.get_field_index("text")).to_pylist():
                    t = Text(text)
                    mask.append(not base_failed(len(t), t.repeat_words()) and first_failure(t, rules) is None)
                yield piece.filter(pa.array(mask, pa.bool_()))
        give_back()

    return docs.mapInArrow(run, docs.schema)


def oracle_sql() -> str:
    """DuckDB SQL for the rows of ``assess`` over ``documents``."""
    blank = r"[\x20\x09-\x0D]"
    strip = " || ".join(f"chr({ord(c)})" for c in BLANKS)
    return rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, CASE WHEN trim(t, {strip}) = '' THEN [] ELSE string_split_regex(trim(t, {strip}), '{blank}+') END AS words,
  [x FOR x IN string_split(t, chr(10)) IF trim(x, {strip}) <> ''] AS lines FROM d),
m AS (SELECT r, doc_id, t, words, len(words) AS n_words, length(regexp_replace(t, '{blank}', '', 'g')) AS word_chars,
  length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols, len(lines) - len(list_distinct(lines)) AS n_dup_lines FROM w),
p AS (SELECT r, unnest(words) AS word, generate_subscripts(words, 1) AS i FROM m),
n AS (SELECT r, i, word, lead(word) OVER o AS w2, lead(word, 2) OVER o AS w3 FROM p WINDOW o AS (PARTITION BY r ORDER BY i)),
g AS (SELECT r, word, w2, w3 FROM n WHERE w3 IS NOT NULL GROUP BY ALL HAVING count(*) > 1),
c AS (SELECT r, count(*) AS n_repeat_words FROM (
  SELECT DISTINCT r, unnest([i, i + 1, i + 2]) AS i FROM n JOIN g USING (r, word, w2, w3)) GROUP BY r),
s AS (SELECT r, count(*) FILTER (word = w2) AS twice, count(*) FILTER (regexp_full_match(word, '[0-9]+')) AS digits FROM n GROUP BY r),
a AS (SELECT m.*, coalesce(n_repeat_words, 0) AS n_repeat_words, coalesce(twice, 0) AS twice, coalesce(digits, 0) AS digits,
  length(regexp_replace(t, '[^!]', '', 'g')) AS loud, length(regexp_replace(t, '\P{{Lu}}', '', 'g')) AS up, length(regexp_replace(t, '\P{{Ll}}', '', 'g')) AS low
  FROM m LEFT JOIN c USING (r) LEFT JOIN s USING (r)),
b AS (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS base_failed FROM a)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND NOT 10 * n_symbols > 3 * n_words AND NOT 10 * loud > 3 * n_words AND NOT 10 * twice > 3 * n_words
  AND word_chars BETWEEN 2 * n_words AND 25 * n_words AND NOT 2 * digits > n_words AND NOT (up + low > 0 AND 2 * up > up + low) AS kept
FROM b"""
