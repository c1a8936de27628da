"""Audit of filters that run one after the other, in every order of them.

A document is reduced to a mask of the filters that it fails. A table of 32
masks by 120 orders holds the step at which the first failing filter removes a
document, so no order is ever run: tasks look their documents' masks up, count
removals by part, label, order and step with ``np.bincount``, and the partial
arrays are summed. All other figures are read off these sums: what fails a
filter is removed at step 1 of the orders that it begins, what fails it alone is
removed at step 5 of the orders that it ends.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_128_digest

from .frames import BROADCAST_ROWS, HOT_ROWS, HOT_SHARE, map_texts, need_columns, reliable, unpacked

FILTERS = "ABCDE"
ORDERS = ["".join(p) for p in permutations(FILTERS)]
MIN_WORDS, MIN_DISTINCT_PERCENT, MAX_UPPER_PERCENT = 50, 65, 5
MARKS = "#$%&*|"
#: Parts that a task counts at once; beyond them it emits what it has.
HELD_PARTS = 256

_UPPER = bytes(range(ord("A"), ord("Z") + 1))
_INNER = bytes(range(0x80, 0xC0))  # bytes that begin no code point
_WORD = re.compile(rb"[^\x20\x09-\x0D]+")
_STEPS = len(FILTERS)
#: Labels, orders and steps of a part's counts; the last step is "never".
_SHAPE = (4, len(ORDERS), _STEPS + 1)


def first_failures() -> np.ndarray:
    """Step (from 0) at which each order removes each mask; ``_STEPS``: never."""
    out = np.full((1 << _STEPS, len(ORDERS)), _STEPS, np.int64)
    for o, order in enumerate(ORDERS):
        for step in reversed(range(_STEPS)):
            out[(np.arange(1 << _STEPS) >> FILTERS.index(order[step])) & 1 == 1, o] = step
    return out


def failures(text: bytes) -> int:
    """Mask of the filters A to D that a text (UTF-8) fails."""
    distinct, words = set(), 0
    for word in _WORD.finditer(text):
        words += 1
        distinct.add(word.group())
    upper = len(text) - len(text.translate(None, _UPPER))
    points = len(text.translate(None, _INNER))
    marked = len(text) > len(text.translate(None, MARKS.encode()))
    return (words < MIN_WORDS) | (100 * len(distinct) < MIN_DISTINCT_PERCENT * words) << 1 | (100 * upper > MAX_UPPER_PERCENT * points) << 2 | marked << 3


def document_masks(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``(part, mask, label)``: per row of ``docs`` its source, the filters that
    it fails and its label (1: good, 2: toxic, 3: both, 0: neither or unknown).

    Texts are read once; copies are found by a digest. The first of each group
    of copies is broadcast where groups are few or large, so a text that a third
    of all rows hold stays where it lies.
    """
    texts = need_columns(docs, doc_id="long", text="string", source="string")
    texts = texts.select("doc_id", F.coalesce("text", F.lit("")).cast("binary").alias("text"), F.coalesce("source", F.lit("")).alias("part"))

    def fn(batch: pa.RecordBatch) -> pa.RecordBatch:
        bodies = batch.column(1).to_pylist()
        k = np.frombuffer(b"".join(map(xxh3_128_digest, bodies)), ">i8").astype(np.int64).reshape(-1, 2)
        cols = [batch.column(0), batch.column(2), pa.array(map(failures, bodies), pa.int32()), pa.array(k[:, 0]), pa.array(k[:, 1])]
        return pa.RecordBatch.from_arrays(cols, names=["doc_id", "part", "failed", "k1", "k2"])

    rows = reliable(map_texts(texts, "text", fn, "doc_id long, part string, failed int, k1 long, k2 long"))
    copies = reliable(rows.groupBy("k1", "k2").agg(F.count("*").alias("n"), F.min("doc_id").alias("first")).where("n > 1"))
    n_rows, n_copies = rows.count(), copies.count()
    hot = copies if n_copies <= BROADCAST_ROWS else copies.where(F.col("n") > max(HOT_ROWS, n_rows // HOT_SHARE))
    rows = rows.join(F.broadcast(hot.select("k1", "k2", F.col("first").alias("least"))), ["k1", "k2"], "left")
    if n_copies > BROADCAST_ROWS:
        # rows that have met their group need no other: they are dealt by their own id
        met = F.col("least").isNotNull()
        rows = rows.withColumns({"j1": F.when(met, F.xxhash64("doc_id")).otherwise(F.col("k1")), "j2": F.when(met, F.lit(None)).otherwise(F.col("k2"))})
        rows = rows.join(copies.select(F.col("k1").alias("j1"), F.col("k2").alias("j2"), "first"), ["j1", "j2"], "left").withColumn("least", F.coalesce("least", "first"))
    mask = F.col("failed") + F.when(F.col("doc_id") > F.col("least"), 16).otherwise(0)
    return rows.select("doc_id", "part", mask.alias("mask"), "k1").transform(_labelled, labels)


def _labelled(rows: DataFrame, labels: DataFrame) -> DataFrame:
    known = need_columns(labels, doc_id="long", quality="int", toxic="int").where("doc_id IS NOT NULL AND (quality = 1 OR toxic = 1)")
    bits = F.max(F.when(F.col("quality") == 1, 1).otherwise(0)) + F.max(F.when(F.col("toxic") == 1, 2).otherwise(0))
    known = reliable(known.groupBy(F.col("doc_id").alias("id")).agg(bits.cast("int").alias("label")))
    known = F.broadcast(known) if known.count() <= BROADCAST_ROWS else known
    # rows without an id have no label; their digest deals them out
    on = (F.coalesce(F.col("doc_id"), F.col("k1")) == F.col("id")) & F.col("doc_id").isNotNull()
    return rows.join(known, on, "left").select("part", "mask", F.coalesce("label", F.lit(0)).alias("label"))


def _partials(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    table = first_failures()
    orders = np.arange(len(ORDERS)) * _SHAPE[2]
    held: dict[str, np.ndarray] = {}
    width = int(np.prod(_SHAPE))
    for batch in batches:
        for at in range(0, batch.num_rows, 4096):
            piece = batch.slice(at, 4096)
            coded = piece.column(0).dictionary_encode()
            parts = coded.dictionary.to_pylist()
            mask, label = (piece.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in (1, 2))
            cell = (coded.indices.to_numpy().astype(np.int64) * 4 + label) * (width // 4)
            hits = (cell[:, None] + orders + table[mask]).ravel()
            counts = np.bincount(hits, minlength=len(parts) * width).reshape(len(parts), width)
            for part, n in zip(parts, counts):
                held[part] = held[part] + n if part in held else n
            if len(held) > HELD_PARTS:
                yield _packed(held)
                held = {}
    if held:
        yield _packed(held)


def _packed(held: dict[str, np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(held, pa.string()), pa.array(list(held.values()), pa.list_(pa.int64()))], names=["part", "counts"])


def _folded(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, np.ndarray]]:
    """The sum of each part's arrays; batches are sorted by part."""
    current, total = None, None
    for batch in batches:
        arrays = unpacked(batch.column(1), np.int64)
        for part, counts in zip(batch.column(0).to_pylist(), arrays):
            if part == current:
                total = total + counts
            else:
                if current is not None:
                    yield current, total
                current, total = part, counts
    if current is not None:
        yield current, total


_OUT = "part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, good_lost long, toxic_lost long, shapley long"


def report(counts: np.ndarray) -> dict[str, np.ndarray]:
    """The figures of a part, each of 120 orders by 5 steps."""
    counts = counts.reshape(_SHAPE)
    by_step = counts.sum(axis=0)
    removed = by_step[:, :_STEPS]
    of = np.array([[FILTERS.index(f) for f in order] for order in ORDERS])
    fails, alone, shapley = (np.zeros(_STEPS, np.int64) for _ in range(3))
    fails[of[:, 0]] = removed[:, 0]
    alone[of[:, -1]] = removed[:, -1]
    np.add.at(shapley, of, removed)
    return {
        "kept": by_step.sum(axis=1, keepdims=True) - np.cumsum(removed, axis=1),
        "removed": removed,
        "redundant": fails[of] - removed,
        "unique_fails": alone[of],
        "good_lost": counts[1, :, :_STEPS] + counts[3, :, :_STEPS],
        "toxic_lost": counts[2, :, :_STEPS] + counts[3, :, :_STEPS],
        "shapley": shapley[of],
    }


def audit(masks: DataFrame) -> DataFrame:
    """The report of ``(part, mask, label)`` rows: 600 rows a part.

    Partial arrays are summed in two steps, by part and a number of the task that
    made them, then by part: a part that every task holds is dealt over several
    tasks first. A task holds one part's array at a time.
    """
    partial = masks.select("part", "mask", "label").mapInArrow(_partials, "part string, counts array<long>")
    partial = partial.withColumn("salt", F.spark_partition_id() % 32)

    def add(batches):
        for part, counts in _folded(batches):
            yield _packed({part: counts})

    def finish(batches):
        orders = np.repeat(np.array(ORDERS, object), _STEPS)
        steps = np.tile(np.arange(1, _STEPS + 1, dtype=np.int32), len(ORDERS))
        for part, counts in _folded(batches):
            found = report(counts)
            cols = [pa.array([part] * len(steps), pa.string()), pa.array(orders, pa.string()), pa.array(steps), *[pa.array(c.ravel(), pa.int64()) for c in found.values()]]
            yield pa.RecordBatch.from_arrays(cols, names=["part", "filter_order", "step", *found])

    some = partial.repartition("part", "salt").sortWithinPartitions("part", "salt").select("part", "counts").mapInArrow(add, "part string, counts array<long>")
    return some.repartition("part").sortWithinPartitions("part").mapInArrow(finish, _OUT)


def audit_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Five filters over ``docs``, in all 120 orders, counted by ``source``.

    One row, zeros included, per part, order and step; see the module for the
    figures. A null text is empty, a null source the part ''. A text of any
    length is taken whole. Filter E removes a row whose text a smaller
    ``doc_id`` has anywhere in the table; rows that repeat a ``doc_id`` with its
    text do not remove each other, and a row without a ``doc_id`` is neither
    removed by E nor removes others, and has no label. Several labels of one
    ``doc_id`` count together; labels of no document are ignored, as are other
    columns, whatever their names. An empty table has no parts: no rows.
    """
    return audit(document_masks(docs, labels))


def oracle_sql() -> str:
    """DuckDB SQL for the rows of ``audit_documents`` over the given tables."""
    orders = ", ".join(f"'{o}'" for o in ORDERS)
    return rf"""
WITH d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS words, min(doc_id) OVER (PARTITION BY t) AS least FROM d),
l AS (SELECT doc_id, bool_or(coalesce(quality = 1, false)) AS good, bool_or(coalesce(toxic = 1, false)) AS toxic FROM labels GROUP BY doc_id),
f AS (SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
  (CASE WHEN len(words) < {MIN_WORDS} THEN 'A' ELSE '' END) || (CASE WHEN 100 * len(list_distinct(words)) < {MIN_DISTINCT_PERCENT} * len(words) THEN 'B' ELSE '' END)
  || (CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > {MAX_UPPER_PERCENT} * length(t) THEN 'C' ELSE '' END)
  || (CASE WHEN regexp_matches(t, '[{MARKS}]') THEN 'D' ELSE '' END) || (CASE WHEN doc_id > least THEN 'E' ELSE '' END) AS fails
  FROM w LEFT JOIN l USING (doc_id)),
g AS (SELECT part, fails, count(*) AS n, count(*) FILTER (good) AS n_good, count(*) FILTER (toxic) AS n_toxic FROM f GROUP BY ALL),
s AS (SELECT o AS filter_order, CAST(i AS INT) AS step, substr(o, CAST(i AS INT), 1) AS filter, substr(o, 1, CAST(i AS INT) - 1) AS before
  FROM (SELECT unnest([{orders}]) AS o), range(1, 6) r(i)),
x AS (SELECT part, filter_order, step, filter, n, n_good, n_toxic, contains(fails, filter) AS hit, fails = filter AS only_this,
  before <> '' AND regexp_matches(fails, '[' || before || '_]') AS gone FROM g, s),
a AS (SELECT part, filter_order, step, filter, sum(CASE WHEN NOT gone AND NOT hit THEN n ELSE 0 END) AS kept, sum(CASE WHEN NOT gone AND hit THEN n ELSE 0 END) AS removed,
  sum(CASE WHEN gone AND hit THEN n ELSE 0 END) AS redundant, sum(CASE WHEN only_this THEN n ELSE 0 END) AS unique_fails,
  sum(CASE WHEN NOT gone AND hit THEN n_good ELSE 0 END) AS good_lost, sum(CASE WHEN NOT gone AND hit THEN n_toxic ELSE 0 END) AS toxic_lost
  FROM x GROUP BY ALL)
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
  CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
  CAST(sum(removed) OVER (PARTITION BY part, filter) AS BIGINT) AS shapley
FROM a"""
