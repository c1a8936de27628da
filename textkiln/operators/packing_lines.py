"""Greedy packing of a document's lines where the lines are rows.

The packer counts words, and begins anew behind the line that takes it over its
limit and at every line that starts a paragraph. Over a run of lines it is a map
from the words it enters with to those it leaves with. A document is cut into
segments of lines; each segment's map is made by itself, for all numbers of
words at once, from the running sums of its lines. Maps are small and are
chained per document, and then each segment packs its own lines from where the
chain says that it begins. One very long document is so many tasks, and the
result is that of reading it from its start, whatever the segments are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textkiln.sources.folders import kept

#: Lines of a segment.
SEGMENT = 1024


def resets(words: np.ndarray, starts: np.ndarray, most: int) -> np.ndarray:
    """For each line, the line that the next chunk begins at when one begins
    here; the number of lines where none does."""
    n = len(words)
    sums = np.r_[0, np.cumsum(words)]
    over = np.searchsorted(sums, sums[:-1] + most, side="right")  # one behind the line that goes over
    marks = np.flatnonzero(starts)
    after = np.searchsorted(marks, np.arange(n), side="right")
    start = np.r_[marks, n][after]
    return np.minimum(np.minimum(over, start), n)


def ways_out(words: np.ndarray, starts: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """For each line, the words held behind the last line and the line that the
    last chunk begins at, when a chunk begins at this line; one more entry for
    the end, where nothing is held."""
    n, sums = len(words), np.r_[0, np.cumsum(words)]
    to = resets(words, starts, most)
    held, begun = np.zeros(n + 1, np.int64), np.full(n + 1, n, np.int64)
    for i in range(n - 1, -1, -1):
        if to[i] < n or sums[n] - sums[i] > most:
            held[i], begun[i] = held[to[i]], begun[to[i]]
        else:
            held[i], begun[i] = sums[n] - sums[i], i
    return held, begun


def first_reset(words: np.ndarray, starts: np.ndarray, most: int, entering: np.ndarray) -> np.ndarray:
    """The line that the first chunk of a segment begins at, for each number of
    words that it is entered with; -1 where the chunk at hand goes on through."""
    n, sums = len(words), np.r_[0, np.cumsum(words)]
    over = np.searchsorted(sums, most - entering, side="right")
    start = int(np.argmax(starts)) if starts.any() else n + 1
    found = np.minimum(over, start)
    return np.where(found > n, -1, found)


def _map_of(words, starts, most: int) -> tuple[list[int], list[int]]:
    """For 0 to ``most`` words held: words held behind, and the line that the
    chunk at hand began at, -1 where it is still the one entered."""
    entering = np.arange(most + 1)
    held, begun = ways_out(words, starts, most)
    first = first_reset(words, starts, most, entering)
    through = first < 0
    out = np.where(through, entering + int(words.sum()), held[first])
    return out.tolist(), np.where(through, -1, begun[first]).tolist()


def pack_lines(lines: DataFrame, most: int, segment: int = SEGMENT) -> DataFrame:
    """``doc, line, chunk``: for each line the line that its chunk begins at.

    ``lines`` has ``doc`` (any type, null is a document of its own), ``line``
    (numbered from 0 without gaps), ``words`` (null is none) and ``starts``
    (null is no). A chunk that ends at a document's last line is as it is.
    """
    kind = dict(lines.dtypes)["doc"]
    rows = lines.select("doc", F.col("line").cast("long").alias("line"), F.coalesce("words", F.lit(0)).cast("long").alias("words"), F.coalesce("starts", F.lit(False)).alias("starts"))
    # a segment's lines are bounded, so its arrays are
    listed = F.array_sort(F.collect_list(F.struct("line", "words", "starts")))
    of = lambda name: F.transform(listed, lambda x: x[name]).alias(name)
    segments = kept(rows.groupBy("doc", F.expr(f"line div {segment}").alias("segment")).agg(F.min("line").alias("first"), of("words"), of("starts")))

    def arrays(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        words, starts = (batch.column(batch.schema.get_field_index(c)) for c in ("words", "starts"))
        for w, s in zip(words, starts):
            yield np.array(w.as_py(), np.int64), np.array(s.as_py(), bool)

    def maps(batches):
        for batch in batches:
            for i, (w, s) in enumerate(arrays(batch)):
                held, begun = _map_of(w, s, most)
                yield pa.RecordBatch.from_arrays([*[batch.column(c).slice(i, 1) for c in range(3)], pa.array([held], pa.list_(pa.int64())), pa.array([begun], pa.list_(pa.int64()))], names=["doc", "segment", "first", "held", "begun"])

    def chain(batches):
        doc, held, chunk, any_ = None, 0, 0, False
        for batch in batches:
            for i, (d, first, to, begun) in enumerate(zip(*[batch.column(c).to_pylist() for c in (0, 2, 3, 4)])):
                if not any_ or d != doc:
                    doc, held, chunk, any_ = d, 0, first, True
                entry = batch.slice(i, 1)
                yield pa.RecordBatch.from_arrays([entry.column(0), entry.column(1), pa.array([held], pa.int64()), pa.array([chunk], pa.int64())], names=["doc", "segment", "held", "chunk"])
                held, chunk = to[held], chunk if begun[held] < 0 else first + begun[held]

    def pack(batches):
        for batch in batches:
            firsts, helds, chunks = (batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("first", "held", "chunk"))
            for i, (w, s) in enumerate(arrays(batch)):
                n, to = len(w), resets(w, s, most)
                begins = np.full(n, -1, np.int64)
                at = int(first_reset(w, s, most, np.array([helds[i]]))[0])
                while 0 <= at < n:
                    begins[at] = firsts[i] + at
                    at = int(to[at])
                begins = np.maximum.accumulate(np.maximum(begins, chunks[i]))
                doc = pa.array(np.zeros(n, np.int64))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, 1).take(doc), pa.array(firsts[i] + np.arange(n)), pa.array(begins)], names=["doc", "line", "chunk"])

    mapped = segments.mapInArrow(maps, f"doc {kind}, segment long, first long, held array<long>, begun array<long>")
    entries = mapped.repartition("doc").sortWithinPartitions("doc", "segment").mapInArrow(chain, f"doc {kind}, segment long, held long, chunk long")
    joined = segments.alias("a").join(entries.alias("b"), F.col("a.doc").eqNullSafe(F.col("b.doc")) & (F.col("a.segment") == F.col("b.segment")))
    return joined.select("a.doc", "first", "words", "starts", "held", "chunk").mapInArrow(pack, f"doc {kind}, line long, chunk long")
