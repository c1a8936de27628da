"""Small helpers shared by the corpus operators."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def need_columns(df: DataFrame, **columns: str) -> DataFrame:
    """Only the named columns, cast: other columns of the input cannot clash."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"the input lacks {', '.join(missing)}")
    return df.select(*[F.col(f"`{c}`").cast(kind).alias(c) for c, kind in columns.items()])


def unused(df: DataFrame, stem: str) -> str:
    """A column name that ``df`` has not, in any case."""
    taken = {c.lower() for c in df.columns}
    while stem in taken:
        stem += "_"
    return stem


#: A key is hot when it holds more than one in so many rows, and more rows than this.
HOT_SHARE, HOT_ROWS = 1000, 10_000
#: Most rows of a few numbers each that are broadcast, counted before.
BROADCAST_ROWS = 500_000


def join_counted(big: DataFrame, per_key: DataFrame, keys: str | list[str], total: int, most: int | None = None) -> DataFrame:
    """Inner join of ``big`` with one row per key; ``per_key.n`` is how many rows
    of ``big`` hold the key and ``total`` how many rows ``big`` has, about;
    ``most`` is the largest ``n``, where that is known.

    Hot keys are at most ``HOT_SHARE`` rows, so these are broadcast and their
    rows of ``big`` stay where they are; the others are joined by a shuffle.
    """
    keys = [keys] if isinstance(keys, str) else keys
    limit = max(HOT_ROWS, total // HOT_SHARE)
    if min(total, total if most is None else most) <= limit:  # no key is hot
        return big.join(per_key, keys).select(*big.columns, *[c for c in per_key.columns if c not in keys])
    rest = [c for c in per_key.columns if c not in keys]
    hot = per_key.where(F.col("n") > limit).select(*keys, F.struct(*rest).alias("hot"))
    tagged = big.join(F.broadcast(hot), keys, "left")
    columns = [*big.columns, *rest]
    found = tagged.where("hot IS NOT NULL").select(*big.columns, "hot.*")
    others = tagged.where("hot IS NULL").select(*big.columns).join(per_key.where(F.col("n") <= limit), keys)
    return found.select(columns).union(others.select(columns))


def small(df: DataFrame, rows: int = BROADCAST_ROWS, n: int | None = None) -> DataFrame:
    """``df``, a written table of few narrow columns, marked for broadcast where
    it is counted to have few rows; ``n`` is their number, where that is known."""
    return F.broadcast(df) if (df.count() if n is None else n) <= rows else df


#: Fewest tasks of a step, and rows of a task where no other number is given.
MIN_TASKS, TASK_ROWS = 12, 20_000


def few(df: DataFrame, rows: int, per_task: int = TASK_ROWS) -> DataFrame:
    """``df``, of ``rows`` rows at most, in no more tasks than these need, however
    many partitions a shuffle has. The driver keeps a record of every task."""
    return df.coalesce(max(MIN_TASKS, -(-rows // per_task)))


def reliable(df: DataFrame) -> DataFrame:
    """Cut the lineage with files in the cluster's shared checkpoint folder.

    The folder is ``spark.checkpoint.dir`` of the session; only where that is
    unset (single-machine runs and tests) is a folder of our own used.
    """
    spark = df.sparkSession
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        shared = spark.conf.get("spark.checkpoint.dir", None)
        sc.setCheckpointDir(shared or local_checkpoint_dir(sc.master))
    return df.checkpoint(eager=True)


def counted(df: DataFrame, **counts: Column) -> tuple[DataFrame, dict]:
    """``reliable(df)``, and its ``rows`` and further aggregates as the write itself
    saw them: no job reads the files again to count them."""
    seen = Observation()
    out = reliable(df.observe(seen, F.count(F.lit(1)).alias("rows"), *[c.alias(k) for k, c in counts.items()]))
    found = seen.get
    return out, {k: found.get(k) or 0 for k in ("rows", *counts)}


def local_checkpoint_dir(master: str) -> str:
    """A temporary folder, only for sessions that run in one process."""
    import tempfile

    if not master.startswith("local") or master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return tempfile.mkdtemp(prefix="textkiln-checkpoint-")


#: Most rows and bytes that go to a Python worker at once. Texts are long, and a
#: batch is held several times over: by the JVM, by Arrow and as Python objects.
BATCH_ROWS, BATCH_BYTES = 2000, 8 << 20


def bound_batches(spark: SparkSession) -> None:
    """Lower the session's Arrow batch limits to the bounds above. They are read
    when a plan runs, so they stay lowered for the session."""
    for key, bound in (("maxRecordsPerBatch", BATCH_ROWS), ("maxBytesPerBatch", BATCH_BYTES)):
        name = f"spark.sql.execution.arrow.{key}"
        now = spark.conf.get(name).rstrip("b")
        if not (now.isdigit() and 0 < int(now) <= bound):
            spark.conf.set(name, str(bound))


def give_back() -> None:
    """Hand freed memory back to the machine: an idle worker keeps none of it."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def unpacked(column: pa.Array, kind: type) -> list[np.ndarray]:
    """The lists of a column as arrays that share its values."""
    values = column.flatten().to_numpy(zero_copy_only=False).astype(kind, copy=False)
    ends = np.cumsum(pc.list_value_length(column).to_numpy(zero_copy_only=False))
    return np.split(values, ends[:-1]) if len(ends) else []


def slices(batch: pa.RecordBatch, column: str, limit: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows whose texts hold about ``limit`` bytes.

    A row is never cut, so one very long text is a run of its own.
    """
    i = batch.schema.get_field_index(column)
    sizes = pc.binary_length(batch.column(i)).to_pylist()
    start, held = 0, 0
    for row, size in enumerate(sizes):
        held += size or 0
        if held >= limit or row - start >= 2000:
            yield batch.slice(start, row + 1 - start)
            start, held = row + 1, 0
    if start < batch.num_rows:
        yield batch.slice(start)


def map_texts(df: DataFrame, column: str, fn: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str) -> DataFrame:
    """Apply ``fn`` to runs of rows; results come from Arrow without pandas."""

    bound_batches(df.sparkSession)

    def run(batches):
        for batch in batches:
            for piece in slices(batch, column):
                yield fn(piece)
        give_back()

    return df.mapInArrow(run, schema)


def map_groups(df: DataFrame, keys: list[str], fn: Callable[[pa.Table], pa.Table | None], schema: str, parts: int | None = None) -> DataFrame:
    """Stream the groups of ``keys`` through ``fn``, one Arrow table at a time.

    Rows are dealt by the keys and sorted inside their partition, and only the
    rows of one group are held at once: callers must bound their groups.
    """
    bound_batches(df.sparkSession)
    width = parts or shuffle_width(df.sparkSession)
    dealt = df.repartition(width, *keys).sortWithinPartitions(*keys)

    def run(batches):
        held: list[pa.RecordBatch] = []
        current = None
        for batch in batches:
            if not batch.num_rows:
                continue
            cols = [batch.column(batch.schema.get_field_index(k)).to_pylist() for k in keys]
            rows = list(zip(*cols))
            start = 0
            for i, key in enumerate(rows):
                if key != current:
                    if i > start:
                        held.append(batch.slice(start, i - start))
                    if held:
                        out = fn(pa.Table.from_batches(held))
                        if out is not None and out.num_rows:
                            yield from out.combine_chunks().to_batches()
                    held, current, start = [], key, i
            held.append(batch.slice(start))
        if held:
            out = fn(pa.Table.from_batches(held))
            held = []
            if out is not None and out.num_rows:
                yield from out.combine_chunks().to_batches()
        give_back()

    return dealt.mapInArrow(run, schema)
