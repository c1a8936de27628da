"""Lines of files with their true numbers, as a Spark data source.

A file is read in byte ranges, each its own task. A range's first line number
comes from an index of how many lines the ranges before it hold; the index is
itself made by a source that counts line breaks range by range. What is done
with bad lines is an option of the scan.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from .folders import open_path, scratch
from .manifest import live_files

RANGE_BYTES = 64 << 20
#: Bytes read at once, and lines that a task hands on at once.
BLOCK, BATCH = 4 << 20, 5000
POLICIES = ("skip", "fail", "keep")


def list_files(path: str) -> list[tuple[str, int]]:
    """Files of a path, a folder, or a pattern of names in a folder, in order of
    their names, with their sizes. A folder with a manifest has the files that
    it lists and no others."""
    from fnmatch import fnmatchcase

    store, name = open_path(path)
    prefix = path[: len(path) - len(name)] if path.endswith(name) else ""
    folder, _, last = name.rpartition("/")
    if any(c in last for c in "*?["):
        found = [i for i in store.get_file_info(fs.FileSelector(folder, allow_not_found=True)) if fnmatchcase(i.base_name, last)]
    else:
        info = store.get_file_info(name)
        if info.type == fs.FileType.Directory:
            live = live_files(store, name)
            found = store.get_file_info([f"{name}/{f}" for f in live]) if live is not None else store.get_file_info(fs.FileSelector(name))
            found = [i for i in found if live is not None or not i.base_name.startswith(("_", "."))]
        else:
            found = [info]
    return sorted((prefix + i.path, i.size) for i in found if i.type == fs.FileType.File)


@dataclass
class Range(InputPartition):
    """Bytes ``start`` to ``end`` of a file; a line belongs to the range that it
    begins in. ``first`` is the number of the range's first line."""

    path: str
    start: int
    end: int
    first: int = 1


def ranges(path: str, size: int) -> list[Range]:
    return [r for p in path.split(",") for f, n in list_files(p) for r in _cut(f, n, size)]


def _cut(path: str, length: int, size: int) -> list[Range]:
    if path.endswith((".gz", ".bz2", ".zst")):  # cannot be entered in the middle
        return [Range(path, 0, 1 << 62)]
    return [Range(path, at, min(at + size, length)) for at in range(0, length, size)]


def _blocks(r: Range) -> Iterator[tuple[int, bytes]]:
    """``(place, bytes)`` from one byte before the range on."""
    store, name = open_path(r.path)
    if r.end >= 1 << 62:
        at = 0
        with store.open_input_stream(name) as file:
            while block := file.read(BLOCK):
                yield at, block
                at += len(block)
        return
    at = max(r.start - 1, 0)
    with store.open_input_file(name) as file:
        file.seek(at)
        while block := file.read(BLOCK):
            yield at, block
            at += len(block)


def range_lines(r: Range) -> Iterator[bytes]:
    """The lines that begin in a range, without their breaks. The last one is
    read on beyond the range; a line of any length is held once."""
    held: list[bytes] = []
    inside = r.start == 0  # else only behind the first break
    begins = r.start  # of the line at hand
    for at, block in _blocks(r):
        start = 0
        while (stop := block.find(b"\n", start)) >= 0:
            if inside:
                yield b"".join([*held, block[start:stop]])
            held, inside, begins = [], True, at + stop + 1
            if begins >= r.end:
                return
            start = stop + 1
        if inside:
            held.append(block[start:])
    if inside and any(held) and begins < r.end:
        yield b"".join(held)


def count_lines_of(r: Range) -> int:
    """How many lines begin in a range."""
    return sum(1 for _ in range_lines(r))


class _Index(DataSourceReader):
    def __init__(self, options: dict):
        self.path, self.size = options["path"], int(options.get("rangebytes", RANGE_BYTES))

    def partitions(self):
        return ranges(self.path, self.size)

    def read(self, partition: Range | None):
        if partition is None:  # there are no files
            return
        yield partition.path, partition.start, partition.end, count_lines_of(partition)


class LineIndex(DataSource):
    """``file, start, stop, n``: lines that begin in each byte range of ``path``."""

    @classmethod
    def name(cls) -> str:
        return "textkiln_line_index"

    def schema(self) -> str:
        return "file string, start long, stop long, n long"

    def reader(self, schema) -> DataSourceReader:
        return _Index(self.options)


class _Lines(DataSourceReader):
    def __init__(self, options: dict):
        self.path, self.index, self.size = options["path"], options.get("index"), int(options.get("rangebytes", RANGE_BYTES))
        self.policy = options.get("badlines", "skip")
        if self.policy not in POLICIES:
            raise ValueError(f"badLines is one of {', '.join(POLICIES)}, not {self.policy}")

    def partitions(self):
        if not self.index:  # a file is one task: it counts from its start
            return ranges(self.path, 1 << 62)
        import pyarrow.parquet as pq

        rows = []
        for file, _ in list_files(self.index):
            store, name = open_path(file)
            rows += pq.read_table(name, filesystem=store).to_pylist()
        return [Range(r["file"], r["start"], r["stop"], r["first"]) for r in rows]

    def read(self, partition: Range | None):
        numbers, rows = [], []
        if partition is None:
            return
        for i, line in enumerate(range_lines(partition)):
            text = line.decode("utf-8", "replace").strip()
            if not text:
                continue
            if self.policy != "keep" and not is_object(text):
                if self.policy == "fail":
                    raise ValueError(f"{partition.path}, line {partition.first + i}: not a JSON object")
                continue
            numbers.append(partition.first + i)
            rows.append(text)
            if len(rows) >= BATCH:
                yield _batch(partition.path, numbers, rows)
                numbers, rows = [], []
        if rows:
            yield _batch(partition.path, numbers, rows)


def _batch(path: str, numbers: list[int], rows: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([path] * len(rows)), pa.array(numbers, pa.int64()), pa.array(rows, pa.string())], names=["file", "line", "row"])


def is_object(text: str) -> bool:
    """One whole JSON object, by the standard: no NaN and no Infinity."""

    def refuse(name):
        raise ValueError(name)

    try:
        return isinstance(json.loads(text, parse_constant=refuse), dict)
    except (ValueError, RecursionError):
        return False


class NumberedLines(DataSource):
    """``file, line, row``: the lines of ``path`` that are not blank, from 1 in
    each file as they stand there. ``badLines`` is ``skip`` (those that are no
    JSON object), ``fail`` or ``keep``. With ``index``, a folder that
    ``line_index`` wrote, files are read in ranges; without, each is one task."""

    @classmethod
    def name(cls) -> str:
        return "textkiln_lines"

    def schema(self) -> str:
        return "file string, line long, row string"

    def reader(self, schema) -> DataSourceReader:
        return _Lines(self.options)


def register(spark: SparkSession) -> None:
    for source in (LineIndex, NumberedLines):
        spark.dataSource.register(source)


def line_index(spark: SparkSession, path: str, range_bytes: int = RANGE_BYTES) -> str:
    """Count the lines of each range and keep, in the shared folder, the number
    of each range's first line: a row for each ``range_bytes`` of input."""
    register(spark)
    counts = spark.read.format("textkiln_line_index").option("rangeBytes", range_bytes).load(path)
    before = F.sum("n").over(Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1))
    to = scratch(spark, "line-index")
    counts.select("file", "start", "stop", (F.coalesce(before, F.lit(0)) + 1).alias("first")).write.parquet(to)
    return to


def numbered_lines(spark: SparkSession, path: str, bad_lines: str = "skip", range_bytes: int = RANGE_BYTES) -> DataFrame:
    """``file, line, row`` of all files of ``path``, read in ranges."""
    index = line_index(spark, path, range_bytes)
    return spark.read.format("textkiln_lines").option("badLines", bad_lines).option("index", index).load(path)


def numbered_rows(spark: SparkSession, path: str, schema: str, bad_lines: str = "skip", range_bytes: int = RANGE_BYTES) -> DataFrame:
    """``file, line`` and the wanted fields of each row."""
    rows = numbered_lines(spark, path, bad_lines, range_bytes)
    return rows.select("file", "line", F.from_json("row", schema).alias("row")).select("file", "line", "row.*")
