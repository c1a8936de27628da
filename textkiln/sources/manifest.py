"""A line sink whose results appear whole or not at all.

Each task writes a file of its own into a staging folder; the driver moves the
files of the tasks that ended well and then publishes a manifest, one file that
lists all live files. Readers take what the newest manifest lists, so a task
that was killed leaves nothing that is read, and an overwritten result stays
readable until its successor is there. A manifest also names the last batch of
each writer that it has taken: one that is written again changes nothing. A
folder has one writer at a time.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from .folders import open_path

STAGING, MANIFESTS = "_staging", "_manifests"
MODES = ("append", "overwrite", "skip")


def _newest(store: fs.FileSystem, folder: str) -> tuple[int, dict]:
    found = store.get_file_info(fs.FileSelector(f"{folder}/{MANIFESTS}", allow_not_found=True))
    numbers = [int(i.base_name.removesuffix(".json")) for i in found if i.base_name.endswith(".json") and i.base_name[0] != "."]
    if not numbers:
        return 0, {"files": [], "batches": {}}
    with store.open_input_stream(f"{folder}/{MANIFESTS}/{max(numbers):020d}.json") as file:
        return max(numbers), json.loads(file.read())


def live_files(store: fs.FileSystem, folder: str) -> list[str] | None:
    """Files that the newest manifest of a folder lists; None without one."""
    number, manifest = _newest(store, folder)
    return manifest["files"] if number else None


@dataclass
class Staged(WriterCommitMessage):
    files: list[str] = field(default_factory=list)


class _Writer(DataSourceArrowWriter):
    def __init__(self, options: dict, overwrite: bool):
        self.path, self.batch, self.number = options["path"], options.get("batch", ""), int(options.get("number", 0))
        self.overwrite, self.job = overwrite, uuid.uuid4().hex

    def _place(self) -> tuple[fs.FileSystem, str]:
        return open_path(self.path.rstrip("/"))

    def write(self, iterator):
        """One file a task, under a name that no other attempt has."""
        store, folder = self._place()
        name, out = f"part-{uuid.uuid4().hex}.jsonl", None
        try:
            for batch in iterator:
                if not batch.num_rows:
                    continue
                if out is None:
                    store.create_dir(f"{folder}/{STAGING}/{self.job}", recursive=True)
                    out = store.open_output_stream(f"{folder}/{STAGING}/{self.job}/{name}")
                out.write("".join(f"{row}\n" for row in batch.column(0).to_pylist()).encode())
        finally:
            if out is not None:
                out.close()
        return Staged([name] if out is not None else [])

    def commit(self, messages):
        store, folder = self._place()
        number, before = _newest(store, folder)
        if self.batch and before["batches"].get(self.batch, -1) >= self.number:
            return self.abort(messages)
        files = [f for m in messages if m for f in m.files]
        store.create_dir(folder, recursive=True)
        for name in files:
            store.move(f"{folder}/{STAGING}/{self.job}/{name}", f"{folder}/{name}")
        kept, batches = ([], {}) if self.overwrite else (before["files"], before["batches"])
        after = {"files": kept + files, "batches": batches | ({self.batch: self.number} if self.batch else {})}
        store.create_dir(f"{folder}/{MANIFESTS}", recursive=True)
        hidden = f"{folder}/{MANIFESTS}/.{self.job}"
        with store.open_output_stream(hidden) as file:
            file.write(json.dumps(after).encode())
        store.move(hidden, f"{folder}/{MANIFESTS}/{number + 1:020d}.json")
        if number > 1:  # the one before stays for whoever reads it now
            store.delete_file(f"{folder}/{MANIFESTS}/{number - 1:020d}.json")
        if self.overwrite:  # the manifest no longer names them
            for name in before["files"]:
                store.delete_file(f"{folder}/{name}")
        self._clear(store, folder)

    def abort(self, messages):
        self._clear(*self._place())

    def _clear(self, store: fs.FileSystem, folder: str) -> None:
        if store.get_file_info(f"{folder}/{STAGING}/{self.job}").type == fs.FileType.Directory:
            store.delete_dir(f"{folder}/{STAGING}/{self.job}")


class ManifestLines(DataSource):
    """Sink of one column of lines; ``batch`` and ``number`` name a write that
    counts once."""

    @classmethod
    def name(cls) -> str:
        return "textkiln_manifest"

    def schema(self) -> str:
        return "row string"

    def writer(self, schema, overwrite: bool):
        return _Writer(self.options, overwrite)


def publish(rows: DataFrame, path: str, mode: str = "append", batch: str = "", number: int = 0) -> None:
    """Write rows as JSON lines: ``append`` to what is there, ``overwrite`` it, or
    ``skip`` where there is something. Of the numbered writes under one name
    those that the folder has taken are not written again."""
    if mode not in MODES:
        raise ValueError(f"mode is one of {', '.join(MODES)}, not {mode}")
    spark = rows.sparkSession
    if mode == "skip" and is_published(path):
        return
    spark.dataSource.register(ManifestLines)
    lines = rows.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("row"))
    lines.write.format("textkiln_manifest").mode("overwrite" if mode == "overwrite" else "append").option("batch", batch).option("number", number).save(path)


def is_published(path: str) -> bool:
    store, folder = open_path(path.rstrip("/"))
    return _newest(store, folder)[0] > 0


def published(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The live rows of a published folder, with file and line."""
    from .lines import numbered_rows

    return numbered_rows(spark, path, schema, bad_lines="fail")
