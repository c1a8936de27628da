"""Text of PDF files. Extraction is external: any function from bytes to text."""

from __future__ import annotations

import subprocess
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession

TIMEOUT_SECONDS = 180


def pdftotext(content: bytes) -> str:
    """Text in reading order by the command-line tool; an error where the tool
    fails or finds no text."""
    done = subprocess.run(["pdftotext", "-", "-"], input=content, capture_output=True, timeout=TIMEOUT_SECONDS)
    text = done.stdout.decode("utf-8", "replace")
    if done.returncode or not text.strip():
        raise RuntimeError(f"no text: {done.stderr.decode('utf-8', 'replace')[:200]}")
    return text


def pdf_texts(spark: SparkSession, pattern: str, extract: Callable[[bytes], str] = pdftotext) -> DataFrame:
    """``path, text`` of all files of a pattern, one file a row."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"path": batch["path"], "text": [extract(bytes(c)) for c in batch["content"]]})

    return spark.read.format("binaryFile").load(pattern).select("path", "content").mapInPandas(run, "path string, text string")
