"""Files to texts."""

from __future__ import annotations

import subprocess
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def text_files(spark: SparkSession, folder: str) -> DataFrame:
    """Whole text files: ``(path, text)``."""
    return spark.read.text(folder, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"))


def binary_files(spark: SparkSession, folder: str, pattern: str = "*.pdf") -> DataFrame:
    """Files with content and SHA-256: ``(path, length, content, sha256)``."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(folder)
    return files.select("path", "length", "content", F.sha2("content", 256).alias("sha256"))


def pdftotext(content: bytes, options: tuple[str, ...] = ()) -> str:
    """Text of a PDF in reading order by the program of that name, with its ``options`` (such as ``-layout``);
    a failure of the program is an error."""
    done = subprocess.run(["pdftotext", *options, "-", "-"], input=content, capture_output=True, check=False)
    if done.returncode:
        raise RuntimeError(done.stderr.decode(errors="replace")[:500])
    return done.stdout.decode(errors="replace")


def extracted(files: DataFrame, extract: Callable[[bytes], str] = pdftotext) -> DataFrame:
    """``(path, text, status, error)``: a file that fails is a row with status ``error``, not the end."""
    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            rows = []
            for path, content in zip(part["path"], part["content"]):
                try:
                    rows.append((path, extract(bytes(content)), "parsed", None))
                except Exception as e:  # noqa: BLE001 - the log tells
                    rows.append((path, None, "error", str(e)[:500]))
            yield pd.DataFrame(rows, columns=["path", "text", "status", "error"])

    return files.select("path", "content").mapInPandas(run, "path string, text string, status string, error string")
