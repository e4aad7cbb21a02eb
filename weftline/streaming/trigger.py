"""Run again when the input file changes: a digest for one file, a file stream for a folder."""

from __future__ import annotations

import hashlib
import os
from typing import Callable

from pyspark.sql import DataFrame, SparkSession

from weftline.sources.companies import RAW_SCHEMA


def digest(path: str, head: int = 1 << 20) -> str:
    """Of path, size, time of change and the first MB."""
    s = os.stat(path)
    h = hashlib.sha256(f"{path}|{s.st_size}|{s.st_mtime_ns}|".encode())
    with open(path, "rb") as f:
        h.update(f.read(head))
    return h.hexdigest()


def run_if_changed(path: str, cursor: str | None, action: Callable[[str], None]) -> str | None:
    """The new cursor; action runs only if it differs from the old one. A missing file changes nothing."""
    if not os.path.isfile(path):
        return cursor
    now = digest(path)
    if now != cursor:
        action(path)
    return now


def follow(spark: SparkSession, folder: str, checkpoint: str, action: Callable[[DataFrame, int], None], once: bool = True):
    """A stream over arriving company CSV files; each micro-batch goes to action."""
    rows = spark.readStream.schema(RAW_SCHEMA).option("header", True).csv(folder)
    writer = rows.writeStream.foreachBatch(action).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()
