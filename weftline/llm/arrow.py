"""Row functions over Arrow batches of bounded size."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

#: Rows in a batch, and bytes: a batch ends at either.
BATCH_ROWS, BATCH_BYTES = 256, 8 << 20


def map_batches(df: DataFrame, f: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """df.mapInArrow(f, schema). Where the session does not set the size of batches itself, it gets the one above: Spark reads it only when the query runs."""
    conf = df.sparkSession.conf
    for name, size in (("maxRecordsPerBatch", BATCH_ROWS), ("maxBytesPerBatch", BATCH_BYTES)):
        if conf.get(f"spark.sql.execution.arrow.{name}", None) is None:
            conf.set(f"spark.sql.execution.arrow.{name}", size)
    return df.mapInArrow(f, schema)
