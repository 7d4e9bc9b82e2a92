"""Reading the text tables, and small helpers for Arrow batches of text inside tasks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Text bytes that a task looks at together. It bounds memory and does not touch results.
PORTION_BYTES = 2 * 1024 * 1024


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def texts(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The key as a long and the text, under fixed names, without the other columns."""
    return docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))


def fresh(df: DataFrame, name: str) -> str:
    """`name`, lengthened until no column of `df` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def portions(
    batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = PORTION_BYTES
) -> Iterator[pa.RecordBatch]:
    """The rows in slices that hold about `limit` bytes of text, or one longer text."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy()
        part = np.cumsum(sizes, dtype=np.int64) // limit
        cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
        for start, stop in zip(cuts, cuts[1:]):
            if stop > start:
                yield batch.slice(start, stop - start)


def raw(batch: pa.RecordBatch, column: str = "text") -> list[bytes]:
    """The texts as UTF-8 bytes; null is empty."""
    return pc.fill_null(batch.column(column).cast(pa.binary()), b"").to_pylist()
