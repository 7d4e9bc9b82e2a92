"""Documents packed into chunks, so that exchanges move arrays and not a row per word or place.

A chunk asks: for each bucket it sends what that bucket has to know. A bucket sees what all chunks
sent it and answers each of them. A chunk then meets its answers again under its number.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame

from barloom.llm import text as T
from barloom.session import cut

CHUNK_BYTES = 2 * 1024 * 1024
TEXT_LEVEL = 3
NO_ID = np.iinfo(np.int64).max
SCHEMA = "chunk long, doc_ids array<long>, ends array<long>, n_bytes long, packed binary"


def squeeze(data: bytes, level: int = 1) -> bytes:
    return zstandard.ZstdCompressor(level=level).compress(data)


def expand(data: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(data)


def _pack(batches: Iterable[pa.RecordBatch], limit: int) -> Iterator[pa.RecordBatch]:
    number = TaskContext.get().partitionId() << 32
    for batch in T.portions(batches, limit=limit):
        texts = T.raw(batch)
        joined = b"".join(texts)
        ends = np.cumsum([len(t) for t in texts], dtype=np.int64).tolist()
        columns = ([number], [batch.column("doc_id").to_pylist()], [ends], [len(joined)], [squeeze(joined, TEXT_LEVEL)])
        kinds = (pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.int64(), pa.binary())
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds)], ["chunk", "doc_ids", "ends", "n_bytes", "packed"])
        number += 1


def pack(docs: DataFrame, limit: int = CHUNK_BYTES) -> DataFrame:
    """(chunk, doc_ids, ends, n_bytes, packed), written to the shared folder.

    The texts of a chunk are joined; `ends` are their ends in bytes. A null text is empty. A text
    beyond the limit is a chunk of its own.
    """
    return cut(T.texts(docs).mapInArrow(partial(_pack, limit=limit), SCHEMA), "chunks")


class Chunk:
    """One row of a packed table."""

    def __init__(self, table: pa.Table | pa.RecordBatch, row: int = 0):
        get = {n: table.column(n)[row] for n in ("chunk", "doc_ids", "ends", "packed")}
        self.number = get["chunk"].as_py()
        self.doc_ids = get["doc_ids"].as_py()
        self.ids = np.array([NO_ID if i is None else i for i in self.doc_ids], np.int64)
        self.ends = np.array(get["ends"].as_py(), np.int64)
        self.starts = np.concatenate([[0], self.ends[:-1]]).astype(np.int64)
        self.text = expand(get["packed"].as_py())

    def texts(self) -> list[bytes]:
        return [self.text[a:b] for a, b in zip(self.starts.tolist(), self.ends.tolist())]


def each(batches: Iterable[pa.RecordBatch]) -> Iterator[Chunk]:
    for batch in batches:
        for row in range(batch.num_rows):
            yield Chunk(batch, row)


def grouped(bucket: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Each bucket with the places that belong to it, in their order."""
    if len(bucket) and bucket.max() <= np.iinfo(np.int16).max:
        bucket = bucket.astype(np.int16)  # sorted by radix
    order = np.argsort(bucket, kind="stable")
    found, starts = np.unique(bucket[order], return_index=True)
    for b, places in zip(found.tolist(), np.split(order, starts[1:])):
        yield b, places
