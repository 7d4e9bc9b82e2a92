"""Writers: the month-partitioned store, published JSON and CSV, the combined series."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterable, Iterator
from functools import partial
from urllib.parse import unquote

import pyarrow as pa
from pyarrow.fs import FileSystem, FileType
from pyspark import cloudpickle
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

import barloom
from barloom.functions import columns as C
from barloom.operators import merge
from barloom.schemas import BARS, OHLCV
from barloom.session import Files, cut

cloudpickle.register_pickle_by_value(barloom)

MONTH = "year_month"
SLASH = "%2F"  # a slash in a symbol's folder name
# Hidden names, which readers of the store pass over.
STAGING, READY, MARKS, LANDED, PENDING = "_staging-", "_READY", "_marks", "_landed", "_pending-"
BATCH = "batch"
LEDGER = "file string, modified timestamp, length long"
STORE = T.StructType([*BARS.fields, T.StructField(MONTH, T.StringType())])


def write_months(df: DataFrame, path: str, mode: str = "months") -> None:
    """Write the bar store, one folder per month.

    `months` replaces exactly the months that `df` holds, `all` the whole store. Rows are range
    partitioned, so a month with most of the rows is spread over many tasks and files.
    """
    if mode not in ("months", "all"):
        raise ValueError(f"unknown mode {mode!r}")
    rows = df.select("symbol", "date", *OHLCV, C.month_key().alias(MONTH))
    (
        rows.repartitionByRange(MONTH, "symbol", "date")
        .sortWithinPartitions(MONTH, "symbol", "date")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic" if mode == "months" else "static")
        .partitionBy(MONTH)
        .parquet(path)
    )


def read_months(spark: SparkSession, path: str, months: list[str] | None = None) -> DataFrame:
    """The bar store, or some months of it; empty when nothing was written yet."""
    recover_months(spark, path)
    try:
        store = spark.read.schema(STORE).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], STORE)
    return store if months is None else store.where(F.col(MONTH).isin(months))


def recover_months(spark: SparkSession, path: str) -> None:
    """Finish or undo what an interrupted upsert left.

    New months lie complete in a staging folder, marked ready, before the first old one goes. From
    a ready folder the swap is completed, one without the mark is removed.
    """
    files = Files(spark, path)
    for name in files.names(path):
        if name.startswith(STAGING):
            stage = f"{path}/{name}"
            if files.exists(f"{stage}/{READY}"):
                for month in files.names(stage):
                    if month.startswith(f"{MONTH}="):
                        files.move(f"{stage}/{month}", f"{path}/{month}")
                if files.exists(f"{stage}/{MARKS}"):
                    files.move(f"{stage}/{MARKS}", f"{path}/{MARKS}")
                for batch in files.names(f"{stage}/{LANDED}"):
                    if batch.startswith(f"{BATCH}="):
                        files.move(f"{stage}/{LANDED}/{batch}", f"{path}/{LANDED}/{batch}")
            files.delete(stage)


def read_marks(spark: SparkSession, path: str) -> DataFrame:
    """(symbol, last_date), the newest stored date of each symbol.

    Upserts keep it beside the months; for a store without it the months are read.
    """
    recover_months(spark, path)
    if Files(spark, path).exists(f"{path}/{MARKS}"):
        return spark.read.schema("symbol string, last_date date").parquet(f"{path}/{MARKS}")
    return merge.high_water(read_months(spark, path))


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """(file, modified, length, batch) of every version of a landed file that the store has taken."""
    recover_months(spark, path)
    schema = f"{LEDGER}, {BATCH} string"
    if not Files(spark, path).exists(f"{path}/{LANDED}"):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{path}/{LANDED}")


def unseen(landed: DataFrame, path: str) -> DataFrame:
    """The landed files that the store has not taken in this version.

    A file that was written again has another time or length and counts as new.
    """
    known = read_ledger(landed.sparkSession, path).drop(BATCH)
    return landed.join(known, ["file", "modified", "length"], "left_anti")


def begin_batch(spark: SparkSession, path: str, beside: str | None = None) -> str:
    """A name for a batch that is about to be taken.

    What earlier batches that never reached the store left in the folder `beside` is removed.
    """
    files = Files(spark, path)
    recover_months(spark, path)
    for name in files.names(path):
        if name.startswith(PENDING):
            batch = f"{BATCH}={name.removeprefix(PENDING)}"
            if beside and not files.exists(f"{path}/{LANDED}/{batch}"):
                Files(spark, beside).delete(f"{beside}/{batch}")
            files.delete(f"{path}/{name}")
    batch = uuid.uuid4().hex
    files.touch(f"{path}/{PENDING}{batch}")
    return batch


def end_batch(spark: SparkSession, path: str, batch: str) -> None:
    Files(spark, path).delete(f"{path}/{PENDING}{batch}")


def upsert_months(
    incoming: DataFrame, path: str, order_cols: list[str] | None = None,
    landed: DataFrame | None = None, batch: str | None = None,
) -> None:
    """Merge new bars into the store; a stored row wins over a new one of the same date.

    The `landed` files that the bars come from are entered in the store's ledger under the name
    of their `batch`, with the months or not at all.

    Only the months of the new rows are read and rewritten. Their list follows the calendar (12 a
    year), not the data. The merged months and the new marks are written beside the store and then
    put in the place of the old ones; `recover_months` completes that after an interruption.
    """
    spark = incoming.sparkSession
    months = [row[0] for row in incoming.select(C.month_key()).distinct().collect()]
    if not months and landed is None:
        return
    stage = f"{path}/{STAGING}{uuid.uuid4().hex}"
    if months:
        marks = merge.high_water(
            read_marks(spark, path).withColumnRenamed("last_date", "date")
            .unionByName(incoming.select("symbol", "date"))
        )
        existing = read_months(spark, path, months).drop(MONTH)
        merged = cut(merge.upsert(existing, incoming, order_cols), "merged")
        write_months(merged, stage, mode="all")
        marks.write.parquet(f"{stage}/{MARKS}")
    if landed is not None:
        landed.write.parquet(f"{stage}/{LANDED}/{BATCH}={batch or uuid.uuid4().hex}")
    Files(spark, path).touch(f"{stage}/{READY}")
    recover_months(spark, path)


def _records(df: DataFrame, *extra: str) -> DataFrame:
    """Bars under the names and date text of the landed files."""
    stamp = F.date_format("date", "yyyy-MM-dd'T'HH:mm:ss.SSS").alias("Date")
    return df.select(*extra, stamp, *[F.col(c).alias(c.capitalize()) for c in OHLCV])


def publish_months(df: DataFrame, path: str, folder: str = "monthly/") -> None:
    """One file `{symbol}/monthly/YYYY-MM.json` per symbol and month, as landed.

    Each holds a one-line array of records in date order. Copies of a date are merged first, so an
    array holds at most 31 records. Tasks write the files into a staging folder, which is marked
    when complete, and tasks move them to their names, replacing earlier ones; a task that is tried
    again goes on where it was. What an interrupted call left is completed by the next one, or
    removed if it was not marked. With an empty `folder` they lie directly below the symbol.
    """
    spark = df.sparkSession
    finish_publishing(spark, path)
    unique = merge.combine(df, [])
    records = _records(unique.withColumn(MONTH, C.month_key()), "symbol", MONTH)
    record = F.struct("Date", *[c.capitalize() for c in OHLCV])
    stage = f"{path}/{STAGING}{uuid.uuid4().hex}"
    (
        records.groupBy("symbol", MONTH)
        .agg(F.to_json(F.array_sort(F.collect_list(record))).alias("value"))
        .repartition("symbol", MONTH)
        .write.partitionBy("symbol", MONTH)
        .text(stage)
    )
    Files(spark, path).write(f"{stage}/{READY}", folder.encode())
    finish_publishing(spark, path)


def finish_publishing(spark: SparkSession, path: str) -> None:
    """Move the files of staging folders that are marked complete to their names; drop the others."""
    files = Files(spark, path)
    for name in files.names(path):
        if name.startswith(STAGING):
            stage = f"{path}/{name}"
            if files.exists(f"{stage}/{READY}"):
                folder = files.read(f"{stage}/{READY}").decode()
                parts = spark.read.format("binaryFile").option("recursiveFileLookup", True).option(
                    "pathGlobFilter", "part-*").load(stage).select(F.col("_metadata.file_path").alias("file"))
                target = re.sub(r"^file:/+", "/", files.full(path))
                try:
                    FileSystem.from_uri(target)
                except (pa.ArrowInvalid, OSError):
                    _move_here(files, parts, path, folder)
                else:
                    moved = parts.mapInArrow(partial(_moved, target=target, folder=folder), "moved long")
                    moved.agg(F.sum("moved")).collect()
            files.delete(stage)


def _target(file: str, target: str, folder: str) -> tuple[str, str]:
    """Where a staged file lies and where it goes."""
    plain = re.sub(r"^file:/+", "/", unquote(file))
    symbol, month = re.search(rf"/symbol=([^/]+)/{MONTH}=([^/]+)/part-", plain).groups()
    return plain, f"{target}/{unquote(symbol).replace('/', SLASH)}/{folder}{month}.json"


def _moved(batches: Iterable[pa.RecordBatch], target: str, folder: str) -> Iterator[pa.RecordBatch]:
    fs, _ = FileSystem.from_uri(target)
    for batch in batches:
        for file in batch.column("file").to_pylist():
            source, place = (FileSystem.from_uri(p)[1] for p in _target(file, target, folder))
            if fs.get_file_info(source).type == FileType.NotFound:
                continue  # moved by an earlier attempt
            fs.create_dir(place.rsplit("/", 1)[0], recursive=True)
            fs.move(source, place)
        yield pa.RecordBatch.from_pydict({"moved": [batch.num_rows]})


def _move_here(files: Files, parts: DataFrame, path: str, folder: str) -> None:
    """The same from the driver, on a file system that only Spark reaches."""
    for row in parts.toLocalIterator():
        files.move(*_target(row["file"], path, folder))


def split_months(df: DataFrame, path: str) -> None:
    """Re-split a whole series by symbol and month as JSON lines, replacing what was there."""
    records = _records(df.withColumn(MONTH, C.month_key()), "symbol", MONTH)
    (
        records.repartitionByRange("symbol", MONTH, "Date")
        .sortWithinPartitions("symbol", MONTH, "Date")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "static")
        .partitionBy("symbol", MONTH)
        .json(path)
    )


def write_combined(df: DataFrame, path: str) -> None:
    """The merged series as JSON lines, in (symbol, date) order over all files."""
    day = C.day_text("date").alias("Date")
    (
        df.repartitionByRange("symbol", "date")
        .sortWithinPartitions("symbol", "date")
        .select("symbol", day, *[F.col(c).alias(c.capitalize()) for c in OHLCV])
        .write.mode("overwrite")
        .json(path)
    )


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).option(
        "dateFormat", "yyyy-MM-dd"
    ).csv(path)


def write_result(df: DataFrame, path: str, history: str | None = None) -> DataFrame:
    """Result documents: the latest ones replace `path`; `history` keeps them all.

    Returns the documents as they were computed once for both.
    """
    df = cut(df, "result")
    df.write.mode("overwrite").json(path)
    if history:
        df.write.mode("append").json(history)
    return df
