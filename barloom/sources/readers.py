"""Readers for bar files. Schemas are fixed; a bad record never fails a read."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.functions import columns as C
from barloom.schemas import BARS, CORRUPT, MODEL_META, PROVIDER_EXTRAS, RECORDS

# File, first byte of the split, place in the split: the order in which records were landed.
FILE_ORDER = ["_file", "_start", "_seq"]


def read_bars(
    spark: SparkSession, path: str, fmt: str = "parquet", start=None, end=None
) -> DataFrame:
    """Stored bars with `start <= date < end`; the bounds reach the scan."""
    reader = spark.read.schema(BARS).format(fmt)
    if fmt == "csv":
        reader = reader.option("header", True).option("dateFormat", "yyyy-MM-dd")
    return reader.load(path).where(C.in_range("date", start, end))


def lookback(df: DataFrame, as_of, days: int = 90) -> DataFrame:
    """The `days` calendar days before `as_of`, which is always given and never "now"."""
    until = F.lit(as_of).cast("date")
    return df.where((F.col("date") >= F.date_sub(until, days)) & (F.col("date") < until))


def landed_files(spark: SparkSession, path: str, glob: str = "*.json") -> DataFrame:
    """(file, modified, length) of the files below `path`, from their listing: no file is opened."""
    listed = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", glob)
        .load(path)
    )
    return listed.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_modification_time").alias("modified"),
        F.col("_metadata.file_size").alias("length"),
    )


def _bound(modified: dt.datetime, step: int) -> str:
    """A time in UTC, a millisecond after or before `modified`, which Spark's bounds leave out."""
    return (modified.astimezone(dt.timezone.utc) + dt.timedelta(milliseconds=step)).strftime("%Y-%m-%dT%H:%M:%S.%f")


def read_records(
    spark: SparkSession,
    path: str | list[str],
    glob: str = "*.json",
    schema: T.StructType = RECORDS,
    modified: tuple[dt.datetime, dt.datetime] | None = None,
) -> DataFrame:
    """Landed JSON: one array of records or one record per line, as text dates and doubles.

    With `modified`, only files last changed between these two times, both included; others are
    left out when files are listed.

    Adds `_corrupt`, the text of an unreadable line, and the columns of `FILE_ORDER`. A split of a
    file is read in order by one task, so these three give the order of records in their files
    however splits are packed into tasks.
    """
    fields = [*schema.fields, T.StructField(CORRUPT, T.StringType())]
    bounds = {}
    if modified:
        bounds = {"modifiedAfter": _bound(modified[0], -1), "modifiedBefore": _bound(modified[1], 1), "timeZone": "UTC"}
    return (
        spark.read.schema(T.StructType(fields))
        .options(**bounds)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", glob)
        .json(path)
        .withColumns({
            "_file": F.col("_metadata.file_path"),
            "_start": F.col("_metadata.file_block_start"),
            "_seq": F.monotonically_increasing_id(),
        })
    )


def symbol_from_path(df: DataFrame, file: str = "_file") -> DataFrame:
    """The symbol from the file's path; null when the path has none.

    Known layouts are `{symbol}/YYYY-MM.json`, `{symbol}/monthly/YYYY-MM.json` and
    `symbol={symbol}/..`. Paths arrive percent-encoded, and partition folders are encoded once more
    on writing.
    """

    def decoded(text):
        return F.url_decode(F.replace(text, F.lit("+"), F.lit("%2B")))

    def folder(text):
        return F.replace(decoded(text), F.lit("%2F"), F.lit("/"))

    monthly = F.regexp_extract(file, r"/([^/]+)/monthly/", 1)
    plain = F.regexp_extract(file, r"/([^/]+)/\d{4}-\d{2}\.[^/]*$", 1)
    keyed = F.regexp_extract(file, r"/symbol=([^/]+)/", 1)
    symbol = (
        F.when(keyed != "", decoded(decoded(keyed)))
        .when(monthly != "", folder(monthly))
        .when(plain != "", folder(plain))
    )
    return df.withColumn("symbol", symbol)


def normalise(df: DataFrame) -> DataFrame:
    """Provider columns to bar columns: first level of two-level names, lower case, no extras."""
    first_level = [name.split(".")[0].strip("`") for name in df.columns]
    df = df.toDF(*first_level)
    df = df.withColumnsRenamed({"index": "Date", "Stock Splits": "StockSplits"})
    df = df.drop(*PROVIDER_EXTRAS)
    return df.withColumnsRenamed({name: name.lower() for name in RECORDS.names})


def read_combined(spark: SparkSession, path: str) -> DataFrame:
    """Combined JSON lines in order. Unreadable lines are skipped; no row at all is an error."""
    symbol = T.StructField("symbol", T.StringType())
    records = read_records(spark, path, schema=T.StructType([symbol, *RECORDS.fields]))
    rows = records.where(F.col(CORRUPT).isNull()).select(
        "symbol",
        C.to_day("Date").alias("date"),
        *[C.known(n).alias(n.lower()) for n in RECORDS.names[1:]],
    ).where(F.col("date").isNotNull())
    if rows.isEmpty():
        raise ValueError(f"no valid record below {path}")
    return rows.orderBy("symbol", "date")


def read_catalog(spark: SparkSession, path: str) -> DataFrame:
    """Saved models below `path`, one row per readable metadata file, absent keys as Unknown."""
    meta = (
        spark.read.schema(MODEL_META)
        .option("mode", "DROPMALFORMED")
        .option("multiLine", True)
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.json")
        .json(path)
    )
    return meta.select(
        C.or_unknown("ticker").alias("ticker"),
        C.or_unknown("feature_set").alias("feature_set"),
        C.or_unknown("created_date").alias("created_date"),
        "features",
        F.col("model_path").alias("path"),
        "scaler_path",
    )
