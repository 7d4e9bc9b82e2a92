"""Topic source, topic sink and message handling on Structured Streaming."""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field

from pyarrow.fs import FileSystem, FileType
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

import barloom
from barloom.schemas import MESSAGES

cloudpickle.register_pickle_by_value(barloom)


@dataclass(frozen=True)
class Topic:
    """Where messages come from and go to.

    `kafka` needs the connector on the class path. `json` keeps messages as files of (key, value)
    rows below `path` and stands in for a broker where there is none.
    """

    name: str = "test_1"
    format: str = "kafka"
    servers: str = "localhost:9092"
    group: str = "my-group"
    path: str | None = None
    options: dict[str, str] = field(default_factory=dict)


def read_topic(spark: SparkSession, topic: Topic) -> DataFrame:
    """Messages as key and value text, from the earliest offset the checkpoint does not know."""
    if topic.format != "kafka":
        return spark.readStream.schema(MESSAGES).options(**topic.options).format(
            topic.format
        ).load(topic.path)
    stream = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", topic.servers)
        .option("subscribe", topic.name)
        .option("startingOffsets", "earliest")
        .option("kafka.group.id", topic.group)
        .options(**topic.options)
        .load()
    )
    return stream.select(F.col("key").cast("string"), F.col("value").cast("string"))


def _start(writer, wait: bool) -> StreamingQuery:
    query = (writer.trigger(availableNow=True) if wait else writer).start()
    if wait:
        query.awaitTermination()
    return query


def write_topic(df: DataFrame, topic: Topic, checkpoint: str, wait: bool = False) -> StreamingQuery:
    """Send key and value rows of a stream. `wait` works off what is there and returns."""
    writer = df.select("key", "value").writeStream.option("checkpointLocation", checkpoint)
    if topic.format == "kafka":
        writer = (
            writer.format("kafka")
            .option("kafka.bootstrap.servers", topic.servers)
            .option("topic", topic.name)
        )
    else:
        writer = writer.format(topic.format).option("path", topic.path)
    return _start(writer.options(**topic.options), wait)


def write_table(df: DataFrame, path: str, checkpoint: str, wait: bool = False) -> StreamingQuery:
    """Append a stream to a Parquet table, exactly once."""
    writer = df.writeStream.format("parquet").option("checkpointLocation", checkpoint)
    return _start(writer.option("path", path), wait)


def handle(
    df: DataFrame,
    process: Callable[[DataFrame, int], None],
    checkpoint: str,
    wait: bool = False,
) -> StreamingQuery:
    """Call `process(batch, batch_id)` for each batch of messages."""
    writer = df.writeStream.option("checkpointLocation", checkpoint).foreachBatch(process)
    return _start(writer, wait)


def _print_all(rows: Iterable[Row]) -> None:
    for row in rows:
        print(f"Received message: {row['value']} (key: {row['key']})")


def to_console(batch: DataFrame, batch_id: int) -> None:
    """Print every message of a batch where it lies, on the console of its executor."""
    batch.foreachPartition(_print_all)


class OncePerPart:
    """Handles messages in the tasks that read them, each part of an epoch once.

    `open` refuses a part that an earlier attempt completed, so an epoch that is replayed after a
    failure changes nothing for the parts that were done. What a part wrote is put in its place
    when the part is complete; a part that fails leaves nothing. Subclasses say in `handled` what
    to write for a message; it may also act on the message, which for a part that fails and is
    tried again happens again.
    """

    def __init__(self, path: str):
        self.path = re.sub(r"^file:/+", "/", path.rstrip("/"))

    def handled(self, row: Row) -> str | None:
        """One line for a message, or nothing."""
        return json.dumps(row.asDict())

    def open(self, partition_id: int, epoch_id: int) -> bool:
        self._fs, folder = FileSystem.from_uri(self.path)
        self._target = f"{folder}/epoch={epoch_id}/part-{partition_id:05d}.json"
        if self._fs.get_file_info(self._target).type != FileType.NotFound:
            return False
        self._fs.create_dir(self._target.rsplit("/", 1)[0], recursive=True)
        self._draft = f"{self._target.replace('part-', '_part-')}.{uuid.uuid4().hex}"
        self._out = self._fs.open_output_stream(self._draft)
        return True

    def process(self, row: Row) -> None:
        line = self.handled(row)
        if line is not None:
            self._out.write(f"{line}\n".encode())

    def close(self, error: Exception | None) -> None:
        if getattr(self, "_out", None) is None:
            return  # nothing was opened
        self._out.close()
        self._out = None
        if error is None:
            self._fs.move(self._draft, self._target)
        else:
            self._fs.delete_file(self._draft)


def handle_each(df: DataFrame, handler: OncePerPart, checkpoint: str, wait: bool = False) -> StreamingQuery:
    """Give every message to a handler in the task that read it; no message comes to the driver."""
    return _start(df.writeStream.option("checkpointLocation", checkpoint).foreach(handler), wait)


def into_table(path: str) -> Callable[[DataFrame, int], None]:
    """A handler that stores each batch in its own folder, so a repeated batch replaces itself."""

    def process(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return process


def envelope(df: DataFrame, message: str = "message", ts: str = "ts") -> DataFrame:
    """`{message, timestamp}` keyed by epoch seconds with six digits, as text."""
    micros = F.unix_micros(ts)
    second = F.expr(f"unix_micros({ts}) div 1000000").cast("string")
    fraction = F.lpad((micros % 1000000).cast("string"), 6, "0")
    stamp = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    body = F.struct(F.col(message).alias("message"), stamp.alias("timestamp"))
    return df.select(
        F.concat(second, F.lit("."), fraction).alias("key"), F.to_json(body).alias("value")
    )
