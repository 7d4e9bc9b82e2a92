"""Session settings, the shared working folder, and lineage cuts."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Windows cost more per byte than scans: keep small exchanges spread over the cores.
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "128KB",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
}


# Input per exchange partition. Windows hold one block at a time and sorts spill, so a partition
# need not fit in memory; much smaller ones would make the exchange itself the burden at 100 TB.
PARTITION_BYTES = 1024 * 1024 * 1024
# The planner's size of an input it knows nothing about, and beyond.
UNKNOWN_BYTES = 1 << 60

_WRITTEN: list[str] = []


def build_session(
    master: str | None = None, input_bytes: int | None = None, **extra: str
) -> SparkSession:
    """A session with the settings above. On a cluster leave `master` to spark-submit.

    `input_bytes`, the size of the largest input, sets the number of exchange partitions; the
    adaptive planner merges those that turn out small.
    """
    settings = dict(SETTINGS)
    if input_bytes:
        settings["spark.sql.shuffle.partitions"] = str(max(200, input_bytes // PARTITION_BYTES))
    builder = SparkSession.builder.appName("barloom")
    if master:
        builder = builder.master(master)
    for key, value in {**settings, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def size_exchanges(df: DataFrame) -> None:
    """Raise the session's number of exchange partitions to what the inputs of `df` ask for.

    The sizes of its scans are added up; an input of unknown size does not count.
    """
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size())]
    now = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    wanted = sum(s for s in sizes if s < UNKNOWN_BYTES) // PARTITION_BYTES
    if wanted > now:
        df.sparkSession.conf.set("spark.sql.shuffle.partitions", str(wanted))


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, named by `spark.checkpoint.dir`.

    A folder on one machine stands in for it only when Spark itself runs on one machine.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        folder = tempfile.mkdtemp(prefix="barloom-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path nobody has used yet, below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame, name: str = "cut") -> DataFrame:
    """Write `df` to the shared folder and read it back.

    The written table replaces the lineage, so a lost executor re-reads files instead of
    recomputing the chain, and two consumers do not evaluate the chain twice.
    """
    path = scratch_path(df.sparkSession, name)
    _WRITTEN.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release(spark: SparkSession, since: int = 0) -> None:
    """Delete the tables that `cut` wrote after the first `since` ones, when nothing reads them."""
    for path in _WRITTEN[since:]:
        Files(spark, path).delete(path)
    del _WRITTEN[since:]


def written() -> int:
    """How many tables of `cut` there are, to be given to `release`."""
    return len(_WRITTEN)


class Files:
    """Folders and files on whatever file system a path is on."""

    def __init__(self, spark: SparkSession, root: str):
        self._spark = spark
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(root).getFileSystem(spark._jsc.hadoopConfiguration())

    def exists(self, path: str) -> bool:
        return self._fs.exists(self._path(path))

    def names(self, path: str) -> list[str]:
        """What lies directly below a folder; nothing when there is no such folder."""
        if not self.exists(path):
            return []
        return sorted(f.getPath().getName() for f in self._fs.listStatus(self._path(path)))

    def move(self, source: str, target: str) -> None:
        """Put a file or folder in the place of another, if that exists."""
        place = self._path(target)
        self._fs.delete(place, True)
        self._fs.mkdirs(place.getParent())
        if not self._fs.rename(self._path(source), place):
            raise OSError(f"cannot move {source} to {target}")

    def replace(self, source: str, target: str) -> None:
        """Put a file in the place of another in one step, so readers see one of the two."""
        jvm = self._spark._jvm.org.apache.hadoop.fs
        overwrite = self._spark.sparkContext._gateway.new_array(jvm.Options.Rename, 1)
        overwrite[0] = jvm.Options.Rename.OVERWRITE
        context = jvm.FileContext.getFileContext(self._fs.getUri(), self._spark._jsc.hadoopConfiguration())
        context.rename(self._fs.makeQualified(self._path(source)), self._fs.makeQualified(self._path(target)), overwrite)

    def touch(self, path: str) -> None:
        self._fs.create(self._path(path), True).close()

    def write(self, path: str, data: bytes) -> None:
        """A file of these bytes."""
        out = self._fs.create(self._path(path), True)
        out.write(bytearray(data))
        out.close()

    def read(self, path: str) -> bytes:
        """The bytes of a small file."""
        stream = self._fs.open(self._path(path))
        try:
            return bytes(stream.readAllBytes())
        finally:
            stream.close()

    def full(self, path: str) -> str:
        """The path with the name of its file system."""
        return self._fs.makeQualified(self._path(path)).toString()

    def delete(self, path: str) -> None:
        self._fs.delete(self._path(path), True)
