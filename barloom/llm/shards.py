"""Shards along a Hilbert curve through several metadata dimensions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom.session import cut

BITS = 4
CELLS = 1 << BITS
LEADING = 6


@dataclass(frozen=True)
class Dimension:
    """A column and how it is quantised: "number" in equal widths, "log" by powers of two,
    "text" in equal widths of the bytes that follow the prefix all values share."""

    column: str
    kind: str


DOCUMENT_DIMENSIONS = (
    Dimension("lang", "text"), Dimension("source", "text"),
    Dimension("size", "log"), Dimension("doc_id", "number"),
)


def _leading(column: Column, skip: int) -> Column:
    """The bytes after the first `skip` as a number that keeps their order."""
    part = F.hex(F.substring(F.encode(column, "UTF-8"), skip + 1, LEADING))
    return F.conv(F.rpad(part, 2 * LEADING, "0"), 16, 10).cast("long")


def _scaled(value: Column, low: int, high: int, cells: int) -> Column:
    """(value - low) * cells div (high - low + 1) in exact integers."""
    wide = "decimal(38,0)"
    shifted = (value.cast(wide) - F.lit(str(low)).cast(wide)) * F.lit(cells)
    return F.call_function("div", shifted.cast(wide), F.lit(str(high - low + 1)).cast(wide))


def _common(low: str, high: str) -> int:
    """The length in bytes of the prefix that `low`, `high` and all strings between share."""
    a, b = low.encode(), high.encode()
    return next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))


def _bounds(df: DataFrame, dimensions) -> dict[str, tuple]:
    """The least and greatest value of each dimension, in one pass."""
    row = df.agg(*(f(d.column).alias(f"{n}{i}") for i, d in enumerate(dimensions)
                   for n, f in (("low", F.min), ("high", F.max)))).first()
    return {d.column: (row[f"low{i}"], row[f"high{i}"]) for i, d in enumerate(dimensions)}


def _number(dim: Dimension, low, high) -> tuple[Column, int, int]:
    column = F.col(dim.column)
    if dim.kind == "text":
        skip = _common(low, high)
        ends = [int(s.encode()[skip:skip + LEADING].ljust(LEADING, b"\0").hex(), 16) for s in (low, high)]
        return _leading(column, skip), *ends
    return column.cast("long"), int(low), int(high)


def _cell(dim: Dimension, low, high) -> Column:
    """The quantised value, 0 to CELLS - 1; null is 0."""
    if low is None:
        return F.lit(0).cast("long")
    if dim.kind == "log":
        cell = F.least(F.floor(F.log2(F.greatest(F.col(dim.column), F.lit(1)))), F.lit(CELLS - 1))
    else:
        cell = _scaled(*_number(dim, low, high), CELLS)
    return F.coalesce(cell.cast("long"), F.lit(0).cast("long"))


def _bind(value: Column, body) -> Column:
    """`body(value)` with `value` computed once."""
    return F.transform(F.array(value), body)[0]


def _curve(axes: list[Column]) -> Column:
    """The place on the Hilbert curve of a cell given by its quantised values.

    Rotations are undone from the highest bit down, the result is Gray-encoded, and its bits are
    interleaved.
    """
    n = len(axes)
    steps = F.array(*(F.struct(F.lit(1 << bit).cast("long").alias("q"), F.lit(i).alias("i"))
                      for bit in range(BITS - 1, 0, -1) for i in range(n)))

    def undo(x, step):
        own, low = F.element_at(x, step["i"] + 1), step["q"] - 1
        swap = x[0].bitwiseXOR(own).bitwiseAND(low)
        return F.transform(x, lambda v, j: F.when(
            own.bitwiseAND(step["q"]) != 0, F.when(j == 0, v.bitwiseXOR(low)).otherwise(v),
        ).otherwise(F.when((j == 0) | (j == step["i"]), v.bitwiseXOR(swap)).otherwise(v)))

    def gray(x):
        out = [x[0]]
        for i in range(1, n):
            out.append(out[-1].bitwiseXOR(x[i]))
        return F.array(*out)

    def turned(x):
        turn = F.lit(0).cast("long")
        for bit in range(BITS - 1, 0, -1):
            is_set = x[n - 1].bitwiseAND(F.lit(1 << bit)) != 0
            turn = turn.bitwiseXOR(F.when(is_set, F.lit((1 << bit) - 1)).otherwise(F.lit(0)))
        return _bind(turn, lambda t: F.transform(x, lambda v: v.bitwiseXOR(t)))

    def interleaved(x):
        bits = [F.shiftleft(F.shiftright(x[i], bit).bitwiseAND(F.lit(1)), bit * n + n - 1 - i)
                for i in range(n) for bit in range(BITS)]
        return sum(bits[1:], bits[0])

    x = F.aggregate(steps, F.array(*axes), undo)
    return _bind(_bind(_bind(x, gray), turned), interleaved).cast("long")


def assign(rows: DataFrame, shards: int, dimensions=DOCUMENT_DIMENSIONS, key: str = "doc_id",
           ties: tuple[str, ...] = ()) -> DataFrame:
    """`rows` with hilbert, shard and slot: runs of equal row count along the curve.

    Rows are ordered by curve index, key (null first) and `ties`; run i holds the rows from rank
    ceil(i * n / shards) on, so counts differ by one at most; slots count from 0 in each shard.
    Rows are range-partitioned and sorted once; their written place in a partition and one row per
    partition give the rank, so neither outlying keys nor a curve index or key with very many rows
    make a large task. Rows equal in key and ties take their slots in any order. The dimensions'
    bounds and the row count are all that reaches the driver. Input columns named hilbert, shard,
    slot or beginning with an underscore are replaced.
    """
    rows = cut(rows.withColumn("_own", F.monotonically_increasing_id()), "shard-rows")
    n = rows.count()
    bounds = _bounds(rows, dimensions)
    placed = rows.withColumn("hilbert", _curve([_cell(d, *bounds[d.column]) for d in dimensions]))
    order = ["hilbert", key, *ties, "_own"]
    dealt = placed.repartitionByRange(*order).sortWithinPartitions(*order).drop("_own")
    dealt = cut(dealt.withColumn("_place", F.monotonically_increasing_id()), "shard-order")
    dealt = dealt.withColumn("_part", F.shiftright("_place", 33))
    runs = dealt.groupBy("_part").agg(F.min("_place").alias("_first"), F.count("*").alias("_n"))
    before = F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")
    runs = runs.select("_part", (before - F.col("_first")).alias("_shift"))
    ranked = dealt.join(runs, "_part").withColumn("_rank", F.col("_place") + F.col("_shift"))
    shard = F.expr(f"_rank * {shards} div {max(n, 1)}")
    ranked = ranked.withColumn("shard", shard.cast("int"))
    begin = F.expr(f"(shard * {n}L + {shards - 1}) div {shards}")
    return ranked.withColumn("slot", (F.col("_rank") - begin).cast("long")).drop("_part", "_place", "_shift", "_rank")


def assign_documents(docs: DataFrame, shards: int = 24) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard, hilbert) of every row.

    Only ids, sizes, checksums, language and source are moved, never the text. Size is the UTF-8
    length of the text plus 8; a null text is empty. The law is "rows": counts of shards differ by
    one at most. Null languages and sources lie at the lower end of their axis. Texts of any length
    are read once, for their size and checksum. An empty table gives an empty table; other columns
    are not looked at.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    slim = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
        F.col("lang").cast("string").alias("lang"),
        F.col("source").cast("string").alias("source"),
    )
    out = assign(slim, shards, ties=("size", "text_crc32"))
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"), "hilbert")


def write(assigned: DataFrame, path: str) -> None:
    """One folder per shard, its files consecutive runs of the curve, so that the least and
    greatest values in their footers prune on every dimension."""
    runs = assigned.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot")
    runs.write.partitionBy("shard").parquet(path)
