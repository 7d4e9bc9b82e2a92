"""Row-ordered work on a series without giving a whole series to one task.

A plain `Window.partitionBy("symbol")` sorts each series in a single task, so one symbol with a
third of the rows would hold up the job. Here every row first learns its position in its series
(a distributed prefix sum over calendar chunks), then series are cut into blocks of equal row
count, and each block carries copies of the few neighbouring rows its frames look at. All windows
then run per (symbol, block), with one exchange for any number of indicators.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.session import cut

POSITION, LENGTH, BLOCK = "_pos", "_len", "_block"
BLOCK_ROWS = 4096

Expr = Callable[[WindowSpec], Column]


def default_chunk(df: DataFrame, order: str) -> Column:
    """Calendar chunk of the order column.

    A year of daily rows is at most 366, a month of minute rows at most 44,640. Denser series
    should be given a finer chunk.
    """
    kind = df.schema[order].dataType
    if isinstance(kind, T.DateType):
        return F.year(order)
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.year(order) * 100 + F.month(order)
    raise TypeError(f"give a chunk for order column {order!r} of type {kind.simpleString()}")


def with_position(
    df: DataFrame, order: str = "date", chunk: Column | None = None, key: str = "symbol"
) -> DataFrame:
    """Add `_pos`, the 0-based rank of `order` in the series, and `_len`, its row count.

    `chunk` must grow with `order`, and (key, order) must be unique. Ranks are taken per
    (key, chunk); the small table of chunk sizes, whose length follows the calendar and not the
    data, gives each chunk its offset. Rows without a key are dropped by the join.
    """
    if POSITION in df.columns:
        return df
    chunked = df.withColumn("_chunk", default_chunk(df, order) if chunk is None else chunk)
    sizes = chunked.groupBy(key, "_chunk").agg(F.count("*").alias("_rows"))
    series = Window.partitionBy(key)
    earlier = series.orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        key,
        "_chunk",
        F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_offset"),
        F.sum("_rows").over(series).alias(LENGTH),
    )
    rank = F.row_number().over(Window.partitionBy(key, "_chunk").orderBy(order))
    return (
        chunked.withColumn("_rank", rank)
        .join(offsets, [key, "_chunk"])
        .withColumn(POSITION, F.col("_offset") + F.col("_rank") - 1)
        .drop("_chunk", "_rank", "_offset")
    )


def without_position(df: DataFrame) -> DataFrame:
    return df.drop(POSITION, LENGTH, BLOCK)


def block_of(rows: int, pos: str = POSITION) -> Column:
    return F.floor(F.col(pos) / F.lit(rows))


def _with_blocks(
    df: DataFrame, rows: int, before: int, after: int, key: str
) -> DataFrame:
    """One copy of each row per block that looks at it, exchanged to that block.

    The exchange is stated here, below the columns the windows work on, so that only the rows
    themselves are moved.
    """
    if max(before, after) > rows:
        raise ValueError(f"frames reach {max(before, after)} rows, more than a block of {rows}")
    home = block_of(rows)
    if before or after:
        offset = F.col(POSITION) % rows
        last = F.floor((F.col(LENGTH) - 1) / F.lit(rows))
        to_previous = ((offset < after) & (home > 0)).cast("long")
        to_next = ((offset >= rows - before) & (home < last)).cast("long")
        home = F.explode(F.sequence(home - to_previous, home + to_next))
    return df.withColumn(BLOCK, home).repartition(key, BLOCK)


@dataclass(frozen=True)
class Indicator:
    """A set of output columns and the frame they need.

    `steps` are dictionaries of column expressions; a later step may use columns of an earlier
    one. Names that start with an underscore are helpers and do not reach the result; equal
    helpers of several indicators are computed once. `before` and `after` are the rows looked at
    on either side; `reach` limits the rows of a block including its copies.
    """

    steps: tuple[dict[str, Expr], ...]
    before: int = 0
    after: int = 0
    reach: int | None = None

    @property
    def outputs(self) -> list[str]:
        return [name for step in self.steps for name in step if not name.startswith("_")]


def _block_rows(before: int, after: int, reach: int | None) -> int:
    rows = max(BLOCK_ROWS, 8 * max(before, after))
    if reach is not None:
        rows = min(rows, reach - before - after)
    return rows


def _passes(indicators: list[Indicator]) -> list[list[Indicator]]:
    """Group indicators whose frames and reaches fit one block size; one group is the norm."""
    groups: list[list[Indicator]] = []
    for item in indicators:
        for group in groups:
            trial = [*group, item]
            if _fits(trial):
                group.append(item)
                break
        else:
            if not _fits([item]):
                raise ValueError("the indicator looks further back than its block may hold")
            groups.append([item])
    return groups


def _frame(group: list[Indicator]) -> tuple[int, int, int]:
    before = max(item.before for item in group)
    after = max(item.after for item in group)
    reaches = [item.reach for item in group if item.reach is not None]
    return before, after, _block_rows(before, after, min(reaches, default=None))


def _fits(group: list[Indicator]) -> bool:
    before, after, rows = _frame(group)
    return rows >= max(before, after, 1)


def measure(
    df: DataFrame,
    *indicators: Indicator,
    order: str = "date",
    chunk: Column | None = None,
    key: str = "symbol",
    block_rows: int | None = None,
    keep_position: bool = False,
) -> DataFrame:
    """Add the outputs of all indicators to `df`."""
    had_position = POSITION in df.columns
    out = with_position(df, order, chunk, key)
    for group in _passes(list(indicators)):
        out = _measure_pass(out, group, key, block_rows)
    return out if had_position or keep_position else without_position(out)


def _measure_pass(
    df: DataFrame, group: list[Indicator], key: str, block_rows: int | None
) -> DataFrame:
    before, after, rows = _frame(group)
    reaches = [item.reach for item in group if item.reach is not None]
    if block_rows and reaches and block_rows + before + after > min(reaches):
        raise ValueError(
            f"a block of {block_rows} rows and its copies pass the {min(reaches)} rows it may hold"
        )
    rows = block_rows or rows
    carried = [c for c in df.columns if c != BLOCK]
    window = Window.partitionBy(key, BLOCK).orderBy(POSITION)
    out = _with_blocks(df.select(*carried), rows, before, after, key)
    # Rows since the start of the block, copies included.
    start = F.greatest(F.col(BLOCK) * rows - before, F.lit(0))
    out = out.withColumn("_step", F.col(POSITION) - start)
    for level in range(max(len(item.steps) for item in group)):
        columns: dict[str, Expr] = {}
        for item in group:
            columns.update(item.steps[level] if level < len(item.steps) else {})
        out = out.withColumns(
            {name: build(window) for name, build in columns.items() if name not in out.columns}
        )
    outputs = [name for item in group for name in item.outputs]
    return out.where(F.col(BLOCK) == block_of(rows)).select(
        *carried, BLOCK, *dict.fromkeys(outputs)
    )


def _in_block(cols: list[str], key: str, pos: str, block: str, forward: bool) -> dict[str, Column]:
    # Always a frame that only grows: the "rest of the block" frame costs its square.
    towards = F.col(pos).asc() if forward else F.col(pos).desc()
    seen = Window.partitionBy(key, block).orderBy(towards).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    return {c: F.last(c, ignorenulls=True).over(seen) for c in cols}


def _from_neighbours(
    rims: DataFrame, cols: list[str], key: str, block: str, forward: bool, rows: int, levels: int
) -> DataFrame:
    """Per block, the nearest known values outside of it, from one row per block."""
    if levels <= 1:
        towards = F.col(block).asc() if forward else F.col(block).desc()
        seen = Window.partitionBy(key).orderBy(towards).rowsBetween(
            Window.unboundedPreceding, Window.currentRow
        )
        known = rims.withColumns({c: F.last(c, ignorenulls=True).over(seen) for c in cols})
    else:
        outer = f"{block}_outer"
        inner = rims.withColumn(outer, block_of(rows, block))
        inner = inner.withColumns(_in_block(cols, key, block, outer, forward))
        nearest = F.max_by if forward else F.min_by
        edges = inner.groupBy(key, outer).agg(
            *[nearest(c, F.when(F.col(c).isNotNull(), F.col(block))).alias(c) for c in cols]
        )
        edges = _from_neighbours(edges, cols, key, outer, forward, rows, levels - 1)
        known = _filled(inner, edges, cols, [key, outer]).drop(outer)
    return known.withColumn(block, F.col(block) + (1 if forward else -1))


def _filled(df: DataFrame, edges: DataFrame, cols: list[str], on: list[str]) -> DataFrame:
    named = edges.select(*on, *[F.col(c).alias(f"{c}_edge") for c in cols])
    out = df.join(named, on, "left")
    return out.withColumns({c: F.coalesce(F.col(c), F.col(f"{c}_edge")) for c in cols}).drop(
        *[f"{c}_edge" for c in cols]
    )


def fill(
    df: DataFrame,
    cols: list[str],
    forward: bool,
    order: str = "date",
    chunk: Column | None = None,
    key: str = "symbol",
    block_rows: int | None = None,
    levels: int = 1,
) -> DataFrame:
    """Fill gaps from the previous (`forward`) or the next known row, however far away it is.

    Gaps are filled inside blocks by a window, on the exchange that `measure(...,
    keep_position=True)` left if there is one. That result is written once; the row at each
    block's rim then says what neighbouring blocks need, so the chain before is not run again.
    `levels` nests the table of rims for series of more than about 10^10 rows.
    """
    names = df.columns
    out = with_position(df, order, chunk, key)
    if BLOCK not in names:
        out = out.withColumn(BLOCK, block_of(block_rows or BLOCK_ROWS))
    out = cut(out.withColumns(_in_block(cols, key, POSITION, BLOCK, forward)), "filled")
    nearest = F.max_by if forward else F.min_by
    rims = out.groupBy(key, BLOCK).agg(*[nearest(c, POSITION).alias(c) for c in cols])
    edges = _from_neighbours(rims, cols, key, BLOCK, forward, block_rows or BLOCK_ROWS, levels)
    return _filled(out, edges, cols, [key, BLOCK]).select(*names)
