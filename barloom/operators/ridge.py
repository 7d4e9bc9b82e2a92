"""A ridge regression per symbol on the rows before each row, without writing windows out.

The normal equations of all windows of a series hold products of columns at two lags, summed over
the series. Such a sum depends on the difference of the lags, but for the first and last rows of
the series. So blocks of a series give the products of each two columns at each distance once,
`length + 1` small matrices per block, and the rows at both ends make up the difference. What is
exchanged is a block's rows once, with the rows before it, and never a window per row.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

import barloom
from barloom.operators.series import BLOCK_ROWS, LENGTH, POSITION, with_position
from barloom.session import cut

cloudpickle.register_pickle_by_value(barloom)

# Blocks whose sums are added up in one step before a symbol's are.
PART_BLOCKS = 64


def blocks(rows: DataFrame, cols: list[str], target: str, length: int, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(symbol, block, n, items): a series in blocks of `block_rows` rows, each led by copies of the
    `length` rows before it. An item is (position, date, values), the target last."""
    if not 0 < length <= block_rows:
        raise ValueError("a window is at most a block")
    known = rows.select("symbol", "date", *dict.fromkeys([*cols, target])).dropna(subset=["symbol", "date"])
    placed = with_position(known)
    values = F.array(*[F.col(c).cast("double") for c in [*cols, target]])
    in_blocks = F.sequence(F.floor(F.col(POSITION) / block_rows), F.least(
        F.floor((F.col(POSITION) + length) / block_rows), F.floor((F.col(LENGTH) - 1) / block_rows)))
    item = F.struct(F.col(POSITION).alias("at"), "date", values.alias("v"))
    return placed.select("symbol", F.col(LENGTH).alias("n"), F.explode(in_blocks).alias("block"), item.alias("item")).groupBy(
        "symbol", "block").agg(F.max("n").alias("n"), F.array_sort(F.collect_list("item")).alias("items"))


def _arrays(batch: pa.RecordBatch, row: int) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Positions, values by row and column, and dates of a block."""
    items = batch.column("items")[row].values
    values = items.field("v")
    at = items.field("at").to_numpy()
    return at, values.flatten().to_numpy(zero_copy_only=False).reshape(len(at), -1), items.field("date")


def _products(batches: Iterable[pa.RecordBatch], length: int, block_rows: int) -> Iterator[pa.RecordBatch]:
    """Per block the products of each two columns at each distance, and the columns' sums."""
    for batch in batches:
        out = []
        for row in range(batch.num_rows):
            at, values, _ = _arrays(batch, row)
            first = batch.column("block")[row].as_py() * block_rows
            led = int(np.searchsorted(at, first))
            # Rows before the start of the series count nothing.
            padded = np.concatenate([np.zeros((length - led, values.shape[1])), values])
            own = values[led:]
            sums = [own.T @ padded[length - d:length - d + len(own)] for d in range(length + 1)]
            out.append((batch.column("symbol")[row].as_py(), batch.column("block")[row].as_py() // PART_BLOCKS,
                        np.array(sums).tobytes(), own.sum(axis=0).tobytes()))
        columns = list(zip(*out)) if out else [()] * 4
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, (pa.string(), pa.int64(), pa.binary(), pa.binary()))],
            ["symbol", "part", "products", "sums"])


def _added(key: tuple, table: pa.Table) -> pa.Table:
    def total(name):
        return sum(np.frombuffer(b.as_py(), np.float64) for b in table.column(name)).tobytes()

    return pa.table({"symbol": [key[0].as_py()], "products": [total("products")], "sums": [total("sums")]})


def normal_equations(
    products: np.ndarray, sums: np.ndarray, head: np.ndarray, tail: np.ndarray, n: int, length: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray, float, float]:
    """Covariances of the window's values, with the target, means of both, and the target's variance.

    `products[d]` holds the sums over s of column i at s times column j at s - d, the target being
    the last column; `head` and `tail` are the first and last `length` rows.
    """
    k, rows = head.shape[1] - 1, n - length
    gram = np.zeros((length, k, length, k))
    x_head, x_tail = head[:, :k], tail[:, :k]
    for d in range(length):
        # Lags a and b = a + d: positions s = t - a run from length - a to n - 1 - a.
        early = np.einsum("si,sj->sij", x_head[d:], x_head[:length - d]).cumsum(axis=0)
        late = np.einsum("si,sj->sij", x_tail[d:][::-1], x_tail[:length - d][::-1]).cumsum(axis=0)
        for a in range(1, length - d + 1):
            block = products[d, :k, :k] - late[a - 1]
            if length - a > d:
                block = block - early[length - a - d - 1]
            gram[length - a, :, length - a - d, :] = block
            gram[length - a - d, :, length - a, :] = block.T
    head_sum = np.concatenate([np.zeros((1, k)), x_head.cumsum(axis=0)])
    tail_sum = np.concatenate([np.zeros((1, k)), x_tail[::-1].cumsum(axis=0)])
    mean, cross = np.zeros((length, k)), np.zeros((length, k))
    y_head = head[:, k]
    for b in range(1, length + 1):
        mean[length - b] = (sums[:k] - head_sum[length - b] - tail_sum[b]) / rows
        cross[length - b] = (products[b, k, :k] - y_head[b:] @ x_head[:length - b]) / rows
    y_mean = (sums[k] - y_head.sum()) / rows
    y_var = (products[0, k, k] - y_head @ y_head) / rows - y_mean**2
    flat = mean.ravel()
    covariance = gram.reshape(length * k, length * k) / rows - np.outer(flat, flat)
    return covariance, cross.ravel() - flat * y_mean, flat, y_mean, max(y_var, 0.0)


def _solve(batches: Iterable[pa.RecordBatch], length: int, penalty: float) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for row in range(batch.num_rows):
            r = {c: batch.column(c)[row].as_py() for c in ("symbol", "products", "sums", "n")}
            ends = {c: np.array([i["v"] for i in batch.column(c)[row].as_py()], float) for c in ("head", "tail")}
            width = ends["head"].shape[1]
            covariance, cross, mean, y_mean, y_var = normal_equations(
                np.frombuffer(r["products"], np.float64).reshape(length + 1, width, width),
                np.frombuffer(r["sums"], np.float64), ends["head"], ends["tail"], r["n"], length)
            weights = np.zeros(len(cross))
            if y_var > 0:
                lower = np.linalg.cholesky(covariance + np.eye(len(cross)) * (penalty / np.sqrt(y_var)))
                weights = np.linalg.solve(lower.T, np.linalg.solve(lower, cross))
            out.append((r["symbol"], weights.tolist(), float(y_mean - weights @ mean), r["n"] - length))
        columns = list(zip(*out)) if out else [()] * 4
        kinds = (pa.string(), pa.list_(pa.float64()), pa.float64(), pa.int64())
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds)], ["symbol", "weights", "bias", "n"])


def fit(
    rows: DataFrame, cols: list[str], target: str = "close", length: int = 120, penalty: float = 0.01,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """(symbol, weights, bias, n): the ridge regression of `target` on the `length` rows before it.

    Weights are in the order of the flattened window, oldest row first; `n` counts the windows. The
    penalty counts in units of the target's deviation, as in Spark ML without standardised columns.
    A symbol with at most `length` rows has no model, one with a constant target has weights 0.
    Columns must be complete and should be scaled.
    """
    if penalty <= 0:
        raise ValueError("the penalty must be positive")
    dealt = cut(blocks(rows, cols, target, length, block_rows), "blocks")
    found = dealt.where(F.col("n") > length).mapInArrow(
        partial(_products, length=length, block_rows=block_rows), "symbol string, part long, products binary, sums binary")
    schema = "symbol string, products binary, sums binary"
    summed = found.groupBy("symbol", "part").applyInArrow(_added, schema).groupBy("symbol").applyInArrow(_added, schema)
    items = dealt.select("symbol", "n", "block", F.explode("items").alias("item")).where(
        (F.col("item.at") >= F.col("block") * block_rows) & (F.col("n") > length)
        & ((F.col("item.at") < length) | (F.col("item.at") >= F.col("n") - length)))

    def end(condition, name):
        return F.array_sort(F.collect_list(F.when(condition, F.col("item")))).alias(name)

    ends = items.groupBy("symbol", "n").agg(
        end(F.col("item.at") < length, "head"), end(F.col("item.at") >= F.col("n") - length, "tail"))
    return summed.join(ends, "symbol").mapInArrow(
        partial(_solve, length=length, penalty=penalty), "symbol string, weights array<double>, bias double, n long")


def _predict(batches: Iterable[pa.RecordBatch], length: int, block_rows: int, names: list[str]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in range(batch.num_rows):
            at, values, dates = _arrays(batch, row)
            weights = np.array(batch.column("weights")[row].as_py()).reshape(length, -1)
            own = np.flatnonzero((at >= batch.column("block")[row].as_py() * block_rows) & (at >= length))
            if not len(own):
                continue
            guess = np.full(len(own), batch.column("bias")[row].as_py())
            for lag in range(1, length + 1):
                guess += values[own - lag, :-1] @ weights[length - lag]
            symbol = pa.array([batch.column("symbol")[row].as_py()] * len(own), pa.string())
            yield pa.RecordBatch.from_arrays(
                [symbol, dates.take(pa.array(own)), pa.array(values[own, -1]), pa.array(guess)], names)


def predict(
    models: DataFrame, rows: DataFrame, cols: list[str], target: str = "close", length: int = 120,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """(symbol, date, actual, predicted) of every row that has a window before it."""
    dealt = blocks(rows, cols, target, length, block_rows).join(models.select("symbol", "weights", "bias"), "symbol")
    names = ["symbol", "date", "actual", "predicted"]
    return dealt.mapInArrow(partial(_predict, length=length, block_rows=block_rows, names=names),
                            "symbol string, date date, actual double, predicted double")
