"""A forest per symbol, grown for all symbols at once, level by level, from histograms.

Rows are packed into chunks of one symbol, a few thousand rows each, so a long series is many
chunks. In each level every chunk counts its rows by (tree, node, feature, bin); the counts of all
chunks are added up, and the best split of every open node of every tree of every symbol is found
by one window over bins. Nothing loops over symbols, and no task needs a whole series.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

import barloom
from barloom.session import cut, scratch_path

cloudpickle.register_pickle_by_value(barloom)

CHUNK_ROWS = 4096
# Trees that one task row grows; more trees of a symbol are more rows.
GROUP_TREES = 25
BINS = 64
# A tree: arrays over its nodes. The root is node 0, and a leaf has feature -1 and no children.
TREE = ("struct<feature:array<int>,threshold:array<double>,left:array<int>,right:array<int>,"
        "value:array<double>,gain:array<double>>")


@dataclass(frozen=True)
class Growth:
    """How trees grow. A split needs `min_leaf` rows on both sides and less squared error."""

    trees: int = 200
    depth: int = 15
    min_leaf: int = 2
    bins: int = BINS
    bootstrap: bool = True
    seed: int = 42


# --- bins and chunks ---------------------------------------------------------------------------


def cut_points(rows: DataFrame, cols: list[str], bins: int = BINS, distinct: int = 10_000) -> DataFrame:
    """(symbol, cuts): per column the borders between at most `bins` bins of a symbol's values.

    A column with few values has a border midway between each two neighbours, another at its
    quantiles, from a sketch of bounded size.
    """
    shares = [i / bins for i in range(1, bins)]

    def borders(name):
        few = F.array_sort(F.collect_set(F.when(F.col(f"{name}_n") <= bins, F.col(name))))
        midway = F.zip_with(F.slice(few, 1, F.greatest(F.size(few) - 1, F.lit(0))),
                            F.slice(few, 2, F.greatest(F.size(few) - 1, F.lit(0))), lambda a, b: (a + b) / 2)
        spread = F.array_distinct(F.percentile_approx(name, shares, distinct))
        return F.when(F.max(f"{name}_n") <= bins, midway).otherwise(spread).alias(name)

    counts = rows.groupBy("symbol").agg(*[F.approx_count_distinct(c, 0.02).alias(f"{c}_n") for c in cols])
    # Near the limit the sketch may err either way; both kinds of border are valid there.
    found = rows.join(counts, "symbol").groupBy("symbol").agg(*[borders(c) for c in cols])
    return found.select("symbol", F.array(*cols).alias("cuts"))


CHUNK = "symbol string, n long, bins binary, target binary, draws binary"


def _pack(key: tuple, table: pa.Table) -> pa.Table:
    """One chunk: bins by row and column as bytes, targets, and a hash of each row."""
    cuts = table.column("cuts")[0].as_py()
    values = table.column("values").combine_chunks().flatten().to_numpy().reshape(table.num_rows, -1)
    bins = np.stack([np.searchsorted(np.array(c, float), values[:, i], "left") for i, c in enumerate(cuts)], axis=1)
    return pa.table({
        "symbol": [key[0].as_py()],
        "n": [table.num_rows],
        "bins": [bins.astype(np.uint8).tobytes()],
        "target": [table.column("target").to_numpy().astype(np.float64).tobytes()],
        "draws": [table.column("hash").to_numpy().astype(np.int64).tobytes()],
    })


def chunks(rows: DataFrame, cuts: DataFrame, cols: list[str], target: str, seed: int) -> DataFrame:
    """The rows of each symbol in chunks of about CHUNK_ROWS rows, dealt by a hash of symbol and date."""
    many = rows.groupBy("symbol").agg(F.ceil(F.count("*") / CHUNK_ROWS).alias("chunks"))
    place = F.xxhash64("symbol", F.col("date").cast("string"), F.lit(seed))
    dealt = rows.select(
        "symbol", F.array(*[F.col(c).cast("double") for c in cols]).alias("values"),
        F.col(target).cast("double").alias("target"), place.alias("hash"),
    ).join(many, "symbol").join(cuts, "symbol")
    dealt = dealt.withColumn("chunk", F.pmod("hash", "chunks")).drop("chunks")
    return dealt.groupBy("symbol", "chunk").applyInArrow(_pack, CHUNK)


# --- growing -----------------------------------------------------------------------------------


def _mixed(hashes: np.ndarray, number: int) -> np.ndarray:
    """Shares in [0, 1) by a mix of row hashes and a number."""
    x = hashes.view(np.uint64) + np.uint64((number + 1) * 0x9E3779B97F4A7C15 % (1 << 64))
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return (x ^ (x >> np.uint64(31))).astype(np.float64) / 2.0**64


def draw(hashes: np.ndarray, tree: int, bootstrap: bool) -> np.ndarray:
    """How often a tree draws each row: a Poisson number of mean 1, by the row's hash and the tree."""
    if not bootstrap:
        return np.ones(len(hashes))
    limits = np.cumsum(np.exp(-1) / np.cumprod([1, *range(1, 12)]))
    return np.searchsorted(limits, _mixed(hashes, tree), "right").astype(np.float64)


def _histograms(batches: Iterable[pa.RecordBatch], level: int, growth: Growth) -> Iterator[pa.RecordBatch]:
    """Per chunk the weights and weighted targets by tree, open node, feature and bin.

    `nodes` of a row holds the splits of its trees above this level. Nodes are numbered as in a
    heap, from 1.
    """
    names = ["symbol", "tree", "node", "feature", "bin", "weight", "total"]
    kinds = [pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.float64(), pa.float64()]
    for batch in batches:
        for i in range(batch.num_rows):
            row = {c: batch.column(c)[i].as_py() for c in batch.schema.names}
            n = row["n"]
            bins = np.frombuffer(row["bins"], np.uint8).reshape(n, -1).astype(np.int64)
            target, hashes = np.frombuffer(row["target"], np.float64), np.frombuffer(row["draws"], np.int64)
            width, first = bins.shape[1], row["group"] * GROUP_TREES
            splits: dict[int, tuple[list, list, list]] = {}
            for s in row["nodes"] or ():
                for kept, value in zip(splits.setdefault(s["tree"], ([], [], [])), (s["node"], s["feature"], s["bin"])):
                    kept.append(value)
            parts = []
            for tree in range(first, min(first + GROUP_TREES, growth.trees)):
                weight = draw(hashes, tree, growth.bootstrap)
                rows, node = np.flatnonzero(weight > 0), None
                node = np.ones(len(rows), np.int64)
                if level:
                    if tree not in splits:
                        continue
                    feature, border = np.full(1 << level, -1), np.zeros(1 << level, np.int64)
                    at = np.array(splits[tree][0])
                    feature[at], border[at] = splits[tree][1], splits[tree][2]
                    for _ in range(level):
                        f = feature[node]
                        inside = f >= 0
                        rows, node, f = rows[inside], node[inside], f[inside]
                        node = 2 * node + (bins[rows, f] > border[node])
                if not len(rows):
                    continue
                key = ((node[:, None] * width + np.arange(width)) * 256 + bins[rows]).ravel()
                found, where = np.unique(key, return_inverse=True)
                w = np.bincount(where, np.repeat(weight[rows], width))
                t = np.bincount(where, np.repeat(weight[rows] * target[rows], width))
                parts.append((np.full(len(found), tree), found // (256 * width), found // 256 % width, found % 256, w, t))
            if parts:
                columns = [np.concatenate(c) for c in zip(*parts)]
                symbol = pa.array([row["symbol"]]).take(pa.array(np.zeros(len(columns[0]), np.int64)))
                yield pa.RecordBatch.from_arrays(
                    [symbol, *(pa.array(c).cast(k) for c, k in zip(columns, kinds[1:]))], names)


COUNTS = "symbol string, tree int, node int, feature int, bin int, weight double, total double"


def best_splits(counts: DataFrame, min_leaf: int) -> DataFrame:
    """The split of least squared error of each node; of equals the first feature and bin."""
    key = ["symbol", "tree", "node"]
    bins = counts.groupBy(*key, "feature", "bin").agg(F.sum("weight").alias("weight"), F.sum("total").alias("total"))
    upto = Window.partitionBy(*key, "feature").orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy(*key, "feature")
    rows = bins.select(
        *key, "feature", "bin",
        F.sum("weight").over(upto).alias("n_low"), F.sum("total").over(upto).alias("low"),
        F.sum("weight").over(whole).alias("n"), F.sum("total").over(whole).alias("sum"),
    )
    high, n_high = F.col("sum") - F.col("low"), F.col("n") - F.col("n_low")
    whole_part = F.col("sum") * F.col("sum") / F.col("n")
    gain = F.try_divide(F.col("low") * F.col("low"), F.col("n_low")) + F.try_divide(high * high, n_high) - whole_part
    enough = (F.col("n_low") >= min_leaf) & (n_high >= min_leaf)
    split = rows.where(enough).withColumn("gain", gain).where(F.col("gain") > 1e-12 * whole_part)
    # Sums of the same rows in another order differ in their last digits: gains are compared in ten.
    unit = F.pow(F.lit(10.0), F.floor(F.log10("gain")) - 9)
    order = F.struct(F.rint(F.col("gain") / unit) * unit, -F.col("feature"), -F.col("bin"))
    best = split.groupBy(*key).agg(F.max_by(F.struct(
        "feature", "bin", "gain", "n", F.try_divide("low", "n_low").alias("low"), F.try_divide(high, n_high).alias("high"),
    ), order).alias("best"))
    return best.select(*key, "best.*")


def fit(
    rows: DataFrame, cols: list[str], target: str = "target", growth: Growth = Growth()
) -> DataFrame:
    """(symbol, trees): a forest per symbol of `rows` (symbol, date, columns, target).

    Rows without a symbol, a target or one of the columns are left out. A symbol whose rows allow
    no split has trees of one leaf, its mean.
    """
    if growth.bins > 256 or growth.depth > 24:
        raise ValueError("at most 256 bins and 24 levels")
    known = rows.dropna(subset=["symbol", target, *cols])
    cuts = cut(cut_points(known, cols, growth.bins), "cuts")
    packed = cut(chunks(known, cuts, cols, target, growth.seed), "chunks")
    groups = -(-growth.trees // GROUP_TREES)
    packed = packed.withColumn("group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    found = None
    for level in range(growth.depth):
        state = packed.withColumn("nodes", F.lit(None).cast("array<struct<tree:int,node:int,feature:int,bin:int>>"))
        if found is not None:
            above = found.groupBy("symbol", F.floor(F.col("tree") / GROUP_TREES).cast("int").alias("group")).agg(
                F.collect_list(F.struct("tree", "node", "feature", "bin")).alias("nodes"))
            state = packed.join(above, ["symbol", "group"])
        counted = state.mapInArrow(partial(_histograms, level=level, growth=growth), COUNTS)
        new = cut(best_splits(counted, growth.min_leaf), "splits")
        if new.isEmpty():
            break
        found = new if found is None else found.unionAll(new)
    means = packed.select("symbol", "n", "target", "draws", "group").mapInArrow(
        partial(_tree_means, growth=growth), 
        "symbol string, tree int, weight double, total double, rows double, plain double")
    # A tree that drew no row of a short series gives the series' mean.
    drawn, every = F.try_divide(F.sum("total"), F.sum("weight")), F.sum("plain") / F.sum("rows")
    means = means.groupBy("symbol", "tree").agg(F.coalesce(drawn, every).alias("mean"))
    return _flattened(means, found, cuts)


def _tree_means(batches: Iterable[pa.RecordBatch], growth: Growth) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for i in range(batch.num_rows):
            target = np.frombuffer(batch.column("target")[i].as_py(), np.float64)
            hashes = np.frombuffer(batch.column("draws")[i].as_py(), np.int64)
            first = batch.column("group")[i].as_py() * GROUP_TREES
            for tree in range(first, min(first + GROUP_TREES, growth.trees)):
                weight = draw(hashes, tree, growth.bootstrap)
                out.append((batch.column("symbol")[i].as_py(), tree, weight.sum(), weight @ target, float(len(target)), target.sum()))
        columns = list(zip(*out)) if out else [()] * 6
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, (pa.string(), pa.int32(), *[pa.float64()] * 4))],
            ["symbol", "tree", "weight", "total", "rows", "plain"])


def _flattened(means: DataFrame, found: DataFrame | None, cuts: DataFrame) -> DataFrame:
    """Splits as one row of arrays per symbol, a tree's nodes in heap order.

    Every node but the root is the child of a split, so the children of the k-th split of a tree
    are its nodes 2k + 1 and 2k + 2, counted from 0.
    """
    leaf = [F.lit(-1).alias("feature"), F.lit(None).cast("double").alias("threshold")]
    nodes = means.select("symbol", "tree", F.lit(1).alias("node"), *leaf, F.col("mean").alias("value"),
                         F.lit(0.0).alias("gain"))
    if found is not None:
        border = F.element_at(F.element_at("cuts", F.col("feature") + 1), F.col("bin") + 1)
        splits = found.join(cuts, "symbol").withColumn("threshold", border)
        own = splits.select("symbol", "tree", "node", "feature", "threshold",
                            F.lit(None).cast("double").alias("value"), "gain")
        children = F.inline(F.array(*[
            F.struct((2 * F.col("node") + side).cast("int").alias("node"), F.col(name).alias("value"))
            for side, name in ((0, "low"), (1, "high"))]))
        below = found.select("symbol", "tree", children).select(
            "symbol", "tree", "node", *leaf, "value", F.lit(0.0).alias("gain"))
        # A node that was split was a leaf one level before: the split counts, and the leaf's mean.
        nodes = own.unionAll(below).unionAll(nodes).groupBy("symbol", "tree", "node").agg(
            *[F.max(c).alias(c) for c in ("feature", "threshold", "value", "gain")])
    earlier = Window.partitionBy("symbol", "tree").orderBy("node").rowsBetween(Window.unboundedPreceding, -1)
    is_split = (F.col("feature") >= 0).cast("int")
    left = F.when(is_split == 1, 2 * F.coalesce(F.sum(is_split).over(earlier), F.lit(0)) + 1).otherwise(-1)
    nodes = nodes.withColumn("left", left.cast("int"))
    return _gathered(nodes.withColumn("right", (F.col("left") + is_split).cast("int")), "symbol")


def _gathered(nodes: DataFrame, *by: str) -> DataFrame:
    """One row per key with its `trees`, from one row per tree and node."""
    names = ("feature", "threshold", "left", "right", "value", "gain")
    listed = nodes.groupBy(*by, "tree").agg(F.array_sort(F.collect_list(F.struct("node", *names))).alias("nodes"))
    tree = F.struct(*[F.col(f"nodes.{c}").alias(c) for c in names]).cast(TREE)
    flat = listed.select(*by, "tree", tree.alias("arrays"))
    found = flat.groupBy(*by).agg(F.array_sort(F.collect_list(F.struct("tree", "arrays"))).alias("found"))
    return found.select(*by, F.col("found.arrays").alias("trees"))


def forests(model) -> list:
    """The Spark ML forests of a pipeline model, in order; a forest or tree is its own."""
    return [stage for stage in getattr(model, "stages", [model]) if hasattr(stage, "featureImportances")]


def from_ml(model, spark: SparkSession) -> DataFrame:
    """The trees of a fitted Spark ML regression forest or tree, or of all forests of a pipeline
    model, as one row of arrays.

    The model is written as Spark writes it, and its node table is read back, so no node passes
    through the driver. Nodes keep their numbers, which begin with 0 at the root.
    """
    found, trees = None, 0
    for forest in forests(model):
        path = scratch_path(spark, "forest")
        forest.write().save(path)
        data = spark.read.parquet(f"{path}/data")
        node = F.col("nodeData") if "nodeData" in data.columns else F.struct("*")
        tree = F.col("treeID") if "treeID" in data.columns else F.lit(0)
        rows = data.select((tree + trees).alias("tree"), node.alias("n"))
        found, trees = rows if found is None else found.unionByName(rows), trees + getattr(forest, "getNumTrees", 1)
    return _gathered(found.select(
        "tree", F.col("n.id").alias("node"), F.col("n.split.featureIndex").alias("feature"),
        F.get("n.split.leftCategoriesOrThreshold", F.lit(0)).alias("threshold"),
        F.col("n.leftChild").alias("left"), F.col("n.rightChild").alias("right"),
        F.col("n.prediction").alias("value"), F.col("n.gain").alias("gain")))


# --- use ---------------------------------------------------------------------------------------


def walked(trees: Column, values: Column, depth: int) -> Column:
    """The mean over trees of the leaf that `values`, an array in column order, falls into.

    A plain expression, for use inside `aggregate` and for few rows per symbol.
    """

    def leaf(tree: Column) -> Column:
        def step(at: Column, _: Column) -> Column:
            value = F.element_at(values, F.greatest(F.element_at(tree["feature"], at + 1), F.lit(0)) + 1)
            return F.when(F.element_at(tree["feature"], at + 1) < 0, at).when(
                value <= F.element_at(tree["threshold"], at + 1), F.element_at(tree["left"], at + 1)
            ).otherwise(F.element_at(tree["right"], at + 1))

        return F.element_at(tree["value"], F.aggregate(F.sequence(F.lit(1), F.lit(depth)), F.lit(0), step) + 1)

    total = F.aggregate(trees, F.lit(0.0), lambda a, tree: a + leaf(tree))
    return total / F.size(trees)


def _predict(batches: Iterable[pa.RecordBatch], names: list[str]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(batch.num_rows):
            rows = batch.column("rows")[i].as_py()
            values = np.array([r["values"] for r in rows], np.float64)
            total, count = np.zeros(len(rows)), 0
            for tree in batch.column("trees")[i].as_py():
                feature, left, right = (np.array(tree[c]) for c in ("feature", "left", "right"))
                threshold, value = np.array(tree["threshold"], float), np.array(tree["value"], float)
                at = np.zeros(len(rows), np.int64)
                while (feature[at] >= 0).any():
                    f = feature[at]
                    low = values[np.arange(len(rows)), f] <= threshold[at]
                    at = np.where(f < 0, at, np.where(low, left[at], right[at]))
                total, count = total + value[at], count + 1
            yield pa.RecordBatch.from_arrays(
                [pa.array([batch.column("symbol")[i].as_py()] * len(rows), pa.string()),
                 pa.array([r["date"] for r in rows], pa.date32()), pa.array(total / count)], names)


def predict(forests: DataFrame, rows: DataFrame, cols: list[str], out: str = "predicted") -> DataFrame:
    """(symbol, date, `out`) of `rows`, by chunks of a symbol's rows, each beside its forest."""
    known = rows.dropna(subset=["symbol", *cols])
    many = known.groupBy("symbol").agg(F.ceil(F.count("*") / CHUNK_ROWS).alias("chunks"))
    item = F.struct("date", F.array(*[F.col(c).cast("double") for c in cols]).alias("values"))
    packed = known.join(many, "symbol").groupBy(
        "symbol", F.pmod(F.xxhash64("symbol", "date"), "chunks").alias("chunk")).agg(F.collect_list(item).alias("rows"))
    names = ["symbol", "date", out]
    return packed.drop("chunk").join(forests, "symbol").mapInArrow(
        partial(_predict, names=names), f"symbol string, date date, `{out}` double")


def importance(forests: DataFrame, cols: list[str]) -> DataFrame:
    """(symbol, feature, importance): each column's share of what the splits gain, as the mean over
    trees; a forest without a split gives 0."""
    tree = F.explode("trees").alias("tree")
    shares = forests.select("symbol", tree)
    total = F.aggregate("tree.gain", F.lit(0.0), lambda a, b: a + b)

    def gained(column: int) -> Column:
        own = F.zip_with("tree.feature", "tree.gain", lambda f, g: F.when(f == column, g).otherwise(0.0))
        return F.aggregate(own, F.lit(0.0), lambda a, b: a + b)

    rows = shares.select("symbol", *[
        F.when(total > 0, F.try_divide(gained(i), total)).otherwise(0.0).alias(c) for i, c in enumerate(cols)])
    means = rows.groupBy("symbol").agg(*[F.avg(c).alias(c) for c in cols])
    whole = sum((F.col(c) for c in cols[1:]), F.col(cols[0]))
    parts = [F.struct(F.lit(c).alias("feature"), F.coalesce(F.try_divide(c, whole), F.lit(0.0)).alias("importance"))
             for c in cols]
    return means.select("symbol", F.inline(F.array(*parts)))


def permutation_importance(
    forests: DataFrame, rows: DataFrame, cols: list[str], target: str = "target", depth: int = 15, seed: int = 42,
    part_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """(symbol, feature, importance): by how much the mean squared error grows when a column's values
    are dealt to other rows of the symbol.

    Rows are dealt by a hash into parts of about `part_rows`; inside a part each row takes the value
    of the row before it in the order of the hash, the first one that of the last. One window serves
    all columns, and one pass gives all errors. A column that does not vary has importance 0.
    """
    known = rows.dropna(subset=["symbol", target, *cols])
    many = known.groupBy("symbol").agg(F.ceil(F.count("*") / part_rows).alias("_parts"))
    key = F.md5(F.concat_ws("|", "symbol", F.date_format("date", "yyyy-MM-dd"), F.lit(seed)))
    dealt = known.join(many, "symbol").withColumn("_key", key)
    dealt = dealt.withColumn("_part", F.pmod(F.xxhash64("_key"), "_parts"))
    order = Window.partitionBy("symbol", "_part").orderBy("_key")
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    other = {c: F.coalesce(F.lag(c).over(order), F.last(c).over(whole)).alias(f"_{i}") for i, c in enumerate(cols)}
    beside = dealt.select("symbol", F.col(target).alias("_y"), *[F.col(c).cast("double").alias(c) for c in cols],
                          *[o.cast("double").alias(f"_{i}") for i, o in enumerate(other.values())])
    beside = beside.join(forests, "symbol")

    def error(changed: int | None) -> Column:
        values = F.array(*[F.col(f"_{i}") if i == changed else F.col(c) for i, c in enumerate(cols)])
        miss = F.col("_y") - walked(F.col("trees"), values, depth)
        return miss * miss

    errors = beside.groupBy("symbol").agg(
        F.avg(error(None)).alias("_base"), *[F.avg(error(i)).alias(f"_{i}") for i in range(len(cols))])
    parts = [F.struct(F.lit(c).alias("feature"), (F.col(f"_{i}") - F.col("_base")).alias("importance"))
             for i, c in enumerate(cols)]
    return errors.select("symbol", F.inline(F.array(*parts)))
