"""Forecasts: checkable baselines, the tree model, and the sequence model."""

from __future__ import annotations

import logging
import math
from collections.abc import Callable
from multiprocessing.pool import ThreadPool

from py4j.protocol import Py4JError
from pyspark import inheritable_thread_target
from pyspark.errors import PySparkException
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import LinearRegression, LinearRegressionModel, RandomForestRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.functions import columns as C
from barloom.functions import indicators as I
from barloom.operators import features, metrics, quantile, scale, split, trees
from barloom.operators.series import LENGTH, POSITION, measure
from barloom.session import cut

log = logging.getLogger(__name__)

BASELINES = ("last_close", "sma_5", "sma_20", "sma_60")
TEST_ROWS, TRAIN_ROWS, WINDOW_ROWS = 30, 420, 120
# Rows of the pooled forest in one task, trees grown by one fit, and fits that run at a time.
FOREST_ROWS, FOREST_TREES, FOREST_FITS = 1 << 16, 50, 4


def _span(name: str) -> int:
    return 1 if name == "last_close" else int(name.removeprefix("sma_"))


# --- baselines ---------------------------------------------------------------------------------


def next_day_baseline(df: DataFrame, n: int = 5, calendar: str = "day") -> DataFrame:
    """The mean of the newest n closes as the prediction for the day after the newest bar."""
    rows = split.tail(df.select("symbol", "date", "close"), 0, n)
    return rows.groupBy("symbol").agg(
        F.max("date").alias("_last"),
        F.max_by("close", "date").alias("current_close"),
        F.when(F.count("close") == n, F.avg("close")).alias("predicted_close"),
    ).select(
        "symbol",
        C.next_date("_last", calendar).alias("prediction_date"),
        "current_close",
        "predicted_close",
    )


def walk_forward_baseline(
    df: DataFrame, names: tuple[str, ...] = BASELINES, test: int = TEST_ROWS
) -> DataFrame:
    """One-step predictions for the last rows of each series, from the true rows before each."""
    longest = max(_span(name) for name in names)
    rows = split.tail(df.select("symbol", "date", "close"), test, longest)
    guesses = measure(rows, *[I.trailing_mean("close", _span(name), name) for name in names])
    pairs = [F.struct(F.lit(n).alias("feature_set"), F.col(n).alias("predicted")) for n in names]
    return (
        guesses.where(F.col("part") == "test")
        .select("symbol", "date", F.col("close").alias("actual"), F.inline(F.array(*pairs)))
        .where(F.col("predicted").isNotNull())
    )


def rank_baselines(df: DataFrame, names: tuple[str, ...] = BASELINES, runs: int = 3) -> DataFrame:
    """Baselines by mean MAPE over runs; run r leaves out the test rows that its hash picks.

    Baselines are not fitted, so their runs differ in the rows they are judged on.
    """
    rows = walk_forward_baseline(df, names)
    run = F.explode(F.sequence(F.lit(1), F.lit(runs)))
    picked = F.pmod(_hash("symbol", C.day_text("date")), F.lit(runs)) + 1
    return metrics.rank(rows.withColumn("run", run).where(picked != F.col("run")))


def predicted_band(
    df: DataFrame, n: int = 5, coverage: float = 0.9, test: int = TEST_ROWS
) -> DataFrame:
    """The next day's predicted close, high and low, and how often such a band held.

    The close is the mean of the newest n closes. High and low lie where days lay relative to such
    a mean before: at the exact quantiles (1 + coverage) / 2 of the highs' and (1 - coverage) / 2 of
    the lows' distance, over all days but the last `test` ones. `held` is the share of these whose
    high and low lay within the band around their own mean.
    """
    rows = measure(df, I.trailing_mean("close", n, "predicted"), keep_position=True)
    rows = cut(rows.where(F.col("predicted").isNotNull()).select(
        "symbol", (F.col(POSITION) >= F.col(LENGTH) - test).alias("tested"),
        (F.col("high") - F.col("predicted")).alias("above"), (F.col("low") - F.col("predicted")).alias("below"),
    ), "distances")
    known = rows.where(~F.col("tested"))
    upper = quantile.exact(known, "above", [(1 + coverage) / 2]).withColumnRenamed("q0", "upper")
    lower = quantile.exact(known, "below", [(1 - coverage) / 2]).withColumnRenamed("q0", "lower")
    band = upper.join(lower, "symbol")
    inside = ((F.col("above") <= F.col("upper")) & (F.col("below") >= F.col("lower"))).cast("double")
    held = rows.where("tested").join(band, "symbol").groupBy("symbol").agg(
        F.avg(inside).alias("held"), F.count("*").alias("n"))
    out = next_day_baseline(df, n).where(F.col("predicted_close").isNotNull()).join(band, "symbol").join(held, "symbol")
    return out.select(
        "symbol", "prediction_date", "predicted_close",
        (F.col("predicted_close") + F.col("lower")).alias("predicted_low"),
        (F.col("predicted_close") + F.col("upper")).alias("predicted_high"), "held", "n")


def _hash(*parts) -> Column:
    """28 bits of the MD5 of some values, the same on every engine and cluster."""
    return F.conv(F.substring(F.md5(F.concat_ws("|", *parts)), 1, 7), 16, 10).cast("long")


def _tail_rows(df: DataFrame, test: int, before: int, item: Column) -> DataFrame:
    """Per symbol the arrays `_before` and `_test`; their lengths are the two arguments."""
    rows = split.tail(df, test, before)
    parts = [
        F.array_sort(F.collect_list(F.when(F.col("part") == p, item))).alias(name)
        for p, name in (("train", "_before"), ("test", "_test"))
    ]
    return rows.groupBy("symbol").agg(*parts)


def recursive_baseline(df: DataFrame, n: int = 5, test: int = TEST_ROWS) -> DataFrame:
    """Moving-mean forecast of the last rows in which each prediction feeds the next one."""
    item = F.struct("date", "close")
    rows = _tail_rows(df.select("symbol", "date", "close"), test, n, item)
    known = F.transform("_before", lambda r: r["close"])

    def step(seen: Column, _: Column) -> Column:
        newest = F.slice(seen, -n, n)
        total = F.aggregate(newest, F.lit(0.0), lambda a, b: a + b)
        return F.concat(seen, F.array(total / n))

    return (
        rows.where(F.size("_before") == n)
        .withColumn("_seen", F.aggregate("_test", known, step))
        .withColumn("_guess", F.slice("_seen", F.lit(n + 1), F.size("_test")))
        .select("symbol", F.inline(F.arrays_zip("_test", "_guess")))
        .select(
            "symbol",
            F.col("_test.date").alias("date"),
            F.col("_test.close").alias("actual"),
            F.col("_guess").alias("predicted"),
        )
    )


# --- tree model --------------------------------------------------------------------------------


def _z(cols: list[str]) -> list[str]:
    return [f"{c}_z" for c in cols]


def supervised(bars: DataFrame, cols: list[str], gaps: bool = False) -> DataFrame:
    """Features and the next close in one pass; the newest rows have no target."""
    return features.supervised(bars, cols, gaps)


def holdout(rows: DataFrame, share: float = 0.2, seed: int = 42) -> DataFrame:
    """Features at t with the close of t + 1 as `target`, and an exact random hold-out."""
    if "target" not in rows.columns:
        rows = features.target(rows, "close", 1)
    return split.random(rows.where(F.col("target").isNotNull()), share, seed)


def fit_scalers(samples: DataFrame, cols: list[str]) -> DataFrame:
    return scale.fit_standard(samples.where(F.col("part") == "train"), [*cols, "target"])


def scaled_samples(samples: DataFrame, params: DataFrame, cols: list[str]) -> DataFrame:
    """Samples with their scaled columns beside them, under the suffix `_z`."""
    return scale.apply(samples, params, [*cols, "target"], suffix="_z")


def fit_forest(
    train: DataFrame,
    cols: list[str],
    trees: int = 200,
    depth: int = 15,
    min_leaf: int = 2,
    seed: int = 42,
    bootstrap: bool = True,
) -> PipelineModel:
    """One forest over scaled rows of all given symbols; pass one symbol's rows for its own.

    Every task of a fit counts all open nodes, however few rows it has, so the number of tasks
    follows from the number of rows, not from the files they lie in; rows are dealt and ordered by
    their values, and the trees depend on nothing else. Trees are grown by several fits at a time,
    and their forests are stages of the model, with the mean of all trees behind them.
    """
    inputs = list(dict.fromkeys([*_z(cols), "target_z"]))
    tasks = max(1, math.ceil(train.count() / FOREST_ROWS))
    vector = VectorAssembler(inputCols=_z(cols), outputCol="features")
    dealt = train.select(*inputs).repartition(tasks, *inputs).sortWithinPartitions(*inputs)
    dealt = vector.transform(dealt).persist()
    firsts = range(0, trees, FOREST_TREES)
    names = ["predicted"] if len(firsts) == 1 else [f"_predicted_{first}" for first in firsts]
    sizes = [min(FOREST_TREES, trees - first) for first in firsts]

    def fit(name: str, size: int, first: int):
        # Spark draws by seed and number of partition: seeds lie further apart than these go.
        forest = RandomForestRegressor(
            featuresCol="features",
            labelCol="target_z",
            predictionCol=name,
            numTrees=size,
            maxDepth=depth,
            minInstancesPerNode=min_leaf,
            featureSubsetStrategy="all",
            maxBins=256,
            bootstrap=bootstrap,
            seed=seed + first * 1_000_003,
        )
        return forest.fit(dealt)

    try:
        with ThreadPool(min(FOREST_FITS, len(names))) as pool:
            forests = pool.starmap(inheritable_thread_target(train.sparkSession)(fit), zip(names, sizes, firsts), 1)
    finally:
        dealt.unpersist()
    if len(forests) == 1:
        return PipelineModel([vector, *forests])
    total = " + ".join(f"{name} * {size}" for name, size in zip(names, sizes))
    mean = f"SELECT * EXCEPT ({', '.join(names)}), ({total}) / {trees} AS predicted FROM __THIS__"
    return PipelineModel([vector, *forests, SQLTransformer(statement=mean)])


def importance(model: PipelineModel, cols: list[str]) -> dict[str, float]:
    """Each column's share of what the splits gain; forests of a model count by their trees."""
    total = sum(f.featureImportances.toArray() * f.getNumTrees for f in trees.forests(model))
    return dict(zip(cols, (total / (total.sum() or 1.0)).tolist(), strict=True))


def importance_map(model: PipelineModel, cols: list[str]) -> Column:
    pairs = importance(model, cols)
    return F.map_from_arrays(F.lit(list(pairs)), F.lit(list(pairs.values())))


def predict_scaled(
    model: PipelineModel, scaled: DataFrame, params: DataFrame, cols: list[str]
) -> DataFrame:
    """Add `predicted`, in original units, to rows that hold their scaled columns."""
    guessed = model.transform(scaled).drop("features", *_z(cols))
    return scale.invert(guessed, params, "predicted", of="target")


def next_day(
    model: PipelineModel, rows: DataFrame, params: DataFrame, cols: list[str], calendar: str = "day"
) -> DataFrame:
    """The prediction from the newest feature row of each symbol."""
    newest = features.latest(rows.select("symbol", "date", *dict.fromkeys(["close", *cols])))
    scaled = scale.apply(newest, params, cols, suffix="_z")
    return predict_scaled(model, scaled, params, cols).select(
        "symbol",
        C.next_date("date", calendar).alias("prediction_date"),
        F.col("close").alias("current_close"),
        F.col("predicted").alias("predicted_close"),
    )


# --- sequence model ----------------------------------------------------------------------------


def study_rows(
    df: DataFrame, cols: list[str], test: int = TEST_ROWS, train: int = TRAIN_ROWS
) -> DataFrame:
    """The tail of each series with its part; the close is always among the columns."""
    names = list(dict.fromkeys([*cols, "close"]))
    return split.tail(df.select("symbol", "date", *names), test, train)


def fit_study_scalers(rows: DataFrame, cols: list[str]) -> DataFrame:
    names = list(dict.fromkeys([*cols, "close"]))
    return scale.fit_minmax(rows.where(F.col("part") == "train"), names)


def sequence_samples(
    rows: DataFrame, params: DataFrame, cols: list[str], length: int = WINDOW_ROWS
) -> DataFrame:
    """Scaled windows of the rows before each row, its scaled close, and its part.

    A test row's window holds the true rows before it and never the row itself.
    """
    names = list(dict.fromkeys([*cols, "close"]))
    scaled = scale.apply(rows, params, names)
    return (
        measure(scaled, I.windows(cols, length, "x"))
        .where(F.col("x").isNotNull())
        .select("symbol", "date", "part", "x", F.col("close").alias("y"))
    )


def fit_sequence(
    samples: DataFrame, penalty: float = 0.01, weight: str | None = None
) -> LinearRegressionModel:
    """Ridge regression on the flattened windows of the train part."""
    kept = ["y"] if weight is None else ["y", weight]
    rows = samples.where(F.col("part") == "train").select(
        array_to_vector(F.flatten("x")).alias("features"), *kept
    )
    ridge = LinearRegression(labelCol="y", regParam=penalty, standardization=False)
    return (ridge if weight is None else ridge.setWeightCol(weight)).fit(rows)


def fit_final_sequence(
    rows: DataFrame, cols: list[str], length: int = WINDOW_ROWS
) -> tuple[LinearRegressionModel, DataFrame]:
    """The model, and its scalers, for use: fitted on every row of every series."""
    every = rows.select("symbol", "date", *dict.fromkeys([*cols, "close"])).withColumn(
        "part", F.lit("train")
    )
    params = cut(fit_study_scalers(every, cols), "scalers")
    return fit_sequence(cut(sequence_samples(every, params, cols, length), "samples")), params


def predict_sequence(
    model: LinearRegressionModel, samples: DataFrame, params: DataFrame
) -> DataFrame:
    """Predictions and actual closes in original units."""
    rows = samples.withColumn("features", array_to_vector(F.flatten("x")))
    guessed = model.setPredictionCol("predicted").transform(rows).drop("features", "x")
    joined = guessed.join(params, "symbol")
    return joined.select(
        "symbol",
        "date",
        "part",
        scale.unscaled("y", "close").alias("actual"),
        scale.unscaled("predicted", "close").alias("predicted"),
    )


def walk_forward(
    model: LinearRegressionModel, samples: DataFrame, params: DataFrame
) -> DataFrame:
    """One-step predictions of the test rows with true history."""
    return predict_sequence(model, samples.where(F.col("part") == "test"), params).drop("part")


def recursive(
    model: LinearRegressionModel,
    rows: DataFrame,
    params: DataFrame,
    cols: list[str],
    length: int = WINDOW_ROWS,
    test: int = TEST_ROWS,
) -> DataFrame:
    """Forecast the test rows, feeding each predicted close into the next window.

    The other features take their true values. State per symbol is one window of `length` rows
    and the `test` rows, whatever the length of the series.
    """
    weights, bias = F.lit(model.coefficients.toArray().tolist()), F.lit(float(model.intercept))
    return recursive_by(_dot(weights, bias), rows, params, cols, length, test)


def _dot(weights: Column, bias: Column) -> Callable[[Column], Column]:
    """A linear model of the flattened window."""

    def guess(values: Column) -> Column:
        products = F.zip_with(values, weights, lambda a, b: a * b)
        return F.aggregate(products, bias, lambda a, b: a + b)

    return guess


def recursive_ridge(
    models: DataFrame, rows: DataFrame, params: DataFrame, cols: list[str],
    length: int = WINDOW_ROWS, test: int = TEST_ROWS,
) -> DataFrame:
    """`recursive` with a linear model per symbol: (symbol, weights, bias)."""
    guess = _dot(F.col("weights"), F.col("bias"))
    return recursive_by(guess, rows, params, cols, length, test, models.select("symbol", "weights", "bias"))


def recursive_trees(
    forests: DataFrame, rows: DataFrame, params: DataFrame, cols: list[str], depth: int,
    length: int = WINDOW_ROWS, test: int = TEST_ROWS,
) -> DataFrame:
    """`recursive` with trees as arrays: (symbol, trees) for a forest per symbol, or one row (trees)
    for a forest of all. The trees, at most `depth` deep, are walked inside the fold over the test
    rows; their columns are those of the flattened window, oldest row first."""
    if "symbol" not in forests.columns:
        forests = rows.select("symbol").distinct().withColumn("_all", F.lit(1)).join(
            forests.withColumn("_all", F.lit(1)), "_all").drop("_all")
    return recursive_by(lambda values: trees.walked(F.col("trees"), values, depth),
                        rows, params, cols, length, test, forests.select("symbol", "trees"))


def recursive_by(
    model: Callable[[Column], Column],
    rows: DataFrame,
    params: DataFrame,
    cols: list[str],
    length: int = WINDOW_ROWS,
    test: int = TEST_ROWS,
    beside: DataFrame | None = None,
) -> DataFrame:
    """`recursive` with any model that is an expression of the flattened window.

    `beside` has one row per symbol with the columns that the expression uses; symbols without
    one are left out.
    """
    names = list(dict.fromkeys([*cols, "close"]))
    scaled = scale.apply(rows, params, names)
    item = F.struct("date", F.array(*cols).alias("v"), F.col("close").alias("y"))
    parts = _tail_rows(scaled.drop("part"), test, length, item).where(F.size("_before") == length)
    if beside is not None:
        parts = parts.join(beside, "symbol")
    fed_back = [F.lit(name == "close") for name in cols]

    def step(state: Column, row: Column) -> Column:
        value = model(F.flatten(state["window"]))
        mixed = F.zip_with(
            row["v"], F.array(*fed_back), lambda v, own: F.when(own, value).otherwise(v)
        )
        window = F.concat(F.slice(state["window"], 2, length - 1), F.array(mixed))
        guesses = F.concat(state["guesses"], F.array(value))
        return F.struct(window.alias("window"), guesses.alias("guesses"))

    start = F.struct(
        F.transform("_before", lambda r: r["v"]).alias("window"),
        F.array().cast("array<double>").alias("guesses"),
    )
    guessed = parts.withColumn("_guess", F.aggregate("_test", start, step)["guesses"])
    pairs = guessed.select("symbol", F.inline(F.arrays_zip("_test", "_guess"))).select(
        "symbol",
        F.col("_test.date").alias("date"),
        F.col("_test.y").alias("actual"),
        F.col("_guess").alias("predicted"),
    )
    return pairs.join(params, "symbol").select(
        "symbol",
        "date",
        scale.unscaled("actual", "close").alias("actual"),
        scale.unscaled("predicted", "close").alias("predicted"),
    )


def compare_feature_sets(
    df: DataFrame,
    sets: dict[str, list[str]],
    runs: int = 3,
    length: int = WINDOW_ROWS,
    test: int = TEST_ROWS,
    train: int = TRAIN_ROWS,
    seed: int = 42,
) -> DataFrame:
    """Mean test MAPE per feature set over runs that differ in the bootstrap of their samples.

    A run that fails is logged, skipped and counted; a set without a finished run is left out.
    """
    long = None
    for name, wanted in sets.items():
        missing = set(wanted) - set(df.columns)
        if missing:
            raise ValueError(f"feature set {name} lacks the columns {sorted(missing)}")
        rows = cut(study_rows(df, wanted, test, train), "study")
        params = fit_study_scalers(rows, wanted)
        samples = cut(sequence_samples(rows, params, wanted, length), "samples")
        for run in range(1, runs + 1):
            try:
                model = fit_sequence(bootstrap(samples, seed + run), weight="_times")
            except (PySparkException, Py4JError) as error:
                log.warning("run %d of feature set %s failed: %s", run, name, error)
                continue
            part = walk_forward(model, samples, params).select(
                "*", F.lit(name).alias("feature_set"), F.lit(run).alias("run")
            )
            long = part if long is None else long.unionByName(part)
    if long is None:
        raise ValueError("no run of any feature set succeeded")
    ranked = metrics.rank(long)
    return ranked.withColumn("failed", F.lit(runs) - F.col("runs"))


def bootstrap(samples: DataFrame, seed: int) -> DataFrame:
    """`samples` with `_times`, how often each is drawn; those drawn never are left out.

    Counts follow a Poisson distribution of mean 1 by a hash of symbol, date and seed, so a draw
    does not depend on how rows are spread over tasks.
    """
    share = _hash("symbol", C.day_text("date"), F.lit(seed)) / F.lit(1 << 28)
    times, reached, chance = F.lit(0), 0.0, math.exp(-1)
    for count in range(1, 9):
        reached += chance
        chance /= count
        times = times + (share >= reached).cast("int")
    return samples.withColumn("_times", times.cast("double")).where(F.col("_times") > 0)
