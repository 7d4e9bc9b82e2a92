"""The four chains: ingest, train, predict, study."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.regression import LinearRegressionModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.functions import columns as C
from barloom.operators import clean, features, forecast, merge, metrics, reporting, trees
from barloom.schemas import BARS
from barloom.sources import models, readers, writers
from barloom.session import cut, size_exchanges


def ingest(
    spark: SparkSession, landing: str, store: str, rejects: str | None = None, glob: str = "*.json"
) -> DataFrame:
    """Landed files into the store: new dates only, bad records set aside. Returns what was new.

    The store keeps a ledger of the files it has taken, by place, time and length. Only files that
    are new or written again are opened, once each; when there are none, no file is. Rejects lie
    in one folder per batch, and an interrupted batch is taken again as a whole: its rejects are
    removed by the next ingest, and its bars, marks and ledger entries reach the store together.
    """
    landed = cut(readers.landed_files(spark, landing, glob), "landed")
    files = cut(writers.unseen(landed, store), "files")
    count, first, last = files.agg(F.count("*"), F.min("modified"), F.max("modified")).first()
    if not count:
        return spark.createDataFrame([], BARS)
    records = readers.read_records(spark, landing, glob, modified=(first, last))
    size_exchanges(records)
    if landed.where(F.col("modified").between(F.lit(first), F.lit(last))).count() > count:
        # Some files of that time were taken before: read beside the new ones, and dropped here.
        records = records.join(files.select(F.col("file").alias("_file")), "_file", "left_semi")
    marked = cut(clean.mark_records(readers.symbol_from_path(records)), "marked")
    good, bad = clean.parted(marked)
    batch = writers.begin_batch(spark, store, rejects)
    if rejects and not bad.isEmpty():
        bad.drop("_start", "_seq").write.json(f"{rejects.rstrip('/')}/{writers.BATCH}={batch}")
    unique = merge.combine(good, readers.FILE_ORDER)
    new = cut(merge.new_rows(unique, writers.read_marks(spark, store)), "ingest")
    writers.upsert_months(new, store, landed=files, batch=batch)
    writers.end_batch(spark, store, batch)
    return new


def merge_store(spark: SparkSession, store: str, combined: str) -> None:
    """The whole store as one combined, ordered series per symbol."""
    rows = writers.read_months(spark, store).drop(writers.MONTH)
    size_exchanges(rows)
    writers.write_combined(merge.combine(rows, []), combined)


@dataclass(frozen=True)
class Trained:
    model: PipelineModel
    params: DataFrame
    metrics: DataFrame
    next_day: DataFrame
    importance: dict[str, float]


def train(
    bars: DataFrame,
    feature_set: str = "rf",
    trees: int = 200,
    depth: int = 15,
    share: float = 0.2,
    seed: int = 42,
    gaps: bool = False,
) -> Trained:
    """Features, hold-out, scaling, forest, errors and the next-day prediction.

    Rows are scaled per symbol and one forest learns from all of them, in one distributed fit.
    Pass one symbol's bars for a model of its own.
    """
    cols = features.FEATURE_SETS[feature_set]
    size_exchanges(bars)
    rows = cut(forecast.supervised(bars, cols, gaps), "features")
    if rows.isEmpty():
        raise ValueError("no bars to train on")
    samples = cut(forecast.holdout(rows, share, seed), "holdout")
    params = cut(forecast.fit_scalers(samples, cols), "scalers")
    scaled = cut(forecast.scaled_samples(samples, params, cols), "scaled")
    model = forecast.fit_forest(
        scaled.where(F.col("part") == "train"), cols, trees=trees, depth=depth, seed=seed
    )
    tested = forecast.predict_scaled(model, scaled.where(F.col("part") == "test"), params, cols)
    return Trained(
        model,
        params,
        metrics.evaluate(tested, actual="target"),
        forecast.next_day(model, rows, params, cols),
        forecast.importance(model, cols),
    )


@dataclass(frozen=True)
class TrainedEach:
    forests: DataFrame
    metrics: DataFrame
    next_day: DataFrame
    importance: DataFrame


def train_each(
    bars: DataFrame,
    feature_set: str = "rf",
    growth: trees.Growth = trees.Growth(),
    share: float = 0.2,
    seed: int = 42,
    gaps: bool = False,
) -> TrainedEach:
    """Features, hold-out, a forest of its own for every symbol, errors and the next-day predictions.

    All forests grow together, level by level, and none is looped over. Columns are not scaled:
    splits of a tree do not depend on it.
    """
    cols = features.FEATURE_SETS[feature_set]
    size_exchanges(bars)
    rows = cut(forecast.supervised(bars, cols, gaps), "features")
    if rows.isEmpty():
        raise ValueError("no bars to train on")
    samples = cut(forecast.holdout(rows, share, seed), "holdout")
    forests = cut(trees.fit(samples.where(F.col("part") == "train"), cols, growth=growth), "forests")
    tested = samples.where(F.col("part") == "test")
    guessed = tested.join(trees.predict(forests, tested, cols), ["symbol", "date"])
    newest = features.latest(rows.select("symbol", "date", *dict.fromkeys(["close", *cols])))
    next_day = trees.predict(forests, newest, cols, "predicted_close").join(
        newest.select("symbol", F.col("close").alias("current_close")), "symbol")
    return TrainedEach(
        forests,
        metrics.evaluate(guessed, actual="target"),
        next_day.select("symbol", C.next_date("date", "day").alias("prediction_date"), "current_close", "predicted_close"),
        trees.importance(forests, cols),
    )


def publish(trained: Trained, root: str, ticker: str, feature_set: str, created: str) -> DataFrame:
    """Save model, scalers, metadata and the result document."""
    cols = features.FEATURE_SETS[feature_set]
    models.save(trained.model, trained.params, root, ticker, feature_set, cols, created)
    importance = forecast.importance_map(trained.model, cols)
    document = reporting.result_document(trained.metrics, trained.next_day, created, importance)
    return writers.write_result(document, f"{root}/latest_results", f"{root}/results")


def predict(
    bars: DataFrame,
    model: PipelineModel,
    params: DataFrame,
    as_of,
    stamp,
    feature_set: str = "rf",
    days: int = 90,
) -> DataFrame:
    """Responses with prediction, current close and recent history per symbol."""
    cols = features.FEATURE_SETS[feature_set]
    rows = features.serving(bars, as_of, days)
    guessed = forecast.next_day(model, rows, params, cols).drop("current_close")
    return reporting.prediction_response(bars, guessed, as_of, stamp, days)


@dataclass(frozen=True)
class Study:
    ranking: DataFrame
    best: str
    report: DataFrame
    model: LinearRegressionModel
    params: DataFrame


def study(
    bars: DataFrame, sets: tuple[str, ...] = ("base", "base_tech"), runs: int = 3, best: str | None = None
) -> Study:
    """Rank feature sets, report the recursive forecast of one of them, and fit its final model.

    The set ranked first for most symbols is used unless `best` names another. The report is on
    rows its model has not seen; the final model is fitted on all rows.
    """
    size_exchanges(bars)
    rows = cut(features.indicators(bars), "indicators")
    if rows.isEmpty():
        raise ValueError("no bars to study")
    ranking = cut(
        forecast.compare_feature_sets(rows, {n: features.FEATURE_SETS[n] for n in sets}, runs),
        "ranking",
    )
    if best is None:
        winners = ranking.where(F.col("place") == 1).groupBy("feature_set").count()
        best = winners.orderBy(F.desc("count"), "feature_set").first()["feature_set"]
    cols = features.FEATURE_SETS[best]
    tail = cut(forecast.study_rows(rows, cols), "study")
    tail_params = forecast.fit_study_scalers(tail, cols)
    trial = forecast.fit_sequence(cut(forecast.sequence_samples(tail, tail_params, cols), "samples"))
    report = metrics.report(forecast.recursive(trial, tail, tail_params, cols))
    return Study(ranking, best, report, *forecast.fit_final_sequence(rows, cols))
