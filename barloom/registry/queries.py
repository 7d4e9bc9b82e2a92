"""Queries over the given tables, one per operator. Oracle SQL is in `oracle.py`.

Doubles are rounded to four digits: two engines add them up in different orders. The rounding is
spelled out with `floor` on both sides, and a hair above one half sends exact halves one way.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from barloom.functions import columns as C
from barloom.functions import indicators as I
from barloom.operators import (
    alerts, clean, features, forecast, merge, metrics, reporting, ridge, scale, split, trees,
)
from barloom.operators.series import measure
from barloom.plans import daily
from barloom.schemas import ALERT, ENVELOPE, MESSAGES, OHLCV, RESULT, TICKS
from barloom.session import cut, scratch_path
from barloom.sources import models, readers, tables, writers
from barloom.streaming import alerts as alert_stream
from barloom.streaming import bars as intraday
from barloom.streaming import changing, topics

# The day the queries are run "as of" and the stamp they carry.
AS_OF, STAMP = "2001-11-05", "2024-01-31 12:00:00"
# The split between stored and incoming bars; ten days of overlap follow it.
STORED_UNTIL, INCOMING_FROM = "2000-06-30", "2000-06-21"
LANDED_UNTIL = "1998-05-15"


def r4(c: str | Column, name: str | None = None) -> Column:
    column = F.col(c) if isinstance(c, str) else c
    return (F.floor(column * 10000 + 0.50001) / 10000).alias(name or c)


def tidy(df: DataFrame) -> DataFrame:
    """Round every double column."""
    return df.select(*[r4(n) if t == "double" else F.col(n) for n, t in df.dtypes])


def stored(spark: SparkSession, sf: str) -> DataFrame:
    """The bars as a written table, the form in which every chain meets them."""
    return cut(tables.bars(spark, sf), "bars")


def measured(*indicators):
    def query(spark: SparkSession, sf: str) -> DataFrame:
        out = measure(stored(spark, sf), *indicators)
        return tidy(out.select("symbol", "date", *[n for i in indicators for n in i.outputs]))

    return query


# --- sources and sinks -------------------------------------------------------------------------


def bars(spark, sf):
    return tidy(tables.bars(spark, sf))


def range_90d(spark, sf):
    return tidy(readers.lookback(stored(spark, sf), AS_OF, 90))


def monthly_json(spark, sf):
    path = scratch_path(spark, "monthly")
    writers.publish_months(tables.bars(spark, sf), path)
    good, _ = clean.bars(readers.symbol_from_path(readers.read_records(spark, path)))
    return tidy(good.select("symbol", "date", *OHLCV))


def jsonl_roundtrip(spark, sf):
    path = scratch_path(spark, "combined")
    writers.write_combined(tables.bars(spark, sf), path)
    return tidy(readers.read_combined(spark, path))


def csv_roundtrip(spark, sf):
    path = scratch_path(spark, "csv")
    writers.write_csv(tables.bars(spark, sf).select("symbol", "date", *OHLCV), path)
    return tidy(readers.read_bars(spark, path, "csv"))


def ticker_from_path(spark, sf):
    path = scratch_path(spark, "split")
    named = tables.bars(spark, sf).withColumn("symbol", F.concat(F.lit("^"), "symbol"))
    writers.split_months(named, path)
    rows = readers.symbol_from_path(readers.read_records(spark, path))
    return tidy(rows.groupBy("symbol").agg(
        F.count("*").alias("bars"), F.sum("Volume").alias("volume")
    ))


def _ingested(spark, rows, folder):
    """Rows published as landed files and ingested with default arguments."""
    path = scratch_path(spark, "landing")
    writers.publish_months(rows, f"{path}/in", folder)
    daily.ingest(spark, f"{path}/in", f"{path}/store")
    return tidy(writers.read_months(spark, f"{path}/store"))


def landed_layout(spark, sf):
    """Files `{symbol}/YYYY-MM.json` of several symbols."""
    return _ingested(spark, tables.bars(spark, sf), "")


def incremental_landing(spark, sf):
    """Files read and bars taken, per ingest and symbol.

    Bars up to a day within a month are landed first, then that month again with its later days
    and the months after it; the third ingest finds nothing new.
    """
    path, rows = scratch_path(spark, "landing"), stored(spark, sf)
    parts = [F.col("date") <= F.lit(LANDED_UNTIL).cast("date"),
             F.col("date") >= F.trunc(F.lit(LANDED_UNTIL).cast("date"), "month"), F.lit(False)]
    out, seen = None, writers.read_ledger(spark, f"{path}/store")
    for ingest, part in enumerate(parts, 1):
        writers.publish_months(rows.where(part), f"{path}/in")
        new = daily.ingest(spark, f"{path}/in", f"{path}/store").groupBy("symbol").agg(F.count("*").alias("bars"))
        ledger = cut(writers.read_ledger(spark, f"{path}/store"), "ledger")
        taken = readers.symbol_from_path(ledger.exceptAll(seen), "file")
        taken, seen = taken.groupBy("symbol").agg(F.count("*").alias("files")), ledger
        step = taken.join(new, "symbol", "full").select(F.lit(ingest).alias("ingest"), "symbol", "files", "bars")
        out = step if out is None else out.unionByName(step)
    return out


def normalise(spark, sf):
    raw = tables.bars(spark, sf).withColumnsRenamed(
        {"date": "Date", **{c: f"{c.capitalize()}.X" for c in OHLCV}}
    ).withColumns({"Dividends": F.lit(0.0), "Stock Splits": F.lit(0.0)})
    return tidy(readers.normalise(raw))


def _stored_and_incoming(spark, sf):
    """Stored bars, and incoming ones that overlap them with another close."""
    rows = stored(spark, sf)
    old = rows.where(F.col("date") <= F.lit(STORED_UNTIL).cast("date"))
    new = rows.where(F.col("date") >= F.lit(INCOMING_FROM).cast("date"))
    changed = F.when(
        F.col("date") <= F.lit(STORED_UNTIL).cast("date"), F.col("close") + 1
    ).otherwise(F.col("close"))
    return old, new.withColumn("close", changed)


def upsert_month_merge(spark, sf):
    old, new = _stored_and_incoming(spark, sf)
    path = scratch_path(spark, "store")
    writers.write_months(old, path)
    writers.upsert_months(new, path)
    return tidy(writers.read_months(spark, path))


def month_split(spark, sf):
    path = scratch_path(spark, "months")
    writers.split_months(tables.bars(spark, sf), path)
    rows = clean.bars(readers.symbol_from_path(readers.read_records(spark, path)))[0]
    month = F.regexp_extract("_file", f"/{writers.MONTH}=([^/]+)/", 1).alias(writers.MONTH)
    return tidy(rows.groupBy("symbol", month).agg(
        F.count("*").alias("bars"),
        F.min("date").alias("first_date"),
        F.max("date").alias("last_date"),
        F.sum("volume").alias("volume"),
    ))


def publish_roundtrip(spark, sf):
    return _ingested(spark, stored(spark, sf), "monthly/")


def merge_combined(spark, sf):
    """Bars delivered by two overlapping sources; the first source wins."""
    old, new = _stored_and_incoming(spark, sf)
    rows = old.withColumn("source", F.lit(1)).unionByName(new.withColumn("source", F.lit(2)))
    return tidy(merge.combine(rows, ["source"]))


def result_document(spark, sf):
    rows = stored(spark, sf)
    scored = metrics.evaluate(
        forecast.walk_forward_baseline(rows, ("sma_5",)), by=["symbol"]
    )
    weights = F.create_map(F.lit("close"), F.lit(1.0))
    document = reporting.result_document(
        scored, forecast.next_day_baseline(rows, 5), STAMP, weights
    )
    path = scratch_path(spark, "results")
    writers.write_result(document, path)
    back = spark.read.schema(RESULT).json(path)
    return tidy(back.select(
        "symbol",
        F.col("metrics.Close.RMSE").alias("rmse"),
        F.col("metrics.Close.MAE").alias("mae"),
        F.col("metrics.Close.MAPE").alias("mape"),
        F.col("next_day_prediction.Pred_Close").alias("pred_close"),
        F.col("feature_importance")["close"].alias("importance_close"),
        "prediction_date",
        "timestamp",
    ))


# --- projections, filters ----------------------------------------------------------------------


def clean_records(spark, sf):
    """Landed records of which some lack a value or a readable date; good and bad are counted."""
    day = F.date_format("date", "yyyy-MM-dd")
    rows = tables.bars(spark, sf).select(
        "symbol",
        F.when(F.dayofmonth("date") == 13, "no date").otherwise(day).alias("Date"),
        F.col("open").alias("Open"),
        F.col("high").alias("High"),
        F.when(F.dayofmonth("date") == 7, None).otherwise(F.col("low")).alias("Low"),
        F.when(F.dayofmonth("date") == 9, F.lit(float("nan"))).otherwise(F.col("close")).alias("Close"),
        F.col("volume").alias("Volume"),
    )
    good, rejects = clean.bars(rows)
    return tidy(
        good.withColumn("reason", F.lit("good")).select("symbol", "reason", "volume")
        .unionByName(rejects.select("symbol", "reason", "record.Volume"))
        .groupBy("symbol", "reason")
        .agg(F.count("*").alias("records"), F.sum("volume").alias("volume"))
    )


def clean_lines(spark, sf):
    """Landed lines, read back: objects, arrays of two records, cut lines, and pair lines.

    The kind follows from the day. Pair lines lie in files of their own.
    """
    day = F.dayofmonth("date")
    rows = tables.bars(spark, sf).withColumn("kind", F.when(day == 13, "cut").when(
        day == 7, "array").when(day == 9, "pair").otherwise("object"))
    stamp = F.date_format("date", "yyyy-MM-dd'T'HH:mm:ss.SSS").alias("Date")
    body = F.to_json(F.struct(stamp, *[F.col(c).alias(c.capitalize()) for c in OHLCV]))
    line = (
        F.when(F.col("kind") == "cut", F.substring(body, 1, 40))
        .when(F.col("kind") == "array", F.concat(F.lit("["), body, F.lit(","), body, F.lit("]")))
        .when(F.col("kind") == "pair", F.concat(F.date_format("date", "yyyy-MM-dd"), F.lit("\t"), body))
        .otherwise(body)
    )
    path = scratch_path(spark, "lines")
    texts = rows.select("symbol", (F.col("kind") == "pair").alias("pairs"), line.alias("value"))
    texts.write.partitionBy("symbol", "pairs").text(path)
    landed = readers.read_records(spark, path, "*.txt").where(~F.col("_file").contains("pairs=true"))
    good, rejects = clean.bars(readers.symbol_from_path(landed))
    lines = spark.read.schema("value string, symbol string, pairs boolean").text(path).where("pairs")
    paired, lost = clean.bars(clean.pair_lines(lines.select("symbol", "value"), keep=["symbol"]))
    kinds = [
        good.select("symbol", F.lit("good").alias("reason"), "volume"),
        rejects.select("symbol", "reason", F.lit(None).cast("double").alias("volume")),
        paired.select("symbol", F.lit("pair").alias("reason"), "volume"),
        lost.select("symbol", F.lit("lost pair").alias("reason"), F.lit(None).cast("double").alias("volume")),
    ]
    out = kinds[0]
    for part in kinds[1:]:
        out = out.unionByName(part)
    return tidy(out.groupBy("symbol", "reason").agg(
        F.count("*").alias("records"), F.sum("volume").alias("volume")))


def incr_new_rows(spark, sf):
    old, new = _stored_and_incoming(spark, sf)
    return tidy(merge.new_rows(new, old))


def high_water(spark, sf):
    return merge.high_water(tables.bars(spark, sf))


def feature_set(name, build):
    def query(spark, sf):
        return tidy(features.select(build(stored(spark, sf)), name))

    return query


def feat_target(spark, sf):
    rows = features.target(stored(spark, sf))
    return tidy(rows.select("symbol", "date", "close", "target"))


def feat_bfill(spark, sf):
    rows = stored(spark, sf)
    gaps = measure(rows, I.sma("close", 20, "ma20"), I.pct_change("close", "change"))
    gaps = gaps.withColumn("low_seldom", F.when(F.dayofmonth("date") == 15, F.col("low")))
    out = features.bfill(gaps, ["ma20", "change", "low_seldom"])
    return tidy(out.select("symbol", "date", "ma20", "change", "low_seldom"))


def with_gaps(rows: DataFrame) -> DataFrame:
    """Bars of which some closes are missing, by a rule on the day."""
    return rows.withColumn("close", F.when(~F.dayofmonth("date").isin(3, 4, 17), F.col("close")))


def ema_gaps(spark, sf):
    rows = with_gaps(stored(spark, sf))
    for span in (12, 26):
        rows = features.ema_over_gaps(rows, "close", span, f"ema_{span}")
    return tidy(rows.select("symbol", "date", "ema_12", "ema_26"))


def pct_change_gaps(spark, sf):
    rows = with_gaps(stored(spark, sf))
    rows = features.change(features.change(rows, "close", "change_1"), "close", "change_5", 5)
    return tidy(rows.select("symbol", "date", "change_1", "change_5"))


def training_gaps(spark, sf):
    return tidy(features.training(with_gaps(stored(spark, sf)), gaps=True))


def feat_price(spark, sf):
    rows = features.price_features(tables.bars(spark, sf)).withColumn("hl_ratio", C.hl_ratio())
    return tidy(rows.select("symbol", "date", "price_range", "price_change", "hl_ratio"))


def chart_feed(spark, sf):
    text = tables.bars(spark, sf).withColumns({c: F.col(c).cast("string") for c in OHLCV})
    return tidy(reporting.chart_feed(text))


def change_info(spark, sf):
    return tidy(reporting.change_info(forecast.next_day_baseline(tables.bars(spark, sf), 5)))


def two_decimals(spark, sf):
    rows = tables.bars(spark, sf)
    return rows.select("symbol", "date", *[C.two_decimals(c).alias(f"{c}_text") for c in OHLCV])


def safe_names(spark, sf):
    rows = tables.bars(spark, sf).select("symbol").distinct()
    name = F.concat(F.lit("^"), "symbol", F.lit("/X base tech"))
    return rows.select("symbol", C.safe_name(name).alias("safe_name"))


def next_prediction_date(spark, sf):
    newest = features.latest(tables.bars(spark, sf))
    return newest.select(
        "symbol", "date", C.next_date("date").alias("next_day"),
        C.next_date("date", "business").alias("next_business_day"),
    )


def rsi_flags(spark, sf):
    out = measure(stored(spark, sf), I.rsi("close", "rsi"))
    return tidy(out.select("symbol", "date", "rsi").withColumn(
        "level", C.rsi_level(r4("rsi"))
    ))


def complete_rows(spark, sf):
    out = features.indicators(stored(spark, sf))
    return tidy(out.select("symbol", "date", *features.TECH))


# --- splits, scaling, forecasting --------------------------------------------------------------


def seq_windows(spark, sf):
    """Each 120-row window by its size, first and last row, and sum."""
    out = features.sequences(stored(spark, sf), ["close", "volume"])
    total = F.aggregate("x", F.lit(0.0), lambda a, r: a + r[0])
    return tidy(out.select(
        "symbol", "date",
        F.size("x").alias("length"),
        F.col("x")[0][0].alias("first_close"),
        F.col("x")[119][0].alias("last_close"),
        F.col("x")[119][1].alias("last_volume"),
        (total / 120).alias("mean_close"),
        "y",
    ))


def seq_last_window(spark, sf):
    out = features.last_window(stored(spark, sf), ["close", "volume"])
    return tidy(out.select("symbol", F.posexplode("x").alias("place", "row")).select(
        "symbol", "place", F.col("row")[0].alias("close"), F.col("row")[1].alias("volume")
    ))


def split_tail(spark, sf):
    return tidy(split.tail(tables.bars(spark, sf)).select("symbol", "date", "close", "part"))


def split_random(spark, sf):
    return split.random(stored(spark, sf)).select("symbol", "date", "part")


def latest_bar(spark, sf):
    return tidy(features.latest(tables.bars(spark, sf)))


def scale_standard(spark, sf):
    rows = split.tail(stored(spark, sf))
    params = scale.fit_standard(rows.where(F.col("part") == "train"), ["close", "volume"])
    scaled = scale.apply(rows, params, ["close", "volume"], suffix="_z")
    back = scale.invert(
        scaled.withColumn("close_back", F.col("close_z")), params, "close_back", of="close"
    )
    return tidy(back.select("symbol", "date", "part", "close_z", "volume_z", "close_back"))


def scale_minmax(spark, sf):
    rows = split.tail(stored(spark, sf)).withColumn("constant", F.lit(7.0))
    cols = ["close", "volume", "constant"]
    params = scale.fit_minmax(rows.where(F.col("part") == "train"), cols)
    scaled = scale.apply(rows, params, cols, suffix="_s")
    return tidy(scaled.select("symbol", "date", "part", *[f"{c}_s" for c in cols]))


def metrics_naive(spark, sf):
    """Every bar predicted by the close before it, over whole series."""
    out = measure(stored(spark, sf), I.trailing_mean("close", 1, "predicted"))
    known = out.where(F.col("predicted").isNotNull()).withColumnRenamed("close", "actual")
    return tidy(metrics.evaluate(known))


def next_day_baseline(spark, sf):
    return tidy(forecast.next_day_baseline(tables.bars(spark, sf), 5))


def walk_forward_baseline(spark, sf):
    return tidy(forecast.walk_forward_baseline(stored(spark, sf)))


def recursive_baseline(spark, sf):
    return tidy(forecast.recursive_baseline(stored(spark, sf), 5))


def rank_feature_sets(spark, sf):
    return tidy(forecast.rank_baselines(stored(spark, sf)))


def prediction_report(spark, sf):
    return tidy(metrics.report(
        forecast.walk_forward_baseline(stored(spark, sf), ("sma_5",)).drop("feature_set")
    ))


def prediction_response(spark, sf):
    rows = stored(spark, sf)
    guessed = forecast.next_day_baseline(rows, 5).drop("current_close")
    out = reporting.prediction_response(rows, guessed, AS_OF, STAMP)
    history = F.col("historical_data")
    return tidy(out.select(
        "ticker", "prediction_date", "predicted_close", "current_close",
        "prediction_timestamp", "is_intraday",
        F.size(history).alias("history_rows"),
        history[0]["date"].alias("history_first"),
        F.aggregate(history, F.lit(0.0), lambda a, r: a + r["volume"]).alias("history_volume"),
    ))


# --- Spark ML ----------------------------------------------------------------------------------

# SQL cannot fit these models. What it can say, rows, dates and actual values, is compared exactly,
# and errors are held against those of a naive forecast. Two small models have closed forms.

RF = features.FEATURE_SETS["rf"]
_FITTED: dict[tuple[str, str], tuple] = {}


def _forest(spark, sf):
    """The forest of the given tables, fitted once per application and shared by its queries."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _FITTED:
        rows = cut(forecast.supervised(stored(spark, sf), RF), "features")
        samples = cut(forecast.holdout(rows), "holdout")
        params = cut(forecast.fit_scalers(samples, RF), "scalers")
        scaled = cut(forecast.scaled_samples(samples, params, RF), "scaled")
        model = forecast.fit_forest(scaled.where(F.col("part") == "train"), RF)
        _FITTED[key] = rows, params, scaled, model
    return _FITTED[key]


def _held_against(model: DataFrame, naive: DataFrame, by: list[str], share: float) -> DataFrame:
    """Row counts, and whether the model's MAE is at most `share` of the naive one."""
    other = naive.select(*by, F.col("mae").alias("naive"))
    return model.join(other, by).select(
        *by, "n", "zero_actuals", (F.col("mae") <= F.col("naive") * share).alias("holds"))


def ml_rf_predict(spark, sf):
    _, params, scaled, model = _forest(spark, sf)
    test = scaled.where(F.col("part") == "test")
    tested = forecast.predict_scaled(model, test, params, RF)
    naive = metrics.evaluate(test.withColumn("predicted", F.col("close")), actual="target")
    return _held_against(metrics.evaluate(tested, actual="target"), naive, ["symbol"], 1.0)


def ml_rf_importance(spark, sf):
    _, _, scaled, model = _forest(spark, sf)
    pairs = F.explode(forecast.importance_map(model, RF)).alias("feature", "importance")
    rows = scaled.groupBy("part").agg(F.count("*").alias("rows")).select("part", "rows", pairs)
    total = F.sum("importance").over(Window.partitionBy("part"))
    sound = (F.col("importance") >= 0) & (F.abs(total - 1) < 1e-9)
    return rows.select("part", "rows", "feature", sound.alias("sound"))


def ml_next_day(spark, sf):
    """Dates, closes, and whether predictions lie within three deviations of the mean close."""
    rows, params, _, model = _forest(spark, sf)
    out = forecast.next_day(model, rows, params, RF)
    usual = rows.groupBy("symbol").agg(F.avg("close").alias("mean"), F.stddev_pop("close").alias("std"))
    near = F.abs(F.col("predicted_close") - F.col("mean")) <= F.col("std") * 3
    return tidy(out.join(usual, "symbol").select(
        "symbol", "prediction_date", "current_close", near.alias("near")))


def ml_model_roundtrip(spark, sf):
    """The loaded model gives what the one in memory gives."""
    rows, params, _, model = _forest(spark, sf)
    root = scratch_path(spark, "models")
    models.save(model, params, root, "^ALL", "rf", RF, STAMP)
    loaded, loaded_params = models.load(spark, root, "^ALL", "rf")
    first = forecast.next_day(model, rows, params, RF)
    again = forecast.next_day(loaded, rows, loaded_params, RF).select(
        "symbol", F.col("predicted_close").alias("again"))
    return tidy(first.join(again, "symbol").select(
        "symbol", "prediction_date", "current_close",
        (F.col("predicted_close") == F.col("again")).alias("same")))


def ml_model_catalog(spark, sf):
    _, params, scaled, model = _forest(spark, sf)
    root = scratch_path(spark, "models")
    meta = models.save(model, params, root, "^ALL", "rf", RF, STAMP)
    trained = scaled.where(F.col("part") == "train").agg(F.count("*").alias("train_rows"))
    scalers = spark.read.parquet(meta["scaler_path"]).agg(F.count("*").alias("symbols"))
    catalog = readers.read_catalog(spark, f"{root}/meta").drop("path", "scaler_path")
    one = F.lit(1).alias("_one")
    counts = trained.withColumn("_one", one).join(scalers.withColumn("_one", one), "_one")
    out = catalog.withColumn("_one", one).join(counts, "_one").drop("_one")
    return out.withColumn("features", F.array_join("features", ","))


def ml_model_versions(spark, sf):
    """Two saves and one that breaks off before its metadata: the second one is loaded, whole."""
    rows, root = stored(spark, sf), scratch_path(spark, "models")
    for length, created in ((1, "2024-01-30 12:00:00"), (2, STAMP)):
        tail = cut(forecast.study_rows(rows, ["close"]), "study")
        params = forecast.fit_study_scalers(tail, ["close"])
        model = forecast.fit_sequence(cut(forecast.sequence_samples(tail, params, ["close"], length), "samples"))
        meta = models.save(model, params, root, "^ALL", "close", ["close"] * length, created)
    model.write().save(f"{meta['model_path']}/../../v-broken/model")
    model, params = models.load(spark, root, "^ALL", "close")
    found = readers.read_catalog(spark, f"{root}/meta").select("ticker", "created_date", F.size("features").alias("lags"))
    one = F.lit(1).alias("_one")
    spans = params.select("symbol", r4("close_shift", "low"), r4("close_scale", "span"), one)
    return spans.join(found.withColumn("_one", one), "_one").drop("_one").withColumn(
        "weights", F.lit(len(model.coefficients)))


def _sequence(spark, sf, cols):
    rows = cut(forecast.study_rows(stored(spark, sf), cols), "study")
    params = forecast.fit_study_scalers(rows, cols)
    samples = cut(forecast.sequence_samples(rows, params, cols), "samples")
    return rows, params, samples, forecast.fit_sequence(samples)


def _naive(spark, sf) -> DataFrame:
    out = measure(stored(spark, sf), I.trailing_mean("close", 1, "predicted"))
    return out.select("symbol", "date", F.col("close").alias("actual"), "predicted")


def ml_seq_regression(spark, sf):
    """The final model, fitted on every row that has a window; its error on these rows."""
    rows, cols = stored(spark, sf), ["close", "volume"]
    model, params = forecast.fit_final_sequence(rows, cols)
    every = rows.withColumn("part", F.lit("train"))
    guessed = forecast.predict_sequence(model, forecast.sequence_samples(every, params, cols), params)
    naive = _naive(spark, sf).join(guessed.select("symbol", "date"), ["symbol", "date"])
    return _held_against(metrics.evaluate(guessed), metrics.evaluate(naive), ["symbol"], 1.0)


def _judged(guessed: DataFrame, naive: DataFrame, share: float) -> DataFrame:
    """Dates and actual values, and per symbol whether the error is bounded by the naive one."""
    own = naive.join(guessed.select("symbol", "date"), ["symbol", "date"])
    bound = _held_against(metrics.evaluate(guessed), metrics.evaluate(own), ["symbol"], share)
    return tidy(guessed.join(bound, "symbol").select("symbol", "date", "actual", "holds"))


def ml_walk_forward(spark, sf):
    _, params, samples, model = _sequence(spark, sf, ["close", "volume"])
    return _judged(forecast.walk_forward(model, samples, params), _naive(spark, sf), 1.0)


def ml_recursive_forecast(spark, sf):
    cols = ["close", "volume"]
    rows, params, _, model = _sequence(spark, sf, cols)
    return _judged(forecast.recursive(model, rows, params, cols), _naive(spark, sf), 1.2)


def ml_rank(spark, sf):
    """Three runs of two sets: every run finishes, the better set comes first, and none is much
    worse than repeating the last close."""
    bars_ = stored(spark, sf)
    rows = cut(features.indicators(bars_), "indicators")
    last = metrics.evaluate(forecast.walk_forward_baseline(bars_, ("last_close",)))
    last = last.select("symbol", F.col("mape").alias("last"))
    sets = {n: features.FEATURE_SETS[n] for n in ("base", "base_tech")}
    ranked = forecast.compare_feature_sets(rows, sets)
    best = F.min("mape").over(Window.partitionBy("symbol"))
    first = (F.col("place") == 1) == (F.col("mape") == best)
    return ranked.withColumn("best_first", first).join(last, "symbol").select(
        "symbol", "feature_set", "runs", F.col("failed").cast("long").alias("failed"),
        "best_first", (F.col("mape") <= F.col("last") * 2).alias("sound"))


def ml_ridge_one_lag(spark, sf):
    """The sequence model with one lag of one column, which has a closed form."""
    rows = cut(forecast.study_rows(stored(spark, sf), ["close"]), "study")
    params = forecast.fit_study_scalers(rows, ["close"])
    samples = cut(forecast.sequence_samples(rows, params, ["close"], length=1), "samples")
    return tidy(forecast.walk_forward(forecast.fit_sequence(samples), samples, params))


def ml_tree_one_split(spark, sf):
    """One tree of one split on the month, without a bootstrap, which has a closed form."""
    rows = tables.bars(spark, sf).select(
        F.month("date").cast("double").alias("month_z"), F.col("volume").alias("target_z"))
    model = forecast.fit_forest(cut(rows, "months"), ["month"], trees=1, depth=1, bootstrap=False)
    months = rows.select("month_z").distinct()
    return tidy(model.transform(months).select(
        F.col("month_z").cast("int").alias("month"), "predicted"))


def ml_tree_per_symbol(spark, sf):
    """One tree per symbol, one and two splits deep, on month and day of the week, without a
    bootstrap: its value for every month and day."""
    rows = cut(stored(spark, sf).select(
        "symbol", "date", F.month("date").cast("double").alias("month"),
        F.weekday("date").cast("double").alias("day"), F.col("volume").alias("target")), "months")
    out = None
    for depth in (1, 2):
        growth = trees.Growth(trees=1, depth=depth, bootstrap=False)
        forests = trees.fit(rows, ["month", "day"], growth=growth)
        value = trees.walked(F.col("trees"), F.array("month", "day"), depth).alias("predicted")
        part = rows.select("symbol", "month", "day").distinct().join(forests, "symbol").select(
            F.lit(depth).alias("depth"), "symbol", F.col("month").cast("int").alias("month"),
            F.col("day").cast("int").alias("day"), value)
        out = part if out is None else out.unionByName(part)
    return tidy(out)


def ml_permutation_importance(spark, sf):
    """Importance of month, weekday and a constant for a tree of one split per symbol."""
    rows = cut(stored(spark, sf).select(
        "symbol", "date", F.month("date").cast("double").alias("month"),
        F.weekday("date").cast("double").alias("day"), F.lit(1.0).alias("one"), F.col("volume").alias("target")), "months")
    cols = ["month", "day", "one"]
    forests = cut(trees.fit(rows, cols, growth=trees.Growth(trees=1, depth=1, bootstrap=False)), "forests")
    # One part per symbol, whatever its length, so that SQL can deal the values the same way.
    return tidy(trees.permutation_importance(forests, rows, cols, depth=1, part_rows=1 << 40))


def ml_forest_per_symbol(spark, sf):
    """A forest for each symbol: its error on the test rows against the close of the day."""
    found = daily.train_each(stored(spark, sf), growth=trees.Growth(trees=50, depth=8))
    test = forecast.holdout(forecast.supervised(stored(spark, sf), RF)).where(F.col("part") == "test")
    naive = metrics.evaluate(test.withColumn("predicted", F.col("close")), actual="target")
    return _held_against(found.metrics, naive, ["symbol"], 1.0)


def ml_ridge_per_symbol(spark, sf):
    """A ridge for each symbol on one and on two lags of its close, which have closed forms."""
    rows = stored(spark, sf)
    scaled = cut(scale.apply(rows, scale.fit_minmax(rows, ["close"]), ["close"]), "scaled")
    out = None
    for lags in (1, 2):
        models_ = ridge.fit(scaled, ["close"], length=lags)
        part = models_.select("symbol", F.lit(lags).alias("lags"), "n", "bias", F.posexplode("weights").alias("i", "weight"))
        part = part.withColumn("lag", F.col("lags") - F.col("i")).drop("i")
        out = part if out is None else out.unionByName(part)
    return tidy(out)


def ml_ridge_walk_forward(spark, sf):
    """A ridge for each symbol on two lags of its close, fitted on the rows before the last 30 of
    its tail and applied to these, which has a closed form."""
    cols = ["close"]
    rows = cut(forecast.study_rows(stored(spark, sf), cols), "study")
    params = cut(forecast.fit_study_scalers(rows, cols), "scalers")
    scaled = cut(scale.apply(rows, params, cols), "scaled")
    models_ = ridge.fit(scaled.where(F.col("part") == "train"), cols, length=2)
    guessed = ridge.predict(models_, scaled, cols, length=2).join(
        scaled.where(F.col("part") == "test").select("symbol", "date"), ["symbol", "date"])
    return tidy(scale.invert(scale.invert(guessed, params, "predicted", "close"), params, "actual", "close"))


def ml_recursive_trees(spark, sf):
    """Thirty days ahead by a forest for each symbol on windows of ten rows."""
    cols, length = ["close", "volume"], 10
    rows = cut(forecast.study_rows(stored(spark, sf), cols), "study")
    params = cut(forecast.fit_study_scalers(rows, cols), "scalers")
    samples = forecast.sequence_samples(rows, params, cols, length).where(F.col("part") == "train")
    names = [f"x{i}" for i in range(length * len(cols))]
    flat = samples.select("symbol", "date", "y", *[
        F.element_at(F.flatten("x"), i + 1).alias(n) for i, n in enumerate(names)])
    forests = cut(trees.fit(cut(flat, "lags"), names, "y", trees.Growth(trees=30, depth=6)), "forests")
    return _judged(forecast.recursive_trees(forests, rows, params, cols, 6, length), _naive(spark, sf), 1.2)


# --- alerts and streams ------------------------------------------------------------------------


def predictions(spark, sf) -> DataFrame:
    """The mean of five daily closes as the prediction for the next day."""
    daily_bars = cut(tables.daily_ticks(spark, sf), "daily")
    guessed = measure(daily_bars, I.sma("close", 5, "predicted"))
    return guessed.where(F.col("predicted").isNotNull()).select(
        "symbol", C.next_date("date").alias("prediction_date"), "predicted"
    )


def _tick_stream(spark, sf) -> DataFrame:
    events = spark.readStream.schema(TICKS).option("pathGlobFilter", "events.parquet").parquet(sf)
    return tables.as_ticks(events)


def _through_stream(spark, stream: DataFrame, name: str) -> DataFrame:
    """Run a stream over everything there is into a table, and read the table."""
    path = scratch_path(spark, name)
    topics.write_table(stream, f"{path}/out", f"{path}/checkpoint", wait=True)
    return spark.read.schema(stream.schema).parquet(f"{path}/out")


def _typed(messages: DataFrame) -> DataFrame:
    return messages.select("key", F.from_json("value", ALERT).alias("v")).select("key", "v.*")


def alerts_batch(spark, sf):
    return tidy(alerts.messages(tables.ticks(spark, sf), predictions(spark, sf), STAMP))


def str_alerts(spark, sf):
    stream = alert_stream.stream(_tick_stream(spark, sf), cut(predictions(spark, sf)), STAMP)
    return tidy(_typed(_through_stream(spark, stream, "alerts")))


def str_alerts_changing(spark, sf):
    """Alerts against predictions from a stream: the mean of five closes from midnight on, and from
    noon on the close of the day before."""
    path, daily_bars = scratch_path(spark, "predictions"), cut(tables.daily_ticks(spark, sf), "daily")
    midnight = F.col("prediction_date").cast("timestamp")
    first = predictions(spark, sf).withColumn("made_at", midnight)
    second = daily_bars.select("symbol", C.next_date("date").alias("prediction_date"), F.col("close").alias("predicted"))
    second = second.withColumn("made_at", F.timestamp_add("HOUR", F.lit(12), midnight))
    made = first.unionByName(second)
    made.write.parquet(path)
    arriving = spark.readStream.schema(made.schema).parquet(path)
    stream = changing.stream(_tick_stream(spark, sf), arriving, STAMP, salts=3)
    return tidy(_typed(_through_stream(spark, stream, "changing")))


def str_consume_each(spark, sf):
    """Envelopes handled in the tasks that read them, each part of an epoch once."""
    path = scratch_path(spark, "each")
    topic = topics.Topic(format="json", path=f"{path}/topic")
    topics.write_topic(topics.envelope(_said(_tick_stream(spark, sf))), topic, f"{path}/sent", wait=True)
    handler = topics.OncePerPart(f"{path}/handled")
    topics.handle_each(topics.read_topic(spark, topic), handler, f"{path}/received", wait=True)
    body = F.from_json("value", ENVELOPE)["message"]
    return spark.read.schema(MESSAGES).json(f"{path}/handled").groupBy(
        F.split_part(body, F.lit(" "), F.lit(1)).alias("symbol")).agg(
        F.count("*").alias("messages"),
        F.sum(F.split_part(body, F.lit(" "), F.lit(2)).cast("long")).alias("event_ids"))


def _said(ticks: DataFrame) -> DataFrame:
    return ticks.withColumn("message", F.concat_ws(" ", "symbol", "event_id"))


def str_envelope(spark, sf):
    sent = _through_stream(spark, topics.envelope(_said(_tick_stream(spark, sf))), "envelopes")
    return sent.select("key", F.from_json("value", ENVELOPE).alias("v")).select("key", "v.*")


def str_consume(spark, sf):
    """Envelopes sent to a topic of files, consumed once each by a handler that stores them."""
    path = scratch_path(spark, "topic")
    topic = topics.Topic(format="json", path=f"{path}/topic")
    sent = topics.envelope(_said(_tick_stream(spark, sf)))
    topics.write_topic(sent, topic, f"{path}/sent", wait=True)
    received = topics.read_topic(spark, topic)
    topics.handle(received, topics.into_table(f"{path}/table"), f"{path}/received", wait=True)
    stored_messages = spark.read.schema(MESSAGES).parquet(f"{path}/table")
    body = F.from_json("value", ENVELOPE)["message"]
    return stored_messages.groupBy(F.split_part(body, F.lit(" "), F.lit(1)).alias("symbol")).agg(
        F.count("*").alias("messages"),
        F.sum(F.split_part(body, F.lit(" "), F.lit(2)).cast("long")).alias("event_ids"),
    )


def bars_240m(spark, sf):
    return tidy(intraday.bars(tables.ticks(spark, sf)))


def str_bars_240m(spark, sf):
    """Windows that closed before the last tick less the allowed lateness of one hour."""
    stream = intraday.bars(_tick_stream(spark, sf), watermark="1 hour")
    return tidy(_through_stream(spark, stream, "bars"))


def str_bars_open(spark, sf):
    """All windows, also those that a watermark would keep open, and the ticks that came late."""
    path = scratch_path(spark, "windows")
    topics.handle(_tick_stream(spark, sf), intraday.into_windows(f"{path}/out"), f"{path}/checkpoint", wait=True)
    intraday.compact_windows(spark, f"{path}/out", 0)
    return tidy(intraday.read_windows(spark, f"{path}/out"))


def band_predicted(spark, sf):
    """A band for the next day of each symbol from exact quantiles, and how often it held."""
    return tidy(forecast.predicted_band(stored(spark, sf)))


def band_breaches(spark, sf):
    """Intraday bars outside the high and low of the day before."""
    bands = tables.daily_ticks(spark, sf).select(
        "symbol", C.next_date("date").alias("prediction_date"),
        F.col("high").alias("predicted_high"), F.col("low").alias("predicted_low"),
    )
    out = intraday.band_breaches(intraday.bars(tables.ticks(spark, sf)), bands)
    return tidy(out.select(
        "symbol", "prediction_date", "window_start", "high", "low",
        "predicted_high", "predicted_low", "side",
    ))


QUERIES = {
    "src_bars": bars,
    "src_range_90d": range_90d,
    "src_monthly_json": monthly_json,
    "src_landed_layout": landed_layout,
    "src_incremental_landing": incremental_landing,
    "src_jsonl_roundtrip": jsonl_roundtrip,
    "src_csv_roundtrip": csv_roundtrip,
    "src_ticker_from_path": ticker_from_path,
    "prj_normalise": normalise,
    "upsert_month_merge": upsert_month_merge,
    "month_split": month_split,
    "publish_roundtrip": publish_roundtrip,
    "merge_combined": merge_combined,
    "result_document": result_document,
    "clean_records": clean_records,
    "clean_lines": clean_lines,
    "incr_new_rows": incr_new_rows,
    "high_water": high_water,
    "feat_set_rf": feature_set("rf", features.training),
    "feat_set_base_tech": feature_set("base_tech", features.indicators),
    "ind_complete_rows": complete_rows,
    "ind_sma": measured(*features.moving_averages("sma_")),
    "ind_volume_ma": measured(I.sma("volume", 5, "volume_ma5")),
    "ind_diff": measured(*[I.diff(c, f"{c}_diff") for c in OHLCV]),
    "ind_diff2": measured(*[I.diff(c, f"{c}_diff2", 2) for c in OHLCV]),
    "ind_pct_change": measured(*[I.pct_change(c, f"{c}_change") for c in OHLCV]),
    "ind_returns": measured(
        I.pct_change("close", "daily_return"), I.pct_change("close", "weekly_return", 5)
    ),
    "ind_rsi": measured(I.rsi("close", "rsi")),
    "ind_rsi_flags": rsi_flags,
    "ind_ema": measured(*[I.ema("close", n, f"ema_{n}") for n in (9, 12, 26)]),
    "ind_ema_gaps": ema_gaps,
    "ind_pct_change_gaps": pct_change_gaps,
    "feat_training_gaps": training_gaps,
    "ind_macd": measured(I.macd("close")),
    "feat_bfill": feat_bfill,
    "feat_target": feat_target,
    "feat_price": feat_price,
    "feat_training": lambda spark, sf: tidy(features.training(stored(spark, sf))),
    "feat_indicators": lambda spark, sf: tidy(features.indicators(stored(spark, sf))),
    "feat_serving_90d": lambda spark, sf: tidy(features.serving(stored(spark, sf), AS_OF, 90)),
    "seq_windows": seq_windows,
    "seq_last_window": seq_last_window,
    "latest_bar": latest_bar,
    "split_tail": split_tail,
    "split_random": split_random,
    "scale_standard": scale_standard,
    "scale_minmax": scale_minmax,
    "metrics_naive": metrics_naive,
    "rank_feature_sets": rank_feature_sets,
    "next_day_baseline": next_day_baseline,
    "next_prediction_date": next_prediction_date,
    "walk_forward_baseline": walk_forward_baseline,
    "recursive_baseline": recursive_baseline,
    "prediction_report": prediction_report,
    "prediction_response": prediction_response,
    "chart_feed": chart_feed,
    "change_info": change_info,
    "safe_names": safe_names,
    "two_decimals": two_decimals,
    "alerts_batch": alerts_batch,
    "bars_240m": bars_240m,
    "band_breaches": band_breaches,
    "band_predicted": band_predicted,
    "str_bars_open": str_bars_open,
    "str_alerts": str_alerts,
    "str_alerts_changing": str_alerts_changing,
    "str_consume_each": str_consume_each,
    "str_envelope": str_envelope,
    "str_consume": str_consume,
    "str_bars_240m": str_bars_240m,
    "ml_rf_predict": ml_rf_predict,
    "ml_rf_importance": ml_rf_importance,
    "ml_next_day": ml_next_day,
    "ml_seq_regression": ml_seq_regression,
    "ml_walk_forward": ml_walk_forward,
    "ml_recursive_forecast": ml_recursive_forecast,
    "ml_rank": ml_rank,
    "ml_ridge_one_lag": ml_ridge_one_lag,
    "ml_tree_one_split": ml_tree_one_split,
    "ml_tree_per_symbol": ml_tree_per_symbol,
    "ml_forest_per_symbol": ml_forest_per_symbol,
    "ml_permutation_importance": ml_permutation_importance,
    "ml_ridge_per_symbol": ml_ridge_per_symbol,
    "ml_ridge_walk_forward": ml_ridge_walk_forward,
    "ml_recursive_trees": ml_recursive_trees,
    "ml_model_roundtrip": ml_model_roundtrip,
    "ml_model_catalog": ml_model_catalog,
    "ml_model_versions": ml_model_versions,
}


def flagship(spark: SparkSession, sf: str) -> DataFrame:
    """The newest bar of each symbol with its moving averages and MACD lines."""
    out = measure(stored(spark, sf), *features.moving_averages("sma_"), I.macd("close"))
    return tidy(features.latest(out))


