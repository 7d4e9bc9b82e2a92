"""Models per symbol: forests from histograms, ridges from lagged products, recursive forecasts."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import functions as F

from barloom.operators import forecast, quantile, ridge, scale, trees
from barloom.plans import daily
from barloom.schemas import BARS


@pytest.fixture(scope="module")
def frame():
    rng = np.random.default_rng(3)
    parts = []
    for symbol, n in (("A", 1500), ("B", 333), ("one", 1)):
        a, b = rng.integers(0, 20, n).astype(float), rng.normal(size=n).round(3)
        parts.append(pd.DataFrame({
            "symbol": symbol, "date": pd.date_range("2001-01-01", periods=n).date, "a": a, "b": b,
            "target": np.where(a > 7, 4.0, 0.0) + b * (a > 12) + rng.normal(size=n) * 0.2}))
    return pd.concat(parts)


@pytest.fixture(scope="module")
def samples(spark, frame):
    return spark.createDataFrame(frame).repartition(5)


def grown(values, target, cuts, depth, min_leaf):
    """One tree by brute force, as nested tuples, with the borders the operator offers."""
    best, whole = None, target.sum() ** 2 / len(target)
    if depth:
        for f, borders in enumerate(cuts):
            for border in borders:
                low = values[:, f] <= border
                if min(low.sum(), (~low).sum()) >= min_leaf:
                    gain = target[low].sum() ** 2 / low.sum() + target[~low].sum() ** 2 / (~low).sum() - whole
                    if best is None or gain > best[0] * (1 + 1e-10):
                        best = gain, f, border
    if best is None or best[0] <= 1e-12 * whole:
        return target.mean()
    low = values[:, best[1]] <= best[2]
    return best[1], best[2], *(grown(values[s], target[s], cuts, depth - 1, min_leaf) for s in (low, ~low))


def fall(tree, row):
    while isinstance(tree, tuple):
        tree = tree[2] if row[tree[0]] <= tree[1] else tree[3]
    return tree


@pytest.mark.parametrize("depth,min_leaf", [(1, 2), (3, 2), (5, 40)])
def test_tree_equals_brute_force_per_symbol(samples, frame, depth, min_leaf, monkeypatch):
    monkeypatch.setattr(trees, "CHUNK_ROWS", 100)
    growth = trees.Growth(trees=1, depth=depth, min_leaf=min_leaf, bootstrap=False)
    forests = trees.fit(samples, ["a", "b"], growth=growth)
    got = trees.predict(forests, samples, ["a", "b"]).toPandas().set_index(["symbol", "date"])["predicted"]
    cuts = {r.symbol: r.cuts for r in trees.cut_points(samples, ["a", "b"], growth.bins).collect()}
    for symbol, part in frame.groupby("symbol"):
        values = part[["a", "b"]].to_numpy()
        tree = grown(values, part["target"].to_numpy(), cuts[symbol], depth, min_leaf)
        for day, row in zip(part["date"], values):
            assert got[symbol, day] == pytest.approx(fall(tree, row))


def test_forest_does_not_depend_on_chunks(samples, monkeypatch):
    growth = trees.Growth(trees=30, depth=4)
    found = []
    for rows, group in ((4096, 25), (64, 7)):
        monkeypatch.setattr(trees, "CHUNK_ROWS", rows)
        monkeypatch.setattr(trees, "GROUP_TREES", group)
        out = trees.predict(trees.fit(samples, ["a", "b"], growth=growth), samples, ["a", "b"]).toPandas()
        found.append(out.sort_values(["symbol", "date"])["predicted"].to_numpy())
    np.testing.assert_allclose(found[0], found[1], rtol=1e-9)


def test_chunks_of_a_hot_symbol_are_bounded(samples, monkeypatch):
    monkeypatch.setattr(trees, "CHUNK_ROWS", 100)
    packed = trees.chunks(samples, trees.cut_points(samples, ["a", "b"]), ["a", "b"], "target", 1)
    sizes = [r.n for r in packed.where("symbol = 'A'").collect()]
    assert sum(sizes) == 1500 and len(sizes) == 15 and max(sizes) < 200


def test_walking_in_an_expression_and_importance(samples, frame):
    growth = trees.Growth(trees=12, depth=5)
    forests = trees.fit(samples.withColumn("c", F.lit(1.0)), ["a", "b", "c"], growth=growth)
    both = samples.withColumn("c", F.lit(1.0)).join(forests, "symbol").select(
        "symbol", "date", trees.walked(F.col("trees"), F.array("a", "b", "c"), growth.depth).alias("walked"))
    plain = trees.predict(forests, samples.withColumn("c", F.lit(1.0)), ["a", "b", "c"])
    assert both.join(plain, ["symbol", "date"]).where(F.abs(F.col("walked") - F.col("predicted")) > 1e-9).isEmpty()
    shares = {(r.symbol, r.feature): r.importance for r in trees.importance(forests, ["a", "b", "c"]).collect()}
    assert shares["A", "a"] > 0.5 and shares["A", "c"] == 0 and shares["one", "a"] == 0
    assert sum(v for (s, _), v in shares.items() if s == "A") == pytest.approx(1)


def test_forest_edge_cases(spark, samples):
    empty = trees.fit(samples.where("false"), ["a", "b"], growth=trees.Growth(trees=2, depth=2))
    assert empty.collect() == []
    flat = samples.withColumn("target", F.lit(3.0)).withColumn("b", F.when(F.col("a") < 3, F.col("b")))
    out = trees.predict(trees.fit(flat, ["a", "b"], growth=trees.Growth(trees=3, depth=3)), samples, ["a", "b"])
    assert {round(r.predicted, 9) for r in out.collect()} == {3.0}


def test_permutation_importance(samples):
    rows = samples.withColumn("c", F.lit(2.0))
    forests = trees.fit(rows, ["a", "b", "c"], growth=trees.Growth(trees=4, depth=4)).cache()
    for part in (4096, 100):
        got = {(r.symbol, r.feature): r.importance for r in trees.permutation_importance(
            forests, rows, ["a", "b", "c"], depth=4, part_rows=part).collect()}
        # Dealing out the column that moves the target by 4 costs about 2 * var = 8 * 0.4 * 0.6 * 4.
        assert 5 < got["A", "a"] < 11 and 0 < got["A", "b"] < 2 and got["A", "c"] == 0 == got["one", "a"]


@pytest.mark.parametrize("slices,precision", [(128, 2000), (4, 10), (2, 3)])
def test_exact_quantiles(spark, slices, precision, monkeypatch):
    monkeypatch.setattr(quantile, "SLICES", slices)
    monkeypatch.setattr(quantile, "PRECISION", precision)
    rng = np.random.default_rng(4)
    values = {"A": rng.normal(size=3000), "ties": rng.integers(0, 3, 500) * 1.0, "far": np.append(rng.random(400), 1e300),
              "one": np.array([7.0]), "same": np.full(90, 2.0)}
    rows = [(s, float(v)) for s, vs in values.items() for v in vs] + [("A", None), (None, 1.0), ("none", None)]
    shares = [0.0, 0.05, 0.5, 0.95, 1.0]
    got = quantile.exact(spark.createDataFrame(rows, "symbol string, v double").repartition(5), "v", shares).collect()
    assert {r.symbol for r in got} == set(values)
    for r in got:
        ordered = np.sort(values[r.symbol])
        ranks = [max(1, int(np.ceil(round(s * len(ordered), 6)))) for s in shares]
        assert list(r)[1:] == [ordered[k - 1] for k in ranks]


# --- ridge -------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def walk(spark):
    rng = np.random.default_rng(8)
    parts = []
    for symbol, n in (("A", 700), ("B", 261), ("short", 130), ("none", 60), ("flat", 300)):
        close = np.zeros(n) + 0.5 if symbol == "flat" else np.cumsum(rng.normal(size=n)) / 20 + 0.5
        parts.append(pd.DataFrame({
            "symbol": symbol, "date": pd.date_range("2001-01-01", periods=n).date,
            "close": close, "volume": rng.random(n)}))
    return pd.concat(parts)


def windows(part, cols, length):
    values, y = part[cols].to_numpy(), part["close"].to_numpy()
    x = np.array([values[t - length:t].ravel() for t in range(length, len(part))])
    return x, y[length:]


@pytest.mark.parametrize("length,block", [(1, 64), (2, 50), (120, 4096), (120, 128)])
def test_ridge_equals_numpy(spark, walk, length, block):
    cols = ["close", "volume"]
    rows = spark.createDataFrame(walk).repartition(4)
    models = ridge.fit(rows, cols, length=length, block_rows=block)
    got = {r.symbol: r for r in models.collect()}
    assert set(got) == {s for s, p in walk.groupby("symbol") if len(p) > length}
    guessed = ridge.predict(models, rows, cols, length=length, block_rows=block).toPandas()
    for symbol, part in walk.groupby("symbol"):
        if symbol not in got:
            continue
        x, y = windows(part, cols, length)
        weights, bias = np.zeros(x.shape[1]), y.mean()
        if y.std() > 0:
            moved = x - x.mean(axis=0)
            weights = np.linalg.solve(moved.T @ moved / len(y) + np.eye(x.shape[1]) * 0.01 / y.std(),
                                      moved.T @ (y - y.mean()) / len(y))
            bias = y.mean() - weights @ x.mean(axis=0)
        np.testing.assert_allclose(got[symbol].weights, weights, atol=1e-8)
        assert got[symbol].bias == pytest.approx(bias, abs=1e-8) and got[symbol].n == len(y)
        own = guessed[guessed["symbol"] == symbol].sort_values("date")
        np.testing.assert_allclose(own["predicted"], x @ weights + bias, atol=1e-8)
        np.testing.assert_allclose(own["actual"], y)


def test_ridge_equals_spark_ml_for_one_symbol(spark, walk):
    rows = spark.createDataFrame(walk[walk["symbol"] == "A"])
    tail = forecast.study_rows(rows, ["close"], test=1, train=699)
    identity = tail.groupBy("symbol").agg(F.lit(0.0).alias("close_shift"), F.lit(1.0).alias("close_scale"))
    ml = forecast.fit_sequence(forecast.sequence_samples(tail, identity, ["close"], length=12).withColumn("part", F.lit("train")))
    own = ridge.fit(rows, ["close"], length=12).first()
    np.testing.assert_allclose(own.weights, ml.coefficients.toArray(), rtol=1e-6)
    assert own.bias == pytest.approx(ml.intercept)


def test_ridge_exchanges_no_windows(spark, walk, monkeypatch):
    sizes = []
    real = ridge.cut
    monkeypatch.setattr(ridge, "cut", lambda df, name: sizes.append(df) or real(df, name))
    ridge.fit(spark.createDataFrame(walk), ["close"], length=120, block_rows=256)
    items = sizes[0].select("symbol", F.explode("items").alias("i"))
    # Each row stands in its block, and in the next if it is one of the last 120.
    assert items.count() < 2 * len(walk) and items.where(F.size("i.v") != 2).isEmpty()


def test_ridge_refuses_no_penalty(spark, walk):
    with pytest.raises(ValueError):
        ridge.fit(spark.createDataFrame(walk), ["close"], penalty=0)


# --- recursive forecasts -----------------------------------------------------------------------


def plain_loop(walk, params, cols, length, test, guess):
    out = {}
    for symbol, part in walk.groupby("symbol"):
        if len(part) < length + test:
            continue
        p = params.loc[symbol]
        scaled = np.stack([(part[c] - p[f"{c}_shift"]) / p[f"{c}_scale"] for c in cols], axis=1)
        window, guesses = list(scaled[-length - test:-test]), []
        for row in scaled[-test:]:
            guesses.append(guess(symbol, np.concatenate(window)))
            window = window[1:] + [np.array([guesses[-1] if c == "close" else v for c, v in zip(cols, row)])]
        out[symbol] = np.array(guesses) * p["close_scale"] + p["close_shift"]
    return out


def test_recursive_ridge_and_trees_equal_a_plain_loop(spark, walk):
    cols, length, test = ["close", "volume"], 6, 30
    kept = walk[walk["symbol"].isin(["A", "B"])]
    rows = forecast.study_rows(spark.createDataFrame(kept), cols, test, 200).cache()
    params = forecast.fit_study_scalers(rows, cols)
    fitted = params.toPandas().set_index("symbol")
    scaled = scale.apply(rows.where("part = 'train'"), params, cols)
    models = ridge.fit(scaled, cols, length=length)
    own = {r.symbol: (np.array(r.weights), r.bias) for r in models.collect()}
    loops = {"ridge": (forecast.recursive_ridge(models, rows, params, cols, length, test),
                       lambda s, w: float(own[s][0] @ w + own[s][1]))}

    windows_ = forecast.sequence_samples(rows, params, cols, length).where("part = 'train'")
    flat = windows_.select("symbol", "date", "y", *[
        F.element_at(F.flatten("x"), i + 1).alias(f"x{i}") for i in range(length * len(cols))])
    names = [f"x{i}" for i in range(length * len(cols))]
    forests = trees.fit(flat, names, "y", trees.Growth(trees=5, depth=4)).cache()
    listed = {r.symbol: r.trees for r in forests.collect()}

    def walked(found, window):
        total = 0.0
        for tree in found:
            at = 0
            while tree.feature[at] >= 0:
                at = tree.left[at] if window[tree.feature[at]] <= tree.threshold[at] else tree.right[at]
            total += tree.value[at]
        return total / len(found)

    loops["trees"] = (forecast.recursive_trees(forests, rows, params, cols, 4, length, test),
                      lambda s, w: walked(listed[s], w))
    ml = Pipeline(stages=[
        VectorAssembler(inputCols=names, outputCol="v"),
        RandomForestRegressor(featuresCol="v", labelCol="y", numTrees=4, maxDepth=3, seed=1)]).fit(flat).stages[-1]
    one = trees.from_ml(ml, spark).cache()
    pooled = one.first().trees
    loops["ml"] = (forecast.recursive_trees(one, rows, params, cols, 3, length, test), lambda s, w: walked(pooled, w))
    # One step equals Spark ML's own prediction.
    vectors = VectorAssembler(inputCols=names, outputCol="v").transform(flat)
    steps = ml.transform(vectors).join(one).select(
        "prediction", trees.walked(F.col("trees"), F.array(*names), 3).alias("walked"))
    assert steps.count() > 300 and steps.where(F.abs(F.col("walked") - F.col("prediction")) > 1e-12).isEmpty()
    for name, (frame_, guess) in loops.items():
        got = frame_.toPandas()
        for symbol, expected in plain_loop(kept, fitted, cols, length, test, guess).items():
            series = got[got["symbol"] == symbol].sort_values("date")["predicted"].to_numpy()
            np.testing.assert_allclose(series, expected, rtol=1e-9, err_msg=name)


def test_pooled_forest_does_not_depend_on_where_rows_lie(spark, frame, tmp_path, monkeypatch):
    rows = spark.createDataFrame(frame).select(
        "symbol", "date", F.col("a").alias("a_z"), F.col("b").alias("b_z"), F.col("target").alias("target_z"))
    monkeypatch.setattr(forecast, "FOREST_TREES", 4, raising=False)
    monkeypatch.setattr(forecast, "FOREST_ROWS", 1000, raising=False)
    found = []
    for laid in (rows.repartition(7), rows.orderBy("date").coalesce(1)):
        model = forecast.fit_forest(laid.cache(), ["a", "b"], trees=10, depth=5)
        shares = forecast.importance(model, ["a", "b"])
        assert sum(shares.values()) == pytest.approx(1) and shares["a"] > shares["b"] > 0
        found.append((shares, model.transform(rows).orderBy("symbol", "date").toPandas()["predicted"]))
    assert found[0][0] == found[1][0] and (found[0][1] == found[1][1]).all()

    # The model predicts the mean of all trees, also when it was saved and read again.
    model.write().save(f"{tmp_path}/model")
    again = PipelineModel.load(f"{tmp_path}/model").transform(rows)
    assert again.columns == [*rows.columns, "features", "predicted"]
    one = trees.from_ml(model, spark).cache()
    assert len(one.first().trees) == 10
    steps = again.join(one).select("predicted", trees.walked(F.col("trees"), F.array("a_z", "b_z"), 5).alias("walked"))
    assert steps.count() == len(frame) and steps.where(F.abs(F.col("walked") - F.col("predicted")) > 1e-12).isEmpty()


def test_plan_of_a_model_per_symbol(spark):
    rng = np.random.default_rng(5)
    parts = []
    for symbol, n in (("A", 400), ("B", 300)):
        close = 100 + np.cumsum(rng.normal(size=n))
        parts.append(pd.DataFrame({
            "symbol": symbol, "date": [dt.date(2020, 1, 1) + dt.timedelta(days=i) for i in range(n)],
            "open": close, "high": close + 1, "low": close - 1, "close": close, "volume": 5.0 + rng.random(n)}))
    bars = spark.createDataFrame(pd.concat(parts), BARS)
    found = daily.train_each(bars, growth=trees.Growth(trees=10, depth=6))
    scores = {r.symbol: r for r in found.metrics.collect()}
    assert scores["A"].n == 80 and scores["B"].n == 60 and all(0 < r.mape < 5 for r in scores.values())
    assert {r.symbol for r in found.next_day.collect()} == {"A", "B"}
    shares = found.importance.groupBy("symbol").agg(F.sum("importance").alias("s")).collect()
    assert all(r.s == pytest.approx(1) for r in shares)
