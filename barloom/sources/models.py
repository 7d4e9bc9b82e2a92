"""Saved models with their scaler parameters and a metadata row."""

from __future__ import annotations

import json
import uuid

from pyspark.ml import Model
from pyspark.ml.util import DefaultParamsReader
from pyspark.sql import DataFrame, SparkSession

from barloom.functions import columns as C
from barloom.schemas import MODEL_META
from barloom.session import Files


def _name(ticker: str, feature_set: str) -> str:
    return f"{C.safe_text(ticker)}_{C.safe_text(feature_set)}"


def save(
    model: Model,
    params: DataFrame,
    root: str,
    ticker: str,
    feature_set: str,
    cols: list[str],
    created: str,
) -> dict:
    """Write model and scaler table into a version folder of their own, then the metadata that name it.

    Versions are never changed. The metadata are one file, put in the place of the earlier one last
    and in one step: a save that breaks off leaves the earlier model, scalers and metadata together.
    """
    spark, name = params.sparkSession, _name(ticker, feature_set)
    version = f"{root}/models/{name}/v-{uuid.uuid4().hex}"
    meta = {
        "ticker": ticker,
        "feature_set": feature_set,
        "features": cols,
        "created_date": created,
        "model_path": f"{version}/model",
        "scaler_path": f"{version}/scalers",
    }
    model.write().save(meta["model_path"])
    params.write.parquet(meta["scaler_path"])
    files = Files(spark, root)
    draft = f"{root}/meta/_{uuid.uuid4().hex}"
    files.write(draft, (json.dumps(meta) + "\n").encode())
    files.replace(draft, f"{root}/meta/{name}.json")
    return meta


def metadata(spark: SparkSession, root: str, ticker: str, feature_set: str) -> dict:
    """The metadata of the newest complete save; an error when there is none."""
    found = spark.read.schema(MODEL_META).json(f"{root}/meta/{_name(ticker, feature_set)}.json").first()
    return found.asDict()


def load(spark: SparkSession, root: str, ticker: str, feature_set: str):
    """Model, of the kind that was saved, and scaler table, of one version; a missing file is an error."""
    meta = metadata(spark, root, ticker, feature_set)
    model = DefaultParamsReader.loadParamsInstance(meta["model_path"], spark)
    return model, spark.read.parquet(meta["scaler_path"])


def prune(spark: SparkSession, root: str, ticker: str, feature_set: str) -> int:
    """Delete the versions that the metadata do not name, when nobody reads or writes one; how many."""
    files, name = Files(spark, root), _name(ticker, feature_set)
    kept = metadata(spark, root, ticker, feature_set)["model_path"].split("/")[-2]
    old = [v for v in files.names(f"{root}/models/{name}") if v != kept]
    for version in old:
        files.delete(f"{root}/models/{name}/{version}")
    return len(old)
