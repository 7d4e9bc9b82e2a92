"""Fixed schemas. No reader in this package infers one."""

from pyspark.sql import types as T

PRICES = ["open", "high", "low", "close"]
OHLCV = [*PRICES, "volume"]

BARS = T.StructType(
    [T.StructField("symbol", T.StringType()), T.StructField("date", T.DateType())]
    + [T.StructField(name, T.DoubleType()) for name in OHLCV]
)

# Landed provider records: capitalised names, the date as text.
RECORD_FIELDS = ["Date", "Open", "High", "Low", "Close", "Volume"]
RECORDS = T.StructType(
    [T.StructField("Date", T.StringType())]
    + [T.StructField(name, T.DoubleType()) for name in RECORD_FIELDS[1:]]
)
# Text of a line the JSON reader could not parse.
CORRUPT = "_corrupt"
PROVIDER_EXTRAS = ["Dividends", "Stock Splits", "StockSplits"]

TICKS = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("props", T.StringType()),
])

MESSAGES = T.StructType([
    T.StructField("key", T.StringType()),
    T.StructField("value", T.StringType()),
])

# The field names of alerts, envelopes, model metadata and result documents.
ALERT = T.StructType([
    T.StructField("ticker", T.StringType()),
    T.StructField("current_price", T.DoubleType()),
    T.StructField("predicted_price", T.DoubleType()),
    T.StructField("price_diff_percent", T.DoubleType()),
    T.StructField("prediction_date", T.StringType()),
    T.StructField("last_update", T.StringType()),
    T.StructField("alert_timestamp", T.StringType()),
    T.StructField("alert_type", T.StringType()),
    T.StructField("direction", T.StringType()),
])

ENVELOPE = T.StructType([
    T.StructField("message", T.StringType()),
    T.StructField("timestamp", T.StringType()),
])

MODEL_META = T.StructType([
    T.StructField("ticker", T.StringType()),
    T.StructField("feature_set", T.StringType()),
    T.StructField("features", T.ArrayType(T.StringType())),
    T.StructField("created_date", T.StringType()),
    T.StructField("model_path", T.StringType()),
    T.StructField("scaler_path", T.StringType()),
])

RESULT = T.StructType([
    T.StructField("symbol", T.StringType()),
    T.StructField("metrics", T.StructType([
        T.StructField("Close", T.StructType([
            T.StructField("RMSE", T.DoubleType()),
            T.StructField("MAE", T.DoubleType()),
            T.StructField("MAPE", T.DoubleType()),
        ])),
    ])),
    T.StructField("next_day_prediction", T.StructType([
        T.StructField("Pred_Close", T.DoubleType()),
    ])),
    T.StructField("feature_importance", T.MapType(T.StringType(), T.DoubleType())),
    T.StructField("prediction_date", T.StringType()),
    T.StructField("timestamp", T.StringType()),
])
