"""ANSI SQL for the queries, as DuckDB runs it on the same tables."""

from __future__ import annotations

from barloom.schemas import OHLCV

STAMP_TEXT = "'2024-01-31T12:00:00'"

BARS = """bars AS MATERIALIZED (
  SELECT symbol, date,
         first(price ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey) AS open,
         max(price) AS high, min(price) AS low,
         last(price ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey) AS close,
         sum(l_quantity) AS volume
  FROM (SELECT l_returnflag AS symbol, CAST(l_shipdate AS DATE) AS date,
               l_extendedprice / l_quantity AS price, * FROM lineitem)
  GROUP BY symbol, date)"""

DAILY = """daily AS MATERIALIZED (
  SELECT event_type AS symbol, CAST(ts AS DATE) AS date,
         first(value ORDER BY ts, event_id) AS open, max(value) AS high, min(value) AS low,
         last(value ORDER BY ts, event_id) AS close, count(value) AS volume
  FROM events GROUP BY ALL)"""

W = "PARTITION BY symbol ORDER BY date"


def with_bars(body: str, *ctes: str, recursive: bool = False) -> str:
    head = "WITH RECURSIVE " if recursive else "WITH "
    return head + ",\n".join([BARS, *ctes]) + "\n" + body


def r4(expr: str, name: str) -> str:
    return f"floor(({expr}) * 10000 + 0.50001) / 10000 AS {name}"


def cols(names=OHLCV) -> str:
    return ", ".join(r4(n, n) for n in names)


def mean(col: str, n: int) -> str:
    frame = f"({W} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"
    return f"CASE WHEN count({col}) OVER {frame} = {n} THEN avg({col}) OVER {frame} END"


def before(col: str, n: int) -> str:
    frame = f"({W} ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING)"
    return f"CASE WHEN count({col}) OVER {frame} = {n} THEN avg({col}) OVER {frame} END"


def lag(col: str, k: int = 1) -> str:
    return f"lag({col}, {k}) OVER ({W})"


def pct(col: str, k: int = 1) -> str:
    return f"({col} / {lag(col, k)} - 1) * 100"


def diff(col: str) -> str:
    return f"{col} - {lag(col)}"


def diff2(col: str) -> str:
    return f"({col} - {lag(col)}) - ({lag(col)} - {lag(col, 2)})"


def nextvalue(col: str) -> str:
    return (f"first_value({col} IGNORE NULLS) OVER "
            f"({W} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)")


def ema(source: str = "bars") -> list[str]:
    """Averages with spans 9, 12, 26 and the signal line, row after row."""
    return [
        f"numbered AS MATERIALIZED (SELECT *, row_number() OVER ({W}) AS rn FROM {source})",
        """ema AS (
  SELECT symbol, date, rn, close AS e9, close AS e12, close AS e26, CAST(0 AS DOUBLE) AS signal
  FROM numbered WHERE rn = 1
  UNION ALL
  SELECT symbol, date, rn, e9, e12, e26, 0.2 * (e12 - e26) + 0.8 * signal
  FROM (SELECT n.symbol, n.date, n.rn,
               0.2 * n.close + 0.8 * e.e9 AS e9,
               2.0 / 13 * n.close + 11.0 / 13 * e.e12 AS e12,
               2.0 / 27 * n.close + 25.0 / 27 * e.e26 AS e26,
               e.signal
        FROM ema e JOIN numbered n ON n.symbol = e.symbol AND n.rn = e.rn + 1))""",
    ]


def rsi(source: str = "bars") -> list[str]:
    frame = f"({W} ROWS BETWEEN 13 PRECEDING AND CURRENT ROW)"
    return [
        f"""moves AS (SELECT symbol, date, {diff('close')} AS delta,
  row_number() OVER ({W}) AS rn FROM {source})""",
        f"""means AS (SELECT symbol, date, rn,
  avg(CASE WHEN delta > 0 THEN delta ELSE 0 END) OVER {frame} AS gain,
  avg(CASE WHEN delta < 0 THEN -delta ELSE 0 END) OVER {frame} AS loss FROM moves)""",
        """rsis AS (SELECT symbol, date, CASE WHEN rn < 14 THEN NULL
  WHEN loss = 0 THEN CASE WHEN gain > 0 THEN 100.0 END
  ELSE 100 - 100 / (1 + gain / loss) END AS rsi FROM means)""",
    ]


def training(source: str = "bars") -> list[str]:
    filled = ["ma5", "ma20", "ma60", "volume_ma5", "daily_return", "weekly_return", "rsi", "macd",
              "signal_line"]
    return [
        *ema(source),
        *rsi(source),
        f"""raw AS (SELECT b.symbol, b.date, open, high, low, close, volume,
  {mean('close', 5)} AS ma5, {mean('close', 20)} AS ma20, {mean('close', 60)} AS ma60,
  {mean('volume', 5)} AS volume_ma5, {pct('close')} AS daily_return,
  {pct('close', 5)} AS weekly_return FROM {source} b)""",
        f"""training AS (SELECT symbol, date, open, high, low, close, volume,
  high - low AS price_range, close - open AS price_change,
  {', '.join(f'{nextvalue(c)} AS {c}' for c in filled)}
  FROM (SELECT raw.*, rsi, e12 - e26 AS macd, signal AS signal_line
        FROM raw JOIN ema USING (symbol, date) JOIN rsis USING (symbol, date)))""",
    ]


GAPS = """gaps AS MATERIALIZED (SELECT * REPLACE (
  CASE WHEN day(date) IN (3, 4, 17) THEN NULL ELSE close END AS close) FROM bars)"""
PADDED = f"""padded AS (SELECT symbol, date, last_value(close IGNORE NULLS) OVER
  ({W} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS known FROM gaps)"""


def ema_gaps() -> list[str]:
    """Averages with spans 12, 26 and the signal line where closes are missing, row after row.

    `age` counts the rows since the last known close; the old average keeps q ^ age against 1 - q.
    """
    def aged(old, q):
        kept = f"power({q}, age + 1)"
        return (f"CASE WHEN n.close IS NULL THEN {old} WHEN {old} IS NULL THEN n.close ELSE "
                f"({kept} * {old} + (1 - {q}) * n.close) / ({kept} + 1 - {q}) END")

    return [
        f"numbered AS MATERIALIZED (SELECT *, row_number() OVER ({W}) AS rn FROM gaps)",
        f"""ema AS (
  SELECT symbol, date, rn, close AS e12, close AS e26, CAST(0 AS BIGINT) AS age,
         CASE WHEN close IS NOT NULL THEN CAST(0 AS DOUBLE) END AS signal
  FROM numbered WHERE rn = 1
  UNION ALL
  SELECT symbol, date, rn, e12, e26, age,
         CASE WHEN signal IS NULL THEN e12 - e26 ELSE 0.2 * (e12 - e26) + 0.8 * signal END
  FROM (SELECT n.symbol, n.date, n.rn,
               {aged('e.e12', '(11.0 / 13)')} AS e12, {aged('e.e26', '(25.0 / 27)')} AS e26,
               CASE WHEN n.close IS NULL THEN age + 1 ELSE 0 END AS age, e.signal
        FROM ema e JOIN numbered n ON n.symbol = e.symbol AND n.rn = e.rn + 1))""",
    ]


def training_gaps() -> list[str]:
    filled = [c for c in TRAINING_COLS]
    return [
        GAPS, PADDED, *ema_gaps(), *rsi("gaps"),
        f"""raw AS (SELECT b.symbol, b.date, open, high, low, close, volume,
  high - low AS price_range, close - open AS price_change,
  {mean('close', 5)} AS ma5, {mean('close', 20)} AS ma20, {mean('close', 60)} AS ma60,
  {mean('volume', 5)} AS volume_ma5 FROM gaps b)""",
        f"""returns AS (SELECT symbol, date, {pct('known')} AS daily_return,
  {pct('known', 5)} AS weekly_return FROM padded)""",
        f"""training AS (SELECT symbol, date, {', '.join(f'{nextvalue(c)} AS {c}' for c in filled)}
  FROM (SELECT raw.*, daily_return, weekly_return, rsi, e12 - e26 AS macd, signal AS signal_line
        FROM raw JOIN returns USING (symbol, date) JOIN ema USING (symbol, date)
        JOIN rsis USING (symbol, date)))""",
    ]


def indicators() -> list[str]:
    base = ["close", "open", "high", "low", "volume"]
    return [
        *ema(),
        *rsi(),
        f"""raw AS (SELECT symbol, date, open, high, low, close, volume,
  {mean('close', 5)} AS sma_5, {mean('close', 20)} AS sma_20, {mean('close', 60)} AS sma_60,
  {', '.join(f'{diff(c)} AS {c}_diff' for c in base)},
  {', '.join(f'{diff2(c)} AS {c}_diff2' for c in base)},
  {', '.join(f'{pct(c)} AS {c}_change' for c in base)},
  (high - low) / close * 100 AS hl_ratio FROM bars)""",
        """indicators AS (SELECT raw.*, e12 - e26 AS macd, signal, e12 - e26 - signal AS histogram, rsi
  FROM raw JOIN ema USING (symbol, date) JOIN rsis USING (symbol, date)
  WHERE sma_60 IS NOT NULL AND rsi IS NOT NULL)""",
    ]


TRAINING_COLS = [*OHLCV, "ma5", "ma20", "ma60", "volume_ma5", "daily_return", "weekly_return",
                 "rsi", "macd", "signal_line", "price_range", "price_change"]
_BASE = ["close", "open", "high", "low", "volume"]
_TECH = ["sma_5", "sma_20", "sma_60", "rsi", "macd", "hl_ratio"]
INDICATOR_COLS = [*OHLCV, *_TECH, "signal", "histogram", *[f"{c}_diff" for c in _BASE],
                  *[f"{c}_diff2" for c in _BASE], *[f"{c}_change" for c in _BASE]]

BACK = f"""back AS (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY date DESC) AS back
  FROM bars)"""
PARTS = """parts AS (SELECT *, CASE WHEN back <= 30 THEN 'test' ELSE 'train' END AS part
  FROM back WHERE back <= 450)"""

def _split(name: str, rows: str, key: str) -> str:
    """The best split of each node of `rows` (symbol, node, month, day, y), and the rows below it."""
    return f"""{name}_best AS (
  SELECT symbol, {key}, f, border FROM (
    SELECT symbol, {key}, f, border, count(*) FILTER (v <= border) AS a, count(*) FILTER (v > border) AS b,
           sum(y) FILTER (v <= border) AS s, sum(y) FILTER (v > border) AS t
    FROM (SELECT *, unnest([0, 1]) AS f, unnest([month, day]) AS v FROM {rows}), range(0, 12) r(border)
    GROUP BY ALL)
  WHERE a >= 2 AND b >= 2
  QUALIFY row_number() OVER (PARTITION BY symbol, {key} ORDER BY s * s / a + t * t / b DESC, f, border) = 1),
{name} AS (
  SELECT r.* EXCLUDE ({key}), 2 * r.{key} + CASE WHEN CASE f WHEN 0 THEN month ELSE day END > border
         THEN 1 ELSE 0 END AS {key}
  FROM {rows} r JOIN {name}_best USING (symbol, {key}))"""


OVERLAP = """old AS (SELECT *, 'a' AS source FROM bars WHERE date <= DATE '2000-06-30'),
incoming AS (SELECT symbol, date, open, high, low,
    CASE WHEN date <= DATE '2000-06-30' THEN close + 1 ELSE close END AS close, volume,
    'b' AS source
  FROM bars WHERE date >= DATE '2000-06-21')"""
MERGED = """merged AS (SELECT * EXCLUDE (place) FROM (
  SELECT *, row_number() OVER (PARTITION BY symbol, date ORDER BY source) AS place
  FROM (SELECT * FROM old UNION ALL BY NAME SELECT * FROM incoming)) WHERE place = 1)"""

GUESSES = f"""guesses AS (SELECT symbol, date, close AS actual,
  row_number() OVER (PARTITION BY symbol ORDER BY date DESC) AS back,
  {before('close', 1)} AS last_close, {before('close', 5)} AS sma_5,
  {before('close', 20)} AS sma_20, {before('close', 60)} AS sma_60 FROM bars)"""
WALK = """walk AS (
  SELECT symbol, date, actual, feature_set, predicted FROM guesses
  UNPIVOT (predicted FOR feature_set IN (last_close, sma_5, sma_20, sma_60))
  WHERE back <= 30)"""
NEXT_DAY = """next_day AS (
  SELECT symbol, max(date) + 1 AS prediction_date, arg_max(close, date) AS current_close,
         CASE WHEN count(close) = 5 THEN avg(close) END AS predicted_close
  FROM back WHERE back <= 5 GROUP BY symbol)"""


def errors(by: str) -> str:
    return f"""SELECT {by}, {r4('sqrt(avg(power(actual - predicted, 2)))', 'rmse')},
  {r4('avg(abs(actual - predicted))', 'mae')},
  {r4('avg(abs((actual - predicted) / nullif(actual, 0))) * 100', 'mape')}"""


HELD = ["""targets AS (SELECT * FROM (SELECT symbol, date,
  lead(close) OVER (PARTITION BY symbol ORDER BY date) AS target FROM bars) WHERE target IS NOT NULL)""",
        """held AS (SELECT symbol, date, CASE WHEN place <= ceil(round(n * 0.2, 6)) THEN 'test' ELSE 'train' END
  AS part
FROM (SELECT symbol, date, count(*) OVER (PARTITION BY symbol) AS n,
        row_number() OVER (PARTITION BY symbol
          ORDER BY md5(symbol || '|' || strftime(date, '%Y-%m-%d') || '|42')) AS place
      FROM targets))"""]


PREDICTIONS = f"""predictions AS (SELECT * FROM (
  SELECT symbol, date + 1 AS prediction_date, {mean('close', 5)} AS predicted FROM daily)
  WHERE predicted IS NOT NULL)"""
ALERTS = """alerts AS (
  SELECT event_type AS ticker, value AS current_price, predicted AS predicted_price,
         abs(predicted - value) / nullif(value, 0) * 100 AS price_diff_percent,
         strftime(prediction_date, '%Y-%m-%d') AS prediction_date,
         strftime(ts, '%Y-%m-%d %H:%M:%S') AS last_update,
         '2024-01-31T12:00:00' AS alert_timestamp,
         'intraday_price_difference' AS alert_type,
         CASE WHEN predicted > value THEN 'up' ELSE 'down' END AS direction
  FROM events e JOIN predictions p
    ON e.event_type = p.symbol AND CAST(e.ts AS DATE) = p.prediction_date
  WHERE abs(predicted - value) / nullif(value, 0) * 100 >= 1.0)"""
ALERT_COLS = f"""ticker, {r4('current_price', 'current_price')},
  {r4('predicted_price', 'predicted_price')}, {r4('price_diff_percent', 'price_diff_percent')},
  prediction_date, last_update, alert_timestamp, alert_type, direction"""

BARS_240M = f"""SELECT event_type AS symbol, time_bucket(INTERVAL '240 minutes', ts) AS window_start,
  time_bucket(INTERVAL '240 minutes', ts) + INTERVAL '240 minutes' AS window_end,
  {r4('first(value ORDER BY ts, event_id)', 'open')}, {r4('max(value)', 'high')},
  {r4('min(value)', 'low')}, {r4('last(value ORDER BY ts, event_id)', 'close')},
  count(value) AS ticks FROM events GROUP BY ALL"""

ENVELOPES = """SELECT concat(epoch_us(ts) // 1000000, '.', lpad(CAST(epoch_us(ts) % 1000000 AS VARCHAR), 6, '0'))
    AS key,
  concat(event_type, ' ', event_id) AS message,
  strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS timestamp FROM events"""

RECURSIVE = f"""start AS (
  SELECT symbol, list(close ORDER BY date) AS seen FROM back
  WHERE back > 30 AND back <= 35 GROUP BY symbol HAVING count(*) = 5),
steps AS (
  SELECT symbol, 0 AS step, seen FROM start
  UNION ALL
  SELECT symbol, step + 1, list_append(seen[2:], list_sum(seen) / 5) FROM steps WHERE step < 30)"""


def _standard(c: str) -> str:
    return f"(p.{c} - s.{c}_shift) / s.{c}_scale"


ORACLE = {
    "src_bars": with_bars(f"SELECT symbol, date, {cols()} FROM bars"),
    "src_range_90d": with_bars(
        f"SELECT symbol, date, {cols()} FROM bars "
        "WHERE date >= DATE '2001-11-05' - 90 AND date < DATE '2001-11-05'"),
    "src_monthly_json": with_bars(f"SELECT symbol, date, {cols()} FROM bars"),
    "src_landed_layout": with_bars(
        f"SELECT symbol, date, {cols()}, strftime(date, '%Y-%m') AS year_month FROM bars"),
    "src_incremental_landing": with_bars(
        """SELECT 1 AS ingest, symbol, count(DISTINCT month) AS files, count(*) AS bars FROM months
WHERE date <= DATE '1998-05-15' GROUP BY symbol
UNION ALL
SELECT 2 AS ingest, symbol, count(DISTINCT month) AS files, count(*) FILTER (date > DATE '1998-05-15') AS bars
FROM months WHERE date >= DATE '1998-05-01' GROUP BY symbol""",
        "months AS (SELECT *, strftime(date, '%Y-%m') AS month FROM bars)"),
    "src_jsonl_roundtrip": with_bars(f"SELECT symbol, date, {cols()} FROM bars"),
    "src_csv_roundtrip": with_bars(f"SELECT symbol, date, {cols()} FROM bars"),
    "src_ticker_from_path": with_bars(
        "SELECT '^' || symbol AS symbol, count(*) AS bars, "
        f"{r4('sum(volume)', 'volume')} FROM bars GROUP BY symbol"),
    "prj_normalise": with_bars(f"SELECT symbol, date, {cols()} FROM bars"),
    "upsert_month_merge": with_bars(
        f"SELECT symbol, date, {cols()}, strftime(date, '%Y-%m') AS year_month FROM merged",
        OVERLAP, MERGED),
    "month_split": with_bars(
        "SELECT symbol, strftime(date, '%Y-%m') AS year_month, count(*) AS bars, "
        "min(date) AS first_date, max(date) AS last_date, "
        f"{r4('sum(volume)', 'volume')} FROM bars GROUP BY ALL"),
    "publish_roundtrip": with_bars(
        f"SELECT symbol, date, {cols()}, strftime(date, '%Y-%m') AS year_month FROM bars"),
    "merge_combined": with_bars(f"SELECT symbol, date, {cols()} FROM merged", OVERLAP, MERGED),
    "result_document": with_bars(
        f"""SELECT symbol, rmse, mae, mape, {r4('predicted_close', 'pred_close')},
  CAST(1.0 AS DOUBLE) AS importance_close,
  strftime(prediction_date, '%Y-%m-%d') AS prediction_date, {STAMP_TEXT} AS timestamp
FROM ({errors('symbol')} FROM walk WHERE feature_set = 'sma_5' GROUP BY symbol)
JOIN next_day USING (symbol)""", GUESSES, WALK, BACK, NEXT_DAY),
    "clean_records": with_bars(
        f"""SELECT symbol, CASE day(date) WHEN 13 THEN 'no date' WHEN 7 THEN 'missing value'
  WHEN 9 THEN 'missing value' ELSE 'good' END AS reason,
  count(*) AS records, {r4('sum(volume)', 'volume')} FROM bars GROUP BY ALL"""),
    "clean_lines": with_bars(
        f"""SELECT symbol, CASE day(date) WHEN 13 THEN 'unreadable line' WHEN 9 THEN 'pair' ELSE 'good' END
    AS reason,
  CAST(sum(CASE day(date) WHEN 7 THEN 2 ELSE 1 END) AS BIGINT) AS records,
  CASE WHEN max(day(date)) FILTER (day(date) = 13) = 13 THEN NULL ELSE
  {r4('sum(CASE day(date) WHEN 7 THEN 2 ELSE 1 END * volume)', 'volume').removesuffix(' AS volume')} END AS volume
FROM bars GROUP BY 1, 2"""),
    "incr_new_rows": with_bars(
        f"""SELECT symbol, date, {cols()} FROM incoming
LEFT JOIN (SELECT symbol, max(date) AS last_date FROM old GROUP BY symbol) USING (symbol)
WHERE last_date IS NULL OR date > last_date""", OVERLAP),
    "high_water": with_bars("SELECT symbol, max(date) AS last_date FROM bars GROUP BY symbol"),
    "feat_set_rf": with_bars(
        f"SELECT symbol, date, {cols(['close', 'volume', 'macd', 'signal_line'])} FROM training",
        *training(), recursive=True),
    "feat_set_base_tech": with_bars(
        f"SELECT symbol, date, {cols([*_BASE, *_TECH])} FROM indicators",
        *indicators(), recursive=True),
    "ind_complete_rows": with_bars(
        f"SELECT symbol, date, {cols(_TECH)} FROM indicators", *indicators(), recursive=True),
    "ind_sma": with_bars("SELECT symbol, date, " + ", ".join(
        r4(mean("close", n), f"sma_{n}") for n in (5, 20, 60)) + " FROM bars"),
    "ind_volume_ma": with_bars(
        f"SELECT symbol, date, {r4(mean('volume', 5), 'volume_ma5')} FROM bars"),
    "ind_diff": with_bars("SELECT symbol, date, " + ", ".join(
        r4(diff(c), f"{c}_diff") for c in OHLCV) + " FROM bars"),
    "ind_diff2": with_bars("SELECT symbol, date, " + ", ".join(
        r4(diff2(c), f"{c}_diff2") for c in OHLCV) + " FROM bars"),
    "ind_pct_change": with_bars("SELECT symbol, date, " + ", ".join(
        r4(pct(c), f"{c}_change") for c in OHLCV) + " FROM bars"),
    "ind_returns": with_bars(
        f"SELECT symbol, date, {r4(pct('close'), 'daily_return')}, "
        f"{r4(pct('close', 5), 'weekly_return')} FROM bars"),
    "ind_rsi": with_bars(f"SELECT symbol, date, {r4('rsi', 'rsi')} FROM rsis", *rsi()),
    "ind_rsi_flags": with_bars(
        """SELECT symbol, date, rsi, CASE WHEN rsi > 70 THEN 'overbought'
  WHEN rsi < 30 THEN 'oversold' END AS level
FROM (SELECT symbol, date, floor(rsi * 10000 + 0.50001) / 10000 AS rsi FROM rsis)""", *rsi()),
    "ind_ema": with_bars("SELECT symbol, date, " + ", ".join(
        r4(f"e{n}", f"ema_{n}") for n in (9, 12, 26)) + " FROM ema", *ema(), recursive=True),
    "ind_macd": with_bars(
        f"SELECT symbol, date, {r4('e12 - e26', 'macd')}, {r4('signal', 'signal')}, "
        f"{r4('e12 - e26 - signal', 'histogram')} FROM ema", *ema(), recursive=True),
    "ind_ema_gaps": with_bars(
        f"SELECT symbol, date, {r4('e12', 'ema_12')}, {r4('e26', 'ema_26')} FROM ema",
        GAPS, *ema_gaps(), recursive=True),
    "ind_pct_change_gaps": with_bars(
        f"SELECT symbol, date, {r4(pct('known'), 'change_1')}, {r4(pct('known', 5), 'change_5')} "
        "FROM padded", GAPS, PADDED),
    "feat_training_gaps": with_bars(
        f"SELECT symbol, date, {cols(TRAINING_COLS)} FROM training", *training_gaps(), recursive=True),
    "feat_bfill": with_bars(
        "SELECT symbol, date, " + ", ".join(
            r4(nextvalue(c), c) for c in ("ma20", "change", "low_seldom"))
        + f""" FROM (SELECT symbol, date, {mean('close', 20)} AS ma20, {pct('close')} AS change,
  CASE WHEN day(date) = 15 THEN low END AS low_seldom FROM bars)"""),
    "feat_target": with_bars(
        f"""SELECT symbol, date, {r4('close', 'close')}, {r4('target', 'target')}
FROM (SELECT *, lead(close) OVER ({W}) AS target FROM bars) WHERE target IS NOT NULL"""),
    "feat_price": with_bars(
        f"SELECT symbol, date, {r4('high - low', 'price_range')}, "
        f"{r4('close - open', 'price_change')}, {r4('(high - low) / close * 100', 'hl_ratio')} "
        "FROM bars"),
    "feat_training": with_bars(
        f"SELECT symbol, date, {cols(TRAINING_COLS)} FROM training", *training(), recursive=True),
    "feat_indicators": with_bars(
        f"SELECT symbol, date, {cols(INDICATOR_COLS)} FROM indicators",
        *indicators(), recursive=True),
    "feat_serving_90d": with_bars(
        f"""SELECT symbol, date, {cols([*OHLCV, 'ma5', 'ma20', 'ma60', 'volume_ma5', 'macd',
                                        'signal_line'])} FROM training""",
        "recent AS (SELECT * FROM bars WHERE date >= DATE '2001-11-05' - 90 "
        "AND date < DATE '2001-11-05')", *training("recent"), recursive=True),
    "seq_windows": with_bars(
        f"""SELECT symbol, date, 120 AS length, {r4(lag('close', 120), 'first_close')},
  {r4(lag('close'), 'last_close')}, {r4(lag('volume'), 'last_volume')},
  {r4(before('close', 120), 'mean_close')}, {r4('close', 'y')} FROM bars
QUALIFY row_number() OVER ({W}) > 120"""),
    "seq_last_window": with_bars(
        f"""SELECT symbol, CAST(150 - back AS INTEGER) AS place, {cols(['close', 'volume'])}
FROM back WHERE back > 30 AND back <= 150""", BACK),
    "latest_bar": with_bars(f"SELECT symbol, date, {cols()} FROM back WHERE back = 1", BACK),
    "split_tail": with_bars(
        f"SELECT symbol, date, {r4('close', 'close')}, part FROM parts", BACK, PARTS),
    "split_random": with_bars(
        """SELECT symbol, date, CASE WHEN place <= ceil(round(n * 0.2, 6)) THEN 'test' ELSE 'train' END
  AS part
FROM (SELECT symbol, date, count(*) OVER (PARTITION BY symbol) AS n,
        row_number() OVER (PARTITION BY symbol
          ORDER BY md5(symbol || '|' || strftime(date, '%Y-%m-%d') || '|42')) AS place
      FROM bars)"""),
    "scale_standard": with_bars(
        f"""SELECT symbol, p.date, part, {r4(_standard('close'), 'close_z')},
  {r4(_standard('volume'), 'volume_z')}, {r4('close', 'close_back')}
FROM parts p JOIN (SELECT symbol, avg(close) AS close_shift, stddev_pop(close) AS close_scale,
  avg(volume) AS volume_shift, stddev_pop(volume) AS volume_scale
  FROM parts WHERE part = 'train' GROUP BY symbol) s USING (symbol)""", BACK, PARTS),
    "scale_minmax": with_bars(
        f"""SELECT symbol, p.date, part, {r4(_standard('close'), 'close_s')},
  {r4(_standard('volume'), 'volume_s')}, CAST(0 AS DOUBLE) AS constant_s
FROM parts p JOIN (SELECT symbol, min(close) AS close_shift,
  max(close) - min(close) AS close_scale, min(volume) AS volume_shift,
  max(volume) - min(volume) AS volume_scale
  FROM parts WHERE part = 'train' GROUP BY symbol) s USING (symbol)""", BACK, PARTS),
    "metrics_naive": with_bars(
        f"""{errors('symbol')}, count(*) AS n, CAST(count_if(actual = 0) AS BIGINT) AS zero_actuals
FROM (SELECT symbol, actual, last_close AS predicted FROM guesses WHERE last_close IS NOT NULL)
GROUP BY symbol""", GUESSES),
    "rank_feature_sets": with_bars(
        f"""SELECT symbol, feature_set, {r4('mape', 'mape')}, runs,
  CAST(row_number() OVER (PARTITION BY symbol ORDER BY mape, feature_set) AS INTEGER) AS place
FROM (SELECT symbol, feature_set, avg(mape) AS mape, count(*) AS runs
      FROM (SELECT symbol, feature_set, run, avg(abs((actual - predicted) / actual)) * 100 AS mape
            FROM walk, range(1, 4) r(run)
            WHERE CAST('0x' || substr(md5(symbol || '|' || strftime(date, '%Y-%m-%d')), 1, 7) AS BIGINT)
                  % 3 + 1 <> run GROUP BY ALL) GROUP BY ALL)""", GUESSES, WALK),
    "next_day_baseline": with_bars(
        f"""SELECT symbol, prediction_date, {r4('current_close', 'current_close')},
  {r4('predicted_close', 'predicted_close')} FROM next_day""", BACK, NEXT_DAY),
    "next_prediction_date": with_bars(
        """SELECT symbol, date, date + 1 AS next_day,
  date + CASE dayofweek(date) WHEN 5 THEN 3 WHEN 6 THEN 2 ELSE 1 END AS next_business_day
FROM back WHERE back = 1""", BACK),
    "walk_forward_baseline": with_bars(
        f"""SELECT symbol, date, {r4('actual', 'actual')}, feature_set,
  {r4('predicted', 'predicted')} FROM walk""", GUESSES, WALK),
    "recursive_baseline": with_bars(
        f"""SELECT symbol, date, {r4('close', 'actual')}, {r4('seen[5]', 'predicted')}
FROM steps JOIN back USING (symbol) WHERE step > 0 AND back = 31 - step""",
        BACK, RECURSIVE, recursive=True),
    "prediction_report": with_bars(
        f"""SELECT symbol, date, {r4('actual', 'actual')}, {r4('predicted', 'predicted')},
  {r4('actual - predicted', 'error')},
  {r4('(actual - predicted) / actual * 100', 'error_pct')}
FROM walk WHERE feature_set = 'sma_5'""", GUESSES, WALK),
    "prediction_response": with_bars(
        f"""SELECT symbol AS ticker, strftime(prediction_date, '%Y-%m-%d') AS prediction_date,
  {r4('predicted_close', 'predicted_close')}, {r4('current_close', 'current_close')},
  {STAMP_TEXT} AS prediction_timestamp, max(date) = prediction_date AS is_intraday,
  CAST(count(*) AS INTEGER) AS history_rows, min(date) AS history_first,
  {r4('sum(volume)', 'history_volume')}
FROM bars JOIN next_day USING (symbol)
WHERE date >= DATE '2001-11-05' - 90 AND date < DATE '2001-11-05'
GROUP BY symbol, next_day.prediction_date, predicted_close, current_close""", BACK, NEXT_DAY),
    "chart_feed": with_bars(
        f"""SELECT symbol, strftime(date, '%Y-%m-%d') AS time, {cols()},
  CASE WHEN close >= open THEN 'up' ELSE 'down' END AS color FROM bars"""),
    "change_info": with_bars(
        f"""SELECT symbol, prediction_date, {r4('current_close', 'current_close')},
  {r4('predicted_close', 'predicted_close')},
  {r4('predicted_close - current_close', 'change')},
  {r4('(predicted_close - current_close) / current_close * 100', 'percent_change')},
  predicted_close - current_close > 0 AS is_positive FROM next_day""", BACK, NEXT_DAY),
    "safe_names": with_bars(
        "SELECT DISTINCT symbol, symbol || '_X_base_tech' AS safe_name FROM bars"),
    "two_decimals": with_bars("SELECT symbol, date, " + ", ".join(
        f"printf('%.2f', floor({c} * 100 + 0.50001) / 100) AS {c}_text" for c in OHLCV) + " FROM bars"),
    "ml_rf_predict": with_bars(
        "SELECT symbol, count(*) AS n, CAST(0 AS BIGINT) AS zero_actuals, true AS holds "
        "FROM held WHERE part = 'test' GROUP BY symbol", *HELD),
    "ml_rf_importance": with_bars(
        """SELECT part, count(*) AS rows, feature, true AS sound
FROM held, (SELECT unnest(['close', 'volume', 'macd', 'signal_line']) AS feature) GROUP BY ALL""", *HELD),
    "ml_next_day": with_bars(
        f"""SELECT symbol, date + 1 AS prediction_date, {r4('close', 'current_close')}, true AS near
FROM back WHERE back = 1""", BACK),
    "ml_model_roundtrip": with_bars(
        f"""SELECT symbol, date + 1 AS prediction_date, {r4('close', 'current_close')}, true AS same
FROM back WHERE back = 1""", BACK),
    "ml_model_catalog": with_bars(
        """SELECT '^ALL' AS ticker, 'rf' AS feature_set, '2024-01-31 12:00:00' AS created_date,
  'close,volume,macd,signal_line' AS features, count(*) AS train_rows, count(DISTINCT symbol) AS symbols
FROM held WHERE part = 'train'""", *HELD),
    "ml_model_versions": with_bars(
        f"""SELECT symbol, {r4('min(close)', 'low')}, {r4('max(close) - min(close)', 'span')}, '^ALL' AS ticker,
  '2024-01-31 12:00:00' AS created_date, 2 AS lags, 2 AS weights
FROM parts WHERE part = 'train' GROUP BY symbol""", BACK, PARTS),
    "ml_seq_regression": with_bars(
        """SELECT symbol, count(*) - 120 AS n, CAST(0 AS BIGINT) AS zero_actuals, true AS holds
FROM bars GROUP BY symbol"""),
    "ml_walk_forward": with_bars(
        f"SELECT symbol, date, {r4('close', 'actual')}, true AS holds FROM back WHERE back <= 30", BACK),
    "ml_recursive_forecast": with_bars(
        f"SELECT symbol, date, {r4('close', 'actual')}, true AS holds FROM back WHERE back <= 30", BACK),
    "ml_rank": with_bars(
        """SELECT DISTINCT symbol, feature_set, CAST(3 AS BIGINT) AS runs, CAST(0 AS BIGINT) AS failed,
  true AS best_first, true AS sound
FROM bars, (SELECT unnest(['base', 'base_tech']) AS feature_set)"""),
    "ml_ridge_one_lag": with_bars(
        f"""SELECT symbol, date, {r4('close', 'actual')},
  {r4('(weight * x + bias) * scale + shift', 'predicted')}
FROM pairs, fitted WHERE part = 'test'""", BACK, PARTS,
        """spans AS (SELECT symbol, min(close) AS shift, max(close) - min(close) AS scale
  FROM parts WHERE part = 'train' GROUP BY symbol)""",
        f"""pairs AS (SELECT *, (close - shift) / scale AS y, lag((close - shift) / scale) OVER ({W}) AS x
  FROM parts JOIN spans USING (symbol))""",
        """fitted AS (SELECT weight, mean_y - weight * mean_x AS bias FROM (
  SELECT covar_pop(x, y) / (var_pop(x) + 0.01 / stddev_pop(y)) AS weight, avg(x) AS mean_x, avg(y) AS mean_y
  FROM pairs WHERE part = 'train' AND x IS NOT NULL))"""),
    "ml_tree_one_split": with_bars(
        f"""SELECT CAST(month AS INTEGER) AS month, {r4('CASE WHEN month <= border THEN low ELSE high END', 'predicted')}
FROM (SELECT DISTINCT month FROM months), (
  SELECT border, low, high FROM (
    SELECT border, avg(volume) FILTER (month <= border) AS low, avg(volume) FILTER (month > border) AS high,
           sum(volume) FILTER (month <= border) * low + sum(volume) FILTER (month > border) * high AS gain
    FROM months, range(1, 12) r(border) GROUP BY border) ORDER BY gain DESC LIMIT 1)""",
        "months AS (SELECT month(date) AS month, volume FROM bars)"),
    "ml_tree_per_symbol": with_bars(
        f"""SELECT 1 AS depth, symbol, month, day, {r4('value', 'predicted')} FROM (
  SELECT symbol, month, day, avg(y) OVER (PARTITION BY symbol, node) AS value FROM one) GROUP BY ALL
UNION ALL
SELECT 2 AS depth, symbol, month, day, {r4('value', 'predicted')} FROM (
  SELECT symbol, month, day, avg(y) OVER (PARTITION BY symbol, node) AS value FROM two) GROUP BY ALL""",
        """months AS (SELECT symbol, CAST(month(date) AS INTEGER) AS month,
  CAST(isodow(date) - 1 AS INTEGER) AS day, volume AS y, 1 AS node FROM bars)""",
        _split("one", "months", "node"), _split("two", "one", "node")),
    "ml_permutation_importance": with_bars(
        f"""SELECT symbol, feature, {r4('avg((y - other) * (y - other)) - avg((y - own) * (y - own))', 'importance')}
FROM (
  SELECT symbol, feature, y, CASE WHEN CASE f WHEN 0 THEN month ELSE day END <= border THEN low ELSE high END AS own,
         CASE WHEN CASE WHEN f = 0 AND feature = 'month' THEN other_month WHEN f = 1 AND feature = 'day' THEN other_day
                        WHEN f = 0 THEN month ELSE day END <= border THEN low ELSE high END AS other
  FROM dealt JOIN one_best USING (symbol) JOIN leaves USING (symbol),
       (SELECT unnest(['month', 'day', 'one']) AS feature))
GROUP BY ALL""",
        """months AS (SELECT symbol, date, CAST(month(date) AS INTEGER) AS month,
  CAST(isodow(date) - 1 AS INTEGER) AS day, volume AS y, 1 AS node FROM bars)""",
        _split("one", "months", "node"),
        """leaves AS (SELECT symbol, avg(y) FILTER (node = 2) AS low, avg(y) FILTER (node = 3) AS high FROM one GROUP BY symbol)""",
        """keyed AS (SELECT *, md5(symbol || '|' || strftime(date, '%Y-%m-%d') || '|42') AS key FROM months)""",
        """dealt AS (SELECT symbol, month, day, y,
  coalesce(lag(month) OVER w, last(month) OVER (PARTITION BY symbol ORDER BY key
    ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)) AS other_month,
  coalesce(lag(day) OVER w, last(day) OVER (PARTITION BY symbol ORDER BY key
    ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)) AS other_day
FROM keyed WINDOW w AS (PARTITION BY symbol ORDER BY key))"""),
    "ml_forest_per_symbol": with_bars(
        "SELECT symbol, count(*) AS n, CAST(0 AS BIGINT) AS zero_actuals, true AS holds "
        "FROM held WHERE part = 'test' GROUP BY symbol", *HELD),
    "ml_ridge_per_symbol": with_bars(
        f"""SELECT symbol, 1 AS lags, 1 AS lag, n, {r4('w', 'weight')}, {r4('my - w * m2', 'bias')} FROM (
  SELECT symbol, count(*) AS n, avg(y) AS my, avg(x2) AS m2,
         covar_pop(x2, y) / (var_pop(x2) + 0.01 / stddev_pop(y)) AS w
  FROM lags WHERE x2 IS NOT NULL GROUP BY symbol)
UNION ALL
SELECT symbol, 2 AS lags, lag, n, {r4('CASE lag WHEN 2 THEN w1 ELSE w2 END', 'weight')},
       {r4('my - w1 * m1 - w2 * m2', 'bias')}
FROM (SELECT *, (b * p - c * q) / (a * b - c * c) AS w1, (a * q - c * p) / (a * b - c * c) AS w2 FROM (
  SELECT symbol, count(*) AS n, avg(y) AS my, avg(x1) AS m1, avg(x2) AS m2,
         var_pop(x1) + 0.01 / stddev_pop(y) AS a, var_pop(x2) + 0.01 / stddev_pop(y) AS b,
         covar_pop(x1, x2) AS c, covar_pop(x1, y) AS p, covar_pop(x2, y) AS q
  FROM lags WHERE x1 IS NOT NULL GROUP BY symbol)), (SELECT unnest([1, 2]) AS lag)""",
        """spans AS (SELECT symbol, min(close) AS least, max(close) - min(close) AS span FROM bars GROUP BY symbol)""",
        f"""lags AS (SELECT symbol, y, lag(y) OVER ({W}) AS x2, lag(y, 2) OVER ({W}) AS x1
  FROM (SELECT symbol, date, (close - least) / span AS y FROM bars JOIN spans USING (symbol)))"""),
    "ml_ridge_walk_forward": with_bars(
        f"""SELECT symbol, date, {r4('close', 'actual')},
  {r4('(my + w1 * (x1 - m1) + w2 * (x2 - m2)) * span + least', 'predicted')}
FROM lags JOIN fitted USING (symbol) WHERE part = 'test'""", BACK, PARTS,
        """spans AS (SELECT symbol, min(close) AS least, max(close) - min(close) AS span
  FROM parts WHERE part = 'train' GROUP BY symbol)""",
        f"""lags AS (SELECT *, lag(y) OVER ({W}) AS x2, lag(y, 2) OVER ({W}) AS x1
  FROM (SELECT *, (close - least) / span AS y FROM parts JOIN spans USING (symbol)))""",
        """fitted AS (SELECT symbol, my, m1, m2, (b * p - c * q) / (a * b - c * c) AS w1,
    (a * q - c * p) / (a * b - c * c) AS w2 FROM (
  SELECT symbol, avg(y) AS my, avg(x1) AS m1, avg(x2) AS m2,
         var_pop(x1) + 0.01 / stddev_pop(y) AS a, var_pop(x2) + 0.01 / stddev_pop(y) AS b,
         covar_pop(x1, x2) AS c, covar_pop(x1, y) AS p, covar_pop(x2, y) AS q
  FROM lags WHERE part = 'train' AND x1 IS NOT NULL GROUP BY symbol))"""),
    "ml_recursive_trees": with_bars(
        f"SELECT symbol, date, {r4('close', 'actual')}, true AS holds FROM back WHERE back <= 30", BACK),
    "alerts_batch": f"WITH {DAILY}, {PREDICTIONS}, {ALERTS} SELECT {ALERT_COLS} FROM alerts",
    "str_alerts":
        f"WITH {DAILY}, {PREDICTIONS}, {ALERTS} SELECT ticker AS key, {ALERT_COLS} FROM alerts",
    "str_alerts_changing": f"""WITH {DAILY}, {PREDICTIONS}, made AS (
  SELECT symbol, prediction_date, predicted, CAST(prediction_date AS TIMESTAMP) AS made_at FROM predictions
  UNION ALL
  SELECT symbol, date + 1, close, CAST(date + 1 AS TIMESTAMP) + INTERVAL '12 hours' FROM daily),
compared AS (
  SELECT e.event_type AS ticker, e.value AS price, p.predicted, p.prediction_date, e.ts,
         row_number() OVER (PARTITION BY e.event_id ORDER BY p.made_at DESC) AS place
  FROM events e JOIN made p ON e.event_type = p.symbol AND CAST(e.ts AS DATE) = p.prediction_date AND p.made_at <= e.ts)
SELECT ticker AS key, ticker, {r4('price', 'current_price')}, {r4('predicted', 'predicted_price')},
  {r4('abs(predicted - price) / nullif(price, 0) * 100', 'price_diff_percent')},
  strftime(prediction_date, '%Y-%m-%d') AS prediction_date, strftime(ts, '%Y-%m-%d %H:%M:%S') AS last_update,
  '2024-01-31T12:00:00' AS alert_timestamp, 'intraday_price_difference' AS alert_type,
  CASE WHEN predicted > price THEN 'up' ELSE 'down' END AS direction
FROM compared WHERE place = 1 AND abs(predicted - price) / nullif(price, 0) * 100 >= 1.0""",
    "str_consume_each": """SELECT event_type AS symbol, count(*) AS messages,
  CAST(sum(event_id) AS BIGINT) AS event_ids FROM events GROUP BY event_type""",
    "str_envelope": ENVELOPES,
    "str_consume": """SELECT event_type AS symbol, count(*) AS messages,
  CAST(sum(event_id) AS BIGINT) AS event_ids FROM events GROUP BY event_type""",
    "bars_240m": BARS_240M,
    "str_bars_240m": f"""SELECT * FROM ({BARS_240M})
WHERE window_end <= (SELECT max(ts) FROM events) - INTERVAL '1 hour'""",
    "str_bars_open": f"SELECT *, CAST(0 AS BIGINT) AS late FROM ({BARS_240M})",
    "band_predicted": with_bars(
        f"""SELECT symbol, date + 1 AS prediction_date, {r4('mean', 'predicted_close')},
  {r4('mean + lower', 'predicted_low')}, {r4('mean + upper', 'predicted_high')}, {r4('held', 'held')}, n
FROM (SELECT symbol, date, back, {mean('close', 5)} AS mean FROM back) JOIN edges USING (symbol)
JOIN judged USING (symbol) WHERE back = 1""", BACK,
        f"""distances AS (SELECT symbol, back, high - guess AS above, low - guess AS below
  FROM (SELECT *, {before('close', 5)} AS guess FROM back) WHERE guess IS NOT NULL)""",
        """places AS (SELECT *, count(*) OVER (PARTITION BY symbol) AS k,
    row_number() OVER (PARTITION BY symbol ORDER BY above) AS i,
    row_number() OVER (PARTITION BY symbol ORDER BY below) AS j FROM distances WHERE back > 30)""",
        """edges AS (SELECT symbol, max(above) FILTER (i = greatest(1, ceil(round(k * 0.95, 6)))) AS upper,
    max(below) FILTER (j = greatest(1, ceil(round(k * 0.05, 6)))) AS lower FROM places GROUP BY symbol)""",
        """judged AS (SELECT symbol, avg(CASE WHEN above <= upper AND below >= lower THEN 1 ELSE 0 END) AS held,
    count(*) AS n FROM distances JOIN edges USING (symbol) WHERE back <= 30 GROUP BY symbol)"""),
    "band_breaches": f"""WITH {DAILY}, intraday AS ({BARS_240M})
SELECT i.symbol, CAST(window_start AS DATE) AS prediction_date, window_start,
  {r4('i.high', 'high')}, {r4('i.low', 'low')}, {r4('d.high', 'predicted_high')},
  {r4('d.low', 'predicted_low')},
  CASE WHEN i.high > d.high AND i.low < d.low THEN 'both' WHEN i.high > d.high THEN 'above'
       ELSE 'below' END AS side
FROM intraday i JOIN daily d ON d.symbol = i.symbol AND d.date + 1 = CAST(window_start AS DATE)
WHERE i.high > d.high OR i.low < d.low""",
}
